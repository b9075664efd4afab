"""Projection, filtering, splitting and placement of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import NON_WORD, case_map


def map_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns))


def tokenize(df: DataFrame, column: str, lower: bool = True, pattern: str = NON_WORD, keep_empty: bool = False) -> DataFrame:
    """One row ``(token, 1)`` per piece of text between matches of ``pattern``."""
    text = F.lower(column) if lower else F.col(column)
    rest = [c for c in df.columns if c != column]
    tokens = df.select(*rest, F.explode(F.split(text, pattern)).alias("token"), F.lit(1).cast("long").alias("n"))
    return tokens if keep_empty else tokens.where(F.col("token") != "")


def filter_rows(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def having(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], predicate: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()]).where(predicate)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``mapping`` goes from the physical name to the logical one."""
    return df.withColumnsRenamed(dict(mapping))


def map_values(df: DataFrame, column: str, mapping: Mapping, default, name: str) -> DataFrame:
    return df.withColumn(name, case_map(F.col(column), mapping, default))


def split_by_rules(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, DataFrame]:
    """One output per named rule; a row may be in several."""
    return {name: df.where(rule) for name, rule in rules.items()}


def select_split(df: DataFrame, rules: Mapping[str, Column], names: Sequence[str]) -> DataFrame:
    """Rows of any of the named outputs, each row once."""
    wanted = rules[names[0]]
    for name in names[1:]:
        wanted = wanted | rules[name]
    return df.where(wanted)


def side_output(df: DataFrame, rejected: Column, message: Column) -> tuple[DataFrame, DataFrame]:
    """``(kept rows, one message per rejected row)``; a null test counts as kept."""
    tagged = df.withColumn("__rejected", F.coalesce(rejected, F.lit(False)))
    kept = tagged.where(~F.col("__rejected")).drop("__rejected")
    messages = tagged.where(F.col("__rejected")).select(message.alias("message"))
    return kept, messages


def connect_map(left: DataFrame, right: DataFrame, left_map: Mapping[str, Column], right_map: Mapping[str, Column]) -> DataFrame:
    """Map two differently typed inputs to one schema; ``side`` tells where a row came from."""
    def mapped(df, columns, side):
        return df.select(*[c.alias(n) for n, c in columns.items()], F.lit(side).alias("side"))

    return mapped(left, left_map, "left").unionByName(mapped(right, right_map, "right"))


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all inputs; works for streams too. Schemas must agree by name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def custom_partition(df: DataFrame, partition: Column, n: int) -> DataFrame:
    """Place each row in the partition whose number is ``partition`` (0 to n - 1).

    Placement by few distinct numbers makes few, large tasks: use it only when the
    placement itself is wanted, never as a step before an aggregation.
    """
    return df.repartitionById(n, partition.cast("int"))


def key_by(df: DataFrame, *keys: str) -> DataFrame:
    """Place the rows of a key together. ``groupBy`` and joins do this by themselves."""
    return df.repartition(*keys)


def broadcast_rows(df: DataFrame, partitions: int) -> DataFrame:
    """One copy of every row per partition number, placed on that partition."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("partition")
    return df.select("*", copies).repartitionById(partitions, F.col("partition"))


def to_global(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """One result over all rows, aggregated inside each task first."""
    return df.agg(*[c.alias(n) for n, c in aggregates.items()])


def parse_tuple_text(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """``"(a,b,c)"`` to typed columns named by ``fields``."""
    inner = F.expr(f"substring({column}, 2, length({column}) - 2)")
    parts = F.split(inner, ",")
    return df.select(*[F.trim(parts[i]).cast(t).alias(n) for i, (n, t) in enumerate(fields.items())])


def parse_csv_pair(df: DataFrame, column: str, key: str = "key", number: str = "ms") -> DataFrame:
    parts = F.split(F.col(column), ",")
    return df.select(parts[0].alias(key), F.trim(parts[1]).cast("long").alias(number))


def sort_desc(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(column).desc(), *ties)


def limit_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)


def cluster_by_day(df: DataFrame, ts: str) -> DataFrame:
    """Rows of a day side by side and sorted by time; a long day is split by time, short days share a task."""
    return df.withColumn("day", F.date_format(ts, "yyyyMMdd")).repartitionByRange("day", ts).sortWithinPartitions("day", ts)
