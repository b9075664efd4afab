"""Joins of streams and tables.

No side is broadcast by hint: Spark broadcasts a side whose size it has checked
(``spark.sql.autoBroadcastJoinThreshold``, at run time under adaptive execution) and
otherwise shuffles, splitting hot keys with the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import interval, micros, time_bucket


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, size: str) -> DataFrame:
    """Inner join of rows with the same key in the same tumbling window.

    The raw times are dropped, so that each streaming side keeps one event-time column.
    """
    a = left.withColumn("window", F.window(left_ts, size)).drop(left_ts)
    b = right.withColumn("window", F.window(right_ts, size)).drop(right_ts)
    return a.join(b, [*keys, "window"])


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, low: str, high: str) -> DataFrame:
    """Pairs with equal keys and ``right_ts + low <= left_ts <= right_ts + high``.

    On tables the time range becomes part of the join key, so a hot key is spread over
    its time line instead of being compared with itself as a whole: a left row lies in
    one bucket as wide as the range, a right row is copied to the (at most two) buckets
    its range touches. Column names other than the keys must differ.
    """
    within = (F.col(left_ts) >= F.col(right_ts) + interval(low)) & (F.col(left_ts) <= F.col(right_ts) + interval(high))
    if left.isStreaming or right.isStreaming:
        renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
        condition = within
        for k in keys:
            condition = condition & (F.col(k) == F.col(f"__r_{k}"))
        return left.join(renamed, condition).drop(*[f"__r_{k}" for k in keys])
    width = f"{max(micros(high) - micros(low), 1_000) / 1_000_000:.6f} seconds"
    a = left.withColumn("__bucket", time_bucket(left_ts, width))
    reach = F.sequence(
        time_bucket(F.col(right_ts) + interval(low), width), time_bucket(F.col(right_ts) + interval(high), width)
    )
    b = right.withColumn("__bucket", F.explode(reach))
    return a.join(b, [*keys, "__bucket"]).where(within).drop("__bucket")


def lookup_join(stream: DataFrame, dim: DataFrame, stream_key: str, dim_key: str, how: str = "left") -> DataFrame:
    """Enrich rows with the dimension as it is now; unmatched rows are kept by default."""
    return stream.join(dim, stream[stream_key] == dim[dim_key], how)


def with_validity(versions: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str = "valid_to") -> DataFrame:
    """Versions of dimension rows with the time at which the next one takes over, null for the last."""
    following = Window.partitionBy(*keys).orderBy(valid_from)
    return versions.withColumn(valid_to, F.lead(valid_from).over(following))


def as_of_join(rows: DataFrame, versions: DataFrame, row_key: str, key: str, ts: str, valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "left") -> DataFrame:
    """Enrich each row with the version of the dimension row that was valid at the row's own time.

    ``versions`` has their validity (``with_validity``), so a row meets one version at most; rows before the first version
    have none. An equality join on the key with a range as its rest: the versions of a key are few, a hot key of ``rows`` is
    split by the adaptive skew join.
    """
    in_time = (rows[ts] >= versions[valid_from]) & (versions[valid_to].isNull() | (rows[ts] < versions[valid_to]))
    return rows.join(versions, (rows[row_key] == versions[key]) & in_time, how)


def comma_join(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """``FROM a, b WHERE ...`` with an equality in the condition."""
    return left.join(right, condition, "inner")


def rule_join(items: DataFrame, rules: DataFrame, field: str, first: str = "first", second: str = "second") -> DataFrame:
    """Every item with every rule it takes part in, as first or second element.

    Rules are listed once per value they name, which makes this an equality join.
    """
    named = rules.withColumn("__value", F.explode(F.array_distinct(F.array(first, second))))
    joined = items.join(named, items[field] == named["__value"])
    return joined.withColumns(
        {"is_first": F.col(field) == F.col(first), "is_second": F.col(field) == F.col(second)}
    ).drop("__value")
