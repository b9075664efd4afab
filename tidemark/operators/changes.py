"""Change events: normalising, retracting, materialising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRING_MAP = "map<string,string>"


def normalize_change_event(df: DataFrame, topic: str = "topic", op: str = "op", before: str = "before", after: str = "after") -> DataFrame:
    """Topic ``server.database.table`` and JSON images to one change-event schema.

    ``create`` becomes ``insert``, other operations are lower-cased. A missing image or a
    null field stays null.
    """
    parts = F.split(F.col(topic), r"\.")
    kind = F.lower(op)
    rest = [c for c in df.columns if c not in (topic, op, before, after)]
    return df.select(
        *rest,
        F.get(parts, F.lit(1)).alias("database"),
        F.get(parts, F.lit(2)).alias("table"),
        F.when(kind == "create", F.lit("insert")).otherwise(kind).alias("type"),
        F.from_json(before, STRING_MAP).alias("before"),
        F.from_json(after, STRING_MAP).alias("after"),
    )


def retract_stream(changes: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """``(false, old row)`` and ``(true, new row)`` for each change, in this order."""
    old = F.struct(F.lit(0).alias("step"), F.lit(False).alias("added"), F.col(before).alias("row"))
    new = F.struct(F.lit(1).alias("step"), F.lit(True).alias("added"), F.col(after).alias("row"))
    rest = [c for c in changes.columns if c not in (before, after)]
    both = changes.select(*rest, F.explode(F.array(old, new)).alias("__c"))
    return both.where(F.col("__c.row").isNotNull()).select(*rest, "__c.step", "__c.added", "__c.row")


def materialize_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column) -> DataFrame:
    """The table as it stands: the latest change per key, unless that deletes the row."""
    rest = [c for c in changes.columns if c not in keys]
    tagged = changes.withColumn("__deleted", deleted)
    latest = tagged.groupBy(*keys).agg(
        F.max_by(F.struct(*rest, "__deleted"), F.struct(*order)).alias("row")
    )
    return latest.where(~F.col("row.__deleted")).select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key, e.g. the rules in force when later ones replace earlier."""
    return materialize_changes(df, keys, order, F.lit(False))
