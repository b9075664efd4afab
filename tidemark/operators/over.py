"""Aggregates over frames of rows or of time, one result per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import interval
from tidemark.operators.history import GROUP_LIMIT, number_rows, prefix_scan, running

TILE_ROWS = 1 << 20


def count_over_range(df: DataFrame, keys: Sequence[str], ts: str, span: str, name: str = "cnt", **slicing) -> DataFrame:
    """Rows of the same key from ``span`` before a row up to its own time, both included.

    Counts by sweeping over time: rows of one time are counted together, add to a running
    total at that time and leave it right after ``span``. The work is linear in the rows,
    not in the pairs a frame would compare.
    """
    keys = list(keys)
    moments = df.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("__n"))
    enter = F.struct(F.col(ts).alias("at"), F.lit(0).alias("leaves"), F.col("__n").alias("change"))
    leave = F.struct((F.col(ts) + interval(span)).alias("at"), F.lit(1).alias("leaves"), (-F.col("__n")).alias("change"))
    points = moments.select(*keys, F.explode(F.array(enter, leave)).alias("p")).select(*keys, "p.*")
    sample = df.select(*keys, F.col(ts).alias("at"), F.lit(0).alias("leaves"))
    swept = prefix_scan(points, keys, ["at", "leaves"], {name: running("change")}, sample=sample, **slicing)
    totals = swept.where("leaves = 0")
    renamed = {k: f"__o{i}" for i, k in enumerate([*keys, ts])}
    counted = totals.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate([*keys, "at"])], name)
    same = F.lit(True)
    for k, r in renamed.items():
        same = same & df[k].eqNullSafe(counted[r])
    return df.join(counted, same).drop(*renamed.values())


def agg_over_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], preceding: int, aggregates: dict[str, Column], tile_rows: int = TILE_ROWS, **slicing) -> DataFrame:
    """Aggregates over a row and the ``preceding`` rows before it.

    Histories are cut into tiles of row numbers. The last rows of a tile are copied to the
    next one, where they are only looked back at, so a frame never crosses a tile.
    """
    keys = list(keys)
    tile = max(tile_rows, preceding + 1)
    numbered = number_rows(df, keys, order, "__rn", **slicing)
    own = F.floor((F.col("__rn") - 1) / tile).cast("long")
    lends = F.pmod(F.col("__rn") - 1, F.lit(tile)) >= tile - preceding
    tiles = F.explode(F.when(lends, F.array(own, own + 1)).otherwise(F.array(own)))
    placed = numbered.withColumn("__own", own).withColumn("__tile", tiles)
    frame = Window.partitionBy(*keys, "__tile").orderBy("__rn").rowsBetween(-preceding, 0)
    out = placed.withColumns({n: c.over(frame) for n, c in aggregates.items()})
    return out.where(F.col("__tile") == F.col("__own")).drop("__rn", "__own", "__tile")


def window_rank(df: DataFrame, windows: Sequence[str], metric: str, ties: Sequence[str], n: int, name: str = "rank") -> DataFrame:
    """The ``n`` rows with the highest metric per window.

    Up to ``GROUP_LIMIT`` rows Spark limits a window before the shuffle too; for more, numeric metrics are ranked in slices.
    """
    if n > GROUP_LIMIT:
        turned = df.withColumn("__descending", -F.col(metric))
        ranked = prefix_scan(turned, windows, ["__descending", *ties], {name: running(F.lit(1).cast("long"))})
        return ranked.where(F.col(name) <= n).withColumn(name, F.col(name).cast("int")).drop("__descending")
    ranked = Window.partitionBy(*windows).orderBy(F.col(metric).desc(), *ties)
    return df.withColumn(name, F.row_number().over(ranked)).where(F.col(name) <= n)
