"""Running values over the ordered history of a key, safe for very hot keys.

``Window.partitionBy(key)`` puts a key's whole history into one task. Here a long
history is first cut into slices of consecutive rows. A slice is what one task
sorts; what the earlier slices add is a small per-slice total that is summed up
and joined back. Short histories have one slice and behave like a plain window.

Slice boundaries are rows picked by a hash of their own content, about one in
``rows_per_slice``, so every re-computation and every retry picks the same ones.
Their number, and thus the size of both broadcast tables, stays near
``max_boundaries`` whatever the input size: more picked rows than that are thinned
by their own number, so the input is not counted first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1 << 20
MAX_BOUNDARIES = 1 << 16
# Boundaries are looked up in two steps, so that a row never carries more than one block.
BLOCK = 256
#: Spark pushes a limit per group below the shuffle up to this many rows (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000

_SLICE, _SPLITS, _ONE = "__slice", "__splits", "__one"


@dataclass(frozen=True)
class Fold:
    """An aggregate that can be continued from slice to slice: sum, min or max."""

    kind: str
    column: Column


def running(column) -> Fold:
    return Fold("sum", F.col(column) if isinstance(column, str) else column)


def lowest(column) -> Fold:
    return Fold("min", F.col(column) if isinstance(column, str) else column)


def highest(column) -> Fold:
    return Fold("max", F.col(column) if isinstance(column, str) else column)


_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}


def _continue(kind: str, here: Column, carried: Column) -> Column:
    if kind == "sum":
        return F.when(here.isNull(), carried).when(carried.isNull(), here).otherwise(here + carried)
    return (F.least if kind == "min" else F.greatest)(here, carried)


def _same(left: DataFrame, right: DataFrame, pairs) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def _boundaries_at_or_before(point: Column, splits: Column) -> Column:
    """Binary search: how many of the sorted ``splits`` are not after ``point``."""

    def halve(bounds, _):
        middle = F.floor((bounds["lo"] + bounds["hi"]) / 2).cast("int")
        open_ = bounds["lo"] < bounds["hi"]
        right = open_ & (F.get(splits, middle) <= point)
        return F.struct(
            F.when(right, middle + 1).otherwise(bounds["lo"]).alias("lo"),
            F.when(open_ & ~right, middle).otherwise(bounds["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi"))
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(splits) + 1)).cast("int"))
    found = F.aggregate(rounds, start, halve, lambda bounds: bounds["lo"])
    return F.when(splits.isNull(), F.lit(0)).otherwise(found)


def slice_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    max_boundaries: int = MAX_BOUNDARIES,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Number the slices of every key's history; adds two internal columns.

    ``order`` should be a total order within a key. Equal rows share a slice. If ``df``
    is costly to compute, pass a cheaper ``sample`` with about the same ``keys`` and
    ``order`` to take the boundaries from: any boundaries give the same result.
    """
    sample = df if sample is None else sample
    draw = F.xxhash64(*keys, *order)
    rate = F.lit(rows_per_slice).cast("long")
    renamed = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)] or [F.lit(1).alias("__k0")]
    names = [f"__k{i}" for i in range(len(renamed))]
    picked = sample.where(F.pmod(draw, rate) == 0).select(*renamed, F.struct(*order).alias("__point"), draw.alias("__draw")).distinct()
    # One row in a million at most is counted here.
    thinned = F.ceil(F.count(F.lit(1)).over(Window.partitionBy()) / F.lit(max_boundaries)).cast("long")
    splits = (
        picked.withColumn("__keep", thinned)
        .where(F.pmod(F.floor(F.col("__draw") / rate), F.col("__keep")) == 0)
        .groupBy(*names)
        .agg(F.array_sort(F.collect_set("__point")).alias("__all"))
    )
    firsts = F.sequence(F.lit(0), F.size("__all") - 1, F.lit(BLOCK))
    coarse = splits.select(*names, F.transform(firsts, lambda i: F.get("__all", i)).alias("__coarse"))
    blocks = F.transform(firsts, lambda i: F.struct(i.alias("first"), F.slice("__all", i + 1, BLOCK).alias("points")))
    fine = splits.select(
        *[F.col(n).alias(f"{n}_") for n in names], F.posexplode(blocks).alias("__position", "__cut_block")
    ).select(*[f"{n}_" for n in names], (F.col("__position") + 1).alias("__cut_number"), "__cut_block")
    if not keys:
        df = df.withColumn(_ONE, F.lit(1))
        keys = [_ONE]
    point = F.struct(*order)
    found = (
        df.join(F.broadcast(coarse), _same(df, coarse, zip(keys, names)), "left")
        .withColumn("__cut_at", _boundaries_at_or_before(point, F.col("__coarse")))
        .withColumn(_SPLITS, F.col("__coarse").isNotNull())
        .drop("__coarse", *names)
    )
    pairs = [*zip(keys, [f"{n}_" for n in names]), ("__cut_at", "__cut_number")]
    placed = found.join(F.broadcast(fine), _same(found, fine, pairs), "left")
    inside = F.col("__cut_block.first") + _boundaries_at_or_before(point, F.col("__cut_block.points"))
    return placed.withColumn(_SLICE, F.coalesce(inside, F.lit(0))).drop(
        "__cut_block", "__cut_number", "__cut_at", *[f"{n}_" for n in names]
    )


def unslice(df: DataFrame) -> DataFrame:
    return df.drop(_SLICE, _SPLITS, _ONE)


def scan_slices(
    sliced: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Mapping[str, Fold],
    inclusive: bool = True,
    backward: bool = False,
) -> DataFrame:
    """Running folds over histories that ``slice_history`` has cut.

    ``backward`` runs from the newest row to the oldest; with ``inclusive=False``
    the row itself is left out of its own value.
    """
    keys = list(keys) or [_ONE]
    direction = (lambda c: F.col(c).desc()) if backward else (lambda c: F.col(c).asc())
    end = Window.currentRow if inclusive else -1
    frame = (
        Window.partitionBy(*keys, _SLICE)
        .orderBy(*[direction(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, end)
    )
    here = {n: f"__here_{n}" for n in folds}
    local = sliced.withColumns({here[n]: _AGGREGATE[f.kind](f.column).over(frame) for n, f in folds.items()})

    renamed = {k: f"__c{i}" for i, k in enumerate([*keys, _SLICE])}
    totals = (
        sliced.where(F.col(_SPLITS))
        .groupBy(*[F.col(k).alias(c) for k, c in renamed.items()])
        .agg(*[_AGGREGATE[f.kind](f.column).alias(n) for n, f in folds.items()])
    )
    earlier = (
        Window.partitionBy(*[renamed[k] for k in keys])
        .orderBy(direction(renamed[_SLICE]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *renamed.values(),
        *[_AGGREGATE[f.kind](F.col(n)).over(earlier).alias(f"__carry_{n}") for n, f in folds.items()],
    )
    joined = local.join(F.broadcast(carry), _same(local, carry, renamed.items()), "left")
    value = {n: _continue(f.kind, F.col(here[n]), F.col(f"__carry_{n}")) for n, f in folds.items()}
    return joined.withColumns(value).drop(
        *renamed.values(), *here.values(), *[f"__carry_{n}" for n in folds]
    )


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: Mapping[str, Fold],
    inclusive: bool = True,
    backward: bool = False,
    **slicing,
) -> DataFrame:
    """``slice_history`` + ``scan_slices`` for a single pass."""
    sliced = slice_history(df, keys, order, **slicing)
    return unslice(scan_slices(sliced, keys, order, folds, inclusive, backward))


def number_rows(df: DataFrame, keys, order, name: str = "rn", **slicing) -> DataFrame:
    """Position of each row in its key's history, from 1."""
    return prefix_scan(df, keys, order, {name: running(F.lit(1).cast("long"))}, **slicing)


def previous_row(df: DataFrame, keys, order, columns: Mapping[str, str], **slicing) -> DataFrame:
    """Values of the row before, as ``{new_name: column}`` (null on the first row)."""
    seen = F.struct(*order, *[F.col(c).alias(n) for n, c in columns.items()])
    out = prefix_scan(df, keys, order, {"__prev": highest(seen)}, inclusive=False, **slicing)
    return out.withColumns({n: F.col(f"__prev.{n}") for n in columns}).drop("__prev")


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Add per-group aggregates to every row: map-side aggregation, then a join back.

    The join is left to Spark: small results are broadcast by the checked
    threshold, and a hot group is split by the adaptive skew join.
    """
    renamed = {k: f"__g{i}" for i, k in enumerate(keys)}
    totals = df.groupBy(*[F.col(k).alias(c) for k, c in renamed.items()]).agg(
        *[c.alias(n) for n, c in stats.items()]
    )
    return df.join(totals, _same(df, totals, renamed.items()), "inner").drop(*renamed.values())
