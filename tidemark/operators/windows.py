"""Assigning rows to windows by time, session, count and change of a measure."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidemark.functions.times import interval, last_millisecond, micros, time_bucket
from tidemark.operators.history import (
    GROUP_LIMIT,
    _ONE, _SLICE, _SPLITS, _same, Fold, highest, number_rows, prefix_scan, running, scan_slices, slice_history, unslice, with_group_stats,
)
from tidemark.runtime import cut_lineage

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def _partial(folds: Mapping[str, Fold]) -> list[Column]:
    return [_MERGE[f.kind](f.column).alias(n) for n, f in folds.items()]


def _merged(folds: Mapping[str, Fold]) -> list[Column]:
    return [_MERGE[f.kind](F.col(n)).alias(n) for n, f in folds.items()]


def tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    return df.withColumn("window", F.window(ts, size))


def tumble_processing_time(df: DataFrame, size: str) -> DataFrame:
    """Windows of the time a row is processed at, not of its own time."""
    return df.withColumn("process_time", F.current_timestamp()).withColumn("window", F.window("process_time", size))


def hop(df: DataFrame, ts: str, slide: str, size: str) -> DataFrame:
    """Overlapping windows; the slide comes first, as in SQL ``HOP``."""
    return df.withColumn("window", F.window(ts, size, slide))


def window_bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window column by ``window_start``, ``window_end`` and ``window_time``."""
    return df.withColumns(
        {
            "window_start": F.col(f"{window}.start"),
            "window_end": F.col(f"{window}.end"),
            "window_time": last_millisecond(F.col(f"{window}.end")),
        }
    ).drop(window)


def cumulate(df: DataFrame, ts: str, step: str, max_size: str) -> DataFrame:
    """Windows with a common start that grow by ``step`` up to ``max_size``."""
    pane, whole = F.window(ts, step), F.window(ts, max_size)
    placed = df.withColumn("__pane", pane).withColumn("__whole", whole)
    ends = F.sequence(F.col("__pane.end"), F.col("__whole.end"), interval(step))
    return (
        placed.withColumn("__end", F.explode(ends))
        .withColumn("window", F.struct(F.col("__whole.start").alias("start"), F.col("__end").alias("end")))
        .drop("__pane", "__whole", "__end")
    )


def window_rows(df: DataFrame, kind: str, ts: str, size: str, step: str | None = None) -> DataFrame:
    """Table-valued form: every row with the bounds of each window it is in."""
    placed = {
        "tumble": lambda: tumble(df, ts, size),
        "hop": lambda: hop(df, ts, step, size),
        "cumulate": lambda: cumulate(df, ts, step, size),
    }[kind]()
    return window_bounds(placed)


def hop_agg(df: DataFrame, ts: str, slide: str, size: str, folds: Mapping[str, Fold], keys: Sequence[str] = ()) -> DataFrame:
    """Aggregates over overlapping windows, from panes reduced before they are copied.

    A pane is as wide as the largest width that divides both slide and size.
    """
    pane = gcd(micros(slide), micros(size))
    width = f"{pane / 1_000_000:.6f} seconds"
    panes = df.groupBy(*keys, F.window(ts, width).alias("pane")).agg(*_partial(folds))
    out = hop(panes.withColumn("__at", F.col("pane.start")), "__at", slide, size).groupBy(*keys, "window").agg(*_merged(folds))
    return out.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *folds
    )


def cumulate_agg(df: DataFrame, ts: str, step: str, max_size: str, folds: Mapping[str, Fold], keys: Sequence[str] = ()) -> DataFrame:
    """Aggregates over cumulating windows; rows are reduced to one per pane before they are copied."""
    panes = df.groupBy(*keys, F.window(ts, step).alias("pane")).agg(*_partial(folds))
    placed = cumulate(panes.withColumn("__at", F.col("pane.start")), "__at", step, max_size)
    out = placed.groupBy(*keys, "window").agg(*_merged(folds))
    return out.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *folds
    )


def session_agg(df: DataFrame, keys: Sequence[str], ts: str, gap: str, folds: Mapping[str, Fold], **slicing) -> DataFrame:
    """Aggregates per session; rows at most ``gap`` apart belong together.

    Rows in the same epoch-aligned bucket of width ``gap`` are always in one session, so
    the rows are reduced to one per key and bucket first. Sessions are then found on those.
    """
    keys = list(keys)
    bucketed = df.withColumn("__bucket", time_bucket(ts, gap))
    sliced = slice_history(bucketed, keys, ["__bucket"], **slicing)
    internal = [c for c in sliced.columns if c not in bucketed.columns]
    reduced = sliced.groupBy(*keys, *internal, "__bucket").agg(
        F.min(ts).alias("__from"), F.max(ts).alias("__to"), *_partial(folds)
    )
    seen = scan_slices(reduced, keys, ["__bucket"], {"__before": highest("__to")}, inclusive=False)
    apart = F.col("__before").isNull() | (F.col("__from") > F.col("__before") + interval(gap))
    opened = seen.withColumn("__opens", F.when(apart, F.col("__from")))
    marked = scan_slices(opened, keys, ["__bucket"], {"session_start": highest("__opens")})
    out = unslice(marked).groupBy(*keys, "session_start").agg(F.max("__to").alias("__to"), *_merged(folds))
    return out.select(*keys, "session_start", (F.col("__to") + interval(gap)).alias("session_end"), *folds)


def count_window_slide(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int, folds: Mapping[str, Fold], **slicing) -> DataFrame:
    """Every ``slide``-th row of a key fires over its last ``size`` rows; ``at_row`` is that row.

    Rows are numbered, reduced to panes and the panes copied to the firings over them, so
    no task needs all rows of a key.
    """
    pane = gcd(size, slide)
    numbered = number_rows(df, keys, order, "__rn", **slicing)
    panes = (
        numbered.withColumn("__pane", F.ceil(F.col("__rn") / pane).cast("long"))
        .groupBy(*keys, "__pane").agg(F.max("__rn").alias("__rn"), *_partial(folds))
    )
    return _firings(panes, keys, pane, size, slide, folds)


def _firings(panes: DataFrame, keys: Sequence[str], pane: int, size: int, slide: int, folds: Mapping[str, Fold]) -> DataFrame:
    """Copy panes to the firings over them; ``__rn`` is the last row of a pane that there is."""
    first = F.ceil(F.col("__pane") * pane / slide).cast("long") * slide
    last = F.floor((F.col("__pane") * pane + (size - pane)) / slide).cast("long") * slide
    firings = panes.where(first <= last).withColumn("at_row", F.explode(F.sequence(first, last, F.lit(slide).cast("long"))))
    out = firings.groupBy(*keys, "at_row").agg(F.max("__rn").alias("__rn"), *_merged(folds))
    return out.where(F.col("__rn") == F.col("at_row")).drop("__rn")


def count_window_slide_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str], times: str, size: int, slide: int, folds: Mapping[str, Fold], **slicing) -> DataFrame:
    """``count_window_slide`` over rows that each stand for ``times`` equal rows in a row.

    A running sum of ``times`` tells which rows of its key a row stands for, and arithmetic which firings look at these, so the
    repeated rows are never made, shuffled or sorted; what is shuffled is one row per firing and task. Sums count a row as
    often as it stands in a window. Rows with ``times`` below 1 stand for none.
    """
    there = df.where(F.col(times) >= 1)
    placed = prefix_scan(there, keys, order, {"__upto": running(F.col(times).cast("long"))}, **slicing)
    from_row = F.col("__upto") - F.col(times) + 1
    first = F.ceil(from_row / slide).cast("long") * slide
    last = F.floor((F.col("__upto") + (size - 1)) / slide).cast("long") * slide
    spread = placed.where(first <= last).withColumn("at_row", F.explode(F.sequence(first, last, F.lit(slide).cast("long"))))
    inside = F.least(F.col("__upto"), F.col("at_row")) - F.greatest(from_row, F.col("at_row") - (size - 1)) + 1
    counted = [_MERGE[f.kind](f.column * inside if f.kind == "sum" else f.column).alias(n) for n, f in folds.items()]
    # A firing whose last row is not there yet does not fire.
    out = spread.groupBy(*keys, "at_row").agg(F.max("__upto").alias("__upto"), *counted)
    return out.where(F.col("__upto") >= F.col("at_row")).drop("__upto")


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, folds: Mapping[str, Fold], **slicing) -> DataFrame:
    """Aggregates of each full group of ``n`` consecutive rows of a key."""
    numbered = number_rows(df, keys, order, "__rn", **slicing)
    groups = numbered.withColumn("group_no", F.floor((F.col("__rn") - 1) / n).cast("long"))
    out = groups.groupBy(*keys, "group_no").agg(F.count(F.lit(1)).alias("__n"), *_partial(folds))
    return out.where(F.col("__n") == n).drop("__n")


def evict_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each group.

    Up to ``GROUP_LIMIT`` rows Spark limits a group before the shuffle too; for more the rows are numbered from the back in
    slices, so that a long group is not sorted in one task.
    """
    if n > GROUP_LIMIT:
        numbered = prefix_scan(df, keys, order, {"__rank": running(F.lit(1).cast("long"))}, backward=True)
        return numbered.where(F.col("__rank") <= n).drop("__rank")
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= n).drop("__rank")


def evict_delta(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, threshold) -> DataFrame:
    """Drop rows whose value lies ``threshold`` or more below that of the last row."""
    last = with_group_stats(df, keys, {"__last": F.max_by(column, F.struct(*order))})
    return last.where(F.col("__last") - F.col(column) < F.lit(threshold)).drop("__last")


def evict_time(df: DataFrame, keys: Sequence[str], ts: str, keep: str) -> DataFrame:
    """Drop rows older than the newest row of the group minus ``keep``."""
    newest = with_group_stats(df, keys, {"__newest": F.max(ts)})
    return newest.where(F.col(ts) >= F.col("__newest") - interval(keep)).drop("__newest")


def sort_in_window(df: DataFrame, keys: Sequence[str], ts: str, size: str, order: Sequence[str], **slicing) -> DataFrame:
    """Rows with their window and position in it by time."""
    placed = window_bounds(tumble(df, ts, size))
    return number_rows(placed, [*keys, "window_start"], order, "position", **slicing)


def best_of_last(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], keep: str, rank: Column, wanted: Column, name: str, **slicing) -> DataFrame:
    """For each ``wanted`` row the highest ``rank`` among rows up to it, ``keep`` old at most.

    Time is cut into buckets as long as ``keep``. The range then is the head of the row's
    own bucket and the tail of the bucket before; both are running maxima, so the work is
    linear however many rows a range holds. ``order`` must begin with the time.
    """
    keys = list(keys)
    ranked = df.withColumns({"__rank": rank, "__bucket": time_bucket(ts, keep), "__wanted": wanted})
    head = prefix_scan(ranked, [*keys, "__bucket"], order, {"__head": highest("__rank")}, **slicing)
    itself = F.struct(F.col("__bucket").alias("b"), F.col(ts).alias("at"), F.lit(1).alias("side"))
    probe = F.struct((F.col("__bucket") - 1).alias("b"), (F.col(ts) - interval(keep)).alias("at"), F.lit(0).alias("side"))
    points = F.explode(F.when(F.col("__wanted"), F.array(itself, probe)).otherwise(F.array(itself)))
    spread = head.withColumn("__p", points).withColumns(
        {"__bucket": F.col("__p.b"), "__at": F.col("__p.at"), "__side": F.col("__p.side")}
    ).drop("__p")
    on_row = F.when(F.col("__side") == 1, F.col("__rank"))
    sample = ranked.withColumns({"__at": F.col(ts), "__side": F.lit(1)})
    tail = prefix_scan(
        spread, [*keys, "__bucket"], ["__at", "__side", *order], {"__tail": highest(on_row)},
        backward=True, sample=sample, **slicing,
    )
    found = tail.where(F.col("__side") == 0).withColumn(name, F.greatest("__head", "__tail"))
    return found.drop("__rank", "__bucket", "__wanted", "__head", "__at", "__side", "__tail")


def _pieces(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(starts[1:]) + 1), len(starts)]
    return zip(cuts, cuts[1:])


def _exits(values: np.ndarray, threshold: float) -> tuple[list[float], list[float]]:
    """What a slice of rising values does to the base it is entered with.

    A base below the slice first fires at some value up to the one that the first value
    itself would lead to; each of those leads to a last firing in the slice. Neighbours
    with the same last firing are put together: ``(highest first firing, last firing)``.
    """
    n = len(values)
    follows = np.searchsorted(values, values + threshold, "right")
    last = np.where(follows < n, follows, np.arange(n))
    while True:
        further = last[last]
        if (further == last).all():
            break
        last = further
    ends = values[last[: min(n, follows[0] + 1)]]
    changes = np.append(np.flatnonzero(np.diff(ends)), len(ends) - 1)
    return values[changes].tolist(), ends[changes].tolist()


def delta_fires(df: DataFrame, keys: Sequence[str], order: Sequence[str], measure: str, threshold: float, **slicing) -> DataFrame:
    """Rows at which ``measure`` has grown by more than ``threshold`` since the last firing.

    The first row of a key sets the base without firing. Only a row above everything
    before it can fire, so just those rows, key and measure only, are looked at. Of a long
    history each slice first tells where it would end for every base it may be entered
    with (``_exits``); going through these gives the base each slice really starts from,
    and the slices then run side by side.
    """
    keys, order = list(keys), list(order)
    slim = df.select(*keys, *order, measure).where(F.col(measure).isNotNull())
    sliced = slice_history(slim, keys, order, **slicing)
    ids = [*(keys or [_ONE]), _SLICE]
    seen = scan_slices(sliced, keys, order, {"__before": highest(measure)}, inclusive=False)
    records = seen.where(F.col("__before").isNull() | (F.col(measure) > F.col("__before"))).drop("__before")
    in_slice = F.row_number().over(Window.partitionBy(*ids).orderBy(*order)) == 1
    in_key = F.row_number().over(Window.partitionBy(*ids[:-1]).orderBy(_SLICE)) == 1
    fields, columns = list(sliced.select(*ids).schema), slim.columns

    def whole_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def told(held, parts):
            values = np.concatenate(parts)
            upto, ends = _exits(values, threshold)
            return held.assign(lowest=values[0], highest=values[-1], upto=[upto], ends=[ends])

        held, parts = None, []
        for batch in batches:
            values, starts = batch[measure].to_numpy(float), batch["__starts"].to_numpy(bool)
            for low, high in _pieces(starts):
                if starts[low]:
                    if held is not None:
                        yield told(held, parts)
                    held, parts = batch[ids].iloc[[low]], []
                parts.append(values[low:high])
        if held is not None:
            yield told(held, parts)

    def through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = None
        for batch in batches:
            enters = []
            for starts, lowest, top, upto, ends in zip(*(batch[c] for c in ("__starts", "lowest", "highest", "upto", "ends"))):
                enters.append(None if starts else base)
                base = lowest if starts else base
                if base + threshold < top:
                    base = ends[np.searchsorted(upto, base + threshold, "right")]
            yield batch[ids].assign(__enters=pd.array(enters, "Float64"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = 0.0
        for batch in batches:
            values, starts = batch[measure].to_numpy(float), batch["__starts"].to_numpy(bool)
            enters = batch["__enters"].to_numpy(float, na_value=np.nan)
            fired = []
            for low, high in _pieces(starts):
                if starts[low]:
                    base = values[low] if np.isnan(enters[low]) else enters[low]
                at = low + np.searchsorted(values[low:high], base + threshold, "right")
                while at < high:
                    fired.append(at)
                    base = values[at]
                    at = low + np.searchsorted(values[low:high], base + threshold, "right")
            yield batch.iloc[fired][columns]

    told = StructType(fields + [
        StructField("lowest", DoubleType()), StructField("highest", DoubleType()),
        StructField("upto", ArrayType(DoubleType())), StructField("ends", ArrayType(DoubleType())),
    ])
    hot = records.where(F.col(_SPLITS)).select(*ids, *order, measure).withColumn("__starts", in_slice)
    slices = hot.select(*ids, measure, "__starts").mapInPandas(whole_slices, told)
    entering = slices.withColumn("__starts", in_key).mapInPandas(
        through, StructType([*fields, StructField("__enters", DoubleType())])
    )
    renamed = {c: f"__d{i}" for i, c in enumerate(ids)}
    entering = entering.withColumnsRenamed(renamed)
    entered = records.join(F.broadcast(entering), _same(records, entering, renamed.items()), "left")
    marked = entered.withColumn("__starts", in_slice).select(*columns, "__starts", "__enters")
    return marked.mapInPandas(run, slim.schema)


def delta_trigger_window(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], measure: str, threshold: float, keep: str, best: str, tie: Sequence[Column], **slicing) -> DataFrame:
    """On each firing of ``delta_fires``: the row of the last ``keep`` with the highest ``best``.

    ``tie`` lists columns that decide among equals (higher wins). ``df`` is read several
    times: pass a table, or a result that has been written once. The firings are.
    """
    keys, order = list(keys), list(order)
    fires = cut_lineage(delta_fires(df, keys, order, measure, threshold, **slicing), "fires")
    fired = fires.select(*[F.col(c).alias(f"__f_{c}") for c in [*keys, *order]], F.lit(True).alias("__fired"))
    same = F.lit(True)
    for c in [*keys, *order]:
        same = same & df[c].eqNullSafe(fired[f"__f_{c}"])
    marked = df.join(fired, same, "left").drop(*[f"__f_{c}" for c in [*keys, *order]])
    rank = F.struct(F.col(best).alias("best"), *[c.alias(f"tie{i}") for i, c in enumerate(tie)], F.struct(*order).alias("row"))
    found = best_of_last(
        marked, keys, ts, order, keep, rank, F.coalesce("__fired", F.lit(False)), "__best", **slicing
    )
    return found.select(
        *keys, *order, measure, F.col("__best.best").alias(f"top_{best}"), F.col("__best.row").alias("top_row")
    )
