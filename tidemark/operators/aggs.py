"""Grouped, distinct and windowed aggregates.

All of them combine rows inside the map tasks before anything is shuffled, so a group
that holds a large share of the rows sends one partial row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import day_label, last_millisecond, micros, ten_minute_label
from tidemark.operators.history import prefix_scan, running


def running_sum(df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[str], name: str = "total", **slicing) -> DataFrame:
    """The total so far, for every row. A stream gives the newest total per key and batch."""
    if df.isStreaming:
        return df.groupBy(*keys).agg(F.sum(value).alias(name))
    return prefix_scan(df, keys, order, {name: running(value)}, **slicing)


def group_sum(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def count_rows(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_distinct(df: DataFrame, keys: Sequence[str], column: str, name: str = "uv") -> DataFrame:
    """Exact distinct count: duplicates are dropped first, then values are counted.

    Streams need the two stages apart, see ``tidemark.streaming.aggregates``.
    """
    return df.groupBy(*keys).agg(F.countDistinct(column).alias(name))


def global_window_agg(df: DataFrame, ts: str, size: str, aggregates: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    out = df.groupBy(F.window(ts, size), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *aggregates)


reduce_window = global_window_agg


def pv_uv(df: DataFrame, ts: str, user: str, size: str, slide: str | None = None) -> DataFrame:
    """Rows and exact distinct users per tumbling or sliding window.

    A sliding window is built from panes one slide wide. A pane is reduced to one row per
    user before it is copied to the windows over it, so the copies are of the reduced rows.
    """
    slide = slide or size
    if micros(size) == micros(slide) or micros(size) % micros(slide):
        grouped = df.groupBy(F.window(ts, size, slide), user).agg(F.count(F.lit(1)).alias("n"))
        windows = grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), user, "n")
    else:
        panes = df.groupBy(F.window(ts, slide).alias("pane"), user).agg(F.count(F.lit(1)).alias("n"))
        steps = micros(size) // micros(slide)
        back = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
        step = F.expr(f"INTERVAL '{micros(slide) / 1_000_000:.6f}' SECOND")
        windows = (
            panes.withColumn("back", back)
            .withColumn("window_start", F.col("pane.start") - step * F.col("back"))
            .select("window_start", (F.col("window_start") + step * F.lit(steps)).alias("window_end"), user, "n")
        )
        return windows.groupBy("window_start", "window_end").agg(F.sum("n").alias("pv"), F.countDistinct(user).alias("uv"))
    # A user has one row in a window here, so no second exchange by user is needed.
    return windows.groupBy("window_start", "window_end").agg(F.sum("n").alias("pv"), F.count(user).alias("uv"))


def cumulative_uv(df: DataFrame, ts: str, user: str) -> DataFrame:
    """Distinct users of the day so far, at each ten-minute label that has rows.

    A user is reduced to the set of labels they were seen at (144 at most); the first one
    counts them. What is left to sum up per day is one row per label.
    """
    labelled = df.select(day_label(F.col(ts)).alias("date_str"), ten_minute_label(F.col(ts)).alias("time_str"), user)
    seen = labelled.groupBy("date_str", user).agg(F.collect_set("time_str").alias("labels"))
    first = seen.select("date_str", F.array_min("labels").alias("first"), F.explode("labels").alias("time_str"))
    fresh = first.groupBy("date_str", "time_str").agg(
        F.sum((F.col("time_str") == F.col("first")).cast("long")).alias("fresh")
    )
    day = Window.partitionBy("date_str").orderBy("time_str").rowsBetween(Window.unboundedPreceding, 0)
    return fresh.select("date_str", "time_str", F.sum("fresh").over(day).alias("uv"))


def hourly_count(df: DataFrame, ts: str, predicate: Column, name: str) -> DataFrame:
    windows = df.where(predicate).groupBy(F.window(ts, "1 hour")).agg(F.count(F.lit(1)).alias(name))
    return windows.select(
        F.col("window.start").alias("window_start"), F.hour("window.start").alias("hour_of_day"), name
    )


def top_n(df: DataFrame, key: str, metric: Column, name: str, n: int) -> DataFrame:
    """The ``n`` keys with the highest metric; ties go to the smaller key."""
    return df.groupBy(key).agg(metric.alias(name)).orderBy(F.col(name).desc(), key).limit(n)


def max_by_row(df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """The whole row with the highest value per group; the earliest one on ties.

    Spark applies the limit of one row per group before the shuffle as well.
    """
    best = Window.partitionBy(*keys).orderBy(F.col(column).desc(), *order)
    return df.withColumn("__rank", F.row_number().over(best)).where(F.col("__rank") <= 1).drop("__rank")


def apply_window(df: DataFrame, keys: Sequence[str], ts: str, size: str, function: Callable, schema: str, columns: Sequence[str] = (), batched: bool = False) -> DataFrame:
    """A caller's function over the rows of each key and window, in the order of their times.

    It gets the key values, the bounds of the window, and the window's ``ts`` and ``columns`` as a pandas table, and returns a
    table of ``schema``. A table for each window costs milliseconds. With ``batched`` the function gets a slice of an Arrow
    batch instead, and returns a list of tuples; Spark then sorts the windows and hands over many of them at a time. As a
    function may look at all rows, those of one key and window are in one task's memory at a time; what aggregates can say is
    better said with ``window_summary`` or ``global_window_agg``.
    """
    placed = df.select(*keys, ts, *columns, F.window(ts, size).alias("window")).select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), ts, *columns
    )
    ids = [*keys, "window_start", "window_end"]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return function(key, rows[[ts, *columns]].sort_values(ts, kind="stable", ignore_index=True))

    if not batched:
        return placed.groupBy(*ids).applyInPandas(run, schema)
    kinds = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def told(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], schema=kinds)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            begins = np.flatnonzero(batch.column(len(ids)).to_numpy(zero_copy_only=False))
            found = list(zip(*(batch.column(k).take(pa.array(begins)).to_pylist() for k in range(len(ids)))))
            rows, out = batch.select(list(range(len(ids) + 1, batch.num_columns))), []
            bounds = [0, *begins.tolist(), len(rows)]
            # What comes before the first begin belongs to the window that is still open.
            parts.append(rows.slice(0, bounds[1]))
            for key, low, high in zip(found, bounds[1:], bounds[2:]):
                if held is not None:
                    out += function(held, parts[0] if len(parts) == 1 else pa.concat_batches(parts))
                held, parts = key, [rows.slice(low, high - low)]
            yield told(out)
        if held is not None:
            yield told(function(held, pa.concat_batches(parts)))

    starts = F.row_number().over(Window.partitionBy(*ids).orderBy(ts)) == 1
    return placed.select(*ids, starts.alias("__starts"), ts, *columns).mapInArrow(run_batches, schema)


def window_summary(df: DataFrame, keys: Sequence[str], ts: str, size: str) -> DataFrame:
    """Per key and window: number of rows, earliest and latest time, window bounds."""
    out = df.groupBy(*keys, F.window(ts, size)).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    return out.select(
        *keys, "cnt", "first_ts", "last_ts",
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
    )


def int_avg(total: str, count: str) -> Column:
    """Average of integers by integer division."""
    return F.expr(f"{total} div {count}")


def carry_first(df: DataFrame, keys: Sequence[str], value: str, others: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Sum one column and keep the other columns of the group's first row."""
    out = df.groupBy(*keys).agg(
        F.min_by(F.struct(*others), F.struct(*order)).alias("first"), F.sum(value).alias(value)
    )
    return out.select(*keys, *[F.col(f"first.{c}").alias(c) for c in others], value)


def sum_rounded_desc(df: DataFrame, key: str, value: Column, name: str, digits: int = 2) -> DataFrame:
    return df.groupBy(key).agg(F.round(F.sum(value), digits).alias(name)).orderBy(F.col(name).desc(), key)


def accumulate_average(df: DataFrame, observation, column: str, name: str = "average") -> DataFrame:
    """The same rows; their average can be read from ``observation`` after the action."""
    return df.observe(observation, F.avg(column).alias(name), F.count(F.lit(1)).alias("rows"))


def window_sum_of_sums(df: DataFrame, ts: str, value: Column, small: str, large: str, name: str) -> DataFrame:
    """A window over the results of smaller windows, by their row time (end - 1 ms)."""
    inner = df.groupBy(F.window(ts, small).alias("w")).agg(F.sum(value).alias("part"))
    outer = inner.groupBy(F.window(last_millisecond(F.col("w.end")), large).alias("w")).agg(
        F.sum("part").alias(name), F.count(F.lit(1)).alias("parts")
    )
    return outer.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name, "parts")
