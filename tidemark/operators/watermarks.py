"""Event time, watermarks and late rows.

Spark moves its watermark once per micro-batch and drops late rows without a trace. The
table forms below use the row-by-row rule instead: the watermark a row meets is the
highest event time of the rows that arrived before it, minus the allowed delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import interval, last_millisecond, micros
from tidemark.operators.history import highest, prefix_scan


def watermark(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    return df.withWatermark(ts, delay)


def allowed_lateness(df: DataFrame, ts: str, bound: str, lateness: str) -> DataFrame:
    """Keep windows open for ``lateness`` more; in update mode late rows revise the result."""
    total = (micros(bound) + micros(lateness)) / 1_000_000
    return df.withWatermark(ts, f"{total:.6f} seconds")


def drop_older_than(df: DataFrame, ts: str, lag: str, now: Column | None = None) -> DataFrame:
    """Rows not older than the wall clock minus ``lag``."""
    return df.where(F.col(ts) >= (F.current_timestamp() if now is None else now) - interval(lag))


def assign_event_time(df: DataFrame, millis: str, name: str = "ts") -> DataFrame:
    """Event time from a column of epoch milliseconds."""
    return df.withColumn(name, F.timestamp_millis(F.col(millis)))


def ingestion_time(df: DataFrame, name: str = "ingested_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def punctuated_watermark(df: DataFrame, keys: Sequence[str], arrival: Sequence[str], marker: Column, ts: str, name: str = "watermark", **slicing) -> DataFrame:
    """The watermark after each row, moved by marker rows only; null before the first."""
    marked = F.when(marker, F.col(ts))
    return prefix_scan(df, keys, arrival, {name: highest(marked)}, **slicing)


def mark_late(df: DataFrame, ts: str, delay: str, size: str, arrival: Sequence[str], keys: Sequence[str] = (), **slicing) -> DataFrame:
    """Add ``window_start``, ``window_end`` and ``is_late``.

    A row is late if the last millisecond of its window is not after the watermark made
    by the rows that arrived before it.
    """
    seen = prefix_scan(df, keys, arrival, {"__newest": highest(ts)}, inclusive=False, **slicing)
    w = F.window(ts, size)
    placed = seen.withColumn("__w", w)
    late = last_millisecond(F.col("__w.end")) <= F.col("__newest") - interval(delay)
    return placed.withColumns(
        {
            "window_start": F.col("__w.start"),
            "window_end": F.col("__w.end"),
            "is_late": F.coalesce(late, F.lit(False)),
        }
    ).drop("__w", "__newest")


def split_late(df: DataFrame, ts: str, delay: str, size: str, arrival: Sequence[str], keys: Sequence[str] = (), **slicing) -> tuple[DataFrame, DataFrame]:
    """``(rows in time, late rows)``."""
    marked = mark_late(df, ts, delay, size, arrival, keys, **slicing)
    return marked.where(~F.col("is_late")).drop("is_late"), marked.where("is_late").drop("is_late")
