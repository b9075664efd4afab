"""Reports by name: how Spark computes them and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.runtime import fresh_dir, use_utc
from tidemark.sources.readers import load, load_stream, load_stream_in_order, sorted_slices, stored_bytes
from tidemark.streaming.runs import closing_row

#: Stored bytes of a micro-batch, which bound what one task holds of a key, and of a file of a sorted slice.
BATCH_BYTES, SLICE_FILE_BYTES = 1 << 28, 1 << 25
#: The columns that tell the order of events of a table. Its files need not follow it.
EVENT_ORDER = {"events": ("ts", "event_id")}


@dataclass(frozen=True)
class Tables:
    """The input tables of one data folder."""

    spark: SparkSession
    folder: str
    slices: dict[str, str] = field(default_factory=dict, compare=False)

    def __call__(self, name: str) -> DataFrame:
        return load(self.spark, self.folder, name)

    def stream(self, name: str, order: tuple[str | Column, ...] | None = None, closing: str | None = None) -> DataFrame:
        """The table as a stream; one of several micro-batches comes in the order of its events, or in the order given.

        With ``closing``, an event time, a last row follows that ends all windows; see ``runs.closed``.
        """
        table, order = self(name), order or EVENT_ORDER.get(name)
        slices = -(-stored_bytes(table) // BATCH_BYTES)
        last = closing_row(table, closing) if closing else None
        if slices <= 1 or not order:
            rows = load_stream(self.spark, self.folder, name, bytes_per_trigger=BATCH_BYTES if slices > 1 else None)
            if last is None:
                return rows
            if slices > 1:
                raise ValueError(f"{name} comes in several batches without an order, so no row is the last one")
            return rows.unionByName(self._written(last, f"{name} {closing}"))
        files = max(1, BATCH_BYTES // SLICE_FILE_BYTES)
        key = f"{name} {order} {closing}"
        if key not in self.slices:
            self.slices[key] = sorted_slices(table, order, slices, files, last)
        return load_stream_in_order(table, self.slices[key], files)

    def _written(self, rows: DataFrame, key: str) -> DataFrame:
        """A few rows as a stream of their own."""
        if key not in self.slices:
            self.slices[key] = fresh_dir(self.spark, "closing")
            rows.write.parquet(self.slices[key])
        return self.spark.readStream.schema(rows.schema).parquet(self.slices[key])


REPORTS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def report(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(use_utc(spark), folder))

        REPORTS[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
