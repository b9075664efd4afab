"""Running streams to their end, and stream forms that need ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.watermarks import mark_late
from tidemark.runtime import fresh_dir, stream_options
from tidemark.sinks.batches import BatchSink, _write_batch, claim, read_upserted, several, upsert_sink


def drain(df: DataFrame, sink: BatchSink, mode: str = "append", checkpoint: str | None = None) -> None:
    """Feed everything available to a batch sink and stop."""
    checkpoint = checkpoint or fresh_dir(df.sparkSession, "checkpoint")
    stream_options(df.writeStream.foreachBatch(sink).outputMode(mode), checkpoint).start().awaitTermination()


def append_to_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """Run an append-mode stream into files and read them."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, "stream")
    writer = df.writeStream.format("parquet").option("path", path).outputMode("append")
    stream_options(writer, fresh_dir(spark, "checkpoint")).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def upsert_to_table(df: DataFrame, keys: Sequence[str], path: str | None = None) -> DataFrame:
    """Run an update-mode stream, grouped by ``keys``, into an upsert table and read its current rows."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, "upserts")
    drain(df, upsert_sink(path, keys, unique=True), "update")
    return read_upserted(spark, path, keys, df.schema)


def complete_to_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """Run a complete-mode stream (sorted, limited) and read its full result, which each batch replaces."""
    spark = df.sparkSession
    path = path or fresh_dir(spark, "complete")
    spark.createDataFrame([], df.schema).write.parquet(path)
    drain(df, lambda batch, _: batch.write.mode("overwrite").parquet(path), "complete")
    return spark.read.schema(df.schema).parquet(path)


def late_rows_sink(path: str, ts: str, delay: str, size: str, arrival: Sequence[str]) -> BatchSink:
    """Split each batch into rows in time and late rows.

    The highest event time of the batches before is kept beside the results, so the rule
    is that of the table form (``watermarks.mark_late``), batch boundaries or not.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        claim(spark, path)
        first = batch.select(F.max(ts).alias("newest"))
        _write_batch(first, f"{path}/marks", batch_id)
        marks = spark.read.option("basePath", f"{path}/marks").parquet(f"{path}/marks")
        before = marks.where(F.col("batch_id") < batch_id).select(F.max("newest").alias("newest"))
        marked = mark_late(batch, ts, delay, size, arrival)
        limit = before.scalar() - F.expr(f"INTERVAL {delay}")
        late = F.col("is_late") | F.coalesce(F.expr("window_end - INTERVAL 1 millisecond") <= limit, F.lit(False))
        _write_batch(marked.withColumn("is_late", late), f"{path}/rows", batch_id)

    return several(write)


def read_late_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(rows in time, late rows)`` of ``late_rows_sink``."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("batch_id")
    return rows.where(~F.col("is_late")).drop("is_late"), rows.where("is_late").drop("is_late")


def distinct_per_window(df: DataFrame, ts: str, user: str, size: str, delay: str) -> DataFrame:
    """The first row of each user in each window, on a stream.

    Streams have no exact distinct count. Dropping repeats is the first stage; counting
    the rows that are left, per window, the second (``count_first_rows``).
    """
    placed = df.withWatermark(ts, delay).withColumn("window", F.window(ts, size))
    # The window itself carries the watermark, so users of closed windows leave the state.
    first = placed.select(user, "window").dropDuplicates([user, "window"])
    return first.select(user, F.col("window.end").alias("window_end"))


def count_first_rows(first: DataFrame, name: str = "uv") -> DataFrame:
    return first.groupBy("window_end").agg(F.count(F.lit(1)).alias(name))


def lookup_per_batch(dimension: Callable[[], DataFrame], join: Callable[[DataFrame, DataFrame], DataFrame], sink: BatchSink) -> BatchSink:
    """Join each batch with the dimension as it is when the batch runs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(join(batch, dimension()), batch_id)

    return write


#: The event time of a row that ends all windows; no row of a table is that late.
CLOSING = "9000-01-01 00:00:00"


def closing_row(table: DataFrame, ts: str) -> DataFrame:
    """One row of nulls at ``CLOSING``, with the columns of a table."""
    kinds = {f.name: f.dataType for f in table.schema.fields}
    values = [F.lit(CLOSING if n == ts else None).cast(k).alias(n) for n, k in kinds.items()]
    return table.sparkSession.range(1).select(*values)


def closed(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Event time and watermark of a stream whose last row is a closing one.

    That row only moves the watermark, behind every window, and goes no further. What is asked of other columns later must
    not be asked before the watermark, where the closing row would go missing: a condition on a random number keeps the
    optimizer from moving it there. Conditions of the table itself belong in front of the closing row.
    """
    marked = df.withWatermark(ts, delay).withColumn("__kept", F.rand() + 1 > 0)
    return marked.where((F.col(ts) < F.lit(CLOSING).cast("timestamp")) & F.col("__kept")).drop("__kept")


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """A zone-less time column as the timestamp type that watermarks need."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def zone_less(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
