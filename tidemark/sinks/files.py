"""Writing tables and streams to the console, files, tables and Kafka."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import stream_options


def write_console(df: DataFrame, rows: int = 20):
    """Print a table; for a stream, return a writer that prints each batch."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", rows)
    return df.show(rows, truncate=False)


def write_text(df: DataFrame, path: str, checkpoint_dir: str | None = None):
    if df.isStreaming:
        return stream_options(df.writeStream.format("text").option("path", path), checkpoint_dir).start()
    return df.write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, sep: str = "|", files: int | None = None) -> None:
    """Overwrite a folder of delimited files.

    ``files`` fixes their number. Leave it out for large results: each task then writes
    its own file. One file means one writing task.
    """
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").option("sep", sep).csv(path)


def write_csv_single(df: DataFrame, path: str, sep: str = "|") -> None:
    """One delimited file, for results known to be small."""
    write_csv(df, path, sep, files=1)


def write_bucketed(df: DataFrame, path: str, bucket: Column, checkpoint_dir: str | None = None, fmt: str = "json"):
    """One folder per bucket value. Tasks write their own files, so a hot bucket has many."""
    tagged = df.withColumn("bucket", bucket)
    if df.isStreaming:
        writer = tagged.writeStream.format(fmt).partitionBy("bucket").option("path", path)
        return stream_options(writer, checkpoint_dir).start()
    return tagged.write.mode("overwrite").format(fmt).partitionBy("bucket").save(path)


def insert_into(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Insert by column name; table columns not listed become null."""
    target = df.sparkSession.table(table).schema
    given = dict(zip(columns, df.columns))
    df.select(
        *[(F.col(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    ).write.insertInto(table)


def append_sink(df: DataFrame, path: str, checkpoint_dir: str | None = None):
    """Append rows under generated ids."""
    tagged = df.withColumn("document_id", F.uuid())
    if df.isStreaming:
        writer = tagged.writeStream.format("parquet").option("path", path).outputMode("append")
        return stream_options(writer, checkpoint_dir).start()
    return tagged.write.mode("append").parquet(path)


def kafka_rows(df: DataFrame, value: Column, key: Column | None = None) -> DataFrame:
    """The columns the Kafka sink takes."""
    columns = [value.alias("value")] if key is None else [key.cast("string").alias("key"), value.alias("value")]
    return df.select(*columns)


def write_kafka(df: DataFrame, options: Mapping[str, str], value: Column, key: Column | None = None):
    rows = kafka_rows(df, value, key)
    return (rows.writeStream if df.isStreaming else rows.write).format("kafka").options(**dict(options))


def discard_sink(df: DataFrame):
    """Run everything and keep nothing."""
    if df.isStreaming:
        return df.writeStream.format("noop")
    return df.write.format("noop").mode("overwrite").save()


def sampled_rows(df: DataFrame, key: str, every: int) -> DataFrame:
    """About each ``every``-th result, chosen by a number that does not depend on the task."""
    return df.where(F.pmod(F.col(key), F.lit(every)) == 0)


def sampled_observe(df: DataFrame, observation, key: str, every: int) -> DataFrame:
    """The same rows; how many there were, and how many a log of each ``every``-th would show."""
    hit = F.pmod(F.col(key), F.lit(every)) == 0
    return df.observe(
        observation, F.count(F.lit(1)).alias("rows"), F.count(F.when(hit, F.lit(1))).alias("logged")
    )
