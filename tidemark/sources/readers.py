"""Reading text, rows, files, tables and dimension data, as tables or streams."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.text import unescape_tsv
from tidemark.runtime import fresh_dir


def read_text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return spark.readStream.text(path) if streaming else spark.read.text(path)


def from_rows(spark: SparkSession, rows: Sequence, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def small_rows(spark: SparkSession, rows: Sequence[Sequence[str | int | float | bool | None]], schema: str) -> DataFrame:
    """A short list of plain values as part of the plan, so that Spark knows its size and broadcasts it by its threshold."""
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    literal = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(literal)) if rows else spark.createDataFrame([], schema)


def named_rows(spark: SparkSession, rows: Sequence, schema: str | StructType, view: str) -> DataFrame:
    """Rows with declared names and types, also registered as a view."""
    return register_view(view, from_rows(spark, rows, schema))


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def read_csv_typed(spark: SparkSession, path: str, schema: str | StructType, ids: Sequence[str] = (), streaming: bool = False) -> DataFrame:
    """Header-less CSV of a given schema; rows whose ``ids`` are missing or not positive are dropped."""
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    df = reader.csv(path)
    for column in ids:
        df = df.where(F.col(column) > 0)
    return df


def read_tsv_with_names(spark: SparkSession, path: str, columns: Mapping[str, str], select: Mapping[str, Column] | None = None, escaped: bool = False) -> DataFrame:
    """Tab-separated text with a header line; ``select`` transforms on load.

    Array columns are written as ``[1,2]``; text was written through ``functions.text.escape_tsv`` if ``escaped``.
    """
    arrays = {c for c, t in columns.items() if t.lower().startswith("array")}
    raw = ", ".join(f"`{c}` {'string' if c in arrays else t}" for c, t in columns.items())
    df = spark.read.csv(path, schema=raw, sep="\t", header=True, quote="\u0000")
    df = df.withColumns({c: F.from_json(c, columns[c]) for c in arrays}) if arrays else df
    texts = [c for c, t in columns.items() if escaped and t.lower() == "string"]
    df = df.withColumns({c: unescape_tsv(F.col(c)) for c in texts}) if texts else df
    return df.select(*[c.alias(n) for n, c in select.items()]) if select else df


def read_jdbc_dim(spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A dimension table in a database. Pass ``partitionColumn`` and bounds for a large one."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**dict(options or {})).load()


class CachedDimension:
    """A dimension kept in executor storage and loaded again once it is older than its TTL.

    Call ``current()`` inside ``foreachBatch``: a batch sees one version, later batches a
    newer one, and results already written are not revised.
    """

    def __init__(self, load: Callable[[], DataFrame], ttl_seconds: float = 600.0, clock: Callable[[], float] = time.monotonic):
        self._load, self._ttl, self._clock = load, ttl_seconds, clock
        self._df: DataFrame | None = None
        self._loaded = 0.0

    def current(self) -> DataFrame:
        if self._df is None or self._clock() - self._loaded >= self._ttl:
            if self._df is not None:
                self._df.unpersist()
            self._df, self._loaded = self._load().persist(), self._clock()
        return self._df


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def define_stream_table(df: DataFrame, computed: Mapping[str, Column], ts: str | None = None, delay: str = "5 seconds") -> DataFrame:
    """Computed columns, a ``proctime`` column and a watermark, as a table definition has them."""
    df = df.withColumns({**computed, "proctime": F.current_timestamp()})
    return df.withWatermark(ts, delay) if ts else df


def register_view(name: str, df: DataFrame) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def keyed_sequence(spark: SparkSession, n_keys: int, n_rows: int) -> DataFrame:
    """Keys 1 to ``n_keys`` in turn, each with value 1."""
    return spark.range(n_rows).select((F.col("id") % n_keys + 1).alias("key"), F.lit(1).cast("long").alias("value"))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load_path(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows that were written to a folder, with the types they had."""
    return spark.read.schema(schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files of a table, as Spark's own file index adds them up."""
    return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())


def load_stream(spark: SparkSession, sf_dir: str, table: str, schema: StructType | None = None, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream of its files, be it one file or a folder of them.

    ``files_per_trigger`` or ``bytes_per_trigger`` bounds a micro-batch; files are taken in the order of their modification
    times. A table that is not there is an error at once, not an empty stream.
    """
    found = load(spark, sf_dir, table).schema
    reader = spark.readStream.schema(schema or found)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    # A pattern that only the table itself matches; a plain path would have to be a folder.
    return reader.parquet(f"{sf_dir}/{table}.parque[t]")


def sorted_slices(df: DataFrame, order: Sequence[str | Column], slices: int, files: int, last: DataFrame | None = None) -> str:
    """Write df to the shared folder in slices of rows that follow each other in order, each of the same number of files.

    Rows are dealt out by sampled bounds in one job. Slices are then copied one after the other, each by a job over all of
    its files, so that their modification times rise in any store; folder names rise too, for stores with coarse times. So
    there are as many jobs as micro-batches, however many files df has. ``last`` is put behind all slices.
    """
    spark = df.sparkSession
    dealt, path = fresh_dir(spark, "dealt"), fresh_dir(spark, "slices")
    number = F.floor(F.spark_partition_id() / F.lit(files)).cast("int")
    df.repartitionByRange(slices * files, *order).withColumn("slice_number", number).write.partitionBy("slice_number").parquet(dealt)
    parts = spark.read.schema(StructType([*df.schema.fields, StructField("slice_number", IntegerType())])).parquet(dealt)
    for k in range(slices):
        # Dealing round gives every file some rows, so a trigger's files are those of one slice.
        parts.where(F.col("slice_number") == k).drop("slice_number").repartition(files).write.parquet(f"{path}/{k:06d}")
    if last is not None:
        last.repartition(files).write.parquet(f"{path}/{slices:06d}")
    return path


def load_stream_in_order(df: DataFrame, path: str, files_per_trigger: int) -> DataFrame:
    """The slices of df below path as a stream."""
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}/*")
