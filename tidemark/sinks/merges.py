"""A table kept from change events on a stream: batches of changes, deletes as tombstones, and compacted versions behind a pointer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import latest_per_key
from tidemark.sinks.batches import BatchSink, _missing, _write_batch, claimed

GONE = "__gone"
POINTER = "version long, through long"


def merge_changes_sink(path: str, keys: Sequence[str], order: Sequence[str], deleted: Column) -> BatchSink:
    """Write the latest change per key of each batch; a delete is written too, as a tombstone.

    ``order`` tells the latest change of a key, within a batch and over all batches, so changes that come late change nothing.
    """
    bind = claimed(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        bind(batch.sparkSession)
        _write_batch(latest_per_key(batch.withColumn(GONE, F.coalesce(deleted, F.lit(False))), keys, order), f"{path}/batches", batch_id)

    return write


def _pointer(spark: SparkSession, path: str) -> tuple[int, int]:
    """The newest complete version, and the last batch in it; (-1, -1) before the first."""
    try:
        newest = spark.read.schema(POINTER).parquet(f"{path}/pointer/*").agg(F.max(F.struct("version", "through")).alias("p")).first()["p"]
    except AnalysisException as error:
        if not _missing(error):
            raise
        newest = None
    return (-1, -1) if newest is None else (newest["version"], newest["through"])


def _changes(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, int, int]:
    """The latest change of every key, tombstones too, with the version they are read from and the newest batch in them."""
    version, through = _pointer(spark, path)
    later = spark.read.option("basePath", f"{path}/batches").parquet(f"{path}/batches").where(F.col("batch_id") > through)
    upto = later.agg(F.max("batch_id").alias("newest")).first()["newest"]
    upto = through if upto is None else int(upto)
    rows = later.where(F.col("batch_id") <= upto).drop("batch_id")
    if version >= 0:
        rows = spark.read.schema(rows.schema).parquet(f"{path}/versions/version={version}").unionByName(rows)
    return latest_per_key(rows, keys, order), version, upto


def read_merged(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table as it stands: the latest change per key of the newest version and the batches behind it, without deleted rows."""
    return _changes(spark, path, keys, order)[0].where(~F.col(GONE)).drop(GONE)


def compact_merged(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], forget: Column | None = None) -> int:
    """Write the current changes as a new version and point to it; returns its number.

    Readers go by the pointer, which is written when the version is complete: they see the old state or the new one, and
    batches written meanwhile are behind it. Tombstones stay, as an older change may still come, but for those that
    ``forget`` says can go. Folders of older versions and batches are not read any more; the store's lifetime rule clears them.
    """
    changes, version, through = _changes(spark, path, keys, order)
    kept = changes if forget is None else changes.where(~(F.col(GONE) & F.coalesce(forget, F.lit(False))))
    kept.write.mode("overwrite").parquet(f"{path}/versions/version={version + 1}")
    record = spark.createDataFrame([(version + 1, through)], POINTER)
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/pointer/{version + 1:09d}")
    return version + 1
