"""Session-level helpers: shared folders, time zone, job reliability options."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """All event times in this library are UTC wall-clock times."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only when the session names none and the master is local (tests, a laptop) a local one is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        current = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(current)
        current = spark.sparkContext.getCheckpointDir()
    return current


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a result that is used several times once, as a table in the shared folder.

    Later steps read only the columns they need of it, and a lost executor does not bring
    the work before it back. This runs a job when it is called.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_options(writer, checkpoint_dir: str, interval: str | None = None, name: str | None = None):
    """Checkpoint folder, trigger interval and a stable query name for a stream writer.

    Without an interval the query drains what is available and stops.
    """
    writer = writer.option("checkpointLocation", checkpoint_dir)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def state_store(spark: SparkSession, backend: str = "rocksdb", incremental: bool = True) -> SparkSession:
    """Choose where keyed state lives: executor heap backed by files, or RocksDB."""
    package = "org.apache.spark.sql.execution.streaming.state"
    providers = {
        "file": f"{package}.HDFSBackedStateStoreProvider",
        "rocksdb": f"{package}.RocksDBStateStoreProvider",
    }
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", providers[backend])
    if backend == "rocksdb":
        key = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
        spark.conf.set(key, str(incremental).lower())
    return spark


def run_with_restart(start, attempts: int = 3, delay_seconds: float = 10.0):
    """Run a stream to its end, restarting it from its checkpoint after a failure.

    ``start`` starts the query and returns it. The last failure is raised again.
    """
    for attempt in range(attempts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if attempt == attempts:
                raise
            time.sleep(delay_seconds)
