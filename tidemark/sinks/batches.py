"""Sinks for ``foreachBatch``: each factory returns a function of ``(batch, batch_id)``.

Tables are written as one folder per batch, ``batch_id=N``. Writing a batch again after a
failure replaces its folder, so a batch counts once however often it is tried. Readers
merge the folders; nothing already written is rewritten per batch.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.changes import latest_per_key

BatchSink = Callable[[DataFrame, int], None]


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


class ForeignTarget(Exception):
    """A target that another stream writes: its batch numbers would be taken for this stream's."""


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def claim(spark: SparkSession, path: str) -> None:
    """Bind a target to the stream that writes it, or raise if it belongs to another one.

    A stream keeps its id with its checkpoint, over restarts too; with a new checkpoint it is another stream whose batches
    are numbered from 0 again. Batches written by hand count as one stream without an id.
    """
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
    try:
        owner = spark.read.schema("stream string").parquet(f"{path}/_stream").first()
    except AnalysisException as error:
        if not _missing(error):
            raise
        owner = None
    if owner is None:
        spark.createDataFrame([(stream,)], "stream string").coalesce(1).write.mode("overwrite").parquet(f"{path}/_stream")
    elif owner[0] != stream:
        raise ForeignTarget(f"{path} belongs to stream {owner[0] or 'without id'}, not to {stream or 'one without id'}")


def claimed(path: str) -> Callable[[SparkSession], None]:
    """``claim`` for a sink: a stream is looked up at its first batch only."""
    known: set[str] = set()

    def once(spark: SparkSession) -> None:
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if stream not in known:
            claim(spark, path)
            known.add(stream)

    return once


def upsert_sink(path: str, keys: Sequence[str], order: Sequence[str] = (), unique: bool = False) -> BatchSink:
    """Write each batch with one row per key; ``order`` decides which one.

    Without an order the batch must have one row per key already; one with more is refused. ``unique`` leaves out that check,
    for results that are grouped by these keys.
    """
    bind = claimed(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        bind(batch.sparkSession)
        if unique:
            return _write_batch(batch, path, batch_id)
        if order:
            return _write_batch(latest_per_key(batch, keys, order), path, batch_id)
        several_rows = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
        refused = F.raise_error(F.lit("several rows of one key in a batch, and no order that chooses one"))
        checked = batch.withColumn("__checked", F.when(several_rows, refused).otherwise(F.lit(0)))
        _write_batch(checked.where("__checked = 0").drop("__checked"), path, batch_id)

    return write


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """The newest row per key over all batches; with a schema, none if nothing was written yet."""
    if schema is not None:
        try:
            spark.read.schema("stream string").parquet(f"{path}/_stream")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return latest_per_key(reader.option("basePath", path).parquet(path), keys, ["batch_id"]).drop("batch_id")


def compact_upserts(spark: SparkSession, path: str, keys: Sequence[str], into: str) -> None:
    """Write the current rows as the only batch of a new folder."""
    _write_batch(read_upserted(spark, path, keys), into, 0)


COMMIT = "txn_id string, committed_batch long"


def _commits(spark: SparkSession, commits: str, txn_id: str, batch: str = "batch=*") -> DataFrame:
    try:
        return spark.read.schema(COMMIT).parquet(f"{commits}/{txn_id}/{batch}")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], COMMIT)


def exactly_once_sink(path: str, commits: str, txn_id: str) -> BatchSink:
    """Rows first, then one commit record; a batch with a commit record is skipped.

    ``read_committed`` shows only rows of committed batches. A batch looks up its own record only. Rows and records belong
    to one stream: a stream with a new checkpoint is refused, as its batches would pass for committed ones.
    """

    bind_rows, bind_commits = claimed(path), claimed(f"{commits}/{txn_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bind_rows(spark)
        bind_commits(spark)
        if not _commits(spark, commits, txn_id, f"batch={batch_id}").isEmpty():
            return
        _write_batch(batch, path, batch_id)
        record = spark.createDataFrame([(txn_id, batch_id)], COMMIT)
        record.coalesce(1).write.mode("overwrite").parquet(f"{commits}/{txn_id}/batch={batch_id}")

    return write


def read_committed(spark: SparkSession, path: str, commits: str, txn_id: str) -> DataFrame:
    done = _commits(spark, commits, txn_id).distinct()
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.join(done, rows["batch_id"] == done["committed_batch"], "left_semi").drop("batch_id")


class RetryableWriteError(Exception):
    """A write that may be tried again; any other error ends the batch."""


def _sender(open_client, send, threshold: int, close, attempts: int, delay_seconds: float, retryable: tuple, wrap):
    """Send the rows of a partition in slices; what fails is tried again, then row by row, then wrapped, then yielded."""

    def tried(client, rows: list) -> bool:
        for attempt in range(attempts):
            try:
                send(client, rows)
                return True
            except retryable:
                if attempt + 1 < attempts:
                    time.sleep(delay_seconds)
        return False

    def run(rows: Iterator) -> Iterator:
        client = open_client()
        try:
            while part := list(islice(rows, threshold)):
                if tried(client, part):
                    continue
                for row in part:
                    if not tried(client, [row]):
                        document = wrap(row)
                        if not tried(client, [document]):
                            yield document
        finally:
            if close:
                close(client)

    return run


def retry_sink(
    open_client: Callable[[], object],
    send: Callable[[object, list], None],
    key: str,
    dead_letters: str,
    threshold: int = 500,
    attempts: int = 3,
    delay_seconds: float = 1.0,
    retryable: tuple = (RetryableWriteError,),
    close: Callable[[object], None] | None = None,
) -> BatchSink:
    """Send rows to a client opened inside each task; a slice that fails is tried again there.

    If a slice keeps failing, its rows are sent one by one; rows that fail even then are sent as wrapped documents
    ``{"id": ..., "document": {"data": ...}}``, and wrapped ones that fail too go to the dead-letter folder. Rows that were
    sent are not sent in another form. Errors that are not retryable end the task. A task that is run again sends its rows
    again, as with any client that is not transactional.
    """

    def wrap(row) -> dict:
        return {"id": str(row[key]), "document": json.dumps({"data": row.asDict(recursive=True)}, default=str)}

    def write(batch: DataFrame, batch_id: int) -> None:
        run = _sender(open_client, send, threshold, close, attempts, delay_seconds, retryable, wrap)
        dead = batch.rdd.mapPartitions(lambda rows: ((d["id"], d["document"]) for d in run(rows)))
        _write_batch(batch.sparkSession.createDataFrame(dead, "id string, document string"), dead_letters, batch_id)

    return write


def per_partition_sink(open_client: Callable[[], object], send: Callable[[object, list], None], threshold: int = 500, close: Callable[[object], None] | None = None) -> BatchSink:
    """Send rows to a client opened inside each task, ``threshold`` rows at a time.

    What is left in the buffer is sent at the end of the partition.
    """

    def send_partition(rows: Iterator) -> None:
        client, buffer = open_client(), []
        try:
            for row in rows:
                buffer.append(row)
                if len(buffer) >= threshold:
                    send(client, buffer)
                    buffer = []
            if buffer:
                send(client, buffer)
        finally:
            if close:
                close(client)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.foreachPartition(send_partition)

    return write


buffered_sink = per_partition_sink


def list_push_sink(open_client: Callable[[], object], key: str, value: str, threshold: int = 500) -> BatchSink:
    """Push each value to the head of the list named by the key; the client has ``lpush``."""

    def send(client, rows: list) -> None:
        for row in rows:
            client.lpush(row[key], row[value])

    return per_partition_sink(open_client, send, threshold)


def json_callback_sink(open_callback: Callable[[], Callable[[str], None]], columns: Sequence[str] | None = None) -> BatchSink:
    """Hand every row, as JSON text, to a function made inside the task."""
    sink = per_partition_sink(open_callback, lambda call, rows: [call(row["json"]) for row in rows])

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch.select(F.to_json(F.struct(*(columns or batch.columns))).alias("json")), batch_id)

    return write


def several(*sinks: BatchSink) -> BatchSink:
    """Run several sinks on one batch, which is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write
