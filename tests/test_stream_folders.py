"""Stream reports on tables that are folders of several files, read in several micro-batches."""

import os
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from conftest import SMALL, rows
from oracle import compare, duck
from tidemark.operators.history import number_rows
from tidemark.operators.over import window_rank
from tidemark.operators.windows import evict_count
from tidemark.plans import REPORTS, SQL, registry
from tidemark.runtime import fresh_dir
from tidemark.sinks import batches
from tidemark.sources.readers import load, load_stream, stored_bytes
from tidemark.streaming import processors as ps
from tidemark.streaming import runs

FILES = 4
#: Arrival is made up from the row's number, so files in order of event_id are not in order of arrival.
BY_ARRIVAL = {"streamed_late_rows"}


@pytest.fixture(scope="module", autouse=True)
def small_batches():
    """Tables as small as these come in several micro-batches."""
    kept = registry.BATCH_BYTES
    registry.BATCH_BYTES = 1 << 13
    yield
    registry.BATCH_BYTES = kept


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Every table as a folder of files in the order of its first column, dated one after the other."""
    top = str(tmp_path_factory.mktemp("tables"))
    for name in ("events", "orders", "lineitem", "part", "customer"):
        table = load(spark, SMALL, name)
        key = table.columns[0]
        cuts = table.select(F.percentile(key, F.array(*[F.lit(k / FILES) for k in range(1, FILES)]))).first()[0]
        for k in range(FILES):
            low, high = (cuts[k - 1] if k else None), (cuts[k] if k < FILES - 1 else None)
            part = table.where((F.lit(True) if low is None else F.col(key) >= low) & (F.lit(True) if high is None else F.col(key) < high))
            part.coalesce(1).write.mode("append").parquet(f"{top}/{name}.parquet")
            for f in os.scandir(f"{top}/{name}.parquet"):
                if f.name.startswith("part-") and f.stat().st_mtime > 1e9 + 1000:
                    os.utime(f.path, (1e9 + k, 1e9 + k))
    return top


@pytest.mark.parametrize("name", sorted(n for n in REPORTS if n.startswith("streamed_") and n not in BY_ARRIVAL))
def test_stream_of_a_folder_equals_the_table(spark, folder, name):
    assert compare(REPORTS[name](spark, folder), duck(SMALL), SQL[name]) is None


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Events in files without any order, as a table that was written without a sort."""
    top = str(tmp_path_factory.mktemp("shuffled"))
    load(spark, SMALL, "events").repartition(FILES, F.xxhash64("event_id")).write.parquet(f"{top}/events.parquet")
    return top


@pytest.mark.parametrize("name", ["streamed_ascending_counts", "streamed_hourly_purchases", "streamed_sliding_pv_uv", "streamed_visitors", "streamed_alerts", "streamed_late_rows"])
def test_files_need_not_follow_the_order_of_events(spark, shuffled, name):
    assert compare(REPORTS[name](spark, shuffled), duck(SMALL), SQL[name]) is None


def test_a_folder_is_read_in_several_batches(spark, folder):
    seen = []
    runs.drain(load_stream(spark, folder, "events", files_per_trigger=1), lambda batch, batch_id: seen.append(batch.count()))
    assert len([n for n in seen if n]) == FILES and sum(seen) == load(spark, SMALL, "events").count()


def test_jobs_follow_the_bytes_and_not_the_files(spark, tmp_path, monkeypatch):
    """A table in 30 files is read as it is where it fits one micro-batch, else in as many parallel copies as there are of these."""
    load(spark, SMALL, "events").repartition(30).write.parquet(f"{tmp_path}/events.parquet")
    tables = registry.Tables(spark, str(tmp_path))
    size = stored_bytes(tables("events"))

    def jobs(batch_bytes):
        monkeypatch.setattr(registry, "BATCH_BYTES", batch_bytes)
        name = f"group-{batch_bytes}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            stream = registry.Tables(spark, str(tmp_path)).stream("events")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return stream, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    whole, few = jobs(size), jobs(-(-size // 3))
    assert whole[1] <= 3 and few[1] <= 3 + 3 * 4
    seen = []
    runs.drain(few[0], lambda batch, batch_id: seen.append((batch.count(), batch.agg(F.min("ts"), F.max("ts")).first())))
    seen = [(n, *bounds) for n, bounds in seen if n]
    assert len(seen) == 3 and sum(n for n, _, _ in seen) == tables("events").count()
    assert all(a[2] <= b[1] for a, b in zip(seen, seen[1:]))


def test_a_missing_table_is_an_error(spark, folder):
    with pytest.raises(AnalysisException):
        load_stream(spark, folder, "nothing")


def test_a_second_checkpoint_cannot_write_the_same_target(spark, folder):
    for make in (
        lambda path: batches.exactly_once_sink(path, f"{path}-commits", "job"),
        lambda path: batches.upsert_sink(path, ["o_orderkey"]),
        lambda path: runs.late_rows_sink(path, "o_orderdate", "1 hour", "10 minutes", ["o_orderkey"]),
    ):
        path, checkpoint = fresh_dir(spark, "target"), fresh_dir(spark, "checkpoint")
        stream = load_stream(spark, folder, "orders", files_per_trigger=1).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
        runs.drain(stream, make(path), checkpoint=checkpoint)
        runs.drain(stream, make(path), checkpoint=checkpoint)
        with pytest.raises(StreamingQueryException, match="belongs to stream"):
            runs.drain(stream, make(path))


def test_a_stream_restarted_after_a_failed_batch_has_all_rows_once(spark, folder):
    path, commits, checkpoint = (fresh_dir(spark, n) for n in ("rows", "commits", "checkpoint"))
    failures = []
    write = batches.exactly_once_sink(path, commits, "job")

    def sink(batch, batch_id):
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise ValueError("on purpose")
        write(batch, batch_id)

    stream = load_stream(spark, folder, "orders", files_per_trigger=1).select("o_orderkey")
    with pytest.raises(StreamingQueryException):
        runs.drain(stream, sink, checkpoint=checkpoint)
    runs.drain(stream, sink, checkpoint=checkpoint)
    got = rows(batches.read_committed(spark, path, commits, "job"))
    assert failures == [2] and got == rows(load(spark, SMALL, "orders").select("o_orderkey"))


def several(spark, data, schema):
    """A stream of one row per file, in order."""
    path = fresh_dir(spark, "rows")
    for k, row in enumerate(data):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)
        for f in os.scandir(path.removeprefix("file:")):
            if f.name.startswith("part-") and f.stat().st_mtime > 1e9 + 1000:
                os.utime(f.path, (1e9 + k, 1e9 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)


@pytest.mark.parametrize("kind, values", [
    ("double", [0.5, None, 0.7, 1.9]),
    ("long", [None, 3, None, 4]),
    ("decimal(20,2)", [None, Decimal("0.10"), Decimal("0.25"), None]),
])
def test_running_totals_keep_types_and_nulls(spark, kind, values):
    schema = f"k int, o int, v {kind}"
    data = [(1, o, v) for o, v in enumerate(values)]
    stream = several(spark, data, schema)
    out = ps.keyed(stream, ["k"], ps.RunningTotal(["o"], "v", kind=kind), ps.widened(stream, total=kind))
    total, want = None, []
    for o, v in enumerate(values):
        total = v if total is None else total if v is None else total + v
        want.append((o, total))
    assert rows(runs.append_to_table(out).select("o", "total")) == sorted(want, key=repr)


def test_count_windows_take_nulls_and_fractions(spark):
    values = [0.5, None, 1.5, None, None, 2.0]
    stream = several(spark, [(1, o, v) for o, v in enumerate(values)], "k int, o int, v double")
    out = ps.keyed(stream, ["k"], ps.SlidingCountWindow(["o"], "v", 2, 1, kind="double"), "k int, at_row long, n long, total double")
    want = []
    for i in range(len(values)):
        part = values[max(0, i - 1) : i + 1]
        want.append((1, i + 1, len(part), sum(v for v in part if v is not None) if any(v is not None for v in part) else None))
    assert rows(runs.append_to_table(out)) == sorted(want, key=repr)


def test_fractions_are_not_cut_off(spark):
    stream = several(spark, [(1, 0, 0.5)], "k int, o int, v double")
    with pytest.raises(StreamingQueryException, match="fractions"):
        runs.append_to_table(ps.keyed(stream, ["k"], ps.RunningTotal(["o"], "v"), ps.widened(stream, total="long")))


def test_state_of_closed_windows_is_dropped(spark):
    data = [(u, f"2024-01-{1 + 4 * d:02d} 00:00:0{u}") for d in range(6) for u in range(5)]
    path = fresh_dir(spark, "visits")
    for k in range(6):
        part = spark.createDataFrame(data[5 * k : 5 * k + 5], "user_id int, at string").select("user_id", F.col("at").cast("timestamp").alias("ts"))
        part.coalesce(1).write.mode("append").parquet(path)
        for f in os.scandir(path.removeprefix("file:")):
            if f.name.startswith("part-") and f.stat().st_mtime > 1e9 + 1000:
                os.utime(f.path, (1e9 + k, 1e9 + k))
    stream = spark.readStream.schema("user_id int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    first = runs.distinct_per_window(stream, "ts", "user_id", "6 hours", "1 hour")
    writer = first.writeStream.format("parquet").option("path", fresh_dir(spark, "first")).option("checkpointLocation", fresh_dir(spark, "c"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 10 and held[-1] <= 5


def test_large_limits_equal_small_ones(spark, events):
    last = evict_count(events, ["user_id"], ["ts", "event_id"], 2000)
    assert last.count() == events.count()
    numbered = number_rows(events, [], ["ts", "event_id"], "rn")
    n = numbered.count()
    assert rows(evict_count(numbered.withColumn("one", F.lit(1)), ["one"], ["rn"], n - 1001).select("rn")) == [(k,) for k in sorted(range(1002, n + 1), key=lambda k: repr((k,)))] if n > 2002 else True
    few, many = (window_rank(events, ["event_type"], "value", ["event_id"], n) for n in (3, 1001))
    assert rows(many.where("rank <= 3").select("event_id", "rank")) == rows(few.select("event_id", "rank"))
