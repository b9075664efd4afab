"""Streams in several micro-batches give what the table forms give."""

import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import aggs, joins, patterns, watermarks, windows
from tidemark.operators.history import running
from tidemark.operators.over import count_over_range
from tidemark.plans.keyed import TRANSITIONS
from tidemark.runtime import fresh_dir, run_with_restart, state_store, stream_options
from tidemark.sinks import batches
from tidemark.streaming import processors as ps
from tidemark.streaming import runs

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """The events with a number column, as four files that a stream reads one by one."""
    folder = tmp_path_factory.mktemp("events")
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = df.withColumn("k", (F.col("event_id") * 37 % 101).cast("long")).drop("props").toPandas()
    size = len(df) // 4 + 1
    for i in range(4):
        path = folder / f"part{i}.parquet"
        part = df.iloc[i * size:(i + 1) * size]
        spark.createDataFrame(part, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, k long").coalesce(
            1
        ).write.parquet(str(path))
        for file in path.glob("*.parquet"):
            target = folder / f"flat{i}.parquet"
            target.write_bytes(file.read_bytes())
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


@pytest.fixture
def table(spark, source):
    return spark.read.option("pathGlobFilter", "flat*.parquet").parquet(source)


@pytest.fixture
def stream(spark, source, table):
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "flat*.parquet")
    return reader.parquet(source)


def test_running_total(stream, table):
    out = ps.keyed(stream, ["user_id"], ps.RunningTotal(ORDER, "k"), ps.widened(stream, total="long"))
    want = aggs.running_sum(table, ["user_id"], F.col("k"), ORDER)
    assert rows(runs.append_to_table(out).select("event_id", "total")) == rows(want.select("event_id", "total"))


def test_reset_row_clears_state(stream, table):
    marked = stream.withColumn("reset", F.col("event_type") == "error")
    out = ps.keyed(marked, ["user_id"], ps.RunningTotal(ORDER, "k", reset="reset"), ps.widened(marked, total="long"))
    got = dict(rows(runs.append_to_table(out).select("event_id", "total")))
    totals, want = {}, {}
    for r in table.orderBy(*ORDER).collect():
        before = 0 if r["event_type"] == "error" else totals.get(r["user_id"], 0)
        totals[r["user_id"]] = want[r["event_id"]] = before + r["k"]
    assert got == want


def test_range_counts(stream, table):
    out = ps.keyed(stream, ["user_id"], ps.RangeCount(ORDER, "ts", "12 hours"), ps.widened(stream, cnt="long"))
    want = count_over_range(table, ["user_id"], "ts", "12 hours")
    assert rows(runs.append_to_table(out).select("event_id", "cnt")) == rows(want.select("event_id", "cnt"))


@pytest.mark.parametrize("size,slide", [(10, 5), (5, 3), (1, 1), (2, 4)])
def test_count_windows(stream, table, size, slide):
    slim = stream.select("user_id", *ORDER, "k")
    schema = "user_id long, at_row long, n long, total long"
    out = ps.keyed(slim, ["user_id"], ps.SlidingCountWindow(ORDER, "k", size, slide), schema)
    folds = {"n": running(F.lit(1).cast("long")), "total": running("k")}
    want = windows.count_window_slide(table, ["user_id"], ORDER, size, slide, folds)
    assert rows(runs.append_to_table(out)) == rows(want)


def test_count_average(stream, table):
    slim = stream.select("user_id", *ORDER, "k")
    out = ps.keyed(slim, ["user_id"], ps.CountAverage(ORDER, "k", 3), "user_id long, average long")
    want = windows.count_window(table, ["user_id"], ORDER, 3, {"total": running("k")})
    assert rows(runs.append_to_table(out)) == rows(want.select("user_id", F.expr("total div 3")))


def test_machine(stream, table):
    out = ps.keyed(stream, ["user_id"], ps.MachineAlerts(ORDER, "event_type", TRANSITIONS), ps.widened(stream, state="string"))
    want = patterns.state_machine_alerts(table, ["user_id"], ORDER, "event_type", TRANSITIONS)
    assert rows(runs.append_to_table(out).select("event_id", "state")) == rows(want.select("event_id", "state"))


def test_previous_action(stream, table):
    out = ps.keyed(stream, ["user_id"], ps.PreviousAction(ORDER, "event_type"), ps.widened(stream, previous="string"))
    got = runs.append_to_table(out).where("previous = 'view' AND event_type = 'click'")
    pair = table.sparkSession.createDataFrame([("view", "click")], "first string, second string")
    want = patterns.consecutive_pattern(table, ["user_id"], ORDER, "event_type", pair)
    assert rows(got.select("event_id")) == rows(want.select("event_id"))


def test_rule_matches(spark, stream, table):
    rules = spark.createDataFrame([("a", "view", "click"), ("b", "view", "view")], "rule string, first string, second string")
    tagged = joins.rule_join(stream.select("user_id", "event_id", "event_type"), rules, "event_type")
    matcher = ps.SequenceMatch(["event_id"], "event_id").keyed_by("user_id", "rule")
    schema = "user_id long, rule string, first_id long, second_id long"
    got = runs.append_to_table(ps.keyed(tagged, ["user_id", "rule"], matcher, schema))
    want = patterns.rule_sequence_match(table, rules, ["user_id"], ["event_id"], "event_type")
    assert rows(got) == rows(want.select("user_id", "rule", "event_id", "matched.event_id"))


def test_delta_trigger(stream, table):
    risen = aggs.running_sum(table, ["user_id"], F.col("k"), ORDER, "distance").withColumn("distance", F.col("distance").cast("double"))
    earliest = [-F.unix_micros(F.col("ts").cast("timestamp")), -F.col("event_id")]
    want = windows.delta_trigger_window(risen, ["user_id"], "ts", ORDER, "distance", 120.0, "12 hours", "value", earliest)
    total = ps.keyed(stream, ["user_id"], ps.RunningTotal(ORDER, "k", "distance"), ps.widened(stream, distance="long"))
    trigger = ps.DeltaTrigger(ORDER, "ts", "distance", 120.0, "12 hours", "value", "event_id")
    out = ps.keyed(total, ["user_id"], trigger, ps.widened(total, top_best="double", top_item="long"))
    got = runs.append_to_table(out).select("event_id", "top_best", "top_item")
    assert rows(got) == rows(want.select("event_id", "top_value", "top_row.event_id")) != []


def for_a_while(df, seconds, until):
    """Run a stream that never ends by itself (processing time always moves on) and stop it."""
    spark = df.sparkSession
    path = fresh_dir(spark, "while")
    writer = df.writeStream.foreachBatch(lambda batch, batch_id: batches._write_batch(batch, path, batch_id))
    query = writer.option("checkpointLocation", fresh_dir(spark, "checkpoint")).start()
    try:
        end = time.time() + seconds
        while time.time() < end and query.isActive and not until(query):
            time.sleep(0.5)
    finally:
        query.stop()
    return spark.read.schema(df.schema).parquet(path)


def test_first_seen_with_ttl(spark, stream, table):
    out = ps.keyed(stream, ["user_id"], ps.FirstSeen(ORDER, ttl_ms=3_600_000), stream.schema, time_mode="ProcessingTime")
    got = for_a_while(out, 60, lambda query: len({p["batchId"] for p in query.recentProgress}) > 5)
    want = patterns.first_per_key(table, ["user_id"], ORDER)
    assert rows(got.select("event_id")) == rows(want.select("event_id"))


def test_several_typed_states(spark, stream, table):
    fields = {"num": F.lit(120), "street": F.lit("s"), "city": F.lit("c"), "state": F.lit("x"), "zip": F.lit("110110")}
    app = F.when(F.col("event_type") == "error", "1").otherwise("2")
    records = stream.withColumns({**fields, "appno": app})
    out = ps.keyed(records, ["user_id"], ps.RecordCheck(ORDER, {"num": "int", "street": "string", "city": "string", "state": "string", "zip": "string", "appno": "string"}, "appno", "2"), ps.widened(records, wrong_before="boolean", seen="long"))
    got = rows(runs.append_to_table(out).select("event_id", "wrong_before", "seen"))
    last, count, want = {}, {}, []
    for r in table.orderBy(*ORDER).collect():
        u = r["user_id"]
        count[u] = count.get(u, 0) + 1
        want.append((r["event_id"], last.get(u) == "error", count[u]))
        last[u] = r["event_type"]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("purge", [False, True])
def test_timer_trigger(spark, stream, table, purge):
    timed = watermarks.watermark(runs.event_time(stream), "ts", "0 seconds").select("user_id", "ts", "k")
    processor = ps.TriggeredTotal("user_id", "ts", "k", "1 day", purge)
    schema = "user_id long, fired_at long, cnt long, total long"
    out = ps.keyed(timed, ["user_id"], processor, schema, time_mode="EventTime")
    fired = for_a_while(out, 60, lambda query: len({p["batchId"] for p in query.recentProgress}) > 5)
    per_user = {r["user_id"]: r for r in fired.groupBy("user_id").agg(F.sum("cnt").alias("sum"), F.max("cnt").alias("top")).collect()}
    counts = {r["user_id"]: r["count"] for r in table.groupBy("user_id").count().collect()}
    assert per_user and all(r["top"] <= counts[u] for u, r in per_user.items())
    if purge:
        assert all(r["sum"] <= counts[u] for u, r in per_user.items())
    else:
        assert any(r["sum"] > counts[u] for u, r in per_user.items())


def test_windows_need_a_later_row_to_close(spark, stream, table):
    """Append mode: windows the watermark has passed, each once and final."""
    timed = watermarks.watermark(runs.event_time(stream), "ts", "1 hour")
    sums = aggs.global_window_agg(timed, "ts", "6 hours", {"total": F.sum("k")})
    got = rows(runs.zone_less(runs.append_to_table(sums), "window_start", "window_end"))
    want = rows(aggs.global_window_agg(table, "ts", "6 hours", {"total": F.sum("k")}))
    assert set(got) < set(want) and len(got) == len(set(got)) and len(want) - len(got) <= 3


def test_lateness_adds_to_the_bound(stream):
    out = watermarks.allowed_lateness(runs.event_time(stream), "ts", "3.5 seconds", "5 minutes")
    assert "303.5 seconds" in out._jdf.queryExecution().toString() or "5 minutes 3.5 seconds" in out._jdf.queryExecution().toString()


def test_late_rows_over_batches(spark, stream, table):
    """Within a batch rows come in ``arrival`` order; across batches as the batches come."""
    path = fresh_dir(spark, "late")
    order = F.expr("event_id + (event_id * 7919) % 101")
    runs.drain(stream.withColumn("arrival", order), runs.late_rows_sink(path, "ts", "10 minutes", "10 minutes", ["arrival", "event_id"]))
    on_time, late = runs.read_late_rows(spark, path)
    size = table.count() // 4 + 1
    whole = table.withColumn("batch", F.floor(F.col("event_id") / size)).withColumn("arrival", order)
    _, want = watermarks.split_late(whole, "ts", "10 minutes", "10 minutes", ["batch", "arrival", "event_id"])
    assert rows(late.select("event_id")) == rows(want.select("event_id")) != []
    assert on_time.count() + late.count() == table.count()


def test_dedupe_on_a_stream(stream, table):
    timed = watermarks.watermark(runs.event_time(stream), "ts", "40 days")
    got = runs.append_to_table(patterns.dedupe(timed, ["user_id"], within="40 days"))
    assert rows(got.select("user_id")) == rows(table.select("user_id").distinct())


def test_failed_batch_is_run_again_without_loss_or_repeats(spark, stream, table):
    path, commits, checkpoint = (fresh_dir(spark, n) for n in ("rows", "commits", "checkpoint"))
    sink, failures = batches.exactly_once_sink(path, commits, "job"), []

    def flaky(batch, batch_id):
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            batches._write_batch(batch, path, batch_id)
            raise RuntimeError("lost between writing and committing")
        sink(batch, batch_id)
        if batch_id == 1 and len(failures) == 1:
            failures.append(batch_id)
            raise RuntimeError("not reached: batch 1 is committed")

    def start():
        return stream_options(stream.writeStream.foreachBatch(flaky), checkpoint, name="restarted").start()

    run_with_restart(start, attempts=2, delay_seconds=0)
    assert failures == [2]
    assert rows(batches.read_committed(spark, path, commits, "job").select("event_id")) == rows(table.select("event_id"))


def test_restarts_end(spark, stream):
    def broken(batch, batch_id):
        raise RuntimeError("always")

    def start():
        return stream_options(stream.writeStream.foreachBatch(broken), fresh_dir(spark, "c")).start()

    with pytest.raises(Exception, match="always"):
        run_with_restart(start, attempts=1, delay_seconds=0)


def test_state_store_choice(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    state_store(spark, "file")
    assert "HDFSBacked" in spark.conf.get(key)
    state_store(spark, "rocksdb", incremental=True)
    assert "RocksDB" in spark.conf.get(key)


def test_lookup_uses_the_dimension_of_the_batch(spark, stream):
    path, calls = fresh_dir(spark, "lookup"), []

    def dimension():
        calls.append(1)
        return spark.range(200).select(F.col("id").alias("user"), F.lit(len(calls)).alias("version"))

    def write(batch, batch_id):
        batches._write_batch(batch, path, batch_id)

    runs.drain(stream, runs.lookup_per_batch(dimension, lambda b, d: joins.lookup_join(b, d, "user_id", "user"), write))
    versions = spark.read.parquet(path).groupBy("batch_id").agg(F.collect_set("version").alias("v"))
    assert {(r["batch_id"], tuple(r["v"])) for r in versions.collect()} == {(i, (i + 1,)) for i in range(4)}
