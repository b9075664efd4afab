"""Sliced histories must equal plain windows, however the data is cut or skewed."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import aggs, history, over, patterns, watermarks, windows
from tidemark.operators.history import (
    highest, lowest, number_rows, prefix_scan, previous_row, running, slice_history, unslice,
)
from tidemark.plans.keyed import TRANSITIONS

CUTS = [{}, {"rows_per_slice": 9}]


@pytest.fixture(autouse=True, scope="module")
def small_blocks():
    """Few boundaries per block, so that both steps of the lookup are used."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(history, "BLOCK", 5)
        yield


@pytest.fixture
def skewed(events):
    """One user has half of all rows, and some rows have no user."""
    user = F.when(F.col("event_id") % 2 == 0, F.lit(1)).when(F.col("event_id") % 31 == 0, F.lit(None)).otherwise(F.col("user_id"))
    return events.withColumn("user_id", user.cast("long")).withColumn("k", (F.col("event_id") * 37 % 101).cast("long")).drop("props")


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_scan_equals_window(skewed, cut, backward, inclusive):
    order = ["ts", "event_id"]
    folds = {"total": running("k"), "low": lowest("value"), "high": highest(F.struct("value", "event_id"))}
    got = prefix_scan(skewed, ["user_id"], order, folds, inclusive, backward, **cut)
    columns = [F.col(c).desc() if backward else F.col(c) for c in order]
    w = Window.partitionBy("user_id").orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = skewed.withColumns(
        {"total": F.sum("k").over(w), "low": F.min("value").over(w), "high": F.max(F.struct("value", "event_id")).over(w)}
    )
    assert rows(got.select(want.columns)) == rows(want)


def test_hot_key_is_cut(skewed):
    sliced = slice_history(skewed, ["user_id"], ["ts", "event_id"], rows_per_slice=40)
    sizes = [r["count"] for r in sliced.where("user_id = 1").groupBy("__slice").count().collect()]
    assert sum(sizes) == skewed.where("user_id = 1").count()
    assert len(sizes) > 4 and max(sizes) < 400
    assert unslice(sliced).columns == skewed.columns


def test_boundaries_are_limited(skewed):
    sliced = slice_history(skewed, ["user_id"], ["ts", "event_id"], rows_per_slice=1, max_boundaries=10)
    assert sliced.select("user_id", "__slice").distinct().count() < 60 + skewed.select("user_id").distinct().count()


def test_no_keys(skewed):
    got = number_rows(skewed, [], ["event_id"], "rn", rows_per_slice=50)
    assert rows(got.select("event_id", "rn")) == sorted(
        ((r[0], i + 1) for i, r in enumerate(skewed.select("event_id").orderBy("event_id").collect())), key=repr
    )


@pytest.mark.parametrize("cut", CUTS)
def test_previous_row(skewed, cut):
    got = previous_row(skewed, ["user_id"], ["ts", "event_id"], {"before": "event_type"}, **cut)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = skewed.withColumn("before", F.lag("event_type").over(w))
    assert rows(got.select("event_id", "before")) == rows(want.select("event_id", "before"))


@pytest.mark.parametrize("cut", CUTS)
def test_sessions(skewed, cut):
    got = windows.session_agg(skewed, ["user_id"], "ts", "2 hours", {"n": running(F.lit(1)), "k": running("k")}, **cut)
    w = F.session_window(F.col("ts").cast("timestamp"), "2 hours")
    want = skewed.groupBy("user_id", w.alias("w")).agg(F.count("*").alias("n"), F.sum("k").alias("k"))
    want = want.select("user_id", F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"), "n", "k")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("cut", CUTS)
def test_range_counts(skewed, cut):
    got = over.count_over_range(skewed, ["user_id"], "ts", "6 hours", **cut)
    skewed.createOrReplaceTempView("skewed")
    want = skewed.sparkSession.sql(
        "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) FROM skewed"
    )
    assert rows(got.select("event_id", "cnt")) == rows(want)


def test_range_counts_with_equal_times(spark):
    df = spark.sql("SELECT 1L AS k, timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id div 3) AS ts FROM range(9)")
    got = over.count_over_range(df, ["k"], "ts", "1 seconds")
    assert sorted(r["cnt"] for r in got.collect()) == [3, 3, 3, 6, 6, 6, 6, 6, 6]


@pytest.mark.parametrize("tile", [5, 1000])
def test_moving_frames(skewed, tile):
    got = over.agg_over_rows(skewed, ["user_id"], ["ts", "event_id"], 4, {"s": F.sum("k"), "m": F.min("value")}, tile_rows=tile, rows_per_slice=50)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-4, 0)
    want = skewed.withColumns({"s": F.sum("k").over(w), "m": F.min("value").over(w)})
    assert rows(got.select("event_id", "s", "m")) == rows(want.select("event_id", "s", "m"))


def machine_by_hand(df):
    known = {(a, e): b for a, e, b in TRANSITIONS}
    state, out = {}, []
    for r in df.orderBy("ts", "event_id").collect():
        now = state.get(r["user_id"], "Initial")
        then = known.get((now, r["event_type"]))
        if then is None:
            out.append((r["event_id"], now))
        else:
            state[r["user_id"]] = "Initial" if then == "Terminal" else then
    return sorted(out, key=repr)


@pytest.mark.parametrize("cut,batch", [(CUTS[0], 13), (CUTS[1], 13), (CUTS[1], 10000)])
def test_machine(spark, skewed, cut, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = patterns.state_machine_alerts(skewed, ["user_id"], ["ts", "event_id"], "event_type", TRANSITIONS, **cut)
        assert rows(got.select("event_id", "state")) == machine_by_hand(skewed)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def delta_by_hand(df, threshold, keep):
    per, out = {}, []
    for r in df.orderBy("ts", "event_id").collect():
        base, seen = per.setdefault(r["user_id"], [None, []])
        seen.append(r)
        if base is None:
            per[r["user_id"]][0] = r["distance"]
        elif r["distance"] - base > threshold:
            per[r["user_id"]][0] = r["distance"]
            reach = [x for x in seen if (r["ts"] - x["ts"]).total_seconds() <= keep]
            top = max(reach, key=lambda x: x["value"])
            out.append((r["event_id"], top["value"], top["event_id"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cut,batch", [(CUTS[0], 13), (CUTS[1], 13), (CUTS[1], 10000)])
def test_delta_trigger(spark, skewed, cut, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        driven = aggs.running_sum(skewed, ["user_id"], F.col("k") - 20, ["ts", "event_id"], "distance", **cut)
        driven = driven.withColumn("distance", F.col("distance").cast("double"))
        earliest = [-F.unix_micros(F.col("ts").cast("timestamp")), -F.col("event_id")]
        got = windows.delta_trigger_window(
            driven, ["user_id"], "ts", ["ts", "event_id"], "distance", 50.0, "6 hours", "value", earliest, **cut
        )
        got = got.select("event_id", "top_value", "top_row.event_id")
        assert rows(got) == delta_by_hand(driven, 50.0, 6 * 3600)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("cut,threshold", [(CUTS[0], 900.0), (CUTS[1], 0.5), (CUTS[1], 60.0), (CUTS[1], 900.0)])
def test_delta_fires_of_a_rising_measure(skewed, cut, threshold):
    driven = skewed.withColumn("distance", (F.col("event_id") * 17 + F.col("k")).cast("double"))
    got = windows.delta_fires(driven, ["user_id"], ["ts", "event_id"], "distance", threshold, **cut)
    assert rows(got.select("event_id")) == [(e,) for e, *_ in delta_by_hand(driven, threshold, 0)]


def test_delta_boundary(spark):
    data = [(0, 0.0), (1, 50.0), (2, 50.5), (3, 100.5), (4, 101.0)]
    df = spark.createDataFrame([(1, o, m) for o, m in data], "k long, o long, m double")
    fires = windows.delta_fires(df, ["k"], ["o"], "m", 50.0)
    assert [r["o"] for r in fires.orderBy("o").collect()] == [2, 4]


@pytest.mark.parametrize("cut", CUTS)
def test_late_parts_add_up(skewed, cut):
    shuffled = skewed.withColumn("arrival", F.expr("event_id + (event_id * 7919) % 101"))
    on_time, late = watermarks.split_late(shuffled, "ts", "10 minutes", "10 minutes", ["arrival", "event_id"], **cut)
    newest, want = None, []
    for r in shuffled.orderBy("arrival", "event_id").collect():
        minute = r["ts"].minute // 10 * 10
        end = np.datetime64(r["ts"].replace(minute=minute, second=0, microsecond=0)) + np.timedelta64(600, "s")
        if newest is not None and end - np.timedelta64(1, "ms") <= newest - np.timedelta64(600, "s"):
            want.append(r["event_id"])
        ts = np.datetime64(r["ts"])
        newest = ts if newest is None else max(newest, ts)
    assert sorted(r["event_id"] for r in late.collect()) == sorted(want)
    assert want and on_time.count() + late.count() == shuffled.count()


@pytest.mark.parametrize("cut", CUTS)
def test_rule_matches_by_hand(skewed, cut):
    spark = skewed.sparkSession
    table = [("r1", "view", "click"), ("r2", "view", "view"), ("r3", "error", "signup")]
    rules = spark.createDataFrame(table, "rule string, first string, second string")
    got = patterns.rule_sequence_match(skewed, rules, ["user_id"], ["ts", "event_id"], "event_type", **cut)
    waiting, want = {}, []
    for r in skewed.orderBy("ts", "event_id").collect():
        for rule, first, second in table:
            at = (r["user_id"], rule)
            if r["event_type"] == second:
                want += [(rule, f, r["event_id"]) for f in waiting.pop(at, [])]
            if r["event_type"] == first:
                waiting.setdefault(at, []).append(r["event_id"])
    assert rows(got.select("rule", "event_id", "matched.event_id")) == sorted(want, key=repr)
