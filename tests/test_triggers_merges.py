"""Window triggers, merged change streams, dimension versions and repeated rows in count windows, against plain Python."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_stream_state import DAY, batches, cut, progress
from tidemark.operators import aggs, joins, windows
from tidemark.operators.history import highest, lowest, running
from tidemark.runtime import fresh_dir
from tidemark.sinks import batches as sinks
from tidemark.sinks import merges
from tidemark.sources.readers import CachedDimension
from tidemark.streaming import runs, triggers

CLOSING = datetime(9000, 1, 1)


def clicks(seed, n, days=3):
    rng = random.Random(seed)
    at = sorted(rng.sample(range(days * 86400), n))
    return [(rng.choice([1, 2, None]), DAY + timedelta(seconds=s), k, rng.choice([None, 1, 5])) for k, s in enumerate(at)]


def expected(data, size, n, purge, end):
    held, fired = defaultdict(list), []
    total = lambda part: sum(v for v in part if v is not None) if any(v is not None for v in part) else None
    seen = defaultdict(int)
    for user, ts, _, v in data:
        start = DAY + (ts - DAY) // size * size if size else datetime(1970, 1, 1)
        held[user, start].append(v)
        seen[user, start] += 1
        if n and seen[user, start] % n == 0:
            fired.append((user, start, len(held[user, start]), total(held[user, start]), "count"))
            if purge:
                held[user, start] = []
    if end:
        fired += [(user, start, len(part), total(part), "end") for (user, start), part in held.items() if part]
    return sorted(fired, key=repr)


SCHEMA = "user long, ts timestamp, id long, v long"


def run(spark, data, size, trigger, closing=True):
    parts = [*cut(data, 5), *([[(None, CLOSING, -1, None)]] if closing else [])]
    stream = runs.closed(batches(spark, parts, SCHEMA), "ts", "1 hour")
    out, state = progress(triggers.triggered_windows(stream, "user", "ts", ["ts", "id"], "v", size, trigger))
    return rows(runs.zone_less(out, "window_start")), state


@pytest.mark.parametrize("purge", [False, True])
@pytest.mark.parametrize("size, n, end", [(None, 4, False), ("1 day", 3, True), ("6 hours", None, True), ("1 day", 1, False)])
def test_counts_and_ends_combine(spark, size, n, end, purge):
    data = clicks(1, 150)
    parts = [p for p in (triggers.count(n) if n else None, triggers.at_end() if end else None) if p]
    trigger = triggers.either(*parts)
    trigger = triggers.purging(trigger) if purge else trigger
    hours = {None: None, "1 day": timedelta(days=1), "6 hours": timedelta(hours=6)}[size]
    got, state = run(spark, data, size, trigger)
    assert got == expected(data, hours, n, purge, end)
    if end:
        assert state[-1]["numRowsTotal"] == 0


@pytest.mark.parametrize("purge", [False, True])
def test_early_firings_add_up_to_the_window(spark, purge):
    data = clicks(2, 200)
    trigger = triggers.either(triggers.early("2 hours"), triggers.at_end())
    got, state = run(spark, data, "1 day", triggers.purging(trigger) if purge else trigger)
    whole = {(u, s): (n, total) for u, s, n, total, _ in expected(data, timedelta(days=1), None, False, True)}
    fired = defaultdict(list)
    for user, start, n, total, cause in got:
        fired[user, start].append((n, total or 0, cause))
    assert set(fired) == set(whole) and any(c == "time" for f in fired.values() for _, _, c in f)
    for key, (n, total) in whole.items():
        counts, sums = [f[0] for f in fired[key]], [f[1] for f in fired[key]]
        assert (sum(counts), sum(sums)) == (n, total or 0) if purge else (max(counts), max(sums)) == (n, total or 0)
    assert state[-1]["numRowsTotal"] == 0


def test_clock_and_event_time_do_not_mix():
    with pytest.raises(ValueError):
        triggers.either(triggers.processing_time("1 second"), triggers.at_end())
    assert triggers.either(triggers.processing_time("1 second"), triggers.count(3)).rows == 3


# --- merged changes -------------------------------------------------------------------------------------------------


def changes(seed, n, keys):
    """(key, step, kind, value) in any order; the highest step of a key counts."""
    rng = random.Random(seed)
    data = [(rng.randrange(keys), step, rng.choice(["insert", "update", "delete"]), rng.choice([None, f"v{step}"])) for step in range(n)]
    rng.shuffle(data)
    return data


def current(data):
    last = {}
    for key, step, kind, value in sorted(data, key=lambda d: d[1]):
        last[key] = (kind, value)
    return sorted(((k, v) for k, (kind, v) in last.items() if kind != "delete"), key=repr)


def test_changes_merge_over_batches_and_compactions(spark):
    data = changes(3, 400, 60)
    path, checkpoint = fresh_dir(spark, "merged"), fresh_dir(spark, "c")
    sink = merges.merge_changes_sink(path, ["k"], ["step"], F.col("kind") == "delete")
    parts, seen = cut(data, 6), []

    def write(batch, batch_id):
        sink(batch, batch_id)
        seen.extend(parts[batch_id])
        if batch_id in (2, 4):
            assert merges.compact_merged(spark, path, ["k"], ["step"]) == batch_id // 2 - 1
        assert rows(merges.read_merged(spark, path, ["k"], ["step"]).select("k", "v")) == current(seen)

    runs.drain(batches(spark, parts, "k long, step long, kind string, v string"), write, checkpoint=checkpoint)
    assert len(seen) == 400
    # A version that was written but never pointed to changes nothing.
    spark.createDataFrame([(1, 10**6, "insert", "lost", False)], "k long, step long, kind string, v string, __gone boolean").write.parquet(f"{path}/versions/version=9")
    assert rows(merges.read_merged(spark, path, ["k"], ["step"]).select("k", "v")) == current(data)


def test_tombstones_stay_until_they_may_be_forgotten(spark):
    path, schema = fresh_dir(spark, "merged"), "k long, step long, kind string, v string"
    sink = merges.merge_changes_sink(path, ["k"], ["step"], F.col("kind") == "delete")
    sink(spark.createDataFrame([(1, 5, "delete", None), (2, 1, "insert", "b")], schema), 0)
    merges.compact_merged(spark, path, ["k"], ["step"])
    sink(spark.createDataFrame([(1, 3, "insert", "too late")], schema), 1)
    assert rows(merges.read_merged(spark, path, ["k"], ["step"]).select("k", "v")) == [(2, "b")]
    merges.compact_merged(spark, path, ["k"], ["step"], forget=F.col("step") < 10)
    assert spark.read.parquet(f"{path}/versions/version=1").count() == 1


# --- dimension versions ---------------------------------------------------------------------------------------------


def test_rows_meet_the_version_of_their_time(spark):
    versions = [(1, "a", 10), (1, "b", 20), (1, "c", 20 + 15), (2, "x", 0), (None, "n", 0)]
    facts = [(k, c, at) for k, (c, at) in enumerate([(1, 9), (1, 10), (1, 19), (1, 20), (1, 99), (2, 0), (3, 5), (None, 5), (1, None)])]
    dimension = joins.with_validity(spark.createDataFrame(versions, "key long, name string, valid_from long"), ["key"], "valid_from")
    table = spark.createDataFrame(facts, "id long, c long, at long")
    got = {r.id: r.name for r in joins.as_of_join(table, dimension, "c", "key", "at").collect()}
    assert got == {0: None, 1: "a", 2: "a", 3: "b", 4: "c", 5: "x", 6: None, 7: None, 8: None}
    assert joins.as_of_join(table, dimension, "c", "key", "at", how="inner").count() == 5


def test_a_stream_sees_a_new_version_after_the_lifetime_of_the_cache(spark):
    clock, loaded = [0.0], []
    names = {0: "old", 1: "old", 2: "new", 3: "new"}

    def load():
        loaded.append(clock[0])
        df = spark.createDataFrame([(1, "old" if clock[0] < 20 else "new", 0)], "key long, name string, valid_from long")
        return joins.with_validity(df, ["key"], "valid_from")

    cached = CachedDimension(load, ttl_seconds=15, clock=lambda: clock[0])
    path = fresh_dir(spark, "looked-up")
    write = sinks.upsert_sink(path, ["id"])

    def sink(batch, batch_id):
        write(batch, batch_id)
        clock[0] += 10

    join = lambda batch, versions: joins.as_of_join(batch, versions, "c", "key", "at").select("id", "name")
    stream = batches(spark, [[(k, 1, 5)] for k in range(4)], "id long, c long, at long")
    runs.drain(stream, runs.lookup_per_batch(cached.current, join, sink))
    assert {r.id: r.name for r in sinks.read_upserted(spark, path, ["id"]).collect()} == names and loaded == [0.0, 20.0]


# --- count windows and window functions -----------------------------------------------------------------------------


@pytest.mark.parametrize("size, slide", [(10, 5), (3, 2), (4, 4), (2, 5)])
def test_repeated_rows_equal_single_ones(spark, size, slide):
    rng = random.Random(size)
    data = [(rng.choice(["a", "b", None]), at, rng.choice([0, 1, 1, 2, 13]), rng.randrange(50)) for at in range(60)]
    repeated = spark.createDataFrame(data, "k string, at long, times long, v long")
    single = spark.createDataFrame([(k, at, j, v) for k, at, n, v in data for j in range(n)], "k string, at long, j long, v long")
    folds = {"n": running(F.lit(1)), "total": running("v"), "top": highest("v"), "low": lowest("v")}
    for slicing in ({}, {"rows_per_slice": 5}):
        got = windows.count_window_slide_repeated(repeated, ["k"], ["at"], "times", size, slide, folds, **slicing)
        assert rows(got) == rows(windows.count_window_slide(single, ["k"], ["at", "j"], size, slide, folds))


def test_a_function_sees_sorted_times(spark):
    data = [(u, DAY + timedelta(minutes=m)) for u, m in ((1, 50), (1, 10), (1, 70), (None, 5), (2, 61), (2, 60))]
    df = spark.createDataFrame(data, "u long, ts timestamp_ntz")

    def shown(key, part):
        return pd.DataFrame({"u": pd.Series([key[0]], dtype="Int64"), "start": [key[1]], "minutes": [",".join(str(t.minute) for t in part["ts"])]})

    got = rows(aggs.apply_window(df, ["u"], "ts", "1 hour", shown, "u long, start timestamp_ntz, minutes string"))
    hour = timedelta(hours=1)
    assert got == sorted([(1, DAY, "10,50"), (1, DAY + hour, "10"), (None, DAY, "5"), (2, DAY + hour, "0,1")], key=repr)
    assert aggs.apply_window(df.limit(0), ["u"], "ts", "1 hour", shown, "u long, start timestamp_ntz, minutes string").collect() == []
