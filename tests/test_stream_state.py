"""Control rows, event-time timers and bounded state on streams of several micro-batches, against plain Python."""

import os
import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import patterns
from tidemark.runtime import fresh_dir, stream_options
from tidemark.streaming import controls, event_time, runs
from tidemark.streaming import processors as ps

DAY = datetime(2024, 3, 1)


def batches(spark, parts, schema):
    """A stream whose micro-batches are the given lists of rows."""
    path = fresh_dir(spark, "rows")
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        for f in os.scandir(path.removeprefix("file:")):
            if f.name.startswith("part-") and f.stat().st_mtime > 1e9 + 1000:
                os.utime(f.path, (1e9 + k, 1e9 + k))
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(path)


def cut(data, n):
    size = -(-len(data) // n)
    return [data[k : k + size] for k in range(0, len(data), size)]


def progress(df, mode="append"):
    """Run a stream; its rows and what its batches say about state."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, "out")
    query = stream_options(df.writeStream.format("parquet").option("path", path).outputMode(mode), fresh_dir(spark, "c")).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path), [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]


# --- control rows ---------------------------------------------------------------------------------------------------


def rule_rows(seed, n, users):
    rng = random.Random(seed)
    data, rules = [], []
    for at in range(n):
        if at % 37 == 5:
            rules.append((at, rng.choice(["r", "s"]), rng.choice("abc"), rng.choice("abc")))
        data.append((at, rng.choice(users), rng.choice("abcd")))
    return data, rules


def expected_matches(data, rules):
    changes, now, waiting, out = {at: (r, a, b) for at, r, a, b in rules}, {}, defaultdict(list), []
    for at, user, kind in data:
        if at in changes:
            rule, first, second = changes[at]
            now[rule] = (first, second)
        for rule, (first, second) in now.items():
            if kind == second:
                out += [(rule, user, i, at) for i in waiting.pop((rule, user), [])]
            if kind == first:
                waiting[rule, user].append(at)
    return sorted(out, key=repr)


def test_rules_change_while_the_stream_runs(spark):
    data, rules = rule_rows(1, 600, [1, 2, None, 2**60 + 1])
    changes = {r[0]: r[1:] for r in rules}
    schema = "at long, user long, kind string, rule string, first string, second string"
    stream = batches(spark, cut([(*d, *changes.get(d[0], (None, None, None))) for d in data], 5), schema)
    items, control = stream.select("at", "user", "kind"), stream.where("rule IS NOT NULL").select("at", "rule", "first", "second")
    processor = controls.ChangingRules(["at"], "user", "kind", "at")
    out = runs.append_to_table(controls.controlled(controls.with_control(items, control, "user", 3), processor, processor.SCHEMA))
    got = rows(out.select("rule", F.col("key").cast("long"), "first_id", "second_id"))
    want = expected_matches(data, rules)
    assert want and got == want
    table = spark.createDataFrame(data, "at long, user long, kind string")
    versions = spark.createDataFrame(rules, "at long, rule string, first string, second string")
    matched = patterns.changing_rule_match(table.where("user IS NOT NULL"), versions, ["user"], ["at"], "kind")
    assert rows(matched.select("rule", "user", F.col("at"), F.col("matched.at"))) == [m for m in want if m[1] is not None]


def test_long_waiting_lists_stay_in_small_entries(spark):
    data = [(at, 7, "a") for at in range(900)] + [(900, 7, "b"), (901, 7, "a"), (902, 7, "b")]
    stream = batches(spark, cut([(*d, *(("r", "a", "b") if d[0] == 0 else (None,) * 3)) for d in data], 4), "at long, user long, kind string, rule string, first string, second string")
    items, control = stream.select("at", "user", "kind"), stream.where("rule IS NOT NULL").select("at", "rule", "first", "second")
    processor = controls.ChangingRules(["at"], "user", "kind", "at")
    out = runs.append_to_table(controls.controlled(controls.with_control(items, control, "user", 2), processor, processor.SCHEMA))
    assert rows(out.select("first_id", "second_id")) == sorted([(k, 900) for k in range(900)] + [(901, 902)], key=repr)


def test_a_reset_reaches_keys_without_rows(spark):
    rng = random.Random(4)
    data = [(at, rng.choice([1, 2, 3, None]), rng.choice([0.5, None, 2.0]), at % 50 == 20) for at in range(300)]
    stream = batches(spark, cut(data, 4), "at long, user long, v double, clears boolean")
    both = controls.with_control(stream.select("at", "user", "v"), stream.where("clears").select("at"), "user", 2)
    schema = ps.widened(both.drop("is_control"), total="double")
    out, state = progress(controls.controlled(both, controls.TotalsSinceReset(["at"], "user", "v", kind="double"), schema))
    totals, want = {}, []
    for at, user, v, clears in data:
        totals = {} if clears else totals
        if v is not None:
            totals[user] = totals.get(user, 0.0) + v
        want.append((at, totals.get(user)))
    assert rows(out.select("at", "total")) == sorted(want, key=repr)


def test_marks_move_the_watermark_of_all_keys(spark):
    rng = random.Random(5)
    data = [(at, rng.randrange(4), DAY + timedelta(minutes=rng.randrange(600)), rng.random() < 0.1) for at in range(200)]
    stream = batches(spark, cut(data, 4), "at long, user long, ts timestamp_ntz, marks boolean")
    both = controls.with_control(stream.select("at", "user", "ts"), stream.where("marks").select("at", "ts"), "user", 3)
    schema = ps.widened(both.drop("is_control"), watermark="timestamp_ntz", is_late="boolean")
    out = runs.append_to_table(controls.controlled(both, controls.MarkedTime(["at"], "ts"), schema))
    highest, want = None, []
    for at, _, ts, marks in data:
        highest = ts if marks and (highest is None or ts > highest) else highest
        want.append((at, highest, highest is not None and ts < highest))
    assert rows(out.select("at", "watermark", "is_late")) == sorted(want, key=repr)


# --- event-time timers ----------------------------------------------------------------------------------------------


def visits(seed, n, days):
    rng = random.Random(seed)
    return [(rng.choice([1, 2, None]), DAY + timedelta(minutes=rng.randrange(days * 1440)), rng.choice([1, 2, None])) for _ in range(n)]


def expected_sessions(data, gap):
    by_user = defaultdict(list)
    for user, ts, v in data:
        by_user[user].append((ts, v))
    out = []
    for user, found in by_user.items():
        found.sort(key=lambda x: x[0])
        open_ = [found[0]]
        for row in [*found[1:], None]:
            if row is None or row[0] - open_[-1][0] > gap:
                values = [v for _, v in open_ if v is not None]
                out.append((user, open_[0][0], open_[-1][0] + gap, len(open_), sum(values) if values else None))
                open_ = []
            if row:
                open_.append(row)
    return sorted(out, key=repr)


def test_sessions_close_once_whatever_the_order_of_batches(spark):
    data = visits(1, 240, 6)
    random.Random(2).shuffle(data)
    closing = (None, datetime(9000, 1, 1), None)
    stream = batches(spark, [*cut(data, 5), [closing]], "user long, ts timestamp, v long")
    closed = event_time.closing_sessions(runs.closed(stream, "ts", "30 days"), "user", "ts", "3 hours", "v")
    out, state = progress(closed)
    got = rows(runs.zone_less(out, "session_start", "session_end").select("user", "session_start", "session_end", "cnt", "total"))
    assert got == expected_sessions(data, timedelta(hours=3))
    # Every open session is in state until the closing row has gone by, and none is left then.
    assert max(s["numRowsTotal"] for s in state) > 0 and state[-1]["numRowsTotal"] == 0


def test_state_of_closed_sessions_is_dropped_on_the_way(spark):
    data = sorted(visits(3, 300, 30), key=lambda x: x[1])
    stream = batches(spark, [*cut(data, 10), [(None, datetime(9000, 1, 1), None)]], "user long, ts timestamp, v long")
    out, state = progress(event_time.closing_sessions(runs.closed(stream, "ts", "1 hour"), "user", "ts", "3 hours", "v"))
    assert out.count() == len(expected_sessions(data, timedelta(hours=3)))
    held = [s["numRowsTotal"] for s in state]
    assert held[-1] == 0 and max(held) < 60


def expected_uv(data):
    out = []
    labels = defaultdict(set)
    for user, ts, _ in data:
        labels[ts.strftime("%Y-%m-%d")].add(ts.strftime("%H:%M")[:4] + "0")
    for day, found in labels.items():
        for label in found:
            users = {u for u, ts, _ in data if u is not None and ts.strftime("%Y-%m-%d") == day and ts.strftime("%H:%M")[:4] + "0" <= label}
            out.append((day, label, len(users)))
    return sorted(out, key=repr)


def test_first_labels_in_any_order(spark):
    rng = random.Random(7)
    data = [(rng.choice([None, *range(90)]), DAY + timedelta(minutes=rng.randrange(2880)), 1) for _ in range(500)]
    stream = batches(spark, cut(data, 4), "user long, ts timestamp, v long").withWatermark("ts", "30 days")
    changed = event_time.first_labels(stream, "ts", "user", parts=2)
    assert rows(event_time.cumulated(runs.upsert_to_table(changed, ["date_str", "part", "time_str"]))) == expected_uv(data)


def test_first_labels_of_past_days_leave_the_state(spark):
    data = sorted(visits(9, 400, 12), key=lambda x: x[1])
    stream = batches(spark, cut(data, 8), "user long, ts timestamp, v long").withWatermark("ts", "1 hour")
    seen = []
    query = stream_options(
        event_time.first_labels(stream, "ts", "user", parts=1).writeStream.foreachBatch(lambda b, k: seen.append(b.count())).outputMode("update"), fresh_dir(spark, "c")
    ).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held[2:]) < 3 * max(held[:2]) and sum(seen) > 0


# --- bounded writing -------------------------------------------------------------------------------------------------


def test_counts_over_a_range_write_only_their_own_stretches(spark):
    rng = random.Random(11)
    data = sorted((1, DAY + timedelta(seconds=rng.randrange(40000)), k) for k in range(1500))
    data += [(1, data[-1][1], k) for k in range(1500, 1510)]  # ties, over two batches
    stream = batches(spark, cut(data, 6), "k long, ts timestamp, id long")
    out = ps.keyed(stream, ["k"], ps.RangeCount(["ts", "id"], "ts", "3 hours"), ps.widened(stream, cnt="long"))
    found, state = progress(out)
    chunks = cut(data, 6)
    want, seen = [], []
    for chunk in chunks:
        seen += [ts for _, ts, _ in chunk]
        want += [(i, sum(ts - timedelta(hours=3) <= t <= ts for t in seen)) for _, ts, i in chunk]
    assert rows(found.select("id", "cnt")) == sorted(want, key=repr)
    # Stretches are a 64th of the span; those of a sixth of the time are written, not all that are held.
    assert all(s["numRowsUpdated"] <= 45 for s in state if s["numRowsTotal"])


# --- lifetime of state -----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("ttl_ms, again", [(1500, True), (3_600_000, False)])
def test_expired_values_are_not_returned(spark, ttl_ms, again):
    path, seen = fresh_dir(spark, "rows"), []
    write = lambda part: spark.createDataFrame(part, "k long, at long").coalesce(1).write.mode("append").parquet(path)
    write([(1, 10)])
    stream = spark.readStream.schema("k long, at long").parquet(path)
    out = ps.keyed(stream, ["k"], ps.FirstSeen(["at"], ttl_ms=ttl_ms), stream.schema, time_mode="ProcessingTime")
    writer = out.writeStream.foreachBatch(lambda batch, _: seen.extend(tuple(r) for r in batch.collect())).trigger(processingTime="0 seconds")
    query = writer.option("checkpointLocation", fresh_dir(spark, "c")).start()
    try:
        for part, n in ((None, 1), ([(1, 20), (2, 21)], 3 if again else 2)):
            if part:
                time.sleep(2.5)
                write(part)
            end = time.time() + 60
            while time.time() < end and query.isActive and len(seen) < n:
                time.sleep(0.2)
    finally:
        query.stop()
    assert sorted(seen) == sorted([(1, 10), (2, 21), *([(1, 20)] if again else [])])
