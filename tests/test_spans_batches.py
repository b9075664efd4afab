"""Work that follows the rows: versions of rules by spans of the order, windows handed over in batches, counts without a shuffle."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from conftest import rows
from test_stream_state import expected_matches
from tidemark.functions.text import counted_items
from tidemark.operators import aggs, patterns
from tidemark.streaming import controls, event_time, triggers

DAY = datetime(2024, 3, 1)


def test_an_item_meets_the_versions_of_its_span_only(spark, monkeypatch):
    rng = random.Random(3)
    data = [(at, rng.choice([1, 2]), rng.choice("abcd")) for at in range(900)]
    rules = [(at, rng.choice("rst"), rng.choice("abc"), rng.choice("abc")) for at in range(40, 800) if at % 3]
    rules.append((41, "u", "a", "d"))
    items = spark.createDataFrame(data, "at long, user long, kind string")
    versions = spark.createDataFrame(rules, "at long, rule string, first string, second string")
    kept = {}
    monkeypatch.setattr(patterns, "cut_lineage", lambda df, name: kept.setdefault(name, df))
    monkeypatch.setattr(patterns, "CHANGES_PER_SPAN", 8)
    got = rows(patterns.changing_rule_match(items, versions, ["user"], ["at"], "kind").select("rule", "user", "at", "matched.at"))
    # One place has changes of two rules, which the plain rows can't hold.
    one = {r: [v for v in rules if (v[1] == "u") == (r == "u")] for r in ("u", "others")}
    assert got == sorted(expected_matches(data, one["u"]) + expected_matches(data, one["others"]), key=repr)
    join = kept["tagged"]._jdf.queryExecution().optimizedPlan().toString()
    assert "__span" in next(line for line in join.splitlines() if "Join Inner" in line and "__kind" in line)


def test_windows_come_in_batches(spark):
    rng = random.Random(5)
    data = [(rng.choice([1, 2, None, 2**60 + 1]), DAY + timedelta(minutes=rng.randrange(600)), rng.choice([None, 2**60 + 3, 5])) for _ in range(200)]
    df = spark.createDataFrame(data, "u long, ts timestamp_ntz, v long")

    def told(key, part):
        times = part.column("ts").to_numpy(zero_copy_only=False)
        assert (np.diff(times) >= np.timedelta64(0)).all() and isinstance(key[1], datetime)
        return [(key[0], key[1], part.num_rows, sum(v or 0 for v in part.column("v").to_pylist()))] * (part.num_rows > 1)

    schema = "u long, start timestamp_ntz, n long, total decimal(38,0)"
    want = defaultdict(list)
    for u, ts, v in data:
        want[u, ts.replace(minute=0)].append(v or 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = rows(aggs.apply_window(df, ["u"], "ts", "1 hour", told, schema, ["v"], batched=True))
        assert got == sorted([(u, s, len(v), sum(v)) for (u, s), v in want.items() if len(v) > 1], key=repr)
        assert aggs.apply_window(df.limit(0), ["u"], "ts", "1 hour", told, schema, ["v"], batched=True).collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_items_are_counted_in_their_row(spark):
    df = spark.createDataFrame([(1, ["b", "a", None, "b"]), (None, ["a"]), (2, []), (3, None), (1, [None, None])], "id long, words array<string>")
    out = counted_items(df, "words", "word", "times")
    assert rows(out) == sorted([(1, "a", 1), (1, "b", 2), (1, None, 1), (None, "a", 1), (1, None, 2)], key=repr)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_markers_that_say_nothing_are_not_held(monkeypatch):
    rng = random.Random(6)
    at, ts = list(range(4000)), [DAY + timedelta(minutes=rng.randrange(9000)) for _ in range(4000)]
    whole = pd.DataFrame({"at": at, "ts": ts, "is_control": [rng.random() < 0.7 for _ in at]}).sample(frac=1, random_state=1)
    whole["ts"] = whole["ts"].where(whole["at"] % 11 > 0)
    monkeypatch.setattr(controls, "FEW_CONTROL", 50)
    held = []

    class Marks(controls.MarkedTime):
        def step(self, items, control):
            held.append(len(control))
            return super().step(items, control)

    marked = Marks(["at"], "ts")
    marked.init(Handle())
    got = next(marked.handleInputRows(("0",), (whole[k : k + 300] for k in range(0, 4000, 300)), None))
    marks = whole.sort_values("at")
    highest = marks["ts"].where(marks["is_control"]).cummax().ffill()[~marks["is_control"]]
    assert got["watermark"].reset_index(drop=True).equals(highest.reset_index(drop=True).astype(got["watermark"].dtype)) and held[0] < 700


class Handle:
    """State of one key in a list, with a count of the calls."""

    def __init__(self):
        self.calls, self.rows, self.timers = 0, [], []

    def getListState(self, *_):
        return self

    getValueState = getListState

    def registerTimer(self, at):
        self.timers.append(at)

    def __getattr__(self, name):
        def call(*given):
            self.calls += 1
            if name in ("put", "update", "clear"):
                self.rows = list(given[0]) if given else []
            return bool(self.rows) if name == "exists" else iter(self.rows) if name == "get" else None

        return call


def test_a_key_reads_and_writes_its_state_once_a_batch():
    times = [DAY + timedelta(hours=4 * k) for k in range(3)]
    frame = pd.DataFrame({"u": 1, "ts": times, "id": range(3), "v": range(3)})
    trigger = triggers.either(triggers.count(3), triggers.at_end())
    for processor in (event_time.ClosingSessions("u", "ts", "3 hours", "v"), triggers.TriggeredWindows("u", "ts", ["ts", "id"], "v", "1 day", trigger)):
        handle = Handle()
        processor.init(handle)
        for batch in (frame, frame.assign(ts=frame["ts"] + timedelta(days=1))):
            handle.calls = 0
            list(processor.handleInputRows((1,), iter([batch]), None))
            assert handle.calls == 2 and len(handle.timers) == 1
