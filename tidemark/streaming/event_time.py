"""Keyed state with event-time timers: what a key holds is given out and dropped when the watermark has passed it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.times import day_label, micros, ten_minute_label
from tidemark.streaming.processors import Numbers, in_order, keyed

#: Below so many keys a map in state is asked key by key, above it is read as a whole.
FEW_KEYS = 64


def as_micros(column: pd.Series) -> np.ndarray:
    return column.astype("datetime64[us]").astype("int64").to_numpy()


def as_times(values) -> pd.Series:
    return pd.Series(pd.to_datetime(np.array(values, "int64"), unit="us"))


class ClosingSessions(StatefulProcessor):
    """Sessions of a key, rows at most ``gap`` apart, each given out once, when no row in time can reach it any more.

    Rows and batches may come in any order within the watermark's delay: a row may open a session, grow one at either end, or
    join two. State holds the open sessions only. The rows of a session are counted, and ``column`` is added up.
    """

    def __init__(self, key: str, ts: str, gap: str, column: str, kind: str = "long"):
        self.key, self.ts, self.gap, self.column, self.numbers = key, ts, micros(gap), column, Numbers(kind)

    def init(self, handle: object) -> None:
        # Open sessions lie within the watermark's delay and a gap, so a key has few of them. Each tells when the key's one timer
        # is pending, so that the state of a key is read and written in one call each.
        self.handle = handle
        self.open = handle.getListState("open", f"start long, last long, cnt long, total {self.numbers.kind}, pending long")

    def _keep(self, sessions: list[tuple], pending: int | None, earliest: int) -> None:
        due = max(min(self._due(s) for s in sessions), earliest)
        if pending is None or due < pending:
            self.handle.registerTimer(int(due))
            pending = due
        self.open.put([(*s, int(pending)) for s in sessions])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        whole = in_order(rows, [self.ts])
        at = as_micros(whole[self.ts])
        values, there = self.numbers.read(whole[self.column])
        begins = np.flatnonzero(np.diff(at, prepend=at[0] - self.gap - 1) > self.gap)
        ends = np.append(begins[1:], len(at))
        sums, seen = self.numbers.sums(values), np.concatenate([[0], np.cumsum(there)])
        new = [
            (int(at[a]), int(at[b - 1]), int(b - a), self.numbers.plain(sums[b] - sums[a]) if seen[b] > seen[a] else None) for a, b in zip(begins, ends)
        ]
        held = [tuple(s) for s in self.open.get()]
        merged: list[tuple] = []
        for session in sorted([s[:4] for s in held] + new, key=lambda s: s[:2]):
            if merged and session[0] <= merged[-1][1] + self.gap:
                start, last, cnt, total = merged[-1]
                both = session[3] if total is None else total if session[3] is None else total + session[3]
                merged[-1] = (start, max(last, session[1]), cnt + session[2], both)
            else:
                merged.append(session)
        self._keep(merged, held[0][4] if held else None, 0)
        yield from ()

    def _due(self, session: tuple) -> int:
        return (session[1] + self.gap) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(s)[:4] for s in self.open.get()]
        over, left = [s for s in held if s[1] + self.gap < reached], [s for s in held if s[1] + self.gap >= reached]
        if left:
            # A timer of now may be asked for again, so one is due after the watermark in any case.
            self._keep(left, None, reached // 1000 + 1)
        else:
            self.open.clear()
        if over:
            yield self._shown(key, sorted(over, key=lambda s: s[:2]))

    def _shown(self, key, sessions: list[tuple]) -> pd.DataFrame:
        start, last, cnt, total = ([s[k] for s in sessions] for k in range(4))
        there = np.array([t is not None for t in total], bool)
        filled = np.array([t if ok else self.numbers.plain(0) for t, ok in zip(total, there)])
        return pd.DataFrame({
            self.key: pd.Series([key[0]] * len(sessions), dtype=object),
            "session_start": as_times(start), "session_end": as_times([x + self.gap for x in last]), "cnt": np.array(cnt, "int64"),
            "total": self.numbers.shown(filled, there) if sessions else pd.Series([], dtype="Int64"),
        })

    def close(self) -> None:
        pass


def closing_sessions(df: DataFrame, key: str, ts: str, gap: str, column: str, kind: str = "long") -> DataFrame:
    """(key, session_start, session_end, cnt, total) of a watermarked stream, appended when the watermark has passed a session."""
    rows = df.select(F.col(key), ts, column)
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, session_start timestamp, session_end timestamp, cnt long, total {kind}"
    return keyed(rows, [key], ClosingSessions(key, ts, gap, column, kind), schema, time_mode="EventTime")


class FirstLabels(StatefulProcessor):
    """How many users of a day and part were first seen at each label, given out anew for labels that changed.

    Rows may come in any order: a user seen earlier than before moves from one label to another. What is written in a batch are
    the users and labels that changed. The state of a day is dropped when the watermark is behind its end.
    """

    def __init__(self, day: str, part: str, label: str, user: str):
        self.day, self.part, self.label, self.user = day, part, label, user

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getMapState("first", "user string", "label string")
        self.fresh = handle.getMapState("fresh", "label string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        whole = pd.concat([r[[self.label, self.user]] for r in rows], ignore_index=True)
        earliest = whole.dropna(subset=[self.user]).groupby(self.user, sort=False)[self.label].min()
        if len(earliest) < FEW_KEYS:
            known = {u: self.first.getValue((u,))[0] for u in earliest.index if self.first.containsKey((u,))}
        else:
            known = {k[0]: v[0] for k, v in self.first.iterator()} if self.first.exists() else {}
        counts = {k[0]: v[0] for k, v in self.fresh.iterator()} if self.fresh.exists() else {}
        change = dict.fromkeys((label for label in whole[self.label].unique() if label not in counts), 0)
        for user, label in earliest.items():
            before = known.get(user)
            if before is None or label < before:
                self.first.updateValue((user,), (label,))
                change[label] = change.get(label, 0) + 1
                if before is not None:
                    change[before] = change.get(before, 0) - 1
        now = {label: counts.get(label, 0) + n for label, n in change.items() if n or label not in counts}
        for label, n in now.items():
            self.fresh.updateValue((label,), (int(n),))
        self.handle.registerTimer(int(pd.Timestamp(key[0]).value // 1_000_000) + 86_400_000)
        days, labels = (pd.Series(x, dtype=object) for x in ([key[0]] * len(now), list(now)))
        yield pd.DataFrame({self.day: days, self.part: np.full(len(now), key[1], "int32"), self.label: labels, "fresh": np.array(list(now.values()), "int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.first.clear()
        self.fresh.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_labels(df: DataFrame, ts: str, user: str, parts: int = 16) -> DataFrame:
    """Changed rows (date_str, part, time_str, fresh) of a watermarked stream: users first seen at a ten-minute label of a day."""
    part = F.pmod(F.xxhash64(user), F.lit(parts)).cast("int")
    rows = df.select(ts, day_label(F.col(ts)).alias("date_str"), part.alias("part"), ten_minute_label(F.col(ts)).alias("time_str"), F.col(user).cast("string").alias("user"))
    processor = FirstLabels("date_str", "part", "time_str", "user")
    return keyed(rows, ["date_str", "part"], processor, "date_str string, part int, time_str string, fresh long", "update", "EventTime")


def cumulated(parts: DataFrame) -> DataFrame:
    """(date_str, time_str, uv) of the newest rows of ``first_labels``: distinct users of the day up to each label."""
    fresh = parts.groupBy("date_str", "time_str").agg(F.sum("fresh").alias("fresh"))
    day = Window.partitionBy("date_str").orderBy("time_str").rowsBetween(Window.unboundedPreceding, 0)
    return fresh.select("date_str", "time_str", F.sum("fresh").over(day).alias("uv"))


def chained_windows(counted: DataFrame, other: DataFrame, key: str, ts: str, tumble: str, final: str, correct: Column) -> DataFrame:
    """Windows of ``counted``, joined to later rows of ``other``, and windows of these; all in one stream, appended.

    ``correct`` is an aggregate of a first window. The watermark goes on from stage to stage: a window gives out its rows at
    its end, the join keeps them for as long as rows of ``other`` may match, and the last windows close behind the join. The
    row time of a window is its last millisecond; Spark's is the last microsecond, so the join's bounds are moved by the rest.
    """
    first = counted.groupBy(key, F.window(ts, tumble)).agg(correct.alias("correct")).select(F.col(key).alias("__key"), "correct", F.window_time("window").alias("rowtime"))
    low, high = F.expr("INTERVAL 999 MICROSECONDS"), F.expr(f"INTERVAL {micros(tumble) - 999} MICROSECONDS")
    later = other.select(key, ts)
    joined = later.join(first, (F.col(key) == F.col("__key")) & (F.col(ts) >= F.col("rowtime") - low) & (F.col(ts) <= F.col("rowtime") + high))
    out = joined.select("rowtime", "correct").groupBy(F.window("rowtime", final).alias("w")).agg(F.sum("correct").alias("correct"))
    return out.select("correct", F.col("w.start").alias("window_start"))
