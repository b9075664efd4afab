"""When a window on a stream gives out its result: after so many rows, at marks of event time, at its end; with or without purging.

A trigger is made of parts that combine, ``either(count(10), at_end())`` or ``purging(count(5))``. What a part has to remember
is kept with its window in state; marks of time are timers of the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.times import micros
from tidemark.streaming.event_time import as_micros, as_times
from tidemark.streaming.processors import Numbers, in_order, keyed

#: The only window of a key where none is given, and the end of it.
EVER = 0


@dataclass(frozen=True)
class Trigger:
    """The parts: rows between firings, event or processing time between firings, firing at the end, and emptying the window."""

    rows: int | None = None
    every: str | None = None
    clock: str | None = None
    end: bool = False
    purge: bool = False


def count(rows: int) -> Trigger:
    """Fires at every so-manieth row of a window."""
    return Trigger(rows=rows)


def at_end() -> Trigger:
    """Fires when the watermark has passed the window's end."""
    return Trigger(end=True)


def early(every: str) -> Trigger:
    """Fires when the watermark passes multiples of a time, for windows that had rows since the mark before."""
    return Trigger(every=every)


def processing_time(every: str) -> Trigger:
    """Fires so long after a row came to a window without a pending firing."""
    return Trigger(clock=every)


def either(*parts: Trigger) -> Trigger:
    """Fires when one of the parts does."""
    whole = Trigger()
    for part in parts:
        whole = replace(whole, **{n: v for n, v in vars(part).items() if v not in (None, False)})
    if whole.clock and (whole.every or whole.end):
        raise ValueError("a stream has timers of event time or of processing time, not both")
    return whole


def purging(trigger: Trigger) -> Trigger:
    """Empties the window whenever the trigger fires."""
    return replace(trigger, purge=True)


class TriggeredWindows(StatefulProcessor):
    """Tumbling windows of a key, or one that never ends, with rows counted and ``column`` added up.

    A firing gives out what the window holds: all of its rows so far, or with purging those since the firing before; an empty
    window gives out nothing. A window leaves the state at its end, a never-ending one stays.
    """

    def __init__(self, key: str, ts: str, order: list[str], column: str, size: str | None, trigger: Trigger, kind: str = "long"):
        self.key, self.ts, self.order, self.column = key, ts, list(order), column
        self.size = micros(size) if size else None
        self.trigger, self.numbers = trigger, Numbers(kind)

    def init(self, handle) -> None:
        # since: rows after the last firing by count; added: whether rows came after the last firing of any kind. A key has few
        # open windows. Each tells when the key's one timer is pending, so that the state of a key is read and written in one call
        # each.
        self.handle = handle
        self.windows = handle.getListState("windows", f"start long, cnt long, total {self.numbers.kind}, since long, added boolean, pending long")

    def _held(self) -> tuple[dict[int, tuple], int | None]:
        """The windows, and the time of the pending timer."""
        rows = [tuple(w) for w in self.windows.get()]
        return {w[0]: w[1:-1] for w in rows}, rows[0][-1] if rows else None

    def _keep(self, held: dict[int, tuple], pending: int | None, due: int | None) -> None:
        if due is not None and (pending is None or due < pending):
            self.handle.registerTimer(int(due))
            pending = int(due)
        if held:
            self.windows.put([(start, *w, pending) for start, w in held.items()])
        else:
            self.windows.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        whole = in_order(rows, self.order)
        at = as_micros(whole[self.ts])
        starts = at // self.size * self.size if self.size else np.full(len(at), EVER)
        values, there = self.numbers.read(whole[self.column])
        fired, (held, pending) = [], self._held()
        for start in np.unique(starts).tolist():
            own = np.flatnonzero(starts == start)
            fired += self._add(held, start, values[own], there[own])
        if not self.trigger.clock:
            due = self._due(held, int(at.min()) // 1000)
        elif pending is None:
            due = timerValues.getCurrentProcessingTimeInMs() + micros(self.trigger.clock) // 1000
        else:
            due = None
        self._keep(held, pending, due)
        if fired:
            yield self._shown(key, fired)

    def _add(self, held: dict[int, tuple], start: int, values: np.ndarray, there: np.ndarray) -> list[tuple]:
        cnt, total, since, added = held.get(start, (0, None, 0, False))
        n, rows = len(values), self.trigger.rows
        sums, seen = self.numbers.sums(values), np.concatenate([[0], np.cumsum(there)])
        # Rows of this batch behind which the window fires, counted from 1.
        at = np.arange(rows - since, n + 1, rows) if rows else np.zeros(0, int)
        begins = np.concatenate([[0], at[:-1]]) if self.trigger.purge else np.zeros(len(at), int)
        fired = []
        for k, (low, high) in enumerate(zip(begins.tolist(), at.tolist())):
            carried = k == 0 or not self.trigger.purge
            part = self.numbers.plain(sums[high] - sums[low]) if seen[high] > seen[low] else None
            before = total if carried else None
            both = before if part is None else part if before is None else before + part
            fired.append((start, high - low + (cnt if carried else 0), both, "count"))
        low = int(at[-1]) if len(at) and self.trigger.purge else 0
        cnt, total = (0, None) if low else (cnt, total)
        part = self.numbers.plain(sums[n] - sums[low]) if seen[n] > seen[low] else None
        total = total if part is None else part if total is None else total + part
        since = (since + n) % rows if rows else 0
        held[start] = (int(cnt + n - low), total, int(since), bool(added or not (len(at) and at[-1] == n)))
        return fired

    def _due(self, held: dict[int, tuple], after: int) -> int | None:
        """The earliest millisecond at which a window ends, or a mark behind ``after`` finds new rows."""
        due = [(start + self.size) // 1000 for start in held] if self.size and (self.trigger.end or self.trigger.every) else []
        if self.trigger.every:
            step = micros(self.trigger.every) // 1000
            due += [(max(start // 1000, after) // step + 1) * step for start, w in held.items() if w[3]]
        return min(due) if due else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock = self.trigger.clock
        reached = expiredTimerInfo.getExpiryTimeInMs() if clock else timerValues.getCurrentWatermarkInMs()
        fired, (held, _) = [], self._held()
        for start, (cnt, total, since, added) in sorted(held.items()):
            over = self.size is not None and not clock and (start + self.size) // 1000 <= reached
            by_end = over and self.trigger.end
            by_time = (clock or self.trigger.every) and added and (clock or start // 1000 < reached)
            if cnt and (by_end or by_time):
                fired.append((start, cnt, total, "end" if by_end else "time"))
                held[start] = (0, None, since, False) if self.trigger.purge else (cnt, total, since, False)
            if over:
                del held[start]
        # A window with new rows sets the clock again; of event time, what is due next is behind the watermark.
        due = None if clock else self._due(held, reached)
        self._keep(held, None, None if due is None else max(due, reached + 1))
        if fired:
            yield self._shown(key, fired)

    def _shown(self, key, fired: list[tuple]) -> pd.DataFrame:
        start, cnt, total, cause = ([f[k] for f in fired] for k in range(4))
        there = np.array([t is not None for t in total], bool)
        filled = np.array([t if ok else self.numbers.plain(0) for t, ok in zip(total, there)])
        return pd.DataFrame({
            self.key: pd.Series([key[0]] * len(fired), dtype=object), "window_start": as_times(start), "cnt": np.array(cnt, "int64"),
            "total": self.numbers.shown(filled, there) if fired else pd.Series([], dtype="Int64"), "cause": pd.Series(cause, dtype=object),
        })

    def close(self) -> None:
        pass


def triggered_windows(df: DataFrame, key: str, ts: str, order: list[str], column: str, size: str | None, trigger: Trigger, kind: str = "long") -> DataFrame:
    """(key, window_start, cnt, total, cause) for every firing; window_start is 1970 for the window that never ends.

    Marks of event time and ends need a watermark on ``df``.
    """
    rows = df.select(*dict.fromkeys([key, ts, *order, column]))
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, window_start timestamp, cnt long, total {kind}, cause string"
    processor = TriggeredWindows(key, ts, order, column, size, trigger, kind)
    mode = "ProcessingTime" if trigger.clock else "EventTime" if trigger.end or trigger.every else "none"
    return keyed(rows, [key], processor, schema, time_mode=mode)
