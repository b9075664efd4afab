"""Keyed state on streams: the row-by-row forms of the table operators.

Each processor sees the rows of one key in one micro-batch. Rows are put in order within
the batch; across batches they are taken as they come. The size of a batch, and with it
what a processor holds, is set by the source (``maxFilesPerTrigger``,
``maxOffsetsPerTrigger``). Between batches only the named state is kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from tidemark.functions.times import micros
from tidemark.operators.patterns import Machine

#: Groups of keys of a processor that takes many keys at a time. A group's rows of a micro-batch are one task's work.
GROUPS = 2048


def keyed(
    df: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: StructType | str, mode: str = "append", time_mode: str = "none", event_time: str = ""
) -> DataFrame:
    """Run a processor per key; needs the RocksDB state store (``runtime.state_store``).

    With ``event_time``, a column of the output, the watermark goes on to the next stage. A ``ManyKeys`` processor runs per
    group of keys, as a call of Python and of the state for each key is dear where keys have few rows.
    """
    if isinstance(processor, ManyKeys):
        return processor.run(df, keys, schema, mode)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode="EventTime" if event_time else time_mode, eventTimeColumnName=event_time
    )


def widened(df: DataFrame, **columns: str) -> StructType:
    """The schema of ``df`` with more columns."""
    schema = StructType(list(df.schema.fields))
    for name, kind in columns.items():
        schema.add(name, kind)
    return schema


def in_order(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    parts = list(rows)
    whole = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return whole.sort_values(list(order), kind="stable", ignore_index=True)


class Ordered(StatefulProcessor):
    """A processor over the ordered rows of a batch; subclasses name their state and ``step``."""

    def __init__(self, order: Sequence[str], ttl_ms: int | None = None):
        self.order = list(order)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def step(self, key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # A call of the state and a table are dear for a key with few rows, so neither is made in vain.
        out = self.step(key, in_order(rows, self.order))
        if len(out):
            yield out

    def close(self) -> None:
        pass

    def value(self, handle, name: str, schema: str):
        return handle.getValueState(name, schema, self.ttl_ms)

    def items(self, handle, name: str, schema: str):
        return handle.getListState(name, schema, self.ttl_ms)


class Numbers:
    """Values of one number type, as SQL adds them: nulls are left out, and a sum of nulls only is null.

    ``kind`` is ``long``, ``double`` or a decimal type; it is the type of the state and of the output as well. A long
    column with fractions is an error, as it would be cut off.
    """

    def __init__(self, kind: str):
        self.kind = kind.lower()

    def read(self, column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """The values, nulls as zero, and which of them are there."""
        there = column.notna().to_numpy()
        if self.kind == "double":
            return column.fillna(0).astype("float64").to_numpy(), there
        if self.kind.startswith("decimal"):
            return np.array([v if ok else Decimal(0) for v, ok in zip(column, there)], object), there
        if column.dtype.kind == "f" and (column[there] % 1 != 0).any():
            raise TypeError(f"{column.name} has fractions; use kind='double' or a decimal type")
        return column.fillna(0).astype("int64").to_numpy(), there

    def shown(self, values: np.ndarray, there: np.ndarray) -> pd.Series:
        """Results with null where nothing was added."""
        kind = {"long": "Int64", "double": "float64"}.get(self.kind, "object")
        out = pd.Series(values, dtype=kind if kind != "object" else object)
        return out.where(pd.Series(there), None if kind == "object" else pd.NA if kind == "Int64" else np.nan)

    def plain(self, value):
        """For the state."""
        return value if self.kind.startswith("decimal") else float(value) if self.kind == "double" else int(value)

    def sums(self, values: np.ndarray, start=None) -> np.ndarray:
        """Sums of the first 0, 1, 2, ... values."""
        zero = Decimal(0) if self.kind.startswith("decimal") else 0
        head = np.array([zero if start is None else start], values.dtype)
        return np.concatenate([head, values]).cumsum()


class RunningTotal(Ordered):
    """The total so far on every row; a row whose ``reset`` is true clears it first."""

    def __init__(self, order, column: str, name: str = "total", reset: str | None = None, ttl_ms: int | None = None, kind: str = "long"):
        super().__init__(order, ttl_ms)
        self.column, self.name, self.reset, self.numbers = column, name, reset, Numbers(kind)

    def open(self, handle):
        self.total = self.value(handle, "total", f"total {self.numbers.kind}")

    def step(self, key, rows):
        values, there = self.numbers.read(rows[self.column])
        before = (self.total.get() or (None,))[0]
        sums = self.numbers.sums(values, before)
        totals, known = sums[1:], np.maximum.accumulate(there) | (before is not None)
        if self.reset and (resets := rows[self.reset].fillna(False).astype(bool).to_numpy()).any():
            place = np.arange(len(values))
            since = np.maximum.accumulate(np.where(resets, place, -1))
            seen = np.concatenate([[0], np.cumsum(there)])
            totals = np.where(since < 0, totals, totals - sums[np.maximum(since, 0)])
            known = np.where(since < 0, known, seen[place + 1] > seen[np.maximum(since, 0)])
            self.total.clear()
        if known[-1]:
            self.total.update((self.numbers.plain(totals[-1]),))
        return rows.assign(**{self.name: self.numbers.shown(totals, known)})


class RangeCount(Ordered):
    """Rows of the key from ``span`` before a row up to its time.

    Times in reach are kept in stretches, ``SPREAD`` to a span, so that a batch writes only the stretches of its own rows.
    """

    SPREAD = 64

    def __init__(self, order, ts: str, span: str, name: str = "cnt"):
        super().__init__(order)
        self.ts, self.span, self.name = ts, micros(span), name
        self.width = max(1, self.span // self.SPREAD)

    def open(self, handle):
        self.times = handle.getMapState("times", "stretch long", "at array<long>, n array<long>")

    def step(self, key, rows):
        new = rows[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
        kept = {k[0]: (v[0], v[1]) for k, v in self.times.iterator()} if self.times.exists() else {}
        old, weights = (np.array([x for v in kept.values() for x in v[c]], "int64") for c in (0, 1))
        times, place = np.unique(np.concatenate([old, new]), return_inverse=True)
        number = np.bincount(place, np.concatenate([weights, np.ones(len(new), "int64")]), len(times)).astype("int64")
        upto = np.concatenate([[0], number.cumsum()])
        counts = upto[np.searchsorted(times, new, "right")] - upto[np.searchsorted(times, new - self.span, "left")]
        stretch, oldest = times // self.width, (times[-1] - self.span) // self.width
        for s in kept:
            if s < oldest:
                self.times.removeKey((s,))
        for s in np.unique(new // self.width):
            if s >= oldest:
                here = stretch == s
                self.times.updateValue((int(s),), (times[here].tolist(), number[here].tolist()))
        return rows.assign(**{self.name: counts})


class SlidingCountWindow(Ordered):
    """Fires on every ``slide``-th row over the last ``size`` rows: their number and a sum."""

    def __init__(self, order, column: str, size: int, slide: int, kind: str = "long"):
        super().__init__(order)
        self.column, self.size, self.slide, self.numbers = column, size, slide, Numbers(kind)

    def open(self, handle):
        self.seen = self.value(handle, "seen", "n long")
        self.last = self.items(handle, "last", f"v {self.numbers.kind}")

    def step(self, key, rows):
        before = self.seen.get()[0] if self.seen.exists() else 0
        kept = pd.Series([v[0] for v in self.last.get()] if before and self.size > 1 else [], dtype=object)
        old, old_there = self.numbers.read(kept.astype("float64") if self.numbers.kind == "double" else kept)
        new, new_there = self.numbers.read(rows[self.column])
        values, there = np.concatenate([old.astype(new.dtype), new]), np.concatenate([old_there, new_there])
        sums, counts = self.numbers.sums(values), np.concatenate([[0], there.cumsum()])
        numbers = before + 1 + np.arange(len(rows))
        at = np.flatnonzero(numbers % self.slide == 0)
        ends = at + len(old) + 1
        starts = np.maximum(ends - self.size, 0)
        self.seen.update((int(numbers[-1]),))
        left = slice(-(self.size - 1), None) if self.size > 1 else slice(0, 0)
        self.last.put([(self.numbers.plain(v) if ok else None,) for v, ok in zip(values[left], there[left])] or [(None,)])
        out = rows.iloc[at][[c for c in rows.columns if c not in (*self.order, self.column)]].reset_index(drop=True)
        return out.assign(at_row=numbers[at], n=ends - starts, total=self.numbers.shown(sums[ends] - sums[starts], counts[ends] > counts[starts]))


class CountAverage(Ordered):
    """The integer average of every ``n`` rows, nulls counted as zero; the state is cleared after each."""

    def __init__(self, order, column: str, n: int, name: str = "average"):
        super().__init__(order)
        self.column, self.n, self.name, self.numbers = column, n, name, Numbers("long")

    def open(self, handle):
        self.part = self.value(handle, "part", "cnt long, total long")

    def step(self, key, rows):
        count, total = self.part.get() if self.part.exists() else (0, 0)
        sums = self.numbers.sums(self.numbers.read(rows[self.column])[0]) + total
        numbers = count + np.arange(len(rows) + 1)
        ends = np.flatnonzero((numbers % self.n == 0) & (np.arange(len(numbers)) > 0))
        parts = np.diff(np.concatenate([[0], sums[ends]]))
        left = int(numbers[-1] % self.n)
        if left:
            self.part.update((left, int(sums[-1] - (sums[ends[-1]] if len(ends) else 0))))
        else:
            self.part.clear()
        out = rows.iloc[ends - 1][[c for c in rows.columns if c not in (*self.order, self.column)]]
        return out.assign(**{self.name: (np.sign(parts) * (np.abs(parts) // self.n)).astype("int64")})


class MachineAlerts(Ordered):
    """Rows whose event the key's state does not allow; see ``patterns.state_machine_alerts``."""

    def __init__(self, order, event: str, transitions, initial: str = "Initial", terminal: Sequence[str] = ("Terminal",), ttl_ms: int | None = None):
        super().__init__(order, ttl_ms)
        self.event = event
        self.machine = Machine(transitions, initial, terminal)

    def open(self, handle):
        self.state = self.value(handle, "state", "state int")

    def step(self, key, rows):
        machine = self.machine
        known = {e: i for i, e in enumerate(machine.events)}
        codes = rows[self.event].map(known).fillna(len(machine.events)).astype(int).to_numpy()
        start = self.state.get()[0] if self.state.exists() else 0
        first = np.zeros(len(codes), bool)
        reached = machine.run(codes, first)[:, start]
        before = np.concatenate([[start], reached[:-1]])
        if reached[-1]:
            self.state.update((int(reached[-1]),))
        else:
            self.state.clear()
        bad = ~machine.valid[before, codes]
        return rows[bad].assign(state=np.array(machine.states, object)[before[bad]])


class PreviousAction(Ordered):
    """Adds the action of the row before of the same key."""

    def __init__(self, order, action: str, name: str = "previous", ttl_ms: int | None = None):
        super().__init__(order, ttl_ms)
        self.action, self.name = action, name

    def open(self, handle):
        self.last = self.value(handle, "last", "action string")

    def step(self, key, rows):
        before = self.last.get()[0] if self.last.exists() else None
        actions = rows[self.action].tolist()
        self.last.update((actions[-1],))
        return rows.assign(**{self.name: [before, *actions[:-1]]})


class ManyKeys(StatefulProcessor):
    """A processor over the rows of a group of keys; ``step`` gets them in order, key by key, with the number of each row's key.

    Keys go to Python and come back as text, and null numbers as 0 with a column that tells them, as nulls would turn whole
    numbers of the group into fractions.
    """

    def __init__(self, order: Sequence[str]):
        self.order = list(order)
        self.keys: list[str] = []

    def run(self, df: DataFrame, keys: Sequence[str], schema: StructType | str, mode: str) -> DataFrame:
        self.keys = list(keys)
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        whole = [c for c in self.needed() if isinstance(df.schema[c].dataType, IntegralType) and c not in keys]
        self.sorted_by = [n for c in self.order for n in ([missing(c), c] if c in whole else [c])]
        shown = {c: F.coalesce(c, F.lit(0)) if c in whole else F.col(c).cast("string") if c in keys else F.col(c) for c in dict.fromkeys([*keys, *self.needed()])}
        group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).cast("int").alias("key_group")
        rows = df.select(group, *[c.alias(n) for n, c in shown.items()], *[F.col(c).isNull().alias(missing(c)) for c in whole])
        texts = StructType([StructField(f.name, StringType()) if f.name in keys else f for f in schema.fields])
        out = rows.groupBy("key_group").transformWithStateInPandas(statefulProcessor=self, outputStructType=texts, outputMode=mode, timeMode="none")
        return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    def needed(self) -> list[str]:
        """The columns that ``step`` needs besides the keys."""
        return list(self.order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = self.step(pd.concat(list(rows), ignore_index=True))
        if len(out):
            yield out

    def step(self, rows: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def missing(column: str) -> str:
    """The column that tells where another one is null. Names that begin with an underscore don't come through to Python."""
    return f"missing_{column}"


def numbered(columns: Sequence[pd.Series]) -> np.ndarray:
    """Rows with the same values in all columns get the same number, nulls being equal."""
    number = np.zeros(len(columns[0]), "int64")
    for column in columns:
        own, names = pd.factorize(column, use_na_sentinel=False)
        number = pd.factorize(number * max(len(names), 1) + own)[0]
    return number


class SequenceMatch(ManyKeys):
    """Stored first elements are matched and cleared by the next second one.

    Rows carry ``is_first`` and ``is_second``, as ``joins.rule_join`` adds them, and the
    stream is keyed by rule as well. What waits in a group of keys is one list.
    """

    def __init__(self, order, item: str):
        super().__init__(order)
        self.item = item

    def needed(self):
        return [*dict.fromkeys([*self.order, self.item]), "is_first", "is_second"]

    def init(self, handle):
        names = ", ".join(f"k{n} string" for n in range(len(self.keys)))
        self.waiting = handle.getListState("waiting", f"{names}, item long")

    def step(self, rows):
        held = list(self.waiting.get())
        known = [pd.Series([h[n] for h in held], dtype=object) for n in range(len(self.keys))]
        who = numbered([pd.concat([k, rows[c].astype(object)], ignore_index=True) for c, k in zip(self.keys, known)])
        held_by, held_item = who[: len(held)], np.array([h[-1] for h in held], "int64")
        rows = rows.assign(**{"__who": who[len(held) :]}).sort_values(["__who", *self.sorted_by], kind="stable", ignore_index=True)
        who, items = rows["__who"].to_numpy(), rows[self.item].to_numpy()
        firsts = np.flatnonzero(rows["is_first"].fillna(False).to_numpy(dtype=bool))
        seconds = np.flatnonzero(rows["is_second"].fillna(False).to_numpy(dtype=bool))

        def next_second(places: np.ndarray, owners: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
            """The second element of the same key behind (right) or from (left) each place, and where there is one."""
            found = np.searchsorted(seconds, places, side)
            there = found < len(seconds)
            there[there] = who[seconds[found[there]]] == owners[there]
            return seconds[found[there]], there

        # The second element that ends the waiting of each first one: the next later row, for stored ones the first of the key.
        ends, matched = next_second(firsts, who[firsts], "right")
        frees, freed = next_second(np.searchsorted(who, held_by), held_by, "left")
        left = firsts[~matched]
        used = np.concatenate([firsts, ends, frees])
        if missing(self.item) in rows.columns and rows[missing(self.item)].to_numpy(bool)[used].any():
            raise ValueError(f"{self.item} is null")
        if freed.any():
            kept = [tuple(held[k]) for k in np.flatnonzero(~freed)] + self._waiting(rows, items, left)
            if kept:
                self.waiting.put(kept)
            else:
                self.waiting.clear()
        elif len(left):
            self.waiting.appendList(self._waiting(rows, items, left))
        at = np.concatenate([frees, ends])
        out = rows.iloc[at][[c for c in self.keys if c in self.key_columns]].reset_index(drop=True)
        return out.assign(first_id=np.concatenate([held_item[freed], items[firsts[matched]]]).astype("int64"), second_id=items[at].astype("int64"))

    def _waiting(self, rows: pd.DataFrame, items: np.ndarray, left: np.ndarray) -> list[tuple]:
        texts = [[None if pd.isna(v) else v for v in rows[c].iloc[left]] for c in self.keys]
        return list(zip(*texts, (int(i) for i in items[left])))

    key_columns: Sequence[str] = ()

    def keyed_by(self, *columns: str) -> "SequenceMatch":
        self.key_columns = columns
        return self


class DeltaTrigger(Ordered):
    """Fires when ``measure`` grew by more than ``threshold`` since the last firing.

    Emits the firing row with the highest ``best`` of the rows at most ``keep`` old, the
    earliest of them on ties. Rows out of reach leave the state.
    """

    def __init__(self, order, ts: str, measure: str, threshold: float, keep: str, best: str, item: str):
        super().__init__(order)
        self.ts, self.measure, self.threshold = ts, measure, threshold
        self.keep, self.best, self.item = micros(keep), best, item

    def open(self, handle):
        self.base = self.value(handle, "base", "base double")
        self.recent = self.items(handle, "recent", "at long, best double, item long")

    def step(self, key, rows):
        base = (self.base.get() or (None,))[0]
        before = base
        recent = [tuple(r) for r in self.recent.get()] if base is not None else []
        at = rows[self.ts].astype("datetime64[us]").astype("int64").tolist()
        fired, tops = [], []
        for i, (now, value, best, item) in enumerate(zip(at, rows[self.measure], rows[self.best], rows[self.item])):
            # Only a falling sequence of candidates can still become the highest.
            while recent and recent[-1][1] < best:
                recent.pop()
            recent.append((now, float(best), int(item)))
            if base is None:
                base = value
            elif value - base > self.threshold:
                base = value
                recent = [r for r in recent if r[0] >= now - self.keep]
                fired.append(i)
                tops.append(recent[0])
        if base != before:
            self.base.update((float(base),))
        self.recent.put([r for r in recent if r[0] >= at[-1] - self.keep])
        out = rows.iloc[fired]
        return out.assign(top_best=[t[1] for t in tops], top_item=np.array([t[2] for t in tops], "int64"))


class FirstSeen(Ordered):
    """Only the first row of each key, remembered for ``ttl_ms`` of processing time if given."""

    def open(self, handle):
        self.seen = self.value(handle, "seen", "seen boolean")

    def step(self, key, rows):
        if self.seen.exists():
            return rows.iloc[:0]
        self.seen.update((True,))
        return rows.iloc[:1]


class RecordCheck(Ordered):
    """Several typed states in one processor.

    Keeps the last record (a struct of ``record``, given as columns and types), a labelled counter (a pair) and a value of
    either text or flag; tells for each row whether ``field`` of the record before it differed from ``expected``.
    """

    def __init__(self, order, record: dict[str, str], field: str, expected: str):
        super().__init__(order)
        self.fields, self.kinds = list(record), list(record.values())
        self.field, self.expected = field, expected

    def open(self, handle):
        self.record = self.value(handle, "record", ", ".join(f"`{f}` {k}" for f, k in zip(self.fields, self.kinds)))
        self.counter = self.value(handle, "counter", "label string, n int")
        self.either = self.value(handle, "either", "left string, right boolean")

    def step(self, key, rows):
        before = self.record.get()[self.fields.index(self.field)] if self.record.exists() else None
        earlier = [before, *rows[self.field].tolist()[:-1]]
        label, n = self.counter.get() if self.counter.exists() else ("rows", 0)
        self.counter.update((label, int(n) + len(rows)))
        wrong = [e is not None and e != self.expected for e in earlier]
        self.either.update((None, True) if any(wrong) else ("ok", None))
        self.record.update(tuple(rows[self.fields].astype(object).iloc[-1]))
        return rows.assign(wrong_before=wrong, seen=int(n) + 1 + np.arange(len(rows)))


class TriggeredTotal(StatefulProcessor):
    """A never-ending window per key that fires at event-time marks, ``every`` apart.

    A firing emits the rows and the sum so far; with ``purge`` it starts over.
    """

    def __init__(self, key: str, ts: str, column: str, every: str, purge: bool):
        self.key, self.ts, self.column, self.every, self.purge = key, ts, column, micros(every) // 1000, purge

    def init(self, handle):
        self.handle = handle
        self.part = handle.getValueState("part", "cnt long, total long")

    def handleInputRows(self, key, rows, timerValues):
        count, total = self.part.get() if self.part.exists() else (0, 0)
        marks = set()
        for batch in rows:
            count, total = count + len(batch), total + int(batch[self.column].sum())
            millis = batch[self.ts].astype("datetime64[ms]").astype("int64")
            marks.update(((millis // self.every + 1) * self.every).tolist())
        self.part.update((int(count), int(total)))
        for mark in marks:
            self.handle.registerTimer(int(mark))
        yield pd.DataFrame({self.key: [], "fired_at": [], "cnt": [], "total": []})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.part.exists():
            return
        count, total = self.part.get()
        if self.purge:
            self.part.clear()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        yield pd.DataFrame({self.key: [key[0]], "fired_at": [fired], "cnt": [count], "total": [total]})

    def close(self):
        pass
