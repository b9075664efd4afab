"""Control rows on streams: rules, resets and time marks that concern every key.

Keyed state is seen by one key only. So keys are gathered in buckets, which are the groups of the stream, and each control row
is copied to all buckets: state of a bucket has one copy of what control rows said, and entries by key. Control rows take their
place in the order of the rows; one at the place of a row comes before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import NumericType, StructType

from tidemark.streaming.processors import Numbers, keyed

#: Groups of keys, each with a copy of the control rows. A group's rows of a micro-batch are one task's work.
BUCKETS = 32
#: Items in one entry of a list in state, so that a longer list is never written again as a whole.
CHUNK = 256
#: Control rows of a batch that a task holds before it drops those that say nothing.
FEW_CONTROL = 1 << 16


def with_control(items: DataFrame, control: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Items in buckets by key, and each control row in all buckets; one stream, so that both share its batches.

    Numbers that the other side lacks are 0, other columns null. The key becomes text, as nulls would turn long keys into
    fractions on their way to Python.
    """
    items = items.withColumn(key, F.col(key).cast("string"))
    names = dict.fromkeys([*items.columns, *control.columns])

    def filled(df: DataFrame, other: StructType) -> DataFrame:
        kinds = {f.name: f.dataType for f in other.fields}
        missing = {n: F.lit(0 if isinstance(kinds[n], NumericType) else None).cast(kinds[n]) for n in names if n not in df.columns}
        return df.withColumns(missing).select(*names) if missing else df.select(*names)

    placed = filled(items, control.schema).withColumns({"bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"), "is_control": F.lit(False)})
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    return placed.unionByName(filled(control, items.schema).withColumns({"bucket": every, "is_control": F.lit(True)}))


class Controlled(StatefulProcessor):
    """A processor over the rows of a bucket in order; ``step`` gets the items and the control rows, both with their places."""

    def __init__(self, order: Sequence[str]):
        self.order = list(order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts, control, least = [], [], 0
        for batch in rows:
            marks = batch["is_control"].to_numpy(bool)
            parts.append(batch[~marks])
            control.append(self.condensed(batch[marks]))
            if sum(map(len, control)) > 2 * least + FEW_CONTROL:
                control = [self.condensed(pd.concat(control, ignore_index=True))]
                least = len(control[0])
        whole = pd.concat([*parts, *control], ignore_index=True)
        del parts, control
        whole = whole.sort_values([*self.order, "is_control"], ascending=[*[True] * len(self.order), False], kind="stable", ignore_index=True)
        marks = whole["is_control"].to_numpy(bool)
        yield self.step(whole[~marks], whole[marks])

    def condensed(self, control: pd.DataFrame) -> pd.DataFrame:
        """The control rows, in any order, without those that say nothing beside the others."""
        return control

    def step(self, items: pd.DataFrame, control: pd.DataFrame) -> pd.DataFrame:
        """The index of both frames tells the places."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def places_before(control: pd.DataFrame, items: pd.DataFrame) -> np.ndarray:
    """For each item the number of control rows before it."""
    return np.searchsorted(control.index.to_numpy(), items.index.to_numpy())


class ChangingRules(Controlled):
    """Pairs of items under rules that change while the stream runs.

    A rule row (``rule``, ``first``, ``second``) puts a version in force, for the items behind it. A first item waits; the next
    item of the same key that is second under the version of that time ends the waiting, also of items that an older version
    stored. Waiting items are kept in entries of ``CHUNK``; only the last entry of a key and rule is written again.
    """

    SCHEMA = "rule string, key string, first_id long, second_id long"

    def __init__(self, order: Sequence[str], key: str, field: str, item: str):
        super().__init__(order)
        self.key, self.field, self.item = key, field, item

    def init(self, handle):
        self.rules = handle.getMapState("rules", "rule string", "first string, second string")
        self.counts = handle.getMapState("counts", "rule string, key string", "n long")
        self.waiting = handle.getMapState("waiting", "rule string, key string, chunk long", "items array<long>")

    def step(self, items, control):
        known = {k[0]: tuple(v) for k, v in self.rules.iterator()} if self.rules.exists() else {}
        before, kinds, ids = places_before(control, items), items[self.field].to_numpy(object), items[self.item].to_numpy("int64")
        users, names = pd.factorize(items[self.key].astype(object), use_na_sentinel=False)
        names = [None if pd.isna(n) else n for n in names]
        found = []
        for rule in dict.fromkeys([*known, *control["rule"]]):
            own = np.flatnonzero((control["rule"] == rule).to_numpy())
            firsts, seconds = ([known.get(rule, (None, None))[c], *control[n].to_numpy(object)[own]] for c, n in ((0, "first"), (1, "second")))
            version = np.searchsorted(own, before)
            is_first = np.array(firsts, object)[version] == kinds
            is_second = np.array(seconds, object)[version] == kinds
            found.append(self._match(rule, is_first.astype(bool), is_second.astype(bool), users, names, ids))
            if len(own):
                self.rules.updateValue((rule,), (firsts[-1], seconds[-1]))
        pairs = [p for part in found for p in part]
        return pd.DataFrame(pairs, columns=["rule", "key", "first_id", "second_id"]).astype({"first_id": "int64", "second_id": "int64"})

    def _match(self, rule, is_first, is_second, users, names, ids) -> list[tuple]:
        at = np.flatnonzero(is_first | is_second)
        at = at[np.argsort(users[at], kind="stable")]
        user, first, second = users[at], np.flatnonzero(is_first[at]), np.flatnonzero(is_second[at])
        pairs = []
        # The first second item of each key releases what waits in state.
        for k in second[np.unique(user[second], return_index=True)[1]] if len(second) else []:
            name = names[user[k]]
            pairs += [(rule, name, i, ids[at[k]]) for i in self._released(rule, name)]
        follows = np.searchsorted(second, first, "right")
        there = follows < len(second)
        there[there] = user[second[follows[there]]] == user[first[there]]
        pairs += [(rule, names[u], a, b) for u, a, b in zip(user[first[there]], ids[at[first[there]]], ids[at[second[follows[there]]]])]
        left = first[~there]
        for u in np.unique(user[left]):
            self._store(rule, names[u], ids[at[left[user[left] == u]]].tolist())
        return pairs

    def _released(self, rule, name) -> list[int]:
        if not self.counts.containsKey((rule, name)):
            return []
        n = self.counts.getValue((rule, name))[0]
        out = []
        for chunk in range(-(-n // CHUNK)):
            out += self.waiting.getValue((rule, name, chunk))[0]
            self.waiting.removeKey((rule, name, chunk))
        self.counts.removeKey((rule, name))
        return out

    def _store(self, rule, name, new: list[int]) -> None:
        n = self.counts.getValue((rule, name))[0] if self.counts.containsKey((rule, name)) else 0
        chunk, open_ = n // CHUNK, []
        if n % CHUNK:
            open_ = list(self.waiting.getValue((rule, name, chunk))[0])
        whole = open_ + new
        for k in range(0, len(whole), CHUNK):
            self.waiting.updateValue((rule, name, chunk + k // CHUNK), (whole[k : k + CHUNK],))
        self.counts.updateValue((rule, name), (n + len(new),))


class TotalsSinceReset(Controlled):
    """The total of each key since the last control row, which clears all keys.

    A control row only raises the epoch of its bucket. Entries of older epochs count as gone, and are dropped in state when the
    epoch has changed; rows of other keys need not come for that.
    """

    def __init__(self, order: Sequence[str], key: str, column: str, name: str = "total", kind: str = "long"):
        super().__init__(order)
        self.key, self.column, self.name, self.numbers = key, column, name, Numbers(kind)

    def init(self, handle):
        self.totals = handle.getMapState("totals", "key string", f"total {self.numbers.kind}")

    def step(self, items, control):
        epoch = places_before(control, items)
        values, there = self.numbers.read(items[self.column])
        users, names = pd.factorize(items[self.key].astype(object), use_na_sentinel=False)
        names = [None if pd.isna(n) else n for n in names]
        order = np.lexsort((np.arange(len(users)), epoch, users))
        user, part = users[order], epoch[order]
        opens = np.flatnonzero((np.diff(user, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
        group = np.cumsum(np.isin(np.arange(len(order)), opens)) - 1
        sums = self.numbers.sums(values[order])
        carried = [None] * len(opens)
        for g, k in enumerate(opens):
            if part[k] == 0 and self.totals.containsKey((names[user[k]],)):
                carried[g] = self.totals.getValue((names[user[k]],))[0]
        zero = values[:0].sum() if not len(values) else values[0] * 0
        start = np.array([zero if c is None else c for c in carried], values.dtype)
        seen = np.concatenate([[0], np.cumsum(there[order])])
        totals, known = np.empty_like(values), np.zeros(len(values), bool)
        totals[order] = sums[1:] - sums[opens][group] + start[group]
        known[order] = (seen[1:] > seen[opens][group]) | np.array([c is not None for c in carried], bool)[group] if len(opens) else known[order]
        if len(control):
            self.totals.clear()
        last = np.flatnonzero(np.diff(user, append=-1) != 0)
        for k in last:
            if part[k] == len(control) and known[order[k]]:
                self.totals.updateValue((names[user[k]],), (self.numbers.plain(totals[order[k]]),))
        return items.drop(columns=["is_control"]).assign(**{self.name: self.numbers.shown(totals, known).to_numpy()})


class MarkedTime(Controlled):
    """The watermark that marker rows set, for each row: the highest ``ts`` of the markers up to it, null before the first.

    ``is_late`` tells whether the row's own time is before that watermark.
    """

    def __init__(self, order: Sequence[str], ts: str):
        super().__init__(order)
        self.ts = ts

    def init(self, handle):
        self.highest = handle.getValueState("highest", "at long")

    def condensed(self, control):
        """Markers that raise the watermark; each marker is in every bucket, so what a task holds must not grow with all of them."""
        ordered = control.sort_values(self.order, kind="stable", ignore_index=True)
        marks = ordered[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
        before = np.maximum.accumulate(np.concatenate([[np.iinfo("int64").min], marks]))[:-1]
        return ordered[marks > before]

    def step(self, items, control):
        start = self.highest.get()[0] if self.highest.exists() else np.iinfo("int64").min
        marks = control[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
        running = np.maximum.accumulate(np.concatenate([[start], marks]))
        if len(marks):
            self.highest.update((int(running[-1]),))
        at = running[places_before(control, items)]
        own = items[self.ts].astype("datetime64[us]").astype("int64").to_numpy()
        there = at > np.iinfo("int64").min
        shown = pd.Series(np.where(there, at, 0).astype("datetime64[us]")).where(pd.Series(there)).to_numpy()
        return items.drop(columns=["is_control"]).assign(watermark=shown, is_late=there & (own < at))


def controlled(stream: DataFrame, processor: Controlled, schema: StructType | str) -> DataFrame:
    """Run a processor over the buckets of ``with_control``."""
    return keyed(stream, ["bucket"], processor, schema)
