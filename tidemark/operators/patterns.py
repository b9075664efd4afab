"""State per key: machines, sequences, repeats and comparisons over ordered rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tidemark.operators.aggs import running_sum
from tidemark.operators.history import (
    _ONE, _SLICE, _SPLITS, lowest, previous_row, prefix_scan, slice_history,
)
from tidemark.operators.joins import rule_join
from tidemark.runtime import cut_lineage

#: Changes of rules in one span of the order; more if there are more rules.
CHANGES_PER_SPAN = 32


class Machine:
    """A finite state machine as an array: row = state, column = event, last = unknown event."""

    def __init__(self, transitions: Sequence[tuple[str, str, str]], initial: str, terminal: Sequence[str]):
        self.states = [initial, *sorted({s for a, _, b in transitions for s in (a, b)} - {initial})]
        self.events = sorted({e for _, e, _ in transitions})
        at = {s: i for i, s in enumerate(self.states)}
        known = {e: i for i, e in enumerate(self.events)}
        shape = (len(self.states), len(self.events) + 1)
        self.next = np.tile(np.arange(shape[0])[:, None], (1, shape[1]))
        self.valid = np.zeros(shape, bool)
        for state, event, then in transitions:
            self.next[at[state], known[event]] = 0 if then in terminal else at[then]
            self.valid[at[state], known[event]] = True

    def code(self, event: str) -> Column:
        pairs = [F.lit(x) for i, e in enumerate(self.events) for x in (e, i)]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(event)), F.lit(len(self.events)))

    def run(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each row and each state before its run: the state after the row.

        Runs begin where ``starts`` is set. The rows are laid out as a square; steps are
        composed along all its lines at once, then the lines are joined up.
        """
        n, k = len(codes), len(self.states)
        width = int(np.ceil(np.sqrt(max(n, 1))))
        lines = -(-n // width)
        after = np.tile(np.arange(k), (lines * width, 1))
        after[:n] = self.next[:, codes].T
        after = after.reshape(lines, width, k)
        begins = np.zeros(lines * width, bool)
        begins[:n] = starts
        begins = begins.reshape(lines, width)
        for j in range(1, width):
            both = np.take_along_axis(after[:, j], after[:, j - 1], axis=1)
            after[:, j] = np.where(begins[:, j, None], after[:, j], both)
        begun = np.logical_or.accumulate(begins, axis=1)
        before = np.tile(np.arange(k), (lines, 1))
        for i in range(1, lines):
            last = after[i - 1, -1]
            before[i] = last if begun[i - 1, -1] else last[before[i - 1]]
        joined = np.take_along_axis(after, np.broadcast_to(before[:, None], after.shape), axis=2)
        return np.where(begun[:, :, None], after, joined).reshape(-1, k)[:n]


def _marked(sliced: DataFrame, keys, order) -> DataFrame:
    history = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    return sliced.withColumn("__starts", F.row_number().over(history) == 1)


def state_machine_alerts(df: DataFrame, keys: Sequence[str], order: Sequence[str], event: str, transitions: Sequence[tuple[str, str, str]], initial: str = "Initial", terminal: Sequence[str] = ("Terminal",), **slicing) -> DataFrame:
    """Rows whose event is not allowed in the key's current state, with that ``state``.

    An event that is not allowed leaves the state as it is; a terminal state starts over.
    A slice of a long history is a function from the state before it to the state after
    it; those functions are chained per key, so that slices can then run side by side.
    """
    machine = Machine(transitions, initial, terminal)
    keys, order = list(keys), list(order)
    slim = df.select(*keys, *order, event).withColumn("__code", machine.code(event))
    sliced = slice_history(slim, keys, order, **slicing)
    keys_ = keys or [_ONE]
    size = len(machine.states)
    key_schema = sliced.select(*keys_, _SLICE).schema

    def whole_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, moved = None, np.arange(size)
        for batch in batches:
            starts = batch["__starts"].to_numpy(bool)
            after = machine.run(batch["__code"].to_numpy(int), starts)
            ends = np.flatnonzero(starts) - 1
            if last is not None and starts[0]:
                yield last.assign(moved=[moved.tolist()])
            ids = batch[[*keys_, _SLICE]]
            if not starts[0]:
                head = ends[0] + 1 if len(ends) else len(batch)
                after[:head] = after[:head][:, moved]
            done = ends[ends >= 0]
            if len(done):
                yield ids.iloc[done].assign(moved=after[done].tolist())
            last, moved = ids.iloc[[-1]], after[-1]
        if last is not None:
            yield last.assign(moved=[moved.tolist()])

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(_SLICE)
        state, before = 0, []
        for moved in group["moved"]:
            before.append(state)
            state = int(moved[state])
        return group.drop(columns="moved").assign(__enters=before)

    hot = _marked(sliced.where(F.col(_SPLITS)).select(*keys_, *order, _SLICE, "__code"), keys_, order)
    moves = hot.select(*keys_, _SLICE, "__code", "__starts").mapInPandas(
        whole_slices, key_schema.add("moved", ArrayType(IntegerType()))
    )
    entering = moves.groupBy(*keys_).applyInPandas(chain, sliced.select(*keys_, _SLICE).schema.add("__enters", IntegerType()))
    renamed = {k: f"__e{i}" for i, k in enumerate([*keys_, _SLICE])}
    entering = entering.withColumnsRenamed(renamed)
    same = F.lit(True)
    for k, r in renamed.items():
        same = same & sliced[k].eqNullSafe(entering[r])
    entered = sliced.join(F.broadcast(entering), same, "left").drop(*renamed.values())
    ready = _marked(entered, keys_, order).withColumn("__enters", F.coalesce("__enters", F.lit(0)))
    states = np.array(machine.states, object)
    columns = [*keys, *order, event]

    def alerts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = 0
        for batch in batches:
            codes = batch["__code"].to_numpy(int)
            starts = batch["__starts"].to_numpy(bool)
            after = machine.run(codes, starts)
            position = np.arange(len(codes))
            head = np.maximum.accumulate(np.where(starts, position, -1))
            enters = np.where(head >= 0, batch["__enters"].to_numpy(int)[head], state)
            reached = after[position, enters]
            before = np.where(starts, enters, np.concatenate([[state], reached[:-1]]))
            bad = ~machine.valid[before, codes]
            yield batch.loc[bad, columns].assign(state=states[before[bad]])
            state = reached[-1]

    return ready.mapInPandas(alerts, df.select(*columns).schema.add("state", StringType()))


def consecutive_pattern(df: DataFrame, keys: Sequence[str], order: Sequence[str], action: str, patterns: DataFrame, first: str = "first", second: str = "second", **slicing) -> DataFrame:
    """Rows that, with the row before of the same key, form one of the patterns."""
    pairs = previous_row(df, keys, order, {"__previous": action}, **slicing)
    wanted = patterns.select(F.col(first).alias("__first"), F.col(second).alias("__second"), *[
        c for c in patterns.columns if c not in (first, second)
    ])
    hit = (pairs["__previous"] == wanted["__first"]) & (pairs[action] == wanted["__second"])
    return pairs.join(wanted, hit).withColumnsRenamed({"__first": first, "__second": second}).drop("__previous")


def rule_sequence_match(items: DataFrame, rules: DataFrame, keys: Sequence[str], order: Sequence[str], field: str, rule: str = "rule", first: str = "first", second: str = "second", **slicing) -> DataFrame:
    """A row per stored ``first`` item that a later ``second`` item of the same rule releases.

    A ``second`` item releases and clears all items stored before it, so each ``first``
    item is matched by the next ``second`` one after it: a running value from the back,
    with no pairs to build. An item that is both releases others before it is stored.
    """
    return _next_second(rule_join(items, rules, field, first, second), [*keys, rule], order, field, **slicing)


def _next_second(tagged: DataFrame, keys: Sequence[str], order: Sequence[str], field: str, **slicing) -> DataFrame:
    """Rows with ``is_first`` that a later row with ``is_second`` follows, with the next of them as ``matched``."""
    at = F.struct(*order, field)
    ahead = prefix_scan(tagged, keys, order, {"matched": lowest(F.when(F.col("is_second"), at))}, inclusive=False, backward=True, **slicing)
    return ahead.where(F.col("is_first") & F.col("matched").isNotNull()).drop("is_first", "is_second")


def changing_rule_match(items: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], field: str, rule: str = "rule", first: str = "first", second: str = "second", **slicing) -> DataFrame:
    """``rule_sequence_match`` under rules that change: an item is judged by the version of its place in the order.

    ``changes`` has the order's columns too; a change at the place of an item comes before it. A version is in force until the
    next one of its rule. Items stay stored when their rule changes.

    The order is cut into spans of about as many changes as there are rules, ``CHANGES_PER_SPAN`` at least, and a version goes
    to each span it is in force in. So an item meets the versions of its own span only, and the copies of versions are about
    as many as the changes.
    """
    begins = F.struct(*[F.col(c) for c in order])
    kept = cut_lineage(changes.select(*order, rule, first, second), "changes")
    until = F.lead(begins).over(Window.partitionBy(rule).orderBy(*order))
    span = {"rows_per_slice": max(CHANGES_PER_SPAN, kept.select(rule).distinct().count()), "sample": kept.select(*order)}

    def placed(df: DataFrame, name: str) -> DataFrame:
        return slice_history(df, [], order, **span).withColumnRenamed(_SLICE, name).drop(_SPLITS, _ONE)

    started = placed(kept.withColumns({"__until": until, "__from": begins}), "__first_span").select(
        rule, first, second, "__from", "__until", "__first_span", *[F.col(f"__until.{c}").alias(c) for c in order]
    )
    versions = placed(started, "__last_span").drop(*order)
    # The last version of a rule stays in force; the number of the last span is that of a place behind all changes.
    last = kept.agg(F.max(begins).alias("__end")).select(*[F.col(f"__end.{c}").alias(c) for c in order])
    last = placed(last, "__end_span").select("__end_span")
    upto = F.when(F.col("__until").isNull(), F.col("__end_span")).otherwise(F.col("__last_span"))
    spread = versions.crossJoin(F.broadcast(last)).withColumn("__span", F.explode(F.sequence("__first_span", upto))).drop("__first_span", "__last_span", "__end_span")
    kinds = spread.withColumn("__kind", F.explode(F.array_distinct(F.array(first, second))))
    found = placed(items, "__span")
    at = F.struct(*[found[c] for c in order])
    in_force = (found["__span"] == kinds["__span"]) & (found[field] == kinds["__kind"])
    in_force = in_force & (kinds["__from"] <= at) & (kinds["__until"].isNull() | (at < kinds["__until"]))
    tagged = found.join(kinds, in_force).withColumns({"is_first": F.col(field) == F.col(first), "is_second": F.col(field) == F.col(second)})
    tagged = tagged.select(*items.columns, rule, "is_first", "is_second")
    # Read by the choice of slices, by their totals and by the scan.
    return _next_second(cut_lineage(tagged, "tagged"), [*keys, rule], order, field, **slicing)


def running_length(df: DataFrame, keys: Sequence[str], text: str, order: Sequence[str], name: str = "total_length", **slicing) -> DataFrame:
    return running_sum(df, keys, F.length(text).cast("long"), order, name, **slicing)


def dedupe(df: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """One row per key; on a watermarked stream, among rows the watermark delay apart."""
    return df.dropDuplicatesWithinWatermark(list(keys)) if within else df.dropDuplicates(list(keys))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deduplication that keeps the earliest row."""
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return kept.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


def compare_with_previous_day(df: DataFrame, keys: Sequence[str], ts: str, metric: Column, name: str = "today") -> DataFrame:
    """Daily value per key beside that of the calendar day before (null if it had no rows)."""
    daily = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(metric.alias(name))
    days = Window.partitionBy(*keys).orderBy("day")
    follows = F.lag("day").over(days) == F.date_sub("day", 1)
    return daily.withColumn("previous_day", F.when(follows, F.lag(name).over(days)))


def count_per_key_and_partition(df: DataFrame, key: str, partition: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows per key, and rows per task (or per value of ``partition``)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    where = F.spark_partition_id() if partition is None else partition
    return per_key, df.groupBy(where.alias("partition")).agg(F.count(F.lit(1)).alias("cnt"))
