"""Rule matches on streams, where a call of Python takes many keys, against plain Python."""

import random
from collections import defaultdict

import pytest

from conftest import rows
from test_stream_state import batches, cut, progress
from tidemark.operators import joins
from tidemark.streaming import processors as ps

RULES = [("r", "a", "b"), ("s", "b", "b"), ("t", "c", "a")]


def matches(spark, parts, schema="at long, user long, kind string"):
    rules = spark.createDataFrame(RULES, "rule string, first string, second string")
    tagged = joins.rule_join(batches(spark, parts, schema), rules, "kind")
    matcher = ps.SequenceMatch(["at"], "at").keyed_by("user", "rule")
    return ps.keyed(tagged, ["user", "rule"], matcher, "user long, rule string, first_id long, second_id long")


def expected(data):
    waiting, out = defaultdict(list), []
    for at, user, kind in data:
        for rule, first, second in RULES:
            if kind == second:
                out += [(user, rule, i, at) for i in waiting.pop((rule, user), [])]
            if kind == first:
                waiting[rule, user].append(at)
    return sorted(out, key=repr)


@pytest.mark.parametrize("groups", [1, 7, 2048])
def test_matches_over_batches(spark, monkeypatch, groups):
    monkeypatch.setattr(ps, "GROUPS", groups)
    rng, start = random.Random(groups), 2**60 + 1
    users = [1, 2, None, 2**60 + 1, 2**60 + 2, *range(10, 40)]
    data = [(start + k, rng.choice(users), rng.choice("abcd")) for k in range(900)]
    got, _ = progress(matches(spark, [random.Random(1).sample(p, len(p)) for p in cut(data, 4)]))
    assert rows(got) == expected(data) != []


def test_a_call_takes_many_keys(spark, monkeypatch):
    monkeypatch.setattr(ps, "GROUPS", 5)
    data = [(k, k % 300, "ab"[k // 300 % 2]) for k in range(1200)]
    got, said = progress(matches(spark, cut(data, 2)))
    assert rows(got) == expected(data) != []
    # One list for each group of keys, not one for each user and rule.
    assert max(p["numRowsTotal"] for p in said) <= 2 * 5


def test_rows_without_a_user_do_not_split_other_keys(spark):
    """Rows of a key that came to Python in several Arrow batches were taken in several calls if there were keys of null."""
    rng, key = random.Random(3), "spark.sql.execution.arrow.maxRecordsPerBatch"
    data = [(k, rng.choice([None, None, *range(6)]), rng.choice("abc")) for k in range(900)]
    before = spark.conf.get(key, None)
    spark.conf.set(key, "40")
    try:
        got, _ = progress(matches(spark, [rng.sample(data, len(data))]))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    assert rows(got) == expected(data) != []


def test_a_null_item_is_an_error(spark):
    with pytest.raises(Exception, match="at is null"):
        progress(matches(spark, [[(1, 1, "a"), (None, 1, "b")]]))
