"""The trie of conversations against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from tidemark.llm.prefixtrie import grow, in_order, median_first, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, key string, depth long, said string, n_convs long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", "k", 7, "s", 9) for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute_force(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said[conv].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in said.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole = own.get(base, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, d == len(whole)))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(c for c, _ in found), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(found), children.get(node, 0), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(c for c, end in found if end))).encode()).hexdigest(),
        )
        for node, found in members.items()
    )


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.collect())


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 900), n):
        for k in range(rng.choice([1, 2, 3, 3, 8])):
            rows.append((c, rng.choice([k, k, k, 1, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "é 日本", "", None, f"t{rng.randrange(9)}"])))
    return rows


def test_all_nodes(spark):
    rows = conversations(1, 200)
    rows += [(None, 1, "user", "nobody's"), (5, 1, "user", "again"), (5, 1, "user", "again"), (100000, 0, "a", "b"), (7, None, None, None)]
    df = table(spark, rows)
    for turns, ids in ((1 << 18, 1 << 15), (9, 2), (1, 1), (60, 3)):
        assert found(prefix_trie(df, turns, ids)) == brute_force(rows)


def test_copies_are_dealt_out(spark):
    rows = [(100 * c, k, "user", f"turn {k}") for c in range(300) for k in range(4)] + [(100 * c, 9, "user", f"own {c % 3}") for c in range(0, 300, 2)]
    df = table(spark, rows).repartition(5)
    for turns in (40, 1 << 18):
        assert found(prefix_trie(df, turns, 7)) == brute_force(rows)


def test_conversations_without_turns_and_long_ones(spark):
    # Nobody has turns behind the head that a missing base would have lent.
    ids = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 6 > 1][:4]
    rows = [(c, 0, "user", "only") for c in ids] + [(2500, k, "user", f"{k % 7}") for k in range(700)] + [(2600, k, "user", f"{k % 7}") for k in range(650)]
    result = found(prefix_trie(table(spark, rows), 100, 2))
    assert result == brute_force(rows)
    assert [r for r in result if r[1] == 0][0][3] == 6


def test_empty_tables(spark):
    assert found(prefix_trie(table(spark, []))) == []
    assert found(prefix_trie(table(spark, [(None, 0, "user", "x")]))) == []


def test_trees_are_balanced_and_ordered():
    assert sorted(median_first(13)) == list(range(13)) and next(median_first(13)) == 6
    paths = [np.array(p) for p in sorted({(k // 40, k // 3 % 11, k) for k in range(1000)})]
    tree, ends = grow(paths)
    assert [tuple(p) for p in paths] == [_path(tree, e) for e in ends]
    order = in_order(tree)
    assert sorted(order) == list(range(len(tree.turn))) and [e for e in order if e in set(ends)] == ends

    def height(at):
        return 1 + max(height(tree.low[at]) if tree.low[at] else 0, height(tree.high[at]) if tree.high[at] else 0)

    assert height(tree.equal[0]) <= 6  # 25 first turns


def _path(tree, at):
    out = []
    while at:
        out.append(tree.turn[at])
        at = tree.parent[at]
    return tuple(reversed(out))
