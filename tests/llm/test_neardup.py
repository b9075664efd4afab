import random
import tracemalloc
import uuid
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from tests.llm.helpers import frame, prose, text
from tidemark.llm import common
from tidemark.llm import neardup as N


def test_links_of_long_texts_take_little_memory():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12000).astype(np.uint64)
    sets = []
    for k in range(120):
        own = np.unique(np.where(rng.random(len(base)) < (0.05 if k % 3 else 0.5), rng.integers(0, 1 << 63, len(base)).astype(np.uint64), base))
        sets.append((own, np.ones(len(own))))
    block = np.arange(120) % 2
    held = sum(s[0].nbytes + s[1].nbytes for s in sets)
    tracemalloc.start()
    links = N.links_between(sets, block, list(range(120)), 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All texts that have lost 0.05 of the base are one class of 0.8, the others are alone.
    linked = {x for pair in links for x in pair}
    assert linked == {k for k in range(120) if k % 3} and len(links) == len(linked) - 1
    assert peak < 2 * held


def test_blocks_hold_few_shingles(spark):
    rows = [(1, k, 0 if k < 30 else k, 200_000) for k in range(60)]
    dealt = N.deal_blocks(spark.createDataFrame(rows, "family long, node long, root long, size long")).collect()
    blocks = {}
    for r in dealt:
        blocks.setdefault(r.block, set()).add(r.node)
    assert len(blocks) == 12 and {n for b in blocks.values() for n in b} == set(range(60))
    # Every outer node meets every other one and every inner one.
    met = {}
    for r in dealt:
        met.setdefault((r.low, r.high), set()).add(r.node)
    pairs = {(a, b) for nodes in met.values() for a in nodes for b in nodes if a < b}
    assert {(a, b) for a in range(60) for b in range(max(a + 1, 30), 60)} <= pairs


def test_python_gets_texts_in_small_batches(spark):
    def told(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    long = spark.range(0, 3000, 1, 1).selectExpr("repeat('abcdefghij', 1000) AS text")
    with N.bounded(spark):
        got = long.mapInArrow(told, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 3000 and max(r.bytes for r in got) < 1 << 23
    assert all(spark.conf.get(k, None) is None for k in N.BATCHES | N.CLEANUP)


def test_texts_of_near_copies_are_not_stored_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "SLICE", 3, raising=False)
    monkeypatch.setattr(common, "shared_folder", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    rng, texts = random.Random(4), []
    for group in range(12):
        base = prose(50 + group, 200)
        for _ in range(10):
            own = list(base)
            own[rng.randrange(200)] = f"q{rng.randrange(10**9)}"
            texts.append(text(own))
    found = {r.doc_id: r.class_id for r in N.near_duplicates(frame(spark, texts)).collect()}
    assert found == {k: k // 10 * 10 for k in range(120)}
    files = list(Path(tmp_path).rglob("*.parquet"))
    assert files and not any("text" in pq.read_schema(f).names for f in files)


def test_texts_are_fetched_once_for_each_row_wanted(spark, monkeypatch):
    monkeypatch.setattr(N, "MARK_BITS", 6)
    texts = [(k // 2, k % 2, f"text {k}") for k in range(300)] * 3
    wanted = [(k // 2, k % 2, tag) for k in range(0, 300, 7) for tag in range(1 + k % 3)]
    got = N.texts_of(spark.createDataFrame(texts, "doc long, version long, text string"), spark.createDataFrame(wanted, "doc long, version long, tag int"))
    assert sorted(tuple(r) for r in got.select("doc", "version", "tag", "text").collect()) == sorted((d, v, t, f"text {2 * d + v}") for d, v, t in wanted)
