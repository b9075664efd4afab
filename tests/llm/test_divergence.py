"""The source audit against sums over every term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tidemark.llm.divergence import audit_sources, pieces, run_distance, share, split_terms

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, counts string, row string, v long"


def documents(spark, rows):
    return spark.createDataFrame([(k, t, l, s, 1, "t", "c", "r", 2) for k, (t, l, s) in enumerate(rows)], SCHEMA)


def brute_force(rows, least, top=50):
    seen, counts, groups = defaultdict(int), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = Counter(TERM.findall((text or "").translate(UPPER)))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        for t in terms:
            seen[lang, t] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (l, t), n in seen.items() if l == lang and n >= least]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            above = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", above, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "naïve", "日本", "x", "İ", "ß", *[f"w{'abcdefgh'[k % 8] * (k // 8 + 1)}" for k in range(40)]]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["hot", "hot", "b", "c", None, "é"])
        rows.append((" ,.1@".join(rng.choices(words, k=rng.randrange(0, 40))), lang, source))
    return rows


def test_all_sums(spark):
    rows = corpus(1, 300) + [(None, "en", "silent"), ("", "en", "silent"), ("1 2 3 [] @`{", "xx", "a"), (None, "xx", "b"), ("one word", "yy", "only")]
    rows += [("the same row", "en", "b")] * 40  # repeated rows and ties
    df = documents(spark, rows)
    for least, top in ((1, 50), (5, 3), (30, 50), (1000, 50)):
        assert found(audit_sources(df, least, top)) == brute_force(rows, least, top)


def test_pieces_blocks_and_held_rows(spark):
    rows = corpus(2, 120) + [(" ".join(["long", "Zürich", "x" * 700] * 400), "en", "hot"), ("y" * 5000, "en", "b")]
    df = documents(spark, rows)
    assert found(audit_sources(df, 2, piece=300, held=50, block=7)) == brute_force(rows, 2)


def test_empty_table(spark):
    assert found(audit_sources(documents(spark, []))) == []


def test_pieces_hold_whole_terms():
    text = ("été " * 50 + "a" * 100 + ", " + "日本 " * 20).encode()
    parts = list(pieces(text, 16))
    assert b"".join(parts) == text
    assert sum((TERM.findall(p.decode()) for p in parts), []) == TERM.findall(text.decode())
    assert split_terms(pa.array(["A a, b", ""])).num_rows == 2


def test_runs_are_intersected():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.integers(0, 3, 60), rng.integers(0, 2, 60)
        runs = []
        for dense in (a, b):
            starts = np.flatnonzero(np.concatenate(([True], np.diff(dense) != 0)))
            runs.append((starts, dense[starts]))
        assert run_distance(*runs, 60) == np.abs(a - b).sum()


def test_shares_are_exact(spark):
    cases = [(0, 1, 1), (7, 13, 3), (10**14, 10**15 + 7, 10**6), (0, 0, 4), (9 * 10**14, 9 * 10**14, 5)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    from pyspark.sql import functions as F

    shown = [r[0] for r in df.select(share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    exact = [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in cases]
    assert shown == exact and [int(share(np.array([c]), n, v)[0]) for c, n, v in cases] == exact
