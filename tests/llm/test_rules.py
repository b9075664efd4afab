"""Quality rules, line dedup, licenses, URLs and shards against plain Python."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, frame, prose, text
from tidemark.llm import queries as Q
from tidemark.llm.licenses import TEMPLATES, Template, license_spans, scan_licenses
from tidemark.llm.linededup import dedup_lines, drop_repeated_lines, keep_bitmaps
from tidemark.llm.quality import RULES, STOP_WORDS, Rule, judge_quality, keep_good
from tidemark.llm.sharding import shard_by_bytes
from tidemark.llm.urls import judge_urls, rules_table

SPACE = " \t\n\x0b\x0c\r"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def measured(t):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
    lines = [x for x in (t or "").split("\n") if x.strip(SPACE)]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n = collections.Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(5)}
    symbols = sum((t or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words)


def test_quality_counts(spark):
    good = text(prose(1, 300))
    texts = [*AWKWARD, good, good, "be " * 40, good + "\n" + good, "a b c d e f a b c d e g a b c d e", "### " * 30, " ".join(prose(2, 21000)), "w " * 9 + "w", "\n".join(["same line here"] * 8 + [good])]
    got = judge_quality(frame(spark, texts)).orderBy("doc_id").collect()
    for row, t in zip(got, texts, strict=True):
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == measured(t), t
        assert row.kept <= (not row.base_failed)
    assert [r.kept for r in got if texts[r.doc_id] == "### " * 30] == [False]


def test_rules_are_a_table(spark):
    rows = judge_quality(frame(spark, ["a b c d e f g h i j k", "aaaaaa bbbbbbb " * 6 + "c d"]), [Rule("short", "chars_per_word", 3.0)]).orderBy("doc_id").collect()
    assert rows[0].failed_rules == ["short"] and not rows[0].kept
    assert len({r.name for r in RULES}) == len(RULES) and "the" in STOP_WORDS


def test_keep_good_keeps_rows_and_columns(spark):
    good = text([*prose(1, 100), *["the", "of", "and"] * 3])
    docs = frame(spark, [good, None, "", good, "be " * 50], ids=[5, 1, 2, 5, None])
    kept = keep_good(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [5, 5]
    assert keep_good(docs.limit(0)).count() == 0
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().toString()


def lines_by_hand(rows):
    key = lambda x: x.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})
    holders = collections.defaultdict(set)
    big = 1 << 63
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(big if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == (big if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def test_lines(spark):
    rng = random.Random(3)
    pool = [" ".join(prose(k, 6)) for k in range(12)] + ["", "short", "  ", "Éa long line of text", "éa long line of text", "A LONG LINE OF ASCII", "\ta long line of ascii \r", "0123456789", "012345678"]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(1, 25))) for _ in range(60)] + AWKWARD + ["\n".join(pool * 300)]
    ids = [rng.randint(0, 40) if rng.random() < 0.5 else 100 + k for k in range(len(texts))]
    ids[3] = ids[8] = None
    rows = list(zip(ids, texts)) + [(ids[0], texts[0])]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    got = dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept"))
    assert sorted(map(tuple, got.collect()), key=repr) == lines_by_hand(rows)
    assert dedup_lines(docs.limit(0)).count() == 0


def test_keep_runs_name_lines(spark):
    common = "this line is in both texts"
    docs = frame(spark, [common, "own line number one\n" + common + "\n" + common + "\nx\n" + common + "\nlast one"])
    assert [r.keep_runs for r in keep_bitmaps(docs).collect()] == [[1, 2, 1, 1]]
    after = drop_repeated_lines(docs)
    assert after.columns == docs.columns
    assert [(r.doc_id, r.text, r.n_chars) for r in after.orderBy("doc_id").collect()] == [(0, common, len(common)), (1, "own line number one\nx\nlast one", 30)]


def licenses_by_hand(t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    hits = [(k, p.label) for p in TEMPLATES if p.base for k in range(len(words)) if words[k : k + len(p.words)] == p.words]
    return len(words), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


def test_licenses(spark):
    rng = random.Random(4)
    parts = ["GNU General Public License", "gnu general", "Apache-License", "CC BY", "cc", "by", "MIT (License)", "License", "word", "é", "mit license mit license"]
    texts = [*AWKWARD, *[" ".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(40)], "mit license " * 4000]
    texts.append(texts[-2])
    got = scan_licenses(frame(spark, texts)).orderBy("doc_id").collect()
    for row, t in zip(got, texts, strict=True):
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == licenses_by_hand(t), t
        assert 0 <= row.score <= 1 and set(filter(None, row.base_labels.split(","))) <= set(filter(None, row.labels.split(",")))
    doubled = scan_licenses(frame(spark, ["cc by", "cc by", None], ids=[7, 7, None])).collect()
    assert sorted((r.doc_id is None, r.n_base) for r in doubled) == [(False, 1), (False, 1), (True, 0)]
    assert scan_licenses(frame(spark, [])).count() == 0


def test_license_spans_merge_diagonals(spark):
    template = [Template("permission is hereby granted free of charge to any person", "mit", False, 0.8)]
    near = "so Permission is hereby, freely: granted free of charge to any person here"
    rows = license_spans(frame(spark, [near, "permission is hereby granted"]), template).where("template is not null").collect()
    assert [(r.doc, r.start, r.score >= 0.8) for r in rows] == [(0, 1, True)]


def test_whole_license_texts(spark):
    """Texts of more than 63 words, in prose, with words put in, left out and replaced, and the halves of two licenses."""
    rng = random.Random(9)

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            at = rng.randrange(len(words))
            rng.choice([lambda: words.insert(at, "inserted"), lambda: words.pop(at), lambda: words.__setitem__(at, "replaced")])()
        return words

    templates = [t for t in TEMPLATES if len(t.words) >= 63]
    assert {t.label for t in templates} == {"mit", "isc", "bsd"}
    texts, want = [], []
    for t in templates:
        for n in (0, 3, 8):
            texts.append(" ".join([*prose(rng.randrange(99), 40), *edited(t.words, n), *prose(rng.randrange(99), 30)]))
            want.append(t.label)
        texts.append(" ".join([*t.words[: len(t.words) // 2], *prose(7, 200)]))
        want.append(None)
    texts += [f"{t.text}\n" * 2 for t in templates]
    want += [t.label for t in templates]
    long = {k for k, t in enumerate(TEMPLATES) if len(t.words) >= 63}
    spans = collections.defaultdict(list)
    for r in license_spans(frame(spark, texts)).where("template is not null").collect():
        if r.template in long:
            spans[r.doc].append((TEMPLATES[r.template].label, r.end - r.start, r.score))
    for doc, label in enumerate(want):
        assert {x for x, _, _ in spans[doc]} == ({label} if label else set()), doc
        assert len(spans[doc]) == (2 if doc >= len(want) - len(templates) else 1 if label else 0)
    assert all(0.8 <= score <= 1 for found in spans.values() for _, _, score in found)


def url_by_hand(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if not rest[len(host) : len(host) + 1] in "?#" else ""
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


@pytest.mark.parametrize("ranges", [1, 5])
def test_urls(spark, ranges):
    rng = random.Random(ranges)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.b.example.com", "example.net", "net", "com", "notexample.com", "x.org:80", "", "a..com", "éx.com"]
    paths = ["", "/", "/en/", "/en/x?y=/es/", "/en", "/es/1#z", "/fr/", "/en/en/", "?q", "#f", "/é/"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + [None, "", "no scheme", "://", "http://a://b.com/en/", "x" * 5000 + "://example.com/en/" + "y" * 5000]
    urls += ["http://example.com/en/same"] * 50
    rules = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("allow", "example.com", "/en/en/"), ("block", "x.org:80", ""), ("block", "b.example.com", ""))
    pages = spark.createDataFrame([(k if k % 7 else None, u, "h", "k") for k, u in enumerate(urls)], "page_id long, url string, host string, key string")
    got = judge_urls(pages, rules_table(spark, rules), ranges=ranges).collect()
    want = [(k if k % 7 else None, *url_by_hand(u, rules)) for k, u in enumerate(urls)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert judge_urls(pages.limit(0), rules_table(spark, rules)).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules_table(spark, rules).limit(0)).collect()} == {"allow"}


def test_a_path_that_many_hosts_share(spark):
    """All home pages below one domain are one key for its rules."""
    hosts = [f"h{k}.{d}" for k in range(300) for d in ("com", "net", "www.example.com", "org")]
    urls = [f"https://{h}{p}" for h in hosts for p in ("/", "/es/x", "/en/")]
    pages = spark.createDataFrame([(k, u, "h", "s", "p") for k, u in enumerate([*urls, *urls[:50]])], "page_id long, url string, html string, suffix string, path string")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, rules_table(spark)).collect()}
    assert len(got) == len(urls) + 50
    for k, u in enumerate([*urls, *urls[:50]]):
        host, path = u[8:].split("/", 1)
        want = (None, "allow")
        if host.endswith(".www.example.com") and path == "en/":
            want = ("www.example.com/en/", "allow")
        elif host.endswith(".com"):
            want = ("com/", "allow")
        elif host.endswith(".net") and path == "es/x":
            want = ("net/es/", "block")
        assert got[k] == want, u


def test_shards_split_only_where_needed(spark):
    texts = [*AWKWARD, *["z" * (k % 50) for k in range(400)], "y" * 5000]
    docs = frame(spark, texts)
    rows = shard_by_bytes(docs, limit=1000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    held = collections.defaultdict(list)
    for r in rows:
        held[r.shard].append(r.n_bytes)
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())
    for shard, sizes in held.items():
        assert sum(sizes) <= 1000 or len(sizes) == 1
        assert not any(other != shard and other.startswith(shard) for other in held)
    # A directory entry is split only if it is too large: no shard fits together with all that shares its parent.
    for shard in held:
        parent = [n for other, sizes in held.items() for n in sizes if other.startswith(shard[:-1])]
        assert shard == "" or (sum(parent) > 1000 and len(parent) > 1)
    assert {(r.shard, r.shard_rows) for r in shard_by_bytes(docs.limit(3)).collect()} == {("", 3)}
    assert shard_by_bytes(docs.limit(0)).count() == 0


def test_equal_rows_are_dealt_out_too(spark):
    rows = shard_by_bytes(frame(spark, ["w" * 100] * 200, ids=[9] * 200), limit=1000).collect()
    held = collections.Counter(r.shard for r in rows)
    assert len(rows) == 200 and max(held.values()) <= 10 and all(r.shard_bytes == 100 * held[r.shard] for r in rows)


def test_several_groups_of_equal_rows_keep_their_own_shards(spark):
    ids = [k for k in (9, 10, None, 11) for _ in range(100)]
    rows = shard_by_bytes(frame(spark, ["w" * 100] * 300 + ["v" * 400] * 100, ids=ids), limit=1000).collect()
    held = collections.defaultdict(list)
    for r in rows:
        held[r.shard].append(r)
    assert len(rows) == 400
    for shard, found in held.items():
        assert {(r.shard_rows, r.shard_bytes) for r in found} == {(len(found), sum(r.n_bytes for r in found))}
        assert sum(r.n_bytes for r in found) <= 1000 and len({r.doc_id for r in found}) == 1
        assert not any(other != shard and other.startswith(shard) for other in held)
    assert len(held) < 150


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_queries_equal_their_sql(spark, name):
    from oracle import compare, duck

    folder = "/root/testdata/sf0.001"
    assert compare(Q.QUERIES[name](spark, folder), duck(folder), Q.ORACLES[name]) is None
