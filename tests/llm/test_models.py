"""Language ID, pieces, near-dedup, passages, decontamination and the pipeline."""

import collections
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

import corpus_pipeline
from tests.llm.helpers import AWKWARD, frame, prose, text
from tidemark.llm import decontaminate as D
from tidemark.llm import neardup as N
from tidemark.llm import queries as Q
from tidemark.llm.components import components
from tidemark.llm.langid import fit_language_model, predict_languages
from tidemark.llm.passages import repeated_passages, shared_passages, shared_spans, without_passages
from tidemark.llm.pieces import Alignment, encode_pieces, read_model
from tidemark.llm.words import hash_words, shingles

SMALL = "/root/testdata/sf0.001"
MODEL = read_model(public_tokenizers.path("piece_bpe_32k.model"))


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = Q.op1_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in told]) > 0.97 and all(0 <= r.score <= 1 for r in told)


def test_a_language_of_one_text_is_learned(spark):
    """Rows are picked one by one, not a text with all of its copies."""
    for k, t in enumerate(["the cat sat on the mat", "once upon a time", "what a lovely day", "no news is good news"]):
        rows = [(i, t, "en") for i in range(2000)] + [(None, t, "en")] * 500 + [(5000 + i, f"der Hund und die Katze {i} schlafen", "de") for i in range(50)]
        labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        for table in (labelled, labelled.drop("doc_id")):
            model = fit_language_model(table, fit_rows=200)
            got = predict_languages(spark.createDataFrame([(1, t), (2, "die Katze und der Hund")], "doc_id long, text string"), model).collect()
            assert {r.doc_id: r.lang_pred for r in got} == {1: "en", 2: "de"}, (k, table.columns)


def test_language_edges(spark):
    docs = frame(spark, [*AWKWARD, "der die das und", "the of and to"]).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") % 3 == 0, "de"))
    model = fit_language_model(docs)
    told = {r.doc_id: r for r in predict_languages(docs, model).collect()}
    assert [told[k].lang_pred for k in (0, 1, 2, 7)] == ["und"] * 4 and told[3].lang_pred in ("en", "de")
    nothing = fit_language_model(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in predict_languages(docs, nothing).collect()} == {("und", 0.0)}
    assert predict_languages(docs.limit(0), model).count() == 0


def test_pieces_equal_the_library(spark):
    texts = [*AWKWARD, " two  blanks ", text(prose(1, 500)), "naïve ☃ 漢字 \U0001f600", text(prose(2, 20000)), "▁ already", "a\nb\tc"]
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    rows = encode_pieces(frame(spark, texts, [k // 2 for k in range(len(texts))]), MODEL, keep=("doc_id", "row")).collect()
    assert len(rows) == len(texts)
    for row, t in zip(rows, texts, strict=True):
        t, raw = t or "", (t or "").encode()
        assert row.ids == library.encode(t) and row.decoded == library.decode(row.ids)
        assert len(row.starts) == len(row.ids) == len(row.ends)
        if raw:
            assert row.starts[0] == 0 and row.ends[-1] == len(raw) and row.ends[:-1] == row.starts[1:]
            for i, a, b in zip(row.ids, row.starts, row.ends):
                piece = library.id_to_piece(i)
                if not library.is_byte(i):
                    shown = raw[a:b].decode().replace(" ", "▁")
                    assert piece == shown or (a == 0 and piece == "▁" + shown)
    assert encode_pieces(frame(spark, []), MODEL).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_alignment_follows_the_character_map(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=rule != "identity", escape_whitespaces=True)
    spec = sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec
    align = Alignment(spec)
    for t in ["plain text", "ﬁne ｆｕｌｌ Ⅳ", "  many   blanks  ", "é é ①②", "カﾞ ㌔", "Straße ÀÉ", "a\u00a0b\tc", "x"]:
        normal, places = align(t.encode())
        assert normal.decode() == library.normalize(t), (rule, t)
        assert len(places) == len(normal) + 1 and (np.diff(places) >= 0).all() and places[-1] <= len(t.encode())


def test_weighted_samples_agree_like_the_sets():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    for share in (1.0, 0.8, 0.5):
        b = np.sort(np.concatenate((a[: int(400 * share)], rng.integers(0, 1 << 63, 400 - int(400 * share)).astype(np.uint64))))
        x, y = ((s, np.where(s % np.uint64(3) == 0, 0.5, 1.0)) for s in (a, b))
        same = np.mean(N.sample_weighted(*x) == N.sample_weighted(*y))
        assert abs(same - N.weighted_jaccard(x, y)) < 0.17


def test_links_between_blocks():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    sets = []
    for _ in range(60):
        own = np.where(rng.random(40) < 0.09, rng.integers(0, 1 << 63, 40).astype(np.uint64), base)
        unique = np.unique(own)
        sets.append((unique, np.where(unique % np.uint64(5) == 0, 0.4, 1.0)))
    for block in (np.zeros(60, int), np.arange(60) % 2):
        pairs = {(a, b) for a in range(60) for b in range(a) if (block.max() == 0 or block[a] != block[b]) and N.weighted_jaccard(sets[a], sets[b]) >= 0.8}
        got = N.links_between(sets, block, list(range(60)), 0.8)
        assert {(max(p), min(p)) for p in got} <= pairs and len(got) < 60

        def groups(edges):
            label = list(range(60))
            for _ in range(60):
                for a, b in edges:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        assert groups(got) == groups(pairs)


def classes(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.class_id, set()).add(r.doc_id)
    return {frozenset(v) for v in found.values()}


def test_near_duplicates(spark):
    base, other = prose(1, 300), prose(2, 300)
    changed = [*base[:100], "changed", *base[101:]]
    texts = [text(base), text(base).upper(), text(changed), text(other), None, None, "", "", "...", "a b", "A, b!", text(base[:150]), text(base)]
    got = N.near_duplicates(frame(spark, texts))
    assert classes(got) == {frozenset(x) for x in ({0, 1, 2, 12}, {3}, {4}, {5}, {6, 7}, {8}, {9, 10}, {11})}
    assert {r.doc_id for r in got.where("keeps").collect()} == {0, 3, 4, 5, 6, 8, 9, 11}
    left = N.drop_near_duplicates(frame(spark, [texts[0], texts[0], texts[3]], [1, 1, 2]))
    assert left.columns == frame(spark, []).columns and sorted(r.doc_id for r in left.collect()) == [1, 2]
    assert N.near_duplicates(frame(spark, [])).count() == 0


def test_chain_and_large_group(spark):
    rng = random.Random(5)
    base = prose(7, 200)
    texts = []
    for _ in range(150):
        own = list(base)
        for k in rng.sample(range(200), 2):
            own[k] = f"q{rng.randint(0, 10**9)}"
        texts.append(text(own))
    chain, step = [], prose(9, 200)
    for k in range(8):
        chain.append(text(step))
        step = [*step[8:], *prose(100 + k, 8)]
    got = classes(N.near_duplicates(frame(spark, [*texts, *chain, text(prose(11, 200))])))
    assert got == {frozenset(range(150)), frozenset(range(150, 158)), frozenset({158})}


def test_near_duplicates_with_shared_and_missing_ids(spark):
    base, other = prose(1, 300), prose(2, 300)
    near = [*base[:100], "changed", *base[101:]]
    # Id 1 and the missing id have foreign texts besides; they link nothing, and every link between the right texts is found.
    texts = [text(other), text(base), text(near), text(prose(3, 300)), text(other[:100] + ["changed"] + other[101:]), text(prose(4, 300)), text(near), text(near)]
    ids = [1, 1, 2, None, None, 5, None, None]
    named = {t: k for k, t in enumerate(texts[:6])}
    for order in (range(8), range(7, -1, -1)):
        docs = frame(spark, [texts[k] for k in order], [ids[k] for k in order]).repartition(3)
        got = N.near_duplicates(docs)
        versions = {r.version: named[r.text] for r in docs.select(N.text_key(F.col("text")).alias("version"), "text").collect()}
        found = {}
        for r in got.select("class_id", "class_size", "version").collect():
            found.setdefault((r.class_id, r.class_size, versions[r.version] in (1, 2)), set()).add(versions[r.version])
        assert found == {(1, 4, True): {1, 2}, (1, 2, False): {0, 4}, (None, 1, False): {3}, (5, 1, False): {5}}
        assert sorted(named[r.text] for r in N.drop_near_duplicates(docs).collect()) in ([0, 1, 3, 5], [0, 2, 3, 5])


def test_a_third_of_a_table_is_linked_as_plain_similarity_tells(spark):
    """A third of the rows are 0.80 to 0.90 similar to the first one; half of the shingles that differ are theirs alone."""
    rng, base, other = random.Random(8), prose(7, 200, size=4000), prose(8, 200, size=4000)
    texts = [" ".join(base)]
    for k in range(1199):
        own, n = list(base), rng.choice((3, 4))
        for at in rng.sample(range(2, 33), n):
            own[6 * at] = f"q{rng.randint(0, 10**9)}"
        texts.append(" ".join(own))
    texts += [" ".join([*prose(5000 + k, 30, size=4000), *other[:20]]) for k in range(2400)]
    plain = [set(zip(*[t.split()[i:] for i in range(5)])) for t in texts[:1200]]
    near = [k for k in range(1, 1200) if 0.8 <= len(plain[0] & plain[k]) / len(plain[0] | plain[k]) <= 0.9]
    assert len(near) == 1199
    docs = frame(spark, texts)
    weights, _ = N.inverse_frequencies(docs)
    idf = lambda t: N._weighted(shingles(hash_words([t.encode()]))[0], weights)
    first = idf(texts[0])
    assert all(N.weighted_jaccard(first, idf(texts[k])) >= 0.8 for k in near)
    found = {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()}
    assert {found[k] for k in near} == {0} and all(found[k] == k for k in range(1200, 3600))


def test_copies_and_a_few_strays_are_dealt_out_about_once(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_NODES", 16)

    def dealt(copies, strays):
        rows = [(1, k, 7) for k in range(copies)] + [(1, 10**6 + k, 100 + k) for k in range(strays)] + [(2, 5, 5), (2, 6, 5)]
        return N.deal_blocks(spark.createDataFrame(rows, "family long, node long, root long"))

    assert dealt(200, 3).count() <= 200 + 3 * 15 and dealt(400, 3).count() <= 2 * dealt(200, 3).count()
    rows = dealt(100, 40).collect()
    meet = collections.defaultdict(set)
    for r in rows:
        assert r.family == 1
        meet[r.low, r.high].add(r.node)
    outer = [10**6 + k for k in range(40)]
    together = {(a, b) for nodes in meet.values() for a in nodes for b in nodes}
    assert all((a, b) in together for a in outer for b in [*outer, *range(100)])


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(k, k + 1) for k in range(500, 560)] + [(9, 9)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_passages(spark):
    passage, short = prose(50, 70), prose(51, 40)
    own = [prose(k, 200) for k in range(20, 26)]
    texts = [
        text(own[0][:90] + passage + own[0][90:]), text(own[1][:13] + passage + own[1][13:]), text(own[2] + short), text(short + own[3]),
        None, "", "few words", text(own[4]), text(passage[:30] + ["edit"] + passage[31:] + own[5]), " ".join(prose(60, 21000)),
    ]
    docs = frame(spark, texts)
    got = repeated_passages(docs).collect()
    assert sorted((r.doc_id, r.removed, r.cluster_id, r.n_docs) for r in got) == [(0, False, 0, 3), (1, True, 0, 3), (8, True, 0, 3)]
    spans = {r.doc_id: (r.first_word, r.end_word) for r in got}
    assert spans == {0: (90, 160), 1: (13, 83), 8: (0, 70)}
    cut = {r.doc_id: r.text for r in without_passages(docs, repeated_passages(docs)).collect()}
    words = lambda t: hash_words([(t or "").encode()]).hashes.tolist()
    assert words(cut[1]) == words(text(own[1])) and words(cut[8]) == words(text(own[5]))
    assert [cut[k] for k in (0, 2, 4, 5)] == [texts[k] for k in (0, 2, 4, 5)]
    assert repeated_passages(docs.limit(0)).count() == 0


def test_rows_without_an_id_meet_their_own_hubs_only(spark):
    """n rows without an id, each a copy of another document, are n pairs and not n * n."""
    texts, ids = [], []
    common = " ".join(prose(400, 20))
    for k in range(40):
        passage = " ".join(prose(500 + k, 80))
        texts += [f"{common} {passage}", f"{' '.join(prose(900 + k, 20))} {passage}"]
        ids += [k, None]
    found = [r for r in repeated_passages(frame(spark, texts, ids)).collect() if r.removed]
    assert len({r.version for r in found if r.doc_id is None}) == 40
    assert all(r.end_word - r.first_word == 80 for r in found if r.doc_id is None)


@pytest.mark.parametrize("size", [50, 54, 60, 75])
def test_passages_behind_a_fragment_are_found(spark, size):
    """The smallest document of each three holds 49 words of a passage, which the other two share as a whole."""
    rng, texts = random.Random(size), []
    for k in range(60):
        passage = prose(1000 + k, size)
        at = rng.randrange(size - 48)
        for words in (passage[at : at + 49], passage, passage):
            texts.append(" ".join([*prose(rng.randrange(10**6), 30), *words, *prose(rng.randrange(10**6), 30)]))
    found = collections.defaultdict(list)
    for r in repeated_passages(frame(spark, texts)).where("removed").collect():
        found[r.doc_id].append(r.end_word - r.first_word)
    # Of 50 words there may be no paragraph within them, as begins are as far apart as words have it.
    hits = [k for k in range(60) if max(found[3 * k + 2], default=0) >= size]
    assert len(hits) >= (60 if size > 50 else 57)
    assert not any(found[3 * k] for k in range(60))


def test_groups_behind_one_fragment(spark):
    """Boilerplate of 40 words that many share; some of them go on alike, at either end."""
    line, texts = prose(5, 40), []
    for k in range(30):
        before, behind = prose(100 + k % 3, 15) if k % 2 else prose(5000 + k, 15), prose(200 + k % 5, 15)
        texts.append(" ".join([*prose(7000 + k, 40), *before, *line, *(behind if k % 2 else prose(6000 + k, 15)), *prose(8000 + k, 40)]))
    texts.insert(0, " ".join([*prose(1, 50), *line, *prose(2, 50)]))
    removed = {r.doc_id for r in repeated_passages(frame(spark, texts)).where("removed").collect()}
    odd = [k for k in range(30) if k % 2]
    shares = {k: [j for j in odd if j < k and (j % 3 == k % 3 or j % 5 == k % 5)] for k in odd}
    assert removed == {k + 1 for k in odd if shares[k]}


def test_passage_groups_keep_one(spark):
    passage = prose(70, 60)
    texts = [text(prose(200 + k, 30 + k) + passage + prose(400 + k, 50)) for k in range(60)]
    got = repeated_passages(frame(spark, texts)).collect()
    assert {r.doc_id for r in got if r.removed} == set(range(1, 60)) and {r.n_docs for r in got} == {60}
    # Words beside the passage that two texts share by chance are part of it.
    assert [(28 <= r.first_word <= 30, 90 <= r.end_word <= 92) for r in got if r.doc_id == 0] == [(True, True)]


def test_spans_allow_edits():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    b = np.concatenate((rng.integers(0, 1 << 63, 20).astype(np.uint64), a[40:120]))
    assert shared_spans(a, b, 20) == [(40, 120)]
    b[60] = np.uint64(1)
    assert shared_spans(a, b, 20) == [(40, 120)] and shared_spans(a, b, 21) == []
    # A long text with many changes still has its equal runs of 50 words.
    long = rng.integers(0, 1 << 63, 600).astype(np.uint64)
    changed = long.copy()
    changed[[*range(60, 300, 8), *range(355, 600, 8)]] += np.uint64(1)
    assert shared_spans(long, changed, 0) == [(0, 60), (293, 355)]


def test_passages_go_on_behind_words_put_in_or_left_out():
    rng = np.random.default_rng(4)
    words = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    for n, at in [(60, k) for k in range(11, 50)] + [(90, 45)]:
        passage = words(n)
        a = np.concatenate((words(30), passage, words(40)))
        longer, shorter = np.insert(passage, at, 1), np.delete(passage, at)
        for other in (longer, shorter):
            b = np.concatenate((words(17), other, words(25)))
            want = [(30, 30 + n, 17, 17 + len(other))]
            # Either side's diagonal finds the whole, as do both.
            later = 13 - (len(other) - n)
            assert shared_passages(a, b, [13]) == shared_passages(a, b, [later]) == shared_passages(a, b, [13, later]) == want
    # Words put in at several places; too many changes leave what is similar.
    passage = words(120)
    changed = np.insert(passage, [40, 80], [1, 2])
    assert shared_passages(passage, changed, [0]) == shared_passages(passage, changed, [-2]) == [(0, 120, 0, 122)]
    assert shared_passages(passage, np.insert(passage, range(6, 120, 6), 1), [0]) == []


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_contamination(spark):
    tests = [text(prose(300 + k, 15 + k)) for k in range(45)] + ["few", None, "", text(prose(999, 150)), text(prose(999, 150))]
    one = lambda k: tests[k].replace("\n", " ")
    own = [text(prose(600 + k, 120)) for k in range(6)]
    docs = [own[0] + one(3) + own[1], own[2], None, "", one(44).upper(), own[3] + " " + " ".join(one(20).split()[:12]), " ".join(prose(5, 20000)) + " " + one(7), one(48), one(30).replace(one(30).split()[9], "edited"), *AWKWARD]
    got = {(r.doc_id, r.item_id) for r in D.find_contamination(frame(spark, docs), items(spark, tests)).collect()}
    assert got == {(0, 3), (4, 44), (6, 7), (7, 48), (7, 49), (8, 30)}
    left = D.drop_contaminated(frame(spark, docs), items(spark, tests))
    assert left.columns == frame(spark, []).columns and {r.doc_id for r in left.collect()} == set(range(len(docs))) - {0, 4, 6, 7, 8}
    assert D.find_contamination(frame(spark, docs), items(spark, [])).count() == 0
    assert D.find_contamination(frame(spark, []), items(spark, tests)).count() == 0


def test_edits_in_the_last_words_of_every_item(spark):
    """A word changed, put in or left out in the last ten words of an item; short answers; words between question and answer."""
    table = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("text").collect() if len(hash_words([r.text.encode()]).hashes) >= 20]
    table += [" ".join(prose(700 + k, 30)) + ". " + " ".join(prose(800 + k, 1 + k % 9)) + "." for k in range(18)]
    table += [" ".join(prose(750 + k, 1 + k % 9)) + ". " + " ".join(prose(850 + k, 30)) + "." for k in range(9)]
    index = D.build_index(list(enumerate(table)))
    around, lost, short = prose(900, 90), [], 0
    for k, item in enumerate(table):
        own, cut = hash_words([item.encode()]).hashes, index.answers[k]
        beside = hash_words([" ".join(around).encode()]).hashes
        copies = [(np.insert(own, cut, np.arange(1, 4, dtype=np.uint64)), cut < len(own) and cut > 20)]
        for at in range(len(own) - 10, len(own)):
            # All that is needed of an answer of under five words: three words in five, and the question before them.
            answer = len(own) - cut
            plain = 1 <= answer < 5 and cut >= 20 and (at < cut or answer >= 3)
            copies += [(np.concatenate((own[:at], [np.uint64(1)], own[at + 1 :])), plain and at != cut - 5), (np.insert(own, at, np.uint64(1)), plain), (np.delete(own, at), plain and at != cut - 5)]
        for copy, must in copies:
            windows = lambda w: set(zip(*[w[i:].tolist() for i in range(5)]))
            held, covered = windows(copy), np.zeros(len(own), dtype=bool)
            for i in range(len(own) - 4):
                covered[i : i + 5] |= tuple(own[i : i + 5].tolist()) in held
            asked = covered[:cut].mean() if cut else 1.0
            if covered.mean() >= D.QUESTION or must and asked >= D.QUESTION:
                short += must
                whole = np.concatenate((beside[:40], copy, beside[40:]))
                words = hash_words([b" ".join(b"w" for _ in whole)])._replace(hashes=whole)
                if k not in {hit[1] for hit in D.search(index, words, D.SCORE_SHARE, D.QUESTION, D.ANSWER)}:
                    lost.append((k, len(own), cut))
    assert short > 100 and lost == []
    # A question with another answer is not the item.
    item = " ".join(prose(700, 20)) + ". " + " ".join(prose(800, 8)) + "."
    index = D.build_index([(0, item)])
    assert not list(D.search(index, hash_words([" ".join([*prose(700, 20), *prose(901, 60, size=4000)]).encode()]), D.SCORE_SHARE, D.QUESTION, D.ANSWER))


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(D, "INDEX_BYTES", 2000)
    tests = [text(prose(300 + k, 40)) for k in range(45)]
    got = {(r.doc_id, r.item_id) for r in D.find_contamination(frame(spark, tests[:9]), items(spark, tests)).collect()}
    assert got == {(k, k) for k in range(9)}


def test_block_bounds_lose_nothing():
    index = D.build_index([(k, text(prose(300 + k, 15 + k % 60, size=80))) for k in range(90)])
    rng = random.Random(1)
    for k in range(60):
        passage = hash_words([" ".join(rng.choices(prose(300 + k, 40, size=80), k=40)).encode()]).hashes
        terms = set(passage.tolist())
        score = np.zeros(len(index.segment_item))
        for t, (a, b) in zip(index.terms.tolist(), zip(index.begins[:-1], index.begins[1:])):
            if t in terms:
                score[index.segments[a:b]] += index.scores[a:b]
        for least in (0.2, 0.5):
            assert D.retrieve(index, passage, least) == pytest.approx({int(s): score[s] for s in np.flatnonzero(score >= least - 1e-9)})


def test_shingles_of_short_texts():
    hashes, begins = shingles(hash_words([b"", b"one", b"a b c d e", b"A b, c d E", b"a b c d e f"]))
    assert begins.tolist() == [0, 0, 1, 2, 3, 5] and hashes[1] == hashes[2] == hashes[3]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL)
        sizes.append(docs.count())
        assert stage is corpus_pipeline.piece_encoding or docs.columns == before.columns
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_span_bytes"]
    assert sizes[0] == sizes[1] >= sizes[2] >= sizes[3] == sizes[4] > 100
    assert sorted(docs.collect()) == sorted(corpus_pipeline.run(spark, SMALL).collect())


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_pipeline_of_awkward_tables(spark, rows):
    docs = frame(spark, rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in Q.ORACLES])
def test_queries_run(spark, name):
    assert Q.QUERIES[name](spark, SMALL).count() > 0
