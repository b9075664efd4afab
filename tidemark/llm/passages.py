"""Substring dedup: MinHash bands of short paragraphs find shared passages, which are verified word by word and clustered."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, cut, order_id, text_key
from tidemark.llm.components import components
from tidemark.llm.words import WORDS, Words, chunks, hash_words, mix, shingles

#: A paragraph begins at a word pair whose hash is the least within REACH words to both sides, so that a passage of
#: MIN_WORDS has paragraphs of its own wherever it stands: about every 2 * REACH + 1 words one begins.
REACH = 6
MIN_WORDS = 50
THRESHOLD = 0.8
#: A paragraph goes on for SIDE words behind the next begin, or starts as many before its own: a band for each, so that of
#: a passage of MIN_WORDS one of the two lies within it. Two rows a band: equal paragraphs always meet, those of similarity
#: 0.8 two times in three, and a passage has several; paragraphs that share a short line seldom do.
SIDE = 16
BANDS, ROWS = 2, 2
#: A paragraph's band is no shorter: a document that is in a bucket by less than a passage shares that many words at least.
FRAGMENT = SIDE + WORDS
#: Matching windows at most so many words apart belong to one passage.
GAP = 10
_BESIDE = np.random.default_rng(6).integers(-(1 << 63), 1 << 63, size=1 << 12, dtype=np.int64) | 1
_SEEDS = np.random.default_rng(5).integers(0, 1 << 64, size=(BANDS, ROWS), dtype=np.uint64)


def paragraph_begins(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words of the paragraphs of all texts, and the texts they are of; ends of texts are ends of paragraphs."""
    counts = np.diff(words.begins)
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(words.hashes)
    follow = np.append(words.hashes[1:], np.uint64(0)) if n else words.hashes
    last = np.zeros(n, dtype=bool)
    last[words.begins[1:][counts > 0] - 1] = True
    pairs = mix(words.hashes + np.where(last, np.uint64(0), follow) * np.uint64(3))
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.full(n + (len(counts) + 1) * REACH, most)
    place = np.arange(n) + (text + 1) * REACH
    padded[place] = pairs
    least = np.ones(n, dtype=bool)
    for k in range(1, REACH + 1):
        least &= (pairs < padded[place - k]) & (pairs <= padded[place + k])
    least[words.begins[:-1][counts > 0]] = True
    return np.flatnonzero(least), text[least]


def paragraph_bands(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word within it and band keys (a column for each band) of all paragraphs."""
    begins, text = paragraph_begins(words)
    hashes, text_begins = shingles(words)
    if not len(text):
        return text, begins, np.zeros((0, BANDS), dtype=np.int64)
    local = begins - words.begins[text]
    ends = np.append(begins[1:], 0) - words.begins[text]
    final = np.append(text[1:] != text[:-1], True)
    n_windows = np.diff(text_begins)[text]
    ends[final] = n_windows[final]
    keys = np.zeros((len(text), BANDS), dtype=np.uint64)
    for band, (low, high) in enumerate(((local, ends + SIDE), (local - SIDE, ends))):
        low = np.clip(low, 0, n_windows - 1)
        high = np.clip(high, low + 1, n_windows)
        bounds = np.stack((text_begins[text] + low, text_begins[text] + high), axis=1).ravel()
        for seed in _SEEDS[band]:
            # One more value, as the last paragraph may end with the last window.
            least = np.minimum.reduceat(np.append(mix(hashes ^ seed), np.uint64(0)), bounds)[::2]
            keys[:, band] = mix(keys[:, band] + least + np.uint64(band))
    return text, local, keys.view(np.int64)


def _runs(a: np.ndarray, b: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """First and last of the windows of a, run by run, that stand in b diagonal words earlier."""
    low, high = max(0, diagonal), min(len(a), len(b) + diagonal)
    if high <= low:
        return []
    at = np.flatnonzero(a[low:high] == b[low - diagonal : high - diagonal]) + low
    breaks = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, breaks + 1)].tolist(), at[np.append(breaks, len(at) - 1)].tolist())) if len(at) else []


def _next(a: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[int, int] | None:
    """The run of windows that follows window i of a and j of b with the smallest gap and shift, at most GAP words: its first window in a and b."""
    reach = GAP + WORDS
    x, y = np.nonzero(a[i + 1 : i + 1 + reach, None] == b[None, j + 1 : j + 1 + reach])
    shift = np.abs(x - y)
    near = shift <= GAP
    if not near.any():
        return None
    x, y, shift = x[near], y[near], shift[near]
    k = int((np.maximum(x, y) + shift).argmin())
    return i + 1 + int(x[k]), j + 1 + int(y[k])


def _chain(a: np.ndarray, b: np.ndarray, i: int, j: int) -> list[tuple[int, int, int]]:
    """Runs (first window in a, first in b, length) that follow window i of a and j of b one after the other."""
    found = []
    while (at := _next(a, b, i, j)) is not None:
        n = min(len(a) - at[0], len(b) - at[1])
        step, length = 64, 0
        while length < n:
            same = a[at[0] + length : at[0] + min(length + step, n)] == b[at[1] + length : at[1] + min(length + step, n)]
            if not same.all():
                length += int(same.argmin())
                break
            length += len(same)
            step *= 2
        found.append((*at, length))
        i, j = at[0] + length - 1, at[1] + length - 1
    return found


def shared_passages(
    a: np.ndarray, b: np.ndarray, diagonals: list[int], least: int = MIN_WORDS, threshold: float = THRESHOLD, short: list[tuple[int, int, int]] | None = None
) -> list[tuple[int, int, int, int]]:
    """Passages of a that b has too: (first, end) in a and in b. Each has a run on one of the diagonals, so many words earlier in b.

    A passage starts and ends with five equal words, has no more than GAP words between matching windows, at least `least`
    words in a and in b, and shingles of a Jaccard similarity of threshold or more with its counterpart; so equal runs
    always count. Where words were put in or left out it goes on at another diagonal, at most GAP words away, whether that
    one is among diagonals or not. short gets (first, end, diagonal) of the runs of FRAGMENT words or more that are in none.
    """
    if min(len(a), len(b)) < max(least, WORDS):
        return []
    wa, wb = (shingles(Words(w, np.array([0, len(w)]), w, w, w))[0] for w in (a, b))
    back_a, back_b = wa[::-1], wb[::-1]
    found, firsts, lasts = set(), set(), set()
    for diagonal in dict.fromkeys(diagonals):
        for first, last in _runs(wa, wb, diagonal):
            if (first, diagonal) in firsts or (last, diagonal) in lasts:
                continue
            before = _chain(back_a, back_b, len(wa) - 1 - first, len(wb) - 1 - (first - diagonal))
            runs = [(len(wa) - i - n, len(wb) - j - n, n) for i, j, n in reversed(before)]
            runs += [(first, first - diagonal, last - first + 1), *_chain(wa, wb, last, last - diagonal)]
            firsts.update((i, i - j) for i, j, _ in runs)
            lasts.update((i + n - 1, i - j) for i, j, n in runs)
            if runs[-1][0] + runs[-1][2] + WORDS - 1 - runs[0][0] < least:
                if short is not None and last - first + WORDS >= FRAGMENT:
                    short.append((first, last + WORDS, diagonal))
                continue
            own, other = (np.concatenate([np.arange(r[side], r[side] + r[2]) for r in runs]) for side in (0, 1))
            steps = np.maximum(np.diff(own), np.diff(other))
            parts = [(0, len(own) - 1)]
            while parts:
                low, high = parts.pop()
                begin, end, other_begin, other_end = int(own[low]), int(own[high]) + WORDS, int(other[low]), int(other[high]) + WORDS
                if min(end - begin, other_end - other_begin) < least:
                    continue
                inner = steps[low:high]
                if len(inner) and inner.max() > 1:
                    x, y = np.unique(wa[begin : end - WORDS + 1]), np.unique(wb[other_begin : other_end - WORDS + 1])
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if shared < threshold * (len(x) + len(y) - shared):
                        # Too many changes for the whole: what lies before and behind the widest of them is looked at by itself.
                        cut = low + int(inner.argmax())
                        parts += [(low, cut), (cut + 1, high)]
                        continue
                found.add((begin, end, other_begin, other_end))
    return sorted(found)


def shared_spans(a: np.ndarray, b: np.ndarray, diagonal: int, least: int = MIN_WORDS, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """The spans in a of the passages that have a run on one diagonal."""
    return [(first, end) for first, end, _, _ in shared_passages(a, b, [diagonal], least, threshold)]


def _merged(spans: DataFrame) -> DataFrame:
    """Spans (doc, version, removed, first, end, first_byte, end_byte) with those that overlap joined, and the passage each one went to."""
    order = Window.partitionBy("doc", "version", "removed").orderBy("first", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(reach >= F.col("first"), 0).otherwise(1))
    return marked.withColumn("number", F.sum("new").over(order)).withColumn("passage", F.xxhash64("doc", "version", "removed", "number"))


def _fragment_pairs(fragments: DataFrame) -> DataFrame:
    """(doc, version, hub, hub_version, diagonals) of members that a hub's fragment and the words beside it bring together."""
    near = lambda side, end, word: F.struct(F.lit(side).alias("side"), F.col(end).alias("hub_at"), F.col(word).alias("word"), F.col(side).alias("at"))
    beside = fragments.select("doc", "version", "hub", "hub_version", F.explode(F.array(near("first", "hub_first", "before"), near("end", "hub_end", "behind"))).alias("n"))
    keyed = beside.where("n.word <> 0").select("doc", "version", "n.at", F.xxhash64("hub", "hub_version", "n.side", "n.hub_at", "n.word").alias("key"))
    least = keyed.groupBy("key").agg(F.min(F.struct("doc", "version", "at")).alias("least"), F.max("doc").alias("most")).where("least.doc < most")
    met = keyed.join(least.select("key", F.col("least.doc").alias("hub"), F.col("least.version").alias("hub_version"), F.col("least.at").alias("hub_at")), "key").where("doc <> hub")
    return met.groupBy("doc", "version", "hub", "hub_version").agg(F.sort_array(F.collect_set(F.col("at") - F.col("hub_at"))).alias("diagonals"))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per passage that several documents share: doc_id, version, removed, first_word, end_word, first_byte, end_byte, cluster_id, n_docs.

    Words are compared without punctuation and the case of A-Z, from min_words on. A passage is removed from every document
    but the smallest doc_id that holds it, and overlapping ones are joined within a document; one that stays has no row if a
    removed one covers it. Clusters are the components
    of the links between passages and their namesake is the smallest doc_id of one. Bytes are those of the UTF-8 text.
    Null, empty and short texts have no passages, nor do repeated rows among themselves: rows of one doc_id are one
    document here, and so are rows without one. Documents that share nothing have no row.

    Paragraphs meet in buckets of their MinHash bands. All members of a bucket are compared with its smallest document, so
    that a passage of a third of all documents makes one row for each of them. Runs are then verified in the texts. Where
    that document holds a fragment only, too short for a passage, others may share more: two that do agree on half of the
    missing words behind the fragment or before it, so members meet again by fragment and those words, with the smallest of
    them. Each such round halves what is missing. Members whose fragments of one document differ in length are not brought
    together by this.
    """
    # Rows without an id are one document of many texts; part tells these apart, so that each meets its own hubs only.
    part = F.when(F.col("doc_id").isNull(), text_key(F.col("text").cast("string"))).otherwise(F.lit(0).cast("long"))
    named = docs.select(order_id(F.col("doc_id")).alias("doc"), part.alias("part"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, version = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "part"))
            for at, part in chunks(batch.column("text")):
                text, local, keys = paragraph_bands(hash_words(part))
                owner = np.repeat(at + text, BANDS)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(keys.ravel(), pa.int64()), "doc": pa.array(doc[owner], pa.int64()), "part": pa.array(version[owner], pa.int64()),
                    "pos": pa.array(np.repeat(local, BANDS), pa.int32()),
                })

    paragraphs = named.mapInArrow(band, "key long, doc long, part long, pos int")
    # The smallest document is the hub. It has an id wherever a bucket has two documents, so it needs no part.
    keys = paragraphs.groupBy("key").agg(F.min("doc").alias("hub"), F.max("doc").alias("most")).where("hub < most").select("key", "hub")
    shared = cut(paragraphs.join(keys, "key"))
    hubs = shared.where("doc = hub").groupBy("key").agg(F.min("pos").alias("hub_pos"))
    seeds = shared.where("doc <> hub").join(hubs, "key").groupBy("doc", "part", "hub", (F.col("pos") - F.col("hub_pos")).alias("diagonal")).agg(F.count("*").alias("n_seeds"))
    pairs = seeds.groupBy("doc", "part", "hub").agg(F.sort_array(F.collect_list("diagonal")).alias("diagonals"))
    pairs = cut(pairs)
    needed = pairs.select("doc", "part").union(pairs.select("hub", F.lit(0).cast("long"))).distinct()
    texts = named.join(needed, ["doc", "part"]).withColumn("version", text_key(F.col("text")))
    texts = cut(texts.groupBy("doc", "part", "version").agg(F.first("text").alias("text")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None)
        for batch in batches:
            out: list[tuple] = []
            hub_names = list(zip(batch.column("hub").to_pylist(), batch.column("hub_version").to_pylist()))
            doc_names = list(zip(batch.column("doc").to_pylist(), batch.column("version").to_pylist()))
            diagonals, hub_texts = batch.column("diagonals").to_pylist(), batch.column("hub_text")
            for at, part in chunks(batch.column("text")):
                words = hash_words(part)
                for k in range(len(part)):
                    hub = hub_names[at + k]
                    if known[0] != hub:
                        known = hub, hash_words([hub_texts[at + k].as_py().encode()])
                    other = known[1]
                    begin, shift = int(words.begins[k]), int(words.text_begins[k])
                    own = words.hashes[begin : words.begins[k + 1]]
                    short: list[tuple[int, int, int]] = []
                    for first, end, low, high in shared_passages(own, other.hashes, diagonals[at + k], min_words, threshold, short):
                        out.append((
                            *doc_names[at + k], first, end, int(words.first[begin + first]) - shift, int(words.stop[begin + end - 1]) - shift,
                            *hub, low, high, int(other.first[low]), int(other.stop[high - 1]), False, 0, 0,
                        ))
                    signed = own.view(np.int64)
                    for first, end, diagonal in short:
                        # Of the words that a passage has besides the fragment, half stand on one side of it.
                        n = -(-(min_words - (end - first)) // 2)
                        before, behind = (
                            int(signed[low:high] @ _BESIDE[:n]) if 0 <= low and high <= len(own) else 0 for low, high in ((first - n, first), (end, end + n))
                        )
                        out.append((*doc_names[at + k], first, end, 0, 0, *hub, first - diagonal, end - diagonal, 0, 0, True, before, behind))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names=names)

    names = ["doc", "version", "first", "end", "first_byte", "end_byte", "hub", "hub_version", "hub_first", "hub_end", "hub_first_byte", "hub_end_byte", "fragment", "before", "behind"]
    kinds = [*[pa.int64(), pa.int64(), *[pa.int32()] * 4] * 2, pa.bool_(), pa.int64(), pa.int64()]
    spelled = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean"}
    schema = ", ".join(f"{n} {spelled[t]}" for n, t in zip(names, kinds))
    hub_texts = texts.select(F.col("doc").alias("hub"), F.col("version").alias("hub_version"), F.col("text").alias("hub_text"))

    def verified(with_text: DataFrame) -> DataFrame:
        return cut(with_text.select("doc", "version", "text", "hub", "hub_version", "hub_text", "diagonals").mapInArrow(verify, schema))

    told = verified(pairs.join(texts, ["doc", "part"]).join(hub_texts, "hub"))
    links = told.where("NOT fragment").drop("fragment", "before", "behind")
    while True:
        again = cut(_fragment_pairs(told.where("fragment")))
        if again.isEmpty():
            break
        told = verified(again.join(texts, ["doc", "version"]).join(hub_texts, ["hub", "hub_version"]))
        links = links.unionByName(told.where("NOT fragment").drop("fragment", "before", "behind"))

    sides = ["doc", "version", "first", "end", "first_byte", "end_byte"]
    taken = links.select(*sides, F.lit(True).alias("removed"))
    left = links.select(*[F.col(f"hub_{c}" if c != "doc" else "hub").alias(c) for c in sides], F.lit(False).alias("removed"))
    spans = cut(_merged(taken.union(left).groupBy(*sides, "removed").agg(F.lit(1).alias("one")).drop("one")))
    find = lambda removed, prefix, to: spans.where(F.col("removed") == removed).select(F.col("doc").alias(prefix or "doc"), *[F.col(c).alias(f"{prefix}_{c}" if prefix else c) for c in ("version", "first", "end")], F.col("passage").alias(to))
    tied = links.join(find(True, "", "u"), ["doc", "version", "first", "end"]).join(find(False, "hub", "v"), ["hub", "hub_version", "hub_first", "hub_end"])
    # A document's removed and staying passages that touch are one node, as their words hang together.
    touch = spans.groupBy("doc", "version", "removed", "passage").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    order = Window.partitionBy("doc", "version").orderBy("first", "end", "removed")
    back = F.lag("passage").over(order)
    joined = touch.where(F.lit(True)).withColumns({"back": back, "reach": F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))})
    same = joined.where((F.col("reach") > F.col("first")) & F.col("back").isNotNull()).select(F.col("passage").alias("u"), F.col("back").alias("v"))
    roots = components(tied.select("u", "v").union(same))
    passages = spans.groupBy("doc", "version", "removed", "passage").agg(
        F.min("first").alias("first_word"), F.max("end").alias("end_word"), F.min("first_byte").alias("first_byte"), F.max("end_byte").alias("end_byte")
    )
    inside = Window.partitionBy("doc", "version").orderBy("first_word", F.col("removed").desc(), F.col("end_word").desc())
    reach = F.max(F.when(F.col("removed"), F.col("end_word"))).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    passages = passages.withColumn("reach", reach).where(F.col("removed") | F.col("reach").isNull() | (F.col("reach") < F.col("end_word"))).drop("reach")
    clustered = cut(passages.join(roots, F.col("passage") == F.col("node")))
    clusters = clustered.groupBy("root").agg(F.min("doc").alias("least"), F.count_distinct("doc").alias("n_docs"))
    told = clustered.join(clusters, "root")
    shown = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return told.select(shown("doc").alias("doc_id"), "version", "removed", "first_word", "end_word", "first_byte", "end_byte", shown("least").alias("cluster_id"), "n_docs")


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs with the removed passages cut out of text; other columns, rows and texts stay as they are."""
    named = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("of"), text_key(F.col("text")).alias("of_version"))
    spans = passages.where("removed").groupBy(F.col("doc_id").alias("of"), F.col("version").alias("of_version")).agg(F.sort_array(F.collect_list(F.struct("first_byte", "end_byte"))).alias("spans"))
    joined = named.join(spans, ["of", "of_version"], "left")
    raw = F.col("row.text").cast("binary")
    begins = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end_byte"]))
    pieces = F.transform(begins, lambda b, i: F.decode(F.substring(raw, b + 1, F.coalesce(F.get(F.col("spans"), i)["first_byte"], F.octet_length("row.text")) - b), "utf-8"))
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.array_join(pieces, ""))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns])
