"""Benchmark decontamination: BM25 over an inverted index of test items with block-max bounds, then an overlap check."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import order_id, text_key, whole_text
from tidemark.llm.words import WORDS, Words, chunks, hash_words, shingles

#: Items are indexed in segments of so many words. Passages are longer by STRIDE and begin every STRIDE words, so that each
#: run of SEGMENT words lies within one.
SEGMENT, STRIDE = 64, 16
PASSAGE = SEGMENT + STRIDE
#: A passage is retrieved for an item if its score is this share of the score that the item itself would get.
SCORE_SHARE = 0.6
#: Shares of the words of question and answer that five-word windows of the document must cover.
QUESTION, ANSWER = 0.8, 0.6
#: Five-word windows tell little of a side of fewer words: its single words also count where they stand at most NEAR words
#: from a window of the other side.
SHORT, NEAR = 2 * WORDS, 20
K1, B = 1.2, 0.75
BLOCK = 4
#: Sums of bounds that are held at a time.
CELLS = 1 << 22
#: Bytes of item text that one index holds; more items are searched for in several passes over the documents.
INDEX_BYTES = 32 << 20
TABLE_BITS = 20
#: Terms in more than this share of the segments only count after the first bounds.
COMMON = 0.1


class Index(NamedTuple):
    """Terms in order; postings and block bounds of term k are at begins[k] to begins[k + 1]. Scores are shares of the items' own."""

    terms: np.ndarray
    begins: np.ndarray
    segments: np.ndarray
    scores: np.ndarray
    block_begins: np.ndarray
    blocks: np.ndarray
    block_scores: np.ndarray
    n_blocks: int
    #: Which hash bits begin a term that is not common, which terms are common, and what these can add to any score.
    known_bits: np.ndarray
    common: np.ndarray
    common_most: float
    segment_item: np.ndarray
    item_words: list[np.ndarray]
    answers: list[int]
    item_ids: list


def _sentences(text: str) -> tuple[str, str]:
    """The item without its last sentence, and that sentence; an item of one sentence is its own question and answer."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if re.search(r"\w", p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def build_index(items: list[tuple[object, str]]) -> Index | None:
    """Items of fewer than five words are left out: they match nothing. None without any item."""
    ids, words, answers = [], [], []
    for item_id, text in items:
        question, answer = _sentences(text)
        own = hash_words([question.encode(), answer.encode()])
        if len(own.hashes) >= WORDS:
            ids.append(item_id)
            words.append(own.hashes)
            answers.append(int(own.begins[1]))
    if not ids:
        return None
    segments = [(k, w[at : at + SEGMENT]) for k, w in enumerate(words) for at in range(0, len(w), SEGMENT) if at == 0 or len(w) - at >= WORDS]
    lengths = np.array([len(w) for _, w in segments], dtype=np.float64)
    term = np.concatenate([w for _, w in segments])
    segment = np.repeat(np.arange(len(segments)), lengths.astype(int))
    pair = np.rec.fromarrays([term, segment], names="t,s")
    pair, counts = np.unique(pair, return_counts=True)
    terms, begins, spread = np.unique(pair.t, return_index=True, return_counts=True)
    idf = np.log1p((len(segments) - spread + 0.5) / (spread + 0.5))
    norm = K1 * (1 - B + B * lengths / lengths.mean())
    raw = np.repeat(idf, spread) * counts * (K1 + 1) / (counts + norm[pair.s])
    scores = raw / np.bincount(pair.s, weights=raw, minlength=len(segments))[pair.s]
    of_term = np.repeat(np.arange(len(terms)), spread)
    cell = of_term.astype(np.int64) * (len(segments) // BLOCK + 1) + pair.s // BLOCK
    cells, at = np.unique(cell, return_index=True)
    block_scores = np.maximum.reduceat(scores, at)
    common = spread > max(COMMON * len(segments), 1)
    bits = np.zeros(1 << TABLE_BITS, dtype=bool)
    bits[(terms[~common] >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    most = np.bincount(pair.s, weights=scores * common[of_term], minlength=len(segments)).max()
    return Index(
        terms, np.append(begins, len(scores)), pair.s.astype(np.int64), scores,
        np.searchsorted(cells // (len(segments) // BLOCK + 1), np.arange(len(terms) + 1)), cells % (len(segments) // BLOCK + 1), block_scores,
        len(segments) // BLOCK + 1, bits, common, float(most), np.array([k for k, _ in segments]), words, answers, ids,
    )


def _slices(begins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places begins[r] to begins[r + 1] of all rows r, one behind the other."""
    sizes = begins[rows + 1] - begins[rows]
    return np.repeat(begins[rows], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def retrieve(index: Index, passage: np.ndarray, least: float) -> dict[int, float]:
    """Segments that the passage scores least or more for: bounds per block first, then the postings of the blocks left."""
    distinct = np.unique(passage)
    at = np.minimum(np.searchsorted(index.terms, distinct), len(index.terms) - 1)
    rows = at[index.terms[at] == distinct]
    if not len(rows):
        return {}
    where = _slices(index.block_begins, rows)
    bounds = np.bincount(index.blocks[where], weights=index.block_scores[where])
    alive = bounds >= least - 1e-9
    if not alive.any():
        return {}
    where = _slices(index.begins, rows)
    where = where[alive[index.segments[where] // BLOCK]]
    scores = np.bincount(index.segments[where], weights=index.scores[where])
    return {int(s): float(scores[s]) for s in np.flatnonzero(scores >= least - 1e-9)}


def _covered(item: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which words of an item lie in a five-word window that is among known."""
    found = np.isin(shingles(Words(item, np.array([0, len(item)]), item, item, item))[0], known)
    covered = np.zeros(len(item), dtype=bool)
    for k in range(WORDS):
        covered[k : k + len(found)] |= found
    return covered


def _beside(side: np.ndarray, other: np.ndarray, own: np.ndarray, known: np.ndarray) -> float:
    """Share of the words of a side of an item that the document (words own, windows known) has beside windows of the other side.

    Words in the windows themselves don't count, nor does a word more often than the document has it there.
    """
    if len(other) < WORDS:
        return 0.0
    windows = np.isin(known, shingles(Words(other, np.array([0, len(other)]), other, other, other))[0])
    at = np.flatnonzero(windows)
    if not len(at):
        return 0.0
    taken, near = np.zeros(len(own) + 1, dtype=np.int64), np.zeros(len(own) + 1, dtype=np.int64)
    for marks, reach in ((taken, 0), (near, NEAR)):
        np.add.at(marks, np.maximum(at - reach, 0), 1)
        np.add.at(marks, np.minimum(at + WORDS + reach, len(own)), -1)
    words, counts = np.unique(own[(np.cumsum(near)[:-1] > 0) & (np.cumsum(taken)[:-1] == 0)], return_counts=True)
    wanted, needed = np.unique(side, return_counts=True)
    _, i, j = np.intersect1d(words, wanted, assume_unique=True, return_indices=True)
    return float(np.minimum(counts[i], needed[j]).sum() / len(side))


def likely_passages(index: Index, words: Words, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Texts and first words of the passages whose bound for some block of segments reaches least.

    Words are looked up once and their block bounds summed in cells of STRIDE words; a passage is a run of cells. Common
    terms are not looked up, their largest share of any score is added instead. Passages at the end of a text are bounded
    together with the words behind it, which can only raise the bound.
    """
    counts = np.diff(words.begins)
    cell_begins = np.concatenate(([0], np.cumsum(-(-counts // STRIDE))))
    at = np.flatnonzero(index.known_bits[(words.hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
    row = np.minimum(np.searchsorted(index.terms, words.hashes[at]), len(index.terms) - 1)
    same = (index.terms[row] == words.hashes[at]) & ~index.common[row]
    at, row = at[same], row[same]
    text = np.searchsorted(words.begins, at, "right") - 1
    cell = cell_begins[text] + (at - words.begins[text]) // STRIDE
    per, step = PASSAGE // STRIDE, max(1, CELLS // index.n_blocks)
    found = []
    for low in range(0, int(cell_begins[-1]), step):
        high = min(low + step, int(cell_begins[-1]))
        first, last = np.searchsorted(cell, (low, high + per - 1))
        rows = row[first:last]
        where = _slices(index.block_begins, rows)
        sizes = index.block_begins[rows + 1] - index.block_begins[rows]
        key = np.repeat(cell[first:last] - low, sizes) * index.n_blocks + index.blocks[where]
        sums = np.bincount(key, weights=index.block_scores[where], minlength=(high - low + per) * index.n_blocks).reshape(-1, index.n_blocks)
        bound = sum(sums[k : k + high - low] for k in range(per)).max(axis=1)
        found.append(low + np.flatnonzero(bound >= least - index.common_most - 1e-6))
    cells = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    text = np.searchsorted(cell_begins, cells, "right") - 1
    return text, (cells - cell_begins[text]) * STRIDE


def search(index: Index, words: Words, least: float, question: float, answer: float) -> Iterator[tuple[int, int, float, float, float]]:
    """Items found in the texts: text, item, best score, and the covered shares of its question and its answer."""
    texts, starts = likely_passages(index, words, least)
    for k in np.unique(texts).tolist():
        own = words.hashes[words.begins[k] : words.begins[k + 1]]
        best: dict[int, float] = {}
        for start in starts[texts == k].tolist():
            for segment, score in retrieve(index, own[start : start + PASSAGE], least).items():
                item = int(index.segment_item[segment])
                best[item] = max(score, best.get(item, 0.0))
        known = shingles(Words(own, np.array([0, len(own)]), own, own, own))[0] if best else own
        for item, score in best.items():
            covered = _covered(index.item_words[item], known)
            cut = index.answers[item]
            asked, answered = float(covered[:cut].mean()) if cut else 1.0, float(covered[cut:].mean()) if cut < len(covered) else 1.0
            words_of = index.item_words[item]
            if 0 < cut < len(words_of):
                if answered < answer and len(words_of) - cut < SHORT:
                    answered = max(answered, _beside(words_of[cut:], words_of[:cut], own, known))
                if asked < question and cut < SHORT:
                    asked = max(asked, _beside(words_of[:cut], words_of[cut:], own, known))
            if asked >= question and answered >= answer or covered.mean() >= question:
                yield k, item, score, asked, answered


def find_contamination(
    docs: DataFrame, items: DataFrame, score_share: float = SCORE_SHARE, question: float = QUESTION, answer: float = ANSWER, keep: Iterable[str] = ("doc_id",)
) -> DataFrame:
    """A row for each row of docs and item found in it: columns keep, item_id, score, question_overlap, answer_overlap.

    Passages of all documents are queries against an index of the items. An item is retrieved if a passage has score_share
    of the item's own BM25 score; the last sentence of an item is its answer, the rest its question, and both must be
    covered by five-word windows of the document to the shares given (an item of one sentence is all question), or the
    item as a whole to that of the question. Of a question or answer of fewer than ten words the single words count as well
    that stand near windows of the other. Words are
    compared without punctuation and the case of A-Z. Null and empty texts, items of fewer than five words, and empty
    tables give no rows; repeated rows of either table give repeated rows. docs needs text and the columns keep, items
    needs item_id and text; no other columns are read.
    """
    keep = list(keep)
    spark = docs.sparkSession
    known = items.select("item_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = size // INDEX_BYTES + 1
    source = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
    kind, id_kind = source.schema["row"].dataType.simpleString(), known.schema["item_id"].dataType
    schema = f"row {kind}, item int, score double, question_overlap double, answer_overlap double"

    def one_pass(number: int) -> DataFrame:
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number) if passes > 1 else known
        index = build_index(sorted(((r["item_id"], r["text"]) for r in part.collect()), key=repr))
        if index is None:
            return source.where(F.lit(False)).select("row.*", F.lit(None).cast(id_kind).alias("item_id"), *[F.lit(None).cast("double").alias(c) for c in ("score", "question_overlap", "answer_overlap")])
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, texts in chunks(batch.column("text")):
                    words = hash_words(texts)
                    hits = [(at + k, *hit) for k, *hit in search(shared.value, words, score_share, question, answer)]
                    if hits:
                        rows, found, *numbers = zip(*hits)
                        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(rows)), pa.array(found, pa.int32()), *[pa.array(x, pa.float64()) for x in numbers]], names=["row", "item", "score", "question_overlap", "answer_overlap"])

        names = F.array(*[F.lit(x).cast(id_kind) for x in index.item_ids]) if len(index.item_ids) <= 1000 else None
        hits = source.mapInArrow(run, schema)
        if names is None:
            ids = spark.createDataFrame([(k, x) for k, x in enumerate(index.item_ids)], f"item int, item_id {id_kind.simpleString()}")
            hits = hits.join(ids, "item")
        else:
            hits = hits.withColumn("item_id", F.get(names, F.col("item")))
        return hits.select("row.*", "item_id", "score", "question_overlap", "answer_overlap")

    found = one_pass(0)
    for number in range(1, passes):
        found = found.union(one_pass(number))
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs in which no item is found, with all their columns."""
    marked = docs.select(F.struct("*").alias("whole"), order_id(F.col("doc_id")).alias("doc"), text_key(whole_text(F.col("text"))).alias("version"))
    named = marked.select("doc", "version", F.col("whole.text").alias("text"))
    found = find_contamination(named, items, keep=("doc", "version")).select("doc", "version").distinct()
    return marked.join(found, ["doc", "version"], "left_anti").select("whole.*")
