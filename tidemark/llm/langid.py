"""Language ID: multinomial naive Bayes over hashed character n-grams, scored in batches of sparse rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 16
ORDERS = (1, 2, 3)
#: Labelled rows of a language that the model is fitted on, about; chosen by a hash of the row.
FIT_ROWS = 4000
MAX_LANGUAGES = 1000
UNDETERMINED = "und"
#: Characters that are scored at a time, to bound memory.
CHUNK = 1 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_letters: np.ndarray | None = None


class LanguageModel(NamedTuple):
    labels: list[str]
    #: Log probabilities, a row for each bucket and a column for each label.
    weights: np.ndarray
    prior: np.ndarray


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def _characters(text: str) -> tuple[np.ndarray, bool]:
    """Lower-cased letters with one blank for what lies between words, and whether there is a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letter_table()[points]
    if not letter.any():
        return points[:0], False
    points = np.where(letter, points, np.uint32(32))
    points = np.concatenate(([np.uint32(32)], points, [np.uint32(32)]))
    blank = points == 32
    return points[~(blank & np.concatenate(([False], blank[:-1])))], True


def _buckets(points: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that begin in the first CHUNK characters and end within the array."""
    wide = points.astype(np.uint64) + np.uint64(1)
    mixed, found = np.zeros(len(wide), dtype=np.uint64), []
    for order in ORDERS:
        mixed = (mixed[: len(wide) - order + 1] ^ (mixed[: len(wide) - order + 1] >> np.uint64(29))) * _FACTORS[1] + wide[order - 1 :]
        found.append(((mixed * _FACTORS[0]) >> np.uint64(64 - BUCKET_BITS))[:CHUNK].astype(np.int64))
    return np.concatenate(found)


def _pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that overlap, so that each n-gram begins in one of them."""
    for at in range(0, len(points), CHUNK):
        yield points[at : at + CHUNK + max(ORDERS) - 1]


def _score(texts: Iterable[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    """A batch is a sparse matrix of one row per text: its buckets, and where each row begins; times the weights."""
    texts = list(texts)
    labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    totals: dict[int, np.ndarray] = {}
    pending: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if pending:
            begins = np.cumsum([0] + [len(b) for _, b in pending[:-1]])
            sums = np.add.reduceat(model.weights[np.concatenate([b for _, b in pending])], begins, axis=0, dtype=np.float64)
            for (row, _), part in zip(pending, sums):
                totals[row] = totals.get(row, model.prior) + part
            pending.clear()

    size = 0
    for row, text in enumerate(texts):
        points, any_letter = _characters(text or "")
        if not any_letter or not model.labels:
            continue
        for piece in _pieces(points):
            pending.append((row, _buckets(piece)))
            size += len(pending[-1][1])
            if size >= CHUNK:
                flush()
                size = 0
    flush()
    for row, total in totals.items():
        best = int(np.argmax(total))
        labels[row] = model.labels[best]
        scores[row] = float(1.0 / np.exp(total - total[best]).sum())
    return labels, scores


def fit_language_model(labelled: DataFrame, fit_rows: int = FIT_ROWS, smoothing: float = 0.5, key: str = "doc_id") -> LanguageModel:
    """Fit on text and lang of labelled, from about fit_rows rows of each language.

    Rows are picked by a hash of text and key, those without a key by their place in the table, so that a text that stands in
    many rows is picked in proportion and not with all of them or none. Rows with a null lang or text are not used. The share of a language in all labelled rows is its prior. The driver gets
    the row counts of at most MAX_LANGUAGES languages and 2**BUCKET_BITS sums for each, whatever the size of the table.
    """
    place = F.monotonically_increasing_id().cast("string")
    picked_by = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("at "), place)) if key in labelled.columns else place
    rows = labelled.select("text", "lang", picked_by.alias("picked_by")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counted) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counted:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0), dtype=np.float32), np.zeros(0))
    counts = {r["lang"]: r["count"] for r in counted}
    labels = sorted(counts)
    steps = 1 << 30
    share = F.element_at(F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), F.array(*[F.lit(int(steps * min(1.0, fit_rows / counts[x]))) for x in labels])), F.col("lang"))
    picked = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "picked_by", "text"), F.lit(steps)) < share).select("text", "lang")
    number = {x: k for k, x in enumerate(labels)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(labels), 1 << BUCKET_BITS), dtype=np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                points, any_letter = _characters(text)
                for piece in _pieces(points) if any_letter else ():
                    sums[number[lang]] += np.bincount(_buckets(piece), minlength=1 << BUCKET_BITS)
        at, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict({"label": pa.array(at, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(sums[at, bucket], pa.int64())})

    parts = picked.mapInArrow(count, "label int, bucket int, n long")
    table = parts.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    sums = np.full((1 << BUCKET_BITS, len(labels)), smoothing)
    sums[table.column("bucket").to_numpy(), table.column("label").to_numpy()] += table.column("n").to_numpy()
    share_of = np.array([counts[x] for x in labels], dtype=np.float64)
    return LanguageModel(labels, (np.log(sums) - np.log(sums.sum(axis=0))).astype(np.float32), np.log(share_of / share_of.sum()))


def predict_languages(docs: DataFrame, model: LanguageModel, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Columns keep of docs with lang_pred and score, the posterior probability of that label.

    The whole text counts. A null text and one without a letter get und and 0, as does every text if nothing could be
    learned; of labels that tie the first in order wins. Repeated rows stay; columns that are not in keep are not read.
    """
    keep = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = _score(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    schema = f"row {source.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return source.mapInArrow(predict, schema).select("row.*", "lang_pred", "score")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1
