"""Token counts of whole texts; long texts are encoded in overlapping chunks that are spliced where both agree for certain.

When a common boundary is proven: a byte-level tokenizer cuts a text from left to right into pre-tokens, and encodes each by
itself. Where a pre-token ends, nothing before that place matters to what follows (no look-behind, no prefix space). A chunk
whose start is right is right up to a margin before its end, as a cut can only change what looks at the missing characters: a
contraction, a run of spaces or a special string. So a place where a pre-token of the chunk before (outside the margin) and one
of the chunk behind both begin is a boundary of the whole text, and the chunk behind is right from there on.

Within a text or chunk, some boundaries show without the library: a run of white space begins a pre-token, and so does a
punctuation mark behind a letter, as no pre-token goes on from other characters to these. What is before such a place doesn't
look behind it. So counts are added up over parts between such places, and the library encodes a part that a worker met lately
only once. Where tokens begin is asked of the library for the ends that a chunk shares with others, not for what is between.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, whole_text
from tidemark.llm.words import chunks

#: Bytes from the start of a chunk to the start of the next, and bytes that both hold.
STEP, OVERLAP = 1 << 14, 1 << 9
#: Both grow by this factor for texts whose chunks don't align.
WIDER = 8
#: Bytes of text that are encoded at a time.
BATCH = 1 << 20
#: Characters that a cut may hide from the pattern of pre-tokens: the rest of a contraction, the one behind a run of spaces.
HIDDEN = 3
#: What the pattern of pre-tokens takes as white space; letters and punctuation that are such in every version of Unicode.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af"
MARKS = ".,;:!?"
#: A part that is one pre-token for certain, and the characters that stand for bytes in a byte-level vocabulary.
WORD = re.compile(f" ?(?:[{LETTERS}]+|[0-9]+)")
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = {b: chr(b) for b in SHOWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in SHOWN)}
#: Where white space begins behind something else.
GAP = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")
#: Characters before the end of a chunk's middle that are searched first for a gap.
NEAR = 256
#: Parts whose counts a worker keeps, once and again for those before, and the length of the longest of them.
KEPT, LONGEST = 1 << 18, 64
#: Parts that are encoded at a time.
PARTS = 1 << 13

CHUNKS = "key string, k long, begin long, next_begin long, last boolean, text string"
ENCODED = "key string, k long, total long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"

_tokenizers: dict[int, object] = {}
_counters: dict[tuple[int, str | None], PartCounts] = {}


def _tokenizer(model: str):
    """One tokenizer for each model in a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    key = hash(model)
    if key not in _tokenizers:
        found = Tokenizer.from_str(model)
        found.no_truncation()
        found.no_padding()
        _tokenizers[key] = found
    return _tokenizers[key]


def margin(model: str) -> int | None:
    """Characters before the end of a chunk that prove nothing; None if boundaries of this tokenizer can't be proven at all."""
    spec = json.loads(model)
    cutter = spec["pre_tokenizer"] or {}
    local = spec["normalizer"] is None and cutter.get("type") == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
    if not local or not plain or spec["model"]["type"] != "BPE":
        return None
    return HIDDEN + max((len(t["content"]) for t in spec["added_tokens"]), default=0)


def marks_of(model: str) -> str | None:
    """Punctuation before which a text may be cut, behind a letter; None if parts of a text can't be counted by themselves."""
    if margin(model) is None:
        return None
    special = [t["content"] for t in json.loads(model)["added_tokens"]]
    if any(re.search(f"[{WHITE}]", s) or WORD.fullmatch(s) for s in special):
        return None
    return "".join(m for m in MARKS if not any(m in s for s in special))


class PartCounts:
    """Numbers of tokens of texts. With marks they are added up over parts, and the counts of short parts met lately are kept."""

    def __init__(self, tokenizer, marks: str | None):
        self.tokenizer, self.marks = tokenizer, marks
        word = f"[{WHITE}]*+[{LETTERS}]++(?![^{WHITE}{marks}])"
        self.parts = re.compile(f"{word}|[{WHITE}]*+[^{WHITE}]++|[{WHITE}]++")
        self.kept: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        if self.marks is None:
            return self._of_texts(texts)
        found = [self.parts.findall(t) for t in texts]
        parts = list(chain.from_iterable(found))
        counts = np.fromiter(map(self.kept.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(counts < 0)
        names = [parts[k] for k in missing.tolist()]
        new = {part: self.before.get(part, -1) for part in names}
        unseen = [part for part, n in new.items() if n < 0]
        for begin in range(0, len(unseen), PARTS):
            new.update(self._encoded(unseen[begin : begin + PARTS]))
        counts[missing] = [new[part] for part in names]
        self.kept.update(x for x in new.items() if len(x[0]) <= LONGEST)
        if len(self.kept) > KEPT:
            self.kept, self.before = {}, self.kept
        sums = np.concatenate(([0], np.cumsum(counts)))
        return np.diff(sums[np.cumsum([0] + [len(f) for f in found])]).tolist()

    def _encoded(self, parts: list[str]) -> Iterator[tuple[str, int]]:
        """Each part with its number of tokens; the library's model takes words without looking for pre-tokens first."""
        words = [part for part in parts if WORD.fullmatch(part)]
        others = [part for part in parts if not WORD.fullmatch(part)]
        shown = "\n".join(words).encode().decode("latin-1").translate(ALPHABET).split(ALPHABET[10]) if words else []
        tokens = self.tokenizer.model.tokenize
        return chain(zip(words, [len(tokens(word)) for word in shown]), zip(others, self._of_texts(others)))

    def _of_texts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _counter(model: str, marks: str | None) -> PartCounts:
    """One counter for each model in a worker, so that counts are kept from task to task."""
    key = hash(model), marks
    if key not in _counters:
        _counters[key] = PartCounts(_tokenizer(model), marks)
    return _counters[key]


def middle(text: str, raw: bytes, overlap: int, behind: int) -> tuple[int, int]:
    """First and last gap of a text, in characters, from byte overlap to byte behind; twice its end if there is none."""
    low, high = len(raw[:overlap].decode(errors="ignore")) + 1, len(raw[:behind].decode(errors="ignore"))
    first = GAP.search(text, low, high + 1)
    if first is None:
        return len(text), len(text)
    for begin in (max(first.start(), high - NEAR), first.start()):
        last = [gap.start() for gap in GAP.finditer(text, begin, high + 1)]
        if last:
            break
    return first.start(), last[-1]


def cut_text(text: bytes, step: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Begin and end of the chunks of a text in bytes, none inside a character; the last one ends with the text."""

    def whole(at: int) -> int:
        while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
            at -= 1
        return min(at, len(text))

    begin = 0
    while True:
        end = whole(begin + step + overlap)
        yield begin, end
        if end == len(text):
            return
        begin = whole(begin + step)


def boundaries(encoding, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of text where pre-tokens begin, and the number of tokens before each."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    first = np.flatnonzero(np.concatenate(([True], np.diff(words) != 0))) if len(words) else np.zeros(0, np.int64)
    raw = np.frombuffer(text, np.uint8)
    byte_of = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
    begins = np.array([o[0] for o in encoding.offsets], np.int64)
    return byte_of[begins[first]], first


def _chunks_of(long: DataFrame, step: int, overlap: int) -> DataFrame:
    """One row for each chunk of the texts, keyed by the text's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                raw, key = text.as_py().encode(), key.as_py()
                places = list(cut_text(raw, step, overlap))
                rows = [
                    (key, k, begin, places[k + 1][0] if k + 1 < len(places) else end, k + 1 == len(places), raw[begin:end].decode())
                    for k, (begin, end) in enumerate(places)
                ]
                names = ["key", "k", "begin", "next_begin", "last", "text"]
                yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*rows))})

    return long.select("key", "text").mapInArrow(run, CHUNKS)


def _encode_chunks(parts: DataFrame, model, hidden: int, marks: str | None, overlap: int) -> DataFrame:
    """For each chunk its tokens, and the boundaries in what it shares with the chunks beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, counter = _tokenizer(model.value), _counter(model.value, marks)
        for batch in batches:
            places = batch.select(["begin", "next_begin", "last"]).to_pydict()
            out: dict[str, list] = {n: [] for n in ("total", "head_at", "head_n", "tail_at", "tail_n")}
            for start, texts in chunks(batch.column("text"), BATCH):
                whole = [t.decode() for t in texts]
                first, behind = places["begin"][start : start + len(texts)], places["next_begin"][start : start + len(texts)]
                inner = [(len(t), len(t)) if marks is None else middle(t, raw, overlap, n - b) for t, raw, b, n in zip(whole, texts, first, behind)]
                between = counter([t[a:z] for t, (a, z) in zip(whole, inner)])
                ends = [x for t, (a, z) in zip(whole, inner) for x in (t[:a], t[z:])]
                encoded = tokenizer.encode_batch(ends, add_special_tokens=False)
                for j, text in enumerate(texts):
                    left, right = (boundaries(encoded[k], ends[k].encode()) for k in (2 * j, 2 * j + 1))
                    inside = len(encoded[2 * j]) + between[j]
                    at = np.concatenate((left[0], right[0] + len(text) - len(ends[2 * j + 1].encode()))) + first[j]
                    before = np.concatenate((left[1], right[1] + inside))
                    proven = first[j] + (len(text) if places["last"][start + j] else len(whole[j][:-hidden].encode()))
                    head, tail = at < first[j] + overlap, (at >= behind[j]) & (at <= proven)
                    for name, values in (("head_at", at[head]), ("head_n", before[head]), ("tail_at", at[tail]), ("tail_n", before[tail])):
                        out[name].append(values)
                    out["total"].append(inside + len(encoded[2 * j + 1]))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "k": batch.column("k")} | out)

    return parts.mapInArrow(run, ENCODED)


def _spliced(encoded: DataFrame) -> DataFrame:
    """Tokens of each text, and whether all of its chunks align. What two chunks both count is taken off once."""
    row = Window.partitionBy("key").orderBy("k")
    before = {c: F.lag(c).over(row).alias(f"before_{c}") for c in ("total", "tail_at", "tail_n")}
    pairs = encoded.select("*", *before.values())
    pairs = pairs.withColumn("at", F.array_min(F.array_intersect("before_tail_at", "head_at")))

    def count(places: str, counts: str):
        return F.try_element_at(counts, F.array_position(places, F.col("at")).cast("int"))

    twice = F.col("before_total") - count("before_tail_at", "before_tail_n") + count("head_at", "head_n")
    pairs = pairs.select("key", (F.col("total") - F.when(F.col("k") > 0, F.when(F.col("at").isNotNull(), twice)).otherwise(0)).alias("own"))
    return pairs.groupBy("key").agg(F.sum("own").cast("long").alias("n_tokens"), F.bool_and(F.col("own").isNotNull()).alias("aligned"))


def _count_long(long: DataFrame, model, hidden: int | None, marks: str | None, step: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of the texts. Texts with chunks that don't align are done again with wider ones, at last in one piece."""
    found = []
    while True:
        if hidden is None:
            step = 1 << 31
        encoded = _encode_chunks(cut(_chunks_of(long, step, overlap)), model, hidden or 0, marks, overlap)
        # Equal texts have equal chunks.
        counted = cut(_spliced(encoded.dropDuplicates(["key", "k"])))
        found.append(counted.where("aligned").select("key", "n_tokens"))
        rest = counted.where("NOT aligned").select("key")
        if rest.isEmpty():
            break
        long, step, overlap = long.join(rest, "key", "left_semi"), step * WIDER, overlap * WIDER
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def count_tokens(docs: DataFrame, model: str, keep: Iterable[str] = ("doc_id",), step: int = STEP, overlap: int = OVERLAP) -> DataFrame:
    """Columns keep of docs with n_bytes (of the text in UTF-8) and n_tokens (of the library for the whole text).

    model is the text of a tokenizer's JSON file. No tokens are added; special strings inside a text count as the library
    takes them, as one token each. A null text is empty and has no bytes and no tokens. Repeated rows stay, ids may be null,
    other columns play no part whatever their names; an empty table gives an empty one.

    Counts are added up over parts of a text, of which the library encodes those that a worker didn't meet lately.
    Texts of more than step + overlap bytes are encoded in chunks, which tasks share out whatever text they are of, and
    spliced at proven boundaries (see above). A tokenizer of which these can't be proven encodes every text as a whole. A text
    without any boundary for long, like one endless word, is one piece in the end: the library's merges depend on all of it.
    """
    hidden, marks = margin(model), marks_of(model)
    if hidden is not None and not 4 * hidden < overlap < step:
        raise ValueError(f"an overlap has more than {4 * hidden} bytes, which a cut may hide, and is shorter than a step")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = whole_text(F.col("text"))
    source = docs.select(F.struct(*keep).alias("row"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    short, long = (source.where(F.col("n_bytes") <= step + overlap), source.where(F.col("n_bytes") > step + overlap))
    long = long.withColumn("key", F.sha2(F.col("text").cast("binary"), 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value, marks)
        for batch in batches:
            counts = [n for _, texts in chunks(batch.column("text"), BATCH) for n in counter([t.decode() for t in texts])]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["row", "n_bytes", "n_tokens"])

    kind = source.schema["row"].dataType.simpleString()
    counted = short.mapInArrow(run, f"row {kind}, n_bytes long, n_tokens long")
    if not long.isEmpty():
        totals = _count_long(long.select("key", "text"), shared, hidden, marks, step, overlap)
        counted = counted.unionByName(long.select("row", "n_bytes", "key").join(totals, "key").drop("key"))
    return counted.select("row.*", "n_bytes", "n_tokens")
