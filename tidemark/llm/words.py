"""Word and shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
#: Bytes of text that are hashed at a time.
CHUNK = 1 << 21

_bytes = np.arange(256)
_letter = (_bytes >= 0x80) | ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x41) & (_bytes <= 0x5A)) | ((_bytes >= 0x61) & (_bytes <= 0x7A))
_folded = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes)


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, size=n, dtype=np.uint64)


_BYTE = _random(1, 256)[_folded]
_PLACE = _random(2, 1024) | np.uint64(1)
_WORD = _random(3, 64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Hashes of the words of several texts, and where the words of each text begin (one more entry than texts).

    first and stop are the byte places of the words in the texts laid side by side with a zero byte behind each.
    """

    hashes: np.ndarray
    begins: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    text_begins: np.ndarray


def hash_words(texts: list[bytes]) -> Words:
    """Words are runs of letters, digits and bytes of other alphabets, with A-Z lower-cased; hashes are of whole words."""
    raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_begins = np.concatenate(([0], np.cumsum(sizes)))
    inside = _letter[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    first, stop = edges[0::2], edges[1::2]
    if not len(first):
        return Words(np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), first, stop, text_begins)
    letters = raw[inside]
    lengths = stop - first
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(offsets, lengths)
    hashes = mix(np.add.reduceat(_BYTE[letters] * _PLACE[place & 1023], offsets) + lengths.astype(np.uint64))
    return Words(hashes, np.searchsorted(first, text_begins), first, stop, text_begins)


def shingles(words: Words, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of size words, and where those of each text begin. A shorter text with words is one window."""
    counts = np.diff(words.begins)
    n_windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begins = np.concatenate(([0], np.cumsum(n_windows)))
    starts = np.repeat(words.begins[:-1], n_windows) + np.arange(begins[-1]) - np.repeat(begins[:-1], n_windows)
    ends = np.repeat(words.begins[1:], n_windows)
    padded = np.concatenate((words.hashes, np.zeros(size, dtype=np.uint64)))
    sums = np.zeros(len(starts), dtype=np.uint64)
    whole = bool((counts >= size).all())
    for k in range(size):
        part = padded[starts + k] * _WORD[k]
        sums += part if whole else np.where(starts + k < ends, part, np.uint64(0))
    return mix(sums), begins


def chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes, null ones as empty, in lists of about most bytes; with the row where each list begins."""
    begin = size = 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for k, n in enumerate(sizes):
        size += n
        if size >= most or k == len(sizes) - 1:
            part = texts.slice(begin, k + 1 - begin).cast(pa.binary()).to_pylist()
            yield begin, [t or b"" for t in part]
            begin, size = k + 1, 0
