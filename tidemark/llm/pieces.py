"""SentencePiece encoding that keeps, for every piece, the bytes of the source text that it came from."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁".encode()
#: Bytes of text that are encoded at a time.
CHUNK = 1 << 20


class CharacterMap:
    """The compiled character map of a model: a double-array trie of source prefixes, and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.texts = blob[4 + size :] if size else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix of data[at:] that the map knows."""
        if not self.units:
            return None
        found, node = None, self._offset(self.units[0])
        for length in range(1, len(data) - at + 1):
            byte = data[at + length - 1]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                begin = self.units[node] & 0x7FFFFFFF
                found = length, self.texts[begin : self.texts.index(b"\0", begin)]
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Alignment:
    """Normalises texts by the rules of a model and tells for each byte of the result the source byte it came from."""

    def __init__(self, spec) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and one source offset for each of them and for the end."""
        if not source:
            return b"", np.zeros(1, dtype=np.int64)
        if self.map.units or self.squeeze or not self.escape:
            return self._by_prefix(source)
        raw = np.frombuffer(source, dtype=np.uint8)
        wide = np.where(raw == 0x20, len(BLANK), 1)
        places = np.repeat(np.arange(len(raw)), wide)
        head = len(BLANK) if self.prefix else 0
        return (BLANK if head else b"") + source.replace(b" ", BLANK), np.concatenate((np.zeros(head, dtype=np.int64), places, [len(raw)]))

    def _by_prefix(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """Replace the longest known prefix again and again; a character that begins none stays as it is."""
        blank = BLANK if self.escape else b" "
        parts: list[tuple[bytes, int, int]] = []
        at = 0
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit is None:
                first = source[at]
                length = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                hit = length, source[at : at + length]
            parts.append((hit[1], at, at + hit[0]))
            at += hit[0]
        text, places, after_blank, end = [], [], self.squeeze, 0
        if self.prefix:
            text.append(blank)
            places += [0] * len(blank)
        for new, begin, stop in parts:
            if self.squeeze and after_blank:
                stripped = new.lstrip(b" ")
                if new and not stripped:
                    continue
                new = stripped
            if new:
                shown = new.replace(b" ", blank)
                text.append(shown)
                places += [begin] * len(shown)
                after_blank = self.squeeze and new.endswith(b" ")
                end = stop
        whole = b"".join(text)
        if self.squeeze:
            while whole.endswith(blank):
                whole = whole[: -len(blank)]
                end = places[len(whole)]
                places = places[: len(whole)]
        if not self.squeeze:
            end = len(source)
        return whole, np.array([*places, end], dtype=np.int64)


class PieceCodec:
    """A model with the byte lengths of its pieces."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        byte_kind, unknown = sentencepiece_model_pb2.ModelProto.SentencePiece.BYTE, sentencepiece_model_pb2.ModelProto.SentencePiece.UNKNOWN
        self.lengths = np.array([1 if p.type == byte_kind else -1 if p.type == unknown else len(p.piece.encode()) for p in proto.pieces], dtype=np.int64)
        self.align = Alignment(proto.normalizer_spec)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int32) for ids in self.model.encode(texts, num_threads=1)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.model.decode([x.tolist() for x in ids], num_threads=1) if ids else []

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every piece in the UTF-8 bytes of text.

        A piece that starts with the blank before the text starts at 0 with no byte for it; the bytes of a character that
        the model spells out in bytes are told apart.
        """
        normal, places = self.align(text.encode("utf-8", "replace"))
        sizes = self.lengths[ids]
        if (sizes < 0).any():
            sizes = np.array([len(p.encode()) for p in self.model.encode(text, out_type=str)], dtype=np.int64)
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("the pieces don't cover the normalised text")
        return places[ends - sizes].astype(np.int32), places[ends].astype(np.int32)


_codecs: dict[int, PieceCodec] = {}


def _codec(model: bytes) -> PieceCodec:
    """One codec for each model in a worker, whatever number of tasks it runs."""
    key = hash(model)
    if key not in _codecs:
        _codecs[key] = PieceCodec(model)
    return _codecs[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, model: bytes, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Columns keep of docs with ids, starts, ends and decoded.

    ids are those of the library for the whole text, without begin or end ids; starts and ends are the byte spans of the
    pieces in the UTF-8 text; decoded is the library's text for the ids. A null text counts as empty, and an empty one has
    empty lists and an empty decoded text. Repeated rows stay. model has the bytes of a model file, which are broadcast.
    """
    keep = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
        begin = size = 0
        for k, n in enumerate(pc.binary_length(texts).to_pylist()):
            size += n
            if size >= CHUNK:
                yield begin, k + 1
                begin, size = k + 1, 0
        if begin < len(texts):
            yield begin, len(texts)

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        offsets = np.cumsum([0] + [len(a) for a in arrays])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays), pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            for begin, end in chunks(batch.column("text")):
                part = batch.slice(begin, end - begin)
                texts = part.column("text").to_pylist()
                ids = codec.encode(texts)
                spans = [codec.spans(t, x) for t, x in zip(texts, ids)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), lists(ids), lists([s for s, _ in spans]), lists([e for _, e in spans]), pa.array(codec.decode(ids), pa.string())],
                    names=["row", "ids", "starts", "ends", "decoded"],
                )

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string").select("row.*", "ids", "starts", "ends", "decoded")
