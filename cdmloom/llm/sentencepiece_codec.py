"""SentencePiece encoding that keeps offsets, and decoding.

The normaliser is written out here: it takes the longest prefix that the model's compiled
character map (a double array) replaces, puts in the marks for white space that the model
asks for, and records for each normalised byte the original byte it came from. The library
merges the normalised text, with its own normaliser switched off, into pieces. Pieces tile
the normalised text, so the alignment projects each one to a span of original bytes.
Texts are encoded where they lie; nothing is shuffled.

Defined results: null text counts as empty (no ids); null ids and repeated rows come out
as they went in; an empty table gives no rows; only the id and the text are read, so other
columns may have any name. A piece made of marks alone (the added leading one) has an empty span.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import small_batches, tokenizer_path, whole_text

MODEL = "piece_bpe_32k.model"
MARK = "▁".encode()

# Field numbers of the public model format (fixed values).
NORMALIZER = 3
PIECE = 1
NAME, CHARMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 1, 2, 3, 4, 5
BYTE_PIECE = 6


def fields(message: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire type, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, kind, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, kind, message[at : at + size]
        at += size


def varint_bytes(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def without_normaliser(model: bytes) -> bytes:
    """The same model, whose normaliser passes text on as it is."""
    plain = b"".join([varint_bytes(NAME << 3 | 2), b"\x08identity", *(bytes([f << 3, 0]) for f in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))])
    out = [varint_bytes(NORMALIZER << 3 | 2), varint_bytes(len(plain)), plain]
    for number, kind, value in fields(model):
        if number != NORMALIZER:
            head = varint_bytes(number << 3 | kind)
            out += [head, varint_bytes(value)] if kind == 0 else [head, *([varint_bytes(len(value))] if kind == 2 else []), value]
    return b"".join(out)


class CharacterMap:
    """The compiled map: a double array over UTF-8 bytes, whose values point at replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def longest_prefix(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest key that the text has at this place."""
        units, found = self.units, None
        node = self._child(units[0])
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(units) or units[node] & 0x800000FF != text[end]:
                break
            unit = units[node]
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1] : self.strings.index(b"\0", found[1])]

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normaliser:
    """What a model asks for, with the original place of each normalised byte."""

    def __init__(self, model: bytes) -> None:
        spec = next((v for n, _, v in fields(model) if n == NORMALIZER), b"")
        values = {n: v for n, _, v in fields(spec)}
        blob = values.get(CHARMAP) or b""
        self.map = CharacterMap(blob) if blob else None
        self.dummy_prefix, self.remove_extra, self.escape = (bool(values.get(f, 1)) for f in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the original offset."""
        if self.map or self.remove_extra:
            out, at = self._mapped(text)
        else:
            out, at = text, np.arange(len(text), dtype=np.int64)
        end = len(text)
        if not len(out):
            return b"", np.array([end], np.int64)
        if self.dummy_prefix:
            out, at = b" " + out, np.concatenate([at[:1], at])
        if self.escape:
            spaces = np.frombuffer(out, np.uint8) == 0x20
            out, at = out.replace(b" ", MARK), np.repeat(at, np.where(spaces, len(MARK), 1))
        return out, np.append(at, end)

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, at, place, after_space = bytearray(), [], 0, self.remove_extra
        while place < len(text):
            hit = self.map.longest_prefix(text, place) if self.map else None
            if hit:
                taken, new = hit
            else:
                lead = text[place]
                taken = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = text[place : place + taken]
            for byte in new:
                if self.remove_extra and byte == 0x20 and after_space:
                    continue
                after_space = byte == 0x20
                out.append(byte)
                at.append(place)
            place += taken
        while self.remove_extra and out.endswith(b" "):
            out.pop()
            at.pop()
        return bytes(out), np.array(at, np.int64)


class Encoded(NamedTuple):
    ids: list[int]
    begins: np.ndarray
    ends: np.ndarray


class Codec:
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            model = f.read()
        self.normalise = Normaliser(model)
        self.merge, self.library = SentencePieceProcessor(), SentencePieceProcessor()
        self.merge.LoadFromSerializedProto(without_normaliser(model))
        self.library.LoadFromSerializedProto(model)
        pieces = [{f: x for f, _, x in fields(v)} for n, _, v in fields(model) if n == PIECE]
        #: Normalised bytes of each piece; a byte piece stands for one.
        self.bytes = np.array([1 if p.get(3) == BYTE_PIECE else len(p.get(1, b"")) for p in pieces], np.int64)
        self.unknown = self.library.unk_id()
        self.decimal = [str(i) for i in range(len(pieces))]

    def encode(self, text: str) -> Encoded:
        """Ids as the library gives them for the text, and the original bytes of each."""
        normal, origin = self.normalise(text.encode("utf-8", "replace"))
        normal_text = normal.decode("utf-8", "replace")
        ids = self.merge.encode(normal_text)
        got = np.array(ids, np.int64)
        if (got == self.unknown).any():  # such a piece has the length of what it stands for
            shown = self.merge.encode(normal_text, out_type="immutable_proto").pieces
            sizes = np.array([len(p.surface.encode()) for p in shown], np.int64)
        else:
            sizes = self.bytes[got]
        until = np.cumsum(sizes)
        return Encoded(ids, origin[until - sizes], origin[until])

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@cache
def codec(path: str) -> Codec:
    """One for each Python worker."""
    return Codec(path)


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids, begins, ends, decoded): pieces with the UTF-8 bytes of the original they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(model))
        for batch in batches:
            done = [c.encode(t) for t in batch.column(1).to_pylist()]
            arrays = [pa.array([d[i] for d in done], pa.list_(pa.int32())) for i in range(3)]
            decoded = pa.array([c.decode(d.ids) for d in done], pa.string())
            yield pa.record_batch([batch.column(0), *arrays, decoded], ["id", "ids", "begins", "ends", "decoded"])

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id]
    return (
        docs.select(F.col(id).alias("id"), whole_text(text).alias("text"))
        .mapInArrow(run, f"id {kind}, ids array<int>, begins array<int>, ends array<int>, decoded string")
        .withColumnRenamed("id", id)
    )


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """What ``encode`` gives, as digests made where the text lies, so that no list of ids leaves the worker.

    (id, n_tokens, ids_sha256, decoded_sha256, spans_sha256, covered_bytes): the span digest is that of
    the ends as little-endian 64-bit numbers, and covered_bytes the bytes that the spans tile without a gap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(model))
        sha = hashlib.sha256
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                done = c.encode(t)
                joined = ",".join(map(c.decimal.__getitem__, done.ids)).encode()
                rows.append(
                    (
                        len(done.ids),
                        sha(joined).hexdigest(),
                        sha(c.decode(done.ids).encode()).hexdigest(),
                        sha(done.ends.astype("<i8").tobytes()).hexdigest(),
                        int((done.ends - done.begins).sum()),
                    )
                )
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch([batch.column(0), *made], ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "covered_bytes"])

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id]
    return (
        docs.select(F.col(id).alias("id"), whole_text(text).alias("text"))
        .mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, covered_bytes long")
        .withColumnRenamed("id", id)
    )
