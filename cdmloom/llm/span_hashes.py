"""Document fingerprints from prefix polynomial hashes.

Texts of a batch are laid end to end, and one modular prefix array (two bases, modulo the prime 2^31 - 1)
is made over them. The hash of any span, ``P[b] - P[a] * B^(b - a)``, depends on its content alone, so the array
answers whether any two spans are equal, within a text or between texts, and a binary search over such answers
finds how far two places go on alike (:func:`common_extensions`).

A fingerprint holds a text's length, the prefix hash of the whole, and the prefix hashes at up to ``PIECES - 1``
cuts. A cut stands where the hash of the next ``WINDOW`` code points ends in so many zero bits (its level), so cuts follow
the content and not the place; the level asked for rises until few enough are left. Prefix hashes at cuts give the
hash of every piece between two cuts, also of the longer pieces between cuts of a higher level, so fingerprints of
a short and of a long text can be compared. Their likeness is the share of both texts in pieces that they have in
common: twice the common length by the sum of lengths. Equal texts have equal fingerprints.

:func:`edited_fingerprints` needs each document's successor in descending order of ids. Rows are dealt to ranges of
ids, whose bounds are quantiles; the first row of a range is also sent to the range before. Ranges are sorted by the
shuffle and streamed, so a task holds a few texts at a time. Texts move once.

Defined results: null text counts as empty, with n_chars 0 and a likeness of 1 to another empty text, of 0 to any
other; null ids come last; rows with one id follow each other in the descending order of a hash of their text, and
rows alike in both are interchangeable; the successor of the last row is the first, which of a single row is itself;
an empty table gives no rows; only the id, a whole number, and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import lists, small_batches, whole_text

MODULUS = (1 << 31) - 1
BASES = (1_145_207_897, 2_023_406_814)
#: Places that share a table of powers.
BLOCK = 1 << 14
#: Blocks worked on at once.
SLAB = 4
#: Code points that decide on a cut, the lowest level of a cut, and the pieces of a fingerprint at most.
WINDOW = 8
LEVEL = 3
PIECES = 32
#: Rows of a range of ids, and ranges at most: bounds and first ids of the ranges are held by the driver.
RANGE_ROWS = 2048
RANGES = 16_384
#: Code points gathered before they are hashed together.
BATCH_CHARS = 1 << 19

def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1 or a little more (2^31 + 2 at most), for unsigned x below 2^63."""
    high = x >> 31
    x = x & MODULUS
    x += high
    np.right_shift(x, 31, out=high)
    x &= MODULUS
    x += high
    return x


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for unsigned x below 2^63."""
    x = _folded(x)
    x -= (x >= MODULUS).astype(np.uint64) * np.uint64(MODULUS)
    return x


@cache
def _tables(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to BLOCK of base k and of its inverse."""
    out = []
    for base in (BASES[k], pow(BASES[k], -1, MODULUS)):
        powers, x = [], 1
        for _ in range(BLOCK + 1):
            powers.append(x)
            x = x * base % MODULUS
        out.append(np.array(powers, np.uint64))
    return out[0], out[1]


@cache
def _far(k: int, blocks: int) -> np.ndarray:
    """Powers of base k at the multiples of BLOCK below ``blocks``, a power of two."""
    step, out = pow(BASES[k], BLOCK, MODULUS), [1]
    while len(out) < blocks:
        out.append(out[-1] * step % MODULUS)
    return np.array(out, np.uint64)


def _power(k: int, lengths: np.ndarray) -> np.ndarray:
    lengths = np.asarray(lengths, np.int64)
    far = lengths >> 14
    most = int(far.max(initial=0))
    near = _tables(k)[0][lengths & (BLOCK - 1)]
    return near if most == 0 else _folded(near * _far(k, 1 << most.bit_length())[far])


@cache
def _near(k: int) -> list[int]:
    return _tables(k)[0].tolist()


def _one_power(k: int, length: int) -> int:
    return _near(k)[length] if length <= BLOCK else pow(BASES[k], length, MODULUS)


class Prefixes:
    """The prefix array of a sequence of whole numbers below 2^31 - 1."""

    def __init__(self, codes: np.ndarray) -> None:
        self.size = len(codes)
        self._at = [self._prefixes(codes, k) for k in range(len(BASES))]

    def _prefixes(self, codes: np.ndarray, k: int) -> np.ndarray:
        powers, inverse = _tables(k)
        out = np.zeros(self.size + 1, np.uint32)
        carry = 0
        for begin in range(0, self.size, SLAB * BLOCK):
            some = np.asarray(codes[begin : begin + SLAB * BLOCK], np.uint64)
            rows = -(-len(some) // BLOCK)
            some = np.pad(some, (0, rows * BLOCK - len(some))).reshape(rows, BLOCK)
            local = _folded(np.cumsum(_folded(some * inverse[:BLOCK]), axis=1))
            local = _folded(local * powers[:BLOCK])
            carries = []
            for last in local[:, -1].tolist():
                carries.append(carry)
                carry = (carry * int(powers[BLOCK]) + last) % MODULUS
            whole = _mod(np.array(carries, np.uint64)[:, None] * powers[None, 1:] + local)
            out[begin + 1 : begin + 1 + rows * BLOCK] = whole.reshape(-1)[: self.size - begin]
        return out

    def part(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end) to one base."""
        at = self._at[k]
        head = _folded(at[start] * _power(k, np.asarray(end) - np.asarray(start)))
        return _mod(at[end] + (np.uint64(2 * MODULUS) - head))

    def windows(self, k: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
        """Hashes of all spans of one width to one base, in stretches that begin at the place given."""
        at, power, step = self._at[k], np.uint64(_one_power(k, width)), SLAB * BLOCK
        for begin in range(0, self.size - width + 1, step):
            end = min(begin + step, self.size - width + 1)
            yield begin, _mod(at[begin + width : end + width] + (np.uint64(2 * MODULUS) - _folded(at[begin:end] * power)))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end), of 62 bits. Equal spans have equal hashes."""
        return (self.part(0, start, end) << np.uint64(31)) | self.part(1, start, end)

    def extensions(self, left: np.ndarray, right: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many places from ``left`` and from ``right`` on (or back) are alike, ``most`` at most; by binary search."""
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        low, high = np.zeros(len(left), np.int64), np.asarray(most, np.int64).copy()
        open_ = np.nonzero(low < high)[0]
        while len(open_):
            length = (low[open_] + high[open_] + 1) // 2
            a, b = left[open_], right[open_]
            if back:
                same = self.spans(a - length, a) == self.spans(b - length, b)
            else:
                same = self.spans(a, a + length) == self.spans(b, b + length)
            low[open_] = np.where(same, length, low[open_])
            high[open_] = np.where(same, high[open_], length - 1)
            open_ = open_[low[open_] < high[open_]]
        return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def laid_out(texts: Iterable[str]) -> tuple[Prefixes, np.ndarray]:
    """The prefix array of the texts laid end to end, and where each one starts; the last place is the end."""
    parts = [code_points(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return Prefixes(np.concatenate([np.zeros(0, np.uint32), *parts]) + np.uint32(1)), starts


class Fingerprint:
    """Length, level, prefix hash of the whole, and the cuts (place, level, prefix hash) of one text."""

    def __init__(self, size: int, level: int, whole: int, cuts: list[tuple[int, int, int]]) -> None:
        self.size, self.level, self.whole, self.cuts = size, level, whole, cuts
        self._pieces: dict[int, Counter] = {}

    def text(self) -> str:
        return f"{self.size:08x}{self.level:02x}{self.whole:016x}" + "".join([f"{place:08x}{level:02x}{hash:016x}" for place, level, hash in self.cuts])

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        (size, level, whole), *cuts = [(int(text[i : i + 8], 16), int(text[i + 8 : i + 10], 16), int(text[i + 10 : i + 26], 16)) for i in range(0, len(text), 26)]
        return cls(size, level, whole, cuts)

    def pieces(self, level: int) -> Counter:
        """(hash, length) of the pieces between cuts of that level, with how often each occurs."""
        if level not in self._pieces:
            out, begin, one, two = [], 0, 0, 0
            for place, high, hash in [*self.cuts, (self.size, level, self.whole)]:
                if high >= level:
                    size, a, b = place - begin, hash >> 31, hash & MODULUS
                    out.append((((a - one * _one_power(0, size)) % MODULUS << 31) | ((b - two * _one_power(1, size)) % MODULUS), size))
                    begin, one, two = place, a, b
            self._pieces[level] = Counter(out)
        return self._pieces[level]


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of both texts in common pieces, from 0 to 1."""
    if not a.size or not b.size:
        return float(a.size == b.size)
    if a.size == b.size and a.whole == b.whole:
        return 1.0
    level = max(a.level, b.level)
    common = a.pieces(level) & b.pieces(level)
    return 2 * sum(size * times for (_, size), times in common.items()) / (a.size + b.size)


def fingerprints_of(prefixes: Prefixes, starts: np.ndarray, pieces: int = PIECES) -> list[Fingerprint]:
    """A fingerprint for each text of a layout."""
    places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for begin, window in prefixes.windows(0, WINDOW):
        at = np.nonzero((window & np.uint64((1 << LEVEL) - 1)) == 0)[0]
        places.append(at + begin)
        found.append(window[at].astype(np.int64))
    places, found = np.concatenate(places), np.concatenate(found)
    levels = np.where(found == 0, 31, np.round(np.log2(np.maximum(found & -found, 1)))).astype(np.int64)
    first = np.searchsorted(places, starts[:-1], "right")
    last = np.searchsorted(places, starts[1:] - WINDOW, "right")
    whole = prefixes.spans(starts[:-1], starts[1:]).tolist()
    chosen = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        level, here = LEVEL, levels[a:b]
        if b - a >= pieces:
            at_least = np.cumsum(np.bincount(here, minlength=34)[::-1])[::-1]
            level = int(np.argmax((at_least < pieces) & (np.arange(len(at_least)) >= LEVEL)))
            chosen.append((level, a + np.nonzero(here >= level)[0]))
        else:
            chosen.append((level, np.arange(a, max(a, b))))
    picked = np.concatenate([np.zeros(0, np.int64), *[c for _, c in chosen]]).astype(np.int64)
    owner = np.repeat(np.arange(len(chosen)), [len(c) for _, c in chosen])
    cut = places[picked]
    cuts = list(zip((cut - starts[owner]).tolist(), levels[picked].tolist(), prefixes.spans(starts[owner], cut).tolist(), strict=True))
    out, end = [], 0
    for i, (level, c) in enumerate(chosen):
        out.append(Fingerprint(int(starts[i + 1] - starts[i]), level, whole[i], cuts[end : end + len(c)]))
        end += len(c)
    return out


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in lists(batches):
            made = fingerprints_of(*laid_out(texts))
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n_chars": [f.size for f in made], "fingerprint": [f.text() for f in made]})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("id"), whole_text(text).alias("text"))
    return rows.mapInArrow(run, "id long, n_chars long, fingerprint string").withColumnRenamed("id", id)


def likeness_of(a: str | Column, b: str | Column) -> Column:
    """The likeness of two columns of fingerprints."""

    @F.pandas_udf("double")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([likeness(Fingerprint.of(x), Fingerprint.of(y)) for x, y in zip(left, right, strict=True)], dtype=float)

    return alike(a, b)


def common_extensions(pairs: DataFrame, left: str, right: str, left_from: str, right_from: str, name: str = "extension") -> DataFrame:
    """``pairs`` with how many code points its two texts have in common from two places on. A place out of its text gives 0."""

    @F.pandas_udf("long")
    def extend(a: pd.Series, b: pd.Series, i: pd.Series, j: pd.Series) -> pd.Series:
        prefixes, starts = laid_out([*a, *b])
        sizes, n = np.diff(starts), len(a)
        i, j = i.to_numpy(np.int64), j.to_numpy(np.int64)
        inside = (i >= 0) & (j >= 0) & (i <= sizes[:n]) & (j <= sizes[n:])
        most = np.where(inside, np.minimum(sizes[:n] - i, sizes[n:] - j), 0)
        return pd.Series(prefixes.extensions(starts[:n] + np.where(inside, i, 0), starts[n:-1] + np.where(inside, j, 0), most))

    small_batches(pairs.sparkSession)
    place = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1))
    return pairs.withColumn(name, extend(whole_text(left), whole_text(right), place(left_from), place(right_from)))


def _ranges(docs: DataFrame, id: str, rows: int) -> tuple[Column, int]:
    """The ranges each row goes to, its own one first, as a column of arrays; and how many ranges there are."""
    count = docs.count()
    parts = max(1, min(RANGES, -(-count // rows)))
    bounds: list[int] = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        found = docs.agg(F.percentile_approx(F.col(id).cast("long"), shares, max(10_000, 4 * parts))).first()[0]
        bounds = sorted(set(found or []))

    def place(ids: pd.Series) -> np.ndarray:
        """Large ids first, null ids last."""
        gone = ids.isna().to_numpy()
        at = np.searchsorted(np.array(bounds, np.int64), ids.fillna(0).astype("int64").to_numpy(), "left")
        return np.where(gone, len(bounds) + 1, len(bounds) - at)

    @F.pandas_udf("int")
    def own(ids: pd.Series) -> pd.Series:
        return pd.Series(place(ids).astype(np.int32))

    key = F.col(id).cast("long")
    heads = sorted(tuple(r) for r in docs.groupBy(own(key).alias("part")).agg(F.max(key).alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def targets(ids: pd.Series) -> pd.Series:
        known = [None if gone else int(x) for x, gone in zip(ids, ids.isna(), strict=True)]
        return pd.Series([[p, before[x]] if x in before else [p] for x, p in zip(known, place(ids).tolist(), strict=True)])

    return targets(key), len(bounds) + 2


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document's fingerprint, and that of an edited form that ends as its successor begins.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, alike_edited, alike_next):
    the last half of the text is replaced by as many code points of the next document; ``near_*`` are likenesses of
    fingerprints, ``alike_*`` how many code points from the start on are the same, exactly.
    """
    schema = f"`{id}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, alike_edited long, alike_next long"

    def work(texts: list[str], pairs: list[tuple[int, int | None]]) -> pa.RecordBatch:
        """``pairs``: the place of a text followed by its successor, and its id."""
        edited = []
        for i, _ in pairs:
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[i + 1][:half])
        prefixes, starts = laid_out([*texts, *edited])
        made = fingerprints_of(prefixes, starts)
        sizes, n = np.diff(starts), len(texts)
        at = np.array([i for i, _ in pairs], np.int64)
        forms = np.arange(n, n + len(edited))
        alike = [prefixes.extensions(starts[at], starts[other], np.minimum(sizes[at], sizes[other])) for other in (forms, at + 1)]
        own, next_, form = [made[i] for i in at], [made[i + 1] for i in at], made[n:]
        return pa.RecordBatch.from_pydict(
            {
                id: pa.array([x for _, x in pairs], pa.int64()),
                "n_chars": pa.array([f.size for f in own], pa.int64()),
                "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                "fingerprint": [f.text() for f in own],
                "edited_fingerprint": [f.text() for f in form],
                "near_edited": pa.array([likeness(a, b) for a, b in zip(own, form, strict=True)], pa.float64()),
                "near_next": pa.array([likeness(a, b) for a, b in zip(own, next_, strict=True)], pa.float64()),
                "alike_edited": alike[0],
                "alike_next": alike[1],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, pairs, chars, before = [], [], 0, None
        for batch in lists(batches):
            for part, guest, doc, text_ in zip(*batch, strict=True):
                texts.append(text_)
                chars += len(text_)
                if before is not None and before[0] == part and not before[1]:
                    pairs.append((len(texts) - 2, before[2]))
                before = part, guest, doc
                if chars >= BATCH_CHARS and pairs:
                    yield work(texts, pairs)
                    texts, pairs, chars = texts[-1:], [], len(text_)
        if pairs:
            yield work(texts, pairs)

    small_batches(docs.sparkSession)
    targets, parts = _ranges(docs, id, range_rows)
    rows = docs.select(F.col(id).cast("long").alias("id"), whole_text(text).alias("text"), targets.alias("targets"))
    rows = rows.select("id", "text", F.posexplode("targets").alias("guest", "part"))
    order = ("part", "guest", F.col("id").desc_nulls_last(), F.xxhash64("text").desc())
    sorted_rows = rows.repartition(parts, "part").sortWithinPartitions(*order)
    return sorted_rows.select("part", "guest", "id", "text").mapInArrow(run, schema)
