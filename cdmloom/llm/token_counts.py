"""Token counts by a map-side two-tier lookup.

A byte-level BPE never merges across pre-tokens, so a text's count is the sum of its
pre-tokens' counts. Tier one is a broadcast table of the corpus's most frequent
pre-tokens and their lengths in tokens, of ``slots`` entries at most whatever the
corpus. Tier two encodes what the table lacks and keeps the length in a bounded cache
of the Python worker. Texts never move, and no pre-token of the corpus is shuffled:
to find the frequent ones, each task reduces all its texts to summaries of fixed size,
and only those are merged. Which pre-tokens the table holds changes the speed alone.

Pre-tokens are cut with a pattern whose classes are spelled out for the code points in
``PLAIN``. A text with any other code point or with a special token's string, and every
text if the tokenizer cuts in another way, goes to the library whole.

Defined results: null text counts as empty (0 tokens, 0 bytes); null ids and repeated
rows come out as they went in; an empty table gives no rows; only the id and the text
are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from heapq import nlargest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import lists, small_batches, tokenizer_path, whole_text

TOKENIZER = "byte_bpe_50k.json"
#: Entries of the broadcast table; about 2 MB.
SLOTS = 65_536
#: Distinct pre-tokens a task counts before it hands on its most frequent ones.
COUNTED = 300_000
#: Entries of one summary.
SUMMARY = 16_384
#: Lengths of rare pre-tokens that a worker keeps; about 50 MB.
CACHED = 400_000

#: Code points whose class is the same in every version of Unicode since 5.0.
PLAIN = re.compile("[\x00-\x1b\x20-ɏ‐-‧€]*")
#: White space among them.
SPACE = "\t\n\x0b\x0c\r \x85\xa0"


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind)


def _pattern() -> re.Pattern[str]:
    letter, number, space = _class("L"), _class("N"), re.escape(SPACE)
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


PRE_TOKEN = _pattern()


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _specials(path: str) -> tuple[str, ...] | None:
    """Strings that end a pre-token wherever they stand; None if this tokenizer cuts otherwise."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cut = spec.get("pre_tokenizer") or {}
    usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if not usual or spec.get("normalizer") or spec["model"].get("type") != "BPE":
        return None
    return tuple(t["content"] for t in spec.get("added_tokens") or ())


def pre_tokens(text: str, path: str) -> list[str] | None:
    """The text's pre-tokens, or None if the library has to cut it."""
    specials = _specials(path)
    if specials is None or not (text.isascii() and "\x1c" > max(text, default="") or PLAIN.fullmatch(text)):
        return None
    return None if any(s in text for s in specials) else PRE_TOKEN.findall(text)


class Lengths(dict):
    """Pre-token to number of tokens: the broadcast entries, and a cache of what was encoded."""

    def __init__(self, frequent: dict[str, int], path: str, cached: int) -> None:
        super().__init__(frequent)
        self.frequent, self.path, self.most = frequent, path, len(frequent) + cached

    def encoded(self, text: str) -> int:
        return len(_tokenizer(self.path).encode(text, add_special_tokens=False))

    def __missing__(self, pre_token: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(self.frequent)
        n = self[pre_token] = self.encoded(pre_token)
        return n

    def tokens(self, text: str) -> int:
        cut = pre_tokens(text, self.path)
        return self.encoded(text) if cut is None else sum(map(self.__getitem__, cut))


_LENGTHS: dict[str, tuple[object, Lengths]] = {}


def _worker_lengths(frequent: dict[str, int], path: str, cached: int) -> Lengths:
    """One table for each Python worker, kept from task to task."""
    held = _LENGTHS.get(path)
    if held is None or held[0] is not frequent:
        held = _LENGTHS[path] = frequent, Lengths(frequent, path, cached)
    return held[1]


def frequent_pre_tokens(
    docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, slots: int = SLOTS,
    counted: int = COUNTED, summary: int = SUMMARY,
) -> dict[str, int]:
    """The ``slots`` pre-tokens that the tasks' summaries name most often, with their counts of tokens."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, seen = tokenizer_path(tokenizer), Counter()

        def top() -> pa.RecordBatch:
            best = nlargest(summary, seen.items(), key=lambda x: x[1])
            seen.clear()
            return pa.record_batch([pa.array([k for k, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["pre", "n"])

        for (texts,) in lists(batches):
            for t in texts:
                seen.update(pre_tokens(t, path) or ())
                if len(seen) > counted:
                    yield top()
        yield top()

    small_batches(docs.sparkSession)
    named = docs.select(whole_text(text).alias("text")).mapInArrow(summaries, "pre string, n long")
    best = named.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(slots)
    path = tokenizer_path(tokenizer)
    return {r["pre"]: len(_tokenizer(path).encode(r["pre"], add_special_tokens=False)) for r in best.collect()}


def count_tokens(
    docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, limit: int = 1024,
    slots: int = SLOTS, cached: int = CACHED, frequent: dict[str, int] | None = None,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every document's whole text.

    ``frequent`` is a table made before by ``frequent_pre_tokens``; else it is made here.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if frequent is None:
        frequent = frequent_pre_tokens(docs, text, tokenizer, slots)
    shared = spark.sparkContext.broadcast(frequent)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _worker_lengths(shared.value, tokenizer_path(tokenizer), cached)
        for batch in batches:
            n = pa.array([lengths.tokens(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), n], ["id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)[id]
    return (
        docs.select(
            F.col(id).alias("id"),
            F.octet_length(whole_text(text)).cast("long").alias("n_bytes"),
            whole_text(text).alias("text"),
        )
        .mapInArrow(counts, f"id {kind}, n_bytes long, n_tokens long")
        .select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
