"""Jaccard self-join of word n-gram sets by chosen paths.

A document's set has the hashes of its runs of ``SHINGLE`` words (a shorter text has one, of all its words).
Equal sets become one representative with a count, so copies are never compared. Representatives are
split recursively: a node of the tree samples a coordinate of the min-hash signature, and members that share
the token there go to the same child. A child of ``LEAF`` members or fewer is a leaf. A larger one is a leaf
too if its members are alike on average, which more splitting would not part, or at ``DEPTH``; else it splits
again. Leaves are compared by brute force, large ones in pairs of blocks. Runs with fresh samples repeat until
pairs at the threshold are found with probability ``RECALL``, at the depth the trees have reached.

A pair is compared once, in the first leaf that has both (every member carries the list of its leaves):
byte sketches sift the members with a likely partner there, and the sets of those alone are made from their
texts and compared exactly. No pairs are written: a leaf gives each member the number of documents it is
linked to and a root, and roots make the classes.

Defined results: a text without words has no links and is a class of its own (its id); null ids count as
larger than others, and a class of null ids alone has the null class; repeated rows are copies of each other;
an empty table gives no rows; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from cdmloom.llm.common import small_batches, stored, whole_text
from cdmloom.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Coordinates of a signature.
TOKENS = 64
LEAF = 256
DEPTH = 5
#: A node whose members share this share of their tokens on average is compared, not split.
ALIKE = 0.4
#: Members that are looked at to judge that.
PROBES = 8
#: Members of large nodes that are broadcast to their signatures, at most; more are joined by a shuffle.
BROADCAST_MEMBERS = 400_000
#: A run begins with this many splits at once, as most nodes of one split share a passage and no more.
FIRST_DEPTH = 2
#: Runs are begun for trees of this depth; more follow if the trees get deeper.
EXPECTED_DEPTH = 3
#: Members of a block of a large leaf.
BLOCK = 512
#: Sketches that agree in a share of bytes this much below the threshold are still compared exactly: five deviations.
SLACK = 0.25
#: Ids that are broadcast to fetch texts, at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of an Arrow batch of sketches.
SKETCH_ROWS = 4096
SEED = 77

_RANDOM = np.random.default_rng(SEED)
_FACTOR = _RANDOM.integers(1, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_ROOTS = _RANDOM.permutation(TOKENS).tolist()
_BASE = np.uint64(0x9E3779B97F4A7C15)
RUN_BITS = 56


# Sets and signatures


def shingles(text: str, n: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the text's runs of n words."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxh3_64_intdigest, words)), np.uint64)
    width = min(n, len(h))
    out = h[: len(h) - width + 1].copy()
    for i in range(1, width):
        out *= _BASE
        out += h[i : len(h) - width + 1 + i]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.unique(out + np.uint64(width))


def signature(found: np.ndarray) -> np.ndarray:
    """The least hash of the set under each of ``TOKENS`` functions, 32 bits each."""
    least = np.full(TOKENS, (1 << 64) - 1, np.uint64)
    for begin in range(0, len(found), 1024):
        some = found[begin : begin + 1024]
        np.minimum(least, (some[None, :] * _FACTOR[:, None] + _SHIFT[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def set_key(found: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return hashlib.blake2b(found.astype("<u8").tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, id: str, text: str, n: int) -> DataFrame:
    """(id, h, key, signature, sketch); key is null for texts without words. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, signs, sketches = [], [], []
            for t in batch.column(2).to_pylist():
                found = shingles(t, n)
                if not len(found):
                    keys.append(None), signs.append(None), sketches.append(None)
                    continue
                s = signature(found)
                keys.append(set_key(found))
                signs.append(s.tobytes())
                sketches.append(s.astype(np.uint8).tobytes())
            made = [pa.array(x, pa.binary()) for x in (keys, signs, sketches)]
            yield pa.record_batch([batch.column(0), batch.column(1), *made], ["id", "h", "key", "signature", "sketch"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(whole_text(text)).alias("h"), whole_text(text).alias("text"))
    return stored(rows.mapInArrow(run, "id long, h long, key binary, signature binary, sketch binary"), "signed")


# The tree


def runs_needed(depth: int, recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold, split ``depth`` times, shares a leaf with probability ``recall``."""
    runs = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))
    if runs > TOKENS:
        raise ValueError(f"a recall of {recall} at similarity {threshold} takes {runs} runs of depth {depth}; signatures hold {TOKENS}")
    return runs


def _token(at: Column) -> Column:
    return F.substring("signature", at * 4 + 1, F.lit(4))


def _node(run: Column, *path: Column) -> Column:
    """The run in the upper bits, so that leaves are in the order of their runs."""
    return F.shiftleft(run.cast("long"), RUN_BITS).bitwiseOR(F.xxhash64(*path).bitwiseAND(F.lit((1 << RUN_BITS) - 1)))


def _sampled(node: Column) -> Column:
    """The coordinate that a node samples."""
    return F.pmod(F.xxhash64(node, F.lit(SEED)), F.lit(TOKENS)).cast("int")


def _children(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (node, key): the members with the size of their node, where that is 2 or more; leaves and the rest."""
    sizes = members.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    both = stored(members.join(sizes, "node"), "nodes")
    return both.where(F.col("size") <= LEAF), both.where(F.col("size") > LEAF)


def _with_signature(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Members of large nodes with their signatures; few members go to the signatures, not the other way."""
    members = F.broadcast(members) if members.count() <= BROADCAST_MEMBERS else members
    return reps.select("key", "signature").join(members, "key")


def _likeness(signatures: list[Column]) -> Column:
    """The share of tokens that two of the signatures have in common, on average."""
    places = F.sequence(F.lit(0), F.lit(TOKENS - 1))
    same = lambda x, y: F.size(F.filter(places, lambda i: F.substring(x, i * 4 + 1, F.lit(4)) == F.substring(y, i * 4 + 1, F.lit(4))))
    pairs = [(x, y) for n, x in enumerate(signatures) for y in signatures[:n]]
    return sum((same(x, y) for x, y in pairs), F.lit(0)) / float(TOKENS * len(pairs))


def _split(members: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of large nodes: those of nodes that are alike as they are, the others by child.

    How alike a node is, is judged by a few members; this steers the work and loses no pair.
    """
    full = stored(_with_signature(members, reps), "large")
    some = full.groupBy("node").agg(*[F.min_by("signature", F.xxhash64("key", F.lit(SEED + i))).alias(f"s{i}") for i in range(PROBES)])
    nodes = stored(some.select("node", (_likeness([F.col(f"s{i}") for i in range(PROBES)]) >= ALIKE).alias("alike")), "alike")
    judged = full.join(nodes, "node")
    child = _node(F.shiftrightunsigned("node", RUN_BITS), F.col("node"), F.col("at"), _token(F.col("at")))
    below = judged.where(~F.col("alike")).withColumn("at", _sampled(F.col("node"))).select(child.alias("node"), "key")
    below = stored(below, "below")
    return members.join(nodes.where("alike"), "node").select("node", "key", "size"), below


def _first_coordinates(run: int) -> tuple[int, int]:
    """Two coordinates, which no other of the first ``TOKENS / 2`` runs has."""
    again = run * 2 // TOKENS
    return _ROOTS[run * 2 % TOKENS], _ROOTS[(run * 2 + 1 + 2 * again) % TOKENS]


def leaves(reps: DataFrame, recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """(node, key, size) of every leaf with two members or more. Stored piece by piece."""
    done, first, deepest = [], 0, EXPECTED_DEPTH
    while first < (last := runs_needed(deepest, recall, threshold)):
        roots = [F.struct(F.lit(r).alias("run"), *[F.lit(c).alias(n) for n, c in zip(("one", "two"), _first_coordinates(r), strict=True)]) for r in range(first, last)]
        top = reps.select("key", "signature", F.explode(F.array(*roots)).alias("root"))
        members = top.select(_node(F.col("root.run"), F.lit(SEED), F.col("root.run"), _token(F.col("root.one")), _token(F.col("root.two"))).alias("node"), "key")
        for depth in range(FIRST_DEPTH, DEPTH + 1):
            leaf, large = _children(members)
            done.append(leaf)
            if large.isEmpty():
                break
            if depth == DEPTH:
                done.append(large)
                break
            alike, members = _split(large, reps)
            done.append(alike.select(*leaf.columns))
            deepest = max(deepest, depth + 1) if not members.isEmpty() else deepest
        first = last
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# Comparing


def _grouped(batches: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables of whole groups: rows come sorted by (node, i, j), and a group may span batches."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < most:
            continue
        table = pa.Table.from_batches(held)
        g = _group_numbers(table)
        cut = int(np.searchsorted(g, g[-1]))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            n = table.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def _group_numbers(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for name in ("node", "i", "j"):
        x = table[name].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.cumsum(new)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, TOKENS)


def _likely(table: pa.Table, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs that this group is the first to have and whose sketches agree enough.

    Rows of a group are compared at growing distance, all groups at once.
    """
    g, sketch = _group_numbers(table), _matrix(table["sketch"])
    block, i, j, node = (table[n].to_numpy() for n in ("b", "i", "j", "node"))
    lists = table["leaves"].to_pylist()
    earlier = np.full((len(lists), max(1, max(map(len, lists), default=1))), -1, np.int64)
    for row, found in enumerate(lists):
        before = [x for x in found if x < node[row]]
        earlier[row, : len(before)] = before
    across = i != j
    distance = 1
    rows = np.arange(len(g))
    while True:
        rows = rows[rows + distance < len(g)]
        rows = rows[g[rows] == g[rows + distance]]
        if not len(rows):
            return
        for begin in range(0, len(rows), 1 << 14):
            a = rows[begin : begin + (1 << 14)]
            b = a + distance
            a = a[~across[a] | (block[a] != block[b])]
            a = a[(sketch[a] == sketch[a + distance]).mean(1) >= least]
            b = a + distance
            if len(a):
                known = np.zeros(len(a), bool)
                for c in range(earlier.shape[1]):
                    x = earlier[a, c][:, None]
                    known |= ((x >= 0) & (x == earlier[b])).any(1)
                if (~known).any():
                    yield a[~known], b[~known]
        distance += 1


def _by_group(members: DataFrame) -> DataFrame:
    return members.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "key")


def _dealt(found: DataFrame) -> DataFrame:
    """Each member once for every pair of blocks of its leaf that needs it; leaves of one block have one pair."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    dealt = found.withColumn("b", F.pmod(F.xxhash64("key"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.select("node", "key", "b", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"))


def _sift(members: DataFrame, least: float) -> DataFrame:
    """The members that have a likely partner in their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            active = np.zeros(table.num_rows, bool)
            for a, b in _likely(table, least):
                active[a] = True
                active[b] = True
            yield from table.filter(pa.array(active)).combine_chunks().to_batches()

    small_batches(members.sparkSession, SKETCH_ROWS)
    return stored(_by_group(members).mapInArrow(run, members.schema), "active")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share."""
    if len(sets) == 2:
        n = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    number = np.cumsum(common) - 1
    keep = common[element]
    owner, element = owner[keep], number[element[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    for begin in range(0, int(common.sum()), 4096):
        a, b = np.searchsorted(element, (begin, begin + 4096))
        x = np.zeros((len(sets), 4096), np.float32)
        x[owner[a:b], element[a:b] - begin] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _verify(members: DataFrame, least: float, threshold: float) -> DataFrame:
    """(key, links, root): documents a member is linked to in its group, and the group's least key it is joined to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, 2048):
            g = _group_numbers(table)
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*_likely(table, least), strict=True)) or ((), ())))
            keys, copies = table["key"].to_pylist(), table["copies"].to_numpy()
            sets = [np.frombuffer(x, "<u8") for x in table["shingles"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            order = np.argsort(g[a], kind="stable")
            a, b = a[order], b[order]
            starts = np.searchsorted(g, np.arange(g[-1] + 2))
            cuts = np.searchsorted(g[a], np.arange(g[-1] + 2))
            out: list[tuple[bytes, int, bytes]] = []
            for x in np.unique(g[a]):
                low, (p, q) = starts[x], (a[cuts[x] : cuts[x + 1]] - starts[x], b[cuts[x] : cuts[x + 1]] - starts[x])
                here = slice(low, starts[x + 1])
                both = shared_counts(sets[here])[p, q]
                n = sizes[here]
                linked = both >= threshold * (n[p] + n[q] - both) - 1e-9
                p, q = p[linked], q[linked]
                if not len(p):
                    continue
                links = np.zeros(len(n), np.int64)
                np.add.at(links, p, copies[here][q])
                np.add.at(links, q, copies[here][p])
                root = np.arange(len(n))
                while True:  # least row number over links, until nothing changes
                    new = root.copy()
                    np.minimum.at(new, p, root[q])
                    np.minimum.at(new, q, root[p])
                    new = new[new]
                    if (new == root).all():
                        break
                    root = new
                out += [(keys[low + r], int(links[r]), keys[low + root[r]]) for r in np.flatnonzero(links)]
            yield pa.record_batch(
                [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.binary())],
                ["key", "links", "root"],
            )

    small_batches(members.sparkSession)
    return stored(_by_group(members).mapInArrow(run, "key binary, links long, root binary"), "links")


def _sets(docs: DataFrame, wanted: DataFrame, id: str, text: str, n: int) -> DataFrame:
    """(key, shingles) of the wanted (key, first_id), made again from the texts with those ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, n) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(map(set_key, found), pa.binary()), pa.array([f.astype("<u8").tobytes() for f in found], pa.binary())], ["key", "shingles"])

    ids = wanted.select("first_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = docs.select(F.col(id).cast("long").alias("id"), whole_text(text).alias("text"))
    texts = rows.join(ids, F.col("id").eqNullSafe(F.col("first_id")), "left_semi").select("text")
    made = texts.mapInArrow(run, "key binary, shingles binary")
    return made.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE, recall: float = RECALL,
) -> DataFrame:
    """(id, h, key, class_id, n_links) of every document.

    ``class_id`` is the least id that the document is joined to over links, ``n_links`` the number of other documents
    whose sets have a similarity of ``threshold`` or more with its own, ``h`` a hash of the text.
    """
    rows = signed(docs, id, text, shingle)
    reps = rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch")
    )
    reps = stored(reps, "sets")
    least = max(0.0, threshold - SLACK)
    found = leaves(reps, recall, threshold)
    lists = found.groupBy("key").agg(F.array_sort(F.collect_set("node")).alias("leaves"))
    about = reps.select("key", "sketch", "copies").join(lists, "key")
    active = _sift(_dealt(found).join(about, "key"), least)
    wanted = stored(active.select("key").distinct().join(reps.select("key", "first_id"), "key"), "wanted")
    links = _verify(active.join(_sets(docs, wanted, id, text, shingle), "key"), least, threshold)
    joined = components(links.select(F.col("key").alias("u"), F.col("root").alias("v")))
    near = links.groupBy("key").agg(F.sum("links").alias("near")).join(joined.select(F.col("u").alias("key"), F.col("v").alias("top")), "key", "left")
    near = near.withColumn("top", F.coalesce("top", "key")).join(reps.select("key", "first_id", "copies"), "key")
    near = stored(near, "near")
    least_id = near.groupBy("top").agg(F.min("first_id").alias("class_id"))
    classes = near.join(least_id, "top").select("key", "class_id", "near")
    every = reps.select("key", "first_id", "copies").join(classes, "key", "left").select(
        "key", F.coalesce("class_id", "first_id").alias("class_id"), (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")
    )
    return rows.select("id", "h", "key").join(every, "key", "left").select(
        F.col("id").alias(id),
        "h",
        "key",
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def without_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **options: float) -> DataFrame:
    """The rows of ``docs`` of which each class keeps one: its least id, then the least hash of the text.

    Texts without words are all kept, as they are classes of their own.
    """
    found = stored(near_duplicates(docs, id, text, **options).withColumnRenamed(id, "id").where(F.col("key").isNotNull()), "classes")
    order: Callable[[str], Column] = lambda c: F.struct(F.col(c).isNull(), c, "h")
    first = found.groupBy("class_id").agg(F.min(order("id")).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    shared = found.join(first, found["class_id"].eqNullSafe(first["class_id"])).select("id", "h", (order("id") == F.col("first")).alias("stays"))
    out = stored(shared.where(~F.col("stays")).select(F.col("id").alias("__id"), F.col("h").alias("__h")).distinct(), "removed")
    again = shared.where("stays").groupBy("id", "h").count().where("count > 1").select(F.col("id").alias("__id"), F.col("h").alias("__h"))
    again = stored(again, "repeated")
    rows = docs.withColumn("__text_hash", F.xxhash64(whole_text(text)))

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = F.broadcast(right) if right.count() <= BROADCAST_IDS else right
        return left.join(right, F.col(id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__h")), how)

    kept = joined(rows, out, "left_anti")
    if not again.isEmpty():  # the class's document is there more than once, row for row
        once = joined(kept, again, "left_semi").dropDuplicates([id, "__text_hash"])
        kept = joined(kept, again, "left_anti").unionByName(once)
    return kept.drop("__text_hash")
