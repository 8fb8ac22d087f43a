"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies each of its documents should have,
and is seldom whole. All documents get the whole part. The fractions are rounded in pairs: mass
is moved from one document's fraction to the other's, in words, in a direction drawn at random so
that each fraction keeps its mean, until one of the two is 0 or 1. Every step keeps the source's
words, so the source misses its target by less than the last unpaired document.

The rounding is a reduction tree. Documents are dealt to blocks of about ``BLOCK`` rows by a hash, so a
source with a third of all rows is many blocks; a block rounds all its documents but one and hands that
residual up, where ``FAN`` residuals of a source form a block again, until each source has one left. Documents are taken
from the largest, so the last one left is small. Only ids, hashes and sizes travel, never texts. Blocks, order and draws follow from hashes of the rows, so
reruns agree.

Targets: sources are put in code-point order, null last, and weigh 1, 2, 3, 1, 2, 3 and so on; they share
the words of all documents by weight, and none gets more than ``MOST`` times its size, the excess going to
the others by weight. So no document needs more than ``MOST`` copies.

Defined results: a null text has size 0; documents without words take 0; a null source is a source of its
own; repeated rows are rounded one by one; an empty table gives no rows; only the id, text and source are
read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdmloom.functions.keys import row_number_key
from cdmloom.llm.common import WORD, stored, whole_text

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 16_384
FAN = 1024
#: Rows of a table of sources that is broadcast at most.
SOURCES = 100_000
SEED = 20_231
#: A share so close to 0 or 1 counts as whole.
NEAR = 1e-9


def words(text: str = "text") -> Column:
    """Maximal runs of anything but ASCII white space."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    A level of filling is raised until the targets, each its weight times the level but at most
    ``most`` sizes, add up to all words. Each round is one aggregate over the table of sources.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = row_number_key(totals.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "__rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", weight.alias("weight")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("source_size") * F.lit(most) <= F.col("weight") * F.lit(level)
        held, open_weight = ranked.agg(
            F.sum(F.when(full, F.col("source_size") * F.lit(most)).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        new = (total - held) / open_weight if open_weight else level
        if new <= level:
            break
        level = new
    target = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * F.lit(most)).cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def pivot(sizes: list[float], shares: list[float], draws: list[float]) -> tuple[list[float], int]:
    """Round the shares of one block, in the order given.

    Returns the shares, all 0 or 1 but one, and the place of that one (-1: none). The sum of
    size times share stays as it was.
    """
    out, at = list(shares), -1
    for i, share in enumerate(shares):
        if not NEAR < share < 1 - NEAR:
            out[i] = round(share)
            continue
        if at < 0:
            at = i
            continue
        a, b = out[at] * sizes[at], share * sizes[i]  # mass in words
        up = min(sizes[at] - a, b)  # what the first can take from the second
        down = min(a, sizes[i] - b)  # what it can give
        move = up if draws[i] * (up + down) < down else -down
        out[at], out[i] = (a + move) / sizes[at], (b - move) / sizes[i]
        left = -1
        for j in (at, i):
            if NEAR < out[j] < 1 - NEAR:
                left = j
            else:
                out[j] = round(out[j])
        at = left
    return out, at


def _round_block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "h", "id"], ascending=[False, True, True], na_position="last", kind="stable").reset_index(drop=True)
    draw = (rows["draw"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) / float(1 << 53)
    share, left = pivot(rows["size"].astype(float).tolist(), rows["share"].tolist(), draw.tolist())
    return rows.assign(share=share, open=np.arange(len(rows)) == left)


ROW = "id long, h long, source string, size long, source_size long, target double, whole long, share double, blocks long, block long, draw long"


def round_copies(items: DataFrame, block: int = BLOCK, fan: int = FAN, seed: int = SEED) -> DataFrame:
    """Rows (id, h, source, size, source_size, target, whole, share) with ``copies``.

    A source is dealt to as many blocks as it fills, so small ones are rounded in one, however large others are. Every
    level of the tree is stored, so it is rounded once and the next one starts from its residuals; a source whose
    last block is done drops out.
    """
    # What is whole already has no part in the tree.
    none = F.lit(0).cast("long")
    done = [items.where("share = 0").withColumns({"blocks": none, "block": none, "draw": none, "open": F.lit(False)})]
    items = items.where("share > 0")
    filled = F.ceil(F.count("*") / F.lit(block)).cast("long")
    counted = stored(items.groupBy(F.col("source").alias("__source")).agg(filled.alias("blocks")), "blocks")
    sources, most = counted.agg(F.count("*"), F.coalesce(F.max("blocks"), F.lit(0))).first()
    counted, level = F.broadcast(counted) if sources <= SOURCES else counted, 0
    place = F.xxhash64(F.lit(seed), "h", "id")
    rows = items.join(counted, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumn("block", F.pmod(place, F.col("blocks")))
    while True:
        draw = F.xxhash64(F.lit(seed + 1 + level), "h", "id", "size")
        made = stored(
            rows.withColumn("draw", draw).groupBy("source", "block").applyInPandas(lambda x: _round_block(x), ROW + ", open boolean"), f"rounded-{level}"
        )
        # The last residual of a source is drawn by its share.
        last = F.pmod(F.xxhash64(F.lit(seed - 1), "h", "id"), F.lit(1 << 52)) / F.lit(float(1 << 52)) < F.col("share")
        done.append(made.where("not open or blocks = 1").withColumn("share", F.when(F.col("open"), last.cast("double")).otherwise(F.col("share"))))
        if most <= 1:
            break
        most, level = -(-most // fan), level + 1
        rows = made.where("open and blocks > 1").drop("open", "draw").withColumns(
            {"block": F.floor(F.col("block") / fan).cast("long"), "blocks": F.ceil(F.col("blocks") / fan).cast("long")}
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumn("copies", F.col("whole") + F.round("share").cast("long"))


def plan_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(id, h, size, source, source_size, target, copies) of every document; h is a hash of its text."""
    items = stored(
        docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(whole_text(text)).alias("h"), F.col(source).alias("source"), words(text).alias("size")), "sizes"
    )
    targets = source_targets(items, weights, most)
    sized = items.join(F.broadcast(targets) if targets.count() <= SOURCES else targets, items["source"].eqNullSafe(targets["source"]), "inner").drop(targets["source"])
    copies = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(copies + F.lit(1e-12)).cast("long")
    sized = sized.select(
        "id", "h", "source", "size", "source_size", "target", whole.alias("whole"), F.greatest(copies - whole, F.lit(0.0)).alias("share")
    )
    return round_copies(sized)
