"""Language identification by compression.

For each language a zstandard raw-content dictionary is made of texts in it, in lower case. A
text, lower-cased, is cut into blocks of ``BLOCK`` bytes, each block is compressed with every dictionary, and the
language with the smallest sum of sizes wins. Where the runner-up comes close, within
``margin`` of its size, the text is rejected.

The dictionaries come from a bounded sample of labelled rows (``SAMPLE`` documents and
``CONTENT`` bytes a language, chosen by a hash of the text; of long texts a slice); every text is classified whole.
The number of languages is taken to be small, as each costs one compression of every text.

Defined results: a null text or one without a letter is ``und``, score 0, and rejected; so is
every text if no language was learned. Null languages are not learned from. Equal sizes go to
the smaller code and have margin 0. Null ids and repeated rows come out as they went in; an
empty table gives no rows; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdmloom.llm.common import small_batches

UNDETERMINED = "und"
#: Labelled documents a language is learned from, at most.
SAMPLE = 128
#: Parts of a language that are ranked on their own before the whole.
PARTS = 64
#: Bytes of a language's dictionary, at most.
CONTENT = 64 * 1024
#: Bytes compressed at a time, so that the dictionary and not the text itself explains the text.
BLOCK = 4096
LEVEL = 5
#: Rejected if the second language needs less than this share more than the first.
MARGIN = 0.005


def learn(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, content: int = CONTENT) -> dict[str, bytes]:
    """Each language's dictionary: distinct texts in the order of a hash of them, as long as they fit.

    Texts of up to an eighth of the dictionary come first and whole. Of longer ones, which are picked where there are
    fewer short ones than ``sample``, a slice from the middle is taken, so that one document does not fill the
    dictionary unless the language has no more; slices fill what the short texts leave.
    """
    t = F.col("text")
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull() & (F.octet_length(t) > 0))
    rows = rows.withColumn("long", F.octet_length(t) > content // 8).withColumn("h", F.xxhash64(t))
    # Only hashes move; copies are one before the sample is taken.
    order = Window.partitionBy("lang").orderBy("long", "h")
    # Ranked within parts of a language first, so that one task never has more than the first of each part.
    in_part = Window.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("long", "h")
    firsts = rows.groupBy("lang", "long", "h").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(in_part)).where(F.col("rank") <= sample)
    picked = firsts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    share = F.greatest(F.lit(content // 32), F.floor(content / F.sum(F.col("long").cast("int")).over(Window.partitionBy("lang")))).cast("int")
    picked = picked.withColumn("share", F.when(F.col("long"), share)).select("lang", "h", "rank", "share")
    begin = F.greatest(F.lit(0), F.floor((F.length(t) - F.col("share")) / 2)).cast("int")
    part = F.when(F.col("share").isNull(), t).otherwise(F.substring(t, begin + 1, F.col("share")))
    found = rows.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "rank", "share").agg(F.first(part).alias("part")).collect()
    texts: dict[str, list[tuple[int, int | None, str]]] = {}
    for r in found:
        texts.setdefault(r["lang"], []).append((r["rank"], r["share"], r["part"]))
    made = {}
    for code, parts in texts.items():
        room, taken = content, {}  # a copy in other case adds nothing
        for _, most, t in sorted(parts):
            data = t.lower().encode()
            if most is not None:
                data = data[: max(0, min(most, room - 1))].decode(errors="ignore").encode()
            if data and len(data) < room and data not in taken:
                taken[data] = True
                room -= len(data) + 1
        made[code] = b"\n".join(taken)
    return made


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, block: int = BLOCK) -> None:
        self.block = block
        self.compressors = []
        for code, data in sorted(dictionaries.items()):
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            c = zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            self.compressors.append((code, c))

    def sizes(self, text: str) -> list[tuple[int, str]]:
        """(compressed bytes, language), smallest first."""
        data = text.lower().encode()
        blocks = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return sorted((sum(len(c.compress(b)) for b in blocks), code) for code, c in self.compressors)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin)."""
        if text is None or not self.compressors or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        ranked = self.sizes(text)
        best = ranked[0][0]
        # A byte less is 256 times likelier; the eighth root keeps the scores of short texts apart.
        score = 1 / sum(2.0 ** max(-1000, best - size) for size, _ in ranked)
        margin = (ranked[1][0] - best) / ranked[1][0] if len(ranked) > 1 else 1.0
        return ranked[0][1], score, margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id: str = "doc_id", text: str = "text", margin: float = MARGIN, keep: tuple[Column, ...] = ()) -> DataFrame:
    """(id, lang_pred, score, margin, rejected) of every text, and the columns ``keep`` as they are."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(shared.value)
        for batch in batches:
            made = [classify(t) for t in batch.column("__text").to_pylist()]
            found = [
                pa.array([m[0] for m in made], pa.string()),
                pa.array([m[1] for m in made], pa.float64()),
                pa.array([m[2] for m in made], pa.float64()),
                pa.array([m[0] == UNDETERMINED or m[2] < margin for m in made], pa.bool_()),
            ]
            kept = [n for n in batch.schema.names if n != "__text"]
            yield pa.record_batch([*map(batch.column, kept), *found], [*kept, "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(F.col(id), *keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{n}` {k}" for n, k in rows.dtypes if n != "__text")
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, margin double, rejected boolean")
