"""Reading source tables and writing targets."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdmloom.model.spec import Source

# A stored table is a folder of versions and a log that names them in turn; the last one named holds.
LOG = "_versions"
READERS = "_readers"


def read_sources(
    spark: SparkSession, sources: Sequence[Source], names: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """One aliased DataFrame per source, lazily.

    ``names`` fills the placeholders of each table name. A name with a slash is
    read as a path, of plain parquet or of a table with versions, any other as a catalog table.
    """
    out = {}
    for s in sources:
        table = s.table.format(**(names or {}))
        df = read_target(spark, table) if "/" in table else spark.read.table(table)
        out[s.alias] = df.alias(s.alias)
    return out


class StaleVersion(RuntimeError):
    """Another writer committed first."""


def _file_system(spark: SparkSession, path: str) -> tuple:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_bytes(spark: SparkSession, path: str) -> int:
    fs, at = _file_system(spark, path)
    return fs.getFileStatus(at).getLen()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, unless it is there already. Of several writers one succeeds."""
    fs, at = _file_system(spark, path)
    if fs.getScheme() == "file":
        # Here the engine's own file system looks first and creates then.
        local = at.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
    try:
        stream = fs.create(at, False)
    except Py4JJavaError as e:
        if not fs.exists(at):
            raise e
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's versions, oldest first; none where nothing was stored yet."""
    return [int(n.split(".")[0]) for n in _names(spark, f"{path}/{LOG}") if n.endswith(".json") and not n.startswith((".", "_"))]


def commit(spark: SparkSession, path: str, number: int) -> dict[str, Any]:
    """What the log says of a version: its folder, when it was stored, and its sizes."""
    while not (text := _read(spark, f"{path}/{LOG}/{number:08d}.json")).endswith("\n"):
        time.sleep(0.01)  # created, and not written to its end yet
    return json.loads(text)


def read_target(spark: SparkSession, path: str, back: int = 0, number: int | None = None) -> DataFrame:
    """The table's last version, or the one ``back`` versions before, or a given one; plain parquet without versions."""
    known = commits(spark, path)
    if not known:
        return spark.read.parquet(path)
    return spark.read.parquet(f"{path}/{commit(spark, path, known[-1 - back] if number is None else number)['folder']}")


def group_sizes(df: DataFrame, by: str, text: str | None = None) -> dict[str, list[int]]:
    """Rows of each group and the most bytes its text has: for columns of few values, such as a vocabulary's name."""
    longest = F.max(F.octet_length(text)) if text else F.lit(0)
    return {r[0]: [r[1], r[2] or 0] for r in df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)), longest).collect()}


def table_sizes(spark: SparkSession, path: str) -> dict[str, list[int]] | None:
    """The sizes stored with the last version, if any."""
    known = commits(spark, path)
    return commit(spark, path, known[-1]).get("sizes") if known else None


def write_version(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    sizes: Callable[[DataFrame], dict[str, list[int]]] | None = None,
    base: int | None = None,
) -> DataFrame:
    """Let ``write`` fill a fresh folder, then make it the table's version.

    Readers see the version before until all rows are written: a job that aborts, or a table rebuilt from itself,
    leaves the old rows where they are. A commit creates the file of the next number in the log; a writer that finds
    it taken goes on to the number after, so all writers' versions stay, in order. With ``base``, the number of the
    version the rows were made from (-1: none), it raises :class:`StaleVersion` instead.
    ``sizes`` of the stored rows go into the log, where plans find them without a job.
    """
    folder = f"v-{uuid4().hex}"
    write(f"{path}/{folder}")
    stored = spark.read.parquet(f"{path}/{folder}")
    entry = {"folder": folder, "stored_at": time.time()} | ({"sizes": sizes(stored)} if sizes else {})
    number = (commits(spark, path)[-1:] or [-1])[0] + 1 if base is None else base + 1
    while not put_if_absent(spark, f"{path}/{LOG}/{number:08d}.json", json.dumps(entry) + "\n"):
        if base is not None:
            raise StaleVersion(f"{path}: version {number} was stored by another writer")
        number += 1
    return stored


def write_target(df: DataFrame, path: str, base: int | None = None) -> DataFrame:
    """Store ``df`` as the table's next version and read it back."""
    return write_version(df.sparkSession, path, df.write.parquet, base=base)


@contextmanager
def held(spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """The last version, kept from removal while the block runs."""
    number = commits(spark, path)[-1]
    lease = f"{path}/{READERS}/{number:08d}-{uuid4().hex}"
    put_if_absent(spark, lease, str(time.time()))
    try:
        yield read_target(spark, path, number=number)
    finally:
        fs, at = _file_system(spark, lease)
        fs.delete(at, False)


def remove_versions(spark: SparkSession, path: str, keep: int = 2, older_than: float = 7 * 86_400, lease_age: float = 86_400) -> list[int]:
    """Delete versions stored more than ``older_than`` seconds ago, but for the last ``keep`` and those that are held.

    A lease older than ``lease_age`` seconds is of a reader that ended without giving it back. The log entry goes last, so a
    removal that is cut off is taken up again by the next one.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    now, read = time.time(), set()
    for name in _names(spark, f"{path}/{READERS}"):
        if not name.startswith(".") and now - float(_read(spark, f"{path}/{READERS}/{name}") or now) <= lease_age:
            read.add(int(name.split("-")[0]))
    gone = []
    for number in commits(spark, path)[:-keep]:
        entry = commit(spark, path, number)
        if number in read or now - entry["stored_at"] < older_than:
            continue
        for part, recursive in ((entry["folder"], True), (f"{LOG}/{number:08d}.json", False)):
            fs, at = _file_system(spark, f"{path}/{part}")
            fs.delete(at, recursive)
        gone.append(number)
    return gone
