"""Helpers shared by the operators: session folders, row identity, text splitting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = "[\\x20\\x09-\\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where the setting is absent in a local session, as in tests, a temporary folder is made and set once; on a cluster its
    absence is an error, since no folder of one machine would do.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


#: Whether a query's shuffle files go when it ends, or when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it back. tidy: its shuffle files go at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    try:
        spark.conf.set(CLEANUP, "true" if tidy else before)
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `written` gave and that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: By operator, how to give up what it has kept in this Python worker for its next tasks.
_kept: dict[str, Callable[[], None]] = {}


def at_work(operator: str, give_up: Callable[[], None] | None = None) -> None:
    """Called by an operator's tasks: Spark hands a Python worker on from query to query, so what other operators have kept
    in it is given up here, with the memory that Arrow holds unused; give_up: how to do that with what this one keeps."""
    for other in [x for x in _kept if x != operator]:
        _kept.pop(other)()
        pa.default_memory_pool().release_unused()
    if give_up:
        _kept[operator] = give_up


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; strings of one-byte characters take the short way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def words_of(text: Column) -> Column:
    """The words of a text, in order (null or blank text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WHITE_CLASS}+"), "")


def blocks_for(df: DataFrame, size: Column, per_block: int, least: int = 1) -> int:
    """How many blocks hold df's rows at about per_block of size each; grows with the data."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return max(least, -(-int(total) // per_block))


def portions(texts: list, most: int = 1_000_000):
    """(from, to) of runs of texts of about `most` bytes, at least one text each, to bound what is hashed at a time."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if isinstance(t, str) else 0
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
