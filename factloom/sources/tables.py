"""Tables as parquet or JSON lines with declared schemas, and loads that are committed by manifests.

A load's files are written once, to a place that no other attempt uses. It becomes visible when a manifest is created that is
named by the load's key and says where the files are; whoever creates it first has loaded, everybody else finds it there.
Readers read the places that the manifests name and nothing else, so that a crash before the manifest leaves nothing and one
after it leaves all. A row of a ledger is a manifest itself. Nothing is renamed and nothing is updated in place.

Creating a file only where there is none is one step on file systems with a name node and on stores with conditional writes;
on a local one it is done by a hard link to a whole file. A manifest without content is one whose writer has died or is just
writing: it is waited for, and then the load's next name is taken.
"""

from __future__ import annotations

import json
import os
import time
import urllib.parse
import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES

ATTEMPTS = 5
WAIT_SECONDS = 30.0
#: What point look-ups go by: files are sorted by it, and carry a Bloom filter of its first column, so that a look-up reads the pages
#: that may hold its key and skips all other files by their footers.
CLUSTERED = {
    "documents": ("document_id",), "facts": ("document_id", "concept"), "extractions": ("document_id", "model"), "chunks": ("document_id", "chunk_index"),
    "answers": ("document_id",), "pins": ("item",),
}
PAGE_BYTES = 64_000
LEDGERS = frozenset(("ingest_runs", "parse_runs", "extract_runs", "index_runs"))


class LoadFailedError(Exception):
    """Nothing was loaded, and no earlier load of the key is there."""


# ---------------------------------------------------------------- files


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def copy_in(spark: SparkSession, local: str, path: str) -> None:
    fs, p, path_of = _fs(spark, path)
    fs.copyFromLocalFile(False, False, path_of(f"file://{os.path.abspath(local)}"), p)


def _local(spark: SparkSession, path: str) -> str | None:
    """The path on this machine's own file system, if it is one."""
    fs, p, _ = _fs(spark, path)
    q = fs.makeQualified(p).toUri()
    return q.getPath() if q.getScheme() == "file" else None


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file unless there is one: whether this call has."""
    local = _local(spark, path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        aside = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(aside, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(aside, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
    fs, p, _ = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; null if there is none."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


# ---------------------------------------------------------------- manifests


def _manifests(root: str, name: str) -> str:
    return f"{root}/{name}/loads"


def _manifest_path(root: str, name: str, key: str, attempt: int = 0) -> str:
    """Keys are quoted, so that different ones never share a file; what follows a quoted key's '+' is the number of the attempt."""
    safe = urllib.parse.quote(key, safe="").replace(".", "%2E").replace("_", "%5F")  # leading dots and underscores would hide a file
    return f"{_manifests(root, name)}/k{safe}" + (f"+r{attempt}" if attempt else "") + ".json"


def new_place(root: str, name: str, file: str = "") -> str:
    return f"{root}/{name}/data/{uuid.uuid4().hex}{file}"


def _parsed(text: str | None) -> dict | None:
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def manifest(spark: SparkSession, root: str, name: str, key: str) -> dict | None:
    """What was committed under a key; null if nothing was."""
    for attempt in range(ATTEMPTS + 1):
        text = _read_small(spark, _manifest_path(root, name, key, attempt))
        if text is None or _parsed(text) is not None:
            return _parsed(text)
    return None


def commit(spark: SparkSession, root: str, name: str, key: str, body: dict, wait: float = WAIT_SECONDS) -> bool:
    """Creates the manifest of a key: whether this call has. Raises LoadFailedError if every name is held by a dead writer's."""
    for attempt in range(ATTEMPTS + 1):
        path = _manifest_path(root, name, key, attempt)
        if create_if_absent(spark, path, json.dumps({"key": key, "attempt": attempt} | body)):
            return True
        until = time.monotonic() + wait
        while _parsed(_read_small(spark, path)) is None and time.monotonic() < until:
            time.sleep(min(0.5, wait / 4))
        if _parsed(_read_small(spark, path)) is not None:
            return False
    raise LoadFailedError(f"{name} {key}: {ATTEMPTS + 1} manifests without content")


def loads(spark: SparkSession, root: str, name: str) -> DataFrame:
    """key, attempt, source, place, counts of a table's loads, read from its manifests by Spark."""
    schema = "key string, attempt int, source string, place string, counts map<string,double>"
    if not exists(spark, _manifests(root, name)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(_manifests(root, name)).where("place is not null")


# ---------------------------------------------------------------- tables


def read_table(spark: SparkSession, root: str, name: str, source: str | None = None) -> DataFrame:
    """A raw table under root, or its loads of one source alone; empty, with its schema, if nothing has been loaded yet."""
    schema = TABLES[name]
    if name in LEDGERS:
        if not exists(spark, _manifests(root, name)):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json(_manifests(root, name)).where(F.col(schema[0].name).isNotNull())
    found = loads(spark, root, name)
    if source is not None:
        found = found.where(F.col("source") == source)
    places = sorted(r["place"] for r in found.select("place").collect())  # one a load
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def read_json_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).json(path)


def staged(df: DataFrame, root: str, name: str) -> DataFrame:
    """df written aside once and read back, for results that are dear or read several times; `unstage` deletes it."""
    path = f"{root}/_staging/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(spark: SparkSession, root: str, name: str) -> None:
    remove(spark, f"{root}/_staging/{name}")


def load_batch(
    df: DataFrame, root: str, name: str, key: str, source: str | None = None, measures: dict[str, Column] | None = None, wait: float = WAIT_SECONDS
) -> bool:
    """Append df to a table under a deterministic key: True if this call has loaded it, False if it is there already.

    What is neither raises: a write that fails is tried again up to ATTEMPTS times, each time at a place of its own. The rows
    are counted, and `measures` (aggregates) taken, while they are written; the manifest keeps the numbers, for `counted`.
    """
    spark = df.sparkSession
    if manifest(spark, root, name, key) is not None:
        return False
    rows, by = df.select(*[f.name for f in TABLES[name]]), CLUSTERED.get(name, ())
    if by:
        rows = rows.sortWithinPartitions(*by)  # a document's rows come from one task as it is
    for attempt in range(ATTEMPTS + 1):
        place, seen = new_place(root, name), Observation()
        try:
            rows.observe(seen, F.count("*").alias("rows"), *[c.alias(n) for n, c in (measures or {}).items()]).write.options(**_layout(by)).parquet(place)
            break
        except Exception as e:
            if attempt == ATTEMPTS:
                raise LoadFailedError(f"{name} {key}: {type(e).__name__}: {e}"[:1000]) from e
    counts = {k: float(v or 0) for k, v in seen.get.items()}
    if commit(spark, root, name, key, {"source": source, "place": place, "counts": counts}, wait):
        return True
    remove(spark, place)
    return False


def counted(spark: SparkSession, root: str, name: str, source: str, key: str | None = None) -> dict[str, float]:
    """The sums of what was counted while a source's loads (or one of them) were written; no table is read."""
    mine = loads(spark, root, name).where((F.col("source") == source) & (F.lit(key is None) | (F.col("key") == F.lit(key))))
    found = mine.select(F.explode("counts").alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n")).collect()
    return {r["name"]: r["n"] for r in found}


def _layout(by: tuple[str, ...]) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{by[0]}": "true", "parquet.page.size": str(PAGE_BYTES), "parquet.page.row.count.limit": "1000"} if by else {}


def _plain(value):
    return value.isoformat() if isinstance(value, (datetime, date)) else value


def append_ledger(spark: SparkSession, root: str, name: str, row: dict, key: str) -> bool:
    """One ledger row, once a key: the row is the manifest."""
    return commit(spark, root, name, key, {f.name: _plain(row.get(f.name)) for f in TABLES[name]})


def purge(spark: SparkSession, root: str, name: str, source: str) -> int:
    """Drop the loads of exactly this source: the number dropped. Each is invisible before its files go."""
    found = loads(spark, root, name).where(F.col("source") == source).select("key", "attempt", "place").collect()  # one a load
    for r in found:
        remove(spark, _manifest_path(root, name, r["key"], r["attempt"]))
    for r in found:
        remove(spark, r["place"])
    return len(found)


def sweep(spark: SparkSession, root: str, name: str, older_than_seconds: float) -> int:
    """Delete places that no manifest names, left by writers that died, if nothing was written there for so long: how many."""
    fs, p, _ = _fs(spark, f"{root}/{name}/data")
    if not fs.exists(p):
        return 0
    named = {r["place"].rstrip("/").rpartition("/data/")[2].partition("/")[0] for r in loads(spark, root, name).select("place").collect()}
    before = (time.time() - older_than_seconds) * 1000
    orphans = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in named and s.getModificationTime() < before]
    for o in orphans:
        fs.delete(o, True)
    return len(orphans)
