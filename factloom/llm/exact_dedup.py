"""Exact dedup by skew-safe combining (DataFrame functions only).

Texts are equal when they are the same after A-Z have been lower-cased. Copies are combined in three stages, and every stage
groups by the digest and the whole text, so that a digest never decides alone:

1. locally: each task's partial aggregate leaves one row a text, with the count and the largest id of its copies;
2. salted: these meet by digest and a salt that their task gives, so that a text that a third of all rows hold is spread
   over `salts` groups;
3. globally: the salts' winners (at most `salts` a text) meet by digest, and the digest's different texts are counted.

Rows find their group by the digest alone where one text has it. Digests that several texts share (none, with SHA-256) are
joined on the text as well. Groups of more than a HOT-th of all rows, of which there are fewer than HOT, are broadcast; every
other digest holds less than a HOT-th of all rows, so that no task of the join gets a crowd. Texts are shuffled twice, and what
is written is one small row for each text that has copies.

Defined results
* null text is empty text, and empty texts are copies of one another; long texts are treated like others.
* a null doc_id comes before every other id; where all ids of a group are null, so is keep_id.
* rows that repeat the largest doc_id are one document: all of them are kept, and all count in group_size.
* other columns of the input are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table, written

SALTS = 32
HOT = 1024


def _sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _merged(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))


def combined(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """digest, text, keep_id, n: one row for each different text of (doc_id, text, digest), partitioned by digest."""
    local = rows.select("digest", "text", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = _merged(local, "digest", "salt", "text")
    return _merged(salted.repartition("digest"), "digest", "text")


def copies(docs: DataFrame, digest: Callable[[Column], Column] = _sha256, salts: int = SALTS, hot: int = HOT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", digest(F.col("text")))
    groups = combined(rows, salts)
    of_digest = groups.groupBy("digest").agg(F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    several = written(of_digest.where("n > 1"), "copies")
    alone = several.where("texts = 1")

    r = rows.select("doc_id", "digest", F.sha2("text", 256).alias("text_sha256"))
    least = docs.count() // hot  # a group above it is hot; fewer than `hot` groups are
    crowd = alone.where(F.col("n") > least).select(F.col("digest").alias("h_digest"), F.col("keep_id").alias("h_keep"), F.col("n").alias("h_n"))
    r = r.join(F.broadcast(crowd), F.col("digest") == F.col("h_digest"), "left")
    settled = r.where("h_n is not null").select("doc_id", F.col("h_keep").alias("keep_id"), F.col("h_n").alias("group_size"), "text_sha256")
    rest = r.where("h_n is null").select("doc_id", "digest", "text_sha256")
    few = several.where((F.col("n") <= least) | (F.col("texts") > 1)).select(F.col("digest").alias("f_digest"), "texts", "keep_id", F.col("n").alias("group_size"))
    rest = rest.join(few, F.col("digest") == F.col("f_digest"), "left")
    own = rest.where("texts is null or texts = 1")
    own = own.select("doc_id", F.when(F.col("texts").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    out = settled.union(own)
    if several.where("texts > 1").limit(1).count():
        out = out.union(_by_text(rows, groups, several.where("texts > 1").select("digest")))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _by_text(rows: DataFrame, groups: DataFrame, shared: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, text_sha256 of the rows whose digest several texts share."""
    g = groups.join(shared, "digest", "left_semi").select(F.col("digest").alias("g_digest"), F.col("text").alias("g_text"), "keep_id", F.col("n").alias("group_size"))
    mine = rows.join(shared, "digest", "left_semi").join(g, (F.col("digest") == F.col("g_digest")) & (F.col("text") == F.col("g_text")))
    return mine.select("doc_id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"))


def keep_last(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, of equal texts only the one with the largest id."""
    gone = copies(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha")).distinct()
    sha = F.sha2(ascii_lower(F.coalesce(docs["text"], F.lit(""))), 256)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]) & (sha == gone["gone_sha"]), "left_anti")


def op13_exact_dedup(spark, sf_dir):
    return copies(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), g as (
  select text, max(doc_id) as keep_id, count(*)::bigint as group_size from d group by text
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(text) as text_sha256 from d join g using (text)
"""
