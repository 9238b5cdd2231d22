"""Line dedup by range-partitioned hashes and per-document keep bitmaps (DataFrame functions only).

Line keys become 128-bit hashes that are range-partitioned with a salt taken from the document, so that a line
found in a third of all documents is spread over SALTS ranges. Within a range, rows are sorted by document and the
first one is streamed out; the first ones of all salts of a key (at most SALTS rows a key) meet in a second range
partitioning that finds the first document of all. What leaves is no text but the 64-bit words of each document's
bitmap in which some line is dropped.

Defined results
* null or empty text: one empty line, nothing dropped; a null doc_id sorts before every other id.
* rows that repeat a doc_id are one document: they never drop each other's lines; equal rows get equal results.
* other columns of the input are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, ascii_lower

MIN_KEY_LENGTH = 10
SALTS = 32


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.xxhash64("text").alias("row_hash"))


def drop_bitmaps(docs: DataFrame, min_key_length: int = MIN_KEY_LENGTH, salts: int = SALTS) -> DataFrame:
    """One row per document that loses lines: doc_id, row_hash, words (sorted array of (word, bits); a set bit is
    a dropped line, absent words drop nothing, so that the arrays hold only what differs from keeping all)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = (
        _identified(docs)
        .select("doc_id", "row_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "row_hash", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_key_length)
        .select(
            "doc_id", "row_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
            F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
        )
    )
    held = (
        lines.repartitionByRange(n, "h1", "h2", "salt")
        .groupBy("h1", "h2", "salt", "doc_id", "row_hash")
        .agg(F.collect_list("pos").alias("at"))
    )
    first = lambda *by: F.first("doc_id").over(Window.partitionBy(*by).orderBy("doc_id"))
    local = held.withColumn("first_doc", first("h1", "h2", "salt"))
    late = local.where(~F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("doc_id", "row_hash", "at")
    lead = local.where(F.col("doc_id").eqNullSafe(F.col("first_doc")))
    overall = lead.repartitionByRange(n, "h1", "h2").withColumn("first_doc", first("h1", "h2"))
    late = late.unionByName(overall.where(~F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("doc_id", "row_hash", "at"))
    bits = (
        late.select("doc_id", "row_hash", F.explode("at").alias("pos"))
        .groupBy("doc_id", "row_hash", F.expr("cast(pos div 64 as int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    )
    return bits.groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


#: Sparse bitmap words to an array with a word at every place up to the last.
_DENSE = """flatten(transform(words, (x, i) ->
    concat(array_repeat(0L, x.word - if(i = 0, 0, words[i - 1].word + 1)), array(x.bits))))"""


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text: the documents without the lines whose bits are set."""
    return (
        _with_bitmaps(docs, bitmaps)
        .select("doc_id", "n_lines", "n_dropped", "kept_text")
    )


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[F.col(c) for c in keep]).withColumn(
        "row_hash", F.xxhash64("text")
    )
    b = bitmaps.select(F.col("doc_id").alias("b_doc"), F.col("row_hash").alias("b_row"), "words")
    joined = d.join(b, d.doc_id.eqNullSafe(b.b_doc) & (d.row_hash == b.b_row), "left")
    lines = F.split("text", "\n", -1)
    return (
        joined.withColumn("dense", F.expr(f"if(words is null, null, {_DENSE})"))
        .withColumn("lines", lines)
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dropped", F.expr("coalesce(aggregate(words, 0L, (n, x) -> n + bit_count(x.bits)), 0L)"))
        .withColumn(
            "kept_text",
            F.expr(
                "if(dense is null, text, array_join(filter(lines, (l, i) -> "
                "(coalesce(get(dense, cast(i div 64 as int)), 0L) & shiftleft(1L, i % 64)) = 0), '\n'))"
            ),
        )
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents with the columns they came with; text lacks the lines that an earlier document holds."""
    cols = docs.columns
    renamed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row_"), "doc_id", "text")
    kept = _with_bitmaps(renamed, drop_bitmaps(docs), keep=("row_",))
    return kept.select(*[F.col("kept_text").alias(c) if c == "text" else F.col(f"row_.`{c}`").alias(c) for c in cols])


def op8_line_dedup(spark, sf_dir):
    from .common import table

    docs = table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, drop_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP8_SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), k as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l
), f as (
  select key, min(doc_id) as first_doc from k where length(key) >= 10 group by key
), m as (
  select k.doc_id, k.pos, k.line, coalesce(k.doc_id > f.first_doc, false) as dropped
  from k left join f on k.key = f.key
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where dropped)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from m group by doc_id
"""
