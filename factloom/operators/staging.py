"""Staging views over the raw tables: one function a view, DataFrame in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import found, once, safe_date, safe_decimal
from ..schemas import ANSWER, CONCEPTS, PERIODS


def stg_documents(documents: DataFrame) -> DataFrame:
    return documents.withColumn("text_chars", F.length("text"))


def _seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_seconds", F.timestamp_diff("SECOND", "started_at", "finished_at"))


def stg_parse_runs(parse_runs: DataFrame) -> DataFrame:
    return _seconds(parse_runs).withColumn("reparse", F.coalesce("reparse", F.lit(False)))


def stg_extract_runs(extract_runs: DataFrame) -> DataFrame:
    return _seconds(extract_runs)


def stg_quarantine(quarantine: DataFrame) -> DataFrame:
    return quarantine.withColumn("released", F.col("released_at").isNotNull())


def stg_extractions(extractions: DataFrame) -> DataFrame:
    a = once(extractions, "answer_", F.from_json("extraction_json", ANSWER))
    text = lambda c: F.col(f"answer_.{c}.value")
    return a.select(
        *extractions.columns, text("company_name").alias("company_name"), text("company_number").alias("company_number"),
        safe_date(text("period_end")).alias("period_end"), safe_date(text("period_start")).alias("period_start"),
    )


def stg_extraction_values(extractions: DataFrame) -> DataFrame:
    """18 rows an extraction (field by period), in one pass over the answer, which is parsed once."""
    cell = lambda f, c, p: F.struct(
        F.lit(f).alias("field"), F.lit(c).alias("concept"), F.lit(p).alias("period"), safe_decimal(F.col(f"a_.{f}.{p}.value")).alias("value"),
        F.col(f"a_.{f}.{p}.value").isNotNull().alias("stated"), F.col(f"a_.{f}.{p}.confidence").alias("confidence"), F.col(f"a_.{f}.{p}.evidence").alias("evidence"),
    )
    cells = F.array(*[cell(f, c, p) for f, c in CONCEPTS.items() for p in PERIODS])
    keys = ["document_id", "model", "prompt_id"]
    parsed = once(extractions.select(*keys, "batch_id", "extraction_json"), "a_", F.from_json("extraction_json", ANSWER))
    return parsed.select(*keys, "batch_id", F.inline(cells)).select(*keys, "field", "concept", "period", "value", "stated", "confidence", "evidence", "batch_id")


def stg_fact_occurrences(facts: DataFrame) -> DataFrame:
    """Splits the namespace into the taxonomy's version and name; what doesn't match is 'unresolved'."""
    version = found(F.col("namespace"), r"/(\d{4}-\d{2}-\d{2})/")
    taxonomy = found(F.col("namespace"), r"/([^/]+)$")
    return facts.withColumn("taxonomy_version", version).withColumn("taxonomy", F.coalesce(taxonomy, F.lit("unresolved")))


FACT_KEY = ("document_id", "concept", "taxonomy", "context_id")


def stg_facts(occurrences: DataFrame) -> DataFrame:
    """One row a fact: occurrences of one concept in one context collapse, with every pick deterministic."""
    least = ("namespace", "value", "unit", "decimals", "format", "scale", "sign", "period_start", "period_end", "instant", "dimensions", "taxonomy_version", "batch_id")
    number = F.when(F.col("is_numeric"), F.coalesce(F.col("value").cast("string"), F.lit("<nil>")))
    # A fact has few occurrences: the sets of its texts and numbers are small, and one shuffle is enough for all of it.
    out = occurrences.groupBy(*FACT_KEY).agg(
        *[F.min(c).alias(c) for c in least],
        F.bool_or("is_numeric").alias("is_numeric"),
        F.min_by("text", F.struct(~F.col("in_hidden"), F.col("text"))).alias("text"),
        F.min_by("text", F.struct("in_hidden", "text")).alias("printed_text"),
        F.bool_or("in_hidden").alias("in_hidden"),
        F.bool_and("in_hidden").alias("hidden_everywhere"),
        F.bool_or("dimensional").alias("dimensional"),
        F.count("*").alias("occurrences"),
        F.size(F.collect_set(number)).cast("long").alias("distinct_values"),
        F.size(F.collect_set("text")).cast("long").alias("distinct_texts"),
    )
    return out.withColumn("inconsistent", F.col("is_numeric") & (F.col("distinct_values") > 1)).withColumn(
        "fact_key", F.concat("document_id", F.lit("|"), "taxonomy", F.lit(":"), "concept", F.lit("|"), "context_id")
    )


def register_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging views of the given raw tables, also as temporary views for SQL users."""
    out = {
        "stg_documents": stg_documents(tables["documents"]),
        "stg_facts": stg_facts(stg_fact_occurrences(tables["facts"])),
        "stg_fact_occurrences": stg_fact_occurrences(tables["facts"]),
        "stg_quarantine": stg_quarantine(tables["quarantine"]),
        "stg_parse_runs": stg_parse_runs(tables["parse_runs"]),
        "stg_extractions": stg_extractions(tables["extractions"]),
        "stg_extraction_values": stg_extraction_values(tables["extractions"]),
        "stg_extract_runs": stg_extract_runs(tables["extract_runs"]),
    }
    for name, df in out.items():
        df.createOrReplaceTempView(name)
    return out
