"""Evaluation: the answer key from the tags, a verdict for each extracted cell, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_divide
from ..schemas import CREDITORS_WITHIN_ONE_YEAR

OUTCOMES = ("correct", "wrong", "missed", "unsupported", "tag_error", "not_applicable")
ERROR_TYPES = ("sign_flipped", "scale_1000", "period_swapped", "near_miss", "other")


def ground_truth(facts: DataFrame, documents: DataFrame, concepts: DataFrame) -> DataFrame:
    """document_id, concept, period, value, ambiguous: what the tags say about the current and the prior period."""
    creditors = F.col("concept") == "Creditors"
    within = F.col("dimensions").eqNullSafe(F.lit(CREDITORS_WITHIN_ONE_YEAR))
    key = facts.where(
        F.col("is_numeric") & ~F.col("inconsistent") & F.col("value").isNotNull()
        & ((~creditors & ~F.col("dimensional")) | (creditors & F.col("dimensional") & within))
    ).select("document_id", "concept", "value", F.coalesce("instant", "period_end").alias("fact_date"))
    ends = documents.select("document_id", F.col("period_end").alias("doc_end"))
    dated = key.join(concepts.select("concept").distinct(), "concept", "left_semi").join(ends, "document_id")
    return latest_truth(dated.withColumn("period", period_of("fact_date", "doc_end")))


def period_of(fact_date: str, doc_end: str) -> Column:
    """current on the document's own date, prior before it; later dates and nulls are neither."""
    return F.when(F.col(fact_date) == F.col(doc_end), "current").when(F.col(fact_date) < F.col(doc_end), "prior")


def latest_truth(dated: DataFrame) -> DataFrame:
    """Of the dates that fall to a period, the latest; ambiguous if it has several values (the least is given)."""
    by_date = (
        dated.where(F.col("period").isNotNull())
        .groupBy("document_id", "concept", "period", "fact_date")
        .agg(F.min("value").alias("value"), (F.count_distinct("value") > 1).alias("ambiguous"))
    )
    place = F.row_number().over(Window.partitionBy("document_id", "concept", "period").orderBy(F.desc("fact_date")))
    return by_date.withColumn("place", place).where("place = 1").select("document_id", "concept", "period", "value", "ambiguous")


def outcome(extracted: Column, truth: Column) -> Column:
    return (
        F.when(truth.isNull() & extracted.isNull(), "not_applicable")
        .when(truth.isNull(), "unsupported")
        .when(extracted.isNull(), "missed")
        .when(extracted == truth, "correct")
        .when((extracted != 0) & (truth == extracted / 100), "tag_error")
        .otherwise("wrong")
    )


def error_type(verdict: Column, extracted: Column, truth: Column, other: Column) -> Column:
    """How a wrong value is wrong; near misses are compared by products, since decimal quotients round."""
    return (
        F.when(verdict == "tag_error", "truth_off_by_100")
        .when(verdict != "wrong", F.lit(None).cast("string"))
        .when(extracted == -truth, "sign_flipped")
        .when((extracted == truth * 1000) | (extracted * 1000 == truth), "scale_1000")
        .when(other.isNotNull() & (extracted == other), "period_swapped")
        .when((truth != 0) & (F.abs(extracted - truth) * 100 < F.abs(truth)), "near_miss")
        .otherwise("other")
    )


def scores(values: DataFrame, truth: DataFrame) -> DataFrame:
    """The extracted cells with truth, the other period's truth, outcome and error_type."""
    of = lambda period: F.max(F.when(F.col("period") == period, F.col("value"))).alias(period)
    known = truth.where(~F.col("ambiguous")).groupBy("document_id", "concept").agg(of("current"), of("prior"))
    j = values.withColumnRenamed("value", "extracted").join(known, ["document_id", "concept"], "left")
    here = F.col("period") == "current"
    j = j.withColumn("truth", F.when(here, F.col("current")).otherwise(F.col("prior"))).withColumn("other_truth", F.when(here, F.col("prior")).otherwise(F.col("current"))).drop("current", "prior")
    j = j.withColumn("outcome", outcome(F.col("extracted"), F.col("truth")))
    return j.withColumn("error_type", error_type(F.col("outcome"), F.col("extracted"), F.col("truth"), F.col("other_truth")))


def counted(by: list[str], scored: DataFrame, rollup: str | None = None) -> DataFrame:
    """Outcome and error counts; with `rollup`, also over all values of that column, in the same scan."""
    kinds = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES] + [F.count_if(F.col("error_type") == e).alias(e) for e in ERROR_TYPES]
    kinds.append(F.count_if(F.col("outcome").isin("correct", "wrong", "missed")).alias("verifiable"))
    if rollup is None:
        return scored.groupBy(*by).agg(*kinds)
    cols = [F.col(c) for c in by]
    sets = [cols, [F.col(c) for c in by if c != rollup]]
    out = scored.groupingSets(sets, *cols).agg(F.grouping(rollup).alias("all_"), *kinds)
    return out.withColumn(rollup, F.when(F.col("all_") == 1, F.lit("ALL")).otherwise(F.col(rollup))).drop("all_")


def with_rates(c: DataFrame) -> DataFrame:
    return c.withColumn("precision", safe_divide(F.col("correct"), F.col("correct") + F.col("wrong"))).withColumn(
        "recall", safe_divide(F.col("correct"), F.col("verifiable"))
    )


def metrics(scored: DataFrame, extractions: DataFrame) -> DataFrame:
    runs = extractions.groupBy("model", "prompt_id").agg(
        F.count("*").alias("documents"), F.avg("latency_ms").alias("mean_latency_ms"), (F.sum("cost_usd") * 1000 / F.count("*")).alias("usd_per_1000")
    )
    return with_rates(counted(["model", "prompt_id", "concept"], scored, rollup="concept")).join(runs, ["model", "prompt_id"])


def size_band(chars: Column) -> Column:
    return (
        F.when(chars < 2000, "1: under 2k chars").when(chars < 5000, "2: 2k to 5k").when(chars < 15000, "3: 5k to 15k").otherwise("4: over 15k")
    )


def metrics_by_size(scored: DataFrame, documents: DataFrame) -> DataFrame:
    bands = documents.select("document_id", size_band(F.col("text_chars")).alias("size_band"))
    return (
        scored.join(bands, "document_id")
        .groupBy("model", "prompt_id", "size_band")
        .agg(
            F.count_distinct("document_id").alias("documents"),
            F.count_if(F.col("outcome") == "correct").alias("correct"),
            F.count_if(F.col("outcome").isin("correct", "wrong", "missed")).alias("verifiable"),
        )
        .withColumn("recall", safe_divide(F.col("correct"), F.col("verifiable")))
    )
