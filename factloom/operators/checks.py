"""Data-quality checks: each gives the rows that break it, so that an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, *cols: str) -> DataFrame:
    whole = df.where(" and ".join(f"{c} is not null" for c in cols))
    return whole.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(col).isin(values)).groupBy(col).agg(F.count("*").alias("n"))


def relationships(child: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    c = child.where(F.col(col).isNotNull())
    return c.join(parent.select(F.col(key).alias("p_")), c[col] == F.col("p_"), "left_anti")


def table_checks(
    df: DataFrame, not_null_: tuple[str, ...] = (), accepted: dict[str, list[str]] | None = None, unique_: tuple[tuple[str, ...], ...] = (),
    parents: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """check, columns, failures (rows that break it; of rows with one key all but one) for all generic checks of a table, from one scan.

    Parents are joined by their distinct keys; keys that are null break neither uniqueness nor a relationship.
    """
    rules = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null_]
    rules += [("accepted_values", c, F.count_if(~F.col(c).isin(v))) for c, v in (accepted or {}).items()]
    for cols in unique_:
        given = F.lit(True)
        for c in cols:
            given = given & F.col(c).isNotNull()
        rules.append(("unique", ",".join(cols), F.count_if(given) - F.count_distinct(F.when(given, F.struct(*cols)))))
    for i, (c, (parent, key)) in enumerate((parents or {}).items()):
        p = parent.select(F.col(key).alias(f"parent_{i}")).where(F.col(f"parent_{i}").isNotNull()).distinct()
        df = df.join(p, F.col(c) == F.col(f"parent_{i}"), "left")
        rules.append(("relationships", c, F.count_if(F.col(c).isNotNull() & F.col(f"parent_{i}").isNull())))
    sums = df.agg(*[r[2].cast("long").alias(f"r{i}") for i, r in enumerate(rules)])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.lit(c).alias("columns"), F.col(f"r{i}").alias("failures")) for i, (k, c, _) in enumerate(rules)])))


def documents_reconcile(documents: DataFrame, quarantine: DataFrame, parse_runs: DataFrame) -> DataFrame:
    """Sources whose documents and quarantine rows differ from what the ledger says since the last reparse."""
    ok = parse_runs.where("status = 'succeeded'")
    since = ok.where("reparse").groupBy("source_key").agg(F.max("started_at").alias("since"))
    ledger = ok.join(since, "source_key", "left").where("since is null or started_at >= since")
    ledger = ledger.groupBy("source_key").agg(F.sum("parsed").alias("parsed"), F.sum("quarantined").alias("quarantined"))
    docs = documents.groupBy("source_key").agg(F.count("*").alias("documents"))
    bad = quarantine.where("stage = 'parse'").groupBy("source_key").agg(F.count("*").alias("rows"))
    j = ledger.join(docs, "source_key", "full_outer").join(bad, "source_key", "full_outer").fillna(0)
    return j.where("parsed <> documents or quarantined <> rows")


def cost_reconciles(extractions: DataFrame, extract_runs: DataFrame, within: float = 0.001) -> DataFrame:
    keys = ["model", "prompt_id", "batch_id"]
    rows = extractions.groupBy(*keys).agg(F.sum("cost_usd").alias("row_cost"))
    runs = extract_runs.where("status = 'succeeded'").groupBy(*keys).agg(F.sum("cost_usd").alias("run_cost"))
    return rows.join(runs, keys, "full_outer").fillna(0.0, ["row_cost", "run_cost"]).where(F.abs(F.col("row_cost") - F.col("run_cost")) > within)


def values_complete(values: DataFrame, expected: int = 18) -> DataFrame:
    return values.groupBy("document_id", "model", "prompt_id").agg(F.count("*").alias("n")).where(F.col("n") != expected)


def extract_counts_match(extractions: DataFrame, quarantine: DataFrame, extract_runs: DataFrame) -> DataFrame:
    """Batches whose succeeded runs count other numbers of answers or failures than there are rows; an answer of low
    confidence is a row of both kinds and counts in both."""
    there = extractions.select("batch_id", F.lit(1).alias("kept"), F.lit(0).alias("failed"))
    there = there.union(quarantine.where("stage = 'extract'").select("batch_id", F.lit(0), F.lit(1)))
    there = there.groupBy("batch_id").agg(F.sum("kept").alias("rows_extracted"), F.sum("failed").alias("rows_quarantined"))
    told = extract_runs.where("status = 'succeeded'").groupBy("batch_id").agg(F.sum("extracted").alias("extracted"), F.sum("quarantined").alias("quarantined"))
    both = told.join(there, "batch_id", "left").fillna(0, ["rows_extracted", "rows_quarantined"])
    return both.where("extracted <> rows_extracted or quarantined <> rows_quarantined")


def fact_counts_match(documents: DataFrame, facts: DataFrame) -> DataFrame:
    n = facts.groupBy("document_id").agg(F.count("*").alias("n"))
    return documents.join(n, "document_id", "left").where("fact_count <> coalesce(n, 0)").select("document_id", "fact_count", "n")


def occurrences_agree(stg_facts: DataFrame) -> DataFrame:
    """A warning rather than a failure: facts whose occurrences give several numbers."""
    return stg_facts.where("inconsistent")
