"""Batch control: what is pending, which batch is open, what to resume, release and purge; all as joins over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import stable_rank

#: What names one quarantine row; a document quarantined again after its release is another row.
QUARANTINE_ROW = ("stage", "source_key", "member_name", "batch_id", "quarantined_at", "model", "prompt_id")


def latest_per(df: DataFrame, by: list[str], order: Column, *ties: str) -> DataFrame:
    """The row of each key that comes first in the order; ties are broken by further columns."""
    cols = df.columns
    top = F.row_number().over(_window(by).orderBy(order, *ties))
    return df.withColumn("top_", top).where("top_ = 1").select(*cols)


def _window(by):
    from pyspark.sql import Window

    return Window.partitionBy(*by)


def overlay_releases(quarantine: DataFrame, releases: DataFrame) -> DataFrame:
    """Quarantine rows with released_at taken from an append-only table of releases."""
    r = releases.groupBy(*[F.col(c).alias(f"r_{c}") for c in QUARANTINE_ROW]).agg(F.min("released_at").alias("r_at"))
    same = None
    for c in QUARANTINE_ROW:
        one = F.col(c).eqNullSafe(F.col(f"r_{c}"))
        same = one if same is None else same & one
    out = quarantine.join(r, same, "left").withColumn("released_at", F.coalesce("released_at", "r_at"))
    return out.select(*quarantine.columns)


def release(quarantine: DataFrame, at, reason: str | None = None, model: str | None = None, prompt: str | None = None) -> DataFrame:
    """Rows of the release table for what a backfill frees: not yet released, never low confidence (its row was kept)."""
    q = quarantine.where(F.col("released_at").isNull() & (F.col("reason") != "LowConfidence"))
    if reason:
        q = q.where(F.col("reason") == reason)
    if model:
        q = q.where(F.col("model") == model)
    if prompt:
        q = q.where((F.col("prompt_id") == prompt) | F.col("prompt_id").startswith(prompt + "-"))
    return q.select(*QUARANTINE_ROW, F.lit(at).cast("timestamp").alias("released_at"))


def processed(documents: DataFrame, quarantine: DataFrame) -> DataFrame:
    """document_id of what is done: parsed, or quarantined by parsing and not released."""
    blocked = quarantine.where("stage = 'parse' and released_at is null and document_id is not null")
    return documents.select("document_id").union(blocked.select("document_id")).distinct()


def pending_documents(documents: DataFrame, extractions: DataFrame, quarantine: DataFrame, model: str, prompt_id: str, cap: int) -> DataFrame:
    """Documents without an answer or an unreleased failure for the model and prompt: released ones first, then by rank."""
    latest = latest_per(documents, ["document_id"], F.desc("parsed_at"), "batch_id")
    mine = (F.col("model") == model) & (F.col("prompt_id") == prompt_id)
    failed = quarantine.where(mine & (F.col("stage") == "extract"))
    done = extractions.where(mine).select("document_id")
    open_ = latest.join(done, "document_id", "left_anti")
    open_ = open_.join(failed.where("released_at is null").select("document_id"), "document_id", "left_anti")
    again = failed.where("released_at is not null").select("document_id").distinct().withColumn("again", F.lit(True))
    flagged = open_.join(again, "document_id", "left").withColumn("again", F.coalesce("again", F.lit(False)))
    return flagged.orderBy(F.desc("again"), stable_rank(F.col("document_id"))).limit(cap)


def open_batch(runs: DataFrame, by: list[str]) -> DataFrame:
    """The latest started row without a succeeded row of the same batch, for each key."""
    done = runs.where("status = 'succeeded'").select(*by, "batch_id").distinct()
    return latest_per(runs.where("status = 'started'").join(done, [*by, "batch_id"], "left_anti"), by, F.desc("started_at"), "run_id")


def resume(members: DataFrame, done: DataFrame) -> DataFrame:
    """Of a pinned batch (one row with an array document_ids), the ids still without an answer."""
    return members.select(F.explode("document_ids").alias("document_id")).distinct().join(done, "document_id", "left_anti")


def missing(pinned: DataFrame, documents: DataFrame) -> DataFrame:
    """Pinned ids whose document has vanished."""
    return pinned.join(documents.select("document_id"), "document_id", "left_anti")


def succeeded_caps(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status").isin("succeeded", "skipped_existing")).groupBy("source_key").agg(F.max("cap").alias("cap"))


def succeeded_keys(ingest_runs: DataFrame) -> DataFrame:
    """Ingested sources, oldest first."""
    return ingest_runs.where("status = 'succeeded'").groupBy("source_key").agg(F.min("finished_at").alias("first_at")).orderBy("first_at", "source_key")


def pending_sources(ingest_runs: DataFrame, parse_runs: DataFrame, quarantine: DataFrame, cap: int) -> DataFrame:
    """Ingested sources parsed with a smaller cap, not at all, or with released rows."""
    freed = quarantine.where("stage = 'parse' and released_at is not null").select("source_key").distinct().withColumn("freed", F.lit(True))
    j = succeeded_keys(ingest_runs).join(succeeded_caps(parse_runs), "source_key", "left").join(freed, "source_key", "left")
    return j.where(F.col("cap").isNull() | (F.col("cap") < cap) | F.coalesce("freed", F.lit(False))).select("source_key", "first_at")


def without_source(facts: DataFrame, documents: DataFrame, source_key: str) -> DataFrame:
    """The facts that stay when a source is parsed anew."""
    gone = documents.where(F.col("source_key") == source_key).select("document_id")
    return facts.join(gone, "document_id", "left_anti")
