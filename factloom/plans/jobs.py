"""The parse, extract and index jobs: members pinned before any data is written, a terminal row in the ledger on every path,
counts taken while rows are written, and runs that take up what an earlier one left open.

What a run has pinned is a table of its own, joined with what is there and anti-joined with what is done: a batch may be as
large as its cap says, and no list of ids passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import cost_usd
from ..operators import batches, extract, parse, retrieval
from ..schemas import CHUNK_CHARS, CHUNK_OVERLAP, EXTRACT_CAP, PARSE_CAP, PARSER_VERSION, PRICES
from ..sources import archives, tables

FLUSH_DOCUMENTS = 100


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def set_id(ids: DataFrame, *salt: str) -> tuple[str, int]:
    """(16 hex digits, count) of a set of ids (one column of distinct texts) and a salt, whatever the order: two sums over hashes."""
    c = ids.columns[0]
    sums = ids.agg(F.count("*").alias("n"), F.sum(F.xxhash64(c).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), F.col(c))).alias("x")).select(
        F.left(F.sha2(F.concat_ws("\n", *[F.lit(x) for x in salt], "n", F.col("s").cast("string"), "x"), 256), F.lit(16)).alias("id"), "n"
    )
    return tuple(sums.first())


def pinned(spark: SparkSession, root: str, ledger: str, batch: str, name: str) -> DataFrame:
    """What a batch has pinned, as one column."""
    return tables.read_table(spark, root, "pins", f"{ledger}/{batch}").select(F.col("item").alias(name))


def _run(
    spark: SparkSession, root: str, ledger: str, keys: dict[str, str], item: str, fixed: dict, choose: Callable[[], DataFrame], work: Callable[[str, DataFrame, str, dict], None],
    salt: Callable[[str], list[str]], publish: Callable[[dict], None] | None, fresh: bool = False,
) -> str:
    """One run of a job: its terminal status. `work` fills the counts as it goes, so that a failed run has those of what is there."""
    run, started = uuid.uuid4().hex, _now()
    batch, selected, counts = None, 0, {}

    def record(status: str, error: str | None = None) -> dict:
        row = {"run_id": run, **keys, "batch_id": batch, "status": status, "selected": selected, "started_at": started, "finished_at": _now(), "error": error}
        zeros = {f.name: 0 if f.dataType.simpleString() == "bigint" else 0.0 for f in tables.TABLES[ledger] if f.dataType.simpleString() in ("bigint", "double")}
        row = zeros | fixed | row | {k: type(zeros[k])(v) for k, v in counts.items() if k in zeros}
        tables.append_ledger(spark, root, ledger, row, f"{run}-{status}")
        return row

    try:
        mine = tables.read_table(spark, root, ledger)
        for k, v in keys.items():
            mine = mine.where(F.col(k) == F.lit(v))
        left_open = None if fresh else batches.open_batch(mine, list(keys)).select("batch_id", "selected").first()
        if left_open is not None:
            batch, selected = left_open
        else:
            chosen = tables.staged(choose(), root, f"chosen-{run}")
            id_, selected = set_id(chosen, *salt(run))
            if not selected:
                tables.unstage(spark, root, f"chosen-{run}")
                record("skipped_existing")
                return "skipped_existing"
            batch = id_
            at = f"{ledger}/{batch}"
            tables.load_batch(chosen.select(F.lit(batch).alias("batch_id"), F.col(item).alias("item")), root, "pins", at, at)
            tables.unstage(spark, root, f"chosen-{run}")
            record("started")
        work(batch, pinned(spark, root, ledger, batch, item), run, counts)
        row = record("succeeded")
    except Exception as e:  # whatever went wrong, the ledger says so
        record("failed", f"{type(e).__name__}: {e}"[:1000])
        return "failed"
    if publish is not None:
        publish(row)
    return "succeeded"


def publisher(root: str, kind: str, documents: Callable[[str], DataFrame] | None = None) -> Callable[[dict], bool]:
    """Writes a run's events after its success row: the documents' first, then the run's own. What fails here is lost but can be
    made again from the ledger; the run stands, and the answer is whether all was published."""

    def publish(row: dict) -> bool:
        try:
            spark = SparkSession.getActiveSession()
            path = f"{root}/_events/{kind}-{row['run_id']}"
            if documents is not None:
                documents(row["batch_id"]).write.mode("overwrite").json(f"{path}/documents")
            event = {"version": 1, "event": kind, "run_id": row["run_id"], "batch_id": row["batch_id"], "occurred_at": f"{_now().isoformat()}Z"}
            event |= {k: row[k] for k in ("source_key", "model", "prompt_id") if row.get(k)}
            spark.createDataFrame([(json.dumps(event),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/lifecycle")
            return True
        except Exception:
            return False

    return publish


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The quarantine with its releases laid over it."""
    return batches.overlay_releases(tables.read_table(spark, root, "quarantine"), tables.read_table(spark, root, "releases"))


def released_sources(spark: SparkSession, root: str) -> list[str]:
    """The sources to parse again because some of their failures were released: a list of archives, one run each."""
    freed = quarantine(spark, root).where("stage = 'parse' and released_at is not null").select("source_key").distinct()
    return [r[0] for r in freed.orderBy("source_key").collect()]


def purge_source(spark: SparkSession, root: str, source_key: str) -> dict[str, int]:
    """Drops all that parsing a source has written; how many rows of each table that were."""
    counts = {}
    for name in ("documents", "facts", "quarantine"):  # documents first: what is left of a crash is not taken for done
        counts[name] = int(tables.counted(spark, root, name, source_key).get("rows", 0))
        tables.purge(spark, root, name, source_key)
    return counts


def parse_source(spark: SparkSession, root: str, path: str, source_key: str, cap: int = PARSE_CAP, reparse: bool = False, publish=None) -> str:
    """Parses the members of one archive under `path` that are not done yet; `reparse` drops what the source gave before."""
    if reparse:
        purge_source(spark, root, source_key)

    def choose() -> DataFrame:
        names = archives.members(spark, path, source_key, with_content=False)
        broken = names.where("place is null").select("error").first()
        if broken is not None:
            raise ValueError(broken[0])
        blocked = quarantine(spark, root).where((F.col("source_key") == source_key) & F.expr("stage = 'parse' and released_at is null"))
        done = tables.read_table(spark, root, "documents", source_key).select("member_name").union(blocked.select("member_name"))
        return archives.select_members(names, cap).select("member_name").join(done, "member_name", "left_anti").distinct()

    def work(batch: str, members: DataFrame, run: str, counts: dict) -> None:
        rows = archives.members(spark, path, source_key).join(members, "member_name", "left_semi")
        parsed = tables.staged(parse.parse_members(rows), root, f"parsed-{batch}-{run}")
        key, at = f"{source_key}-{batch}", _now().isoformat()
        # Documents last: they are what says that a member is done.
        for name, made, count in (("quarantine", parse.quarantine_rows(parsed, batch, at), "quarantined"), ("facts", parse.fact_rows(parsed, batch), "facts"), ("documents", parse.document_rows(parsed, batch, at), "parsed")):
            tables.load_batch(made, root, name, key, source_key)
            counts[count] = tables.counted(spark, root, name, source_key, key)["rows"]
        tables.unstage(spark, root, f"parsed-{batch}-{run}")

    fixed = {"cap": cap, "parser_version": PARSER_VERSION, "reparse": reparse}
    salt = lambda run: [f"parser={PARSER_VERSION}", source_key, run if reparse else ""]
    return _run(spark, root, "parse_runs", {"source_key": source_key}, "member_name", fixed, choose, work, salt, publish, fresh=reparse)


def documents_by_id(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The latest row of each of the documents named (document_id)."""
    return batches.latest_per(documents.join(ids, "document_id", "left_semi"), ["document_id"], F.desc("parsed_at"), "batch_id")


def _priced(name: str) -> None:
    if not name.startswith("fake") and name.partition("@")[0] not in PRICES:
        raise ValueError(f"no price for {name}")


def _part_of(parts: int):
    """The part of a document, so that each holds about as many."""
    return F.pmod(F.xxhash64("document_id"), F.lit(parts))


def extract_documents(
    spark: SparkSession, root: str, model: extract.Model, prompt: dict[str, str], cap: int = EXTRACT_CAP, publish=None, flush: int = FLUSH_DOCUMENTS, threads: int = extract.THREADS
) -> str:
    """Asks the model about pending documents; a pinned document that is there no more is a failure of its own.

    About `flush` documents are asked about at a time; their answers are stored before the next, and a run that takes up the batch
    asks only about the others, so that a crash pays for no stored call again.
    """
    mine = (F.col("model") == model.name) & (F.col("prompt_id") == prompt["id"])
    documents = lambda: tables.read_table(spark, root, "documents")
    answered = lambda: tables.read_table(spark, root, "extractions").where(mine)

    def choose() -> DataFrame:
        _priced(model.name)
        return batches.pending_documents(documents(), answered(), quarantine(spark, root), model.name, prompt["id"], cap).select("document_id")

    def ask(batch: str, todo: DataFrame, run: str, selected: int) -> None:
        docs = documents_by_id(documents(), todo).select("document_id", "source_key", "text")
        parts = max(1, -(-selected // flush))
        for part in range(parts):
            said = extract.ask(docs.where(_part_of(parts) == part), model, prompt, threads)
            own = {"model": F.lit(model.name), "prompt_id": F.lit(prompt["id"]), "batch_id": F.lit(batch)}
            tables.load_batch(said.withColumns(own), root, "answers", f"{batch}-{run}-{part}", batch)

    def work(batch: str, pins: DataFrame, run: str, counts: dict) -> None:
        blocked = quarantine(spark, root).where(mine & F.expr("stage = 'extract' and released_at is null"))
        done = answered().select("document_id").union(blocked.select("document_id"))
        todo = tables.staged(pins.join(done, "document_id", "left_anti"), root, f"todo-{batch}-{run}")
        # Answers of this batch that an earlier run has paid for and not settled; one answer a document.
        paid = lambda: tables.read_table(spark, root, "answers", batch)
        unasked = todo.join(paid().select("document_id"), "document_id", "left_anti")
        ask(batch, unasked, run, unasked.count())
        said = paid().join(todo, "document_id", "left_semi")
        gone = batches.missing(todo, documents()).join(paid().select("document_id"), "document_id", "left_anti")
        zero = F.lit(0).cast("long")
        none = F.lit(None).cast("string")
        gone = gone.select("document_id", F.lit("").alias("source_key"), none.alias("answer"), *[zero.alias(c) for c in ("input_tokens", "output_tokens", "thinking_tokens", "latency_ms")],
                           none.alias("finish_reason"), F.lit("MissingDocument: pinned to the batch but absent from documents").alias("failure"))
        kept, bad = extract.split_answers(said.select(*gone.columns).unionByName(gone), model.name, prompt, batch, _now().isoformat())
        # What has no answer is written first: an answer is what says that a document is done.
        tables.load_batch(bad, root, "quarantine", f"{batch}-{run}", batch)
        spent = {"input_tokens": F.sum("input_tokens"), "output_tokens": F.sum(F.col("output_tokens") + F.col("thinking_tokens")), "cost_usd": F.sum("cost_usd")}
        tables.load_batch(kept, root, "extractions", f"{batch}-{run}", batch, spent)
        there = tables.counted(spark, root, "extractions", batch)
        counts |= there | {"extracted": there["rows"], "cost_usd": round(there["cost_usd"], 6), "quarantined": tables.counted(spark, root, "quarantine", batch)["rows"]}
        tables.unstage(spark, root, f"todo-{batch}-{run}")

    keys = {"model": model.name, "prompt_id": prompt["id"]}
    return _run(spark, root, "extract_runs", keys, "document_id", {"cap": cap}, choose, work, lambda run: list(keys.values()), publish)


def index_documents(
    spark: SparkSession, root: str, cap: int, model: str = "fake", embed: Callable[[DataFrame], DataFrame] = retrieval.embed, flush: int = FLUSH_DOCUMENTS
) -> str:
    """Chunks and embeds documents that the index lacks, about `flush` documents a part, so that a crash keeps the parts before it."""
    documents = lambda: tables.read_table(spark, root, "documents")
    there = lambda: tables.read_table(spark, root, "chunks").where(F.col("embedding_model") == model)
    nothing = lambda: tables.read_table(spark, root, "quarantine").where("false")

    def choose() -> DataFrame:
        _priced(model)
        as_done = there().select("document_id", F.lit(model).alias("model"), F.lit("").alias("prompt_id")).distinct()
        return batches.pending_documents(documents().where("text rlike '\\\\S'"), as_done, nothing(), model, "", cap).select("document_id")

    def work(batch: str, pins: DataFrame, run: str, counts: dict) -> None:
        todo = tables.staged(pins.join(there().select("document_id"), "document_id", "left_anti"), root, f"index-{batch}-{run}")
        parts = max(1, -(-todo.count() // flush))
        docs = documents_by_id(documents(), todo)
        for part in range(parts):
            rows = embed(retrieval.chunk_documents(docs.where(_part_of(parts) == part), "document_id", CHUNK_CHARS, CHUNK_OVERLAP))
            rows = rows.select(
                "document_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.lit(model).alias("embedding_model"), "text", F.col("chars").cast("long").alias("chars"), "tokens",
                "embedding", F.lit(batch).alias("batch_id"), F.lit(_now().isoformat()).cast("timestamp").alias("indexed_at"),
            )
            measures = {"indexed": F.count_if(F.col("chunk_index") == 0), "tokens": F.sum("tokens"), "cost_usd": F.coalesce(cost_usd(F.lit(model), F.sum("tokens"), F.lit(0), F.lit(0)), F.lit(0.0))}
            tables.load_batch(rows, root, "chunks", f"{batch}-{run}-{part}", batch, measures)
            seen = tables.counted(spark, root, "chunks", batch)
            counts |= seen | {"chunks": seen["rows"], "cost_usd": round(seen["cost_usd"], 6)}
        tables.unstage(spark, root, f"index-{batch}-{run}")

    return _run(spark, root, "index_runs", {"embedding_model": model}, "document_id", {"cap": cap}, choose, work, lambda run: [model], None)
