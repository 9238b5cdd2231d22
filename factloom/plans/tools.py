"""The query tools: search, ask, facts and extraction of a document, model comparison, pipeline status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import cost_usd, fake_embedding
from ..operators import retrieval
from ..operators.extract import Model


def search(chunks: DataFrame, documents: DataFrame, names: DataFrame, question: str, k: int = 5, model: str = "fake") -> DataFrame:
    """The k (1 to 20) chunks nearest to a question, nearest first."""
    query = fake_embedding(F.lit(question))
    mine = chunks.where(F.col("embedding_model") == model)
    hits = retrieval.nearest(mine, query, max(1, min(k, 20)), "document_id", "chunk_index")
    return retrieval.with_documents(hits, documents, names).orderBy("distance", "document_id", "chunk_index")


def ask(hits: DataFrame, question: str, model: Model) -> DataFrame:
    """One row: the model's answer over the passages, with citations that were given and ones that were not."""
    p = retrieval.passage(F.col("document_id"), F.col("chunk_index"), F.col("company_name"), F.col("company_number"), F.col("period_end"), F.col("text"))
    ordered = F.sort_array(F.collect_list(F.struct("distance", "key", p.alias("p"))))
    one = hits.agg(ordered.alias("h")).select(F.col("h.key").alias("keys"), F.array_join(F.col("h.p"), "\n\n").alias("passages"))

    def call(passages):
        import pandas as pd

        said = [model.answer(f"{x}\n\n{question}") for x in passages]
        rows = [(r.text, r.input_tokens, r.output_tokens, r.thinking_tokens) for r in said]
        return pd.DataFrame(rows, columns=["answer", "input_tokens", "output_tokens", "thinking_tokens"])

    schema = "answer string, input_tokens long, output_tokens long, thinking_tokens long"
    a = one.withColumn("r", F.pandas_udf(call, schema)("passages")).select("keys", "r.*")
    c = retrieval.cited(F.col("answer"), F.col("keys"))
    price = cost_usd(F.lit(model.name), F.col("input_tokens"), F.col("output_tokens"), F.col("thinking_tokens"))
    return a.select("answer", c["resolved"].alias("citations"), c["unsupported"].alias("unsupported_citations"), price.alias("cost_usd"))


def get_facts(facts: DataFrame, document_id: str, most: int = 200) -> DataFrame:
    """A document's numeric facts that are printed somewhere."""
    mine = facts.where((F.col("document_id") == document_id) & F.col("is_numeric") & ~F.col("hidden_everywhere"))
    return mine.orderBy(F.asc_nulls_first("concept"), F.asc_nulls_first("period_end"), F.asc_nulls_first("instant"), "context_id").limit(most)


def get_extraction(values: DataFrame, scored: DataFrame, document_id: str | None = None, model: str | None = None, prompt: str | None = None) -> DataFrame:
    """Extracted values with their verdicts, of one document or all; the prompt may be given by its version alone."""
    v = values if document_id is None else values.where(F.col("document_id") == document_id)
    if model is not None:
        v = v.where(F.col("model") == model)
    if prompt is not None:
        v = v.where(F.col("prompt_id").startswith(prompt))
    keys = ["document_id", "model", "prompt_id", "field", "period"]
    return v.join(scored.select(*keys, "truth", "outcome", "error_type"), keys, "left")


def compare_models(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("model", "prompt_id", "concept")


def status(tables: dict[str, DataFrame]) -> DataFrame:
    """One row on the whole pipeline."""
    t = tables
    count = lambda name: F.count("*").alias(name)
    last = lambda name: F.max(F.when(F.col("status") == "succeeded", F.col("finished_at"))).cast("string").alias(name)
    spend = lambda name: F.round(F.sum("cost_usd"), 2).alias(name)
    parts = [
        t["documents"].agg(count("documents")), t["stg_facts"].agg(count("facts")), t["extractions"].agg(count("extractions")),
        t["chunks"].agg(F.count_distinct("document_id").alias("indexed_docs"), count("chunks")),
        t["quarantine"].where("released_at is null").agg(count("quarantined")), t["parse_runs"].agg(last("last_parse")),
        t["extract_runs"].agg(last("last_extract"), spend("extract_spend_usd")), t["index_runs"].agg(last("last_index"), spend("index_spend_usd")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out
