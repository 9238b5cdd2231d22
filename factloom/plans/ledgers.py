"""Queries over ledgers in which something is left open, redone or broken, so that every branch has rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import batches, checks
from .catalogue import dec, query, t
from .tools import status

#: events as a ledger: a source a user, a batch that several events may share.
RUNS_SQL = """r as (select event_id::varchar as run_id, user_id % 40 as source_key, event_id % 400 as batch_id, ts as started_at, event_id % 37 = 0 as reparse,
 case when event_type in ('view', 'signup') then 'started' when event_type in ('purchase', 'click') then 'succeeded' else 'failed' end as status, event_id % 3 as parsed, event_id % 2 as quarantined from events)"""


def _runs(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    status_ = F.when(F.col("event_type").isin("view", "signup"), "started").when(F.col("event_type").isin("purchase", "click"), "succeeded").otherwise("failed")
    return e.select(
        F.col("event_id").cast("string").alias("run_id"), (F.col("user_id") % 40).alias("source_key"), (F.col("event_id") % 400).alias("batch_id"), F.col("ts").cast("timestamp").alias("started_at"),
        (F.col("event_id") % 37 == 0).alias("reparse"), status_.alias("status"), (F.col("event_id") % 3).alias("parsed"), (F.col("event_id") % 2).alias("quarantined"), F.col("value"),
    )


@query(
    f"""with {RUNS_SQL}, ok as (select * from r where status = 'succeeded'), s as (select source_key, max(started_at) as since from ok where reparse group by 1),
    l as (select source_key, sum(parsed) as parsed, sum(quarantined) as quarantined from ok left join s using (source_key) where since is null or started_at >= since group by 1),
    d as (select o_orderkey % 45 as source_key, count(*) as documents from orders group by 1), q as (select l_orderkey % 42 as source_key, count(*) as n from lineitem where l_linenumber = 7 group by 1)
    select source_key, coalesce(parsed, 0)::bigint as parsed, coalesce(documents, 0)::bigint as documents, coalesce(quarantined, 0)::bigint as quarantined, coalesce(n, 0)::bigint as rows
    from l full join d using (source_key) full join q using (source_key) where coalesce(parsed, 0) <> coalesce(documents, 0) or coalesce(quarantined, 0) <> coalesce(n, 0)"""
)
def reconcile_since_reparse(spark, sf_dir):
    """Sources whose rows differ from what the ledger says of the runs since their last reparse."""
    docs = t(spark, sf_dir, "orders").select((F.col("o_orderkey") % 45).alias("source_key"))
    bad = t(spark, sf_dir, "lineitem").where("l_linenumber = 7").select((F.col("l_orderkey") % 42).alias("source_key"), F.lit("parse").alias("stage"))
    out = checks.documents_reconcile(docs, bad, _runs(spark, sf_dir))
    return out.select("source_key", *[F.col(c).cast("long").alias(c) for c in ("parsed", "documents", "quarantined", "rows")])


@query(
    f"""with {RUNS_SQL}, s as (select distinct source_key, batch_id from r where status = 'succeeded')
    select source_key, batch_id, run_id from r where status = 'started' and not exists (select 1 from s where s.source_key = r.source_key and s.batch_id = r.batch_id)
    qualify row_number() over (partition by source_key order by started_at desc, run_id) = 1"""
)
def batches_left_open(spark, sf_dir):
    """Of each source the latest started batch that never succeeded."""
    return batches.open_batch(_runs(spark, sf_dir), ["source_key"]).select("source_key", "batch_id", "run_id")


@query(
    """select 'not_null' as check, 'l_shipdate' as columns, count(*) filter (where l_shipdate is null)::bigint as failures from lineitem
    union all select 'not_null', 'l_comment', count(*) filter (where case when l_linenumber = 7 then null else l_returnflag end is null)::bigint from lineitem
    union all select 'accepted_values', 'l_returnflag', count(*) filter (where l_returnflag not in ('A', 'N'))::bigint from lineitem
    union all select 'unique', 'l_orderkey', count(*)::bigint - count(distinct l_orderkey)::bigint from lineitem
    union all select 'unique', 'l_orderkey,l_linenumber', count(*)::bigint - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))::bigint from lineitem
    union all select 'relationships', 'l_suppkey', count(*) filter (where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 20))::bigint from lineitem
    union all select 'relationships', 'l_partkey', count(*) filter (where l_partkey not in (select p_partkey from part))::bigint from lineitem"""
)
def generic_checks(spark, sf_dir):
    """All generic checks of one table from one scan, some of them broken."""
    line = t(spark, sf_dir, "lineitem").withColumn("l_comment", F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")))
    suppliers = t(spark, sf_dir, "supplier").where("s_nationkey < 20")
    return checks.table_checks(
        line, ("l_shipdate", "l_comment"), {"l_returnflag": ["A", "N"]}, (("l_orderkey",), ("l_orderkey", "l_linenumber")),
        {"l_suppkey": (suppliers, "s_suppkey"), "l_partkey": (t(spark, sf_dir, "part"), "p_partkey")},
    )


@query(
    f"""with {RUNS_SQL} select (select count(*) from documents)::bigint as documents, (select count(*) from lineitem)::bigint as facts, (select count(*) from orders)::bigint as extractions,
    (select count(distinct label) from embeddings)::bigint as indexed_docs, (select count(*) from embeddings)::bigint as chunks, (select count(*) from labels where quality = 0 and toxic = 0)::bigint as quarantined,
    (select strftime(max(started_at), '%Y-%m-%d %H:%M:%S') from r where status = 'succeeded') as last_parse, (select strftime(max(started_at), '%Y-%m-%d %H:%M:%S') from r where status = 'succeeded' and source_key < 20) as last_extract,
    (select strftime(max(started_at), '%Y-%m-%d %H:%M:%S') from r where status = 'succeeded' and source_key = 7) as last_index,
    (select round(sum(o_totalprice::decimal(38,2)), 2)::double from orders) as extract_spend_usd, (select round(sum(l_tax::decimal(38,2)), 2)::double from lineitem) as index_spend_usd"""
)
def pipeline_status(spark, sf_dir):
    """One row on the whole pipeline, all of its columns."""
    runs = _runs(spark, sf_dir).withColumn("finished_at", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss"))
    spent = lambda name, c: t(spark, sf_dir, name).select(F.lit("-").alias("status"), F.lit(None).cast("string").alias("finished_at"), dec(c).alias("cost_usd"))
    ledger = lambda df: df.select("status", "finished_at", F.lit(None).cast("decimal(12,2)").alias("cost_usd"))
    bad = t(spark, sf_dir, "labels").where("quality = 0").withColumn("released_at", F.when(F.col("toxic") == 1, F.lit("2025-01-01").cast("timestamp")))
    s = status({
        "documents": t(spark, sf_dir, "documents"), "stg_facts": t(spark, sf_dir, "lineitem"), "extractions": t(spark, sf_dir, "orders"),
        "chunks": t(spark, sf_dir, "embeddings").withColumnRenamed("label", "document_id"), "quarantine": bad, "parse_runs": runs,
        "extract_runs": ledger(runs.where("source_key < 20")).union(spent("orders", "o_totalprice")), "index_runs": ledger(runs.where("source_key = 7")).union(spent("lineitem", "l_tax")),
    })
    return s.select(*[F.col(c).cast("double").alias(c) if c.endswith("_usd") else F.col(c) for c in s.columns])
