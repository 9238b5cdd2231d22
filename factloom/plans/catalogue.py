"""Registered queries over the given tables, each through the operators, with the SQL that says the same.

The tables stand in for the engine's own: orders for documents with a date, lineitem for tagged facts, events for
ledgers and messages, embeddings for chunks, pages for markup, labels for verdicts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import batches, checks, evaluate, parse, retrieval, staging
from ..schemas import NUMERIC
from ..streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; in a local session without one, in a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="factloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df as a written table."""
    path = shared_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dec(c: str | Column, digits: int = 2) -> Column:
    return F.col(c).cast(f"decimal(38,{digits})") if isinstance(c, str) else c.cast(f"decimal(38,{digits})")


# ---------------------------------------------------------------- projections and predicates


@query("select doc_id, source, lang, length(text)::bigint as text_chars from documents")
def stg_documents_text_chars(spark, sf_dir):
    d = staging.stg_documents(t(spark, sf_dir, "documents"))
    return d.select("doc_id", "source", "lang", F.col("text_chars").cast("long").alias("text_chars"))


BAND = """case when length(text) < 2000 then '1: under 2k chars' when length(text) < 5000 then '2: 2k to 5k'
 when length(text) < 15000 then '3: 5k to 15k' else '4: over 15k' end"""


@query(f"select {BAND} as size_band, count(*)::bigint as n, sum(n_chars)::bigint as chars from documents group by 1")
def size_bands(spark, sf_dir):
    d = t(spark, sf_dir, "documents").withColumn("size_band", evaluate.size_band(F.length("text")))
    return d.groupBy("size_band").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def _runs(spark, sf_dir):
    """events as ledger rows: one run a user and event type, from its first to its last event."""
    e = t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy("user_id", "event_type").agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"), F.count("*").alias("n"))


@query(
    """select user_id, event_type, datesub('second', min(ts), max(ts))::bigint as duration_seconds, count(*)::bigint as n
    from events group by user_id, event_type"""
)
def runs_duration(spark, sf_dir):
    r = _runs(spark, sf_dir)
    return staging.stg_extract_runs(r).select("user_id", "event_type", F.col("duration_seconds").cast("long").alias("duration_seconds"), "n")


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_header_pull(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    r"""select page_id, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') as host,
    coalesce(nullif(regexp_extract(url, '/([^/]+)$', 1), ''), 'unresolved') as segment from pages"""
)
def namespace_split(spark, sf_dir):
    host, last = X.found(F.col("url"), "^https?://([^/]+)"), X.found(F.col("url"), "/([^/]+)$")
    return t(spark, sf_dir, "pages").select("page_id", host.alias("host"), F.coalesce(last, F.lit("unresolved")).alias("segment"))


# ---------------------------------------------------------------- facts, answer key, verdicts


def _facts(spark, sf_dir):
    """lineitem as tagged occurrences; every sixth number is nil, every second occurrence hidden."""
    line = t(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    return line.select(
        F.col("l_orderkey").cast("string").alias("document_id"), F.col("l_returnflag").alias("concept"),
        F.concat(F.lit("http://example.test/x/2025-01-01/"), F.col("l_linestatus")).alias("namespace"),
        (F.col("l_suppkey") % 2).cast("string").alias("context_id"), (F.col("l_linenumber") != 7).alias("is_numeric"),
        F.when(F.col("l_linenumber") != 6, F.col("l_quantity").cast(NUMERIC)).alias("value"), F.col("l_partkey").cast("string").alias("text"),
        F.lit("GBP").alias("unit"), F.lit("0").alias("decimals"), F.lit(None).cast("string").alias("format"), F.lit(0).cast("long").alias("scale"),
        F.lit(None).cast("string").alias("sign"), (F.col("l_linenumber") % 2 == 0).alias("in_hidden"), F.lit(None).cast("date").alias("period_start"),
        day.alias("period_end"), F.when(F.col("l_linenumber") % 3 == 0, day).alias("instant"), (F.col("l_tax") > 0.07).alias("dimensional"),
        F.lit("b").alias("batch_id"), F.lit(None).cast("string").alias("dimensions"),
    )


FACTS_SQL = """f as (select l_orderkey::varchar as document_id, l_returnflag as concept, l_linestatus as taxonomy, (l_suppkey % 2)::varchar as context_id,
 l_linenumber <> 7 as is_numeric, case when l_linenumber <> 6 then l_quantity::decimal(38,9) end as value, l_partkey::varchar as text,
 l_linenumber % 2 = 0 as in_hidden, l_shipdate::date as day, l_tax > 0.07 as dimensional from lineitem)"""
COLLAPSE_SQL = f"""with {FACTS_SQL}, g as (select document_id, concept, taxonomy, context_id, min(value) as value, bool_or(is_numeric) as is_numeric,
 arg_min(text, (case when in_hidden then '0' else '1' end) || lpad(text, 20, ' ')) filter (where true) as x,
 first(text order by in_hidden desc, text) as text, first(text order by in_hidden, text) as printed_text, bool_and(in_hidden) as hidden_everywhere,
 count(*)::bigint as occurrences, count(distinct case when is_numeric then coalesce(value::varchar, '<nil>') end)::bigint as distinct_values,
 count(distinct text)::bigint as distinct_texts from f group by all)"""


@query(
    COLLAPSE_SQL
    + """ select document_id, concept, taxonomy, context_id, value::double as value, is_numeric, text, printed_text, hidden_everywhere, occurrences,
    distinct_values, distinct_texts, is_numeric and distinct_values > 1 as inconsistent from g"""
)
def occurrence_collapse(spark, sf_dir):
    f = staging.stg_facts(staging.stg_fact_occurrences(_facts(spark, sf_dir)))
    return f.select(
        "document_id", "concept", "taxonomy", "context_id", F.col("value").cast("double").alias("value"), "is_numeric", "text", "printed_text",
        "hidden_everywhere", "occurrences", "distinct_values", "distinct_texts", "inconsistent",
    )


@query(COLLAPSE_SQL + " select document_id || '|' || taxonomy || ':' || concept || '|' || context_id as fact_key, distinct_values from g where is_numeric and distinct_values > 1")
def inconsistent_facts(spark, sf_dir):
    f = staging.stg_facts(staging.stg_fact_occurrences(_facts(spark, sf_dir)))
    return checks.occurrences_agree(f).select("fact_key", "distinct_values")


def _truth(spark, sf_dir):
    """Ship dates against the order's date plus 60 days: current on or within it, prior before."""
    line, orders = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    ends = orders.select(F.col("o_orderkey").alias("document_id"), F.date_add(F.col("o_orderdate").cast("date"), 60).alias("doc_end"))
    f = line.select(F.col("l_orderkey").alias("document_id"), F.col("l_returnflag").alias("concept"), F.col("l_shipdate").cast("date").alias("fact_date"), dec("l_quantity").alias("value"))
    dated = f.join(ends, "document_id")
    month = F.when(F.col("fact_date") > F.date_sub("doc_end", 30), F.when(F.col("fact_date") <= F.col("doc_end"), F.col("doc_end"))).otherwise(F.col("fact_date"))
    return evaluate.latest_truth(dated.withColumn("fact_date", month).withColumn("period", evaluate.period_of("fact_date", "doc_end")))


TRUTH_SQL = """e as (select o_orderkey as document_id, o_orderdate::date + 60 as doc_end from orders),
d as (select l_orderkey as document_id, l_returnflag as concept, l_shipdate::date as s, l_quantity::decimal(38,2) as value, doc_end
      from lineitem join e on l_orderkey = document_id),
p as (select *, case when s > doc_end then null when s > doc_end - 30 then doc_end else s end as fact_date from d),
q as (select *, case when fact_date = doc_end then 'current' when fact_date < doc_end then 'prior' end as period from p),
m as (select document_id, concept, period, fact_date, min(value) as value, count(distinct value) > 1 as ambiguous from q where period is not null group by all),
truth as (select document_id, concept, period, value, ambiguous from m
          qualify row_number() over (partition by document_id, concept, period order by fact_date desc) = 1)"""


@query(f"with {TRUTH_SQL} select document_id, concept, period, value::double as value, ambiguous from truth")
def ground_truth_latest_date(spark, sf_dir):
    return _truth(spark, sf_dir).select("document_id", "concept", "period", F.col("value").cast("double").alias("value"), "ambiguous")


MEASURES = ("quantity", "extendedprice", "discount", "tax")


@query(
    " union all ".join(
        f"select l_orderkey as document_id, l_linenumber::int as line, '{m}' as field, '{p}' as period, round(l_{m}{' * 2' if p == 'prior' else ''}, 4)::double as value from lineitem"
        for m in MEASURES
        for p in ("current", "prior")
    )
)
def cells_unpivot(spark, sf_dir):
    """All cells in one pass over the rows, where a union of selections would read the table once a cell."""
    cells = [
        F.struct(F.lit(m).alias("field"), F.lit(p).alias("period"), F.round(F.col(f"l_{m}") * (2 if p == "prior" else 1), 4).alias("value"))
        for m in MEASURES
        for p in ("current", "prior")
    ]
    line = t(spark, sf_dir, "lineitem")
    return line.select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").cast("int").alias("line"), F.inline(F.array(*cells)))


def _scores(spark, sf_dir):
    """A simulated answer for each cell of the answer key, distorted by its order's number, and its verdict."""
    truth = _truth(spark, sf_dir).withColumn("value", F.col("value").cast(NUMERIC))
    v, n = F.col("value"), (F.col("document_id") + F.ascii("concept") + F.when(F.col("period") == "prior", 3).otherwise(0)) % 7
    said = (
        F.when(n == 0, v).when(n == 1, -v).when(n == 2, v * 1000).when(n == 3, F.lit(None)).when(n == 4, v + v / 200).when(n == 5, v * 100).otherwise(v + 7)
    )
    cells = truth.select(
        "document_id", F.concat(F.lit("m"), F.col("document_id") % 3).alias("model"), F.lit("v1-x").alias("prompt_id"), "concept", "period",
        said.cast(NUMERIC).alias("value"),
    )
    return evaluate.scores(cells, truth)


SCORES_SQL = f"""{TRUTH_SQL}, c as (select document_id, 'm' || (document_id % 3) as model, 'v1-x' as prompt_id, concept, period, value::decimal(28,9) as v,
 (document_id + ascii(concept) + case when period = 'prior' then 3 else 0 end) % 7 as n from truth),
cells as (select document_id, model, prompt_id, concept, period,
  (case n when 0 then v when 1 then -v when 2 then v * 1000 when 3 then null when 4 then ((v * 1005)::double / 1000)::decimal(28,9) when 5 then v * 100 else v + 7 end)::decimal(28,9) as extracted from c),
known as (select * from truth where not ambiguous),
j as (select cells.*, a.value::decimal(28,9) as truth, b.value::decimal(28,9) as other_truth from cells
  left join known a on cells.document_id = a.document_id and cells.concept = a.concept and cells.period = a.period
  left join known b on cells.document_id = b.document_id and cells.concept = b.concept and cells.period <> b.period),
o as (select *, case when truth is null and extracted is null then 'not_applicable' when truth is null then 'unsupported' when extracted is null then 'missed'
  when extracted = truth then 'correct' when extracted <> 0 and truth * 100 = extracted then 'tag_error' else 'wrong' end as outcome from j),
scores as (select *, case when outcome = 'tag_error' then 'truth_off_by_100' when outcome <> 'wrong' then null when extracted = -truth then 'sign_flipped'
  when extracted = truth * 1000 or extracted * 1000 = truth then 'scale_1000' when other_truth is not null and extracted = other_truth then 'period_swapped'
  when truth <> 0 and abs(extracted - truth) * 100 < abs(truth) then 'near_miss' else 'other' end as error_type from o)"""


@query(f"with {SCORES_SQL} select document_id, model, concept, period, extracted::double as extracted, truth::double as truth, outcome, error_type from scores")
def eval_scores(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.select("document_id", "model", "concept", "period", F.col("extracted").cast("double").alias("extracted"), F.col("truth").cast("double").alias("truth"), "outcome", "error_type")


def _extractions(spark, sf_dir):
    """orders as extraction runs: their price as cost, a latency from the key."""
    o = t(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("document_id"), F.concat(F.lit("m"), F.col("o_orderkey") % 3).alias("model"), F.lit("v1-x").alias("prompt_id"),
        dec("o_totalprice").alias("cost_usd"), (F.col("o_orderkey") % 1000).alias("latency_ms"),
    )


COUNTS_SQL = ", ".join(f"count(*) filter (where outcome = '{o}')::bigint as {o}" for o in evaluate.OUTCOMES)
COUNTS_SQL += ", " + ", ".join(f"count(*) filter (where error_type = '{e}')::bigint as {e}" for e in evaluate.ERROR_TYPES)
COUNTS_SQL += ", count(*) filter (where outcome in ('correct', 'wrong', 'missed'))::bigint as verifiable"
ROLLUP_SQL = f"""{SCORES_SQL}, w as (select model, prompt_id, case when grouping(concept) = 1 then 'ALL' else concept end as concept, {COUNTS_SQL}
 from scores group by grouping sets ((model, prompt_id, concept), (model, prompt_id))),
r as (select 'm' || (o_orderkey % 3) as model, 'v1-x' as prompt_id, count(*)::bigint as documents, round(avg(o_orderkey % 1000), 6) as mean_latency_ms,
 round(sum(o_totalprice::decimal(38,2))::double * 1000 / count(*), 4) as usd_per_1000 from orders group by 1)
"""
ROLLUP_SELECT = """select w.*, round(correct / nullif(correct + wrong, 0), 9) as precision, round(correct / nullif(verifiable, 0), 9) as recall,
 documents, mean_latency_ms, usd_per_1000 from w join r using (model, prompt_id)"""


@query(f"with {ROLLUP_SQL} {ROLLUP_SELECT}")
def eval_metrics_rollup(spark, sf_dir):
    """Precision and recall by model, prompt and concept, and over all concepts, with cost and latency."""
    m = evaluate.metrics(_scores(spark, sf_dir), _extractions(spark, sf_dir))
    rounded = {"precision": 9, "recall": 9, "mean_latency_ms": 6}
    cost = F.round(F.col("usd_per_1000").cast("double"), 4)
    return m.withColumns({c: F.round(c, n) for c, n in rounded.items()}).withColumn("usd_per_1000", cost)


@query(
    f"""with s as (select doc_id, lang as model, 'v1' as prompt_id, {BAND} as size_band,
    case when quality = 1 and toxic = 0 then 'correct' when quality = 1 then 'wrong' else 'missed' end as outcome from documents join labels using (doc_id))
    select model, prompt_id, size_band, count(distinct doc_id)::bigint as documents, count(*) filter (where outcome = 'correct')::bigint as correct,
    count(*)::bigint as verifiable, round(count(*) filter (where outcome = 'correct') / count(*), 9) as recall from s group by all"""
)
def eval_metrics_by_size(spark, sf_dir):
    d, labels = t(spark, sf_dir, "documents"), t(spark, sf_dir, "labels")
    verdict = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "correct").when(F.col("quality") == 1, "wrong").otherwise("missed")
    scored = labels.join(d.select("doc_id", "lang"), "doc_id").select(
        F.col("doc_id").alias("document_id"), F.col("lang").alias("model"), F.lit("v1").alias("prompt_id"), verdict.alias("outcome")
    )
    sized = d.select(F.col("doc_id").alias("document_id"), F.length("text").alias("text_chars"))
    return evaluate.metrics_by_size(scored, sized).withColumn("recall", F.round("recall", 9))


@query(
    f"""with {ROLLUP_SQL}, mm as ({ROLLUP_SELECT}) select concept, max(recall) filter (where model = 'm0') as "m0 / v1", max(recall) filter (where model = 'm1') as "m1 / v1",
    max(recall) filter (where model = 'm2') as "m2 / v1" from mm group by concept"""
)
def report_pivot(spark, sf_dir):
    from .report import pivot_recall

    return pivot_recall(eval_metrics_rollup(spark, sf_dir), [f"m{i} / v1" for i in range(3)])


# ---------------------------------------------------------------- batch control


def _control(spark, sf_dir):
    """documents, labels of quality 1 as answers, other labels as failures (toxic ones released)."""
    d = t(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("source_key"), F.lit("2025-01-01").cast("timestamp").alias("parsed_at"), F.lit("b").alias("batch_id")
    )
    at, lab = F.lit("2025-01-02").cast("timestamp"), t(spark, sf_dir, "labels")
    ids = lab.select(
        F.col("doc_id").cast("string").alias("document_id"), "quality", "toxic", F.lit("m").alias("model"), F.lit("p").alias("prompt_id"), F.lit("b").alias("batch_id")
    )
    extractions = ids.where("quality = 1 and toxic = 0")
    quarantine = ids.where("quality = 0 or toxic = 1").withColumns({
        "stage": F.lit("extract"), "reason": F.when(F.col("quality") == 0, "SchemaValidation").otherwise("LowConfidence"),
        "source_key": F.lit("s"), "member_name": F.col("document_id"), "quarantined_at": at, "released_at": F.when(F.col("toxic") == 1, at),
    })
    return d, extractions, quarantine


@query(
    """with done as (select doc_id from labels where quality = 1 and toxic = 0), bad as (select doc_id, toxic = 1 as released from labels where quality = 0 or toxic = 1)
    select d.doc_id::varchar as document_id, coalesce(bool_or(b.released), false) as again from documents d left join bad b on d.doc_id = b.doc_id
    where d.doc_id not in (select doc_id from done) and d.doc_id not in (select doc_id from bad where not released)
    group by d.doc_id order by again desc, sha256(d.doc_id::varchar) limit 300"""
)
def pending_documents(spark, sf_dir):
    d, done, bad = _control(spark, sf_dir)
    return batches.pending_documents(d, done, bad, "m", "p", 300).select("document_id", "again")


@query("select doc_id, sha256(doc_id::varchar) as place from documents order by place limit 100")
def stable_sample_cap(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", X.stable_rank(F.col("doc_id")).alias("place")).orderBy("place").limit(100)


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id) = 1")
def latest_per_document(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return batches.latest_per(e, ["user_id"], F.desc("ts"), "event_id").select("user_id", "event_id", "event_type")


STATUS = "case event_type when 'view' then 'started' when 'click' then 'started' when 'purchase' then 'succeeded' when 'signup' then 'skipped_existing' else 'failed' end"


def _ledger(spark, sf_dir):
    """events as ledger rows of sources (users by hundreds) and batches (users)."""
    return t(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), (F.col("user_id") % 100).cast("string").alias("source_key"), F.col("user_id").alias("batch_id"),
        F.expr(STATUS).alias("status"), F.col("ts").alias("started_at"), F.col("ts").alias("finished_at"), F.from_json("props", "k bigint")["k"].alias("cap"),
    )


LEDGER_SQL = f"""l as (select event_id as run_id, (user_id % 100)::varchar as source_key, user_id as batch_id, {STATUS} as status, ts,
 try_cast(json_extract_string(props, '$.k') as bigint) as cap from events)"""


@query(
    f"""with {LEDGER_SQL}, s as (select distinct source_key, batch_id from l where status = 'succeeded')
    select source_key, batch_id, run_id from l where status = 'started' and not exists (select 1 from s where s.source_key = l.source_key and s.batch_id = l.batch_id)
    qualify row_number() over (partition by source_key order by ts desc, run_id) = 1"""
)
def open_batch(spark, sf_dir):
    return batches.open_batch(_ledger(spark, sf_dir), ["source_key"]).select("source_key", "batch_id", "run_id")


@query("select doc_id::varchar as document_id from labels where quality = 1 and toxic = 0 union select doc_id::varchar from labels where quality = 0 and toxic = 0")
def processed_union(spark, sf_dir):
    _, done, bad = _control(spark, sf_dir)
    return batches.processed(done, bad.withColumn("stage", F.lit("parse")))


@query("select doc_id::varchar as document_id from documents where doc_id not in (select doc_id from labels where quality = 1 and toxic = 0)")
def resume_todo(spark, sf_dir):
    """Batches pinned by source; what of them is still to be answered."""
    d, done, _ = _control(spark, sf_dir)
    block = F.pmod(F.xxhash64("document_id"), F.lit(1024))  # a pinned batch is a bounded list
    pinned = d.groupBy("source_key", block.alias("b")).agg(F.collect_list("document_id").alias("document_ids"))
    return batches.resume(pinned, done.select("document_id"))


@query(f"with {LEDGER_SQL} select source_key, max(cap)::bigint as cap from l where status in ('succeeded', 'skipped_existing') group by source_key")
def succeeded_caps(spark, sf_dir):
    return batches.succeeded_caps(_ledger(spark, sf_dir))


@query(f"with {LEDGER_SQL} select source_key, datesub('second', timestamp '1990-01-01', min(ts))::bigint as first_second from l where status = 'succeeded' group by source_key")
def succeeded_keys(spark, sf_dir):
    k = batches.succeeded_keys(_ledger(spark, sf_dir))
    return k.select("source_key", F.timestamp_diff("SECOND", F.lit("1990-01-01").cast("timestamp_ntz"), "first_at").alias("first_second"))


@query(
    f"""with {LEDGER_SQL}, c as (select source_key, max(cap) as cap from l where status in ('succeeded', 'skipped_existing') group by 1),
    k as (select distinct source_key from l where status = 'succeeded'), f as (select distinct (doc_id % 100)::varchar as source_key from labels where toxic = 1)
    select k.source_key from k left join c using (source_key) where c.cap is null or c.cap < 90 or k.source_key in (select source_key from f)"""
)
def pending_sources(spark, sf_dir):
    freed = t(spark, sf_dir, "labels").where("toxic = 1").select((F.col("doc_id") % 100).cast("string").alias("source_key"), F.lit("parse").alias("stage"), F.lit("x").alias("released_at"))
    ledger = _ledger(spark, sf_dir)
    return batches.pending_sources(ledger, ledger, freed, 90).select("source_key")


@query(
    """with q as (select doc_id, quality, toxic from labels where quality = 0 or toxic = 1)
    select doc_id::varchar as member_name, toxic = 1 or quality = 0 as released from q"""
)
def backfill_release(spark, sf_dir):
    """Releases every failure but low confidence by an append-only overlay."""
    _, _, bad = _control(spark, sf_dir)
    freed = batches.release(bad, "2025-03-01")
    after = staging.stg_quarantine(batches.overlay_releases(bad, freed))
    return after.select("member_name", "released")


# ---------------------------------------------------------------- checks


@query(
    """with p as (select l_orderkey % 50 as source_key, count(*) as parsed from lineitem group by 1), d as (select o_orderkey % 50 as source_key, count(*) as documents from orders group by 1),
    q as (select user_id % 60 as source_key, count(*) as n from events where event_type = 'error' group by 1)
    select source_key, coalesce(parsed, 0)::bigint as parsed, coalesce(documents, 0)::bigint as documents, coalesce(n, 0)::bigint as quarantined
    from p full join d using (source_key) full join q using (source_key) where coalesce(parsed, 0) <> coalesce(documents, 0) or coalesce(n, 0) <> 0"""
)
def reconcile_full_outer(spark, sf_dir):
    docs = t(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("source_key"))
    bad = t(spark, sf_dir, "events").where("event_type = 'error'").select((F.col("user_id") % 60).alias("source_key"), F.lit("parse").alias("stage"))
    runs = t(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 50).alias("source_key"), F.lit("succeeded").alias("status"), F.lit(False).alias("reparse"), F.col("l_shipdate").alias("started_at"),
        F.lit(1).cast("long").alias("parsed"), F.lit(0).cast("long").alias("quarantined"),
    )
    out = checks.documents_reconcile(docs, bad, runs)
    return out.select("source_key", "parsed", "documents", F.col("rows").alias("quarantined"))


@query(
    """with a as (select l_orderkey as batch_id, sum(l_extendedprice::decimal(38,2)) as c from lineitem group by 1), b as (select o_orderkey as batch_id, sum(o_totalprice::decimal(38,2)) as c from orders group by 1)
    select batch_id, coalesce(a.c, 0)::double as row_cost, coalesce(b.c, 0)::double as run_cost from a full join b using (batch_id)
    where abs(coalesce(a.c, 0) - coalesce(b.c, 0)) > 0.001"""
)
def cost_reconcile(spark, sf_dir):
    same = [F.lit("m").alias("model"), F.lit("p").alias("prompt_id")]
    rows = t(spark, sf_dir, "lineitem").select(*same, F.col("l_orderkey").alias("batch_id"), dec("l_extendedprice").alias("cost_usd"))
    runs = t(spark, sf_dir, "orders").select(*same, F.col("o_orderkey").alias("batch_id"), dec("o_totalprice").alias("cost_usd"), F.lit("succeeded").alias("status"))
    out = checks.cost_reconciles(rows, runs)
    return out.select("batch_id", F.col("row_cost").cast("double").alias("row_cost"), F.col("run_cost").cast("double").alias("run_cost"))


@query("select l_orderkey as document_id, count(*)::bigint as n from lineitem group by 1 having count(*) <> 4")
def values_complete_having(spark, sf_dir):
    v = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.lit("m").alias("model"), F.lit("p").alias("prompt_id"))
    return checks.values_complete(v, 4).select("document_id", "n")


@query(
    """with n as (select l_orderkey, count(*) as n from lineitem group by 1) select o_orderkey as document_id, (o_orderkey % 8)::bigint as fact_count, n::bigint as n
    from orders left join n on o_orderkey = l_orderkey where o_orderkey % 8 <> coalesce(n, 0)"""
)
def fact_counts_match(spark, sf_dir):
    docs = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), (F.col("o_orderkey") % 8).alias("fact_count"))
    return checks.fact_counts_match(docs, t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id")))


@query(
    """with r as (select user_id as batch_id, count(*) filter (where event_type in ('view', 'click')) as kept, count(*) filter (where event_type in ('error', 'click')) as failed from events group by 1),
    u as (select user_id as batch_id, count(*) * 2 as extracted, count(*) as quarantined from events where event_type = 'purchase' group by 1)
    select u.batch_id, extracted::bigint as extracted, quarantined::bigint as quarantined, coalesce(kept, 0)::bigint as rows_extracted, coalesce(failed, 0)::bigint as rows_quarantined
    from u left join r using (batch_id) where extracted <> coalesce(kept, 0) or quarantined <> coalesce(failed, 0)"""
)
def ledger_vs_rows(spark, sf_dir):
    """Clicks stand for answers of low confidence, which are kept and quarantined."""
    e = t(spark, sf_dir, "events").withColumn("batch_id", F.col("user_id"))
    kept, failed = e.where("event_type in ('view', 'click')"), e.where("event_type in ('error', 'click')").withColumn("stage", F.lit("extract"))
    runs = e.where("event_type = 'purchase'").withColumns({"status": F.lit("succeeded"), "extracted": F.lit(2).cast("long"), "quarantined": F.lit(1).cast("long")})
    return checks.extract_counts_match(kept, failed, runs).select("batch_id", "extracted", "quarantined", "rows_extracted", "rows_quarantined")


@query("select user_id as key, count(*)::bigint as n from events group by 1 having count(*) > 1")
def check_unique(spark, sf_dir):
    return checks.unique(t(spark, sf_dir, "events"), "user_id").select(F.col("user_id").alias("key"), "n")


@query("select event_id from events where try_cast(json_extract_string(props, '$.missing') as bigint) is null")
def check_not_null(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("missing", F.from_json("props", "missing bigint")["missing"])
    return checks.not_null(e, "missing").select("event_id")


@query("select o_orderstatus, count(*)::bigint as n from orders where o_orderstatus not in ('F', 'O') group by 1")
def check_accepted_values(spark, sf_dir):
    return checks.accepted_values(t(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def check_relationships(spark, sf_dir):
    return checks.relationships(t(spark, sf_dir, "customer"), "c_custkey", t(spark, sf_dir, "orders"), "o_custkey").select("c_custkey")


# ---------------------------------------------------------------- lookups, status, prices


@query(
    """select (select count(*) from documents)::bigint as documents, (select count(*) from lineitem)::bigint as facts, (select count(*) from orders)::bigint as extractions,
    (select count(distinct label) from embeddings)::bigint as indexed_docs, (select count(*) from embeddings)::bigint as chunks,
    (select count(*) from labels where quality = 0)::bigint as quarantined, (select round(sum(o_totalprice::decimal(38,2)), 2)::double from orders) as extract_spend_usd"""
)
def status_row(spark, sf_dir):
    from .tools import status

    ledger = _ledger(spark, sf_dir)
    orders = t(spark, sf_dir, "orders").withColumn("cost_usd", dec("o_totalprice"))
    s = status({
        "documents": t(spark, sf_dir, "documents"), "stg_facts": t(spark, sf_dir, "lineitem"), "extractions": orders,
        "chunks": t(spark, sf_dir, "embeddings").withColumnRenamed("label", "document_id"),
        "quarantine": t(spark, sf_dir, "labels").where("quality = 0").withColumn("released_at", F.lit(None).cast("timestamp")),
        "parse_runs": ledger, "extract_runs": ledger.withColumn("cost_usd", F.lit(0)).select("status", "finished_at", "cost_usd"), "index_runs": ledger.withColumn("cost_usd", F.lit(0)),
    })
    spend = orders.agg(F.round(F.sum("cost_usd"), 2).cast("double").alias("spend"))
    return s.crossJoin(spend).select("documents", "facts", "extractions", "indexed_docs", "chunks", "quarantined", F.col("spend").alias("extract_spend_usd"))


@query(
    f"""with {FACTS_SQL}, g as (select document_id, concept, taxonomy, context_id, min(day) as period_end, bool_or(is_numeric) as is_numeric, bool_and(in_hidden) as hidden
     from f group by all) select document_id, concept, context_id, strftime(period_end, '%Y-%m-%d') as period_end from g where is_numeric and not hidden and document_id = '1'
     order by concept nulls first, period_end nulls first limit 200"""
)
def facts_lookup_limit200(spark, sf_dir):
    from .tools import get_facts

    f = staging.stg_facts(staging.stg_fact_occurrences(_facts(spark, sf_dir)))
    return get_facts(f, "1").select("document_id", "concept", "context_id", F.date_format("period_end", "yyyy-MM-dd").alias("period_end"))


@query(f"with {SCORES_SQL} select concept, period, extracted::double as value, outcome from scores where model = 'm1' and prompt_id like 'v1%'")
def extraction_lookup_prefix(spark, sf_dir):
    from .tools import get_extraction

    s = _scores(spark, sf_dir).withColumn("field", F.col("concept"))
    v = s.select("document_id", "model", "prompt_id", "field", "concept", "period", F.col("extracted").alias("value"))
    j = get_extraction(v, s, None, "m1", "v1")  # no document named: the filters on model and prompt over all documents
    return j.select("concept", "period", F.col("value").cast("double").alias("value"), "outcome")


MODELS = ["gemini-3.1-flash-lite", "gemini-3.8-flash@t0", "unpriced"]


@query(
    """with e as (select event_id, user_id, case user_id % 3 when 0 then 'gemini-3.1-flash-lite' when 1 then 'gemini-3.8-flash@t0' else 'unpriced' end as model from events),
    p(base, pin, pout) as (values ('gemini-3.1-flash-lite', 0.25, 1.5), ('gemini-3.8-flash', 0.75, 3.75))
    select model, count(*)::bigint as n, round(sum((user_id * pin + (event_id % 100 + 5) * pout) / 1000000), 9) as cost_usd, round(avg(user_id), 6) as mean_in from e left join p on split_part(model, '@', 1) = base group by model"""
)
def cost_by_model(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    model = F.element_at(F.array(*[F.lit(m) for m in MODELS]), (F.col("user_id") % 3 + 1).cast("int"))
    e = e.withColumn("model", model).withColumn("cost", X.cost_usd(F.col("model"), F.col("user_id"), F.col("event_id") % 100, F.lit(5)))
    return e.groupBy("model").agg(F.count("*").alias("n"), F.round(F.sum("cost"), 9).alias("cost_usd"), F.round(F.avg("user_id"), 6).alias("mean_in"))


# ---------------------------------------------------------------- numbers and names

#: How a figure is written, by line number: well and badly formed.
WRITTEN = """case l_linenumber % 7 when 0 then '(' || q || ')' when 1 then '£' || substr(p, 1, 1) || ',' || substr(p, 2, 3) when 2 then ' -' || q when 3 then '(-' || q || ')'
 when 4 then q || 'k' when 5 then substr(p, 1, 1) || ' ' || substr(p, 2, 3) || '.50' else substr(p, 1, 1) || ',' || substr(p, 2, 2) end"""


def _written(spark, sf_dir):
    line = t(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(cast(l_quantity as int) as string) as q", "cast(1000 + l_partkey % 9000 as string) as p"
    )
    return line.select("l_orderkey", "l_linenumber", F.expr(WRITTEN).alias("raw"))


@query(
    f"""with w as (select l_orderkey, l_linenumber, l_quantity::int::varchar as q, (1000 + l_partkey % 9000)::varchar as p from lineitem), r as (select *, {WRITTEN} as raw from w),
    s as (select *, trim(raw) as s, case when trim(raw) like '(%)' then trim(trim(raw)[2:-2]) else trim(raw) end as i, trim(raw) like '(%)' as b from r),
    u as (select *, case when i like '-%' then i[2:] else i end as body, i like '-%' as d from s)
    select l_orderkey, l_linenumber::int as l_linenumber, raw, case when not (b and d) and not regexp_matches(body, '[-()]') and regexp_full_match(regexp_replace(body, '[£$€,\\s]', '', 'g'), '\\d+(\\.\\d+)?')
      and regexp_full_match(trim(ltrim(trim(s, '()'), '-')), '[£$€]?\\s?(\\d+|\\d{{1,3}}([,\\s]\\d{{3}})+)(\\.\\d+)?')
      then case when b or d then '-' else '' end || regexp_replace(body, '[£$€,\\s]', '', 'g') end as value from u""".replace("\\\\", "\\")
)
def normalise_number(spark, sf_dir):
    w = _written(spark, sf_dir)
    return w.select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "raw", X.normalise_number(F.col("raw"))["value"].alias("value"))


FORMAT = "case l_linenumber % 7 when 0 then 'ixt:numcommadot' when 1 then 'ixt2:numdotdecimal' when 2 then 'ixt:numcommadecimal' when 3 then 'ixt:numdash' when 4 then 'ixt:unheard-of' when 5 then 'ixt4:num-dot-decimal' end"
SHOWN = "case l_linenumber % 7 when 2 then '1.' || substr(p, 2, 3) || ',5' when 3 then '-' when 6 then '' else substr(p, 1, 1) || ',' || substr(p, 2, 3) || '.25' end"


@query(
    f"""with w as (select l_orderkey, l_linenumber, (1000 + l_partkey % 9000)::varchar as p, l_suppkey % 4 - 1 as scale, case when l_partkey % 3 = 0 then '-' end as sign from lineitem),
    r as (select *, {FORMAT} as fmt, {SHOWN} as text from w)
    select l_orderkey, l_linenumber::int as l_linenumber, fmt is not null and fmt = 'ixt:unheard-of' as failed,
    (case when fmt = 'ixt:unheard-of' or text = '' then null when fmt = 'ixt:numdash' then 0
      else (case when fmt = 'ixt:numcommadecimal' then replace(replace(text, '.', ''), ',', '.') else replace(text, ',', '') end)::decimal(28,9) * case scale when -1 then 0.1 when 0 then 1 when 1 then 10 else 100 end
      * case when sign = '-' then -1 else 1 end end)::double as value from r"""
)
def numeric_transform(spark, sf_dir):
    w = t(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "cast(l_linenumber as int) as l_linenumber", "cast(1000 + l_partkey % 9000 as string) as p", "l_suppkey % 4 - 1 as scale",
        "case when l_partkey % 3 = 0 then '-' end as sign",
    )
    w = w.select("*", F.expr(FORMAT).alias("fmt"), F.expr(SHOWN).alias("text"))
    w = X.once(w, "n", X.transform_numeric(F.col("text"), F.col("fmt"), F.col("scale"), F.col("sign")))
    return w.select("l_orderkey", "l_linenumber", F.col("n.error").isNotNull().alias("failed"), F.col("n.value").cast("double").alias("value"))


NAME = """case o_orderkey % 5 when 0 then 'x/Prod223_' || o_custkey || '_' || lpad(o_orderkey::varchar, 8, '0') || '_' || d || '.html' when 1 then 'Prod1_2_SC123456_' || d || '_CIC.zip'
 when 2 then 'Prod1_2_' || lpad(o_orderkey::varchar, 8, '0') || '_20251301.html' when 3 then 'notes/README.txt' else 'Prod1_2_1234_' || d || '.xml' end"""


def _members(spark, sf_dir):
    o = t(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "date_format(o_orderdate, 'yyyyMMdd') as d")
    return o.select("o_orderkey", F.expr(NAME.replace("::varchar", "")).alias("member_name"))


KEYS_SQL = f"""o as (select o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') as d from orders), n as (select o_orderkey, {NAME} as member_name, d from o),
k as (select o_orderkey, member_name, case o_orderkey % 5 when 0 then lpad(o_orderkey::varchar, 8, '0') when 1 then 'SC123456' end as company_number,
 case when o_orderkey % 5 < 2 then d end as day from n)"""


@query(f"with {KEYS_SQL} select o_orderkey, member_name, company_number, company_number || '_' || day as document_id, case when day is not null then o_orderkey % 5 = 1 end as is_archive from k")
def document_key(spark, sf_dir):
    m = _members(spark, sf_dir)
    k = X.document_key(F.col("member_name"))
    return m.select("o_orderkey", "member_name", k["company_number"].alias("company_number"), k["document_id"].alias("document_id"), k["is_archive"].alias("is_archive"))


@query(
    """select doc_id::varchar as document_id, 'kept' as side, null as reason from labels where quality = 1 union all
    select doc_id::varchar, 'quarantined', case when quality = 0 then 'SchemaValidation' else 'LowConfidence' end from labels where quality = 0 or toxic = 1"""
)
def quarantine_split(spark, sf_dir):
    """Answers of low confidence (toxic here) are kept and quarantined; failures (quality 0) are only quarantined."""
    lab = t(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("document_id"), "quality", "toxic")
    kept = lab.where("quality = 1").select("document_id", F.lit("kept").alias("side"), F.lit(None).cast("string").alias("reason"))
    bad = lab.where("quality = 0 or toxic = 1").select(
        "document_id", F.lit("quarantined"), F.when(F.col("quality") == 0, "SchemaValidation").otherwise("LowConfidence")
    )
    return kept.union(bad)


@query()
def xml_wellformed_quarantine(spark, sf_dir):
    """Every page through the strict parser: what is no well-formed XML has its reason."""
    p = t(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source_key"), F.col("html").cast("binary").alias("content"),
        F.concat(F.lit("Prod1_1_"), F.lpad(F.col("page_id").cast("string"), 8, "0"), F.lit("_20250101.html")).alias("member_name"),
    )
    r = parse.parse_members(p)
    return r.select("document_id", "reason", F.size("facts").alias("facts"))


@query()
def html_render_text(spark, sf_dir):
    """Pages as text by the same rules of blocks, rows and cells, read by the lenient HTML reader."""
    from ..functions.html import render_html

    text = F.pandas_udf(lambda s: s.map(render_html), "string")("html")
    return t(spark, sf_dir, "pages").select("page_id", text.alias("text")).select("page_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").alias("chars"))


# ---------------------------------------------------------------- retrieval


CHUNKS_SQL = """with recursive l as (select doc_id, line, row_number() over (partition by doc_id order by pos) as ln, length(line) + 1 as w from
      (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents) where trim(line, ' ' || chr(9)) <> ''),
    c as (select *, sum(w) over (partition by doc_id order by ln) as cum, count(*) over (partition by doc_id) as n from l),
    nx as (select a.doc_id, a.ln as s, a.n, max(b.ln) as e from c a join c b on a.doc_id = b.doc_id and b.ln >= a.ln and (b.ln = a.ln or b.cum - a.cum + a.w <= 1500) group by all),
    r as (select doc_id, s, e, n, 0 as i from nx where s = 1 union all
          select nx.doc_id, nx.s, nx.e, nx.n, r.i + 1 from r join nx on r.doc_id = nx.doc_id and nx.s = greatest(r.e - 3 + 1, r.s + 1) where r.e < r.n)"""


@query(
    f"""{CHUNKS_SQL}
    select r.doc_id, r.i::int as chunk_index, sum(length(c.line) + 1)::bigint - 1 as chars from r join c on r.doc_id = c.doc_id and c.ln between r.s and r.e group by r.doc_id, r.i"""
)
def chunk_documents(spark, sf_dir):
    c = retrieval.chunk_documents(t(spark, sf_dir, "documents"), "doc_id")
    return c.select("doc_id", "chunk_index", F.col("chars").cast("long").alias("chars"))


@query()
def fake_embed(spark, sf_dir):
    """Deterministic embeddings of all benchmark items and documents' chunks share one space; here the items'."""
    e = retrieval.embed(t(spark, sf_dir, "benchmark"))
    nonzero = F.aggregate("embedding", F.lit(0), lambda s, x: s + F.when(x != 0, 1).otherwise(0))
    return e.select("item_id", "tokens", nonzero.alias("buckets"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query(
    """with q as (select embedding::double[] as v from embeddings where vec_id = 0) select vec_id, label, round(1 - list_cosine_similarity(embedding::double[], v), 6) as distance
    from embeddings, q order by round(1 - list_cosine_similarity(embedding::double[], v), 9), vec_id limit 20"""
)
def knn_cosine(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings")
    one = e.where("vec_id = 0").agg(F.first("embedding").alias("query"))
    hits = retrieval.nearest(e.crossJoin(F.broadcast(one)), F.col("query"), 20, "vec_id")  # one query row
    return hits.select("vec_id", "label", F.round("distance", 6).alias("distance"))


ANSWER = r"'see [SC' || lpad((conv_id % 1000000)::varchar, 6, '0') || '_20251231#' || turn || '] and [NI715334_20260430#0], [SC' || lpad((conv_id % 1000000)::varchar, 6, '0') || '_20251231#' || turn || '] not [x#1]'"


@query(
    f"""with a as (select conv_id, turn, {ANSWER} as answer from conversations), c as (select conv_id, turn, list_distinct(regexp_extract_all(answer, '\\[([A-Z0-9]{{8}}_\\d{{8}}#\\d+)\\]', 1)) as c from a)
    select conv_id, turn, array_to_string(list_sort(list_filter(c, lambda x: x like 'SC%')), ',') as resolved, array_to_string(list_filter(c, lambda x: x not like 'SC%'), ',') as unsupported from c"""
)
def citations(spark, sf_dir):
    answer = F.expr(ANSWER.replace("::varchar", ""))
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", answer.alias("answer"))
    known = F.filter(retrieval.citations(F.col("answer")), lambda x: x.startswith("SC"))
    s = retrieval.cited(F.col("answer"), known)
    return c.select("conv_id", "turn", F.array_join(F.array_sort(s["resolved"]), ",").alias("resolved"), F.array_join(s["unsupported"], ",").alias("unsupported"))


@query(
    """with q as (select embedding::double[] as v from embeddings where vec_id = 0), h as (select vec_id, label, round(1 - list_cosine_similarity(embedding::double[], v), 9) as distance
      from embeddings, q order by distance, vec_id limit 6)
    select string_agg('[' || lpad(label::varchar, 8, '0') || '#' || vec_id || '] ' || label || ', period ending 2025-12-31' || chr(10) || d.source, chr(10) || chr(10) order by distance, vec_id) as passages
    from h join documents d on d.doc_id = h.vec_id % 100"""
)
def passages_render(spark, sf_dir):
    e, d = t(spark, sf_dir, "embeddings"), t(spark, sf_dir, "documents")
    one = e.where("vec_id = 0").agg(F.first("embedding").alias("query"))
    hits = retrieval.nearest(e.crossJoin(F.broadcast(one)), F.col("query"), 6, "vec_id")
    label = F.col("label").cast("string")
    p = retrieval.passage(F.lpad(label, 8, "0"), F.col("vec_id"), label, label, F.lit("2025-12-31"), F.col("source"))
    j = hits.join(d.select("doc_id", "source"), F.col("vec_id") % 100 == F.col("doc_id")).select("distance", "vec_id", p.alias("p"))
    return j.agg(F.sort_array(F.collect_list(F.struct("distance", "vec_id", "p"))).alias("h")).select(F.array_join(F.col("h.p"), "\n\n").alias("passages"))


# ---------------------------------------------------------------- events

EVENT = """case event_type when 'view' then to_json(struct(1 as version, 'ingested' as event, cast(user_id as string) as source_key, 'r' as run_id, '2025-01-01T00:00:00Z' as occurred_at))
 when 'click' then to_json(struct(1 as version, 'extracted' as event, 'b' as batch_id, 'm' as model, 'p' as prompt_id, 'r' as run_id, '2025-01-01T00:00:00Z' as occurred_at))
 when 'purchase' then to_json(struct(9 as version, 'ingested' as event, 's' as source_key, 'r' as run_id, '2025-01-01T00:00:00Z' as occurred_at))
 when 'signup' then to_json(struct(1 as version, 'parsed' as event, 'r' as run_id, '2025-01-01T00:00:00Z' as occurred_at)) else 'not json' end"""


@query(
    """select event_id, case event_type when 'view' then null when 'click' then null when 'purchase' then 'invalid event' when 'signup' then 'invalid event' else case when event_id % 2 = 0 then 'not base64' else 'not a closed object' end end as error,
    case when event_type = 'view' then 'parse' end as job from events"""
)
def events_valid_deadletter(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("body", F.expr(EVENT))
    broken = (F.col("body") == "not json") & (F.col("event_id") % 2 == 0)
    e = e.withColumn("data", F.when(broken, "%%%").otherwise(F.base64(F.col("body").cast("binary")))).select("event_id", "data")
    d = stream.decoded(e)
    return d.select("event_id", "error", stream.planned_job().alias("job"))


def streamed(spark, sf_dir):
    """events as a stream of files."""
    schema = t(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    return files.parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def drained(df: DataFrame, mode: str) -> DataFrame:
    """All results of a stream over what is there, written by the executors to a table in the folder they share."""
    spark = df.sparkSession
    path = shared_path(spark, "drained")
    spark.createDataFrame([], df.schema).write.parquet(path)  # what a stream without input leaves
    w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True)
    if mode == "append":
        w = w.format("parquet").option("path", path)
    else:  # each batch is the whole result
        w = w.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
    w.start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("select distinct event_id, event_type from events")
def event_dedupe(spark, sf_dir):
    """Each event delivered twice, taken once, in a stream."""
    e = streamed(spark, sf_dir).select("event_id", "event_type", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    return drained(stream.deduplicated(e, "event_id", "ts").select("event_id", "event_type"), "append")


WINDOW_SQL = """select strftime(time_bucket(interval '10 minutes', ts), '%Y-%m-%d %H:%M') as window_start, event_type, count(*)::bigint as n, round(sum(value), 4) as total, round(max(value), 4) as most
 from events group by 1, 2"""


def _shown(w: DataFrame) -> DataFrame:
    return w.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"), F.round("most", 4).alias("most"))


@query(WINDOW_SQL)
def window_metrics_10m(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _shown(stream.window_metrics(e, "ts", "event_type", "value"))


@query(WINDOW_SQL)
def stream_events_available_now(spark, sf_dir):
    """The same windows from a stream, in complete mode, so that the last window is closed as well."""
    return _shown(drained(stream.window_metrics(streamed(spark, sf_dir), "ts", "event_type", "value"), "complete"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)



from . import ledgers, searched, tagged  # noqa: E402, F401  (they register their queries)
