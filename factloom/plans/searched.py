"""Queries that embed and search whole tables, and that keep state over streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval
from ..streaming import delivery
from .catalogue import CHUNKS_SQL, drained, query, shared_path, streamed, t


@query(
    f"""{CHUNKS_SQL},
    x as (select r.doc_id, r.i, string_agg(c.line, chr(10) order by c.ln) as text from r join c on r.doc_id = c.doc_id and c.ln between r.s and r.e group by all),
    w as (select doc_id, i, unnest(regexp_split_to_array(lower(text), '\\s+')) as word from x),
    b as (select doc_id, i, ('0x' || right(sha256(word), 2))::int as bucket, count(*) as n from w where word <> '' group by all),
    e as (select doc_id, i, count(*) as buckets, sum(n) / sqrt(sum(n * n)) as total from b group by all)
    select x.doc_id, x.i::int as chunk_index, greatest(1, length(text) // 4)::bigint as tokens, coalesce(buckets, 0)::bigint as buckets, round(coalesce(total, 0), 6)::double as total
    from x left join e using (doc_id, i)"""
)
def embed_chunks(spark, sf_dir):
    """The chunks of all documents through the boundary to an embedding service, many texts a request."""
    chunks = retrieval.chunk_documents(t(spark, sf_dir, "documents"), "doc_id")
    e = retrieval.embed_with(chunks, retrieval.FakeEmbedder())
    full = F.size(F.filter("embedding", lambda x: x != 0)).cast("long")
    return e.select("doc_id", "chunk_index", "tokens", full.alias("buckets"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query(
    """with q as (select vec_id as question_id, embedding::double[] as v from embeddings where vec_id % 50 = 0),
    d as (select question_id, vec_id, label, round(1 - list_cosine_similarity(embedding::double[], v), 9) as distance from embeddings, q)
    select question_id, vec_id, label, round(distance, 6) as distance, row_number() over (partition by question_id order by distance, vec_id)::int as place from d
    qualify row_number() over (partition by question_id order by distance, vec_id) <= 20"""
)
def knn_all(spark, sf_dir):
    """The nearest rows of every fiftieth vector, among all."""
    e = t(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), "embedding")
    return retrieval.nearest_all(e, q, 20, "vec_id", keep=("label",)).select("question_id", "vec_id", "label", F.round("distance", 6).alias("distance"), "place")


@query(
    """select user_id::varchar as subscription, event_id::varchar as message_id, strftime(ts + interval 1 hour, '%Y-%m-%d %H:%M:%S') as alert_at
    from events where event_id % 13 = 0 or event_id % 9 in (7, 8)"""
)
def stuck_messages(spark, sf_dir):
    """Events as messages that are acknowledged after some tens of minutes, or never: those that were open for over an hour."""
    e = streamed(spark, sf_dir).select(F.col("user_id").cast("string").alias("subscription"), F.col("event_id").cast("string").alias("message_id"), "ts", (F.col("event_id") % 9).alias("tens"), "event_id")
    seen = F.when(F.col("event_id") % 13 != 0, F.struct(F.lit("acknowledged").alias("kind"), (F.col("ts") + F.make_dt_interval(mins=(F.col("tens") * 10).cast("int"))).alias("at")))
    # Each hour's clock is a message of its own subscription, so that the stream's time goes on after the last event.
    tick = F.struct(F.lit("clock").alias("kind"), (F.col("ts") + F.make_dt_interval(hours=F.lit(3))).alias("at"))
    rows = F.filter(F.array(F.struct(F.lit("published").alias("kind"), F.col("ts").alias("at")), seen, tick), lambda x: x.isNotNull())
    e = e.select("subscription", "message_id", F.explode(rows).alias("x")).select(
        F.when(F.col("x.kind") == "clock", "clock").otherwise(F.col("subscription")).alias("subscription"), F.col("x.kind").alias("kind"), "message_id", F.col("x.at").alias("at")
    )
    e = e.where("kind <> 'clock' or message_id % 1000 = 0")
    delivery.with_state_store(spark)
    return drained(delivery.stuck(e), "append").select("subscription", "message_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("alert_at"))


#: Seconds that a user's first job runs, by the user's id.
_RUNS = (3, 10, 30, 60, 100, 1000)


@query(
    f"""with u as (select user_id, min(ts) as t0, list_value{_RUNS}[user_id % 6 + 1] as runs from events group by user_id),
    o as (select *, unnest([5, 15, 35, 75, 155]) as off, unnest([1, 2, 3, 4, 5]) as delivery from u),
    b as (select user_id, t0, off, delivery, case when off > runs then 'start' when delivery = 5 then 'dead_letter' else 'retry' end as action from o
      qualify count(*) filter (where off > runs) over (partition by user_id order by delivery rows between unbounded preceding and 1 preceding) = 0)
    select user_id::varchar as job, 'first' as message_id, 'start' as action, 1 as delivery, strftime(t0, '%Y-%m-%d %H:%M:%S') as at from u
    union all select user_id::varchar, 'second', action, delivery, strftime(t0 + to_seconds(off), '%Y-%m-%d %H:%M:%S') from b"""
)
def deliveries(spark, sf_dir):
    """Two messages a user, five seconds apart: the second finds the first's job busy until that has run, or is dead after five deliveries."""
    u = t(spark, sf_dir, "events").groupBy("user_id").agg(F.min(F.col("ts").cast("timestamp")).alias("t0"))
    u = u.withColumn("runs", F.element_at(F.array(*[F.lit(x) for x in _RUNS]), (F.col("user_id") % 6 + 1).cast("int")))
    after = lambda s: F.col("t0") + F.make_dt_interval(secs=s.cast("decimal(18,6)"))
    row = lambda kind, message, at, job=None: F.struct(F.coalesce(F.lit(job), F.col("user_id").cast("string")).alias("job"), F.lit(kind).alias("kind"), F.lit(message).alias("message_id"), at.alias("at"))
    rows = F.array(row("message", "first", F.col("t0")), row("finished", "first", after(F.col("runs"))), row("message", "second", after(F.lit(5))), row("message", "tick", after(F.lit(9_000_000)), "clock"))
    e = u.select(F.explode(rows).alias("x")).select("x.*", F.lit("").alias("argument"), F.lit(None).cast("string").alias("error"))
    path = shared_path(spark, "deliveries")
    e.write.parquet(path)
    delivery.with_state_store(spark)
    done = drained(delivery.dispatched(spark.readStream.schema(e.schema).parquet(path)), "append")
    return done.where("job <> 'clock'").select("job", "message_id", "action", "delivery", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))
