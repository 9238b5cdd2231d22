"""Event streams: closed schemas, dead letters, the document-event sink, windows and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LIFECYCLE = "version int, event string, source_key string, run_id string, batch_id string, occurred_at string, model string, prompt_id string"
DOCUMENT = "version int, document_id string, source_key string, batch_id string, fact_count long, text_chars long, parsed_at string"


def _fields(schema: str) -> list[str]:
    return [x.split(" ")[0] for x in schema.split(", ")]


def _closed(raw: Column, schema: str) -> Column:
    """No key that the schema doesn't have."""
    keys = F.json_object_keys(raw)
    return keys.isNotNull() & (F.size(F.array_except(keys, F.array(*[F.lit(x) for x in _fields(schema)]))) == 0)


def lifecycle_error(raw: Column) -> Column:
    """Why a text is no lifecycle event; null if it is one."""
    e = F.from_json(raw, LIFECYCLE)
    needs = (
        F.when(e["event"].isin("ingested", "parsed"), e["source_key"].isNotNull())
        .when(e["event"] == "extracted", e["batch_id"].isNotNull() & e["model"].isNotNull() & e["prompt_id"].isNotNull())
        .otherwise(F.lit(False))
    )
    ok = e["version"].eqNullSafe(F.lit(1)) & e["run_id"].isNotNull() & e["occurred_at"].try_cast("timestamp").isNotNull() & F.coalesce(needs, F.lit(False))
    return F.when(raw.isNull(), "no data").when(~F.coalesce(_closed(raw, LIFECYCLE), F.lit(False)), "not a closed object").when(~ok, "invalid event")


def document_event_error(raw: Column) -> Column:
    e = F.from_json(raw, DOCUMENT)
    ok = e["version"].eqNullSafe(F.lit(1))
    for name in _fields(DOCUMENT)[1:]:
        ok = ok & e[name].isNotNull()
    return F.when(raw.isNull(), "no data").when(~F.coalesce(_closed(raw, DOCUMENT), F.lit(False)), "not a closed object").when(~ok, "invalid event")


def decoded(envelopes: DataFrame) -> DataFrame:
    """Push envelopes with base64 `data`: adds `body` and `error` (bad base64 or a bad event)."""
    body = F.try_to_binary(F.col("data"), F.lit("base64")).cast("string")
    out = envelopes.withColumn("body", body)
    return out.withColumn("error", F.when(F.col("data").isNotNull() & F.col("body").isNull(), "not base64").otherwise(lifecycle_error(F.col("body"))))


def planned_job(extract_on_event: bool = False) -> Column:
    """The job that a decoded event starts: parse after ingest, extract after parse if switched on; null for none."""
    event = F.when(F.col("error").isNull(), F.get_json_object("body", "$.event"))
    return F.when(event == "ingested", "parse").when(event.eqNullSafe("parsed") & F.lit(extract_on_event), "extract")


def plan(events: DataFrame, extract_on_event: bool = False, cap: int = 300) -> DataFrame:
    """The valid events with `job` and its `argument`: the source that was ingested, or the cap."""
    job = planned_job(extract_on_event)
    arg = F.when(job == "parse", F.get_json_object("body", "$.source_key")).when(job.isNotNull(), F.lit(str(cap)))
    return events.where("error is null").select("*", job.alias("job"), arg.alias("argument"))


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet event files as a stream."""
    return spark.readStream.schema(schema).parquet(path)


DELIVERIES = 5


def run_consumer(envelopes: DataFrame, out: str, checkpoint: str, start_job=None, extract_on_event: bool = False) -> None:
    """Consumes what is there: valid events to `<out>/events` and to start_job one after another, others to
    `<out>/dead_letters`. Each micro-batch overwrites its own folder, so that a replayed batch changes nothing.

    The envelopes of a job that fails go to `<out>/retries` with one more in `attempts` (none: 0), to be read again as a stream;
    after DELIVERIES deliveries they are dead letters.
    """

    def batch(df: DataFrame, number: int) -> None:
        known = df if "attempts" in df.columns else df.withColumn("attempts", F.lit(0))
        d = decoded(known.withColumn("attempts", F.col("attempts") + 1)).persist()
        d.where("error is null").write.mode("overwrite").parquet(f"{out}/events/batch={number}")
        failed = []
        if start_job is not None:
            for row in plan(d, extract_on_event).where("job is not null").select("job", "argument").distinct().toLocalIterator():
                try:
                    start_job(row["job"], row["argument"])
                except Exception as e:
                    failed.append((row["job"], row["argument"], f"{type(e).__name__}: {e}"[:1000]))
        lost = d.sparkSession.createDataFrame(failed, "job string, argument string, why string")  # of the batch's few jobs
        again = plan(d, extract_on_event).join(lost, ["job", "argument"]).drop("job", "argument", "error").withColumnRenamed("why", "error")
        over = F.col("attempts") >= DELIVERIES
        again.where(~over).drop("error", "body").write.mode("overwrite").parquet(f"{out}/retries/batch={number}")
        dead = d.where("error is not null").unionByName(again.where(over).select(*d.columns))
        dead.write.mode("overwrite").parquet(f"{out}/dead_letters/batch={number}")
        d.unpersist()

    envelopes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def sink_document_events(messages: DataFrame, out: str, checkpoint: str) -> None:
    """Messages with publish_time to a table partitioned by day."""
    q = messages.withColumn("publish_day", F.to_date("publish_time")).writeStream.format("parquet").partitionBy("publish_day")
    q.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deduplicated(messages: DataFrame, id_column: str, time_column: str, within: str = "1 hour") -> DataFrame:
    """Each message once, though it was delivered more than once within the given time."""
    return messages.withWatermark(time_column, within).dropDuplicatesWithinWatermark([id_column])


def window_metrics(events: DataFrame, time_column: str, by: str, value: str, width: str = "10 minutes") -> DataFrame:
    """Counts, sums and maxima in tumbling windows: what alerts look at."""
    return (
        events.groupBy(F.window(time_column, width), by)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("most"))
        .select(F.col("window.start").alias("window_start"), by, "n", "total", "most")
    )


def drain_dead_letters(letters: DataFrame, replay: bool) -> DataFrame:
    """What goes back to the source: letters marked as replayed; nothing if they are purged."""
    return letters.where(F.lit(replay)).drop("error", "body", "attempts").withColumn("replayed", F.lit(1))
