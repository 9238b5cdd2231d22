"""Jobs that crash, resume, lose documents, free failures and start over; costs; failed deliveries."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from factloom.operators import batches
from factloom.plans import jobs, report
from factloom.sources import tables
from factloom.streaming import events
from test_parse import FACT, synthetic

PROMPT = {"id": "v1-abc", "version": "v1", "system": "", "user": "{text}"}


def archive(folder, name, members):
    with zipfile.ZipFile(folder / name, "w") as z:
        for i in members:
            z.writestr(f"Prod1_1_0000000{i}_20240331.html", synthetic(FACT) if i != 3 else b"<html")
    return name


@pytest.fixture
def place(tmp_path):
    (tmp_path / "raw").mkdir()
    archive(tmp_path / "raw", "a.zip", range(5))
    return tmp_path / "raw", f"file://{tmp_path}/lake"


def runs(spark, root, table):
    return [r.status for r in tables.read_table(spark, root, table).orderBy("finished_at").collect()]


def count(spark, root, table):
    return tables.read_table(spark, root, table).count()


def test_parse_resume_and_start_over(spark, place, monkeypatch):
    raw, root = place
    said = []
    load = tables.load_batch

    def crash(df, where, name, key, *more):
        if name == "documents":
            raise OSError("store is down")
        return load(df, where, name, key, *more)

    monkeypatch.setattr(jobs.tables, "load_batch", crash)
    assert jobs.parse_source(spark, root, str(raw), "a.zip", publish=said.append) == "failed" and not said
    failed = tables.read_table(spark, root, "parse_runs").where("status = 'failed'").first()
    assert "store is down" in failed.error and count(spark, root, "facts") > 0 and count(spark, root, "documents") == 0
    monkeypatch.setattr(jobs.tables, "load_batch", load)
    archive(raw, "a.zip", range(7))  # what comes later waits for the open batch
    assert jobs.parse_source(spark, root, str(raw), "a.zip", publish=said.append) == "succeeded"
    row = tables.read_table(spark, root, "parse_runs").where("status = 'succeeded'").first()
    assert (row.selected, row.parsed, row.quarantined, row.facts) == (5, 4, 1, 8) == (jobs.pinned(spark, root, "parse_runs", row.batch_id, "m").count(), count(spark, root, "documents"), count(spark, root, "quarantine"), count(spark, root, "facts"))
    assert row.batch_id == failed.batch_id and said[0]["batch_id"] == row.batch_id
    assert jobs.parse_source(spark, root, str(raw), "a.zip") == "succeeded" and count(spark, root, "documents") == 6
    assert jobs.parse_source(spark, root, str(raw), "a.zip") == "skipped_existing"
    assert jobs.parse_source(spark, root, str(raw), "none.zip") in ("failed", "skipped_existing")
    # A released failure is parsed again; a reparse replaces all that the source gave, under a batch of its own.
    freed = batches.release(tables.read_table(spark, root, "quarantine"), "2025-02-01")
    load(freed, root, "releases", "r1")
    assert jobs.released_sources(spark, root) == ["a.zip"]
    assert jobs.parse_source(spark, root, str(raw), "a.zip") == "succeeded" and count(spark, root, "quarantine") == 2
    assert jobs.purge_source(spark, f"{root}x", "a.zip") == {"facts": 0, "documents": 0, "quarantine": 0}
    old = {r.batch_id for r in tables.read_table(spark, root, "documents").collect()}
    assert jobs.parse_source(spark, root, str(raw), "a.zip", reparse=True) == "succeeded"
    new = {r.batch_id for r in tables.read_table(spark, root, "documents").collect()}
    assert not old & new and count(spark, root, "documents") == 6 and count(spark, root, "facts") == 12 and count(spark, root, "quarantine") == 1


class Model:
    name = "fake"
    down = True

    def answer(self, prompt):
        from factloom.operators.extract import FakeModel

        return FakeModel().answer(prompt)


def documents(spark, root, ids, key):
    rows = [{"document_id": i, "text": f"Total {i}\nCash 1" if i != "blank" else " "} for i in ids]
    from test_flow import frame

    tables.load_batch(frame(spark, "documents", rows), root, "documents", key, key)


def test_extract_and_index(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/lake"
    documents(spark, root, ["a", "b"], "s-1")
    documents(spark, root, ["gone"], "t-1")
    publish = jobs.publisher(root, "extracted")
    ask = jobs.extract.ask
    monkeypatch.setattr(jobs.extract, "ask", lambda *a, **k: 1 / 0)
    assert jobs.extract_documents(spark, root, Model(), PROMPT, 10, publish) == "failed"
    monkeypatch.setattr(jobs.extract, "ask", ask)
    assert tables.purge(spark, root, "documents", "t-1") == 1  # a pinned document vanishes
    documents(spark, root, ["c"], "u-1")
    assert jobs.extract_documents(spark, root, Model(), PROMPT, 10, publish) == "succeeded"
    row = tables.read_table(spark, root, "extract_runs").where("status = 'succeeded'").first()
    assert (row.selected, row.extracted, row.quarantined) == (3, 2, 1) and row.output_tokens > 0
    assert tables.read_table(spark, root, "quarantine").first().reason == "MissingDocument"
    event = json.loads(spark.read.text(f"{root}/_events/extracted-{row.run_id}/lifecycle").first()[0])
    assert spark.createDataFrame([(json.dumps(event),)], "b string").select(events.lifecycle_error(F.col("b"))).first()[0] is None
    assert jobs.extract_documents(spark, root, Model(), PROMPT, 10) == "succeeded" and count(spark, root, "extractions") == 3
    assert jobs.extract_documents(spark, root, Model(), PROMPT, 10) == "skipped_existing"
    unpriced = Model()
    unpriced.name = "unheard-of"
    assert jobs.extract_documents(spark, root, unpriced, PROMPT, 10) == "failed"
    assert not jobs.publisher("file:///proc/nowhere", "extracted")({"run_id": "r", "batch_id": "b"})

    documents(spark, root, ["blank"], "v-1")
    embed, parts = jobs.retrieval.embed, []

    def second_fails(df):
        parts.append(1)
        if len(parts) == 2:
            raise OSError("rate limit")
        return embed(df)

    assert jobs.index_documents(spark, root, 10, embed=second_fails, flush=1) == "failed"
    left = tables.read_table(spark, root, "index_runs").where("status = 'failed'").first()
    first = spark.createDataFrame([(i,) for i in "abc"], "document_id string").where(jobs._part_of(3) == 0).count()
    assert (left.indexed, left.selected) == (first, 3) and (left.tokens > 0) == (first > 0)  # what was paid for before the failure
    assert jobs.index_documents(spark, root, 10, flush=2) == "succeeded" and jobs.index_documents(spark, root, 10) == "skipped_existing"
    chunks = tables.read_table(spark, root, "chunks")
    assert {r.document_id for r in chunks.collect()} == {"a", "b", "c"} and chunks.select("document_id", "chunk_index").distinct().count() == chunks.count()


def test_loads_are_tried_again(spark, tmp_path, monkeypatch):
    """A write that fails leaves nothing behind that is read, and the load either is there or raises."""
    from test_flow import frame

    root, tries = f"file://{tmp_path}", []
    place = tables.new_place

    def flaky(r, n, file=""):
        tries.append(n)
        return "file:///proc/nowhere/x" if len(tries) < 3 else place(r, n, file)

    monkeypatch.setattr(tables, "new_place", flaky)
    df = frame(spark, "documents", [{"document_id": "a"}])
    assert tables.load_batch(df, root, "documents", "k") and len(tries) == 3
    assert tables.read_table(spark, root, "documents").count() == 1 and not tables.load_batch(df, root, "documents", "k")
    monkeypatch.setattr(tables, "new_place", lambda *a: "file:///proc/nowhere/x")
    with pytest.raises(tables.LoadFailedError):
        tables.load_batch(df, root, "documents", "other")
    assert tables.read_table(spark, root, "documents").count() == 1


def test_one_load_a_key_whoever_is_first(spark, tmp_path, monkeypatch):
    """Drivers that race for one key give one load; one that dies between its files and its manifest leaves nothing to be read."""
    from concurrent.futures import ThreadPoolExecutor

    from test_flow import frame

    root = f"file://{tmp_path}"
    one = lambda i: frame(spark, "documents", [{"document_id": f"d{i}"}])
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda i: tables.load_batch(one(i), root, "documents", "s/ö'1.x", "s"), range(4)))
    assert sum(won) == 1 and tables.read_table(spark, root, "documents").count() == 1
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda i: tables.create_if_absent(spark, f"{root}/race", str(i)), range(40))) == 1
    commit = tables.commit
    monkeypatch.setattr(tables, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.load_batch(one(9), root, "documents", "t", "t")
    monkeypatch.setattr(tables, "commit", commit)
    assert tables.read_table(spark, root, "documents").count() == 1 and tables.sweep(spark, root, "documents", 3600) == 0
    assert tables.sweep(spark, root, "documents", -10) == 1 and tables.read_table(spark, root, "documents").count() == 1
    # A manifest without content is a dead writer's: the next name is taken, and every name may be.
    for attempt in range(2):
        tables.create_if_absent(spark, tables._manifest_path(root, "documents", "u", attempt), "")
    assert tables.load_batch(one(3), root, "documents", "u", "u", wait=0.1) and not tables.load_batch(one(3), root, "documents", "u", "u", wait=0.1)
    assert tables.read_table(spark, root, "documents", "u").first().document_id == "d3"
    for attempt in range(tables.ATTEMPTS + 1):
        tables.create_if_absent(spark, tables._manifest_path(root, "documents", "v", attempt), "{")
    with pytest.raises(tables.LoadFailedError):
        tables.load_batch(one(4), root, "documents", "v", "v", wait=0.01)


def test_purge_takes_one_source_exactly(spark, tmp_path):
    from test_flow import frame

    root = f"file://{tmp_path}"
    for source in ("day", "day-", "day-extra", "o'day"):
        tables.load_batch(frame(spark, "documents", [{"document_id": source}] * 2), root, "documents", f"{source}-1", source)
    assert tables.counted(spark, root, "documents", "day-") == {"rows": 2.0} and tables.counted(spark, root, "documents", "none") == {}
    assert tables.purge(spark, root, "documents", "day-") == 1 == tables.purge(spark, root, "documents", "o'day")
    assert {r.document_id for r in tables.read_table(spark, root, "documents").collect()} == {"day", "day-extra"}
    assert tables.purge(spark, root, "facts", "day") == 0


def test_a_source_with_an_apostrophe(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    archive(tmp_path / "raw", "it's.zip", range(2))
    root = f"file://{tmp_path}/lake"
    assert jobs.parse_source(spark, root, str(tmp_path / "raw"), "it's.zip") == "succeeded"
    assert jobs.parse_source(spark, root, str(tmp_path / "raw"), "it's.zip") == "skipped_existing" and count(spark, root, "documents") == 2


class Dear(Model):
    """Keeps a file for every call; some calls may end the process that makes them."""

    def __init__(self, folder, deadly=()):
        self.folder, self.deadly = str(folder), deadly

    def answer(self, prompt):
        import os
        import uuid

        from factloom.operators.extract import FakeModel

        open(f"{self.folder}/{prompt.split()[1]}.{uuid.uuid4().hex}", "w").close()
        if prompt.split()[1] in self.deadly:
            os._exit(1)
        return FakeModel().answer(prompt)


def test_a_crash_pays_no_stored_call_again(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    (tmp_path / "calls").mkdir()
    ids = [f"d{i}" for i in range(12)]
    documents(spark, root, ids, "s")
    parts = {r.document_id: r.p for r in spark.createDataFrame([(i,) for i in ids], "document_id string").withColumn("p", jobs._part_of(4)).collect()}
    last = max(ids, key=lambda i: (parts[i], i))
    assert jobs.extract_documents(spark, root, Dear(tmp_path / "calls", {last}), PROMPT, 20, flush=3) == "failed"
    before = {f.name.split(".")[0] for f in (tmp_path / "calls").iterdir()}
    stored = {r.document_id for r in tables.read_table(spark, root, "answers").collect()}
    assert stored == {i for i in ids if parts[i] < parts[last]} and last in before and count(spark, root, "extractions") == 0
    for f in (tmp_path / "calls").iterdir():
        f.unlink()
    assert jobs.extract_documents(spark, root, Dear(tmp_path / "calls"), PROMPT, 20, flush=3) == "succeeded"
    assert sorted(f.name.split(".")[0] for f in (tmp_path / "calls").iterdir()) == sorted(set(ids) - stored)
    row = tables.read_table(spark, root, "extract_runs").where("status = 'succeeded'").first()
    assert (row.selected, row.extracted) == (12, 12) == (12, count(spark, root, "extractions"))


def test_calls_run_together_and_are_tried_again(spark):
    import time

    from factloom.operators import calls, extract

    docs = spark.createDataFrame([(f"d{i}", "s", "x") for i in range(24)], "document_id string, source_key string, text string").coalesce(1)

    def took(threads):
        began = time.time()
        said = extract.ask(docs, extract.FakeModel(seconds=0.1), PROMPT, threads).collect()
        assert [r.document_id for r in said] == [f"d{i}" for i in range(24)]  # in order
        return time.time() - began

    took(8)  # workers are up
    assert took(8) < took(1) / 2
    waits, tries = [], []

    def busy():
        tries.append(1)
        if len(tries) < 4:
            raise calls.ServiceError(429 if len(tries) < 3 else 503, "later")
        return "now"

    assert calls.with_patience(busy, 4, 2.0, waits.append) == "now" and waits == [2.0, 4.0, 8.0]
    tries.clear()
    with pytest.raises(calls.ServiceError):
        calls.with_patience(busy, 3, 0.0, waits.append)
    with pytest.raises(calls.ServiceError):
        calls.with_patience(lambda: (_ for _ in ()).throw(calls.ServiceError(400, "never")), 9, 1.0, lambda s: 1 / 0)


def test_failed_jobs_are_delivered_five_times(spark, tmp_path):
    import base64

    body = json.dumps({"version": 1, "event": "ingested", "source_key": "s", "run_id": "r", "occurred_at": "2025-01-01T00:00:00Z"})
    rows = [("1", base64.b64encode(body.encode()).decode(), 0), ("2", "%%%", 0)]
    spark.createDataFrame(rows, "message_id string, data string, attempts int").write.parquet(str(tmp_path / "in0"))
    for n in range(5):
        source = spark.readStream.schema("message_id string, data string, attempts int").parquet(str(tmp_path / (f"in{n}" if n == 0 else f"out{n - 1}/retries/batch=0")))
        events.run_consumer(source, str(tmp_path / f"out{n}"), str(tmp_path / f"cp{n}"), lambda *a: 1 / 0)
        dead = {(r.message_id, r.attempts) for r in spark.read.parquet(str(tmp_path / f"out{n}/dead_letters")).collect()}
        assert dead == ({("2", 1)} if n == 0 else set() if n < 4 else {("1", 5)})


def test_running_cost(spark):
    usage = spark.createDataFrame([("compute", 100, 40, 0.5), ("compute", 10, 40, 9.0), ("storage", 3, 0, 2.0)], "component string, units long, free long, price double")
    assert {r.component: r.usd for r in report.running_cost(usage).collect()} == {"compute": 30.0, "storage": 6.0, "Total": 36.0}


def test_point_lookups_read_few_rows(spark, tmp_path):
    """Of many loads with overlapping keys, a look-up of one document's facts reads the pages that hold it."""
    from factloom.plans import tools

    root = f"file://{tmp_path}"
    names = [f.name for f in tables.TABLES["facts"]]
    for i in range(4):
        f = spark.range(40_000).selectExpr(
            f"lpad(cast((id * 7919 % 10000) * 4 + {i} as string), 8, '0') as document_id", "concat('C', id div 10000) as concept", "'n' as namespace", "'c' as context_id", "true as is_numeric",
            "cast(id as decimal(38,9)) as value", "'t' as text", *[f"cast(null as {t.dataType.simpleString()}) as {t.name}" for t in tables.TABLES["facts"][7:12]], "false as in_hidden",
            "cast(null as date) as period_start", "cast(null as date) as period_end", "cast(null as date) as instant", "false as dimensional", "'b' as batch_id", "cast(null as string) as dimensions",
        )
        assert tables.load_batch(f.select(*names), root, "facts", f"s{i}", f"s{i}")
    found = tools.get_facts(tables.read_table(spark, root, "facts").withColumn("hidden_everywhere", F.lit(False)), "00020002")
    assert [r.concept for r in found.collect()] == ["C0", "C1", "C2", "C3"]
    scan = [n for n in _nodes(found._jdf.queryExecution().executedPlan()) if "Scan" in n.nodeName()]
    assert len(scan) == 1 and scan[0].metrics().apply("numOutputRows").value() <= 4000  # a page of each of four files, of 160,000 rows


def _nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    if plan.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage")):
        plan = plan.plan()
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))
