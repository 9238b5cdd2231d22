"""Batch control, extraction, retrieval, events, checks, tools and report on hand-made rows."""

import base64
import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from factloom import schemas
from factloom.operators import batches, calls, checks, extract, parse, retrieval, staging
from factloom.plans import report, tools
from factloom.sources import tables
from factloom.streaming import events

AT = datetime(2025, 1, 2)


def frame(spark, name, rows):
    schema = schemas.TABLES[name]
    fill = {"string": "x", "bigint": 0, "double": 0.0, "boolean": False, "date": date(2025, 12, 31), "timestamp": AT}
    full = [tuple(r.get(f.name, None if f.nullable else fill[f.dataType.simpleString()]) for f in schema) for r in rows]
    return spark.createDataFrame(full, schema)


def test_loads_are_replay_safe(spark, tmp_path):
    root = f"file://{tmp_path}"
    docs = frame(spark, "documents", [{"document_id": "a"}, {"document_id": "b"}])
    assert tables.load_batch(docs, root, "documents", "s-1", "s") and not tables.load_batch(docs, root, "documents", "s-1", "s")
    assert tables.load_batch(docs, root, "documents", "t-1", "t")
    assert tables.read_table(spark, root, "documents").count() == 4
    assert tables.read_table(spark, root, "facts").count() == 0
    assert tables.purge(spark, root, "documents", "s") == 1 and tables.read_table(spark, root, "documents").count() == 2
    row = {"run_id": "r", "source_key": "s", "status": "started", "cap": 1, "selected": 1, "parsed": 0, "quarantined": 0, "facts": 0, "started_at": AT, "finished_at": AT, "members": ["m"]}
    assert tables.append_ledger(spark, root, "parse_runs", row, "r") and not tables.append_ledger(spark, root, "parse_runs", row, "r")
    assert tables.read_table(spark, root, "parse_runs").first().members == ["m"]


def test_pending_resume_and_release(spark):
    docs = frame(spark, "documents", [{"document_id": x, "parsed_at": AT} for x in "abcdef"] + [{"document_id": "a", "parsed_at": datetime(2025, 1, 3)}])
    done = frame(spark, "extractions", [{"document_id": "a", "model": "m", "prompt_id": "v1-1"}, {"document_id": "b", "model": "other", "prompt_id": "v1-1"}])
    bad = {"stage": "extract", "model": "m", "prompt_id": "v1-1", "quarantined_at": AT, "reason": "ModelCall"}
    q = frame(spark, "quarantine", [bad | {"document_id": "c", "member_name": "c"}, bad | {"document_id": "d", "member_name": "d", "reason": "LowConfidence"}])
    pending = lambda q, cap=10: [r.document_id for r in batches.pending_documents(docs, done, q, "m", "v1-1", cap).collect()]
    assert set(pending(q)) == {"b", "e", "f"}
    assert pending(q, 2) == pending(q)[:2]  # a larger cap only adds
    freed = batches.release(q, "2025-02-01", prompt="v1")
    assert [r.member_name for r in freed.collect()] == ["c"]
    after = batches.overlay_releases(q, freed.union(freed))
    assert after.where("released_at is not null").count() == 1 and pending(after)[0] == "c"
    later = q.withColumn("quarantined_at", F.lit(datetime(2025, 3, 1)))
    assert set(pending(batches.overlay_releases(q.union(later), freed))) == {"b", "e", "f"}  # quarantined again, blocked again
    assert batches.release(q, "2025-02-01", model="other").count() == 0
    pinned = spark.createDataFrame([(["a", "b", "zz"],)], "document_ids array<string>")
    todo = batches.resume(pinned, done.where("model = 'm'").select("document_id"))
    assert {r[0] for r in todo.collect()} == {"b", "zz"} and [r[0] for r in batches.missing(todo, docs).collect()] == ["zz"]


def test_open_batch_and_sources(spark):
    run = lambda i, s, b, status, cap=1: {"run_id": str(i), "source_key": s, "batch_id": b, "status": status, "cap": cap, "started_at": datetime(2025, 1, 1 + i)}
    runs = frame(spark, "parse_runs", [run(1, "s", "b1", "started"), run(2, "s", "b1", "succeeded", 5), run(3, "s", "b2", "started"), run(4, "s", "b3", "started"), run(5, "t", "b4", "started"), run(6, "t", "b4", "succeeded", 9)])
    assert [(r.source_key, r.batch_id) for r in batches.open_batch(runs, ["source_key"]).collect()] == [("s", "b3")]
    ingest = frame(spark, "ingest_runs", [{"source_key": k, "status": "succeeded"} for k in "stu"])
    none = frame(spark, "quarantine", [])
    assert [r.source_key for r in batches.pending_sources(ingest, runs, none, 6).collect()] == ["s", "u"]


def test_batch_ids(spark):
    from factloom.functions.exprs import batch_id

    one = lambda ids, *salt: spark.range(1).select(batch_id(F.array(*[F.lit(x) for x in ids]), *[F.lit(x) for x in salt])).first()[0]
    assert one("ab") == one("ba") != one("ab", "salt") and len(one("ab")) == 16


PROMPT = extract.load_prompt("---\nversion: v2\n---\n# System\nBe strict.\n# User\nRead: {text}\n")


class Flaky:
    name = "gemini-3.8-flash@t0"

    def answer(self, prompt):
        said = extract.FakeModel(confidence=0.2 if "low" in prompt else 0.9).answer(prompt)
        if "fail" in prompt:
            raise calls.ServiceError(400, "no model")
        if "odd" in prompt:
            raise KeyError("no key")
        body = json.loads(said.text)
        if "extra" in prompt:
            body["cash"]["current"]["guess"] = 1
        if "number" in prompt:
            body["cash"]["current"]["value"] = "12k"
        if "sure" in prompt:
            body["equity"]["prior"]["confidence"] = 2
        if "header" in prompt:
            del body["company_name"]["evidence"]
        text = "" if "empty" in prompt else json.dumps(body)[: 100 if "cut" in prompt else None] + (" x" if "trail" in prompt else "")
        return replace(said, text=text, finish_reason="MAX_TOKENS" if "cut" in prompt else "STOP")


def test_extraction(spark):
    assert PROMPT["id"].startswith("v2-") and PROMPT["system"] == "Be strict."
    with pytest.raises(ValueError):
        extract.load_prompt("# User\nnothing\n")
    words = ["ok", "low", "fail", "extra", "number", "sure", "empty", "odd", "header", "cut", "trail"]
    docs = spark.createDataFrame([(w, "s", w) for w in words], "document_id string, source_key string, text string")
    kept, bad = extract.split_answers(extract.ask(docs, Flaky(), PROMPT, first_wait=0.01).cache(), Flaky.name, PROMPT, "b", "2025-01-01")
    assert {r.document_id for r in kept.collect()} == {"ok", "low"}
    why = {r.document_id: r.reason for r in bad.collect()}
    schema = dict.fromkeys(("extra", "number", "sure", "header", "trail"), "SchemaValidationError")
    assert why == schema | {"low": "LowConfidence", "fail": "ModelCallError", "empty": "EmptyResponseError", "odd": "Unexpected:KeyError", "cut": "TruncatedResponseError"}
    errors = {r.document_id: r.error for r in bad.collect()}
    assert errors["number"].startswith("cash.current: not a number\n---\n{") and errors["sure"].startswith("equity.prior.confidence: ") and errors["low"] == "overall_confidence=0.2 < 0.5"
    assert {r.document_id: r.status for r in kept.collect()} == {"ok": "ok", "low": "low_confidence"}
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for df, node, most in ((kept, "MapInArrow", 2), (bad, "MapInArrow", 2), (staging.stg_extraction_values(kept), "from_json", 1), (staging.stg_extractions(kept), "from_json", 1)):
        assert 1 <= optimized(df).count(node) <= most  # the call and the verdict, or one parse
    assert kept.where("cost_usd > 0").count() == 2 and set(kept.columns) == {f.name for f in schemas.EXTRACTIONS}
    assert staging.stg_extraction_values(kept).where("value is not null").count() == 18


def test_chunks_and_citations(spark):
    cut = lambda text, most, overlap: spark.createDataFrame([(text,)], "t string").select(retrieval.line_chunks(F.col("t"), most, overlap)).first()[0]
    lines = [f"Row {i:02d}: {'x' * 20}" for i in range(40)]
    chunks = cut("\n\n".join(lines), 120, 2)
    assert all(len(c) < 120 for c in chunks) and set("\n".join(chunks).split("\n")) == set(lines)
    assert chunks[0].split("\n")[-2:] == chunks[1].split("\n")[:2]
    assert cut("", 10, 1) == [] and cut(None, 10, 1) == [] and cut("y" * 50, 10, 3) == ["y" * 50]
    # Every line counts with its break: three lines of three fill twelve; a long line among short ones pushes starts on.
    assert cut("aaa\nbbb\nccc\nddd", 12, 0) == ["aaa\nbbb\nccc", "ddd"] and cut("aaa\nbbb\nccc", 11, 0) == ["aaa\nbbb", "ccc"]
    assert cut("a\nb\nc\nzzzzzzz\nd", 9, 2) == ["a\nb\nc", "b\nc", "c", "zzzzzzz", "d"]
    docs = spark.createDataFrame([("a", "l1\nl2"), ("b", None)], "document_id string, text string")
    assert [r.chunk_index for r in retrieval.chunk_documents(docs).collect()] == [0]
    a = "[SC041563_20251231#0] [NI715334_20260430#1] [SC041563_20251231#0] [x#1]"
    c = spark.range(1).select(retrieval.cited(F.lit(a), F.array(F.lit("NI715334_20260430#1"))).alias("c")).first().c
    assert (c.resolved, c.unsupported) == (["NI715334_20260430#1"], ["SC041563_20251231#0"])


def test_tools(spark):
    texts = {"00000001_20251231": "The average number of employees was 12", "00000002_20251231": "Cash at bank and in hand", "00000003_20251231": "Creditors due within one year"}
    docs = frame(spark, "documents", [{"document_id": k, "company_number": k[:8], "text": v} for k, v in texts.items()])
    chunks = retrieval.embed(retrieval.chunk_documents(docs.select("document_id", "text"))).withColumn("embedding_model", F.lit("fake"))
    names = spark.createDataFrame([("00000001_20251231", "B"), ("00000001_20251231", "A")], "document_id string, company_name string")
    hits = tools.search(chunks, docs, names, "average number of employees", 2)
    rows = hits.collect()
    assert len(rows) == 2 and rows[0].key == "00000001_20251231#0" and rows[0].company_name == "A" and rows[0].distance < rows[1].distance

    class Citing:
        name = "gemini-3.1-flash-lite"

        def answer(self, prompt):
            return extract.Reply("It is 12 [00000001_20251231#0], not [00000009_20251231#3].", len(prompt), 10)

    a = tools.ask(hits, "how many?", Citing()).first()
    assert a.citations == ["00000001_20251231#0"] and a.unsupported_citations == ["00000009_20251231#3"] and a.cost_usd > 0


def test_registered_views(spark):
    made = {n: frame(spark, n, []) for n in schemas.TABLES}
    staging.register_views(made)
    assert spark.sql("select count(*) from stg_facts").first()[0] == 0


def lifecycle(**more):
    return json.dumps({"version": 1, "event": "ingested", "source_key": "s", "run_id": "r", "occurred_at": "2025-01-01T00:00:00Z"} | more)


def test_event_rules(spark):
    cases = [
        (lifecycle(), None), (lifecycle(event="parsed"), None), ("not json", "not a closed object"), (lifecycle(version=9), "invalid event"), (None, "no data"),
        (lifecycle(more=1), "not a closed object"), (lifecycle(source_key=None), "invalid event"), (lifecycle(event="extracted"), "invalid event"),
        (lifecycle(event="extracted", batch_id="b", model="m", prompt_id="p"), None), (lifecycle(event="deleted"), "invalid event"),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "body string")
    assert [r[0] for r in df.select(events.lifecycle_error(F.col("body"))).collect()] == [e for _, e in cases]


def test_consumer_and_dead_letters(spark, tmp_path):
    b64 = lambda x: base64.b64encode(x.encode()).decode()
    rows = [("1", b64(lifecycle())), ("2", "%%%"), ("3", b64("{}")), ("4", None), ("5", b64(lifecycle(event="parsed")))]
    spark.createDataFrame(rows, "message_id string, data string").write.parquet(str(tmp_path / "in"))
    started = []
    for _ in range(2):  # a second run finds nothing new
        source = events.read_events(spark, str(tmp_path / "in"), "message_id string, data string")
        events.run_consumer(source, str(tmp_path / "out"), str(tmp_path / "cp"), lambda *a: started.append(a))
    assert started == [("parse", "s")]
    letters = spark.read.parquet(str(tmp_path / "out/dead_letters"))
    assert {r.message_id for r in letters.collect()} == {"2", "3", "4"} and spark.read.parquet(str(tmp_path / "out/events")).count() == 2
    again = events.drain_dead_letters(letters, True)
    assert again.where("replayed = 1").count() == 3 and events.drain_dead_letters(letters, False).count() == 0


def test_document_event_sink(spark, tmp_path):
    body = json.dumps({"version": 1, "document_id": "d", "source_key": "s", "batch_id": "b", "fact_count": 1, "text_chars": 2, "parsed_at": "2025-01-01T00:00:00Z"})
    df = spark.createDataFrame([("m", AT, body)], "message_id string, publish_time timestamp, data string")
    df.write.parquet(str(tmp_path / "in"))
    events.sink_document_events(events.read_events(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert str(out.first().publish_day) == "2025-01-02" and out.select(events.document_event_error(F.col("data"))).first()[0] is None


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert checks.unique(df, "k").count() == 1 and checks.not_null(df, "k").count() == 1
    assert checks.accepted_values(df, "v", ["a", "b"]).count() == 1
    assert checks.relationships(df, "k", spark.createDataFrame([(2,)], "p int"), "p").count() == 2
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    rows = checks.table_checks(df, ("k", "v"), {"v": ["a", "b"]}, (("k",), ("k", "v")), {"k": (parent, "p"), "v": (df, "v")})
    assert [tuple(r) for r in rows.collect()] == [
        ("not_null", "k", 1), ("not_null", "v", 0), ("accepted_values", "v", 1), ("unique", "k", 1), ("unique", "k,v", 0), ("relationships", "k", 0), ("relationships", "v", 0)
    ]
    assert checks.table_checks(df, parents={"k": (spark.createDataFrame([(2,)], "p int"), "p")}).first().failures == 2
    ok = {"source_key": "s", "status": "succeeded", "started_at": datetime(2025, 1, 1), "parsed": 9, "quarantined": 9}
    redo = ok | {"started_at": datetime(2025, 2, 1), "reparse": True, "parsed": 1, "quarantined": 0}
    docs, none = frame(spark, "documents", [{"source_key": "s"}]), frame(spark, "quarantine", [])
    assert checks.documents_reconcile(docs, none, frame(spark, "parse_runs", [ok, redo])).count() == 0
    assert checks.documents_reconcile(docs, none, frame(spark, "parse_runs", [ok])).count() == 1


def test_report(spark):
    m = {"model": "m", "prompt_id": "v1-x", "recall": 0.5, "precision": None, "documents": 2, "verifiable": 4, "unsupported": 0, "tag_error": 1, "usd_per_1000": 1.5, "mean_latency_ms": 2500.0}
    m |= dict.fromkeys(report.ERROR_TYPES, 0)
    rows = [m | {"concept": "ALL"}, m | {"concept": "Equity"}, m | {"concept": "ALL", "model": "a", "recall": 0.9}]
    by = spark.createDataFrame([{"model": "m", "prompt_id": "v1-x", "size_band": "1: under 2k chars", "documents": 2, "recall": 0.25}])
    metrics = spark.createDataFrame(rows, "model string, prompt_id string, concept string, recall double, precision double, documents long, verifiable long, unsupported long, tag_error long, usd_per_1000 double, mean_latency_ms double, " + ", ".join(f"{e} long" for e in report.ERROR_TYPES))
    block = report.render(metrics, by, date(2025, 1, 1))
    lines = block.split("\n")
    assert "| m / v1 | 2 | 4 | 50.0% | n/a | 0 | 1 | 1.50 | 2.5 s |" in lines and block.index("| a / v1") < block.index("| m / v1")
    assert "| Equity | n/a | 50.0% (n=4) |" in lines and "| m / v1 | 25.0% (n=2) |" in lines
    text = report.splice(f"x\n{report.START}\nold\n{report.END}\ny", block)
    assert not report.is_stale(text, report.render(metrics, by, date(2026, 2, 2))) and report.is_stale(text, block.replace("50.0%", "51.0%"))
    with pytest.raises(ValueError):
        report.splice("no markers", block)


def test_html_text():
    from factloom.functions.html import render_html

    assert render_html("<title>t</title><p>a  b</p><table><tr><td>x</td><td> </td><th>y</th></tr></table><script>s</script>") == "a b\n\nx | y\n"
    assert render_html(None) is None and parse.CELL


@pytest.mark.parametrize("name", ["event_dedupe", "stream_events_available_now"])
def test_streams_end_in_files_and_not_in_the_driver(spark, tiny, name):
    from factloom.plans import catalogue

    out = catalogue.queries()[name](spark, tiny)
    assert len(out.inputFiles()) and all(f.endswith(".parquet") for f in out.inputFiles()) and out.count()


class PickyEmbedder(retrieval.FakeEmbedder):
    """Turns requests down that hold a certain text, is busy at first, or answers too little."""

    def __init__(self, folder, fault=""):
        super().__init__(dims=16)
        self.folder, self.fault = str(folder), fault

    def embed(self, texts, task):
        import os
        import uuid

        seen = len(os.listdir(self.folder))
        open(f"{self.folder}/{len(texts)}.{uuid.uuid4().hex}", "w").close()
        if self.fault == "busy" and seen == 0:
            raise calls.ServiceError(429, "later")
        if self.fault == "refuses" and any("bad" in t for t in texts) and (len(texts) > 1 or task == "always"):
            raise calls.ServiceError(400, "no")
        out = super().embed(texts, task)
        return out[:-1] if self.fault == "few" else [(v[:-1], n) for v, n in out] if self.fault == "short" else out


def test_embedding_requests(spark, tmp_path):
    texts = [f"text {i} of some words" for i in range(20)] + ["bad one", None, "long " * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, text string").coalesce(1)

    def made(fault, **more):
        folder = tmp_path / f"{fault}{len(more)}"
        folder.mkdir()
        got = retrieval.embed_with(df, PickyEmbedder(folder, fault), threads=2, first_wait=0.01, request_texts=8, request_tokens=40, **more).collect()
        return got, sorted(int(f.name.split(".")[0]) for f in folder.iterdir())

    got, sizes = made("")
    want = df.withColumn("e", retrieval.fake_embedding(F.coalesce("text", F.lit("")), 16)).orderBy("n").collect()
    assert [r.n for r in got] == list(range(23)) and [r.text for r in got] == texts  # in order
    assert all(r.embedding == pytest.approx(w.e) and r.tokens == max(1, len(w.text or "") // 4) for r, w in zip(got, want, strict=True))
    assert max(sizes) <= 8 and sum(sizes) == 23 and len(sizes) < 10
    assert made("busy")[0] == got and sum(made("refuses")[1]) > 23
    for fault, more in (("few", {}), ("short", {}), ("refuses", {"task": "always"})):
        with pytest.raises(Exception, match="expected|400"):
            made(fault, **more)


def test_many_questions_at_once(spark, monkeypatch):
    import numpy as np

    r = np.random.default_rng(2)
    v = r.normal(size=(300, 8)).round(1)
    rows = [(f"d{i % 40:02}", i // 40, v[i].tolist(), "x") for i in range(300)] + [("z", 0, None, "x"), ("z", 1, [0.0] * 8, "x"), ("z", 2, [1.0, 2.0], "x"), ("same", 0, v[0].tolist(), "x")]
    chunks = spark.createDataFrame(rows, "document_id string, chunk_index long, embedding array<double>, label string").repartition(4)
    asked = [(i, v[i].tolist()) for i in range(0, 300, 7)] + [(1000, [0.0] * 8), (1001, [1.0, 2.0]), (1002, None)]
    questions = spark.createDataFrame(asked, "question_id long, embedding array<double>")
    want = {}
    for q, x in asked:
        x = np.array([] if x is None else x)
        n = lambda a: np.linalg.norm(a) or 1.0
        near = sorted((round(1 - float(x @ np.array(e)) / (n(x) * n(np.array(e))), 9), d, c) for d, c, e, _ in rows if e is not None and len(e) == len(x))
        want |= {(q, p + 1): near[p] for p in range(min(5, len(near)))}
    for block in (2048, 10):
        monkeypatch.setattr(retrieval, "QUESTIONS", block)
        got = retrieval.nearest_all(chunks, questions, 5, "document_id", "chunk_index", keep=("label",))
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert {(g.question_id, g.place): (pytest.approx(g.distance, abs=2e-9), g.document_id, g.chunk_index) for g in got.collect()} == want
    assert retrieval.nearest_all(chunks, questions.where("false"), 5, "document_id").count() == 0
