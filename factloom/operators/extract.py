"""Model answers: calls, validation against the closed schema, failures as quarantine rows, prices."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import cost_usd, written_number
from ..schemas import CONCEPTS, HEADERS, MIN_CONFIDENCE, PERIODS
from . import calls

THREADS = 4
CALL_ATTEMPTS = 4
FIRST_WAIT = 2.0


@dataclass(frozen=True)
class Reply:
    """What a model has said. `finish_reason` is why it stopped; None where it doesn't say."""

    text: str | None
    input_tokens: int
    output_tokens: int
    thinking_tokens: int = 0
    finish_reason: str | None = "STOP"


class Model(Protocol):
    """The boundary to a language model: text in, a Reply out. It raises calls.ServiceError where the service turns a call down."""

    name: str

    def answer(self, prompt: str) -> Reply: ...


class FakeModel:
    """A deterministic model: it reads nothing, says one figure for each concept, and counts four characters a token."""

    def __init__(self, name: str = "fake", confidence: float = 0.9, seconds: float = 0.0):
        self.name, self.confidence, self.seconds = name, confidence, seconds

    def answer(self, prompt: str) -> Reply:
        time.sleep(self.seconds)
        cell = lambda v: {"value": v, "confidence": self.confidence, "evidence": v or ""}
        body = {h: cell(None) for h in HEADERS} | {f: {"current": cell(str(len(f))), "prior": cell(None)} for f in CONCEPTS}
        text = json.dumps(body | {"overall_confidence": self.confidence})
        return Reply(text, len(prompt) // 4, len(text) // 4)


def load_prompt(text: str) -> dict[str, str]:
    """version, id (version and 12 digits of the file's hash), system and user part of a prompt file."""
    head = re.match(r"\A---\n(.*?)\n---\n", text, re.S)
    body = text[head.end() :] if head else text
    version = re.search(r"^version:\s*(\S+)", head[1], re.M)[1] if head else "v0"
    parts = re.split(r"^# (System|User)\s*$", body, flags=re.M)
    named = dict(zip(parts[1::2], (p.strip() for p in parts[2::2]), strict=False))
    if "{text}" not in named.get("User", ""):
        raise ValueError("the user part has no place for the text")
    digest = hashlib.sha256(text.encode()).hexdigest()[:12]
    return {"version": version, "id": f"{version}-{digest}", "system": named.get("System", ""), "user": named["User"]}


# ---------------------------------------------------------------- calls

SAID = "answer string, input_tokens long, output_tokens long, thinking_tokens long, latency_ms long, finish_reason string, failure string"
_SAID_ARROW = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.string()]


def called(model: Model, prompt: str, attempts: int = CALL_ATTEMPTS, first_wait: float = FIRST_WAIT) -> tuple:
    """One call as a row of SAID: the answer, or why there is none."""
    began = time.perf_counter()
    try:
        r = calls.with_patience(lambda: model.answer(prompt), attempts, first_wait)
    except (calls.ServiceError, OSError) as e:
        what = str(e) if isinstance(e, calls.ServiceError) else f"{type(e).__name__}: {e}"
        return None, 0, 0, 0, 0, None, f"ModelCallError: {what}"[:1000]
    except Exception as e:  # the provider's failures are rows, like every other failure
        return None, 0, 0, 0, 0, None, f"Unexpected:{type(e).__name__}: {e}"[:1000]
    failure = None
    if not (r.text or "").strip():
        failure = f"EmptyResponseError: finish_reason={r.finish_reason}"
    elif r.finish_reason not in (None, "STOP"):
        failure = f"TruncatedResponseError: finish_reason={r.finish_reason}"
    return r.text, r.input_tokens, r.output_tokens, r.thinking_tokens, int((time.perf_counter() - began) * 1000), r.finish_reason, failure


def ask(documents: DataFrame, model: Model, prompt: dict[str, str], threads: int = THREADS, attempts: int = CALL_ATTEMPTS, first_wait: float = FIRST_WAIT) -> DataFrame:
    """Calls the model once a document: document_id, source_key and SAID, in the documents' order.

    Each task has at most `threads` calls under way; a call that may pass later is tried again. Write the result before reading
    it twice: a model is paid for each call.
    """
    user = prompt["user"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        answers = calls.in_order(rows, lambda r: called(model, user.replace("{text}", r[2] or ""), attempts, first_wait), threads)
        for (document, source, _), said in answers:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((document, source, *said), (pa.string(), pa.string(), *_SAID_ARROW), strict=True)],
                names=["document_id", "source_key", *[x.split(" ")[0] for x in SAID.split(", ")]],
            )

    return documents.select("document_id", "source_key", "text").mapInArrow(run, f"document_id string, source_key string, {SAID}")


# ---------------------------------------------------------------- validation

_CELL_KEYS, _PAIR_KEYS = {"value", "confidence", "evidence"}, set(PERIODS)
_ANSWER_KEYS = {*HEADERS, *CONCEPTS, "overall_confidence"}


class _Misfit(Exception):
    """Where an answer doesn't fit the schema, and why."""


def _closed(x, keys: set[str], place: str) -> dict:
    if not isinstance(x, dict) or x.keys() != keys:
        raise _Misfit(f"{place}: not an object of {', '.join(sorted(keys))}")
    return x


def _sure(x, place: str) -> float:
    try:
        sure = float(x)
    except (TypeError, ValueError):
        sure = -1.0
    if not 0 <= sure <= 1:
        raise _Misfit(f"{place}: not in 0 to 1")
    return sure


def _cell(x, place: str, number: bool) -> dict:
    value = _closed(x, _CELL_KEYS, place)["value"]
    if not (value is None or isinstance(value, str)) or not isinstance(x["evidence"], str):
        raise _Misfit(f"{place}: value or evidence is no text")
    if number and value is not None:
        value = written_number(value)
        if value is None:
            raise _Misfit(f"{place}: not a number")
    return {"value": value, "confidence": _sure(x["confidence"], f"{place}.confidence"), "evidence": x["evidence"]}


def fitted(answer: str) -> dict:
    """An answer as the closed schema has it, with every number as plain digits; raises if it doesn't fit."""
    try:
        a = json.loads(answer)
    except (ValueError, RecursionError) as e:
        raise _Misfit(f"no JSON: {e}") from e
    _closed(a, _ANSWER_KEYS, "answer")
    out = {h: _cell(a[h], h, False) for h in HEADERS}
    for f in CONCEPTS:
        _closed(a[f], _PAIR_KEYS, f)
        out[f] = {p: _cell(a[f][p], f"{f}.{p}", True) for p in PERIODS}
    return out | {"overall_confidence": _sure(a["overall_confidence"], "overall_confidence")}


def verdict(answer: str | None, failure: str | None) -> tuple:
    """(extraction_json, overall_confidence, reason, error) of one call."""
    if failure is not None:
        return None, None, re.match(r"(?:Unexpected:)?[^:]*", failure)[0], failure
    if answer is None or not answer.strip():
        return None, None, "EmptyResponseError", None
    try:
        fit = fitted(answer)
    except _Misfit as e:
        return None, None, "SchemaValidationError", f"{e}\n---\n{answer[:500]}"
    return json.dumps(fit, ensure_ascii=False, separators=(",", ":")), fit["overall_confidence"], None, None


def judged(answers: DataFrame) -> DataFrame:
    """Adds extraction_json, confidence, reason and error: every answer is parsed and validated once, in one streamed pass that the
    optimizer can't copy into what reads its parts."""
    kinds = [("extraction_json", pa.string()), ("confidence", pa.float64()), ("reason", pa.string()), ("error", pa.string())]
    answer, failure = (answers.columns.index(c) for c in ("answer", "failure"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = zip(*map(verdict, b.column(answer).to_pylist(), b.column(failure).to_pylist()), strict=True)
                more = [pa.array(list(v), t) for v, (_, t) in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *[n for n, _ in kinds]])

    more = T.StructType.fromDDL("extraction_json string, confidence double, reason string, error string")
    return answers.mapInArrow(run, T.StructType([*answers.schema.fields, *more.fields]))


def split_answers(answers: DataFrame, model: str, prompt: dict[str, str], batch: str, at, least: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(extractions, quarantine). An answer of low confidence is kept and quarantined as well; failures only quarantined."""
    a = judged(answers)
    when = F.lit(at).cast("timestamp")
    price = cost_usd(F.lit(model), F.col("input_tokens"), F.col("output_tokens"), F.col("thinking_tokens"))
    low = F.col("reason").isNull() & (F.col("confidence") < least)
    kept = a.where("reason is null").select(
        "document_id", "source_key", F.lit(model).alias("model"), F.lit(prompt["id"]).alias("prompt_id"), F.lit(prompt["version"]).alias("prompt_version"),
        F.when(low, "low_confidence").otherwise("ok").alias("status"), F.col("confidence").alias("overall_confidence"),
        "extraction_json", "input_tokens", "output_tokens", "thinking_tokens",
        F.round(F.coalesce(price, F.lit(0.0)), 8).alias("cost_usd"), "latency_ms", "finish_reason", F.lit(batch).alias("batch_id"), when.alias("extracted_at"),
    )
    unsure = F.concat(F.lit("overall_confidence="), F.col("confidence").cast("string"), F.lit(f" < {least}"))
    bad = a.withColumn("why", F.when(low, "LowConfidence").otherwise(F.col("reason"))).where("why is not null").select(
        "document_id", "source_key", F.col("document_id").alias("member_name"), F.lit("extract").alias("stage"), F.col("why").alias("reason"),
        F.left(F.coalesce(F.when(low, unsure), "error", "why"), F.lit(1000)).alias("error"), F.lit(batch).alias("batch_id"), when.alias("quarantined_at"),
        F.lit(model).alias("model"), F.lit(prompt["id"]).alias("prompt_id"), F.lit(None).cast("timestamp").alias("released_at"),
    )
    return kept, bad
