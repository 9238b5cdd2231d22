"""Chunks, embeddings, brute-force nearest neighbours, passages and citations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import sqrt
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import cosine_distance, fake_embedding, let
from ..schemas import CHUNK_CHARS, CHUNK_OVERLAP, EMBEDDING_DIMS
from . import calls


def line_chunks(text: Column, most: int, overlap: int) -> Column:
    """The chunks of a text: whole lines, with a line break each, of at most `most` characters (a longer line is a chunk of its
    own); a chunk repeats up to `overlap` lines of the one before it. Blank lines count for nothing.

    A fold over the lines, whose sums of lengths are known: when a line has no room left, the chunk ends before it, and so
    does every later start within the overlap from which there is no room either.
    """
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"(?U)\S"))

    def cut(x: Column) -> Column:
        sums = F.aggregate(x["lines"], F.array(F.lit(0).cast("long")), lambda s, y: F.concat(s, F.array(F.element_at(s, -1) + F.length(y) + 1)))
        return let(F.struct(x["lines"].alias("lines"), sums.alias("sums")), chunks)

    def chunks(x: Column) -> Column:
        sums, n = x["sums"], F.size(x["lines"])
        room = lambda start, i: F.get(sums, i + 1) - F.get(sums, start) <= most

        def fold(state: Column, i: Column) -> Column:
            start, done = state["start"], state["done"]
            low = F.greatest(i - overlap, start + 1)
            full = F.filter(F.when(low < i, F.sequence(low, i - 1)).otherwise(F.array().cast("array<int>")), lambda y: ~room(y, i))
            ended = F.concat(F.array(F.struct(start.alias("first"), i.alias("end"))), F.transform(full, lambda y: F.struct(y.alias("first"), i.alias("end"))))
            fits = room(start, i) | (i == start)
            return F.struct(F.when(fits, start).otherwise(low + F.size(full)).alias("start"), F.when(fits, done).otherwise(F.concat(done, ended)).alias("done"))

        none = F.array().cast("array<struct<first:int,end:int>>")
        state = F.aggregate(F.when(n > 0, F.sequence(F.lit(0), n - 1)), F.struct(F.lit(0).alias("start"), none.alias("done")), fold)
        spans = let(state, lambda z: F.concat(z["done"], F.array(F.struct(z["start"].alias("first"), n.alias("end")))))
        return F.transform(spans, lambda z: F.array_join(F.slice(x["lines"], z["first"] + 1, z["end"] - z["first"]), "\n"))

    return F.coalesce(let(F.struct(lines.alias("lines")), cut), F.array().cast("array<string>"))


def chunk_documents(documents: DataFrame, key: str = "document_id", most: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """key, chunk_index, text, chars."""
    chunks = documents.select(key, F.posexplode(line_chunks(F.col("text"), most, overlap)).alias("chunk_index", "text"))
    return chunks.withColumn("chars", F.length("text"))


def embed(chunks: DataFrame, dims: int = EMBEDDING_DIMS) -> DataFrame:
    """Chunks with tokens (four characters each, at least one) and the deterministic embedding."""
    return chunks.withColumn("tokens", F.greatest(F.lit(1), F.floor(F.length("text") / 4)).cast("long")).withColumn("embedding", fake_embedding(F.col("text"), dims))


def nearest(chunks: DataFrame, query: Column, k: int, *ties: str) -> DataFrame:
    """The k rows nearest to one query vector by cosine distance; equal distances go by the tie columns."""
    return chunks.withColumn("distance", F.round(cosine_distance(F.col("embedding"), query), 9)).orderBy("distance", *ties).limit(max(1, min(k, 20)))


QUESTIONS = 2048  # in a block


def nearest_all(chunks: DataFrame, questions: DataFrame, k: int, *ties: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """question_id, place (from 1), the tie columns, those to keep and distance: the k rows (1 to 20) of (embedding, ...) nearest to each
    question (question_id, embedding), all questions in one job; equal distances go by the tie columns. Rows without a vector of
    the questions' length are nobody's neighbours.

    Questions go in blocks of about QUESTIONS to the tasks that read the chunks; a batch of rows meets a block in one matrix
    product, and a task gives k rows a question, so that the chunks themselves are never shuffled and never joined.
    """
    k = max(1, min(k, 20))
    spark, names = chunks.sparkSession, [*ties, *(c for c in keep if c not in ties)]
    q = questions.select("question_id", F.col("embedding").cast("array<double>").alias("v")).where("v is not null and size(v) > 0")
    blocks = max(1, -(-q.count() // QUESTIONS))
    rows = chunks.select(*names, F.col("embedding").cast("array<double>").alias("v_")).where("v_ is not null and size(v_) > 0 and not exists(v_, x -> x is null)")
    schema = T.StructType([questions.schema["question_id"], *[chunks.schema[c] for c in names], T.StructField("distance", T.DoubleType())])
    found = None
    for b in range(blocks):
        block = q.where(F.pmod(F.xxhash64("question_id"), F.lit(blocks)) == b).orderBy("question_id").collect()  # about QUESTIONS rows
        for width in sorted({len(r["v"]) for r in block}):
            mine = [r for r in block if len(r["v"]) == width]
            best = rows.where(F.size("v_") == width).mapInPandas(_nearest_of_block([r["question_id"] for r in mine], np.array([r["v"] for r in mine]), k, list(ties), names), schema)
            found = best if found is None else found.union(best)
    if found is None:
        found = spark.createDataFrame([], schema)
    place = F.row_number().over(Window.partitionBy("question_id").orderBy("distance", *ties))
    return found.withColumn("place", place).where(F.col("place") <= k)


def _nearest_of_block(ids: list, vectors: np.ndarray, k: int, ties: list[str], names: list[str]):
    """The function of a task: its k rows nearest to each question of a block."""
    unit = vectors / _lengths(vectors)
    order = ["question_", "distance", *ties]

    def best(f: pd.DataFrame) -> pd.DataFrame:
        return f.sort_values(order, kind="stable").groupby("question_", sort=False).head(k)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for f in frames:
            if not len(f):
                continue
            v = np.stack(f["v_"].to_numpy())
            distance = np.round(1.0 - unit @ (v / _lengths(v)).T, 9)
            last = np.partition(distance, k - 1, axis=1)[:, k - 1 : k] if k < distance.shape[1] else np.full((len(unit), 1), np.inf)
            question, row = np.nonzero(distance <= last)  # the k nearest, with all that are as near as the last of them
            new = f[names].iloc[row].assign(question_=question, distance=distance[question, row])
            held = best(new if held is None else pd.concat([held, new]))
        if held is not None:
            yield held.assign(question_id=[ids[i] for i in held["question_"]])[["question_id", *names, "distance"]]

    return search


def _lengths(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.where(n == 0, 1.0, n)


# ---------------------------------------------------------------- embedding services

REQUEST_TEXTS = 64
REQUEST_TOKENS = 8000


class Embedder(Protocol):
    """The boundary to an embedding service: texts in, a (vector, tokens) for each out. It raises calls.ServiceError where the
    service turns a request down."""

    name: str
    dims: int

    def embed(self, texts: list[str], task: str) -> list[tuple[list[float], int]]: ...


class FakeEmbedder:
    """The deterministic embedding of `fake_embedding` behind the boundary."""

    def __init__(self, name: str = "fake", dims: int = EMBEDDING_DIMS):
        self.name, self.dims = name, dims

    def embed(self, texts: list[str], task: str) -> list[tuple[list[float], int]]:
        out = []
        for text in texts:
            counts = [0.0] * self.dims
            for word in text.lower().split():
                counts[int(hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()[-8:], 16) % self.dims] += 1
            norm = sqrt(sum(c * c for c in counts)) or 1.0
            out.append(([c / norm for c in counts], max(1, len(text) // 4)))
        return out


def _requests(rows: Iterator[tuple], text: int, most_texts: int, most_tokens: int) -> Iterator[list[tuple]]:
    """Runs of rows for one request each: as many as its limits allow, one at least (four characters are counted as a token)."""
    held, size = [], 0
    for r in rows:
        tokens = max(1, len(r[text] or "") // 4)
        if held and (len(held) >= most_texts or size + tokens > most_tokens):
            yield held
            held, size = [], 0
        held.append(r)
        size += tokens
    if held:
        yield held


def _embedded(embedder: Embedder, texts: list[str], task: str, attempts: int, first_wait: float) -> list[tuple[list[float], int]]:
    """One request: as many vectors as texts, each as long as it should be. A request of several that is turned down for good is made
    again text by text, so that one text does not keep the others from their vectors; what a single text meets is raised."""
    try:
        got = calls.with_patience(lambda: embedder.embed(texts, task), attempts, first_wait)
    except calls.ServiceError:
        if len(texts) == 1:
            raise
        return [one for t in texts for one in _embedded(embedder, [t], task, attempts, first_wait)]
    if len(got) != len(texts):
        raise ValueError(f"expected {len(texts)} embeddings, got {len(got)}")
    for vector, _ in got:
        if len(vector) != embedder.dims:
            raise ValueError(f"expected {embedder.dims} dimensions, got {len(vector)}")
    return got


def embed_with(
    chunks: DataFrame, embedder: Embedder, task: str = "RETRIEVAL_DOCUMENT", threads: int = 4, attempts: int = 6, first_wait: float = 1.0,
    request_texts: int = REQUEST_TEXTS, request_tokens: int = REQUEST_TOKENS,
) -> DataFrame:
    """Chunks (text, ...) with tokens and embedding: texts go in requests of several, a few requests at a time in each task, in order."""
    text = chunks.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None

        def rows():
            nonlocal kinds
            for b in batches:
                kinds = b.schema
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        requests = _requests(rows(), text, request_texts, request_tokens)
        for held, got in calls.in_order(requests, lambda rs: _embedded(embedder, [r[text] or "" for r in rs], task, attempts, first_wait), threads):
            columns = [pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), kinds, strict=True)]
            vectors, tokens = zip(*got, strict=True)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))], names=[*kinds.names, "tokens", "embedding"])

    schema = T.StructType([*chunks.schema.fields, T.StructField("tokens", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    return chunks.mapInArrow(run, schema)


def with_documents(hits: DataFrame, documents: DataFrame, names: DataFrame) -> DataFrame:
    """Hits with their document's dates (documents must exist) and a company name if there is one."""
    name = names.groupBy("document_id").agg(F.min("company_name").alias("company_name"))
    d = documents.select("document_id", "company_number", "period_end")
    return hits.join(d, "document_id").join(name, "document_id", "left").withColumn("key", F.concat_ws("#", "document_id", "chunk_index"))


def passage(document: Column, index: Column, name: Column, number: Column, period_end: Column, text: Column) -> Column:
    return F.concat(
        F.lit("["), document, F.lit("#"), index.cast("string"), F.lit("] "), F.coalesce(name, number), F.lit(", period ending "),
        period_end.cast("string"), F.lit("\n"), text,
    )


CITATION = r"\[([A-Z0-9]{8}_\d{8}#\d+)\]"


def citations(answer: Column, pattern: str = CITATION) -> Column:
    """Distinct citations of an answer, in the order of their first mention."""
    return F.array_distinct(F.regexp_extract_all(answer, F.lit(pattern), 1))


def cited(answer: Column, known: Column, pattern: str = CITATION) -> Column:
    """struct(resolved, unsupported): citations of passages that were given, and of ones that were not."""
    c = citations(answer, pattern)
    return F.struct(
        F.filter(c, lambda x: F.array_contains(known, x)).alias("resolved"), F.filter(c, lambda x: ~F.array_contains(known, x)).alias("unsupported")
    )
