"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash turns a unit vector by three rounds of random signs and a fast Hadamard transform and takes the nearest
signed axis; two such turns (more in bands of millions) are strung together to one bucket, so that buckets do not grow with
the table. The index is cut into norm bands, each with tables and a scale of its own: its vectors are scaled by the
band's largest norm and get one more coordinate, a short one, that makes them unit vectors, so that the order of angles
is the order of inner products. A query probes the nearest buckets (`probes_for`), by the sum of its coordinates along their axes,
in each of TABLES tables of every band; what it meets there is ranked exactly, by the inner product of the original vectors
in double precision, summed in one order whatever the batch. Bands of every size are hashed alike (`small_band`, off by default,
scans smaller ones whole). Queries that meet fewer rows than there are to give are answered by an exact scan of the index, which
SCAN_QUERIES or so of them share.

How it is spread out: a table's axes fall into groups of axes, and each group into SALTS parts by id, so that a crowded
axis is many cells. Each cell is streamed (queries first, then candidates, in Arrow batches), keeps K best a query, and
only these are shuffled. Equal vectors are one index row that holds their K + 1 smallest ids, which is exact: ties go to
smaller ids, so no other id of an equal vector can be in any answer; they are found behind a rank limit that Spark
applies before the shuffle.

Defined results
* vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id, nor vectors of
  another length than most have, with which there is no inner product; an empty table gives an empty result; other columns
  of the input are ignored.
* rows that repeat an id with the same vector count once; a query's own id is never its neighbour.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

TABLES = 20
PROBES = 300
SPARSE = 3500  # rows of a band at which twice as many buckets are probed
SALTS = 2
GROUP_ROWS = 20_000
CROWDED = 64  # rows a bucket from which one more turn is strung on
NEAREST_AXES = 48  # of each turn that probes are made of
PAIRS = 60_000  # scored at a time
BAND = 1.2  # the longest of a band's vectors by its shortest
SMALL_BAND = 0
SCAN_QUERIES = 2000
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    for s in signs:
        x = hadamard(x * s)
    return x


def table_signs(t: int, dims: int, turn: int = 0) -> np.ndarray:
    return np.random.default_rng([SEED, t, turn]).choice([-1.0, 1.0], size=(3, dims))


def turns_for(rows: int, dims: int) -> int:
    """How many turns make a bucket of a band of so many rows; two at least."""
    turns = 2
    while rows > CROWDED * (2 * dims) ** turns:
        turns += 1
    return turns


def probes_for(rows: int, probes: int = PROBES) -> int:
    """How many buckets a query probes in a table of a band of so many rows. The k nearest of few rows are a larger share of them and
    lie farther off, so that more buckets may hold them; the number falls towards `probes` as the band grows."""
    return int(probes * (1 + (SPARSE / rows) ** 0.5))


def buckets_of(turned: list[np.ndarray], dims: int) -> np.ndarray:
    """The bucket of each row: its nearest signed axes, as digits of one number."""
    out = np.zeros(len(turned[0]), np.int64)
    for r in turned:
        out = out * (2 * dims) + axes(r, 1)[:, 0]
    return out


def nearest_buckets(turned: list[np.ndarray], dims: int, count: int) -> np.ndarray:
    """The count buckets of each row (fewer if there are fewer) whose axes have the largest sum of the row's coordinates."""
    out, total = None, None
    for r in turned:
        near = axes(r, min(NEAREST_AXES, dims))
        value = np.abs(np.take_along_axis(r, near // 2, 1))
        if out is None:
            out, total = near, value
        else:
            out = (out[:, :, None] * (2 * dims) + near[:, None, :]).reshape(len(r), -1)
            total = (total[:, :, None] + value[:, None, :]).reshape(len(r), -1)
        if out.shape[1] > count:
            top = np.argpartition(-total, count - 1, axis=1)[:, :count]
            out, total = np.take_along_axis(out, top, 1), np.take_along_axis(total, top, 1)
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, whose sums do not depend on what else is in the batch."""
    return np.add.reduce(a * b, axis=1)


def axes(r: np.ndarray, count: int) -> np.ndarray:
    """The count nearest signed axes of each row, nearest first: axis i is 2i, its negative 2i + 1."""
    top = np.argpartition(-np.abs(r), min(count, r.shape[1] - 1), axis=1)[:, :count]
    order = np.argsort(-np.abs(np.take_along_axis(r, top, 1)), axis=1, kind="stable")
    top = np.take_along_axis(top, order, 1)
    return 2 * top + (np.take_along_axis(r, top, 1) < 0)


def lifted(v: np.ndarray, longest, dims: int, query: bool) -> np.ndarray:
    """Unit vectors of `dims` coordinates whose angles order as the inner products of the originals that share a scale
    (`longest`, one for all or one a row)."""
    out = np.zeros((len(v), dims))
    if query:
        out[:, : v.shape[1]] = v / np.linalg.norm(v, axis=1, keepdims=True)
    else:
        out[:, : v.shape[1]] = v / np.reshape(longest, (-1, 1))
        out[:, v.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (out[:, : v.shape[1]] ** 2).sum(1)))
    return out


def _valid(vectors: DataFrame) -> DataFrame:
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and v is not null and size(v) > 0")
    v = v.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    return v


def _log_norm(v):
    """The logarithm of the norm; squares of parts of the largest coordinate neither overflow nor vanish."""
    most = F.array_max(F.transform(v, F.abs))
    return F.log(most) + F.log(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / most) * (x / most))) / 2


def _best(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a, rows of b and products of the k best of each row of a, with all that come close to the last of them."""
    score = a @ b.T
    if k >= score.shape[1]:
        row, col = np.nonzero(np.ones_like(score, bool))
    else:
        slack = 1e-12 * np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1).max()
        row, col = np.nonzero(score >= -np.partition(-score, k - 1, axis=1)[:, k - 1 : k] - slack[:, None])
    return row, col, np.concatenate([_products(a[row[x : x + PAIRS]], b[col[x : x + PAIRS]]) for x in range(0, len(row), PAIRS)] or [np.zeros(0)])


def _topk(ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, first: np.ndarray, k: int):
    """Of (query row, score, index row) triples the k best of each query: by score, then by smallest id."""
    order = np.lexsort((first, -scores, rows))
    rows, scores, ids = rows[order], scores[order], ids[order]
    begin = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - begin < k
    return ids[keep], rows[keep], scores[keep], first[order][keep]


def _group(bucket: np.ndarray, groups: int) -> np.ndarray:
    return ((bucket.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % groups


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, tables: int = TABLES, probes: int = PROBES, salts: int = SALTS, small_band: int = SMALL_BAND
) -> DataFrame:
    """query_id, rank, vec_id, score for every id divisible by `every`, against all rows."""
    valid = _valid(vectors)
    sizes = valid.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if most is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width = most["d"]
    dims = 1 << int(width).bit_length()
    # One row for each different vector, with its k + 1 smallest ids.
    keyed = valid.where(F.size("v") == width).select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = keyed.dropDuplicates(["h1", "h2", "vec_id"]).withColumn("place", place).where(F.col("place") <= k + 1)
    index = few.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = keyed.where(F.col("vec_id") % every == 0).select("vec_id", "h1", "h2").distinct()
    index = index.join(asked.select("h1", "h2").distinct().withColumn("asks", F.lit(True)), ["h1", "h2"], "left")
    # Half a band on, so that unit vectors, whose norms are 1 but for rounding, are all in one.
    index = index.select("h1", "h2", "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"), _log_norm(F.col("v")).alias("log_norm"))
    index = written(index.withColumn("band", F.floor(F.col("log_norm") / F.lit(float(np.log(BAND))) + 0.5)), "ann-index")
    found = index.groupBy("band").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids"), F.max("log_norm").alias("longest")).orderBy("band").collect()
    # Of each band its scale, tables, groups of axes and first cell; a small one is a table with one cell that all meet.
    plan, cells = {}, 0
    for b in found:
        few_rows = b["n"] <= small_band
        t_, g_ = (1, 1) if few_rows else (tables, int(np.clip(b["n"] // GROUP_ROWS, 2, 2 * dims)))
        plan[b["band"]] = (float(np.exp(b["longest"])) * (1 + 1e-12), t_, g_, cells, 0 if few_rows else turns_for(b["n"], dims), probes_for(b["n"], probes))
        cells += t_ * g_ * salts
    turns = max((p[4] for p in plan.values()), default=0)
    need = min(k, sum(b["ids"] for b in found) - 1)

    def place_rows(frames):
        signs = [[table_signs(t, dims, i) for i in range(turns)] for t in range(tables)]
        for f in frames:
            if not len(f):
                continue
            v = np.stack(f["v"].to_numpy())
            ids = f["ids"].to_numpy()
            first = np.array([i[0] for i in ids], np.int64)
            asks = np.flatnonzero(f["asks"].to_numpy())
            band = f["band"].to_numpy()
            mine = lifted(v, np.array([plan[b][0] for b in band.tolist()]), dims, False)
            query = lifted(v[asks], None, dims, True)
            own = {b: np.flatnonzero(band == b) for b in np.unique(band).tolist()}
            for t in range(tables):
                for b, (_, b_tables, groups, start, strung, b_probes) in plan.items():
                    if t >= b_tables:
                        continue
                    if b in own:
                        at = own[b]
                        bucket = buckets_of([rotated(mine[at], x) for x in signs[t][:strung]], dims) if strung else np.zeros(len(at), np.int64)
                        cell = start + (t * groups + _group(bucket, groups)) * salts + first[at] % salts
                        yield pd.DataFrame({
                            "cell": cell, "kind": 1, "first": first[at], "v": f["v"].to_numpy()[at], "ids": ids[at], "buckets": [[x] for x in bucket.tolist()],
                        })
                    for lo in range(0, len(asks), 256):  # some queries at a time
                        some = asks[lo : lo + 256]
                        near = nearest_buckets([rotated(query[lo : lo + 256], x) for x in signs[t][:strung]], dims, b_probes) if strung else np.zeros((len(some), 1), np.int64)
                        group = _group(near, groups)
                        for g in range(groups):
                            probed = [row[of == g].tolist() for row, of in zip(near, group, strict=True)]
                            has = np.array([len(o) > 0 for o in probed])
                            for s in range(salts if has.any() else 0):
                                yield pd.DataFrame({
                                    "cell": start + (t * groups + g) * salts + s, "kind": 0, "first": first[some][has], "v": f["v"].to_numpy()[some][has],
                                    "ids": [[]] * int(has.sum()), "buckets": [o for o in probed if o],
                                })

    placed = index.select("v", "ids", "asks", "band").mapInPandas(
        place_rows, "cell long, kind int, first long, v array<double>, ids array<long>, buckets array<long>"
    )
    n = min(cells, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartition(n, "cell").sortWithinPartitions("cell", "kind")

    whole = {p[3] + s for p in plan.values() if not p[4] for s in range(salts)}

    def scan(frames):
        """Best k + 1 index rows of each query in each cell; a query's row is known by its smallest id."""
        best: dict[int, tuple] = {}
        cell, queries = None, []

        def ask(f):
            v = np.stack(queries_v)
            ids, first = f["ids"].to_numpy(), f["first"].to_numpy()
            c = np.stack(f["v"].to_numpy())
            if cell in whole:
                parts = [(lo, _best(v[lo : lo + 1000], c, k + 1)) for lo in range(0, len(v), 1000)]
                q, i, s = (np.concatenate(x) for x in zip(*[(lo + row, col, score) for lo, (row, col, score) in parts], strict=True))
            else:
                bucket = np.array([b[0] for b in f["buckets"]], np.int64)
                lo, hi = np.searchsorted(probed, bucket), np.searchsorted(probed, bucket, "right")
                met = hi - lo
                i = np.repeat(np.arange(len(bucket)), met)
                q = probes_row[np.repeat(lo - (np.cumsum(met) - met), met) + np.arange(int(met.sum()))]
                s = np.concatenate([_products(v[q[x : x + PAIRS]], c[i[x : x + PAIRS]]) for x in range(0, len(i), PAIRS)] or [np.zeros(0)])
            if not len(q):
                return
            i, q, s, _ = _topk(i, q, s, first[i], k + 1)
            for row in np.unique(q):
                lo, hi = np.searchsorted(q, row), np.searchsorted(q, row, "right")
                key = queries[row]
                old = best.get(key)
                new = (s[lo:hi], first[i[lo:hi]], [ids[x] for x in i[lo:hi]])
                if old is not None:
                    new = (np.concatenate([old[0], new[0]]), np.concatenate([old[1], new[1]]), old[2] + new[2])
                    _, u = np.unique(new[1], return_index=True)
                    o = u[np.lexsort((new[1][u], -new[0][u]))][: k + 1]
                    new = (new[0][o], new[1][o], [new[2][x] for x in o])
                best[key] = new

        def results():
            keys = list(best)
            for lo in range(0, len(keys), 500):
                part = keys[lo : lo + 500]
                yield pd.DataFrame({
                    "q": part, "scores": [best[x][0] for x in part], "ids": [[np.asarray(i, np.int64).tolist() for i in best[x][2]] for x in part],
                })
            best.clear()

        for f in frames:
            for (c_, kind), part in f.groupby(["cell", "kind"], sort=True):
                if c_ != cell:
                    cell, queries, queries_v, pending = c_, [], [], []
                    probed, probes_row = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    if len(best) > 50_000:
                        yield from results()
                if kind == 0:
                    for b in part["buckets"]:
                        pending.append(b)
                    queries += part["first"].tolist()
                    queries_v += part["v"].tolist()
                    continue
                if pending:
                    probed = np.concatenate([np.asarray(b, np.int64) for b in pending])
                    probes_row = np.repeat(np.arange(len(pending)), [len(b) for b in pending])
                    order = np.argsort(probed, kind="stable")
                    probed, probes_row = probed[order], probes_row[order]
                    pending = []
                if queries:
                    ask(part)
        yield from results()

    answer = "q long, scores array<double>, ids array<array<long>>"
    # Each asking row takes its vector's list and leaves itself out.
    key = index.where("asks").select(F.col("ids")[0].alias("q"), "h1", "h2")
    mine = asked.join(key, ["h1", "h2"]).select("vec_id", "q")
    near = written(_lists(mine, dealt.mapInPandas(scan, answer), k), "ann-lists")
    short = F.size("near") < need
    missed = near.where(short).select("q").distinct()
    if n_missed := missed.count():
        exact = _lists(mine.join(missed, "q", "left_semi"), _scanned(index, missed, n_missed, k), k)
        near = near.join(missed, "q", "left_anti").select("vec_id", "q", "near").union(exact)
    return near.select(F.col("vec_id").alias("query_id"), F.posexplode("near").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.neg")).alias("score")
    )


def _lists(mine: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """vec_id, q, near: the k best (neg, id) of each asking row (vec_id, q), from partial lists of its q."""
    hit = found.select("q", F.explode(F.arrays_zip("scores", "ids")).alias("x")).select("q", F.col("x.scores").alias("score"), "x.ids")
    hit = hit.select("q", "score", F.col("ids")[0].alias("first"), "ids").dropDuplicates(["q", "first"])
    top = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))
    lists = hit.withColumn("p", top).where(F.col("p") <= k + 1).groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("hits"))
    flat = F.expr("flatten(transform(hits, h -> transform(h.ids, i -> struct(-h.score as neg, i as id))))")
    near = F.slice(F.sort_array(F.filter(flat, lambda x: x["id"] != F.col("vec_id"))), 1, k)
    none = F.array().cast("array<struct<neg: double, id: bigint>>")
    return mine.join(lists, "q", "left").select("vec_id", "q", F.coalesce(near, none).alias("near"))


def _scanned(index: DataFrame, missed: DataFrame, n_missed: int, k: int) -> DataFrame:
    """q, scores, ids: partial exact lists of the queries `missed` (q). About SCAN_QUERIES of them go to the tasks that read the index,
    and each task gives its best of every query; the index is neither joined nor shuffled."""
    queries = index.where("asks").withColumn("q", F.col("ids")[0]).join(missed, "q", "left_semi").select("q", "v")
    blocks = -(-n_missed // SCAN_QUERIES)
    found = None
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).orderBy("q").collect()  # about SCAN_QUERIES rows
        if block:
            part = index.select("v", "ids").mapInPandas(_scan_of([r["q"] for r in block], np.array([r["v"] for r in block], np.float64), k), "q long, scores array<double>, ids array<array<long>>")
            found = part if found is None else found.union(part)
    return found


def _scan_of(asked: list[int], queries: np.ndarray, k: int):
    """The function of a task: its k + 1 best index rows of each query."""

    def scan(frames):
        rows, scores, first, ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, object)
        for f in frames:
            if not len(f):
                continue
            own = f["ids"].to_numpy()
            c = np.stack(f["v"].to_numpy()).astype(np.float64)
            row, col, s = _best(queries, c, k + 1)
            least = np.array([i[0] for i in own], np.int64)
            ids, rows, scores, first = _topk(np.concatenate([ids, own[col]]), np.concatenate([rows, row]), np.concatenate([scores, s]), np.concatenate([first, least[col]]), k + 1)
        cut = np.searchsorted(rows, np.arange(len(asked) + 1))
        yield pd.DataFrame({
            "q": asked, "scores": [scores[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)],
            "ids": [[np.asarray(x, np.int64).tolist() for x in ids[a:b]] for a, b in zip(cut, cut[1:], strict=False)],
        })

    return scan


def op2_cross_polytope(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))
