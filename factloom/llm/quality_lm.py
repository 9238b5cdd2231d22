"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Trusted documents are those whose label says quality 1 and not toxic. They fall into two halves by a hash of their ids.
Character n-grams of each half and language, and of each half over all languages, are counted over all of them, and counts,
continuation counts, discounts and back-off weights are DataFrames keyed by model and n-gram that meet in sharded joins;
nothing of the n-grams is broadcast. A document is scored by the other half's model of its language, so that no text is
judged by a model that has read it; where that half knows nothing of the language, by its model of all languages. To
score, documents are dealt into blocks of bounded size, each block asks once for each n-gram that it holds, the asked
n-grams are joined with the model's shards, and the answers go back to the block, which adds up its documents. A frequent
n-gram is thus one row a block, not one an occurrence.

Perplexity bounds are quantiles of the trusted documents of the same language and length band; text that is far less or
far more predictable than those is rejected. So is text that repeats itself far more than those do, such as one word over
and over, which is as predictable as any: its distinct n-grams a character (`log_variety`) have a lower quantile of the
same kind. A quantile of n documents counts n to SHRINK against that of the band over all languages, so that languages and
bands with little trusted text are judged too, and none by a rule of its own. Toxic text is only not trusted; well-written
toxic text is no matter of perplexity, and stays.

Defined results
* null or blank text has no perplexity and is rejected; a null language is a language of its own.
* a language without trusted text is judged by the model of all languages and the widest bounds of all of them.
* without any trusted document nothing can be judged: what is not blank is kept.
* rows that repeat an id are judged one by one; labels that repeat are read once (trusted if any says so, and none
  says quality 0 or toxic). Other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_work, blocks_for, portions, table, written

ORDER = 3
BLOCK_BYTES = 10_000_000
SHRINK = 20
BANDS = (160, 320, 640, 1280, 2560)
QUANTILE = 0.005
MARGIN = 0.04
EASE = 0.6  # of the bounds, by the root of the number of documents behind them
BITS = 21  # of a character in a packed n-gram
PAD = 0x110000  # stands before the first character; no character has this number
FEW_ROWS = 10_000  # tables of models or bounds (one row a language and band) of up to so many rows are broadcast


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each with ORDER - 1 pads before it, where each text begins in them, and the lengths."""
    blank = " " * (ORDER - 1)
    codes = np.frombuffer((blank + blank.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(lengths + ORDER - 1) - lengths
    for back in range(1, ORDER):
        codes[begin - back] = PAD
    return codes, begin, lengths


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram (packed, BITS bits a character) that ends at each character of each text, and the texts' lengths."""
    codes, begin, lengths = _codes(texts)
    packed = codes.copy()
    for back in range(1, ORDER):
        packed[back:] |= codes[:-back] << (BITS * back)
    own = np.ones(len(codes), bool)
    for back in range(1, ORDER):
        own[begin - back] = False
    return packed[own], lengths


def _by(f: pd.DataFrame, column: str):
    for name, part in f.groupby(f[column].to_numpy(), sort=True):
        yield name, part


COLUMNS = ["doc_id", "lang", "scale", "half", "text", "row_hash"]


def _packed(frames):
    """A batch's documents by block, each block's as one compressed blob: what the one shuffle of the texts carries."""
    at_work("quality")
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for f in frames:
        t = pa.Table.from_pandas(f[COLUMNS].astype({"doc_id": "Int64"}), preserve_index=False)
        for block, at in f.groupby("block").indices.items():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=options) as w:
                w.write_table(t.take(pa.array(at)))
            yield pd.DataFrame({"block": [block], "blob": [sink.getvalue().to_pybytes()]})


def _unpacked(f: pd.DataFrame) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(b).read_all().to_pandas() for b in f["blob"]]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=COLUMNS)


def _models_of(docs: pd.DataFrame):
    """The documents by the model that scores them: the other half's, of their language or of all."""
    return _by(docs.assign(model=(1 - docs["half"].astype(int)).astype(str) + docs["scale"]), "model") if len(docs) else ()


def _count_and_ask(f: pd.DataFrame, trusted: pd.DataFrame) -> pd.DataFrame:
    """The n-gram counts of the block's trusted documents, for the models of their half (no block), and the n-grams that
    the block asks for (no count)."""
    docs = _unpacked(f)
    out = [pd.DataFrame({"block": pd.array([], "Int32"), "lang": pd.Series([], dtype=object), "gram": np.zeros(0, np.int64), "n": pd.array([], "Int64")})]
    for half, of_half in _by(docs[docs["doc_id"].isin(trusted["doc_id"])], "half"):
        for lang, part in [*_by(of_half, "lang"), ("*", of_half)]:
            gram, n = _distinct(part["text"].tolist())
            out.append(pd.DataFrame({"block": pd.array([pd.NA] * len(gram), "Int32"), "lang": f"{half}{lang}", "gram": gram, "n": pd.array(n, "Int64")}))
    for name, part in _models_of(docs):
        gram, _ = _distinct(part["text"].tolist())
        asked = pd.array([int(f["block"].iloc[0])] * len(gram), "Int32")
        out.append(pd.DataFrame({"block": asked, "lang": name, "gram": gram, "n": pd.array([pd.NA] * len(gram), "Int64")}))
    return pd.concat(out[1:] or out)


def _distinct(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the texts and their counts, some texts at a time, so that only the distinct ones are held."""
    gram, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for lo, hi in portions(texts):
        own, k = np.unique(_grams(texts[lo:hi])[0], return_counts=True)
        gram, at = np.unique(np.concatenate([gram, own]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([n, k]), minlength=len(gram)).astype(np.int64)
    return gram, n


def _sum(*columns):
    return reduce(lambda a, b: a + b, columns)


def _few(df: DataFrame) -> DataFrame:
    """A table that was written, broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def train(counts: DataFrame, few=lambda df: df, keep=lambda df, name: df) -> list[tuple[DataFrame, DataFrame]]:
    """From counts of n-grams of the highest order (lang, gram, n), for each order from 1 up: (n-grams with probability `p`, without the lower orders' share; contexts with `back`,
    the weight of the lower order). Probabilities of order n: p, or nothing, plus back times order n - 1. `few` marks tables of
    one row a model for broadcasting if there are few models; `keep` writes a table that several others are made from."""
    out = []
    for order in range(ORDER, 0, -1):
        if order < ORDER:  # continuation counts: how many n-grams of the next order end in this one
            mask = (1 << (BITS * order)) - 1
            counts = keep(counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count("*").alias("n")), "lm-counts")
        k = lambda i: F.count_if(F.col("n") == i).cast("double")
        spread = counts.groupBy("lang").agg(k(1).alias("k1"), k(2).alias("k2"), k(3).alias("k3"), k(4).alias("k4"))
        y = F.col("k1") / F.greatest(F.lit(1.0), F.col("k1") + 2 * F.col("k2"))
        step = lambda i: F.least(F.lit(float(i)), F.greatest(F.lit(0.1), i - (i + 1) * y * F.col(f"k{i + 1}") / F.greatest(F.lit(1.0), F.col(f"k{i}"))))
        discounts = spread.select("lang", step(1).alias("d1"), step(2).alias("d2"), step(3).alias("d3"))
        with_d = counts.withColumn("context", F.shiftright("gram", BITS)).join(few(discounts), "lang")
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        with_d = with_d.withColumn("d", F.least(d, F.col("n").cast("double")))
        contexts = with_d.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("cut"), F.count("*").alias("kinds"))
        back = F.col("cut") / F.col("total")
        if order == 1:  # the order below is uniform over the characters seen and one for all others
            contexts = contexts.withColumn("back", back / (F.col("kinds") + 1))
        else:
            contexts = contexts.withColumn("back", back)
        contexts = keep(contexts, "lm-contexts")
        grams = with_d.join(contexts.select("lang", "context", "total"), ["lang", "context"]).select(
            "lang", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("p")
        )
        out.append((keep(grams, "lm-grams"), contexts.select("lang", "context", "back")))
    return out[::-1]


def log_probabilities(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """lang, gram, logp for each asked n-gram; null for a language without a model."""
    a, total = asked, None
    for order, (grams, contexts) in enumerate(model, 1):
        mask = (1 << (BITS * order)) - 1
        a = a.withColumn("g", F.col("gram").bitwiseAND(F.lit(mask))).withColumn("c", F.shiftright(F.col("g"), BITS))
        a = a.join(grams.select("lang", F.col("gram").alias("g"), F.col("p").alias(f"p{order}")), ["lang", "g"], "left")
        a = a.join(contexts.select("lang", F.col("context").alias("c"), F.col("back").alias(f"b{order}")), ["lang", "c"], "left")
        own, weight = F.coalesce(f"p{order}", F.lit(0.0)), F.coalesce(f"b{order}", F.lit(1.0))
        total = own + (weight if total is None else weight * total)
    return a.select("lang", "gram", F.log(total).alias("logp"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, row_hash, lang, scale, n_chars, log_perplexity (a character; null without text or model), log_variety, blank.

    Documents of one `scale` were scored by one model. The texts are shuffled by block twice: one pass counts and asks,
    the other scores; between them every table of the model is written once. As one plan, the counting would stand in it
    once for each path from the counts to an answer (18 times).
    """
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("?"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int"))
    t = trusted.select(F.col("doc_id").cast("long").alias("doc_id"))
    blocks = blocks_for(d, F.octet_length("text"), BLOCK_BYTES, 12)
    # The languages that the other half's trusted documents show; a handful of rows.
    known = d.select("doc_id", "lang", "half").join(t, "doc_id", "left_semi").select((1 - F.col("half")).alias("half"), "lang").distinct()
    known = written(known.withColumn("scale", F.col("lang")), "lm-languages")
    few = F.broadcast if known.limit(FEW_ROWS + 1).count() <= FEW_ROWS else (lambda df: df)
    d = d.join(few(known), ["half", "lang"], "left").withColumn("scale", F.coalesce("scale", F.lit("*")))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block")
    d = d.select("doc_id", "lang", "scale", "half", "text", F.xxhash64("text").alias("row_hash"), block).mapInPandas(_packed, "block int, blob binary")
    both = d.groupBy("block").cogroup(t.select("doc_id", block).groupBy("block")).applyInPandas(_count_and_ask, "block int, lang string, gram long, n long")
    both = written(both, "lm-blocks", tidy=True)
    counts = both.where("block is null").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    model = train(written(counts, "lm-counts"), few, written)
    asked = both.where("block is not null").select("block", "lang", "gram")
    told = written(log_probabilities(asked.select("lang", "gram").distinct(), model), "lm-answers")
    answers = asked.join(told, ["lang", "gram"])

    def score(f: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        out = []
        tables = {name: part.sort_values("gram") for name, part in a.groupby("lang")} if len(a) else {}
        for name, part in _models_of(_unpacked(f)):
            texts = part["text"].tolist()
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            value, variety = np.full(len(texts), np.nan), np.zeros(len(texts))
            keys, logp = (tables[name]["gram"].to_numpy(), tables[name]["logp"].to_numpy(np.float64)) if name in tables else (None, None)
            for lo, hi in portions(texts):
                grams, n = _grams(texts[lo:hi])
                end = np.cumsum(n)
                variety[lo:hi] = [len(np.unique(g)) for g in np.split(grams, end[:-1])]
                if keys is not None and len(grams):
                    sums = np.concatenate([[0.0], np.cumsum(logp[np.searchsorted(keys, grams)])])
                    with np.errstate(invalid="ignore", divide="ignore"):
                        value[lo:hi] = -(sums[end] - sums[end - n]) / n
            blank = np.array([not t.strip() for t in texts], bool)
            out.append(pd.DataFrame({
                "doc_id": part["doc_id"].astype("Int64").array, "row_hash": part["row_hash"].array, "lang": part["lang"].array,
                "scale": name, "n_chars": lengths, "log_perplexity": np.where(blank, np.nan, value),
                "log_variety": np.log(np.maximum(variety, 1) / np.maximum(lengths, 1)), "blank": blank,
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    names = ["doc_id", "row_hash", "lang", "scale", "n_chars", "log_perplexity", "log_variety", "blank"]
    schema = "doc_id long, row_hash long, lang string, scale string, n_chars long, log_perplexity double, log_variety double, blank boolean"
    p = d.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)
    p = p.withColumn("lang", F.when(F.col("lang") != "?", F.substring("lang", 2, 1 << 30)))
    return p.withColumn("log_perplexity", F.when(~F.isnan("log_perplexity"), F.col("log_perplexity")))


def _band():
    return _sum(*[F.when(F.col("n_chars") >= b, 1).otherwise(0) for b in BANDS])


def bounds(trusted: DataFrame) -> DataFrame:
    """scale, band, low, high, varied: the bounds of every scale and band from the trusted documents' figures.

    Figures are taken from the scale's median. Of n documents a quantile counts n to SHRINK against the one that it goes
    back to: a scale's in one band to the band's over all scales, that to the one of all.
    Bounds are eased, the more the fewer documents the scale has.
    """
    q = lambda c, x, name: F.percentile_approx(c, x, 10_000).alias(name)
    middle = trusted.groupBy("scale").agg(q("log_perplexity", 0.5, "mid"), q("log_variety", 0.5, "mid_v"))
    t = trusted.join(_few(written(middle, "lm-middles")), "scale").select(
        "scale", "band", (F.col("log_perplexity") - F.col("mid")).alias("x"), (F.col("log_variety") - F.col("mid_v")).alias("v"), "mid", "mid_v"
    )
    t = written(t, "lm-trusted")
    cut = lambda s: [F.count("*").alias(f"n{s}"), q("x", QUANTILE, f"low{s}"), q("x", 1 - QUANTILE, f"high{s}"), q("v", QUANTILE, f"varied{s}")]
    grid = t.groupBy("scale").agg(F.first("mid").alias("mid"), F.first("mid_v").alias("mid_v"), F.count("*").alias("n_s"))
    grid = grid.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(len(BANDS)))))
    grid = grid.join(t.groupBy("band").agg(*cut("_b")), "band", "left").join(t.groupBy("scale", "band").agg(*cut("_sb")), ["scale", "band"], "left")
    grid = grid.crossJoin(F.broadcast(t.agg(*cut("_all"))))  # one row

    def shrunk(name: str, part: str, back):
        n = F.coalesce(f"n{part}", F.lit(0))
        return (n * F.coalesce(f"{name}{part}", F.lit(0.0)) + SHRINK * back) / (n + SHRINK)

    def bound(name: str):
        return shrunk(name, "_sb", shrunk(name, "_b", F.col(f"{name}_all")))

    ease = MARGIN + EASE / F.sqrt("n_s")
    return grid.select(
        "scale", "band", (F.col("mid") + bound("low") - ease).alias("low"), (F.col("mid") + bound("high") + ease).alias("high"),
        (F.col("mid_v") + bound("varied") - ease).alias("varied"),
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, row_hash, lang, n_chars, log_perplexity, low, high, kept."""
    told = labels.groupBy(F.col("doc_id").alias("l_doc")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    told = written(told.where("quality = 1 and coalesce(toxic, 0) = 0").select("l_doc"), "lm-told")
    scored = written(perplexities(docs, told.select(F.col("l_doc").alias("doc_id"))).withColumn("band", _band()), "perplexities")
    trusted = scored.join(told, scored.doc_id == told.l_doc, "left_semi").where("log_perplexity is not null")
    own = written(bounds(trusted), "lm-bounds")
    # What has no bounds of its own has the widest ones of its band.
    widest = own.groupBy("band").agg(F.min("low").alias("any_low"), F.max("high").alias("any_high"), F.min("varied").alias("any_varied"))
    j = scored.join(_few(own), ["scale", "band"], "left").join(F.broadcast(widest), "band", "left")  # a row a band
    j = j.withColumn("low", F.coalesce("low", "any_low")).withColumn("high", F.coalesce("high", "any_high")).withColumn("varied", F.coalesce("varied", "any_varied"))
    outside = ~F.col("log_perplexity").between(F.col("low"), F.col("high")) | (F.col("log_variety") < F.col("varied"))
    kept = ~F.col("blank") & ~F.coalesce(outside, F.lit(False))
    return j.select("doc_id", "row_hash", "lang", "n_chars", "log_perplexity", "low", "high", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all columns they came with, that the classifier keeps."""
    bad = classify(docs, labels).where(~F.col("kept")).select(F.col("doc_id").alias("bad_doc"), F.col("row_hash").alias("bad_row")).distinct()
    d = docs.select(*[F.col(f"`{c}`") for c in docs.columns])
    row = F.xxhash64(F.coalesce(d.text, F.lit("")))
    return d.join(bad, d.doc_id.eqNullSafe(bad.bad_doc) & (row == bad.bad_row), "left_anti")


def op4_quality_lm(spark, sf_dir):
    c = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return c.select("doc_id", "lang", "n_chars", F.round(F.exp("log_perplexity"), 6).alias("perplexity"), "kept")
