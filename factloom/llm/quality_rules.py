"""Quality rules by distribution divergence (DataFrame functions only).

Each document gets a histogram of character classes and one of its language's common words; both are compared by
Jensen-Shannon distance (base 2, 0 to 1) with the language's reference, which is summed over the language's trusted
documents. Minimum-length guards keep short texts, for which a histogram says little, out of the comparison.

Defined results
* null or empty text: no words, so the base rules fail it (fewer than MIN_WORDS words).
* a null language is a language of its own; one without a trusted document is compared with the characters of all trusted
  documents; one without a word list, or without a trusted document, has no word distance (null), which rejects nothing.
* without any trusted document the character reference is empty: no distance, and only the base rules reject.
* rows that repeat an id are judged one by one; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_CLASS, table, words_of, written

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
MIN_CHARS_FOR_CLASSES = 100
MIN_WORDS_FOR_COMMON = 60
PRIOR_CHARS = 2000
FIRST_CLASS_DISTANCE = 0.25
MAX_CLASS_DISTANCE = 0.08
CLASS_SLACK = 2.4
MAX_WORD_DISTANCE = 0.24
WORD_SLACK = 1.0

#: Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his are".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au plus avec".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo".split(),
}
#: Character classes (Java patterns), which share no character; the commonest first.
CLASSES = {
    "lower": r"\p{Ll}", "white": WHITE_CLASS, "upper": r"\p{Lu}", "mark": r"[.,;:'\"?!-]", "digit": r"\p{Nd}",
    "symbol": r"[#*$%&|<>]",
}


def _repeated_words() -> Column:
    """Words in REPEAT_WINDOW-word windows found twice or more, from the array `words`.

    Window hashes by doubling; only a document with a repeat sorts its windows by hash to find which ones are held by
    others, and adds up what these cover.
    """
    return F.expr(
        """if(repeats, aggregate(
             zip_with(starts, slice(starts, 2, size(starts)), (a, b) -> if(b is null, 8L, least(8L, cast(b - a as bigint)))),
             0L, (s, x) -> s + x), 0L)"""
    )


def base_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, classes and common (counts).

    Each step is a column of its own, so that what several later steps read is worked out once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "lang", text.alias("text"))
    d = d.withColumn("words", words_of(F.col("text"))).withColumn("n_chars", F.char_length("text").cast("long"))
    # Runs of one class after another are taken out; what the text loses each time is the count of the class.
    left, size = "text", F.col("n_chars")
    for name, pattern in CLASSES.items():
        d = d.withColumn(f"no_{name}", F.regexp_replace(left, f"{pattern}+", ""))
        d = d.withColumn(f"size_{name}", F.char_length(f"no_{name}").cast("long"))
        d = d.withColumn(name, size - F.col(f"size_{name}"))
        left, size = f"no_{name}", F.col(f"size_{name}")
    d = d.drop(*[f"no_{name}" for name in CLASSES])
    d = d.withColumn("other", size)
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{WHITE_CLASS[1:-1]}]"))
    d = d.withColumn("lines", lines).drop("text")
    d = d.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    d = d.withColumn("n_words", F.size("words").cast("long"))
    d = _with_common(d)
    d = d.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    for step in (1, 2, 4):
        pair = f"zip_with(h{step}, slice(h{step}, {step + 1}, size(h{step})), (a, b) -> if(b is null, null, xxhash64(a, b)))"
        d = d.withColumn(f"h{2 * step}", F.expr(pair)).drop(f"h{step}")
    d = d.withColumn("h8", F.expr("if(n_words < 8, cast(array() as array<bigint>), slice(h8, 1, cast(n_words - 7 as int)))"))
    d = d.withColumn("repeats", F.expr("size(array_distinct(h8)) < size(h8)"))
    d = d.withColumn("by_hash", F.expr("if(repeats, sort_array(transform(h8, (h, i) -> struct(h, i))), null)")).drop("h8")
    d = d.withColumn(
        "starts",
        F.expr(
            "sort_array(transform(filter(by_hash, (x, k) -> coalesce(get(by_hash, k - 1).h = x.h, false) "
            "or coalesce(get(by_hash, k + 1).h = x.h, false)), x -> x.i))"
        ),
    ).drop("by_hash")
    d = d.withColumn("n_repeat_words", _repeated_words())
    return d.select(
        "doc_id", "lang", "n_words", (F.col("n_chars") - F.col("white")).alias("word_chars"), F.col("symbol").alias("n_symbols"),
        "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        "n_chars", F.array(*[F.col(name).cast("double") for name in [*CLASSES, "other"]]).alias("classes"), "common",
    )


def _one_of(words: list[str]):
    longest = max(len(w) for w in words)
    return lambda w: (F.octet_length(w) <= longest) & w.isin(words)


def _with_common(d: DataFrame) -> DataFrame:
    """With `common`: counts of the language's common words, then of all other words; null for a language without a list."""
    found, counts = F.lit(None).cast("array<string>"), F.lit(None).cast("array<double>")
    for lang, words in COMMON_WORDS.items():
        found = F.when(F.col("lang") == lang, F.filter("words", _one_of(words))).otherwise(found)
        own = [((F.octet_length("joined") - F.octet_length(F.replace("joined", F.lit(f" {w} ")))) / F.lit(len(w) + 2)).cast("double") for w in words]
        counts = F.when(F.col("lang") == lang, F.array(*own, (F.col("n_words") - F.col("n_found")).cast("double"))).otherwise(counts)
    d = d.withColumn("found", found).withColumn("n_found", F.size("found"))
    # Two spaces between words, so that ' w ' never shares one with its neighbour.
    d = d.withColumn("joined", F.concat(F.lit(" "), F.array_join("found", "  "), F.lit(" "))).drop("found")
    return d.withColumn("common", counts).drop("joined", "n_found")


def _js(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two count arrays of equal length; null if either is null or empty of counts."""
    total = lambda a: f"aggregate({a}, 0D, (s, x) -> s + x)"
    term = "if(x > 0, x * log2(2 * x / (x + y)), 0D) + if(y > 0, y * log2(2 * y / (x + y)), 0D)"
    norm = lambda a: f"transform({a}, x -> x / nullif({total(a)}, 0D))"
    half = F.expr(f"aggregate(zip_with({norm(p)}, {norm(q)}, (x, y) -> {term}), 0D, (s, x) -> s + x) / 2")
    return F.sqrt(F.when(half < 0, F.lit(0.0)).otherwise(half))


def references(features: DataFrame) -> DataFrame:
    """ref_lang, ref_chars, ref_words, ref_classes, ref_common: counts over the documents of a language, summed before the
    shuffle."""
    k = len(CLASSES) + 1
    w = max(len(x) for x in COMMON_WORDS.values()) + 1
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(k)] + [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(w)]
    g = features.groupBy("lang").agg(F.sum("n_chars").alias("ref_chars"), F.sum("n_words").alias("ref_words"), *sums)
    common = F.filter(F.array(*[F.col(f"w{i}") for i in range(w)]), lambda x: x.isNotNull())
    return g.select(
        F.col("lang").alias("ref_lang"), "ref_chars", "ref_words", F.array(*[F.col(f"c{i}") for i in range(k)]).alias("ref_classes"),
        F.when(F.size(common) > 0, common).alias("ref_common"),
    )


def _measured(features: DataFrame, trusted: DataFrame) -> DataFrame:
    """The features with class_distance, word_distance and the size of the references of `trusted`.

    The characters of all languages stand in, with PRIOR_CHARS characters' weight, for what a language has not shown.
    """
    refs = written(references(trusted), "quality-references")
    k = len(CLASSES) + 1
    total = refs.select(*[F.sum(F.get("ref_classes", F.lit(i))).alias(f"c{i}") for i in range(k)])
    pooled = [float(x or 0) for x in total.first()]
    scale = PRIOR_CHARS / max(1.0, sum(pooled))
    prior = F.array(*[F.lit(x * scale) for x in pooled])
    j = features.join(refs, features.lang.eqNullSafe(refs.ref_lang), "left")
    j = j.withColumn("ref_chars", F.coalesce("ref_chars", F.lit(0))).withColumn("ref_words", F.coalesce("ref_words", F.lit(0)))
    j = j.withColumn("ref_classes", F.coalesce(F.zip_with("ref_classes", prior, lambda x, y: x + y), prior))
    j = j.withColumn("class_distance", F.when(F.col("n_chars") >= MIN_CHARS_FOR_CLASSES, _js("classes", "ref_classes")))
    return j.withColumn("word_distance", F.when(F.col("n_words") >= MIN_WORDS_FOR_COMMON, _js("common", "ref_common")))


def judge(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """base_features plus class_distance, word_distance and kept.

    The references are those of the documents that the labels trust (quality 1, not toxic). Without labels they are taken
    twice: over all documents that the base rules pass, then over those of them that are not far from the first one.
    """
    f = written(base_features(docs), "quality-features")
    if labels is not None:
        told = labels.groupBy(F.col("doc_id").alias("l_doc")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        told = told.where("quality = 1 and coalesce(toxic, 0) = 0").select("l_doc")
        trusted = f.join(told, f.doc_id == told.l_doc, "left_semi").where(~F.col("base_failed"))
    else:
        passed = f.where(~F.col("base_failed"))
        trusted = _measured(passed, passed).where(F.coalesce("class_distance", F.lit(0.0)) <= FIRST_CLASS_DISTANCE).select(*f.columns)
    j = _measured(f, trusted)
    # A histogram of few characters or words lies farther from any other: the bounds are wider for short texts and for
    # references of little text.
    ref_chars, ref_words = F.col("ref_chars") + PRIOR_CHARS, F.greatest(F.lit(1), F.col("ref_words"))
    class_bound = MAX_CLASS_DISTANCE + CLASS_SLACK * (1 / F.sqrt("n_chars") + 1 / F.sqrt(ref_chars))
    word_bound = MAX_WORD_DISTANCE + WORD_SLACK * (1 / F.sqrt("n_words") + 1 / F.sqrt(ref_words))
    far = (F.coalesce("class_distance", F.lit(0.0)) > class_bound) | (F.coalesce("word_distance", F.lit(0.0)) > word_bound)
    return j.withColumn("kept", ~F.col("base_failed") & ~far)


def op10_quality_rules(spark, sf_dir):
    j = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return j.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )
