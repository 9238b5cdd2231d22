"""The evaluation report as Markdown, spliced between markers of a file. Rows are a collected handful of metrics."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import ERROR_TYPES
from ..schemas import CONCEPTS

START, END = "<!-- eval:start -->", "<!-- eval:end -->"


CONFIG = "Model / prompt"


def _configured(df: DataFrame) -> DataFrame:
    return df.withColumn(CONFIG, F.concat_ws(" / ", "model", F.substring_index("prompt_id", "-", 1)))


def _share(c: str):
    return F.when(F.col(c).isNull(), "n/a").otherwise(F.format_string("%.1f%%", F.col(c) * 100))


def pivot_recall(metrics: DataFrame, configs: list[str] | None = None) -> DataFrame:
    """One row a concept, one column of recall for each model and prompt; with the configurations named, in one pass."""
    return _configured(metrics).groupBy("concept").pivot(CONFIG, configs).agg(F.max("recall"))


def tables(metrics: DataFrame, by_size: DataFrame) -> list[DataFrame]:
    """The report's tables, worked out by Spark, every cell a text: totals, recall by concept, kinds of errors, recall by size."""
    m = _configured(metrics)
    total = m.where("concept = 'ALL'").orderBy(F.desc_nulls_last("recall"), "model")
    text = lambda name, c: c.alias(name)
    count = lambda name, c: F.col(c).cast("string").alias(name)
    totals = total.select(
        CONFIG, count("Documents", "documents"), count("Verifiable", "verifiable"), text("Recall", _share("recall")), text("Precision", _share("precision")),
        count("Unsupported", "unsupported"), count("Tag errors", "tag_error"), text("USD per 1,000", F.format_string("%.2f", F.col("usd_per_1000").cast("double"))),
        text("Mean latency", F.format_string("%.1f s", F.col("mean_latency_ms") / 1000)),
    )
    configs = [r[0] for r in total.select(CONFIG).collect()]  # a column of the report each
    shown = lambda n: F.first(F.concat(_share("recall"), F.lit(" (n="), F.col(n).cast("string"), F.lit(")")))
    every = metrics.sparkSession.createDataFrame(list(enumerate(CONCEPTS.values())), "place int, Concept string")
    concepts = every.join(m.withColumnRenamed("concept", "Concept").groupBy("Concept").pivot(CONFIG, configs).agg(shown("verifiable")), "Concept", "left")
    sizes = _configured(by_size).withColumn("band", F.substring_index("size_band", ": ", -1))
    bands = [r[0] for r in sizes.select("size_band", "band").distinct().orderBy("size_band").select("band").collect()]
    order = total.select(CONFIG, F.monotonically_increasing_id().alias("place"))
    by_band = order.join(sizes.groupBy(CONFIG).pivot("band", bands).agg(shown("documents")), CONFIG, "left").orderBy("place")
    return [
        totals,
        concepts.orderBy("place").select("Concept", *[F.coalesce(F.col(f"`{c}`"), F.lit("n/a")).alias(c) for c in configs]),
        total.select(CONFIG, *[count(e, e) for e in ERROR_TYPES]),
        by_band.select(CONFIG, *[F.coalesce(F.col(f"`{b}`"), F.lit("n/a")).alias(b) for b in bands]),
    ]


def markdown(df: DataFrame) -> str:
    """A small table of texts in Markdown, the first column to the left, the others to the right."""
    rows = [df.columns, ["---", *["---:"] * (len(df.columns) - 1)], *df.collect()]
    return "\n".join(f"| {' | '.join(r)} |" for r in rows)


def render(metrics: DataFrame, by_size: DataFrame, on: date) -> str:
    return "\n\n".join([f"{START}\nComputed on {on.isoformat()}.", *map(markdown, tables(metrics, by_size)), END])


def running_cost(usage: DataFrame) -> DataFrame:
    """component, usd of a month, and their total as a row of its own: units (component, units, free, price) beyond the free ones
    at their price; components of several rows are added up."""
    usd = F.greatest(F.lit(0.0), F.col("units").cast("double") - F.col("free").cast("double")) * F.col("price").cast("double")
    out = usage.withColumn("usd", usd).groupingSets([["component"], []], "component").agg(F.grouping("component").alias("all_"), F.sum("usd").alias("usd"))
    return out.select(F.when(F.col("all_") == 1, "Total").otherwise(F.col("component")).alias("component"), F.coalesce("usd", F.lit(0.0)).alias("usd"))


def splice(text: str, block: str) -> str:
    if START not in text or END not in text:
        raise ValueError("the text has no markers")
    return text[: text.index(START)] + block + text[text.index(END) + len(END) :]


def is_stale(text: str, block: str) -> bool:
    """Whether the text holds another report; the date doesn't count."""
    undated = lambda t: re.sub(r"\d{4}-\d{2}-\d{2}", "", t)
    return undated(splice(text, block)) != undated(text)
