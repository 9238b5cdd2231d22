"""The corpus pipeline: documents in, packed token sequences out.

Every stage works on all documents that the one before it kept; all but the last return the columns of documents.

Defined results, of each stage on its own input
* quality classifier: null and blank texts are rejected; rows that repeat an id are judged one by one.
* line dedup: null text counts as one empty line and comes back as empty text; rows that repeat an id never drop each other's lines.
* near duplicates: of a component the rows with the least id stay; documents without words or id link with nothing and stay.
* passage dedup: null, empty and short texts lose nothing; rows that repeat an id are one document.
* packing: null and empty texts are one end token; rows that repeat an id are packed one by one.
Long texts are whole in all of them, ties go to smaller ids, an empty table gives an empty result, and other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import kk_packing, line_dedup, parity_join, quality_lm, suffix_dedup
from factloom.llm.common import table, written
from factloom.session import ship

#: Passages that repeat across documents are cut from this length on; shorter repeats are common phrases.
PASSAGE_BYTES = 100


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    return quality_lm.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    ship(spark)
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, a similarity of 0.8 or more."""
    ship(spark)
    return parity_join.keep_first(docs, shingle=5, percent=80)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go."""
    ship(spark)
    return suffix_dedup.remove_repeats(docs, PASSAGE_BYTES)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, one row a piece."""
    ship(spark)
    return kk_packing.pack(docs)


STAGES = [
    ("quality classifier", reject_poor),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_copies),
    ("passage dedup", drop_passages),
    ("packing", pack_tokens),
]

#: The classifier, the suffix sort and the packing have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
