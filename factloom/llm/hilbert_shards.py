"""Sharding along a Hilbert curve.

Metadata (language, source, text size) is quantised to a small grid, each document gets the index of its cell on the
Hilbert curve through that grid, documents are sorted by it, and the order is cut into runs of equal row counts: a
shard holds a compact box of the metadata space, and min/max statistics of its files prune on every dimension. Equal
texts are one group: all have the cell of the least id among them and lie side by side, so that only the end of a run can
part them.

Only ids, metadata and numbers are shuffled, never texts. Groups of more than a HOT-th of all rows, fewer than HOT of them, are
broadcast to their rows, so that no join brings a hot group into one task. The global order is a range partitioning plus counts per partition
(one row a partition on the driver); no key has to be in one task, since the sort key ends with the id.

Defined results
* null text has no bytes (size 1); null metadata has a cell of its own; a null doc_id sorts first.
* rows that repeat an id are rows of their own; ties on all keys are equal rows, whose order does not matter.
* an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written

BITS = 6
HOT = 1024


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (one row each, every coordinate below 2**bits).

    The usual transposed form: undo the rotations from the top bit down, then Gray-code the bits across dimensions.
    """
    x = coords.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit = np.int64(1) << level
        low = bit - 1
        for d in range(dims):
            on = (x[d] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = np.int64(1) << level
        flip ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << 1) | ((x[d] >> level) & 1)
    return out


def _curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([a, b, c], axis=1), BITS))


def curve_rows(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, size, text_crc32, text_hash and hilbert. Categories go to 2**BITS cells by hash; sizes to cells of
    equal ratio, fixed and not fitted, so that a cell never depends on other documents than those of equal text."""
    cells = 1 << BITS
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    bucket = lambda c: F.pmod(F.xxhash64(F.coalesce(F.col(c), F.lit("\0"))), F.lit(cells)).cast("int")
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", "lang", "source", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    level = F.least(F.floor(F.log2("size") * 2), F.lit(cells - 1)).cast("int")
    d = written(d.select("*", F.pandas_udf(_curve, "long")(bucket("lang"), bucket("source"), level).alias("hilbert")), "curve-rows")
    same = ["text_hash", "text_crc32", "size"]
    groups = d.groupBy(*same).agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "hilbert")).alias("least")).where("copies > 1")
    groups = written(groups.select(*same, "copies", F.col("least.hilbert").alias("of_group")), "curve-groups")
    hot = F.col("copies") * HOT > d.count()
    d = d.join(F.broadcast(groups.where(hot).drop("copies")), same, "left")
    rest = d.where("of_group is null").drop("of_group").join(groups.where(~hot).drop("copies"), same, "left")
    return d.where("of_group is not null").unionByName(rest).withColumn("hilbert", F.coalesce("of_group", "hilbert")).drop("of_group")


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, hilbert, shard, slot, lang, source: runs of the curve order whose row counts differ by one at most."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["hilbert", "text_crc32", "text_hash", "doc_id", "size", "lang", "source"]
    ordered = curve_rows(docs).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = ordered.withColumn("at", F.monotonically_increasing_id())
    placed = written(
        placed.select("*", F.shiftright("at", 33).cast("int").alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("local")), "curve"
    )
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    ahead, starts = 0, []
    for part, count in counts:
        starts.append((part, ahead))
        ahead += count
    offsets = spark.createDataFrame(starts, "o_part int, ahead long")
    ranked = placed.join(F.broadcast(offsets), placed.part == offsets.o_part).withColumn("rank", F.col("ahead") + F.col("local"))
    # The shard of rank r is the largest s with floor(s * total / shards) <= r.
    s = F.expr(f"cast(((rank + 1) * {shards} - 1) div {max(ahead, 1)} as int)")
    slot = (F.col("rank") - F.expr(f"(shard * {ahead}L) div {shards}")).alias("slot")
    return ranked.withColumn("shard", s).select("doc_id", "size", "text_crc32", "hilbert", "shard", slot, "lang", "source")


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> DataFrame:
    """Write the documents' shard table as one folder a shard, each file in curve order, with the metadata to prune on."""
    out = shard(docs, shards)
    out.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return out


def op9_hilbert_shards(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )
