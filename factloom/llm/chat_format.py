"""Chat formatting with cumulative-snapshot collapse (DataFrame functions only).

Logs often hold every state of a growing conversation. Each turn gets 128 hash bits that include its place; the XOR
of the first k turns is the digest of the prefix of k turns. A conversation whose whole digest is the prefix digest of
a longer one is a snapshot, and anti-joins leave only maximal conversations; of equal ones the smallest id stays.
Places and prefixes come from two-level scans over blocks of BLOCK turn numbers, so that one conversation with a third
of all rows is many groups, and digests are XORed before they are shuffled.

Defined results
* rows equal in conv_id, turn, role and text count once; rows of one turn go by role, then text; a null turn is first.
* null text is empty, a null role is 'unknown'; a null conv_id is one conversation of its own.
* marker openings inside a text are broken ('<|' becomes '< |'), so that no text can start a turn.
* a conversation is rendered in rows of at most BLOCK turns (`part`), which joined in order are the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

BLOCK = 1024


def _ranked(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text, g1, g2 (turn hash with its place), block of turn numbers."""
    c = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    c = c.withColumn("block", F.expr(f"coalesce(cast(turn as bigint) div {BLOCK}, -9223372036854775807L)"))
    inner = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    c = c.withColumn("in_block", F.row_number().over(inner))
    sizes = c.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("conv_id").alias("s_conv"), F.col("block").alias("s_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    )
    placed = c.join(sizes, c.conv_id.eqNullSafe(sizes.s_conv) & (c.block == sizes.s_block))
    placed = placed.select("conv_id", "block", (F.col("ahead") + F.col("in_block")).alias("place"), "role", "text")
    return placed.withColumn("g1", F.xxhash64("place", "role", "text")).withColumn("g2", F.xxhash64(F.lit(1), "text", "place", "role"))


def _prefixes(ranked: DataFrame) -> DataFrame:
    """place, p1, p2: digests of every prefix, each once."""
    within = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"), F.max("place").alias("end"))
    sums = sums.select(
        F.col("conv_id").alias("s_conv"), F.col("block").alias("s_block"),
        F.coalesce(F.bit_xor("b1").over(before), F.lit(0)).alias("a1"),
        F.coalesce(F.bit_xor("b2").over(before), F.lit(0)).alias("a2"),
        F.max("end").over(Window.partitionBy("conv_id")).alias("last"),
    )
    r = ranked.select(
        "conv_id", "block", "place", F.bit_xor("g1").over(within).alias("w1"), F.bit_xor("g2").over(within).alias("w2")
    )
    j = r.join(sums, r.conv_id.eqNullSafe(sums.s_conv) & (r.block == sums.s_block)).where("place < last")
    return j.select("place", F.expr("w1 ^ a1").alias("p1"), F.expr("w2 ^ a2").alias("p2")).distinct()


def maximal(ranked: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that are no prefix and no copy of another."""
    whole = ranked.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.bit_xor("g1").alias("d1"), F.bit_xor("g2").alias("d2"))
    p = _prefixes(ranked)
    longest = whole.join(p, (whole.n_turns == p.place) & (whole.d1 == p.p1) & (whole.d2 == p.p2), "left_anti")
    return longest.groupBy("n_turns", "d1", "d2").agg(F.min("conv_id").alias("conv_id")).select("conv_id", "n_turns")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, chat: every maximal conversation, rendered."""
    ranked = _ranked(conversations)
    m = maximal(ranked).select(F.col("conv_id").alias("m_conv"), "n_turns")
    safe = F.replace("text", F.lit("<|"), F.lit("< |"))
    role = F.replace("role", F.lit("|>"), F.lit("| >"))
    piece = F.concat(F.lit("<|"), role, F.lit("|>\n"), safe, F.lit("\n<|end|>\n"))
    r = ranked.select("conv_id", "place", piece.alias("piece"))
    kept = r.join(m, r.conv_id.eqNullSafe(m.m_conv))
    part = F.expr(f"(place - 1) div {BLOCK}")
    grouped = kept.groupBy("conv_id", part.alias("part"), "n_turns").agg(F.sort_array(F.collect_list(F.struct("place", "piece"))).alias("p"))
    return grouped.select("conv_id", "part", "n_turns", F.array_join(F.col("p.piece"), "").alias("chat"))


def op5_chat_format(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations"))


OP5_SQL = r"""
with t as (
  select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations
), r as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place from t
), c as (
  select conv_id, count(*) as n, list({'r': role, 't': text} order by place) as l from r group by conv_id
), p as (
  select distinct l[1:k] as l from (select l, unnest(range(1, n)) as k from c)
), m as (
  select min(conv_id) as conv_id, n from c where l not in (select l from p) group by l, n
)
select r.conv_id, (r.place - 1) // 1024 as part, m.n as n_turns,
       string_agg('<|' || replace(role, '|>', '| >') || '|>' || chr(10) || replace(text, '<|', '< |') || chr(10)
                  || '<|end|>' || chr(10), '' order by place) as chat
from r join m on r.conv_id is not distinct from m.conv_id
group by all
"""
