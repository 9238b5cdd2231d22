"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is right when its roles are one optional system turn followed by user and assistant in turn, or when it is
empty. Each row is kept, given another role or deleted, and empty turns are inserted, at the least cost; of equally cheap
repairs the one whose edits spell the least string is taken. The costs to go from a row are one number for each of four states
(nothing yet, after system, after user, after assistant), so a row is a min-plus map of vectors of four, and only differences
within a vector matter: vectors that differ by a constant are one.

1. Rows are sorted by conversation and place and cut into chunks: whole conversations packed together, and pieces of
   conversations that are longer than a chunk.
2. Every piece works backward from speculative vectors, the first in full, the others until they differ from an earlier run by
   a constant, from where on all is known.
3. Stitching walks each long conversation backward from its true end over what its pieces have found. A piece that meets a
   vector it has not started from is run again from that one, in a fix-up pass over all such pieces at once, until none is
   left. The vectors of small differences are few, so the passes do not grow with the table.
4. The same walk goes forward: from each state a piece's trace ends in one state. With its entry state and its costs to go,
   each piece traces its own edits, the least letter first among those that lie on a cheapest way.

How it is spread out: equal rows of one place are one row with a count; conversations with more than a HOT-th of all rows
(fewer than HOT, so their names are broadcast) are dealt by place, all others by conversation. Chunks are rows of a written
table, so that later passes read them without a shuffle. Only pieces of long conversations move again: their edges, of a few
numbers each, and the repaired text, which one task a conversation must hash in order, since the digest of a whole
is no sum of digests of parts; it streams. A conversation's audit is one value with a letter an edit, as the result asks for.

Defined results
* a null role or text is one space; a null turn is before every other turn; a null conv_id is a conversation of its own.
* rows of one turn go by role, then text; rows that are equal in all four count one by one, and each is damaged alike.
* long texts are whole; other columns of the input are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, discard, table, written

CHUNK_ROWS = 4096
CHUNK_CHARS = 4_000_000
HOT = 1024
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; a repair may end in 0 or 3.
FORWARD = (2, 2, 3, 2)  # where an inserted or renamed turn leads
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by initial: s, u, a, any other
END = (0, 10, 5, 0)
SPECULATIVE = ((0, 0, 0, 0), END, (0, 0, 0, 5), (5, 5, 5, 0), (2, 2, 2, 0), (0, 0, 0, 2))
INITIALS = "sua"
LEGAL = frozenset(("su", "ua", "au"))
FINE, CUT_OFF, MUST_GO = 0, 1, 2  # a row's fault, as the costs see it

Vector = tuple[int, int, int, int]


@lru_cache(maxsize=None)
def step(after: Vector, kind: int) -> tuple[Vector, int]:
    """Costs to go from before a row (kind: three times its initial's place, plus its fault), least 0, and what was taken off."""
    new = _costs(after, kind)
    least = min(new)
    return tuple(x - least for x in new), least


def _costs(after: Vector, kind: int) -> list[int]:
    initial, fault = divmod(kind, 3)
    new = [DELETE + x for x in after]
    if fault != MUST_GO:
        extra = TRUNCATED if fault == CUT_OFF else 0
        for s in range(4):
            new[s] = min(new[s], extra + REROLE + after[FORWARD[s]])
            if s in KEPT[initial]:
                new[s] = min(new[s], extra + after[KEPT[initial][s]])
    return [min(new[s], INSERT + new[FORWARD[s]], 2 * INSERT + new[FORWARD[FORWARD[s]]]) for s in range(4)]


@lru_cache(maxsize=None)
def edits(after: Vector, kind: int, state: int) -> tuple[str, int, int]:
    """The least letters of a cheapest way through a row from a state, up to and with the row's own edit; the state after it; the cost."""
    initial, fault = divmod(kind, 3)
    costs = _costs(after, kind)
    extra = TRUNCATED if fault == CUT_OFF else 0
    letters, spent = "", 0
    while True:
        if DELETE + after[state] == costs[state]:
            return letters + "D", state, spent + DELETE
        to = FORWARD[state]
        if INSERT + costs[to] == costs[state]:
            letters, spent, state = letters + "I", spent + INSERT, to
            continue
        keep = KEPT[initial].get(state)
        if keep is not None and extra + after[keep] == costs[state]:
            return letters + "K", keep, spent + extra
        return letters + "R", to, spent + extra + REROLE


def backward(kinds: list[int], end: Vector, known: list[Vector] | None = None) -> list[Vector]:
    """The vectors before each row, and the end's. A run stops where it is where a known one was: the rest is the same."""
    out = [end]
    for i in range(len(kinds) - 1, -1, -1):
        vector = step(out[-1], kinds[i])[0]
        out.append(vector)
        if known is not None and vector == known[i]:
            return known[:i] + out[::-1]
    return out[::-1]


def exits(kinds: list[int], vectors: list[Vector]) -> list[int]:
    """The state in which the trace from each state ends."""
    states = [0, 1, 2, 3]
    for i, kind in enumerate(kinds):
        after = vectors[i + 1]
        states = [edits(after, kind, s)[1] for s in states]
        if len(set(states)) == 1:  # all are one from here on
            s = states[0]
            for j in range(i + 1, len(kinds)):
                s = edits(vectors[j + 1], kinds[j], s)[1]
            return [s] * 4
    return states


# ---------------------------------------------------------------- rows


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string")))


def damaged(conversations: DataFrame) -> DataFrame:
    """key, turn, role, text, m: rows as the log holds them; some are dropped (m = 0), emptied, cut off, repeated or given to the user."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    c = conversations.select(
        _key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), space(F.col("role")).alias("role"), space(F.col("text")).alias("text"),
        (F.crc32(F.concat(space(F.col("conv_id")), F.lit(":"), space(F.col("turn"))).cast("binary")) % 20).alias("harm"),
    )
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    return c.select("key", "turn", role.alias("role"), text.alias("text"), F.when(F.col("harm") == 0, 0).when(F.col("harm") == 3, 2).otherwise(1).cast("long").alias("m"))


def faulted(rows: DataFrame) -> DataFrame:
    """key, turn, role, text, m, fault ('' or the first of blank, duplicate, truncated) and whether it is the first copy only that
    has it: one row for m equal ones of (key, turn, role, text, m)."""
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    r = rows.where("m > 0").withColumn("said", F.unhex(said))
    first = r.groupBy("key", "said").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
    first = first.select(F.col("key").alias("f_key"), F.col("said").alias("f_said"), F.when(~F.col("none"), F.col("least")).alias("f_turn"))
    # Both sides are unique in (key, turn, said): nothing here is crowded, whatever is said how often.
    r = r.groupBy("key", "turn", "said", "role", "text").agg(F.sum("m").alias("m"))
    r = r.join(first, (F.col("key") == F.col("f_key")) & F.col("turn").eqNullSafe(F.col("f_turn")) & (F.col("said") == F.col("f_said")), "left")
    bare = F.btrim("text", F.lit(WHITE))
    fault = F.when(bare == "", "blank").when(F.col("f_key").isNull(), "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    return r.select("key", "turn", "role", "text", "m", fault.alias("fault"))


def chunked(rows: DataFrame, sizes: DataFrame, chunk_rows: int, hot: int) -> DataFrame:
    """chunk, piece and arrays of keys, turns, roles, texts, ms, faults, in order; a written table. A piece is a part of one
    conversation, any other chunk holds whole ones; chunks of a conversation are numbered in order."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    crowd = F.broadcast(sizes.where(F.col("n") > max(total // hot, chunk_rows)).select(F.col("key").alias("c_key")))  # fewer than `hot`
    r = rows.join(crowd, F.col("key") == F.col("c_key"), "left").withColumn("is_hot", F.col("c_key").isNotNull())
    place = [F.when(F.col("is_hot"), c) for c in (F.col("turn"), F.col("role"), F.left("text", F.lit(200)))]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = r.repartitionByRange(parts, "key", *place).sortWithinPartitions("key", "turn", "role", "text")
    names = ["key", "turn", "role", "text", "m", "fault"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 32
        whole: list[tuple] = []  # conversations that are complete
        own: list[tuple] = []  # the one that is being read
        key, in_pieces = None, False

        def give(some: list[tuple], piece: bool) -> pa.RecordBatch:
            nonlocal seq
            columns = [pa.array([list(c)], pa.list_(t)) for c, t in zip(zip(*some, strict=True), kinds, strict=True)]
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([piece]), *columns], names=["chunk", "piece", *[f"{n}s" for n in names]])

        chars = own_chars = 0
        for batch in batches:
            for *row, is_hot in zip(*(batch.column(i).to_pylist() for i in range(len(names) + 1)), strict=True):
                if row[0] != key:
                    if in_pieces:
                        yield give(own, True)
                    else:
                        whole += own
                        chars += own_chars
                        if len(whole) >= chunk_rows or chars >= CHUNK_CHARS:
                            yield give(whole, False)
                            whole, chars = [], 0
                    key, in_pieces, own, own_chars = row[0], is_hot, [], 0
                elif len(own) >= chunk_rows or own_chars >= CHUNK_CHARS:
                    yield give(own, True)
                    in_pieces, own, own_chars = True, [], 0
                own.append(tuple(row))
                own_chars += len(row[3])
        if own and in_pieces:
            yield give(own, True)
        elif own:
            whole += own
        if whole:
            yield give(whole, False)

    schema = "chunk long, piece boolean, keys array<string>, turns array<long>, roles array<string>, texts array<string>, ms array<long>, faults array<string>"
    return written(dealt.select(*names, "is_hot").mapInArrow(pack, schema), "repair-chunks")


def _kind(role: str, fault: str) -> int:
    initial = INITIALS.find(role[:1]) if role else -1
    return 3 * (initial if initial >= 0 else 3) + (MUST_GO if fault in ("blank", "duplicate") else CUT_OFF if fault else FINE)


# ---------------------------------------------------------------- long conversations

_MEMO = "key string, chunk long, entry array<int>, first array<int>, exits array<int>"


def _runs(key: str, chunk: int, kinds: list[int], ends) -> list[tuple]:
    """What a piece finds from each of some vectors."""
    rows, known = [], None
    for end in ends:
        vectors = backward(kinds, end, known)
        known = known or vectors
        rows.append((key, chunk, list(end), list(vectors[0]), exits(kinds, vectors)))
    return rows


def _memo_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), *[pa.list_(pa.int32())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["key", "chunk", "entry", "first", "exits"])


def speculated(pieces: DataFrame) -> DataFrame:
    """What every piece finds from the speculative vectors: the vector before it, and where its traces end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, keys, roles, faults in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _memo_batch(_runs(keys[0], chunk, [_kind(r, f) for r, f in zip(roles, faults, strict=True)], SPECULATIVE))

    return pieces.select("chunk", "keys", "roles", "faults").mapInArrow(run, _MEMO)


def fixed_up(pieces: DataFrame, wanted: DataFrame) -> DataFrame:
    """The same from the vectors that stitching has asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, keys, roles, faults, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kinds = [_kind(r, f) for r, f in zip(roles, faults, strict=True)]
                known = backward(kinds, SPECULATIVE[0])
                yield _memo_batch([(keys[0], chunk, list(e), list(v[0]), exits(kinds, v)) for e in map(tuple, ends) for v in [backward(kinds, e, known)]])

    w = wanted.groupBy(F.col("chunk").alias("w_chunk")).agg(F.collect_set("vector").alias("ends"))  # a few vectors a piece
    return pieces.join(w, F.col("chunk") == F.col("w_chunk")).select("chunk", "keys", "roles", "faults", "ends").mapInArrow(run, _MEMO)


def stitched(memo: DataFrame) -> DataFrame:
    """key, chunk, vector, state (null: the piece has to be run from the vector first): a walk back over each conversation's pieces
    for the vectors after them, then, if all are known, a walk forward for the states before them."""

    def walk(f: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, dict[Vector, tuple]] = {}
        for chunk, entry, first, out in zip(f["chunk"].tolist(), f["entry"], f["first"], f["exits"], strict=True):
            found.setdefault(chunk, {})[tuple(map(int, entry))] = (tuple(map(int, first)), list(map(int, out)))
        order = sorted(found)
        vector, after = END, {}
        for chunk in reversed(order):
            after[chunk] = vector
            known = found[chunk].get(vector)
            vector = known[0] if known else found[chunk][SPECULATIVE[0]][0]  # a guess, so that later pieces ask in the same pass
        lacking = [c for c in order if after[c] not in found[c]]
        state, states = 0, []
        for chunk in order if not lacking else ():
            states.append(state)
            state = found[chunk][after[chunk]][1][state]
        picked = lacking or order
        return pd.DataFrame({
            "key": f["key"].iloc[0], "chunk": picked, "vector": [list(after[c]) for c in picked], "state": pd.array([None] * len(picked) if lacking else states, "Int32"),
        })

    return memo.groupBy("key").applyInPandas(walk, "key string, chunk long, vector array<int>, state int")


def settled(pieces: DataFrame) -> DataFrame:
    """key, chunk, vector, state of every piece: a written table."""
    memo = written(speculated(pieces), "repair-memo")
    while True:
        walked = written(stitched(memo), "repair-walk")
        wanted = walked.where("state is null")
        if not wanted.limit(1).count():
            discard(memo)
            return walked
        more = written(memo.union(fixed_up(pieces, wanted)), "repair-memo")
        discard(memo, walked)
        memo = more


# ---------------------------------------------------------------- repairs

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost", "turns")
_REPAIR = "key string, chunk long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", low long, high long, head string, tail string, audit string"


def repaired(rows: list[tuple], end: Vector, state: int, last: bool) -> tuple[tuple, list[str]]:
    """Counts, turns, audit and the repaired lines of a piece of a conversation: rows of (key, turn, role, text, m, fault)."""
    kinds = [_kind(r[2], r[5]) for r in rows]
    vectors = backward(kinds, end)
    n = dict.fromkeys(_COUNTS, 0)
    lines, audit = [], []
    names = {2: "user", 3: "assistant"}
    before, seen = None, None
    for i, (_, turn, role, text, m, fault) in enumerate(rows):
        if fault == "blank":
            n["blank"] += m
        else:
            n["duplicate"] += m - (fault != "duplicate")
            n["truncated"] += fault == "truncated"
        initial = role[:1]
        n["illegal"] += m - 1 + (before is not None and before + initial not in LEGAL)
        n["turns"] += turn is not None and turn != seen
        before, seen = initial, turn
        letters, to, spent = edits(vectors[i + 1], kinds[i], state)
        for letter in letters[:-1]:
            state = FORWARD[state]
            lines.append(f"{names[state]}:")
        if letters[-1] == "K":
            lines.append(f"{role}:{text}")
        elif letters[-1] == "R":
            lines.append(f"{names[to]}:{text}")
        state = to
        audit.append(letters + "D" * (m - 1))
        n["cost"] += spent + DELETE * (m - 1)
    while last and state in (1, 2):
        state = FORWARD[state]
        lines.append(f"{names[state]}:")
        audit.append("I")
        n["cost"] += INSERT
    turns = [r[1] for r in rows if r[1] is not None]
    ends = (turns[0], turns[-1]) if turns else (None, None)
    return (*(n[c] for c in _COUNTS), *ends, rows[0][2][:1], rows[-1][2][:1], "".join(audit)), lines


def _text(lines: list[str]) -> bytes:
    return "\n".join(lines).encode("utf-8", "surrogatepass")


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows, strict=True), schema, strict=True)], names=[n for n, _ in schema])


_ARROW = [("key", pa.string()), ("chunk", pa.int64()), *[(c, pa.int64()) for c in (*_COUNTS, "low", "high")], *[(c, pa.string()) for c in ("head", "tail", "audit")]]
_ARRAYS = ("keys", "turns", "roles", "texts", "ms", "faults")


def repair_whole(chunks: DataFrame) -> DataFrame:
    """A row a conversation, with the digest of its repaired text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = list(zip(*arrays, strict=True))
                out, begin = [], 0
                for i in range(1, len(rows) + 1):
                    if i == len(rows) or rows[i][0] != rows[begin][0]:
                        found, lines = repaired(rows[begin:i], END, 0, True)
                        out.append((rows[begin][0], chunk, *found, hashlib.sha256(_text(lines)).hexdigest()))
                        begin = i
                yield _batch(out, [*_ARROW, ("sha", pa.string())])

    return chunks.where(~F.col("piece")).select("chunk", *_ARRAYS).mapInArrow(run, _REPAIR + ", sha string")


def repair_pieces(pieces: DataFrame, walked: DataFrame) -> DataFrame:
    """A row a piece of a long conversation, with its repaired text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, vector, state, last, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = list(zip(*arrays, strict=True))
                found, lines = repaired(rows, tuple(vector), state, last)
                yield _batch([(rows[0][0], chunk, *found, _text(lines))], [*_ARROW, ("lines", pa.binary())])

    ends = walked.groupBy(F.col("key").alias("e_key")).agg(F.max("chunk").alias("end"))
    w = walked.join(ends, F.col("key") == F.col("e_key")).select(F.col("chunk").alias("w_chunk"), "vector", "state", (F.col("chunk") == F.col("end")).alias("last"))
    j = pieces.join(w, F.col("chunk") == F.col("w_chunk"))
    return j.select("chunk", "vector", "state", "last", *_ARRAYS).mapInArrow(run, _REPAIR + ", lines binary")


def digests(parts: DataFrame) -> DataFrame:
    """key, sha: the digest of each conversation's text, streamed piece by piece in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = [("key", pa.string()), ("sha", pa.string())]
        key, digest, some = None, None, False
        for batch in batches:
            for k, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if digest is not None:
                        yield _batch([(key, digest.hexdigest())], schema)
                    key, digest, some = k, hashlib.sha256(), False
                if lines:
                    digest.update(b"\n" + lines if some else lines)
                    some = True
        if digest is not None:
            yield _batch([(key, digest.hexdigest())], schema)

    ordered = parts.repartition("key").sortWithinPartitions("key", "chunk")
    return ordered.select("key", "lines").mapInArrow(run, "key string, sha string")


def joined(parts: DataFrame) -> DataFrame:
    """A row a long conversation from its pieces: sums, and what lies between neighbours."""
    from pyspark.sql import Window

    along = Window.partitionBy("key").orderBy("chunk")
    tail, high = F.lag("tail").over(along), F.last("high", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    p = parts.withColumns({"before": tail, "so_far": high})
    broken = F.col("before").isNotNull() & ~F.concat("before", "head").isin(*sorted(LEGAL))
    p = p.withColumn("illegal", F.col("illegal") + broken.cast("long")).withColumn("turns", F.col("turns") - F.coalesce((F.col("so_far") == F.col("low")).cast("long"), F.lit(0)))
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "audit")))["audit"], "")
    return p.groupBy("key").agg(*[F.sum(c).alias(c) for c in _COUNTS], F.min("low").alias("low"), F.max("high").alias("high"), audit.alias("audit"))


def repair_rows(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, hot: int = HOT) -> DataFrame:
    """key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every key of (key, turn, role, text, m)."""
    sizes = written(rows.groupBy("key").agg(F.sum("m").alias("n")), "repair-sizes")
    chunks = chunked(faulted(rows), sizes, chunk_rows, hot)
    every = ["key", *_COUNTS, "low", "high", "audit", "sha"]
    found = repair_whole(chunks).select(*every)
    pieces = chunks.where("piece")
    if pieces.limit(1).count():
        walked = settled(pieces)
        parts = written(repair_pieces(pieces, walked), "repair-pieces")
        discard(walked)
        found = found.union(joined(parts.drop("lines")).join(digests(parts), "key").select(*every))
    f = sizes.select(F.col("key").alias("s_key")).join(found, F.col("s_key") == F.col("key"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    empty = hashlib.sha256(b"").hexdigest()
    return f.select(
        F.col("s_key").alias("key"), zero(F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps"), *[zero(F.col(c)).alias(c) for c in _COUNTS[:5]],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(empty)).alias("repaired_sha256"),
    )


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS, hot: int = HOT) -> DataFrame:
    """The damage of the log, found and repaired, for every conv_id."""
    r = repair_rows(damaged(conversations), chunk_rows, hot)
    conv = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(conversations.schema["conv_id"].dataType)
    return r.select(conv.alias("conv_id"), *r.columns[1:])


def op11_structure_repair(spark, sf_dir):
    return repair(table(spark, sf_dir, "conversations"))
