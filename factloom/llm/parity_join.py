"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles; equal sets are one class, and one document of each class is sketched.
Each shingle toggles one bit of a parity sketch, so the number of bits in which two sketches differ is at most the
symmetric difference of the sets, and of linked sets at most a bound that their sizes give.

Sets of similar size meet in size bands. In a band whose linked sets differ in at most t shingles, a very wide sketch is
cut into P > t segments, each known by the XOR of its shingles' hashes. Linked sets agree in at least P - t segments, so
joining on single segments finds every linked pair. Segments without shingles say nothing: P leaves room for `spare` of
them, and a set with more of them is sketched again under other seeds, like every set that it could meet on empty
segments alone, which keeps the search exact. Segments that only one set has go no farther than their shard.

A passage that many documents share makes hot segments. Each sketch has some segments more than it needs (its slack: the
spare ones that are not empty): linked sets agree in one more of them than the slack of either. So each sketch gives up as many
of its hottest segments as its slack; in one order of all segments by their number of sets, the rarest that two linked sets
share is given up by neither.

Pairs are then decided, never whole groups:

1. each set is paired with the one leader (the least set of a segment) that it shares most segments with; a folded sketch
   of about 16 bits a tolerated difference tests the Hamming distance, and what passes is verified on the sets. Most
   copies of a large group end in one family here.
2. segments whose sets are not all of one family yet are searched for pairs across families that pass the Hamming test.
   The FIRST nearest ones of each set are verified first, which joins most families; then MORE times as many of what is
   across families still, and so on, until no pair is left. Rounds are few, since each one costs some shuffles however few
   pairs it has. A segment that many sets share is dealt into cells: its largest family stays in place, once in all, and
   only the others meet it.

A set travels once for all its pairs in a bin, and a pair that fails the Hamming test moves no set.

Defined results
* no words or no text: an empty set, linked with nothing. Fewer words than a shingle: the whole sequence is one.
* rows that repeat an id are one document with the links of all its rows, and each row has its own shingle count.
* a null doc_id links nothing and has no component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import exp, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import at_work, blocks_for, discard, portions, table, written
from .suffix_dedup import Prefixes, mixed

SHINGLE = 4
PERCENT = 85
SHARD_BYTES = 16_000_000
SEEDS = 8
BATCH = 2048
STAR = 256  # pairs of one leader that are verified in one bin
CELL = 8192  # sets of one segment in a cell
SMALL_CELL = 64
GIVE_UP = 16  # one more segment to be given up for as many tolerated differences
HOT = 32  # sets of a segment from which on it is given up where slack allows
FIRST = 8  # of the nearest sets of each set in the first round
MORE = 64  # times as many in each next round
BITS_PER_DIFFERENCE = 16
MIX = np.uint64(0xD6E8FEB86659FD93)
KEY_BYTES = 6


class Bands:
    """Size bands, and for each the words of a sketch, how many of them may be empty, and how many are there to be given up."""

    def __init__(self, percent: int, ratio_steps: int = 2):
        self.similar = percent / 100
        self.ratio = (1 / self.similar) ** ratio_steps if percent < 100 else 2.0
        self.made: dict[int, tuple[int, int, int]] = {}

    def of(self, n: int) -> list[int]:
        """The bands in which a set of n meets its partners: its own, and the next if a larger partner can be there."""
        own = int(log(n) / log(self.ratio) + 1e-9)
        return [own, own + 1] if n / self.similar >= self.ratio ** (own + 1) * (1 - 1e-9) else [own]

    def sketch(self, band: int) -> tuple[int, int, int]:
        if band not in self.made:
            most = self.ratio ** (band + 1) * (1 + 1e-9)
            differ = int((1 - self.similar) / (1 + self.similar) * 2 * most + 1e-9)
            least = self.ratio**band * self.similar  # the smallest set that meets a partner in this band
            extra = 1 + differ // GIVE_UP if differ else 0
            spare = 0
            while differ and spare < 3 + differ // 6:
                words = differ + 1 + spare + extra
                share = least / words
                empty = words * exp(-share)
                if spare >= empty + 1.5 * sqrt(empty * (1 - (1 + share) * exp(-share))):
                    break
                spare += 1
            self.made[band] = (differ + 1 + spare + extra, spare, extra)
        return self.made[band]


def shingle_sets(texts: list[str], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text."""
    raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8).copy()
    capital = (data >= 65) & (data <= 90)
    data[capital] += 32
    inside = np.ones(len(data) + 1, bool)
    inside[0] = False
    inside[1:] = (data != 32) & ((data < 9) | (data > 13))
    change = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = change[::2], change[1::2]
    word = Prefixes(data).of(begin, end - begin)
    text_end = np.cumsum([len(r) + 1 for r in raw])
    last = np.searchsorted(begin, text_end)  # words before the end of each text
    first = np.concatenate([[0], last[:-1]])
    rolled = word.copy()
    for i in range(1, k):
        rolled = rolled[: len(word) - i] * MIX + word[i:] if len(word) > i else rolled[:0]
    rolled = mixed(rolled + np.uint64(k))
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            h = 0
            for w in word[a:b].tolist():
                h = (h * int(MIX) + w) % (1 << 64)
            out.append(mixed(np.array([(h + b - a) % (1 << 64)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch_keys(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The join keys of a set: one key for each segment of its sketches that has shingles.

    If more words than the band's spare ones are empty, the set is sketched again under another seed, as is every set
    that can be linked with it on empty words alone; sets that SEEDS seeds don't help meet under one key.
    """
    keys = []
    for band in bands.of(len(s)):
        words, spare, _ = bands.sketch(band)
        for seed in range(SEEDS):
            own = _seeded(s, seed)
            at = (own % np.uint64(words)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            sorted_at = at[order]
            head = np.flatnonzero(np.concatenate([[True], sorted_at[1:] != sorted_at[:-1]]))
            xor = np.bitwise_xor.reduceat(own[order], head)
            tag = np.uint64(((band * SEEDS + seed + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
            keys.append(_of_sketch(mixed(mixed(xor + tag) + sorted_at[head].astype(np.uint64) * MIX), band, seed))
            if len(head) >= words - spare:
                break
        else:
            keys.append(_of_sketch(mixed(np.array([tag], np.uint64)), band, seed))
    return np.concatenate(keys)


def slacks(s: np.ndarray, bands: Bands) -> list[int]:
    """For each sketch of a set how many of its segments may be given up, below the sketch's number (bits 16 to 23)."""
    out = []
    for band in bands.of(len(s)) if len(s) else []:
        words, spare, extra = bands.sketch(band)
        for seed in range(SEEDS):
            empty = words - np.count_nonzero(np.bincount((_seeded(s, seed) % np.uint64(words)).astype(np.int64), minlength=words))
            out.append((band * SEEDS + seed) % 256 << 16 | min(max(0, spare + extra - int(empty)), 0xFFFF))
            if empty <= spare:
                break
    return out


def _seeded(s: np.ndarray, seed: int) -> np.ndarray:
    return mixed(s + np.uint64(seed * int(MIX) % (1 << 64))) if seed else s


def _of_sketch(key: np.ndarray, band: int, seed: int) -> np.ndarray:
    """Keys whose bits 16 to 23 tell the sketches of one set apart (its bands are neighbours)."""
    return (key & ~np.uint64(0xFF0000)) | np.uint64((band * SEEDS + seed) % 256 << 16)


def differ_at_most(a, b, percent: int):
    """The largest symmetric difference of linked sets of sizes a and b."""
    return (a + b) * (100 - percent) // (100 + percent)


def folded_sketch(s: np.ndarray, percent: int) -> np.ndarray:
    """The parity sketch of a set in 64-bit words; a power of two of bits, so that a longer one folds into a shorter."""
    bits = 64
    while bits < BITS_PER_DIFFERENCE * differ_at_most(len(s), len(s), percent):
        bits *= 2
    at = mixed(s ^ MIX) & np.uint64(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def fold(sketch: np.ndarray, words: int) -> np.ndarray:
    return sketch if len(sketch) == words else np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def hamming(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    words = min(len(x), len(y))
    return int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum())


def measured(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, row_hash, bytes, n, d1, d2 (size and digests of the set), its folded sketch and the slack of its segments, for
    every row of (doc_id, text, row_hash)."""

    def measure(frames):
        at_work("join")
        bands = Bands(percent)
        for f in frames:
            for lo, hi in portions(f["text"].tolist()):
                part = f.iloc[lo:hi]
                sets = shingle_sets(part["text"].tolist(), shingle)
                total = lambda x: int(np.sum(x, dtype=np.uint64)) if len(x) else 0
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].astype("Int64").array, "row_hash": part["row_hash"].array, "bytes": part["bytes"].array, "n": [len(x) for x in sets],
                    "d1": np.array([total(x) for x in sets], np.uint64).astype(np.int64),
                    "d2": np.array([total(mixed(x)) for x in sets], np.uint64).astype(np.int64),
                    "sketch": [folded_sketch(x, percent).tobytes() if len(x) else None for x in sets],
                    "slack": [slacks(x, bands) for x in sets],
                })

    docs = docs.withColumn("bytes", F.octet_length("text"))
    return docs.mapInPandas(measure, "doc_id long, row_hash long, bytes int, n long, d1 long, d2 long, sketch binary, slack array<int>")


def shared_segments(texts: DataFrame, shards: int, shingle: int, percent: int) -> DataFrame:
    """key, cid: the segments that more than one class has, and the classes that have them, of (cid, text)."""

    def sketch(frames):
        at_work("join")
        bands = Bands(percent)
        for whole in frames:
            for lo in range(0, len(whole), BATCH):
                part = whole.iloc[lo : lo + BATCH]
                yield from sketch_batch(part["cid"].to_numpy(np.int64), part["text"].tolist(), bands)

    def sketch_batch(cids, texts, bands):
        keys, rows = [], []
        for lo, hi in portions(texts):
            for i, s in enumerate(shingle_sets(texts[lo:hi], shingle), lo):
                if len(s):
                    keys.append(sketch_keys(s, bands))
                    rows.append(np.full(len(keys[-1]), i, np.uint16))
        if not keys:
            return
        key, row = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        several = again.copy()
        several[:-1] |= again[1:]
        # Of the sets of this batch that share a segment one goes on to the shard; all are known to share it.
        shard = _shard_of(key, shards)
        more = np.stack([_named(key[several], shard[several]), cids[row[several]]], axis=1).astype("<i8").tobytes()
        key, row, shard = key[~again], row[~again], shard[~again]
        order = np.argsort(shard, kind="stable")
        there, cut = np.unique(shard[order], return_index=True)
        for i, (s, own) in enumerate(zip(there.tolist(), np.split(order, cut[1:]), strict=True)):
            # Classes are named once a row; a key is six bytes (its shard says the rest) and an index into the names.
            used, index = np.unique(row[own], return_inverse=True)
            short = key[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BYTES :]
            yield pd.DataFrame({
                "shard": [s], "keys": [short.tobytes()], "index": [index.astype("<u2").tobytes()],
                "names": [cids[used].astype("<i8").tobytes()], "more": [more if i == 0 else b""],
            })

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        flat = np.frombuffer(b"".join(f["keys"]), np.uint8).reshape(-1, KEY_BYTES)
        wide = np.zeros((len(flat), 8), np.uint8)
        wide[:, 8 - KEY_BYTES :] = flat
        key = wide.reshape(-1).view("<u8")
        cid = np.concatenate([np.frombuffer(n, "<i8")[np.frombuffer(i, "<u2")] for n, i in zip(f["names"], f["index"], strict=True)])
        order = np.argsort(key, kind="stable")
        key, cid = key[order], cid[order]
        same = np.zeros(len(key), bool)
        same[1:] = key[1:] == key[:-1]
        same[:-1] |= same[1:]
        more = np.frombuffer(b"".join(f["more"]), "<i8").reshape(-1, 2)
        name = _named(key[same], np.full(int(same.sum()), f["shard"].iloc[0], np.int64))
        return pd.DataFrame({"key": np.concatenate([name, more[:, 0]]), "cid": np.concatenate([cid[same], more[:, 1]])})

    dealt = texts.select("cid", "text").mapInPandas(sketch, "shard int, keys binary, index binary, names binary, more binary")
    return dealt.groupBy("shard").applyInPandas(meet, "key long, cid long")


def _shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """By the lower two bytes of the key, which are not sent."""
    return ((key & np.uint64(0xFFFF)).astype(np.int64) * shards) >> 16


def _named(key: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """What a segment is called from here on: the six bytes that are sent, and its shard."""
    return ((key & ~np.uint64(0xFFFF)) | shard.astype(np.uint64)).view(np.int64)


def without_hot(segments: DataFrame, slack: DataFrame) -> DataFrame:
    """The segments (key, cid) without those that each sketch gives up: of its hot ones the hottest, as many as its slack (cid, slack).

    Only rows of hot segments are joined and ranked, those of one sketch at a time.
    """
    hot = segments.groupBy("key").agg(F.count("*").alias("sets")).where(F.col("sets") >= HOT)
    sketch = F.shiftright("key", 16).bitwiseAND(F.lit(0xFF)).cast("int")
    rows = segments.join(hot, "key").join(slack, "cid").withColumn("sketch", sketch)
    rows = rows.withColumn("slack", F.expr("get(filter(slack, t -> shiftright(t, 16) = sketch), 0)").bitwiseAND(F.lit(0xFFFF)))
    rank = F.row_number().over(Window.partitionBy("cid", "sketch").orderBy(F.desc("sets"), "key"))
    up = rows.where("slack > 0").withColumn("rank", rank).where("rank <= slack").select("key", "cid")
    return segments.join(up, ["key", "cid"], "left_anti")


def components(edges: DataFrame, name: str, known: DataFrame | None = None) -> DataFrame:
    """node, label (least node reachable) for the nodes of the edges a, b (of written tables): least labels of neighbours, then
    a jump to the label's label, until nothing changes; each round is a written table, of which only the last is left.
    known: labels that some of these edges gave, to start from."""
    e = edges.select("a", "b").union(edges.select("b", "a")).where(F.col("a") != F.col("b"))
    start = e.union(known.select("node", "label")) if known else e
    labels = start.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"))
    labels = written(labels, f"{name}-labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("m"))
        near = e.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("m").alias("m"))
        new = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = written(new.join(up, "label").select("node", "old", F.least("label", "up").alias("label")), f"{name}-labels")
        changed = new.where(F.col("old") != F.col("label")).limit(1).count()
        discard(labels)
        labels = new
        if not changed:
            out = labels.select("node", "label")
            out.written_at = labels.written_at
            return out


def close_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those that pass the Hamming test, with the sizes of both sets."""
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))

    def test(frames):
        for f in frames:
            apart = np.fromiter((hamming(a, b) for a, b in zip(f["s_a"], f["s_b"], strict=True)), np.int64, len(f))
            keep = apart <= differ_at_most(f["n_a"].to_numpy(np.int64), f["n_b"].to_numpy(np.int64), percent)
            yield f.loc[keep, ["a", "b", "n_a", "n_b"]]

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInPandas(test, "a long, b long, n_a long, n_b long")


def linked_pairs(pairs: DataFrame, rows: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """a, b, linked: whether the pairs (a, b, n_a, n_b; of a written table) are linked, by exact sizes of intersections.

    A leader's pairs are dealt into bins some at a time; each set goes once to each bin that needs it. Repeated pairs meet in
    one bin and count once.
    """
    bins = blocks_for(pairs, (F.col("n_a") + F.col("n_b")) * 8, SHARD_BYTES, 8)
    stars = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(STAR)).alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts"))
    binned = pairs.join(stars, "a").select(F.pmod(F.xxhash64("a", part), F.lit(bins)).cast("int").alias("bin"), "a", "b")
    binned = written(binned, "join-binned")
    ask = binned.select("bin", F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.collect_set("bin").alias("bins"))
    ask = written(rows.join(ask, "cid").select("cid", "rep_doc", "rep_row", "bins"), "join-asks")

    def ship(frames):
        for f in frames:
            for lo, hi in portions(f["text"].tolist()):
                part = f.iloc[lo:hi]
                for cid, to, s in zip(part["cid"].tolist(), part["bins"], shingle_sets(part["text"].tolist(), shingle), strict=True):
                    yield pd.DataFrame({"bin": to, "cid": cid, "shingles": [s.tobytes()] * len(to)})

    sent = docs.join(ask, (docs.doc_id == ask.rep_doc) & (docs.row_hash == ask.rep_row)).select("cid", "text", "bins")
    sent = sent.mapInPandas(ship, "bin int, cid long, shingles binary")

    def verify(p: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        held = {c: np.frombuffer(s, "<u8") for c, s in zip(sets["cid"].tolist(), sets["shingles"], strict=True)}
        done = [pd.DataFrame({"a": [], "b": [], "linked": []})]
        for a, g in p.drop_duplicates(["a", "b"]).groupby("a", sort=False):
            done.append(g[["a", "b"]].assign(linked=linked_with(held[a], [held[b] for b in g["b"].tolist()], percent)))
        return pd.concat(done[1:] or done)

    found = written(binned.groupBy("bin").cogroup(sent.groupBy("bin")).applyInPandas(verify, "a long, b long, linked boolean"), "join-links")
    discard(ask, binned)
    return found


def linked_with(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted sets are linked with the one, in whole numbers."""
    n = np.fromiter(map(len, others), np.int64, len(others))
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = np.add.reduceat((one[at] == flat).astype(np.int64), np.cumsum(n) - n)
    return 100 * both >= percent * (len(one) + n - both)


def across_families(members: DataFrame, classes: DataFrame, tried: DataFrame, nearest: int, percent: int) -> DataFrame:
    """r, a, b, n_a, n_b, new, more: pairs of different families (key, cid, family) in one segment that pass the Hamming test; new:
    among the `nearest` of the set r, and not a tried one (a pair can come once for either set); more: r has more such pairs,
    which one row of each set says. A written table."""
    sizes = members.groupBy("key", "family").agg(F.count("*").alias("k"))
    keys = sizes.groupBy("key").agg(F.count("*").alias("families"), F.sum("k").alias("all"), F.max(F.struct("k", "family")).alias("largest"))
    keys = keys.where("families > 1")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(CELL)))
    keys = keys.select(
        "key", F.col("largest.family").alias("main"), blocks(F.col("largest.k")).alias("mains"), blocks(F.col("all") - F.col("largest.k")).alias("others")
    )
    live = members.join(keys, "key").withColumn("rest", F.col("family") != F.col("main"))
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("rest"), F.col("others")).otherwise(F.col("mains")))
    live = live.withColumn("own", own)
    # A cell (x, y): block x of the others against block y of the main family, or, with y from `mains` on, of the others.
    to = F.expr(
        """case when mains = 1 and others = 1 then array(struct(0L as x, 0L as y))
           when not rest then transform(sequence(0L, others - 1), x -> struct(x as x, own as y))
           else concat(transform(sequence(0L, mains - 1), y -> struct(own as x, y as y)),
                       transform(sequence(0L, others - 1), o -> struct(least(own, o) as x, mains + greatest(own, o) as y))) end"""
    )
    cells = live.select("key", "cid", "family", "rest", "own", F.explode(to).alias("cell"))
    cells = written(cells.select(F.xxhash64("key", "cell").alias("cell"), "cid", "family", "rest"), "join-cells")
    rows = cells.join(classes.select("cid", "n", "sketch"), "cid")
    bins = blocks_for(cells.join(classes.select("cid", F.length("sketch").alias("size")), "cid"), F.col("size") + 64, SHARD_BYTES, 8)

    def search(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["cell", "cid"]).drop_duplicates(["cell", "cid"])
        cid, family, n = f["cid"].to_numpy(np.int64), f["family"].to_numpy(np.int64), f["n"].to_numpy(np.int64)
        rest, sketches = f["rest"].to_numpy(bool), f["sketch"].tolist()
        cell = f["cell"].to_numpy(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        size = np.diff(np.append(begin, len(cell)))
        found = [_close_in_small(np.repeat(begin + size, size), np.repeat(size, size) <= SMALL_CELL, n, family, sketches, percent)]
        for lo, k in zip(begin[size > SMALL_CELL].tolist(), size[size > SMALL_CELL].tolist(), strict=True):
            found += [x + np.array([[lo], [lo], [0]]) for x in _close_in_large(sketches[lo : lo + k], n[lo : lo + k], family[lo : lo + k], rest[lo : lo + k], nearest, percent)]
        i, j, apart = np.concatenate(found, axis=1)
        # A pair that several cells have counts once; of each set the nearest of each family, then the nearest of all.
        pick = np.unique(np.stack([cid[i], cid[j]], axis=1), axis=0, return_index=True)[1]
        i, j, apart = i[pick], j[pick], apart[pick]
        keep = _first(cid[i], family[j], apart, a_family(nearest))
        keep = keep[_first(cid[i[keep]], np.zeros(len(keep), np.int64), apart[keep], nearest)]
        left_out = np.ones(len(i), bool)
        left_out[keep] = False
        more = np.isin(cid[i[keep]], cid[i[left_out]])
        i, j, apart = i[keep], j[keep], apart[keep]
        return pd.DataFrame({"r": cid[i], "f": cid[j], "n_r": n[i], "n_f": n[j], "apart": apart, "more": more})

    schema = "r long, f long, n_r long, n_f long, apart long, more boolean"
    found = rows.groupBy(F.pmod("cell", F.lit(bins)).alias("bin")).applyInPandas(search, schema)
    found = written(found, "join-near")
    size = lambda x, y: F.when(F.col("r") < F.col("f"), F.col(x)).otherwise(F.col(y))
    pair = [F.least("r", "f").alias("a"), F.greatest("r", "f").alias("b"), size("n_r", "n_f").alias("n_a"), size("n_f", "n_r").alias("n_b")]
    ranked = found.select("r", *pair, "apart", "more").join(tried.select("a", "b", F.lit(True).alias("old")), ["a", "b"], "left")
    # All that follows is of one set at a time: dealt out by it once. A pair that several bins have counts once.
    ranked = ranked.repartition("r").groupBy("r", "a", "b", "n_a", "n_b", "apart").agg(F.bool_or("more").alias("more"), F.coalesce(F.bool_or("old"), F.lit(False)).alias("old"))
    of_set = Window.partitionBy("r")
    ranked = ranked.withColumn("place", F.row_number().over(of_set.orderBy("old", "apart", "a", "b")))
    ranked = ranked.withColumn("more", F.bool_or("more").over(of_set) | (F.count_if(~F.col("old")).over(of_set) > nearest))
    new = ~F.col("old") & (F.col("place") <= nearest)
    ranked = ranked.select("r", "a", "b", "n_a", "n_b", new.alias("new"), (F.col("more") & (F.col("place") == 1)).alias("more"))
    ranked = written(ranked.where("new or more"), "join-ranked")
    discard(cells, found)
    return ranked


def a_family(nearest: int) -> int:
    """How many of the nearest sets may be of one family."""
    return -(-nearest // 4)


def _first(one: np.ndarray, two: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` rows of least value of each (one, two)."""
    order = np.lexsort((value, two, one))
    o, t = one[order], two[order]
    head = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (t[1:] != t[:-1])])[: len(o)])
    size = np.diff(np.append(head, len(o)))
    return order[np.arange(len(o)) - np.repeat(head, size) < most]


def _may_link(n_i, n_j, percent: int):
    return np.abs(n_i - n_j) * (100 + percent) <= (n_i + n_j) * (100 - percent)


def _close_in_small(end: np.ndarray, small: np.ndarray, n: np.ndarray, family: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """(row, other row, Hamming distance), both ways, of all close pairs of different families in the small cells at once; `end`
    is where each row's cell ends."""
    left, right = [], []
    at = np.flatnonzero(small)
    step = 1
    while len(at):
        at = at[at + step < end[at]]
        ok = (family[at] != family[at + step]) & _may_link(n[at], n[at + step], percent)
        left.append(at[ok])
        right.append(at[ok] + step)
        step += 1
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    words = np.fromiter(map(len, sketches), np.int64, len(sketches)) // 8
    offset = np.cumsum(words) - words
    flat = np.frombuffer(b"".join(sketches), "<u8")
    low = np.minimum(words[i], words[j])
    apart = np.zeros(len(i), np.int64)
    for w in np.unique(low).tolist():
        for a, b in np.unique(np.stack([words[i], words[j]], axis=1)[low == w], axis=0).tolist():
            pick = np.flatnonzero((words[i] == a) & (words[j] == b))
            for lo in range(0, len(pick), 4_000_000 // (a + b)):
                part = pick[lo : lo + 4_000_000 // (a + b)]
                x = np.bitwise_xor.reduce(flat[offset[i[part], None] + np.arange(a)].reshape(len(part), -1, w), axis=1)
                y = np.bitwise_xor.reduce(flat[offset[j[part], None] + np.arange(b)].reshape(len(part), -1, w), axis=1)
                apart[part] = np.bitwise_count(x ^ y).sum(axis=1)
    ok = apart <= differ_at_most(n[i], n[j], percent)
    i, j, apart = i[ok], j[ok], apart[ok]
    return np.stack([np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([apart, apart])])


def _close_in_large(sketches: list[bytes], n: np.ndarray, family: np.ndarray, rest: np.ndarray, nearest: int, percent: int):
    """The same of one large cell, from its sets outside the main family to all, some rows at a time; of each set and family
    only one more than `nearest`."""
    parts = [np.frombuffer(s, "<u8") for s in sketches]
    words = min(map(len, parts))
    bits = np.stack([fold(s, words) for s in parts])
    who = np.flatnonzero(rest)
    step = max(1, 2_000_000 // len(n))
    for lo in range(0, len(who), step):
        r = who[lo : lo + step]
        apart = np.zeros((len(r), len(n)), np.int32)
        for w in range(words):
            apart += np.bitwise_count(bits[r, None, w] ^ bits[None, :, w])
        i, j = np.nonzero((apart <= differ_at_most(n[r, None], n[None, :], percent)) & (family[r, None] != family[None, :]))
        if len(i):
            h = apart[i, j].astype(np.int64)
            keep = _first(i, family[j], h, nearest + 1)
            yield np.stack([r[i[keep]], j[keep], h[keep]])


def join_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_hash, n_shingles, component_id for every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("row_hash", F.xxhash64("text"))
    rows = written(measured(d, shingle, percent), "join-rows")
    held = rows.where("n > 0 and doc_id is not null")
    same = ["n", "d1", "d2"]
    first = F.min(F.struct("doc_id", "row_hash", "bytes")).alias("least")
    rep = [F.col("least.doc_id").alias("rep_doc"), F.col("least.row_hash").alias("rep_row"), F.col("least.bytes").alias("bytes")]
    classes = written(held.groupBy(*same).agg(first).select(F.monotonically_increasing_id().alias("cid"), *same, *rep), "join-classes")
    reps = classes.select("cid", "rep_doc", "rep_row")
    chosen = held.join(reps, (held.doc_id == reps.rep_doc) & (held.row_hash == reps.rep_row)).select("cid", "n", "sketch", "slack").dropDuplicates(["cid"])
    texts = d.join(reps, (d.doc_id == reps.rep_doc) & (d.row_hash == reps.rep_row)).select("cid", "text")
    shards = min(1 << 15, blocks_for(classes, F.col("bytes"), SHARD_BYTES, 8))
    shared = written(shared_segments(texts, shards, shingle, percent), "join-shared")
    members = shared.select("cid").distinct()
    sketches = written(chosen.join(members, "cid", "left_semi"), "join-sketches")
    segments = written(without_hot(shared, sketches.select("cid", "slack")), "join-segments")
    discard(shared)

    # Each set with the leader that it shares most segments with.
    leaders = segments.groupBy("key").agg(F.min("cid").alias("a"))
    led = segments.withColumnRenamed("cid", "b").join(leaders, "key").where("a < b").repartition("b").groupBy("a", "b").agg(F.count("*").alias("k"))
    led = led.groupBy("b").agg(F.max(F.struct("k", -F.col("a"))).alias("m")).select((-F.col("m.col2")).alias("a"), "b")
    led = written(close_pairs(led, sketches, percent), "join-led")
    verified = [linked_pairs(led, reps, d, shingle, percent)]
    discard(led)

    def pairs(linked: bool) -> DataFrame:
        """Of the pairs verified so far those that are linked, or those that are not."""
        return reduce(DataFrame.union, verified).where(F.col("linked") == linked).select("a", "b")

    families, nearest, live = components(pairs(True), "join-families"), FIRST, segments
    while True:
        now = live.join(families, live.cid == families.node, "left").select("key", "cid", F.coalesce("label", "cid").alias("family"))
        ranked = across_families(now, sketches, pairs(False), nearest, percent)
        new, more = ranked.where("new").select("a", "b", "n_a", "n_b"), ranked.where("more").select(F.col("r").alias("cid"))
        if new.limit(1).count():
            verified.append(linked_pairs(new, reps, d, shingle, percent))
            if verified[-1].where("linked").limit(1).count():
                families, known = components(pairs(True), "join-families", families), families
                discard(known)
        left = more.limit(1).count()
        if left:  # only segments of sets that have more pairs can hold any
            open_ = written(live.join(live.join(more, "cid").select("key").distinct(), "key", "left_semi"), "join-open")
        discard(ranked, live)
        if not left:
            break
        live, nearest = open_, nearest * MORE
    # Rows of one id are one document.
    of_doc = written(held.join(classes.select("cid", *same), same).select("doc_id", "cid"), "join-docs")
    several = of_doc.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z").select("doc_id", "a")
    several = written(of_doc.join(several, "doc_id").where("a < cid").select("a", F.col("cid").alias("b")), "join-several")
    if several.limit(1).count():
        families, known = components(pairs(True).union(several), "join-families", families), families
        discard(known)
    named = of_doc.join(families, of_doc.cid == families.node, "left").select("doc_id", F.coalesce("label", "cid").alias("family")).distinct()
    least = named.groupBy("family").agg(F.min("doc_id").alias("component_id"))
    least = written(named.join(least, "family").select(F.col("doc_id").alias("l_doc"), "component_id"), "join-components")
    slim = written(rows.select("doc_id", "row_hash", F.col("n").alias("n_shingles")), "join-sizes")
    discard(rows, classes, sketches, families, several, of_doc, *verified)
    out = slim.join(least, F.col("doc_id") == least.l_doc, "left")
    return out.select("doc_id", "row_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, without those whose component has a smaller id."""
    c = join_components(docs, shingle, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("copy_id")).distinct()
    d = docs.select(*[F.col(f"`{x}`") for x in docs.columns])
    return d.join(c, d.doc_id == c.copy_id, "left_anti")


def op6_parity_join(spark, sf_dir):
    return join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
