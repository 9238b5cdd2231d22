"""Exact substring dedup with a hash-compared suffix sort.

Removes each byte covered by a string of MIN_BYTES bytes that also starts in a document with a smaller id.

The suffix sort compares two suffixes by prefix polynomial hashes: a binary search finds how far they agree, so that a
comparison takes logarithmic time, and a mergesort of all runs at once puts the suffixes in order; what the hashes call
equal is verified on the bytes. Only suffixes that can matter are sorted. Every window of MIN_BYTES bytes is known by
the seed with the least hash in it (equal windows have equal seeds at equal places), and successive windows with one
seed form a context of at most 2 * MIN_BYTES bytes:

1. each block of documents (bounded bytes, dealt by id) sends its distinct seeds, four bytes each, to seed shards, which
   answer with the bits of the seeds that more than one document holds;
2. the block names the distinct contexts of these seeds, each with its smallest document; where several contexts share
   a seed, the shard asks one block for the bytes of each, sorts two suffixes of each (what follows the seed, and what
   is before it, backwards), and tells every block that holds them the smallest document of each window;
3. the block covers the windows that a smaller document holds and digests what is left.

All steps read one shuffle of the texts, and no context's bytes are sent twice. A line or a document that a third of all rows hold is one request a
block, so no shard gets a row for each copy.

Defined results
* null or empty text: no bytes, nothing removed; texts shorter than MIN_BYTES lose nothing.
* a null doc_id counts as smaller than all others; rows that repeat an id are one document, which never loses what only
  they hold, and each such row has its own result row; an empty table gives an empty result.
* other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_work, blocks_for, table

MIN_BYTES = 50
SEED_BYTES = 20
BLOCK_BYTES = 3_000_000
SHARD_BYTES = 12_000_000
SLAB = 1 << 15
LEAD = 8  # bytes of a suffix that are one number
VERIFIED = 200_000  # suffixes at a time whose bytes are compared
NO_ID = -(1 << 63)

BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(of: int, n: int) -> np.ndarray:
    """of**0 to of**(n - 1), modulo 2**64."""
    if of not in _powers or len(_powers[of]) < n:
        p = np.full(max(n, 1 << 16), of, np.uint64)
        p[0] = 1
        _powers[of] = np.cumprod(p)
    return _powers[of][:n]


class Prefixes:
    """Prefix polynomial hashes of a byte string; of(i, n) hashes the n bytes from i on, for arrays of both."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_INVERSE, len(data)), out=self.sums[1:])
        self.scale = powers(BASE, len(data) + 1)

    def of(self, at: np.ndarray, n) -> np.ndarray:
        return mixed((self.sums[at + n] - self.sums[at]) * self.scale[at])

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.sums[a + n] - self.sums[a]) * self.scale[a] == (self.sums[b + n] - self.sums[b]) * self.scale[b]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def common_extension(p: Prefixes, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at a and b share, up to `most`: binary search over equal prefix hashes."""
    out = most.astype(np.int64).copy()
    open_ = np.flatnonzero(~p.equal(a, b, out))  # the others agree all the way
    low, high = np.zeros(len(open_), np.int64), out[open_] - 1
    a, b = a[open_], b[open_]
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = p.equal(a, b, mid)
        low = np.where(same, mid, low)
        high = np.where(same, high, mid - 1)
    out[open_] = low
    return out


def suffix_sort(data: np.ndarray, starts: np.ndarray, group: np.ndarray, limit: int | None = None, p: Prefixes | None = None) -> np.ndarray:
    """Order of the suffixes (indexes into starts) by group, then by their bytes up to limit; ties keep their order.

    A bottom-up mergesort of those that share their first LEAD bytes: at each level every element finds its place among
    the run beside its own by binary search, for all runs of all groups at once.
    """
    p = p or Prefixes(data)
    reach = len(data) - starts if limit is None else np.minimum(limit, len(data) - starts)
    lead = np.zeros(len(starts), np.uint64)  # what ends before is less, or the same and then shorter
    for i in range(LEAD):
        there = i < reach
        lead <<= np.uint64(8)
        lead[there] |= data[starts[there] + i]
    order = np.lexsort((lead, group))
    g, lead = group[order], lead[order]
    first = np.concatenate([[True], (g[1:] != g[:-1]) | (lead[1:] != lead[:-1])]) if len(g) else np.zeros(0, bool)
    begin = np.flatnonzero(first)
    sizes = np.diff(np.concatenate([begin, [len(g)]]))
    g_begin, g_size = np.repeat(begin, sizes), np.repeat(sizes, sizes)

    def less(a, b, or_equal):
        x, y = starts[a], starts[b]
        most = np.minimum(reach[a], reach[b])
        n = common_extension(p, x, y, most)
        at_end = n >= most
        cx = data[np.minimum(x + n, len(data) - 1)]
        cy = data[np.minimum(y + n, len(data) - 1)]
        shorter = (reach[a] <= reach[b]) if or_equal else (reach[a] < reach[b])
        return np.where(at_end, shorter, cx < cy)

    width = 1
    while len(sizes) and width < sizes.max():
        live = np.flatnonzero(g_size > width)
        rank = live - g_begin[live]
        run = rank // width
        pair = g_begin[live] + (run // 2) * 2 * width
        other_begin = np.where(run % 2 == 0, pair + width, pair)
        end = g_begin[live] + g_size[live]
        other_begin, other_end = np.minimum(other_begin, end), np.minimum(other_begin + width, end)
        low, high = other_begin.copy(), other_end.copy()
        right = run % 2 == 1
        own = order[live]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            theirs = order[mid]
            # An element of the left run goes after those of the right run that are less; one of the right run goes
            # after those of the left run that are less or equal.
            r = right[open_]
            before = np.empty(len(open_), bool)
            if r.any():
                before[r] = less(theirs[r], own[open_][r], True)
            if (~r).any():
                before[~r] = less(theirs[~r], own[open_][~r], False)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        to = pair + rank % width + (low - other_begin)
        merged = order.copy()
        merged[to] = own
        order = merged
        width *= 2
    return order


class Contexts:
    """A block's windows, gathered into contexts: begin (first window), count (windows), seed_at, seed, key, doc."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, docs: np.ndarray, min_bytes: int, seed_bytes: int):
        p = self.p = Prefixes(data)
        last = length - min_bytes  # the last window of each document, from its begin
        row = np.flatnonzero(last >= 0)
        low, high = begin[row], (begin + last)[row]
        seed_at = _seeds_of_windows(p, len(data), min_bytes, seed_bytes)
        turns = np.flatnonzero(seed_at[1:] != seed_at[:-1]) + 1
        # A context begins where the seed changes within a document's windows, and at the document's first window.
        owner = np.searchsorted(low, turns, "right") - 1
        inside = (owner >= 0) & (turns > low[owner]) & (turns <= high[owner]) if len(low) else np.zeros(len(turns), bool)
        first = np.concatenate([low, turns[inside]])
        who = np.concatenate([np.arange(len(low)), owner[inside]])
        order = np.argsort(first, kind="stable")
        self.begin, who = first[order], who[order]
        after = np.concatenate([self.begin[1:], [0]])
        ends = np.concatenate([who[1:] != who[:-1], [True]])[: len(who)]
        self.count = np.where(ends, high[who] + 1, after[: len(who)]) - self.begin
        self.seed_at = seed_at[self.begin].astype(np.int64)
        self.seed = p.of(self.seed_at, seed_bytes)
        self.doc = docs[row[who]]
        whole = p.of(self.begin, self.count + min_bytes - 1)
        self.key = mixed(whole + self.count.astype(np.uint64) * np.uint64(0x94D049BB133111EB) + (self.seed_at - self.begin).astype(np.uint64))


def _seeds_of_windows(p: Prefixes, size: int, min_bytes: int, seed_bytes: int) -> np.ndarray:
    """Where the seed of the window at each place lies, over all places, slab by slab so that the work stays in cache."""
    windows = max(0, size - min_bytes + 1)
    out = np.zeros(windows, np.int32)
    for lo in range(0, windows, SLAB):
        hi = min(windows, lo + SLAB)
        end = hi + min_bytes - seed_bytes  # seeds begin in lo to end - 1
        h = mixed((p.sums[lo + seed_bytes : end + seed_bytes] - p.sums[lo:end]) * p.scale[lo:end])
        out[lo:hi] = _least(h, min_bytes - seed_bytes + 1) + lo
    return out


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each `width` successive hashes lies; of equal ones (by their upper bits) the first."""
    low = np.uint64((SLAB << 1) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    done = 1
    while done * 2 <= width:
        m = np.minimum(m[: len(m) - done], m[done:])
        done *= 2
    rest = width - done
    if rest:
        m = np.minimum(m[: len(m) - rest], m[rest:])
    return (m & low).astype(np.int32)


def _read_block(f: pd.DataFrame):
    """The block's rows in a fixed order: raw texts, their bytes one after another, begins, lengths, ids."""
    at_work("suffixes", _powers.clear)
    raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in f["text"]]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    docs = f["doc_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)
    return raw, data, np.cumsum(length) - length, length, docs


def _least_doc(key: np.ndarray, doc: np.ndarray):
    """Distinct keys, the first place of each, its least document, and the most, and each place's distinct key."""
    order = np.lexsort((doc, key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(k)]]) - 1
    which = np.empty(len(k), np.int64)
    which[order] = np.cumsum(new) - 1
    return k[first], order[first], doc[order[first]], doc[order[last]] if len(k) else doc[:0], which


def _dealt(to: np.ndarray):
    """(receiver, the places of what goes there, in their order) for each receiver: one sort, not a pass for each."""
    order = np.argsort(to, kind="stable")
    first = np.flatnonzero(np.diff(to[order], prepend=-1))
    return zip(to[order[first]].tolist(), np.split(order, first[1:]) if len(first) else [], strict=True)


def _agreements(view: np.ndarray, at: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How many bytes each suffix shares with the one before it in order, read from the bytes themselves; -1 where a group begins."""
    out = np.full(len(order), -1)
    near = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1
    for lo in range(0, len(near), VERIFIED):
        part = near[lo : lo + VERIFIED]
        differ = view[at[order[part]]] != view[at[order[part - 1]]]
        out[part] = np.where(differ.any(axis=1), differ.argmax(axis=1), view.shape[1])
    return out


def _window_minima(data, begin, count, offset, seed, doc, min_bytes, seed_bytes):
    """For distinct contexts: the least document of each of their windows, context after context.

    Windows of contexts whose seed no other context has belong to their own document. Of the others two suffixes a context
    are sorted, whatever its windows: the bytes after its seed, and those before it, backwards. Windows are equal where
    they begin as far before one seed and their contexts agree that far backwards and for the rest of the window forwards;
    contexts that agree so far lie together in both orders, between neighbours whose bytes, compared, agree so far.
    """
    start = np.cumsum(count) - count
    out = np.repeat(doc, count)
    seeds, which, n = np.unique(seed, return_inverse=True, return_counts=True)
    pick = np.flatnonzero(n[which] > 1)
    if not len(pick):
        return out
    group, doc, offset, least_back = which[pick], doc[pick], offset[pick], (offset - count)[pick] + 1
    padded = np.concatenate([np.zeros(min_bytes, np.uint8), data, np.zeros(min_bytes, np.uint8)])
    at = begin[pick] + offset + min_bytes
    places, agreed = [], []
    for side, starts, limit, same in ((padded, at, min_bytes, seed_bytes), (padded[::-1].copy(), len(padded) - at, int(offset.max()), 0)):
        order = suffix_sort(side, starts + same, group, limit - same)
        view = np.lib.stride_tricks.sliding_window_view(np.concatenate([side, side[:limit]]), max(1, limit))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        places.append(place)
        agreed.append(_agreements(view, starts, order, group))
    for back in range(int(least_back.min()), int(offset.max()) + 1):
        m = np.flatnonzero((least_back <= back) & (back <= offset))
        forward_class, back_class = (np.cumsum(g < far)[p[m]] for g, far, p in zip(agreed, (min_bytes - back, back), places, strict=True))
        window = back_class * (len(pick) + 1) + forward_class
        order = np.argsort(window)
        head = np.flatnonzero(np.diff(window[order], prepend=-1))
        least = np.minimum.reduceat(doc[m][order], head) if len(m) else doc[m]
        out[start[pick[m[order]]] + offset[m[order]] - back] = np.repeat(least, np.diff(head, append=len(m)))
    return out


def _flow(docs: DataFrame, min_bytes: int, seed_bytes: int, with_text: bool) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    blocks = blocks_for(d, F.octet_length("text"), BLOCK_BYTES, 4)
    shards = max(4, -(-blocks * BLOCK_BYTES // SHARD_BYTES))
    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))

    def seeds(f: pd.DataFrame) -> pd.DataFrame:
        _, data, begin, length, ids = _read_block(f)
        c = Contexts(data, begin, length, ids, min_bytes, seed_bytes)
        seed, _, least, most, _ = _least_doc(c.seed, c.doc)
        value = ((seed >> np.uint64(33)) << np.uint64(1)) | (least != most)
        shard = (seed % np.uint64(shards)).astype(np.int64)
        rows = [(s, value[own].astype("<u4").tobytes()) for s, own in _dealt(shard)]
        return pd.DataFrame({"shard": [r[0] for r in rows], "block": f["block"].iloc[0] if len(f) else 0, "seeds": [r[1] for r in rows]})

    def shared(f: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(s, "<u4") for s in f["seeds"]]
        flat = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
        value = flat >> 1
        ordered = np.sort(value)
        more = np.zeros(len(value), bool)
        if len(value):
            repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            at = np.minimum(np.searchsorted(repeated, value), max(0, len(repeated) - 1))
            more = (repeated[at] == value) if len(repeated) else more
        more |= (flat & 1).astype(bool)
        cut = np.cumsum([len(x) for x in lists])[:-1]
        return pd.DataFrame({"block": f["block"], "shard": f["shard"], "bits": [np.packbits(x).tobytes() for x in np.split(more, cut)]})

    def contexts(f: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame({"shard": [], "block": [], "head": []})
        _, data, begin, length, ids = _read_block(f)
        c = Contexts(data, begin, length, ids, min_bytes, seed_bytes)
        seed, _, _, _, which = _least_doc(c.seed, c.doc)
        told = np.zeros(len(seed), bool)
        places = dict(_dealt((seed % np.uint64(shards)).astype(np.int64)))
        for s, b in zip(bits["shard"], bits["bits"], strict=True):
            own = places[s]
            told[own] = np.unpackbits(np.frombuffer(b, np.uint8), count=len(own)).astype(bool)
        live = np.flatnonzero(told[which])
        key, first, least, _, _ = _least_doc(c.key[live], c.doc[live])
        at = live[first]
        to = (c.seed[at] % np.uint64(shards)).astype(np.int64)
        rows = []
        for s, own in _dealt(to):
            m = at[own]
            head = np.zeros(len(m), HEAD)
            head["seed"], head["key"], head["doc"] = c.seed[m], key[own], least[own]
            head["count"], head["offset"] = c.count[m], c.seed_at[m] - c.begin[m]
            rows.append((s, head.tobytes()))
        return pd.DataFrame({"shard": [r[0] for r in rows], "block": f["block"].iloc[0], "head": [r[1] for r in rows]})

    def asks(f: pd.DataFrame) -> pd.DataFrame:
        """Of the contexts that share their seed with another context, each from the first block that has it."""
        f = f.sort_values("block")
        heads = [np.frombuffer(h, HEAD) for h in f["head"]]
        head = np.concatenate(heads)
        source = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
        key, first = np.unique(head["key"], return_index=True)
        seeds, n = np.unique(head["seed"][first], return_counts=True)
        pick = first[n[np.searchsorted(seeds, head["seed"][first])] > 1]
        rows = [(f["block"].iloc[b], head["key"][pick[own]].tobytes()) for b, own in _dealt(source[pick])]
        return pd.DataFrame({"block": [r[0] for r in rows], "shard": f["shard"].iloc[0], "keys": [r[1] for r in rows]})

    def gives(f: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"shard": asked["shard"], "keys": asked["keys"]})
        if not len(f) or not len(asked):
            return out.iloc[:0].assign(bytes=[])
        _, data, begin, length, ids = _read_block(f)
        c = Contexts(data, begin, length, ids, min_bytes, seed_bytes)
        key, first = np.unique(c.key, return_index=True)
        texts = []
        for k in asked["keys"]:
            m = first[np.searchsorted(key, np.frombuffer(k, "<u8"))]
            n = c.count[m] + min_bytes - 1
            texts.append(data[np.repeat(c.begin[m] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes())
        return out.assign(bytes=texts)

    def minima(f: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame(columns=["block", "keys", "per", "runs", "docs"])
        heads = [np.frombuffer(h, HEAD) for h in f["head"]]
        head = np.concatenate(heads)
        key, first, least, _, which = _least_doc(head["key"], head["doc"])
        count = head["count"][first].astype(np.int64)
        data = np.frombuffer(b"".join(given["bytes"]), np.uint8)
        there = np.searchsorted(key, np.frombuffer(b"".join(given["keys"]), "<u8"))
        n = count[there] + min_bytes - 1
        begin = np.full(len(key), -1)
        begin[there] = np.cumsum(n) - n
        windows = _window_minima(data, begin, count, head["offset"][first].astype(np.int64), head["seed"][first], least, min_bytes, seed_bytes)
        start = np.cumsum(count) - count
        lowest = np.minimum.reduceat(windows, start) if len(count) else windows
        source = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
        need = np.flatnonzero(lowest[which] < head["doc"])
        out = []
        for b, own in _dealt(source[need]):
            w = which[need[own]]
            c = count[w]
            flat = windows[np.repeat(start[w] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))]
            # Runs of windows with one document: most contexts are a single run.
            new = np.ones(len(flat), bool)
            new[1:] = flat[1:] != flat[:-1]
            new[np.cumsum(c) - c] = True
            at = np.flatnonzero(new)
            per = np.add.reduceat(new, np.cumsum(c) - c).astype(np.uint8)
            runs = np.diff(np.concatenate([at, [len(flat)]])).astype(np.uint8)
            out.append((f["block"].iloc[b], key[w].tobytes(), per.tobytes(), runs.tobytes(), flat[at].astype("<i8").tobytes()))
        return pd.DataFrame(out, columns=["block", "keys", "per", "runs", "docs"])

    def cover(f: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame(columns=columns)
        raw, data, begin, length, ids = _read_block(f)
        c = Contexts(data, begin, length, ids, min_bytes, seed_bytes)
        key, _, least, _, which = _least_doc(c.key, c.doc)
        change = np.zeros(len(data) + 1, np.int64)

        def mark(first, windows):
            np.add.at(change, first, 1)
            np.add.at(change, first + windows + min_bytes - 1, -1)

        own = least[which] < c.doc
        mark(c.begin[own], c.count[own])
        if len(told):
            join = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in told[name]])
            keys, per, runs, doc = join("keys", "<u8"), join("per", np.uint8).astype(np.int64), join("runs", np.uint8).astype(np.int64), join("docs", "<i8")
            order = np.argsort(keys, kind="stable")
            at = np.minimum(np.searchsorted(keys[order], key), len(keys) - 1)
            reply = np.where(keys[order][at] == key, order[at], -1)[which]
            first_run = np.cumsum(per) - per
            offset = np.cumsum(runs) - runs
            asks = np.flatnonzero(reply >= 0)
            r = reply[asks]
            context = np.repeat(asks, per[r])
            run = np.repeat(first_run[r] - (np.cumsum(per[r]) - per[r]), per[r]) + np.arange(int(per[r].sum()))
            skip = offset[run] - offset[first_run[reply[context]]]
            hit = doc[run] < c.doc[context]
            mark(c.begin[context][hit] + skip[hit], runs[run][hit])
        covered = np.cumsum(change[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(covered)])
        rise = covered.copy()
        rise[1:] &= ~covered[:-1]
        rise[begin[length > 0]] = covered[begin[length > 0]]
        rises = np.concatenate([[0], np.cumsum(rise)])
        end = begin + length
        kept_all = data[~covered].tobytes()
        rows = []
        for i in range(len(raw)):
            lo, hi = int(begin[i] - before[begin[i]]), int(end[i] - before[end[i]])
            kept = kept_all[lo:hi]
            row = [int(length[i]), int(before[end[i]] - before[begin[i]]), int(rises[end[i]] - rises[begin[i]]), hashlib.sha256(kept).hexdigest()]
            if with_text:
                flags = covered[begin[i] : end[i]].astype(np.int8)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]])))
                row += [edges.tolist(), kept, hashlib.sha256(raw[i]).hexdigest()]
            rows.append(row)
        out = pd.DataFrame(rows, columns=columns[1:])
        out.insert(0, "doc_id", f["doc_id"].astype("Int64").array)
        return out

    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["edges", "kept", "text_sha256"] * with_text
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", edges array<long>, kept binary, text_sha256 string" if with_text else ""
    asked = d.groupBy("block").applyInPandas(seeds, "shard long, block int, seeds binary")
    bits = asked.groupBy("shard").applyInPandas(shared, "block int, shard long, bits binary")
    sent = d.groupBy("block").cogroup(bits.groupBy("block")).applyInPandas(contexts, "shard long, block int, head binary")
    wanted = sent.groupBy("shard").applyInPandas(asks, "block int, shard long, keys binary")
    given = d.groupBy("block").cogroup(wanted.groupBy("block")).applyInPandas(gives, "shard long, keys binary, bytes binary")
    told = sent.groupBy("shard").cogroup(given.groupBy("shard")).applyInPandas(minima, "block int, keys binary, per binary, runs binary, docs binary")
    return d.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(cover, schema)


HEAD = np.dtype([("seed", "<u8"), ("key", "<u8"), ("doc", "<i8"), ("count", "u1"), ("offset", "u1")])


def repeated_spans(docs: DataFrame, min_bytes: int = MIN_BYTES, seed_bytes: int = SEED_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, edges (begin and end of each removed span, in bytes), kept
    (the bytes left) and text_sha256 (of the whole text, to tell apart rows of one id)."""
    return _flow(docs, min_bytes, seed_bytes, True)


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The documents with all their columns; text lacks the repeated spans, and the characters that a cut has split."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    text_hash = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    d = docs.select(row, F.col("doc_id").cast("long").alias("own_id"), text_hash.alias("own_hash"))
    spans = repeated_spans(docs, min_bytes).where("n_removed > 0")
    spans = spans.select(F.col("doc_id").alias("cut_id"), F.col("text_sha256").alias("cut_hash"), F.col("kept").alias("left_over")).dropDuplicates(["cut_id", "cut_hash"])
    j = d.join(spans, F.col("own_id").eqNullSafe(F.col("cut_id")) & (F.col("own_hash") == F.col("cut_hash")), "left")
    text = F.when(F.col("left_over").isNull(), F.col("whole.text")).otherwise(_readable(F.col("left_over")))
    return j.select(*[(text if c == "text" else F.col(f"whole.`{c}`")).alias(c) for c in docs.columns])


def _readable(kept):
    """Bytes as text, without the characters that a cut has split."""

    def read(s: pd.Series) -> pd.Series:
        return s.map(lambda b: b.decode("utf-8", "ignore") if b is not None else None)

    return F.pandas_udf(read, "string")(kept)


def op1_suffix_dedup(spark, sf_dir):
    return _flow(table(spark, sf_dir, "documents"), MIN_BYTES, SEED_BYTES, False)
