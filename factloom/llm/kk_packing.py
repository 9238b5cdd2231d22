"""Packing token sequences by Karmarkar-Karp multiway differencing.

Tokenising and packing happen in one pass over the documents, without a shuffle: every task packs the documents that
it reads. A document longer than a window gives whole windows by itself; what is left of BLOCK documents is partitioned
into windows. Differencing starts with one partial partition an item and always merges the two with the largest
imbalances, largest sums against smallest, which gives near-equal windows. The number of windows starts with the fewest
that could hold the block and rises while one of them exceeds the capacity, as long as at most MAX_PADDING is padding;
what exceeds the capacity at that number is cut off and goes where there is room (documents may be cut freely). Without
a bound on the padding nothing is cut. Items of a few to a window leave differencing too little choice to come within 2 %:
blocks of documents like those of the given tables reach the bound and end in cuts.

Defined results
* null or empty text: only the end id; every document, repeated ids and null ids included, is packed as its own.
* an empty table gives an empty result; other columns of the input are ignored.
* sequence ids are the task's number and a counter within it: unique, but not consecutive across tasks.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import at_work, table

CAPACITY = 2048
END_ID = 1
BLOCK = 1024
MAX_PADDING = 0.02
CACHED_BYTES = 250_000_000
ENTRY_BYTES = 160
RUN_WORDS = 512
RUN_CHARS = 64
WORD_END = "</w>"
# Arrow and \s of `re` also count U+001C to U+001F as white space, which the tokenizer does not.
_NOT_WHITE = re.compile(r"[\x1c-\x1f]")
_WORD = re.compile(r"[\S\x1c-\x1f]+")
# Letters of Latin-1 and symbols of ASCII after them (no apostrophe): the tokenizer parts them there, whatever they are.
_PARTED = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]+)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def difference(sizes: list[int], k: int) -> np.ndarray:
    """The window (0 to k-1) of each item: Karmarkar-Karp differencing of the sizes into k near-equal sums."""
    n = len(sizes)
    if k <= 1 or n <= 1:
        return np.zeros(n, np.int64)
    # A node is (sums, descending, less their least; how its slots come from two children's slots).
    made: list[tuple] = []
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = s
        made.append((i,))
        heap.append((-int(s), i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, sa = heapq.heappop(heap)
        _, b, sb = heapq.heappop(heap)
        sums = sa + sb[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]
        made.append((a, b, order))
        heapq.heappush(heap, (-int(sums[0]), len(made) - 1, sums))
    out = np.zeros(n, np.int64)
    stack = [(heap[0][1], np.arange(k))]  # node, the final window of each of its slots
    while stack:
        node, slot = stack.pop()
        if len(made[node]) == 1:
            out[node] = slot[0]
            continue
        a, b, order = made[node]
        of = np.empty(k, np.int64)
        of[order] = slot
        stack += [(a, of), (b, of[::-1])]
    return out


def pack_items(sizes: list[int], capacity: int = CAPACITY, max_padding: float | None = MAX_PADDING) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start, length) pieces; every unit of every item is in exactly one piece.

    The number of windows rises while one of them exceeds the capacity, up to that whose padding is max_padding (None: as
    far as it takes, for items of at most the capacity); only what exceeds the capacity then is cut.
    """
    if not sizes:
        return []
    total = sum(sizes)
    k = least = max(1, -(-total // capacity))
    most = len(sizes) if max_padding is None else max(least, int(total / (capacity * (1 - max_padding))))
    while True:
        window = difference(sizes, k)
        if k >= most or np.bincount(window, weights=sizes, minlength=k).max() <= capacity:
            break
        k = min(most, k + max(1, k // 100))
    windows: list[list[tuple[int, int, int]]] = [[] for _ in range(k)]
    for i, w in enumerate(window.tolist()):
        windows[w].append((i, 0, sizes[i]))
    used = [sum(p[2] for p in w) for w in windows]
    tails = []
    for w, pieces in enumerate(windows):
        while used[w] > capacity:
            over = used[w] - capacity
            item, start, length = pieces.pop()
            take = min(over, length)
            tails.append((item, start + length - take, take))
            if take < length:
                pieces.append((item, start, length - take))
            used[w] -= take
    room = sorted((w for w in range(k) if used[w] < capacity), key=lambda w: used[w])
    for item, start, length in tails:
        while length:
            w = room[-1]
            put = min(length, capacity - used[w])
            windows[w].append((item, start, put))
            used[w] += put
            start, length = start + put, length - put
            if used[w] == capacity:
                room.pop()
    return [w for w in windows if w]


class _Words:
    """Token ids of words between what the tokenizer counts as white space, kept between batches; no token spans it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(WORD_END)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)  # where each word's ids begin, and where the last one's end
        self.size = 0  # bytes that the words take, about

    def _append(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        first, end = len(self.index), int(self.start[len(self.index)])
        while end + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(words) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.ids[end : end + len(flat)] = flat
        self.start[first + 1 : first + len(words) + 1] = end + np.cumsum(lengths)
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.size += ENTRY_BYTES * len(words) + 4 * len(flat) + sum(map(len, words))

    def learn(self, words: list[str]) -> None:
        """Take up the words (distinct ones) that are new."""
        new = [w for w in words if w not in self.index]
        parted = [m for m in map(_PARTED.fullmatch, new) if m]
        if parted:  # what is put together from known parts needs no tokenizer
            heads, tails = [m[1] for m in parted], [m[2] for m in parted]
            whole = [m[0] for m in parted]
            self._encode(set(new).difference(whole).union(heads, tails).difference(self.index))
            number = lambda of: np.fromiter(map(self.index.__getitem__, of), np.int64, len(of))
            at = np.stack([number(heads), number(tails)], axis=1).ravel()
            lengths = self.start[at + 1] - self.start[at]
            self._append(whole, self._ids_of(at, lengths), lengths.reshape(-1, 2).sum(axis=1))
        else:
            self._encode(set(new))

    def _ids_of(self, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of the words at these places, one after another."""
        return self.ids[np.repeat(self.start[at] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]

    def _encode(self, new: set[str]) -> None:
        # A word of letters is one token run, which ends with an end-of-word id. Such words are encoded many at a time,
        # and the ends say which ids are whose.
        kept = [w for w in new if w.isalpha() and len(w) <= RUN_CHARS]
        parts = [kept[lo : lo + RUN_WORDS] for lo in range(0, len(kept), RUN_WORDS)]
        odd = new.difference(kept)
        for i, e in enumerate(self.tokenizer.encode_batch_fast([" ".join(x) for x in parts], add_special_tokens=False)):
            flat = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.ends[flat])
            if len(ends) != len(parts[i]):  # a letter that the tokenizer takes apart: word by word
                odd.update(parts[i])
                continue
            self._append(parts[i], flat, np.diff(ends + 1, prepend=0))
        if odd:
            odd = list(odd)
            ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
            self._append(odd, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by END_ID, and where each text's ids begin (and the end of all)."""
        split = _split([self._fold(t) for t in texts])
        counts = pc.list_value_length(split).to_numpy()
        if self.size > CACHED_BYTES:
            self.clear()
        # Only a batch's distinct words are looked up one by one.
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        del split
        self.learn(distinct)
        at = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        del words, distinct
        lengths = self.start[at + 1] - self.start[at]
        # The words' ids lie text after text, with one place after each text for the end id.
        ends = np.cumsum(counts)
        text_of_end = np.concatenate([[0], np.cumsum(lengths)])[ends] + np.arange(1, len(texts) + 1)
        total = int(text_of_end[-1]) if len(texts) else 0
        out = np.full(total, END_ID, np.uint32)
        body = np.ones(total, bool)
        body[text_of_end - 1] = False
        out[body] = self._ids_of(at, lengths)
        return out, np.concatenate([[0], text_of_end])

    def _fold(self, text: str) -> str:
        """Lower case where that changes no id: within Latin-1 the tokenizer's own folding does the same, but after it has
        found added tokens, so a text that would hold one of them only when folded stays as it is."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        folded = text.lower()
        return text if any(t in folded for t in self.added) else folded


def _split(texts: list[str]) -> pa.Array:
    """The words of each text; a text without any may have an empty one."""
    if any(map(_NOT_WHITE.search, texts)):
        return pa.array([_WORD.findall(t) for t in texts], pa.list_(pa.large_string()))
    return pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pa.array(texts, pa.large_string())))


_words: dict[str, _Words] = {}


def _packer(path: str, capacity: int, max_padding: float | None, with_ids: bool):
    schema = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def pack(frames):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path not in _words:
            _words[path] = _Words(path)
        w = _words[path]
        at_work("packing", _words.clear)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        for frame in frames:
            for lo in range(0, len(frame), BLOCK):
                docs = frame["doc_id"].iloc[lo : lo + BLOCK].tolist()
                ids, begin = w.encode([t if isinstance(t, str) else "" for t in frame["text"].iloc[lo : lo + BLOCK]])
                rows = []

                def put(d, start, length, offset, ids=ids, begin=begin, docs=docs, rows=rows):
                    piece = ids[begin[d] + start : begin[d] + start + length]
                    crc = zlib.crc32(piece.astype("<u4", copy=False).tobytes())
                    rows.append((docs[d], start, length, crc, int(begin[d + 1] - begin[d]), sequence, offset, *[piece.astype(np.int32)] * with_ids))

                rest = []
                for d, n in enumerate(np.diff(begin).tolist()):
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):
                        put(d, start, capacity, 0)
                        sequence += 1
                    if n > whole:
                        rest.append((d, whole, n - whole))
                for window in pack_items([r[2] for r in rest], capacity, max_padding):
                    offset = 0
                    for item, start, length in window:
                        put(rest[item][0], rest[item][1] + start, length, offset)
                        offset += length
                    sequence += 1
                out = pd.DataFrame(rows, columns=schema)
                out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
                yield out

    return pack


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, max_padding: float | None = MAX_PADDING, with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, the ids."""
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if with_ids else ""
    d = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return d.mapInPandas(_packer(tokenizer or default_tokenizer(), capacity, max_padding, with_ids), schema)


def op7_kk_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
