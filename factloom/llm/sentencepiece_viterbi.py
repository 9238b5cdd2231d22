"""SentencePiece encoding and decoding by batched numpy Viterbi.

The best segmentation into pieces is the one with the largest sum of scores (the unigram rule; the scores are those of
the model file). Pieces never reach over the start of a run of word-boundary marks, so a text falls into words that are
segmented once each: new words of equal length advance together (long ones, as texts without spaces are, with others of
about their length, each read back from its own end), the hashes of their substrings probe the sorted piece keys behind a
table of their low bits, and a vectorised maximum at each place stores the back pointer. A character that no piece covers
becomes its UTF-8 bytes. Encoding is a map over documents and shuffles nothing; the words that a task keeps are bounded in
bytes.

Sums are exact in double precision; of equal sums the longest last piece wins.

Defined results
* null or empty text: no ids. Decoding gives back every text that does not hold U+2581 itself, which reads as a space.
* an id outside the model decodes to nothing; other columns of the input are ignored; repeated rows are kept.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import at_work, table

MARK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
CACHED_BYTES = 200_000_000
ENTRY_BYTES = 260  # of a cached word besides its characters and ids
SPREAD = 1.125  # the longest of the words that advance together, by the shortest
TOGETHER = 4096  # words, and
PLACES = 2_000_000  # places of all words that advance together
PROBE_BITS = 20
_SPLIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of every prefix, for equal-length rows of code points."""
    h = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        h[:, i + 1] = h[:, i] * BASE + codes[:, i] + np.uint64(1)
    return h


class Model:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        normal, byte = 1, 6
        self.dummy_prefix = proto.normalizer_spec.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.score = np.array([p.score for p in proto.pieces])
        self.byte_id = np.zeros(256, np.int64)
        self.is_byte = np.array([p.type == byte for p in proto.pieces])
        usable = [i for i, p in enumerate(proto.pieces) if p.type == normal]
        for i, p in enumerate(proto.pieces):
            if p.type == byte:
                self.byte_id[int(p.piece[1:-1], 16)] = i
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_id)}
        self.longest = max(len(self.pieces[i]) for i in usable)
        self.unknown = self.score[usable].min() - 10.0
        self.power = np.ones(self.longest + 1, np.uint64)
        for i in range(self.longest):
            self.power[i + 1] = (int(self.power[i]) * int(BASE)) % (1 << 64)
        keys = np.array([self._key(self.pieces[i]) for i in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_id = keys[order], np.array(usable, np.int64)[order]
        self.probe = np.zeros(1 << PROBE_BITS, bool)
        self.probe[keys & np.uint64((1 << PROBE_BITS) - 1)] = True
        if (np.diff(self.keys) == 0).any():
            raise ValueError("two pieces share a hash key")
        # What a piece reads as; decoding joins these.
        shown = [p.replace(MARK, " ") if p_ok else "" for p, p_ok in zip(self.pieces, np.isin(np.arange(len(self.pieces)), usable), strict=True)]
        self.shown = np.array(shown, dtype=object)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self._store: list[np.ndarray] = []
        self.size = 0

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) % (1 << 64)
        return h

    def _segment(self, words: list[str]) -> list[list[int]]:
        """Viterbi over words of about one length, the longest last, all at once."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        length = int(lengths[-1])
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.zeros((len(words), length), np.uint64)
        codes[np.arange(length)[None, :] < lengths[:, None]] = flat  # what is past a word's end is never read back
        h = _prefix_hashes(codes)
        best = np.full((len(words), length + 1), -np.inf)
        best[:, 0] = 0
        piece = np.full((len(words), length + 1), -1, np.int32)  # -1: a character that no piece covers
        back = np.zeros((len(words), length + 1), np.int16)
        rows = np.arange(len(words))
        low = np.uint64((1 << PROBE_BITS) - 1)
        for end in range(1, length + 1):
            sizes = np.arange(min(end, self.longest), 0, -1)
            begin = end - int(sizes[0])
            sub = h[:, [end]] - h[:, begin:end] * self.power[sizes]
            row, which = np.nonzero(self.probe[sub & low])
            sub = sub[row, which]
            at = np.minimum(np.searchsorted(self.keys, sub), len(self.keys) - 1)
            hit = self.keys[at] == sub
            row, which, ids = row[hit], which[hit], self.key_id[at[hit]]
            total = np.full((len(words), len(sizes)), -np.inf)
            total[:, -1] = best[:, end - 1] + self.unknown
            found = np.full((len(words), len(sizes)), -1, np.int32)
            total[row, which] = best[row, begin + which] + self.score[ids]
            found[row, which] = ids
            pick = total.argmax(axis=1)
            best[:, end] = total[rows, pick]
            piece[:, end] = found[rows, pick]
            back[:, end] = sizes[pick]
        out = []
        for word, p, b in zip(words, piece, back, strict=True):
            end = len(word)
            p, b = p[: end + 1].tolist(), b[: end + 1].tolist()
            ids = []
            while end:
                begin = end - b[end]
                if p[end] >= 0:
                    if self.pieces[p[end]] != word[begin:end]:
                        return [self._plain(w) for w in words]  # two substrings share a hash: compare texts instead
                    ids.append(p[end])
                else:
                    ids.extend(self.byte_id[list(word[begin:end].encode("utf-8", "surrogatepass"))[::-1]].tolist())
                end = begin
            ids.reverse()
            out.append(ids)
        return out

    def _plain(self, word: str) -> list[int]:
        """The same segmentation, by looking up texts."""
        known = {self.pieces[i]: i for i in self.key_id.tolist()}
        best, ids = [0.0], [[]]
        for end in range(1, len(word) + 1):
            options = []
            for size in range(min(end, self.longest), 0, -1):
                i = known.get(word[end - size : end])
                if i is not None:
                    options.append((best[end - size] + self.score[i], size, [i]))
                elif size == 1:
                    options.append((best[end - 1] + self.unknown, 1, self.byte_id[list(word[end - 1].encode("utf-8", "surrogatepass"))].tolist()))
            top = max(options, key=lambda o: o[0])
            best.append(top[0])
            ids.append((top[1], top[2]))
        out, end = [], len(word)
        while end:
            size, own = ids[end]
            out, end = own + out, end - size
        return out

    def learn(self, words: set[str]) -> None:
        new = sorted((w for w in words if w not in self.index), key=len)
        lo = 0
        while lo < len(new):
            shortest = len(new[lo])
            hi = lo + 1
            while hi < len(new) and hi - lo < TOGETHER and len(new[hi]) <= max(shortest, int(shortest * SPREAD)) and len(new[hi]) * (hi - lo) < PLACES:
                hi += 1
            part = new[lo:hi]
            for w, ids in zip(part, self._segment(part), strict=True):
                self.index[w] = len(self._store)
                self._store.append(np.array(ids, np.int32))
                self.size += ENTRY_BYTES + len(w) + 4 * len(ids)
            lo = hi

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split = [_SPLIT.findall((MARK if self.dummy_prefix else "") + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.size > CACHED_BYTES:
            self.clear()
        self.learn({w for s in split for w in s})
        get, store = self.index.__getitem__, self._store
        none = np.zeros(0, np.int32)
        return [np.concatenate([store[i] for i in map(get, s)]) if s else none for s in split]

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.pieces))]
        if self.is_byte[ids].any():
            raw = b"".join(bytes([self.byte_of[i]]) if self.is_byte[i] else self.shown[i].encode() for i in ids.tolist())
            text = raw.decode("utf-8", "replace")
        else:
            text = "".join(self.shown[ids])
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    at_work("sentencepiece", _models.clear)
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


STEP = 1024


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: the token ids of every whole text."""
    path = path or default_model()

    def run(frames):
        m = model(path)
        for f in frames:
            for lo in range(0, len(f), STEP):
                part = f.iloc[lo : lo + STEP]
                ids = m.encode_batch([t if isinstance(t, str) else "" for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64").array, "ids": ids})

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInPandas(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of the ids."""
    path = path or default_model()

    def run(frames):
        m = model(path)
        for f in frames:
            text = [m.decode(i) if i is not None else "" for i in f["ids"]]
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64").array, "text": text})

    return tokens.selectExpr("cast(doc_id as bigint) as doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, ids_crc32 (little-endian 32-bit ids) and whether decoding gives back the text."""
    path = path or default_model()

    def run(frames):
        m = model(path)
        for f in frames:
            for lo in range(0, len(f), STEP):
                part = f.iloc[lo : lo + STEP]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                rows = [
                    (len(i), int(m.is_byte[i].sum()), zlib.crc32(i.astype("<i4").tobytes()), m.decode(i) == t.replace(MARK, " "))
                    for t, i in zip(texts, m.encode_batch(texts), strict=True)
                ]
                out = pd.DataFrame(rows, columns=["n_tokens", "n_byte_tokens", "ids_crc32", "round_trip"])
                out.insert(0, "doc_id", part["doc_id"].astype("Int64").array)
                yield out

    schema = "doc_id long, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean"
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInPandas(run, schema)


def op3_sentencepiece(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"))
