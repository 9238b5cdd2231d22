import hashlib
from collections import Counter

import numpy as np
import pytest

from factloom.llm import parity_join, suffix_dedup

NONE = -(1 << 63)


def brute_spans(rows, n):
    first = {}
    raw = [(NONE if d is None else d, (t or "").encode()) for d, t, *_ in rows]
    for d, b in raw:
        for i in range(len(b) - n + 1):
            w = b[i : i + n]
            first[w] = min(first.get(w, d), d)
    out = Counter()
    for (d, b), row in zip(raw, rows, strict=True):
        c = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < d:
                c[i : i + n] = True
        kept = np.frombuffer(b, np.uint8)[~c].tobytes()
        spans = int((np.diff(np.concatenate([[0], c.astype(int), [0]])) == 1).sum())
        out[(row[0], len(b), int(c.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("n", [50, 100])
def test_repeated_spans(docs, rows, n):
    got = suffix_dedup.repeated_spans(docs, n).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_spans(rows, n)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.edges) == 2 * r.n_spans for r in got)


def test_remove_repeats(docs, rows, empty):
    out = suffix_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[80] is None and text[79] == "" and text[85] == next(r[1] for r in rows if r[0] == 85)
    more = docs.selectExpr("*", *[f"'x' as {c}" for c in ("whole", "own_id", "own_hash", "cut_id", "cut_hash", "left_over", "s_doc", "s_row", "edges")])
    assert suffix_dedup.remove_repeats(more).columns == more.columns
    assert Counter(r.text for r in suffix_dedup.remove_repeats(more).collect()) == Counter(r.text for r in out.collect())
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.repeated_spans(empty).count() == 0


def test_suffix_sort_is_a_suffix_array():
    data = np.frombuffer(b"banana bandana " * 20 + b"ananas", np.uint8)
    starts = np.arange(len(data))
    order = suffix_dedup.suffix_sort(data, starts, np.zeros(len(data), np.int64))
    raw = data.tobytes()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    group = starts % 3
    order = suffix_dedup.suffix_sort(data, starts, group, 5)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: (i % 3, raw[i : i + 5]))


def test_common_extension():
    data = np.frombuffer(b"abcdefabcxef", np.uint8)
    p = suffix_dedup.Prefixes(data)
    a, b = np.array([0, 0, 4]), np.array([6, 0, 10])
    assert suffix_dedup.common_extension(p, a, b, np.array([6, 12, 2])).tolist() == [3, 12, 2]


def test_minima_sort_two_suffixes_a_context(monkeypatch):
    """A passage and its near copies in every document: their edges are contexts of one seed, a window each place."""
    r = np.random.default_rng(3)
    for min_bytes, seed_bytes in ((50, 20), (100, 20), (24, 20)):
        passage = bytes(r.integers(97, 105, 300).astype(np.uint8))
        parts = []
        for i in range(120):
            lo, hi = sorted(r.integers(0, 300, 2).tolist())
            own = bytearray(passage[lo:hi])
            if i % 3 == 0 and own:
                own[len(own) // 2] = 120
            parts.append(bytes(r.integers(0, 5, int(r.integers(0, 60))).astype(np.uint8)) + bytes(own) + b"\0" * int(r.integers(0, 40)))
        length = np.array([len(x) for x in parts])
        data, docs = np.frombuffer(b"".join(parts), np.uint8), r.permutation(len(parts))
        c = suffix_dedup.Contexts(data, np.cumsum(length) - length, length, docs, min_bytes, seed_bytes)
        key, first, least, _, _ = suffix_dedup._least_doc(c.key, c.doc)
        begin, count = c.begin[first], c.count[first]
        least_of: dict[bytes, int] = {}
        windows = [(data[b + t : b + t + min_bytes].tobytes(), d) for b, n, d in zip(begin, count, least, strict=True) for t in range(n)]
        for w, d in windows:
            least_of[w] = min(d, least_of.get(w, d))
        sorted_ = []
        sort = suffix_dedup.suffix_sort
        with monkeypatch.context() as m:
            m.setattr(suffix_dedup, "suffix_sort", lambda data, starts, *a, s=sorted_: (s.append(len(starts)), sort(data, starts, *a))[1])
            got = suffix_dedup._window_minima(data, begin, count, c.seed_at[first] - begin, c.seed[first], least, min_bytes, seed_bytes)
        assert got.tolist() == [least_of[w] for w, _ in windows]
        assert 0 < sum(sorted_) <= 2 * len(key) and (min_bytes < 50 or len(windows) > 2 * len(key))


def test_what_goes_to_each_receiver():
    to = np.array([5, 2, 5, 0, 2, 2])
    assert [(s, own.tolist()) for s, own in suffix_dedup._dealt(to)] == [(0, [3]), (2, [1, 4, 5]), (5, [0, 2])]
    assert list(suffix_dedup._dealt(to[:0])) == []


def sets_of(rows, k):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for d, t, *_ in rows:
        w = [x for x in (t or "").translate(lower).replace("\t", " ").replace("\n", " ").split(" ") if x]
        out.append((d, frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def brute_components(rows, k, percent):
    sets = sets_of(rows, k)
    root = {d: d for d, _ in sets if d is not None}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return Counter((d, len(s), None if d is None else find(d)) for d, s in sets)


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (3, 60)])
def test_components(docs, rows, k, percent):
    got = parity_join.join_components(docs, k, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, k, percent)


def test_hot_segments_are_dealt_into_cells_and_more_rounds_follow(docs, rows, monkeypatch):
    monkeypatch.setattr(parity_join, "CELL", 2)
    monkeypatch.setattr(parity_join, "STAR", 1)
    monkeypatch.setattr(parity_join, "SMALL_CELL", 2)
    got = parity_join.join_components(docs, 4, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 4, 85)


@pytest.mark.parametrize("small", [2, 64])
def test_grey_group(spark, monkeypatch, small):
    """Copies of one text at all distances from it, many of them just under and just over the bound to each other."""
    monkeypatch.setattr(parity_join, "SMALL_CELL", small)
    monkeypatch.setattr(parity_join, "MORE", 3)
    monkeypatch.setattr(parity_join, "CELL", 64)
    r = np.random.default_rng(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(240):
        w = list(base)
        for at in r.choice(150, int(r.integers(1, 9)), replace=False):
            w[at] = f"x{r.integers(1 << 40)}"
        rows.append((int(1000 - i), " ".join(w)))
    got = parity_join.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = brute_components(rows, 4, 85)
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in got) == want
    assert len({c for *_, c in want}) > 3


@pytest.mark.parametrize("first", [1, None])
def test_rounds_and_tables_are_few(spark, monkeypatch, first):
    """Each round costs its shuffles however few pairs it has. From one pair of each set on, with many tried ones, none is lost."""
    if first:
        monkeypatch.setattr(parity_join, "FIRST", first)
        monkeypatch.setattr(parity_join, "MORE", 2)
    r = np.random.default_rng(13)
    rows = []
    for group in range(3):
        base = [f"w{group}-{i}" for i in range(150)]
        for i in range(80):
            w = list(base)
            for at in r.choice(150, int(r.integers(1, 9)), replace=False):
                w[at] = f"x{r.integers(1 << 40)}"
            rows.append((100 * i + group, " ".join(w)))
    names = []
    whole = parity_join.written

    def noted(df, name, *more):
        names.append(name)
        return whole(df, name, *more)

    monkeypatch.setattr(parity_join, "written", noted)
    got = parity_join.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in got) == brute_components(rows, 4, 85)
    rounds = names.count("join-near")
    assert rounds > 2 if first else rounds <= 2 and len(names) <= 40, names


def test_long_sets_are_verified_in_whole_numbers():
    """At 671,089 common shingles and more, single precision gets the bound wrong."""
    rng = np.random.default_rng(2)
    both = np.unique(rng.integers(0, 1 << 62, 17_000_000 // 20, dtype=np.uint64))
    for extra, linked in ((0, True), (1, False)):
        own = np.arange(1, 1 + 150 * len(both) // 850 + extra, dtype=np.uint64) | np.uint64(1 << 63)
        assert parity_join.linked_with(np.concatenate([both, own]), [both], 85).tolist() == [linked]


def test_keep_first(docs, rows, empty):
    out = parity_join.keep_first(docs, 4, 85)
    first = {c for (d, n, c) in brute_components(rows, 4, 85)}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == first
    assert parity_join.keep_first(empty).count() == 0 and parity_join.join_components(empty).count() == 0


def test_every_linked_pair_shares_a_key():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 85, 95):
        bands = parity_join.Bands(percent)
        for n in (1, 2, 5, 8, 12, 20, 50, 133, 400):
            for _ in range(30):
                a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                drop = int(n * (100 - percent) / 100)
                for add in {0, drop // 2}:
                    b = np.concatenate([a[drop - add :], rng.integers(0, 1 << 63, add, dtype=np.uint64)]) if drop else a
                    x, y = np.unique(a), np.unique(b)
                    if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)):
                        assert len(np.intersect1d(parity_join.sketch_keys(x, bands), parity_join.sketch_keys(y, bands)))


def test_every_linked_pair_shares_a_key_that_neither_gives_up():
    """Whatever the order of segments is, as long as it is one."""
    rng = np.random.default_rng(6)
    for percent in (60, 80, 85, 95):
        bands = parity_join.Bands(percent)
        for n in (1, 2, 5, 8, 12, 20, 50, 133, 400):
            for trial in range(20):
                a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
                drop = int(n * (100 - percent) / 100)
                b = np.concatenate([a[drop - drop // 2 :], rng.integers(0, 1 << 63, drop // 2, dtype=np.uint64)])
                x, y = np.unique(a), np.unique(b)
                if 100 * len(np.intersect1d(x, y)) < percent * len(np.union1d(x, y)):
                    continue
                left = []
                for s in (x, y):
                    keys = parity_join.sketch_keys(s, bands)
                    sketch = (keys >> np.uint64(16)).astype(np.int64) & 0xFF
                    kept = []
                    for t in parity_join.slacks(s, bands):
                        own = keys[sketch == t >> 16]
                        order = np.argsort(parity_join.mixed(own + np.uint64(trial)))
                        kept.append(own[order][: len(own) - min(len(own), t & 0xFFFF)])
                    assert sum(map(len, kept)) <= len(keys) and set(sketch.tolist()) == {t >> 16 for t in parity_join.slacks(s, bands)}
                    left.append(np.concatenate(kept))
                assert len(np.intersect1d(*left))


def test_a_passage_of_many_documents_makes_no_hot_segment(spark, monkeypatch):
    """A third of the documents share a passage; a few are linked on top of it. No link is lost, and what is hot is given up."""
    r = np.random.default_rng(12)
    passage = [f"p{i}" for i in range(24)]
    rows = []
    for i in range(300):
        own = [f"w{r.integers(1 << 40)}" for _ in range(int(r.integers(80, 160)))]
        w = own[:40] + passage + own[40:] if i % 3 == 0 else own
        rows.append((i, " ".join(w)))
        if i % 10 == 0:
            w = list(w)
            w[int(r.integers(len(w)))] = f"y{i}"
            rows.append((1000 + i, " ".join(w)))
    sizes = []
    whole = parity_join.without_hot

    def looked_at(segments, slack):
        out = whole(segments, slack)
        sizes.extend(max(x["count"] for x in t.groupBy("key").count().collect()) for t in (segments, out))
        return out

    monkeypatch.setattr(parity_join, "without_hot", looked_at)
    monkeypatch.setattr(parity_join, "HOT", 8)
    got = parity_join.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in got) == brute_components(rows, 4, 85)
    assert sizes[0] >= 8 > sizes[1], sizes


def test_exact_verification():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 40, 80, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 60, replace=False), rng.integers(0, 1 << 40, 5, dtype=np.uint64)])) for _ in range(60)]
    for x in sets[:8]:
        assert parity_join.linked_with(x, sets, 60).tolist() == [100 * len(np.intersect1d(x, y)) >= 60 * len(np.union1d(x, y)) for y in sets]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 9, 70, 500, 3000):
        for apart in (0, 1, n // 6, n // 3, n):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            b = np.concatenate([a[apart // 2 :], rng.integers(0, 1 << 63, apart - apart // 2, dtype=np.uint64)])
            x, y = (parity_join.folded_sketch(np.unique(s), 85).tobytes() for s in (a, b))
            assert parity_join.hamming(x, y) <= len(np.setxor1d(a, b))
            if apart >= max(2, n // 3):
                assert parity_join.hamming(x, y) > parity_join.differ_at_most(len(a), len(b), 85)
