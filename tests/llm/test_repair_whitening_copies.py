import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import exact_dedup, structure_repair, whitening

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ---------------------------------------------------------------- exact copies


def brute_copies(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    out = Counter()
    for d, t, *_ in rows:
        n = (t or "").translate(LOWER)
        ids = [x for x in groups[n] if x is not None]
        keep = max(ids) if ids else None
        out[(d, keep, len(groups[n]), d == keep, hashlib.sha256(n.encode()).hexdigest())] += 1
    return out


@pytest.fixture(scope="module")
def with_copies(spark, rows):
    more = [*rows, (90, rows[5][1].upper(), "en", "s1"), (91, "É" + rows[6][1], "en", "s1"), (92, "é" + rows[6][1], "en", "s1"), (93, None, None, None), (None, "only without an id", "en", "s1")]
    more += [(1000 + i, "The crowd's text", "en", "hot") for i in range(60)] + [(None, "the crowd's text", "en", "hot")]
    df = spark.createDataFrame([r[:4] for r in more], "doc_id long, text string, lang string, source string").repartition(5)
    return more, df.withColumns({c: F.lit(1) for c in ("digest", "salt", "n", "keep_id", "texts", "h_n", "gone_id", "text_sha256", "group_size")})


@pytest.mark.parametrize("hot", [1, 4, 1024])
def test_copies(with_copies, hot):
    rows, df = with_copies
    assert Counter(tuple(r) for r in exact_dedup.copies(df, salts=3, hot=hot).collect()) == brute_copies(rows)


def test_copies_whose_digests_are_shared(with_copies):
    """A digest of four bits puts many texts together, which the texts themselves tell apart."""
    rows, df = with_copies
    weak = lambda text: F.unhex(F.left(F.sha2(text, 256), F.lit(1)))
    assert Counter(tuple(r) for r in exact_dedup.copies(df, digest=weak, salts=2, hot=4).collect()) == brute_copies(rows)


def test_kept_documents_have_their_columns(with_copies):
    rows, df = with_copies
    got = exact_dedup.keep_last(df)
    assert got.columns == df.columns
    want = Counter((k[0], k[4]) for k, n in brute_copies(rows).items() for _ in range(n) if k[3])
    assert Counter((r.doc_id, hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()) for r in got.collect()) == want


def test_copies_of_nothing_and_native_plan(empty, with_copies):
    assert exact_dedup.copies(empty).count() == 0
    plan = exact_dedup.copies(with_copies[1])._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups"))


# ---------------------------------------------------------------- whitening


def exact_moments(x):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    v = [[Fraction(n * sum(r[i] * r[j] for r in x) - s[i] * s[j], n * n) for j in range(d)] for i in range(d)]
    return n, s, v


def check_whitened(got, vectors, components=8):
    """Rows against exact fractions: `vectors` are (id, floats) that take part."""
    x = [[int(np.floor(np.float64(c) * 1024)) + 100000 for c in v] for _, v in vectors]
    n, s, v = exact_moments(x)
    d = len(s)
    trace = float(sum(v[i][i] for i in range(d)))
    scaled = np.array([[float(c) for c in r] for r in v])
    e, q = np.linalg.eigh(scaled)
    e, q = e[::-1], q[:, ::-1]
    want_ids = Counter(i for i, _ in vectors)
    assert Counter(r.vec_id for r in got if r.component == 1) == want_ids and len(got) == n * min(d, components)
    deviation = {i: sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True)) for (i, _), row in zip(vectors, x, strict=True)}
    by_component = {}
    for r in got:
        assert r.n == n and r.deviation == deviation[r.vec_id] and abs(r.identity_error) < 1e-9
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-6)
        by_component.setdefault(r.component, {})[r.vec_id] = r.whitened
    for c, values in by_component.items():
        want = {i: float((np.array([a - Fraction(b, n) for a, b in zip(row, s, strict=True)], float) @ q[:, c - 1]) / np.sqrt(e[c - 1])) for (i, _), row in zip(vectors, x, strict=True)}
        big = max(want, key=lambda i: abs(want[i]))
        sign = 1 if want[big] * values[big] > 0 else -1
        assert all(abs(sign * values[i] - want[i]) < 1e-7 for i in want)


def embeddings(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("v", "n", "d", "component", "label")})


def test_whitening(spark):
    r = np.random.default_rng(3)
    mix = r.normal(size=(10, 10)) * np.linspace(3, 0.1, 10)
    good = [(i, (r.normal(size=10) @ mix).astype(np.float32).tolist()) for i in range(300)]
    bad = [(1000, None), (1001, [1.0] * 9 + [None]), (1002, [1.0] * 9 + [float("nan")]), (1003, [float("inf")] + [0.0] * 9), (1004, []), (1005, [1.0, 2.0])]
    check_whitened(whitening.whiten(embeddings(spark, good + bad)).collect(), good)
    few = [(i, v[:3]) for i, v in good]
    check_whitened(whitening.whiten(embeddings(spark, few)).collect(), few)


def test_whitening_without_variance(spark):
    one = whitening.whiten(embeddings(spark, [(1, [0.5, 0.25]), (2, None)])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one, key=lambda r: r.component)] == [(1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    # The second component is flat, and null ids and repeated rows count.
    flat = whitening.whiten(embeddings(spark, [(1, [0.0, 2.0]), (1, [0.0, 2.0]), (None, [3.0, 2.0])])).collect()
    assert Counter((r.vec_id, r.component, r.whitened is None) for r in flat) == {(1, 1, False): 2, (1, 2, True): 2, (None, 1, False): 1, (None, 2, True): 1}
    assert whitening.whiten(embeddings(spark, [(1, None)])).count() == 0
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_whitening_of_large_numbers(spark):
    """Sums beyond 64 bits stay exact; a deviation that fits no long is null."""
    rows = [(i, [2.0**45 + i * 2.0**24, -(2.0**40) * (i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = whitening.whiten(df).collect()
    x = [[int(np.floor(c * 1024)) + 100000 for c in v] for _, v in rows]
    n, s, v = exact_moments(x)
    counted, sums, cross = whitening.moments(whitening.usable(df)[0], 2)
    assert counted == n and [a + n * 100000 for a in sums] == s
    assert Fraction(n * cross[0][1] - sums[0] * sums[1], n * n) == v[0][1] and Fraction(n * cross[0][0] - sums[0] ** 2, n * n) == v[0][0]
    assert all(r.deviation is None and abs(r.identity_error) < 1e-9 for r in got)


# ---------------------------------------------------------------- conversations


def damage(rows):
    out = {}
    space = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = space(role), space(text)
        harm = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        mine += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    for v in out.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def brute_repair(rows):
    """By (cost, audit) of every state, whole strings compared."""
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    count = Counter(faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def best(i, state, room):
        """(cost, audit, lines) from row i on; at most `room` more insertions before it."""
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            extra = 5 if faults[i] == "truncated" else 0
            found.append(add(2, "D", None, best(i + 1, state, 3)))
            if faults[i] not in ("blank", "duplicate"):
                if (state, role[:1]) in follow and role:
                    found.append(add(extra, "K", f"{role}:{text}", best(i + 1, follow[state, role[:1]], 3)))
                for name in ("user", "assistant"):
                    if (state, name[0]) in follow:
                        found.append(add(extra + 1, "R", f"{name}:{text}", best(i + 1, follow[state, name[0]], 3)))
        for name in ("user", "assistant") if room else ():
            if (state, name[0]) in follow:
                found.append(add(5, "I", f"{name}:", best(i, follow[state, name[0]], room - 1)))
        found = [x for x in found if x is not None]
        return min(found) if found else None

    def add(cost, letter, line, rest):
        return rest and (cost + rest[0], letter + rest[1], (() if line is None else (line,)) + rest[2])

    cost, audit, lines = best(0, "", 3)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha)


def chat_rows():
    r = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "and then", "", " \n", None, "Ja. ", "ö", "x: y.\nz?"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "uncle"]
    rows = []
    for c in [*range(150), None]:
        for i in range(r.randint(0, 12)):
            clean = r.random() < 0.6
            rows.append((c, r.choice([i, i, i, i + 3, None]), ["user", "assistant"][i % 2] if clean else r.choice(roles), f"Line {i}." if clean else r.choice(texts)))
    rows += [(500, 7, "user", "Again."), (500, 7, "user", "Again."), (500, 7, "assistant", "Again."), (501, 2**62, "user", "Far."), (501, -(2**40), "system", "Near.")]
    rows.append((502, 1, "user", "word " * 30000 + "end."))
    return rows


@pytest.fixture(scope="module")
def chats(spark):
    rows = chat_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    return rows, df.withColumns({c: F.lit("k") for c in ("key", "chunk", "m", "fault", "said", "n", "piece", "audit")})


@pytest.mark.parametrize(("chunk_rows", "hot"), [(4096, 1024), (3, 1024), (2, 10**9), (5, 7)])
def test_repair(chats, chunk_rows, hot):
    """Whole conversations, pieces of one task, and pieces dealt by place."""
    rows, df = chats
    want = {c: brute_repair(v) for c, v in damage(rows).items()}
    got = structure_repair.repair(df, chunk_rows, hot).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_repair_of_a_long_conversation(spark):
    """Hundreds of pieces, some without any damage: few passes, and the vectors of all agree with one run."""
    r = random.Random(5)
    rows = [(1, i, ["user", "assistant"][(i + (i > 1500)) % 2], f"Line {i}." if r.random() < 0.97 or i < 900 else r.choice(["", "cut", "Line 4."])) for i in range(3000)]
    rows += [(2, None, "user", "Same.")] * 50 + [(2, None, "assistant", "Same.")] * 30
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {x.conv_id: tuple(x)[1:] for x in structure_repair.repair(df, 16, 3).collect()}
    whole = {x.conv_id: tuple(x)[1:] for x in structure_repair.repair(df, 10**6, 1).collect()}
    assert got == whole
    kinds = [structure_repair._kind(x[2], "") for x in rows[:900]]
    assert structure_repair.backward(kinds, structure_repair.END, structure_repair.backward(kinds, (0, 0, 0, 0))) == structure_repair.backward(kinds, structure_repair.END)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert structure_repair.repair(empty).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = structure_repair.repair(spark.createDataFrame([(dropped, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(x) for x in got] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
