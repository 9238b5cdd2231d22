import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import chat_format, hilbert_shards, line_dedup, quality_rules

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def least(i):
    return -(10**18) if i is None else i


def brute_lines(rows):
    holders = {}
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            k = line.strip(WHITE).translate(LOWER)
            if len(k) >= 10:
                holders.setdefault(k, set()).add(least(d))
    out = Counter()
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(k := x.strip(WHITE).translate(LOWER)) < 10 or min(holders[k]) == least(d)]
        out[(d, len(lines), len(lines) - len(kept), "\n".join(kept) if kept else "")] += 1
    return out


def test_line_dedup(docs, rows, empty):
    got = line_dedup.apply_bitmaps(docs, line_dedup.drop_bitmaps(docs, salts=3))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == brute_lines(rows)
    whole = line_dedup.dedup_lines(docs)
    assert whole.columns == docs.columns and whole.count() == len(rows)
    assert Counter(r.text for r in whole.collect()) == Counter(k[3] for k in brute_lines(rows).elements())
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_of_a_long_document(spark):
    lines = [f"line number {i}" for i in range(3000)]
    df = spark.createDataFrame([(1, "\n".join(lines[::7])), (2, "\n".join(lines))], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.apply_bitmaps(df, line_dedup.drop_bitmaps(df)).collect()}
    assert got[2].n_dropped == len(lines[::7]) and got[2].kept_text == "\n".join(x for i, x in enumerate(lines) if i % 7)
    words = line_dedup.drop_bitmaps(df).collect()
    assert len(words) == 1 and sum(bin(w.bits & (2**64 - 1)).count("1") for w in words[0].words) == len(lines[::7])


def brute_chats(rows):
    chats = {}
    for c, turn, role, text in set(rows):
        chats.setdefault(c, []).append((least(turn), role or "unknown", text or ""))
    chats = {c: [t[1:] for t in sorted(v)] for c, v in chats.items()}
    prefixes = {tuple(v[:n]) for v in chats.values() for n in range(1, len(v))}
    best = {}
    for c, v in chats.items():
        if tuple(v) not in prefixes:
            best.setdefault(tuple(v), []).append(c)
    piece = lambda r, t: f"<|{r.replace('|>', '| >')}|>\n{t.replace('<|', '< |')}\n<|end|>\n"
    return {min(cs, key=lambda c: (c is None, c)): "".join(piece(*t) for t in v) for v, cs in best.items()}


def test_chats(spark, monkeypatch):
    r = random.Random(3)
    long = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(23)]
    rows = []
    for c in range(30):
        base = long if c % 2 else [(role, f"{c} {t}") for role, t in long]
        rows += [(c, i, *t) for i, t in enumerate(base[: r.randint(1, 23)])]
    rows += [(40, i, *t) for i, t in enumerate(long)] + [(41, i, *t) for i, t in enumerate(long)] + [(41, 3, *long[3])]
    rows += [(None, 0, "user", "<|user|> hi"), (42, None, None, None), (42, 1, "a|>b", ""), (43, 5, "user", "x"), (43, 5, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(1))
    for block in (4, 1024):
        monkeypatch.setattr(chat_format, "BLOCK", block)
        got = {}
        for x in sorted(chat_format.format_chats(df).collect(), key=lambda x: x.part):
            got[x.conv_id] = got.get(x.conv_id, "") + x.chat
        assert got == brute_chats(rows)
    assert chat_format.format_chats(df.limit(0)).count() == 0


def brute_rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def distance(p, q):
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    half = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    return np.sqrt(max(0, (half(p) + half(q)) / 2))


def test_quality_rules(docs, rows, empty):
    text = {**{d: t for d, t, *_ in rows}}
    f = quality_rules.base_features(docs).collect()
    assert len(f) == len(rows)
    for r in f:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text[r.doc_id])
        assert sum(r.classes) == len(text[r.doc_id] or "")
    j = quality_rules.judge(docs).collect()
    near = [r for r in j if r.lang == "de" and r.class_distance is not None]
    assert near and all(r.class_distance == pytest.approx(distance(r.classes, r.ref_classes), abs=1e-9) for r in near)
    assert all(r.word_distance == pytest.approx(distance(r.common, r.ref_common), abs=1e-9) for r in j if r.word_distance is not None)
    assert not any(r.kept for r in j if r.base_failed) and any(r.kept for r in j)
    assert quality_rules.judge(empty).count() == 0


def plain_classes(text):
    import unicodedata

    of = {"Ll": 0, "Lu": 2, "Nd": 4}
    out = [0] * 7
    for c in text:
        kind = unicodedata.category(c)
        out[1 if c in " \t\n\x0b\x0c\r" else 3 if c in ".,;:'\"?!-" else 5 if c in "#*$%&|<>" else of.get(kind, 6)] += 1
    return out


def test_verdicts_against_plain_python(spark, tiny):
    docs, labels = spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    rows = docs.collect()
    base = {r.doc_id: brute_rules(r.text) for r in rows}
    classes = {r.doc_id: plain_classes(r.text or "") for r in rows}
    words = {r.doc_id: re.findall(r"[^ \t-\r]+", r.text or "") for r in rows}
    common = {r.doc_id: [*(words[r.doc_id].count(w) for w in quality_rules.COMMON_WORDS[r.lang]), sum(w not in quality_rules.COMMON_WORDS[r.lang] for w in words[r.doc_id])] for r in rows}
    of = lambda table, lang: np.sum([table[r.doc_id] for r in rows if r.lang == lang and r.doc_id in good and not base[r.doc_id][-1]], axis=0)
    langs = {r.lang for r in rows}
    pooled = sum(of(classes, x) for x in langs)
    got = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    for r in rows:
        n, chars, lang = len(words[r.doc_id]), len(r.text or ""), r.lang
        ref, ref_words = of(classes, lang), of(common, lang)
        far = False
        if chars >= quality_rules.MIN_CHARS_FOR_CLASSES:
            d = distance(classes[r.doc_id], ref + pooled * quality_rules.PRIOR_CHARS / pooled.sum())
            assert got[r.doc_id].class_distance == pytest.approx(d, abs=1e-9)
            far |= d > quality_rules.MAX_CLASS_DISTANCE + quality_rules.CLASS_SLACK * (chars**-0.5 + (ref.sum() + quality_rules.PRIOR_CHARS) ** -0.5)
        if n >= quality_rules.MIN_WORDS_FOR_COMMON:
            d = distance(common[r.doc_id], ref_words)
            assert got[r.doc_id].word_distance == pytest.approx(d, abs=1e-9)
            far |= d > quality_rules.MAX_WORD_DISTANCE + quality_rules.WORD_SLACK * (n**-0.5 + ref_words.sum() ** -0.5)
        assert got[r.doc_id].kept == (not base[r.doc_id][-1] and not far)


def test_common_words_are_counted(spark):
    text = "the the cat the of of\tthe Then the, of"
    r = quality_rules.base_features(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")).first()
    counts = dict(zip(quality_rules.COMMON_WORDS["en"], r.common, strict=False))
    assert counts["the"] == 4 and counts["of"] == 3 and r.common[-1] == len(text.split()) - 7


def test_junk_is_rejected_on_the_given_tables(spark, tiny):
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    judged = quality_rules.judge(spark.read.parquet(f"{tiny}/documents.parquet"), labels)
    rate = {r.quality: r.rate for r in judged.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rate[1] > 0.85 and rate[0] < 0.2


def test_hilbert_curve_visits_every_cell_by_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        index = hilbert_shards.hilbert_index(grid, bits)
        assert sorted(index) == list(range(len(grid)))
        path = grid[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards(docs, rows, empty):
    got = hilbert_shards.shard(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        own = sorted((r.slot, r.hilbert) for r in got if r.shard == s)
        assert [x[0] for x in own] == list(range(len(own))) and [x[1] for x in own] == sorted(x[1] for x in own)
    assert max(r.hilbert for r in got if r.shard == 0) <= min(r.hilbert for r in got if r.shard == 7)
    assert hilbert_shards.shard(empty).count() == 0 and sorted(r.shard for r in hilbert_shards.shard(docs.limit(3)).collect()) == sorted({r.shard for r in hilbert_shards.shard(docs.limit(3)).collect()})


def test_equal_texts_are_torn_only_at_the_end_of_a_run(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = hilbert_shards.shard(docs).collect()
    last = Counter(r.shard for r in rows)
    groups = {}
    for r in rows:
        groups.setdefault(text[r.doc_id], []).append((r.shard, r.slot))
    assert any(len(g) > 1 for g in groups.values())
    for g in groups.values():
        order = sorted(g)
        for (s, i), after in zip(order, order[1:], strict=False):
            assert after == (s, i + 1) or (i == last[s] - 1 and after == (s + 1, 0))


@pytest.mark.parametrize("hot", [1, 1 << 40])
def test_hot_groups_are_placed_as_others_are(spark, monkeypatch, hot):
    """A text in a third of all rows: the same places whether its group is broadcast or joined."""
    rows = [(i, "" if i % 3 == 0 else f"text {i // 2}", "en" if i % 2 else "de", f"s{i % 5}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    want = sorted((r.doc_id, r.hilbert, r.shard, r.slot) for r in hilbert_shards.shard(docs).collect())
    monkeypatch.setattr(hilbert_shards, "HOT", hot)
    assert sorted((r.doc_id, r.hilbert, r.shard, r.slot) for r in hilbert_shards.shard(docs).collect()) == want
    assert len({h for i, h, *_ in want if i % 3 == 0}) == 1


def test_files_of_shards_prune_on_metadata(spark, tiny, tmp_path):
    import glob

    import pyarrow.parquet as pq

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    hilbert_shards.write_shards(docs, f"file://{tmp_path}/shards")
    files = glob.glob(f"{tmp_path}/shards/shard=*/*.parquet")
    found = []
    for f in files:
        meta = pq.ParquetFile(f).metadata.row_group(0)
        columns = {meta.column(i).path_in_schema: meta.column(i).statistics for i in range(meta.num_columns)}
        found.append({c: (columns[c].min, columns[c].max) for c in ("lang", "source", "size", "hilbert")})
    assert len({f.split("shard=")[1].split("/")[0] for f in files}) == 8
    wanted = docs.groupBy("lang").count().orderBy("count").first().lang
    assert sum(f["lang"][0] <= wanted <= f["lang"][1] for f in found) < len(found)
    assert spark.read.parquet(f"file://{tmp_path}/shards").count() == docs.count()


def test_line_sql(spark, tiny):
    from duck import connect, same

    con = connect(tiny)
    same(line_dedup.op8_line_dedup(spark, tiny), line_dedup.OP8_SQL, con)
    same(chat_format.op5_chat_format(spark, tiny), chat_format.OP5_SQL, con)
    assert hashlib.sha256(b"").hexdigest()
