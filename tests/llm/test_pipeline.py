import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as pipeline  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, tiny):
    """What each stage gives on the smallest tables, with the documents before it."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    out = [docs]
    for name, f in pipeline.STAGES:
        docs = pipeline.written(f(spark, docs, tiny), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_columns_and_order(steps):
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "line dedup", "near duplicates", "passage dedup", "packing"]
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(steps[-1].columns)


def test_clean_documents_stay_and_junk_goes(spark, tiny, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    good, bad = [d for d, q in labels.items() if q == 1], [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.95 * len(good) and sum(d in kept for d in bad) <= 0.3 * len(bad)


def test_lines(steps):
    from test_lines_chats_rules_shards import brute_lines

    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert Counter((r.doc_id, r.text) for r in steps[2].collect()) == Counter((k[0], k[3]) for k in brute_lines(rows).elements())


def test_near_duplicates(steps):
    from test_copies_and_passages import brute_components

    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert {r.doc_id for r in steps[3].collect()} == {c for _, _, c in brute_components(rows, 5, 80)}


def test_passages(steps):
    import hashlib

    from test_copies_and_passages import brute_spans

    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    after = {r.doc_id: r.text for r in steps[4].collect()}
    for d, size, removed, _, digest in brute_spans(rows, pipeline.PASSAGE_BYTES):
        left = after[d].encode()
        assert size - removed - 6 * 8 <= len(left) <= size - removed
        assert removed or hashlib.sha256(left).hexdigest() == digest


def test_packing_holds_every_token(steps):
    from tokenizers import Tokenizer

    from factloom.llm.kk_packing import default_tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    pieces = {}
    for r in steps[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    assert {d: [i for _, ids in sorted(p) for i in ids] for d, p in pieces.items()} == {d: t.encode(x or "", add_special_tokens=False).ids + [1] for d, x in texts.items()}


def test_run_gives_the_last_stage(spark, tiny, steps):
    assert pipeline.run(spark, tiny).count() == steps[-1].count()
