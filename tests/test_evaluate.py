from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from factloom.operators import evaluate, staging

WITHIN = "MaturitiesOrExpirationPeriodsDimension=WithinOneYear"


def test_answer_key_rules(spark):
    now, before, later = date(2025, 12, 31), date(2024, 12, 31), date(2026, 12, 31)
    facts = [
        ("d", "Equity", D(100), True, False, False, None, now), ("d", "Equity", D(90), True, False, False, None, before),
        ("d", "Equity", D(1), True, False, False, None, later), ("d", "Equity", D(7), True, False, True, "A=B", now),
        ("d", "Equity", D(80), True, False, False, None, date(2023, 12, 31)), ("d", "Equity", None, True, False, False, None, now),
        ("d", "Creditors", D(40), True, False, True, WITHIN, now), ("d", "Creditors", D(9), True, False, False, None, now),
        ("d", "Creditors", D(35), True, False, True, WITHIN, before), ("d", "Creditors", D(36), True, False, True, WITHIN, before),
        ("d", "Equity", D(5), True, True, False, None, now), ("d", "Unasked", D(5), True, False, False, None, now),
    ]
    schema = "document_id string, concept string, value decimal(38,9), is_numeric boolean, inconsistent boolean, dimensional boolean, dimensions string, instant date"
    f = spark.createDataFrame(facts, schema).selectExpr("*", "cast(null as date) as period_end")
    docs = spark.createDataFrame([("d", now)], "document_id string, period_end date")
    concepts = spark.createDataFrame([("Equity",), ("Creditors",), ("Equity",)], "concept string")
    got = {(r.concept, r.period): (r.value, r.ambiguous) for r in evaluate.ground_truth(f, docs, concepts).collect()}
    assert got == {("Equity", "current"): (100, False), ("Equity", "prior"): (90, False), ("Creditors", "current"): (40, False), ("Creditors", "prior"): (35, True)}


CASES = [  # concept, period, extracted, truth, outcome, error type
    ("Equity", "current", "100", "100", "correct", None), ("Equity", "prior", "-90", "90", "wrong", "sign_flipped"),
    ("Cash", "current", "12000", "12", "wrong", "scale_1000"), ("Cash", "prior", None, "8", "missed", None),
    ("Creditors", "current", "70", "50", "wrong", "period_swapped"), ("Creditors", "prior", "50", "70", "wrong", "period_swapped"),
    ("Fixed", "current", "5", None, "unsupported", None), ("Fixed", "prior", None, None, "not_applicable", None),
    ("Net", "current", "1001", "1000", "wrong", "near_miss"), ("Employees", "current", "2", "0.02", "tag_error", "truth_off_by_100"),
    ("Edge", "current", "100.99996", "100", "wrong", "near_miss"), ("Zero", "current", "0", "0.00", "correct", None),
    ("Other", "current", "5", "0", "wrong", "other"), ("Order", "current", "3000", "3", "wrong", "scale_1000"), ("Order", "prior", "1", "3000", "wrong", "other"),
]


def _scored(spark):
    keys = "document_id string, model string, prompt_id string, field string, concept string, period string, value decimal(38,9), confidence double, evidence string"
    values = [("d", "m", "p", c, c, p, None if e is None else D(e), 0.9, "") for c, p, e, *_ in CASES]
    truth = [("d", c, p, D(t), False) for c, p, _, t, *_ in CASES if t is not None] + [("d", "Fixed", "current", D(5), True)]
    return evaluate.scores(spark.createDataFrame(values, keys), spark.createDataFrame(truth, "document_id string, concept string, period string, value decimal(38,9), ambiguous boolean"))


def test_verdicts(spark):
    got = {(r.concept, r.period): (r.outcome, r.error_type) for r in _scored(spark).collect()}
    assert got == {(c, p): (o, e) for c, p, _, _, o, e in CASES}


def test_metrics_roll_up(spark):
    x = spark.createDataFrame([("d", "m", "p", 2.0, 100)], "document_id string, model string, prompt_id string, cost_usd double, latency_ms long")
    m = {r.concept: r for r in evaluate.metrics(_scored(spark), x).collect()}
    verifiable = [c for c in CASES if c[4] in ("correct", "wrong", "missed")]
    assert m["ALL"].verifiable == len(verifiable) and m["ALL"].correct == 2
    assert m["ALL"].usd_per_1000 == 2000 and m["Fixed"].precision is None
    by = evaluate.metrics_by_size(_scored(spark), spark.createDataFrame([("d", 2000)], "document_id string, text_chars int")).collect()
    assert [r.size_band for r in by] == ["2: 2k to 5k"]


def test_collapse_is_deterministic_and_counts_nil(spark):
    base = dict(document_id="d", concept="C", namespace="http://x/2025-01-01/core", context_id="c", is_numeric=True, batch_id="b", dimensional=False)
    schema = (
        "document_id string, concept string, namespace string, context_id string, is_numeric boolean, value decimal(38,9), text string, unit string, decimals string, "
        "format string, scale long, sign string, in_hidden boolean, period_start date, period_end date, instant date, dimensional boolean, batch_id string, dimensions string"
    )
    rows = [base | {"value": D(1), "text": "b", "in_hidden": False}, base | {"value": None, "text": "a", "in_hidden": True}, base | {"value": D(1), "text": "c", "in_hidden": False}]
    names = [x.split(" ")[0] for x in schema.split(", ")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in order], schema)
        r = staging.stg_facts(staging.stg_fact_occurrences(df)).first()
        assert (r.text, r.printed_text, r.occurrences, r.distinct_values, r.inconsistent, r.taxonomy, r.taxonomy_version) == ("a", "b", 3, 2, True, "core", "2025-01-01")
        assert r.value == 1 and not r.hidden_everywhere


def test_extraction_values_are_eighteen_rows(spark):
    import json

    from factloom.operators.extract import FakeModel

    text = FakeModel().answer("x").text
    df = spark.createDataFrame([("d", "m", "p", text)], "document_id string, model string, prompt_id string, extraction_json string").withColumn("batch_id", F.lit("b"))
    v = staging.stg_extraction_values(df)
    assert v.count() == 18 and v.where("field = 'cash' and period = 'current'").first().value == len("cash")
    assert json.loads(text)["overall_confidence"] == 0.9
