from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from factloom.functions import exprs as X

# text, format, scale, sign, number: each rule by figures of its own. The names of the formats.
TRANSFORM = [
    ("98,765,432", "ixt:numcommadot", None, None, "98765432"), ("7,004.125", "ixt2:numdotdecimal", None, None, "7004.125"),
    ("31.415,9", "ixt:numdotcomma", None, None, "31415.9"), ("6.022,5", "ixt4:num-comma-decimal", 1, "-", "-60225"),
    ("88\u00a0044", "ixt:numdotdecimal", None, None, "88044"), ("5 017", None, None, None, "5017"),
    ("nil", "ixt:zerodash", 6, None, "0"), ("--", "ixt:numdash", None, "-", "0"), ("none", "ixt4:fixed-zero", None, None, "0"),
    ("40.70", None, None, None, "40.70"), ("3,3", None, 2, None, "3300"), (" 61 ", None, None, "-", "-61"), ("70", None, 6, None, "70000000"),
    ("19", None, -4, "-", "-0.0019"), (".25", None, 0, None, "0.25"), ("9.", None, None, None, "9"), ("2e3", None, -1, None, "200"), ("+8", None, None, None, "8"),
    ("   ", None, 3, "-", None), ("", "ixt:zerodash", None, None, None), (None, None, None, None, None),
]
BAD = [("about 5", None), ("", "ixt:nosuchformat"), ("44", "ixt:nosuchformat"), ("4.4.4", "ixt:numdotdecimal"), ("1e", None), ("-", None)]


def test_transform_numeric(spark):
    rows = [(t, f, s, g) for t, f, s, g, _ in TRANSFORM] + [(t, f, None, None) for t, f in BAD]
    df = spark.createDataFrame(rows, "text string, fmt string, scale int, sign string")
    got = df.select(X.transform_numeric(*[F.col(c) for c in df.columns]).alias("r")).collect()
    for (r,), (*_, want) in zip(got, TRANSFORM, strict=False):
        assert r["error"] is None
        assert r["value"] == (None if want is None else Decimal(want))
    assert all(r[0]["error"] for r in got[len(TRANSFORM) :])


GOOD = {
    "40": "40", "6,012": "6012", "$77": "77", "€3,000,000.5": "3000000.5", "(909)": "-909", "( 1,010 )": "-1010", "-£12": "-12", "\t8\n": "8",
    "5 500": "5500", "0.75": "0.75", "123,456,789,012": "123456789012",
}
NOT = [" ", "()", "nil", "7%", "4.5.6", "9m", "-(3)", "(-3)", "- -3", "10,00", "1,0000", ",500", "5.", "2 2", "7,,000"]


def test_normalise_number(spark):
    df = spark.createDataFrame([(x,) for x in [*GOOD, *NOT]], "raw string")
    got = {r["raw"]: r["n"] for r in df.select("raw", X.normalise_number(F.col("raw")).alias("n")).collect()}
    assert {k: got[k]["value"] for k in GOOD} == GOOD
    assert all(got[k]["value"] is None and got[k]["error"] for k in NOT)
    assert {k: X.written_number(k) for k in got} == {k: v["value"] for k, v in got.items()}


def test_safe_casts(spark):
    r = spark.sql("select '1.0000000005' a, 'abc' b, '2025' c, '2025-02-30' d, '2025-02-03' e").select(
        X.safe_decimal(F.col("a")), X.safe_decimal(F.col("b")), X.safe_date(F.col("c")), X.safe_date(F.col("d")), X.safe_date(F.col("e"))
    ).first()
    assert r[0] == Decimal("1.000000001") and r[1] is None and r[2] is None and r[3] is None and str(r[4]) == "2025-02-03"


def test_prices_and_labels(spark):
    one = spark.range(1)
    cost = lambda m, *n: one.select(X.cost_usd(F.lit(m), *[F.lit(x) for x in n])).first()[0]
    assert cost("gemini-3.1-flash-lite", 1_000_000, 0, 0) == pytest.approx(0.25)
    assert cost("gemini-3.8-flash", 0, 1_000_000, 0) == cost("gemini-3.8-flash@t0", 0, 0, 1_000_000) == pytest.approx(3.75)
    assert cost("unknown", 1, 1, 1) is None
    assert one.select(X.label_value(F.lit("A model 3.1"))).first()[0] == "a-model-3-1"


def test_document_key(spark):
    names = ["x/Prod223_4298_SC123456_20251231.html", "Prod1_2_01234567_20251301.html", "notes.txt", "Prod1_2_1234_20251231.xml", "Prod1_2_07114506_20251231_CIC.zip"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select(*[c.alias(k) for k, c in X.document_key(F.col("n")).items()]).collect()
    assert got[0]["document_id"] == "SC123456_20251231" and not got[0]["is_archive"]
    assert [r["document_id"] for r in got[1:4]] == [None] * 3
    assert got[4]["is_archive"]


def test_plain_numbers_are_what_the_expression_gives(spark):
    texts = ["0", "007", "1,234", "1,2,3", "12.5", "1.234,5", "1.", ".5", "", "-", "-3", "1 000", "123456789012345", "1234567890123456", "1.00001", "1.0001", "2e3", "٣", "1,234.56", "(5)"]
    formats = [None, "numdotdecimal", "ixt:numcommadot", "ixt:num-dot-decimal", "a:b:numdotdecimal", "ixt:numdotcomma", "numcommadecimal", "ixt:zerodash", "ixt:nosuch", "", ":numdotdecimal"]
    cases = [(t, f, s, g) for t in texts for f in formats for s in (None, "0", "9", "-1", "12", " 3") for g in (None, "-", "+")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, f string, s string, g string")
    got = df.select("i", X.transform_numeric(F.col("t"), F.col("f"), F.col("s").try_cast("int"), F.col("g")).alias("x")).collect()
    plain = {i: n for i, c in enumerate(cases) if (n := X.plain_number(*c)) is not None}
    assert len(plain) > 300
    assert all(r.x.error is None and r.x.value == plain[r.i] for r in got if r.i in plain)
