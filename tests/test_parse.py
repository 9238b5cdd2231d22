import re
import zipfile

import pytest
from pyspark.sql import functions as F

from factloom.operators import parse
from factloom.sources import archives


def synthetic(body: str) -> bytes:
    return f"""<html xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:xbrli="http://www.xbrl.org/2003/instance"
 xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:own="http://example.test/2023-04-01/own">
<head><title>no</title></head><body><ix:header><ix:hidden><ix:nonNumeric name="own:Name" contextRef="c1">Blue  Kite</ix:nonNumeric></ix:hidden><ix:resources>
<xbrli:context id="c1"><xbrli:entity><xbrli:identifier scheme="s">NI902114</xbrli:identifier></xbrli:entity><xbrli:period><xbrli:instant>2024-03-31</xbrli:instant></xbrli:period></xbrli:context>
<xbrli:context id="c2"><xbrli:entity><xbrli:identifier scheme="s">NI902114</xbrli:identifier><xbrli:segment><xbrldi:explicitMember dimension="own:Axis">own:Part</xbrldi:explicitMember></xbrli:segment></xbrli:entity>
<xbrli:period><xbrli:startDate>2023-04-01</xbrli:startDate><xbrli:endDate>2024-03-31</xbrli:endDate></xbrli:period></xbrli:context>
<xbrli:unit id="u"><xbrli:measure>iso4217:GBP</xbrli:measure></xbrli:unit></ix:resources></ix:header>{body}</body></html>""".encode()


NAME = "Prod1_1_NI902114_20240331.html"
FACT = '<p>Equity <ix:nonFraction name="own:Equity" contextRef="c1" unitRef="u" format="ixt:numcommadot" decimals="0" scale="3" sign="-">7,005</ix:nonFraction></p>'


def parsed(spark, body, name=NAME):
    return parse.parse_members(spark.createDataFrame([("k.zip", name, body)], "source_key string, member_name string, content binary"))


def test_facts_and_text(spark):
    table = '<table><tr><td>Cash</td><td></td><td>2.00</td></tr></table><ix:nonNumeric name="own:Text" contextRef="c2">some\n text</ix:nonNumeric>'
    p = parsed(spark, synthetic(FACT + table)).cache()
    row = p.first()
    assert row.reason is None and row.entity_identifier == "NI902114" and row.document_id == "NI902114_20240331"
    assert row.text == "Equity 7,005\n\nCash | 2.00\n\nsome\ntext\n"
    facts = {f.concept: f for f in parse.fact_rows(p, "b").collect()}
    e = facts["Equity"]
    assert (e.value, e.unit, e.namespace, str(e.instant), e.dimensional, e.in_hidden) == (-7005000, "GBP", "http://example.test/2023-04-01/own", "2024-03-31", False, False)
    assert facts["Name"].in_hidden and facts["Name"].text == "Blue Kite" and facts["Name"].value is None
    assert facts["Text"].dimensions == "Axis=Part" and str(facts["Text"].period_start) == "2023-04-01"
    assert parse.document_rows(p, "b", "2023-04-01").first().fact_count == 3
    assert parse.quarantine_rows(p, "b", "2023-04-01").count() == 0


@pytest.mark.parametrize(
    ("name", "body", "reason"),
    [
        (NAME, b"<html><p></html>", "MalformedDocumentError"), (NAME, b"<html/>", "NotInlineXbrlError"), ("notes/README.txt", b"x", "UnknownDocumentNameError"),
        ("Prod1_1_NI902114_20240331_CIC.zip", b"x", "nested_archive"), (NAME, synthetic(FACT.replace("numcommadot", "nosuchformat")), "UnsupportedFormatError"),
        (NAME, synthetic(FACT.replace('scale="3"', 'scale="x"')), "Unexpected:ValueError"),
    ],
)
def test_quarantine(spark, name, body, reason):
    p = parsed(spark, body, name)
    q = parse.quarantine_rows(p, "b", "2023-04-01").collect()
    assert [r.reason for r in q] == [reason] and parse.fact_rows(p, "b").count() == 0


def test_one_event_an_element_only_where_prefixes_are_declared_below_the_root(monkeypatch):
    """Most documents are read without it; both ways give the same."""
    root = synthetic("").partition(b"<head>")[0]
    deep = synthetic('<p xmlns:own="deep">' + FACT + "</p>" + FACT)
    odd = [
        b"<!-- <b> -->" + synthetic(FACT), synthetic(FACT).decode().encode("utf-16"), synthetic(FACT).replace(b"2023-04-01/own", b"a>b"), deep,
        b"<!DOCTYPE html [<!ENTITY e '<p xmlns:own=\"deep\">x</p>'>]>" + synthetic("&e;" + FACT), b"\xef\xbb\xbf" + synthetic(FACT), synthetic(FACT + "<!-- xmlns -->"),
    ]
    whole = parse.tree_with_prefixes
    gone = []
    monkeypatch.setattr(parse, "tree_with_prefixes", lambda data: (gone.append(data), whole(data))[1])
    plain = [synthetic(FACT), synthetic("<ix:hidden>" + FACT + "</ix:hidden>" + FACT), root + FACT.encode() + b"</html>"]
    tagged = lambda t: [(e.attrib, scope, hidden) for e, scope, hidden in t[1]]
    for data in plain:
        assert tagged(parse.tree(data)) == tagged(whole(data)) and len(whole(data)[1]) > 0
    assert not gone
    for data in odd:
        assert tagged(parse.tree(data)) == tagged(whole(data)) and len(whole(data)[1]) > 0
    assert [s["own"] for _, s, _ in parse.tree(deep)[1]][1:] == ["deep", "http://example.test/2023-04-01/own"]
    assert len(gone) >= 4


def test_numbers_and_text_left_out(spark):
    """Plain numbers come from the parser, others from the expression; text that nothing reads is not made."""
    body = FACT + FACT.replace("7,005", "1 2").replace("own:Equity", "own:Odd")
    rows = spark.createDataFrame([("k.zip", NAME, synthetic(body))], "source_key string, member_name string, content binary")
    for with_text in (True, False):
        p = parse.parse_members(rows, with_text)
        row = p.first()
        assert (row.text is not None) == with_text and row.reason is None
        assert {f.concept: f.number for f in row.facts} == {"Name": None, "Equity": -7005000, "Odd": None}
        assert {r.concept: r.value for r in parse.fact_rows(p, "b").collect()} == {"Name": None, "Equity": -7005000, "Odd": -12000}


def test_nil_is_kept_without_a_value(spark):
    body = '<ix:nonFraction name="own:Equity" contextRef="c1" unitRef="u" xsi:nil="true">n/a</ix:nonFraction>'
    f = [r for r in parse.fact_rows(parsed(spark, synthetic(body)), "b").collect() if r.concept == "Equity"]
    assert len(f) == 1 and f[0].value is None and f[0].is_numeric


@pytest.fixture
def raw(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/", b"")
        for i in range(6):
            z.writestr(f"Prod1_1_0000000{i}_20240331.html", synthetic(FACT), zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED)
        z.writestr("z.txt", b"")
        z.writestr("a.txt", b"")
    (tmp_path / "broken.zip").write_bytes(b"PK no archive")
    return tmp_path


def test_archives(spark, raw):
    ok = {r.source_key: (r.members, r.error) for r in archives.validated(spark, str(raw)).collect()}
    assert ok["a.zip"] == (8, None) and ok["broken.zip"][0] is None and ok["broken.zip"][1]
    assert "larger" in {r.error for r in archives.validated(spark, str(raw), "a.zip", max_bytes=10).collect()}.pop()
    m = archives.members(spark, str(raw), partition_bytes=1000).where("error is null").cache()
    assert m.count() == 8 and {r.source_key for r in m.collect()} == {"a.zip"} and m.where("byte_count = octet_length(content)").count() == 8
    few, more = ({r.member_name for r in archives.select_members(m, n).collect()} for n in (2, 4))
    assert few < more and "a.txt" in few and len(few) == 4
    assert parse.parse_members(m).where("reason is null").count() == 6
    names = archives.members(spark, f"file://{raw}", "a.zip", with_content=False)
    assert names.where("content is null").count() == 8 and archives.members(spark, str(raw), "none.zip").count() == 0


def test_members_that_cannot_be_read(spark, raw):
    """A damaged byte costs one member, a lost end the whole archive."""
    whole = (raw / "a.zip").read_bytes()
    entry = {m[1]: m for m in archives.directory(str(raw / "a.zip"))}["Prod1_1_00000003_20240331.html"]
    at = entry[2] + 30 + len(entry[1]) + entry[3] // 2
    (raw / "a.zip").write_bytes(whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :])
    bad = archives.members(spark, str(raw), "a.zip").where("error is not null").collect()
    assert [r.member_name for r in bad] == [entry[1]] and bad[0].content is None and bad[0].error.startswith("Truncated")
    assert [(r.members, r.error) for r in archives.validated(spark, str(raw), "a.zip").collect()] == [(8, bad[0].error)]
    (raw / "a.zip").write_bytes(whole[: len(whole) // 2])
    assert [r.place for r in archives.members(spark, str(raw), "a.zip").collect()] == [None]


def test_a_large_archive_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("concat('big', id div 20000, '.zip') as source_key", "concat('m', id, '.html') as member_name", "cast(repeat(cast(id as string), 20) as binary) as content")
    assert [tuple(r) for r in archives.write_archives(rows, f"file://{tmp_path}/zips").collect()] == [("big0.zip", 20_000)]
    m = archives.members(spark, f"{tmp_path}/zips", partition_bytes=20_000)
    assert m.rdd.getNumPartitions() == 10
    same = m.withColumn("n", F.regexp_extract("member_name", r"m(\d+)", 1)).where(F.col("content").cast("string") == F.repeat("n", 20))
    assert same.count() == m.count() == 20_000 and same.select("place").distinct().count() == 20_000


def test_plans_hold_no_members(tmp_path):
    """What is planned of an archive is as large as its runs, not as its members; small archives share partitions."""
    import pickle

    with zipfile.ZipFile(tmp_path / "big.zip", "w") as z:
        for i in range(5000):
            z.writestr("d/" if i == 17 else f"{'a long name ' * 8}{i}.html", b"" if i == 17 else str(i).encode() * 20, zipfile.ZIP_DEFLATED)
    (tmp_path / "after.zip").write_bytes(b"something before it" + (tmp_path / "big.zip").read_bytes())
    with zipfile.ZipFile(tmp_path / "after.zip", "a") as z:
        z.comment = b"a comment"
    whole = archives.directory(str(tmp_path / "big.zip"))
    reader = lambda most, **o: archives.ZipReader({"path": str(tmp_path), "partitionbytes": str(most), **o})
    for key, moved in (("big.zip", 0), ("after.zip", len(b"something before it"))):
        plan = reader(10_000, sourcekey=key).partitions()
        found = [m for r in plan for p in r.parts for m in p.members()]
        assert found == [(*m[:2], m[2] + moved, *m[3:]) for m in whole] and len(plan) > 3
        assert len(pickle.dumps(plan)) < 300 * len(plan) + 1000
        assert [m[2] for m in found] == [m[2] for m in archives.directory(str(tmp_path / key))]
    for i in range(40):
        with zipfile.ZipFile(tmp_path / f"small{i:02}.zip", "w") as z:
            z.writestr("a", b"1")
    small = [r for r in reader(1_000_000_000).partitions() if len(r.parts) > 1]
    assert sum(len(r.parts) for r in small) >= 40 and 40 <= sum(b.num_rows for r in small for b in reader(1_000_000_000).read(r) if b["byte_count"][0].as_py() == 1)
    assert len(reader(1_000_000_000, partitions="8").partitions()) >= 3


def test_a_large_archive_beyond_zip64(tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w") as z:
        for i in range(66_000):  # more than the old record can count
            z.writestr(zipfile.ZipInfo(f"{i}"), b"")
        z.writestr(zipfile.ZipInfo("last"), b"x" * 500)
    plan = archives.ZipReader({"path": str(tmp_path), "partitionbytes": "400"}).partitions()
    assert [m for r in plan for p in r.parts for m in p.members()] == archives.directory(str(tmp_path / "many.zip")) and len(plan) == 2
    data = bytearray((tmp_path / "many.zip").read_bytes())
    at = data.rindex(archives.ENTRY_MARK)
    data[at : at + 4] = b"junk"
    (tmp_path / "many.zip").write_bytes(data)
    (run,) = archives.ZipReader({"path": str(tmp_path), "partitionbytes": "400"}).partitions()
    assert run.parts[0].error


def test_create_only(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    for name, body in (("one", b"1"), ("two", b"2")):
        (tmp_path / name).write_bytes(body)
    first, again = (archives.store_once(spark, root, "a b'c.zip", str(tmp_path / name)) for name in ("one", "two"))
    assert first[0] and not again[0] and first[1] == again[1]
    place = archives.raw_place(spark, root, "a b'c.zip")
    assert open(place.removeprefix("file://"), "rb").read() == b"1" and archives.raw_place(spark, root, "other.zip") is None
    assert archives.ingest_status(False, again[1], "other", False) == "failed"
    assert archives.ingest_status(False, again[1], again[1], False) == "succeeded"


def test_every_document_is_parsed_once(spark, raw):
    p = parse.parse_members(archives.members(spark, str(raw)))
    for rows in (parse.fact_rows(p, "b"), parse.document_rows(p, "b", "2023-04-01"), parse.quarantine_rows(p, "b", "2023-04-01")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.count("transform(") <= 3


def test_the_answer_key_stores_what_it_reads_and_deals_facts_once(spark, tiny, monkeypatch):
    from factloom.plans import tagged

    kept = []
    stored = tagged.stored
    monkeypatch.setattr(tagged, "stored", lambda df: (kept.append(df.columns), stored(df))[1])
    key = tagged.ground_truth_from_tags(spark, tiny)
    plan = key._jdf.queryExecution().executedPlan().toString()
    assert len(kept) == 1 and not {"text", "sha256", "error"} & set(kept[0])
    # By document alone: nothing is dealt again for the facts' contexts, dates and periods.
    dealt = re.findall(r"hashpartitioning\((\w+)#\d+(, \w+#)?", plan)
    assert ("document_id", "") in dealt and {d for d in dealt if d[0] == "document_id"} == {("document_id", "")}, dealt
