"""Tagged documents to facts and text. One pass over the bytes gives both, or the reason why there is neither."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import document_key, once, plain_number, safe_date, transform_numeric
from ..schemas import PARSER_VERSION

#: The two inline-tag namespaces and what goes with them.
INLINE = ("http://www.xbrl.org/2008/inlineXBRL", "http://www.xbrl.org/2013/inlineXBRL")
INSTANCE = "http://www.xbrl.org/2003/instance"
DIMENSIONS = "http://xbrl.org/2006/xbrldi"
NIL = (f"{{{INSTANCE}}}nil", "{http://www.w3.org/2001/XMLSchema-instance}nil")
#: Tags that end a line, tags of cells, tags that are left out.
BLOCK = frozenset(
    "p div br h1 h2 h3 h4 h5 h6 li ul ol table tr thead tbody tfoot section article header footer hr blockquote pre dl dt dd caption".split()
)
CELL = frozenset(("td", "th"))
DROP = frozenset(("script", "style", "head", "title"))
#: The full names of tagged facts, and of what a context holds.
FACTS = {f"{{{ns}}}{name}": name == "nonFraction" for ns in INLINE for name in ("nonFraction", "nonNumeric")}
IDENTIFIER, START, END, INSTANT, SEGMENT, SCENARIO = (f"{{{INSTANCE}}}{n}" for n in ("identifier", "startDate", "endDate", "instant", "segment", "scenario"))
MEMBER = f"{{{DIMENSIONS}}}explicitMember"
_FIRST_TAG = re.compile(rb"<[A-Za-z_][^>]*>")

_OCCURRENCE = (
    "struct<concept:string,namespace:string,context_id:string,is_numeric:boolean,text:string,unit:string,decimals:string,format:string,"
    "scale:string,sign:string,nil:boolean,in_hidden:boolean,number:decimal(38,9)>"  # number: of plain numbers only
)
_CONTEXT = "struct<entity:string,start:string,end:string,instant:string,dimensional:boolean,dimensions:string>"
PARSED = (
    f"reason string, error string, ix_namespace string, entity_identifier string, text string, facts array<{_OCCURRENCE}>, contexts map<string,{_CONTEXT}>"
)


class ParseError(Exception):
    """A document that can't be parsed; the reason is the name of the kind."""


class MalformedDocumentError(ParseError):
    pass


class NotInlineXbrlError(ParseError):
    pass


@lru_cache(10_000)
def _local(tag: str) -> tuple[str, str]:
    ns, _, name = tag.rpartition("}")
    return ns[1:], name


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def tree_with_prefixes(data: bytes) -> tuple[ET.Element, list[tuple]]:
    """The root element and each tagged fact element in order, with the prefixes in scope there and whether it is hidden."""
    scopes: list[dict[str, str]] = [{}]
    waiting: dict[str, str] = {}
    hidden = 0
    tagged: list[tuple] = []
    root = None
    try:
        for event, item in ET.iterparse(io.BytesIO(data), ("start-ns", "start", "end")):
            if event == "start-ns":
                waiting[item[0]] = item[1]
            elif event == "start":
                root = item if root is None else root
                scopes.append(scopes[-1] | waiting if waiting else scopes[-1])
                waiting = {}
                ns, name = _local(item.tag)
                if ns in INLINE:
                    hidden += name == "hidden"
                    if name in ("nonFraction", "nonNumeric"):
                        tagged.append((item, scopes[-1], hidden > 0))
            else:
                scopes.pop()
                ns, name = _local(item.tag)
                hidden -= ns in INLINE and name == "hidden"
    except ET.ParseError as e:
        raise MalformedDocumentError(str(e)) from e
    return root, tagged


@lru_cache(1000)
def _declared(head: bytes) -> dict[str, str] | None:
    """The prefixes that the root declares, if a document's first bytes end with its root's tag; documents of one maker begin alike."""
    parser = ET.XMLPullParser(("start-ns", "start"))
    try:
        parser.feed(head)
        events = list(parser.read_events())
    except ET.ParseError:
        return None
    return dict(x for kind, x in events if kind == "start-ns") if events and events[-1][0] == "start" else None


def tree(data: bytes) -> tuple[ET.Element, list[tuple]]:
    """What tree_with_prefixes gives, without an event for each element where only the root can declare prefixes."""
    first = _FIRST_TAG.search(data)
    plain = first is not None and data.find(b"xmlns", first.end()) < 0 and data.find(b"<!DOCTYPE", 0, first.start()) < 0
    scope = _declared(data[: first.end()]) if plain else None
    if scope is None:
        return tree_with_prefixes(data)
    try:
        root = ET.fromstring(data)
    except ET.ParseError as e:
        raise MalformedDocumentError(str(e)) from e
    hidden = {id(e) for ns in INLINE for h in root.iter(f"{{{ns}}}hidden") for e in h.iter()}
    return root, [(e, scope, id(e) in hidden) for e in root.iter() if e.tag in FACTS]


def _contexts(root) -> dict[str, tuple]:
    """entity, start, end, instant, dimensional, dimensions by id."""
    out = {}
    for c in root.iter(f"{{{INSTANCE}}}context"):
        said: dict[str, str] = {}
        explicit, dimensional = [], False
        for x in c.iter():
            if x.tag == MEMBER:
                explicit.append(f"{x.get('dimension', '').rpartition(':')[2]}={(x.text or '').strip().rpartition(':')[2]}")
            elif x.tag == SEGMENT or x.tag == SCENARIO:
                dimensional = True
            elif x.text and x.tag not in said:
                said[x.tag] = x.text.strip()
        out[c.get("id", "")] = (said.get(IDENTIFIER), said.get(START), said.get(END), said.get(INSTANT), dimensional, ";".join(sorted(explicit)) or None)
    return out


def _units(root) -> dict[str, str]:
    return {
        u.get("id", ""): "/".join((m.text or "").strip().rpartition(":")[2] for m in u.iter(f"{{{INSTANCE}}}measure"))
        for u in root.iter(f"{{{INSTANCE}}}unit")
    }


def parse_document(data: bytes, with_text: bool = True) -> dict:
    """Facts, contexts and text of one document; raises ParseError."""
    root, tagged = tree(data)
    inline = next((ns for ns in (_local(e.tag)[0] for e in root.iter() if isinstance(e.tag, str)) if ns in INLINE), None)
    if inline is None:
        raise NotInlineXbrlError("no inline tags")
    contexts, units = _contexts(root), _units(root)
    facts = []
    for e, scope, hidden in tagged:
        if not e.get("name"):
            continue
        numeric = FACTS[e.tag]
        prefix, _, concept = e.get("name").rpartition(":")
        unit, fmt, scale, sign = e.get("unitRef"), e.get("format"), e.get("scale"), e.get("sign")
        text = _squeezed("".join(e.itertext()) if len(e) else e.text or "")
        nil = any(e.get(n) == "true" for n in NIL)
        facts.append((
            concept, scope.get(prefix, ""), e.get("contextRef", ""), numeric, text, units.get(unit, unit) if numeric else None, e.get("decimals"),
            fmt, scale, sign, nil, hidden, plain_number(text, fmt, scale, sign) if numeric and not nil else None,
        ))
        if scale is not None:
            int(scale)  # a scale that is no number is an unexpected error
    entity = next((c[0] for c in contexts.values() if c[0]), None)
    return {"ix_namespace": inline, "entity_identifier": entity, "facts": facts, "contexts": contexts, "text": render(root) if with_text else None}


def _tidy(parts: list[str]) -> str:
    lines: list[str] = []
    for line in "".join(parts).split("\n"):
        line = _squeezed(line)
        if line or (lines and lines[-1]):
            lines.append(line)
    return "\n".join(lines).strip() + "\n"


@lru_cache(10_000)
def _kind(tag: str) -> str:
    ns, name = _local(tag)
    if (ns in INLINE and name in ("header", "exclude")) or name in DROP:
        return "drop"
    return "tr" if name == "tr" else "block" if name in BLOCK else ""


def render(root) -> str:
    """Plain text: tags that end lines break them, a table row is one line with ' | ' between its cells."""
    parts: list[str] = []
    # An explicit stack: (what to do, element or text, where to write).
    work: list[tuple] = [("open", root, parts)]
    while work:
        kind, item, to = work.pop()
        if kind == "text":
            to.append(item)
            continue
        if kind == "cell":
            cells, buffer = item
            if text := _squeezed("".join(buffer)):
                cells.append(text)
            continue
        if kind == "row":
            to.append("\n" + " | ".join(item) + "\n")
            continue
        tag, tail = item.tag, item.tail or ""
        kind = _kind(tag) if isinstance(tag, str) else "drop"
        if kind == "drop":
            if tail:
                to.append(tail)
        elif kind == "tr":
            cells: list[str] = []
            steps: list[tuple] = []
            for child in item:
                if not isinstance(child.tag, str):
                    continue
                if _local(child.tag)[1] in CELL:
                    buffer: list[str] = []
                    steps += [("open", child, buffer), ("cell", (cells, buffer), to)]
                else:
                    steps.append(("open", child, to))
            if tail:
                work.append(("text", tail, to))
            work += [("row", cells, to), *reversed(steps)]
        else:
            edge = "\n" if kind else ""
            if before := edge + (item.text or ""):
                to.append(before)
            if after := edge + tail:
                work.append(("text", after, to))
            if len(item):
                work += [("open", c, to) for c in reversed(item)]
    return _tidy(parts)


def _struct(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.StructArray:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _offsets(sizes: list[int | None]) -> pa.Array:
    """Where each list begins, and the end; null where there is none."""
    out, at = [], 0
    for n in sizes:
        out.append(None if n is None else at)
        at += n or 0
    return pa.array([*out, at], pa.int32())


def _kinds(struct: str) -> dict[str, pa.DataType]:
    of = {"string": pa.string(), "boolean": pa.bool_(), "decimal(38,9)": pa.decimal128(38, 9)}
    return {n: of[kind] for n, kind in re.findall(r"(\w+):([^,>(]+(?:\(.*?\))?)", struct)}


def _parse_array(contents: pa.Array, with_text: bool = True) -> pa.Array:
    """Columns, not rows, are handed back: lists of facts and maps of contexts are cut from one array of each."""
    heads: list[tuple] = []
    facts: list[tuple] = []
    keys: list[str] = []
    contexts: list[tuple] = []
    sizes: list[tuple[int | None, int | None]] = []
    for data in contents:
        head, size = (None,) * 5, (None, None)
        if data.is_valid:
            try:
                p = parse_document(data.as_py(), with_text)
                head, size = (None, None, p["ix_namespace"], p["entity_identifier"], p["text"]), (len(p["facts"]), len(p["contexts"]))
                facts += p["facts"]
                keys += p["contexts"]
                contexts += p["contexts"].values()
            except ParseError as e:
                head = (type(e).__name__, str(e)[:1000], None, None, None)
            except Exception as e:  # whatever goes wrong with one document ends in quarantine, not in a failed job
                head = (f"Unexpected:{type(e).__name__}", str(e)[:1000], None, None, None)
        heads.append(head)
        sizes.append(size)
    columns = [pa.array([h[i] for h in heads], pa.string()) for i in range(5)]
    columns.append(pa.ListArray.from_arrays(_offsets([n for n, _ in sizes]), _struct(facts, _kinds(_OCCURRENCE))))
    columns.append(pa.MapArray.from_arrays(_offsets([n for _, n in sizes]), pa.array(keys, pa.string()), _struct(contexts, _kinds(_CONTEXT))))
    return pa.StructArray.from_arrays(columns, names=["reason", "error", "ix_namespace", "entity_identifier", "text", "facts", "contexts"])


def parse_members(rows: DataFrame, with_text: bool = True) -> DataFrame:
    """source_key, member_name, content -> the document's key, what was parsed, and the reason if nothing was. with_text: false where
    nothing reads the text, which is null then.

    The numbers are worked out from text, format, scale and sign by expressions, those that are plainly written while parsing;
    one unknown format rejects the document.
    """

    def _parse(contents: pa.Array) -> pa.Array:
        return _parse_array(contents, with_text)

    k = document_key(F.col("member_name"))
    d = rows.select("source_key", "member_name", "content", *[c.alias(n) for n, c in k.items()])
    early = F.when(F.col("document_id").isNull(), "UnknownDocumentNameError").when(F.col("is_archive"), "nested_archive")
    d = d.withColumn("early", early)
    # Not deterministic as far as the optimizer knows, so that no filter on what it gives has a copy of it.
    p = F.arrow_udf(_parse, PARSED).asNondeterministic()(F.when(F.col("early").isNull(), F.col("content")))
    d = d.withColumn("p", p).select(
        "source_key", "member_name", "document_id", "company_number", "period_end", F.length("content").cast("long").alias("byte_count"),
        F.sha2("content", 256).alias("sha256"), F.coalesce("early", "p.reason").alias("reason"), F.coalesce("p.error", "early").alias("error"),
        "p.ix_namespace", "p.entity_identifier", "p.text", "p.facts", "p.contexts",
    )

    def value(f):
        plain = F.struct(f["number"].alias("value"), F.lit(None).cast("string").alias("error"))
        other = transform_numeric(f["text"], f["format"], f["scale"].try_cast("int"), f["sign"])
        return F.when(f["number"].isNotNull(), plain).when(f["is_numeric"] & ~f["nil"], other)

    values = F.transform("facts", value)
    d = once(d, "values", values)
    bad = F.exists("values", lambda v: F.coalesce(v["error"].isNotNull(), F.lit(False)))
    d = d.withColumn("reason", F.coalesce("reason", F.when(bad, "UnsupportedFormatError")))
    return d.withColumn("error", F.coalesce("error", F.when(bad, "unsupported number format")))


def fact_rows(parsed: DataFrame, batch: str) -> DataFrame:
    """The facts table's rows of the documents that were parsed."""
    f = parsed.where("reason is null").select("document_id", "contexts", F.explode(F.arrays_zip("facts", "values")).alias("x"))
    f = f.select("document_id", "x.facts", F.col("x.values.value").alias("value"), F.try_element_at("contexts", F.col("x.facts.context_id")).alias("c"))
    own = ("concept", "namespace", "context_id", "is_numeric")
    return f.select(
        "document_id", *[F.col(f"facts.{c}") for c in own], "value", F.col("facts.text"), F.col("facts.unit"), F.col("facts.decimals"),
        F.col("facts.format"), F.col("facts.scale").try_cast("long").alias("scale"), F.col("facts.sign"), F.col("facts.in_hidden"),
        safe_date(F.col("c.start")).alias("period_start"), safe_date(F.col("c.end")).alias("period_end"), safe_date(F.col("c.instant")).alias("instant"),
        F.coalesce("c.dimensional", F.lit(False)).alias("dimensional"), F.lit(batch).alias("batch_id"), F.col("c.dimensions").alias("dimensions"),
    )


def document_rows(parsed: DataFrame, batch: str, at) -> DataFrame:
    return parsed.where("reason is null").select(
        "document_id", "source_key", "member_name", "company_number", "period_end", "byte_count", "sha256", "ix_namespace", "entity_identifier",
        F.size("facts").cast("long").alias("fact_count"), "text", F.lit(batch).alias("batch_id"), F.lit(at).cast("timestamp").alias("parsed_at"),
        F.lit(PARSER_VERSION).cast("long").alias("parser_version"),
    )


def quarantine_rows(parsed: DataFrame, batch: str, at, stage: str = "parse") -> DataFrame:
    return parsed.where("reason is not null").select(
        "document_id", "source_key", "member_name", F.lit(stage).alias("stage"), "reason", F.left(F.coalesce("error", "reason"), F.lit(1000)).alias("error"),
        F.lit(batch).alias("batch_id"), F.lit(at).cast("timestamp").alias("quarantined_at"), F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("string").alias("prompt_id"), F.lit(None).cast("timestamp").alias("released_at"),
    )
