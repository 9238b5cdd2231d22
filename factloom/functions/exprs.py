"""Column builders: casts that never fail, numbers as people write them, names, hashes, vectors, prices."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EMBEDDING_DIMS, NUMERIC, PRICES


def safe_decimal(c: Column) -> Column:
    """Text to decimal(38,9), rounded half up; null if it is no number."""
    return c.try_cast(NUMERIC)


def safe_date(c: Column) -> Column:
    """ISO text to a date; null for anything else, a bare year included."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date"))


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group that a pattern captures; null, not '', where it doesn't match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def stable_rank(c: Column) -> Column:
    """A text that orders rows the same way everywhere, for samples that only grow with their cap."""
    return F.sha2(c.cast("string").cast("binary"), 256)


def batch_id(ids: Column, *salt: Column) -> Column:
    """16 hex digits over the sorted members; the same members and salt give the same batch."""
    return F.left(F.sha2(F.array_join(F.concat(F.array(*salt), F.array_sort(ids)), "\n").cast("binary"), 256), F.lit(16))


_MEMBER = r"^Prod\d+_\d+_([A-Z0-9]{8})_(\d{8})(_CIC)?\.(html|xhtml|xml|zip)$"


def document_key(member: Column) -> dict[str, Column]:
    """company_number, period_end, document_id and is_archive of an archive member's name; all null if it isn't one
    or its date doesn't exist."""
    base = F.substring_index(member, "/", -1)
    day = F.try_to_timestamp(found(base, _MEMBER, 2), F.lit("yyyyMMdd")).cast("date")
    ok = day.isNotNull()
    return {
        "company_number": F.when(ok, found(base, _MEMBER, 1)),
        "period_end": day,
        "document_id": F.when(ok, F.concat_ws("_", found(base, _MEMBER, 1), found(base, _MEMBER, 2))),
        "is_archive": F.when(ok, F.coalesce(found(base, _MEMBER, 3), F.lit("")).eqNullSafe("_CIC") | (found(base, _MEMBER, 4) == "zip")),
    }


#: The number formats, by the local name without hyphens.
DOT_FORMATS = ("numcommadot", "numdotdecimal")
COMMA_FORMATS = ("numdotcomma", "numcommadecimal")
ZERO_FORMATS = ("numdash", "zerodash", "fixedzero")


def transform_numeric(text: Column, fmt: Column, scale: Column, sign: Column) -> Column:
    """struct(value decimal(38,9), error): a tagged number as its format, scale and sign say.

    Empty text is null, not zero; an unknown format is an error even on empty text.
    """
    clean = F.trim(F.translate(text, "   ", "   "))
    clean = F.regexp_replace(clean, r"^\s+|\s+$", "")
    local = F.replace(F.when(F.instr(fmt, ":") > 0, F.regexp_extract(fmt, r"^[^:]*:(.*)$", 1)).otherwise(fmt), F.lit("-"), F.lit(""))

    def digits(x: Column) -> Column:
        comma, dot = F.translate(x["clean"], ",. ", "."), F.translate(x["clean"], ", ", "")
        plain = F.when(x["local"].isin(*ZERO_FORMATS), F.lit("0")).when(x["local"].isin(*COMMA_FORMATS), comma).otherwise(dot)
        known = x["local"].isNull() | x["local"].isin(*DOT_FORMATS, *COMMA_FORMATS, *ZERO_FORMATS)
        part = lambda i: F.regexp_extract(plain, r"^([+-]?(?:\d+\.?\d*|\.\d+))(?:[eE]([+-]?\d+))?$", i)
        return let(F.struct(part(1).alias("mantissa"), part(2).alias("exponent"), known.alias("known"), (x["clean"] == "").alias("empty")), number)

    def number(x: Column) -> Column:
        # Moving the point is a change of the exponent, so that no power of ten is ever rounded.
        exponent = F.coalesce(x["exponent"].try_cast("int"), F.lit(0)) + F.coalesce(scale.cast("int"), F.lit(0))
        value = F.concat(x["mantissa"], F.lit("E"), exponent.cast("string")).try_cast(NUMERIC)
        signed = F.when(sign == "-", -value).otherwise(value)
        bad = ~x["known"] | (~x["empty"] & (x["mantissa"] == ""))
        return F.struct(F.when(x["known"] & ~x["empty"], signed).alias("value"), F.when(bad, F.lit("UnsupportedFormat")).alias("error"))

    return let(F.struct(clean.alias("clean"), local.alias("local")), digits)


_PLAIN = re.compile(r"[0-9]{1,15}(?:\.[0-9]{0,4})?", re.ASCII)


def plain_number(text: str, fmt: str | None, scale: str | None, sign: str | None) -> Decimal | None:
    """What transform_numeric gives, for code that has a text in hand: of digits, commas and a point (or the other way round) in a
    known format with a scale of one digit; null for all else, which is left to it."""
    local = None if fmt is None else fmt.partition(":")[2] if ":" in fmt else fmt
    if local is None or local in DOT_FORMATS:
        digits = text.replace(",", "")
    elif local in COMMA_FORMATS:
        digits = text.replace(".", "").replace(",", ".")
    else:
        return None
    if not _PLAIN.fullmatch(digits) or not (scale is None or (len(scale) == 1 and scale in "0123456789")):
        return None
    value = Decimal(digits).scaleb(int(scale or 0))
    return -value if sign == "-" else value


#: White space as text tools strip it, and what may follow a number's sign.
_BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_AMOUNT = rf"[£$€]?{_BLANK}?(?:[0-9]+|[0-9]{{1,3}}(?:(?:,|{_BLANK})[0-9]{{3}})+)(?:\.[0-9]+)?"
_WRITTEN = rf"^{_BLANK}*(?:\({_BLANK}*{_AMOUNT}{_BLANK}*\)|-?{_BLANK}*{_AMOUNT}){_BLANK}*$"


def normalise_number(raw: Column) -> Column:
    """struct(value, error): a number as a model wrote it, as plain digits with an optional minus.

    Brackets or one dash mean negative, never both; thousands groups have exactly three digits; all else is an error.
    """
    minus = F.when(F.regexp_replace(raw, r"[^-(]", "") != "", F.lit("-")).otherwise(F.lit(""))
    value = F.when(raw.rlike(_WRITTEN), F.concat(minus, F.regexp_replace(raw, r"[^0-9.]", "")))
    return F.struct(value.alias("value"), F.when(raw.isNotNull() & ~raw.rlike(_WRITTEN), F.lit("not a number")).alias("error"))


def written_number(raw: str) -> str | None:
    """The same of one text, for code that has the text in hand; null if it is no number."""
    if re.fullmatch(_WRITTEN[1:-1], raw) is None:
        return None
    return ("-" if "-" in raw or "(" in raw else "") + re.sub("[^0-9.]", "", raw)


def label_value(c: Column) -> Column:
    """A text as a label: lower case, everything but a-z, 0-9, _ and - as -, at most 63 characters."""
    return F.left(F.regexp_replace(F.lower(c), "[^a-z0-9_-]", "-"), F.lit(63))


def base_model(c: Column) -> Column:
    return F.substring_index(c, "@", 1)


def price(model: Column, which: int) -> Column:
    """Price of a million tokens in (0) or out (1); null for a model without a price."""
    pairs = [x for name, p in PRICES.items() for x in (F.lit(name), F.lit(p[which]))]
    return F.try_element_at(F.create_map(*pairs), base_model(model))


def cost_usd(model: Column, tokens_in: Column, tokens_out: Column, thinking: Column) -> Column:
    return (tokens_in * price(model, 0) + (tokens_out + thinking) * price(model, 1)) / F.lit(1_000_000)


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, where a lambda would work it out for each element."""
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a further column that is worked out once a row, however often it is read: a generator of one row, which the
    optimizer doesn't merge with what stands above it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def fake_embedding(text: Column, dims: int = EMBEDDING_DIMS) -> Column:
    """A deterministic embedding: words counted in buckets by their hash, scaled to length 1 (dims: a power of two)."""
    words = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")
    bucket = F.transform(words, lambda w: F.pmod(F.conv(F.substring(F.sha2(w.cast("binary"), 256), 57, 8), 16, 10).cast("long"), F.lit(dims)))
    every = F.sequence(F.lit(0), F.lit(dims - 1))
    counts = let(bucket, lambda own: F.transform(every, lambda b: F.size(F.filter(own, lambda x: x == b)).cast("double")))

    def scaled(c: Column) -> Column:
        norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
        return let(F.when(norm == 0, F.lit(1.0)).otherwise(norm), lambda n: F.transform(c, lambda x: x / n))

    return let(counts, scaled)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; a vector of length zero counts as length one."""
    length = lambda v: F.when(dot(v, v) == 0, F.lit(1.0)).otherwise(F.sqrt(dot(v, v)))
    return 1.0 - dot(a, b) / (length(a) * length(b))
