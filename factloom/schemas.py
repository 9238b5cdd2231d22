"""Declared schemas and the constants that several operators share."""

from __future__ import annotations

from pyspark.sql import types as T

#: Answer field -> concept name.
CONCEPTS = {
    "equity": "Equity",
    "net_assets": "NetAssetsLiabilities",
    "net_current_assets": "NetCurrentAssetsLiabilities",
    "total_assets_less_current_liabilities": "TotalAssetsLessCurrentLiabilities",
    "current_assets": "CurrentAssets",
    "fixed_assets": "FixedAssets",
    "creditors": "Creditors",
    "cash": "CashBankOnHand",
    "average_employees": "AverageNumberEmployeesDuringPeriod",
}
PERIODS = ("current", "prior")
HEADERS = ("company_name", "company_number", "period_end", "period_start")

#: US dollars for a million tokens in and out; thinking tokens cost as output.
PRICES = {
    "gemini-3.1-flash-lite": (0.25, 1.50),
    "gemini-3.8-flash": (0.75, 3.75),
    "gemini-2.5-flash-lite": (0.10, 0.40),
    "gemini-embedding-2": (0.20, 0.0),
}

#: Defaults that are part of the semantics.
MAX_BYTES = 750_000_000
PARSE_CAP = 500
EXTRACT_CAP = 300
MIN_CONFIDENCE = 0.5
CHUNK_CHARS = 1500
CHUNK_OVERLAP = 3
EMBEDDING_DIMS = 256
PARSER_VERSION = 2
CREDITORS_WITHIN_ONE_YEAR = "MaturitiesOrExpirationPeriodsDimension=WithinOneYear"

NUMERIC = "decimal(38,9)"


_TYPES = {
    "string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "decimal(38,9)": T.DecimalType(38, 9), "array<string>": T.ArrayType(T.StringType()), "array<double>": T.ArrayType(T.DoubleType()),
}


def _struct(ddl: str) -> T.StructType:
    """The columns of a DDL text; StructType.fromDDL needs a session, which workers that import this don't have."""
    out = T.StructType()
    for column in ddl.split(", "):
        name, kind = column.removesuffix(" NOT NULL").split(" ")
        out.add(name, _TYPES[kind], nullable=not column.endswith(" NOT NULL"))
    return out


#: Fixed values from here on: the columns of the tables.
DOCUMENTS = _struct(
    "document_id string NOT NULL, source_key string NOT NULL, member_name string NOT NULL, company_number string NOT NULL, period_end date NOT NULL, byte_count long NOT NULL, sha256 string NOT NULL, "
    "ix_namespace string NOT NULL, entity_identifier string, fact_count long NOT NULL, text string NOT NULL, batch_id string NOT NULL, parsed_at timestamp NOT NULL, parser_version long"
)
FACTS = _struct(
    "document_id string NOT NULL, concept string NOT NULL, namespace string NOT NULL, context_id string NOT NULL, is_numeric boolean NOT NULL, value decimal(38,9), text string NOT NULL, unit string, "
    "decimals string, format string, scale long, sign string, in_hidden boolean NOT NULL, period_start date, period_end date, instant date, "
    "dimensional boolean NOT NULL, batch_id string NOT NULL, dimensions string"
)
QUARANTINE = _struct(
    "document_id string, source_key string NOT NULL, member_name string NOT NULL, stage string NOT NULL, reason string NOT NULL, error string NOT NULL, batch_id string NOT NULL, "
    "quarantined_at timestamp NOT NULL, model string, prompt_id string, released_at timestamp"
)
RELEASES = _struct(
    "stage string NOT NULL, source_key string NOT NULL, member_name string NOT NULL, batch_id string NOT NULL, quarantined_at timestamp NOT NULL, model string, prompt_id string, released_at timestamp NOT NULL"
)
PARSE_RUNS = _struct(
    "run_id string NOT NULL, source_key string NOT NULL, batch_id string, status string NOT NULL, cap long NOT NULL, selected long NOT NULL, parsed long NOT NULL, quarantined long NOT NULL, facts long NOT NULL, "
    "started_at timestamp NOT NULL, finished_at timestamp NOT NULL, error string, members array<string>, parser_version long, reparse boolean"
)
INGEST_RUNS = _struct(
    "run_id string NOT NULL, source_key string NOT NULL, source_url string NOT NULL, status string NOT NULL, raw_uri string, sha256 string, byte_count long, error string, "
    "started_at timestamp NOT NULL, finished_at timestamp NOT NULL"
)
EXTRACTIONS = _struct(
    "document_id string NOT NULL, source_key string NOT NULL, model string NOT NULL, prompt_id string NOT NULL, prompt_version string NOT NULL, status string NOT NULL, overall_confidence double NOT NULL, "
    "extraction_json string NOT NULL, input_tokens long NOT NULL, output_tokens long NOT NULL, thinking_tokens long NOT NULL, cost_usd double NOT NULL, latency_ms long NOT NULL, "
    "finish_reason string, batch_id string NOT NULL, extracted_at timestamp NOT NULL"
)
EXTRACT_RUNS = _struct(
    "run_id string NOT NULL, model string NOT NULL, prompt_id string NOT NULL, batch_id string, status string NOT NULL, cap long NOT NULL, selected long NOT NULL, extracted long NOT NULL, quarantined long NOT NULL, "
    "input_tokens long NOT NULL, output_tokens long NOT NULL, cost_usd double NOT NULL, started_at timestamp NOT NULL, finished_at timestamp NOT NULL, error string, document_ids array<string>"
)
CHUNKS = _struct(
    "document_id string NOT NULL, chunk_index long NOT NULL, embedding_model string NOT NULL, text string NOT NULL, chars long NOT NULL, tokens long NOT NULL, embedding array<double>, batch_id string NOT NULL, "
    "indexed_at timestamp NOT NULL"
)
INDEX_RUNS = _struct(
    "run_id string NOT NULL, embedding_model string NOT NULL, batch_id string, status string NOT NULL, cap long NOT NULL, selected long NOT NULL, indexed long NOT NULL, chunks long NOT NULL, tokens long NOT NULL, "
    "cost_usd double NOT NULL, started_at timestamp NOT NULL, finished_at timestamp NOT NULL, error string, document_ids array<string>"
)
ANSWERS = _struct(
    "document_id string NOT NULL, source_key string NOT NULL, answer string, input_tokens long, output_tokens long, thinking_tokens long, latency_ms long, "
    "finish_reason string, failure string, model string NOT NULL, prompt_id string NOT NULL, batch_id string NOT NULL"
)
PINS = _struct("batch_id string NOT NULL, item string NOT NULL")
DOCUMENT_EVENTS = _struct("subscription_name string, message_id string, publish_time timestamp, data string, attributes string")

TABLES = {
    "documents": DOCUMENTS, "facts": FACTS, "quarantine": QUARANTINE, "parse_runs": PARSE_RUNS, "ingest_runs": INGEST_RUNS,
    "extractions": EXTRACTIONS, "extract_runs": EXTRACT_RUNS, "releases": RELEASES, "chunks": CHUNKS, "index_runs": INDEX_RUNS, "document_events": DOCUMENT_EVENTS, "answers": ANSWERS,
    "pins": PINS,
}

_SAID = "struct<value:string,confidence:double,evidence:string>"
ANSWER = (
    "struct<" + ",".join(f"{h}:{_SAID}" for h in HEADERS)
    + "".join(f",{f}:struct<current:{_SAID},prior:{_SAID}>" for f in CONCEPTS)
    + ",overall_confidence:double>"
)
