"""The event contract as column expressions.

``validate`` works in two tiers:

* Messages in the publisher's own spelling are recognised by one regular expression, which settles field
  names, token types and value patterns at once; one ``from_json`` then gives typed values. This tier only
  ever *accepts*.
* Everything else (other spellings, and every invalid message) is parsed once into a VARIANT, and each rule
  is checked on its own so that a rejected message gets its reason and its list of locations.

Both tiers stay inside the JVM; no Python runs per row.
"""

from __future__ import annotations

from functools import cache, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import content_hash, key_bytes, stable_event_id
from tidemark.schemas import DETAILS, ENVELOPE, ENVELOPE_FIELDS, MONEY, PAYLOAD_FIELDS

# --- Fixed values of the contract -------------------------------------------------------------------
EVENT_TYPES = ("insert", "update")
ORDER_STATUSES = ("O", "F", "P")
SCHEMA_VERSION = 1
MAX_NAME = 200
MAX_SOURCE = 200
EVENT_ID_PATTERN = r"^[0-9a-f]{64}\z"
ENTITY_KEY_PATTERN = r"^order:[1-9][0-9]*\z"
SOURCE_PATTERN = r"(?U)^\S+\z"

UNSUPPORTED_TOMBSTONE = "unsupported_tombstone"
INVALID_JSON = "invalid_json"
BUSINESS_QUALITY_VIOLATION = "business_quality_violation"
INVALID_ENVELOPE = "invalid_envelope"
PARTITION_KEY_MISMATCH = "partition_key_mismatch"
SOURCE_VERSION_CONFLICT = "source_version_conflict"
# -----------------------------------------------------------------------------------------------------

# Accepted spellings outside the canonical tier. Stricter than a lenient parser: no numeric timestamps in
# strings, no week dates, and so on.
_TIME_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}[Tt _]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([Zz]|[+-]\d{2}:?\d{2})\z"
_NAIVE_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}[Tt _]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?\z"
_UUID_PATTERN = r"(?i)^(urn:uuid:)?[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z|^[0-9a-f]{32}\z"
_DATE_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}\z"
_DECIMAL_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*\z"

# --- Tier one: canonical messages ----------------------------------------------------------------------

_INT = r"[1-9][0-9]{0,18}"
_TIME = r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}Z"
_UUID = r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"

_CANONICAL = (
    r'^\{"event_id":"[0-9a-f]{64}","event_type":"(?:insert|update)","source":"[!#-\[\]-~]{1,200}",'
    r'"entity_key":"order:[1-9][0-9]*","payload":\{'
    rf'"order_key":{_INT},"customer_key":{_INT},'
    r'"customer_name":"[^"\\\x00-\x1f�]{1,200}","order_status":"[OFP]",'
    r'"total_price":"[0-9]{1,16}\.[0-9]{2}","order_date":"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"\},'
    rf'"occurred_at":"{_TIME}","captured_at":"{_TIME}","schema_version":1,"source_version":{_INT},'
    rf'"source_updated_at":"{_TIME}","batch_id":"{_UUID}","sync_run_id":"{_UUID}",'
    rf'"batch_sequence":{_INT}\}}\z'
)

# Times, dates and money arrive as strings; they are cast explicitly.
_CANONICAL_SCHEMA = (
    "event_id string, event_type string, source string, entity_key string, "
    "payload struct<order_key: bigint, customer_key: bigint, customer_name: string, order_status: string, "
    "total_price: string, order_date: string>, occurred_at string, captured_at string, "
    "schema_version int, source_version bigint, source_updated_at string, "
    "batch_id string, sync_run_id string, batch_sequence bigint"
)


def _envelope(value: dict[str, Column], payload: dict[str, Column]) -> Column:
    fields = {
        **value,
        "payload": F.struct(*[payload[name].alias(name) for name in PAYLOAD_FIELDS]),
    }
    return F.struct(*[fields[name].alias(name) for name in ENVELOPE_FIELDS]).cast(ENVELOPE)


def _canonical_envelope(parsed: Column) -> Column:
    payload = parsed["payload"]
    value = {name: parsed[name] for name in ENVELOPE_FIELDS if name != "payload"}
    for name in ("occurred_at", "captured_at", "source_updated_at"):
        value[name] = parsed[name].try_cast("timestamp")
    inner = {name: payload[name] for name in PAYLOAD_FIELDS}
    inner["total_price"] = payload["total_price"].try_cast(MONEY)
    inner["order_date"] = payload["order_date"].try_cast("date")
    return _envelope(value, inner)


def _canonical_ok(parsed: Column, envelope: Column) -> Column:
    """What the pattern cannot settle: calendar, integer range, and the rules across fields."""
    payload = envelope["payload"]
    return (
        payload["order_key"].isNotNull()
        & payload["customer_key"].isNotNull()
        & payload["total_price"].isNotNull()
        & payload["order_date"].isNotNull()
        & envelope["source_version"].isNotNull()
        & envelope["batch_sequence"].isNotNull()
        & envelope["captured_at"].isNotNull()
        & envelope["occurred_at"].isNotNull()
        & (parsed["occurred_at"] == parsed["source_updated_at"])
        & (envelope["entity_key"] == F.concat(F.lit("order:"), payload["order_key"].cast("string")))
        & (
            envelope["event_id"]
            == stable_event_id(envelope["source"], envelope["entity_key"], envelope["source_version"])
        )
    )


# --- Tier two: rule by rule ------------------------------------------------------------------------------

_TOP = tuple(name for name in ENVELOPE_FIELDS if name != "payload")


def _path(name: str, inner: bool) -> str:
    return f"$[0].payload.{name}" if inner else f"$[0].{name}"


def _tokens(document: str) -> Column:
    """Per field: the JSON token type (NULL when absent) and the scalar as text."""
    fields = []
    for name in (*_TOP, "payload"):
        token = F.schema_of_variant(F.try_variant_get(F.col(document), _path(name, False), "variant"))
        fields.append(token.alias(f"{name}_token"))
        if name != "payload":
            fields.append(F.try_variant_get(F.col(document), _path(name, False), "string").alias(name))
    for name in PAYLOAD_FIELDS:
        token = F.schema_of_variant(F.try_variant_get(F.col(document), _path(name, True), "variant"))
        fields.append(token.alias(f"payload_{name}_token"))
        fields.append(F.try_variant_get(F.col(document), _path(name, True), "string").alias(f"payload_{name}"))
    fields.append(F.schema_of_variant(F.try_variant_get(F.col(document), "$[0]", "variant")).alias("root_token"))
    keys = "map<string,variant>"
    fields.append(F.map_keys(F.try_variant_get(F.col(document), "$[0]", keys)).alias("names"))
    fields.append(F.map_keys(F.try_variant_get(F.col(document), "$[0].payload", keys)).alias("payload_names"))
    return F.struct(*fields)


def _error(loc: tuple[str, ...], kind: str | Column) -> Column:
    where = F.array(*[F.lit(part) for part in loc]) if loc else F.array().cast("array<string>")
    return F.struct(where.alias("loc"), (F.lit(kind) if isinstance(kind, str) else kind).alias("type"))


def _timestamp(text: Column) -> Column:
    plain = F.regexp_replace(F.upper(text), "[ _]", "T")
    return F.when(text.rlike(_TIME_PATTERN), plain.try_cast("timestamp"))


def _uuid(text: Column) -> Column:
    digits = F.regexp_replace(F.regexp_replace(F.lower(text), "^urn:uuid:", ""), "-", "")
    return F.when(
        text.rlike(_UUID_PATTERN),
        F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
    )


def _problem_int(token: Column, text: Column) -> Column:
    number = text.try_cast("bigint")
    return (
        F.when(token.isNull(), "missing")
        .when(token.startswith("DECIMAL") & text.rlike(r"^[0-9]+\z"), "less_than_equal")
        .when(token != "BIGINT", "int_type")
        .when(number <= 0, "greater_than")
    )


def _problem_literal(token: Column, text: Column, allowed: tuple[str, ...]) -> Column:
    return F.when(token.isNull(), "missing").when((token != "STRING") | ~text.isin(*allowed), "literal_error")


def _problem_text(token: Column, text: Column, maximum: int | None, pattern: str | None) -> Column:
    problem = F.when(token.isNull(), "missing").when(token != "STRING", "string_type")
    if maximum is not None:
        problem = problem.when(F.char_length(text) < 1, "string_too_short").when(
            F.char_length(text) > maximum, "string_too_long"
        )
    if pattern is not None:
        problem = problem.when(~text.rlike(pattern), "string_pattern_mismatch")
    return problem


def _problem_money(token: Column, text: Column) -> Column:
    digits = F.regexp_replace(F.regexp_replace(F.trim(text), "^[+-]", ""), "^0+", "")
    whole = F.char_length(F.regexp_extract(digits, r"^(\d*)", 1))
    scale = F.char_length(F.regexp_replace(F.regexp_extract(digits, r"\.(\d*)\z", 1), "0+$", ""))
    negative = F.trim(text).startswith("-") & digits.rlike("[1-9]")
    return (
        F.when(token.isNull(), "missing")
        .when((token == "DOUBLE") | (token == "BOOLEAN"), "value_error")
        .when(token.startswith("DECIMAL") & ~text.rlike(r"^-?[0-9]+\z"), "value_error")
        .when(token.startswith("DECIMAL"), "decimal_max_digits")
        .when(~token.isin("STRING", "BIGINT"), "decimal_type")
        .when(text.rlike(r"(?i)^\s*[+-]?(nan|inf|infinity)\s*\z"), "finite_number")
        .when(~text.rlike(_DECIMAL_PATTERN), "decimal_parsing")
        .when(negative, "greater_than_equal")
        .when(scale > 2, "decimal_max_places")
        .when(whole > 16, "decimal_whole_digits")
    )


def _problem_date(token: Column, text: Column) -> Column:
    return (
        F.when(token.isNull(), "missing")
        .when(token != "STRING", "date_type")
        .when(~text.rlike(_DATE_PATTERN) | text.try_cast("date").isNull(), "date_from_datetime_parsing")
    )


def _problem_time(token: Column, text: Column) -> Column:
    return (
        F.when(token.isNull(), "missing")
        .when(token != "STRING", "value_error")
        .when(text.rlike(_NAIVE_PATTERN), "timezone_aware")
        .when(_timestamp(text).isNull(), "datetime_from_date_parsing")
    )


def _problem_uuid(token: Column, text: Column) -> Column:
    return (
        F.when(token.isNull(), "missing")
        .when(token != "STRING", "uuid_type")
        .when(~text.rlike(_UUID_PATTERN), "uuid_parsing")
    )


def _problem_schema_version(token: Column, text: Column) -> Column:
    return F.when(token.isNull(), F.lit(None).cast("string")).when(token != "BIGINT", "value_error").when(
        text != str(SCHEMA_VERSION), "literal_error"
    )


def _field_errors(t: Column) -> Column:
    """All violations of single fields, as ``array<struct<loc, type>>``."""

    def top(name: str) -> tuple[Column, Column]:
        return t[f"{name}_token"], t[name]

    def inner(name: str) -> tuple[Column, Column]:
        return t[f"payload_{name}_token"], t[f"payload_{name}"]

    problems: dict[tuple[str, ...], Column] = {
        ("event_id",): _problem_text(*top("event_id"), None, EVENT_ID_PATTERN),
        ("event_type",): _problem_literal(*top("event_type"), EVENT_TYPES),
        ("source",): _problem_text(*top("source"), MAX_SOURCE, SOURCE_PATTERN),
        ("entity_key",): _problem_text(*top("entity_key"), None, ENTITY_KEY_PATTERN),
    }
    in_payload = {
        ("payload", "order_key"): _problem_int(*inner("order_key")),
        ("payload", "customer_key"): _problem_int(*inner("customer_key")),
        ("payload", "customer_name"): _problem_text(*inner("customer_name"), MAX_NAME, None),
        ("payload", "order_status"): _problem_literal(*inner("order_status"), ORDER_STATUSES),
        ("payload", "total_price"): _problem_money(*inner("total_price")),
        ("payload", "order_date"): _problem_date(*inner("order_date")),
    }
    is_object = t["payload_token"].startswith("OBJECT")
    for loc, problem in in_payload.items():
        problems[loc] = F.when(is_object, problem)
    problems[("payload",)] = F.when(t["payload_token"].isNull(), "missing").when(~is_object, "model_type")
    for name in ("occurred_at", "captured_at", "source_updated_at"):
        problems[(name,)] = _problem_time(*top(name))
    problems[("schema_version",)] = _problem_schema_version(*top("schema_version"))
    problems[("source_version",)] = _problem_int(*top("source_version"))
    problems[("batch_id",)] = _problem_uuid(*top("batch_id"))
    problems[("sync_run_id",)] = _problem_uuid(*top("sync_run_id"))
    problems[("batch_sequence",)] = _problem_int(*top("batch_sequence"))

    single = F.array_compact(
        F.array(*[F.when(problem.isNotNull(), _error(loc, problem)) for loc, problem in problems.items()])
    )
    none = F.array().cast("array<string>")
    extra = F.transform(
        F.array_except(F.coalesce(t["names"], none), F.array(*[F.lit(n) for n in ENVELOPE_FIELDS])),
        lambda name: F.struct(F.array(name).alias("loc"), F.lit("extra_forbidden").alias("type")),
    )
    extra_inner = F.transform(
        F.array_except(F.coalesce(t["payload_names"], none), F.array(*[F.lit(n) for n in PAYLOAD_FIELDS])),
        lambda name: F.struct(F.array(F.lit("payload"), name).alias("loc"), F.lit("extra_forbidden").alias("type")),
    )
    root = F.array(_error((), "model_type"))
    return F.when(t["root_token"].startswith("OBJECT"), F.concat(single, extra, extra_inner)).otherwise(root).cast(DETAILS)


def _spelled_envelope(t: Column) -> Column:
    """Typed envelope of a message whose single fields are all valid."""
    value = {
        "event_id": t["event_id"],
        "event_type": t["event_type"],
        "source": t["source"],
        "entity_key": t["entity_key"],
        "occurred_at": _timestamp(t["occurred_at"]),
        "captured_at": _timestamp(t["captured_at"]),
        "schema_version": F.lit(SCHEMA_VERSION),
        "source_version": t["source_version"].try_cast("bigint"),
        "source_updated_at": _timestamp(t["source_updated_at"]),
        "batch_id": _uuid(t["batch_id"]),
        "sync_run_id": _uuid(t["sync_run_id"]),
        "batch_sequence": t["batch_sequence"].try_cast("bigint"),
    }
    payload = {name: t[f"payload_{name}"] for name in PAYLOAD_FIELDS}
    for name in ("order_key", "customer_key"):
        payload[name] = payload[name].try_cast("bigint")
    payload["total_price"] = F.trim(payload["total_price"]).try_cast(MONEY)
    payload["order_date"] = payload["order_date"].try_cast("date")
    return _envelope(value, payload)


def _identity_ok(envelope: Column) -> Column:
    return (
        (envelope["entity_key"] == F.concat(F.lit("order:"), envelope["payload"]["order_key"].cast("string")))
        & (envelope["occurred_at"] == envelope["source_updated_at"])
        & (
            envelope["event_id"]
            == stable_event_id(envelope["source"], envelope["entity_key"], envelope["source_version"])
        )
    )


# --- Public operators --------------------------------------------------------------------------------------


class _Rules(NamedTuple):
    """The contract as columns over the steps of ``validate``, in the order of the steps."""

    steps: tuple[tuple[str, Column], ...]
    result: Column
    content_hash: Column


@cache
def _rules(application_id: str) -> _Rules:
    """Built once per application: the rules do not depend on the data they are applied to."""
    body = F.col("value").cast("string")
    nothing = F.array().cast(DETAILS)
    # The document is wrapped together with its own digest: text after the end of the document, a second
    # document or an early bracket all change what stands in second place.
    text = F.try_validate_utf8(F.col("value").cast("string"))
    seal = F.sha2(F.col("value"), 256)
    wrapped = F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]'))
    sealed = (F.size(F.try_variant_get("_wrapped", "$", "array<variant>")) == 2) & (
        F.try_variant_get("_wrapped", "$[1]", "string") == seal
    )
    steps = (
        ("_fast", F.when(body.rlike(_CANONICAL), F.from_json(body, _CANONICAL_SCHEMA))),
        ("_canonical", _canonical_envelope(F.col("_fast"))),
        ("_ok", F.coalesce(_canonical_ok(F.col("_fast"), F.col("_canonical")), F.lit(False))),
        ("_wrapped", F.when(~F.col("_ok"), F.try_parse_json(wrapped))),
        ("_document", F.when(sealed, F.col("_wrapped"))),
        ("_tokens", F.when(F.col("_document").isNotNull(), _tokens("_document"))),
        ("_errors", F.when(F.col("_tokens").isNotNull(), _field_errors(F.col("_tokens")))),
        ("_spelled", F.when(F.size("_errors") == 0, _spelled_envelope(F.col("_tokens")))),
        ("_related", F.coalesce(_identity_ok(F.col("_spelled")), F.lit(False))),
        ("envelope", F.when(F.col("_ok"), F.col("_canonical")).when(F.col("_related"), F.col("_spelled"))),
    )
    valid = F.col("envelope").isNotNull()
    in_payload = F.exists("_errors", lambda error: F.get(error["loc"], 0).eqNullSafe(F.lit("payload")))
    right_key = F.col("key").eqNullSafe(key_bytes(F.col("envelope.entity_key")))
    reason = (
        F.when(F.col("value").isNull(), UNSUPPORTED_TOMBSTONE)
        .when(valid, F.when(~right_key, PARTITION_KEY_MISMATCH))
        .when(F.col("_document").isNull(), INVALID_JSON)
        .when(in_payload, BUSINESS_QUALITY_VIOLATION)
        .otherwise(INVALID_ENVELOPE)
    )
    details = (
        F.when(F.col("value").isNull() | valid, nothing)
        .when(F.col("_document").isNull(), F.array(_error((), "json_invalid")).cast(DETAILS))
        .when(F.size("_errors") > 0, F.col("_errors"))
        .otherwise(F.array(_error((), "value_error")).cast(DETAILS))
    )
    results = {
        "envelope": F.col("envelope"),
        "reason_code": reason,
        "details": details,
    }
    # Unpacked from a one-element array: a generator is where Catalyst stops moving filters and field accesses
    # down. Below it, they would be rewritten into copies of the whole rule set.
    row = F.struct(*[column.alias(name) for name, column in results.items()])
    return _Rules(steps, F.inline(F.array(row)), F.when(valid, content_hash(F.col("envelope"))))


def validate(wire: DataFrame) -> DataFrame:
    """Add ``envelope``, ``content_hash``, ``reason_code`` and ``details`` to delivered messages.

    ``envelope`` is NULL unless the message met the whole contract; ``reason_code`` is NULL for a valid
    message whose key equals its entity key. ``details`` names locations and rule types, never input values.
    """
    rules = _rules(wire.sparkSession.sparkContext.applicationId)
    rows = wire
    for name, column in rules.steps:
        rows = rows.withColumn(name, column)
    return rows.select(*wire.columns, rules.result).withColumn("content_hash", rules.content_hash)


def _journal_problems() -> dict[tuple[str, ...], Column]:
    def positive(name: str) -> Column:
        return F.when(F.col(name).isNull(), "int_type").when(F.col(name) <= 0, "greater_than")

    name = F.col("customer_name")
    return {
        ("event_type",): F.when(~F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False)), "literal_error"),
        ("payload", "order_key"): positive("order_key"),
        ("payload", "customer_key"): positive("customer_key"),
        ("payload", "customer_name"): F.when(name.isNull(), "string_type")
        .when(F.char_length(name) < 1, "string_too_short")
        .when(F.char_length(name) > MAX_NAME, "string_too_long"),
        ("payload", "order_status"): F.when(
            ~F.coalesce(F.col("order_status").isin(*ORDER_STATUSES), F.lit(False)), "literal_error"
        ),
        ("payload", "total_price"): F.when(F.col("total_price").isNull(), "decimal_type").when(
            F.col("total_price") < 0, "greater_than_equal"
        ),
        ("payload", "order_date"): F.when(F.col("order_date").isNull(), "date_type"),
        ("source_version",): positive("source_version"),
    }


def journal_errors() -> Column:
    """Violations of a typed journal row, as ``array<struct<loc, type>>`` (empty for a valid row)."""
    return F.array_compact(
        F.array(*[F.when(problem.isNotNull(), _error(loc, problem)) for loc, problem in _journal_problems().items()])
    ).cast(DETAILS)


def journal_ok() -> Column:
    """Whether ``journal_errors`` is empty, without building the list."""
    return reduce(lambda a, b: a & b, [problem.isNull() for problem in _journal_problems().values()])


def errors_text(errors: Column) -> Column:
    """``loc.loc: type; ...`` for the quarantine reason."""
    return F.array_join(
        F.transform(errors, lambda e: F.concat(F.array_join(e["loc"], "."), F.lit(": "), e["type"])), "; "
    )
