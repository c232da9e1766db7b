"""Scalar building blocks: keys, identities, hashes, canonical text. Built-in functions only."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONEY


def entity_key(order_key: Column) -> Column:
    """``order:<order_key>``."""
    return F.concat(F.lit("order:"), order_key.cast("string"))


def key_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def utc_timestamp(at: Column) -> Column:
    """ISO-8601 text in UTC with six fractional digits and ``Z``."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def money(amount: Column) -> Column:
    """Two-decimal text."""
    return amount.cast(MONEY).cast("string")


def date_text(day: Column) -> Column:
    return day.cast("string")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


# Characters that JSON text holds unchanged when everything outside ASCII is escaped.
_PLAIN_JSON = r"^[\x20\x21\x23-\x5b\x5d-\x7e]*\z"


def _escape_unit(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)
    above = code - 0x10000
    return (
        F.when(char == '"', F.lit('\\"'))
        .when(char == "\\", F.lit("\\\\"))
        .when(char == "\n", F.lit("\\n"))
        .when(char == "\r", F.lit("\\r"))
        .when(char == "\t", F.lit("\\t"))
        .when(char == "\f", F.lit("\\f"))
        .when(char == "\b", F.lit("\\b"))
        .when((code >= 0x20) & (code < 0x7F), char)
        .when(code < 0x10000, _escape_unit(code))
        .otherwise(
            F.concat(
                _escape_unit(F.shiftright(above, 10) + 0xD800),
                _escape_unit(above.bitwiseAND(0x3FF) + 0xDC00),
            )
        )
    )


def json_string(text: Column) -> Column:
    """Quoted JSON string in pure ASCII with lower-case ``\\uXXXX`` escapes."""
    escaped = F.concat_ws("", F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), _escape_char))
    body = F.when(text.rlike(_PLAIN_JSON), text).otherwise(escaped)
    return F.concat(F.lit('"'), body, F.lit('"'))


def stable_event_id(source: Column | str, key: Column, version: Column) -> Column:
    """SHA-256 of the compact JSON array ``[source, entity_key, source_version]``.

    A valid entity key needs no escaping.
    """
    quoted = F.lit(json.dumps(source)) if isinstance(source, str) else json_string(source)
    identity = F.concat(F.lit("["), quoted, F.lit(',"'), key, F.lit('",'), version.cast("string"), F.lit("]"))
    return F.sha2(identity, 256)


def content_json(event: Column) -> Column:
    """Business content of an envelope as compact JSON with sorted keys.

    Capture time, batch id, run id and batch sequence are left out: they may change on recapture.
    """
    payload = event["payload"]
    return F.concat(
        F.lit('{"entity_key":"'), event["entity_key"],
        F.lit('","event_id":"'), event["event_id"],
        F.lit('","event_type":"'), event["event_type"],
        F.lit('","occurred_at":"'), utc_timestamp(event["occurred_at"]),
        F.lit('","payload":{"customer_key":'), payload["customer_key"].cast("string"),
        F.lit(',"customer_name":'), json_string(payload["customer_name"]),
        F.lit(',"order_date":"'), date_text(payload["order_date"]),
        F.lit('","order_key":'), payload["order_key"].cast("string"),
        F.lit(',"order_status":"'), payload["order_status"],
        F.lit('","total_price":"'), money(payload["total_price"]),
        F.lit('"},"schema_version":'), event["schema_version"].cast("string"),
        F.lit(',"source":'), json_string(event["source"]),
        F.lit(',"source_updated_at":"'), utc_timestamp(event["source_updated_at"]),
        F.lit('","source_version":'), event["source_version"].cast("string"),
        F.lit("}"),
    )


def content_hash(event: Column) -> Column:
    return F.sha2(content_json(event), 256)


def wire_json(event: Column) -> Column:
    """The envelope as it travels: money and times as text, fields in the order of the contract."""
    payload = event["payload"]
    return F.to_json(
        F.struct(
            event["event_id"].alias("event_id"),
            event["event_type"].alias("event_type"),
            event["source"].alias("source"),
            event["entity_key"].alias("entity_key"),
            F.struct(
                payload["order_key"].alias("order_key"),
                payload["customer_key"].alias("customer_key"),
                payload["customer_name"].alias("customer_name"),
                payload["order_status"].alias("order_status"),
                money(payload["total_price"]).alias("total_price"),
                date_text(payload["order_date"]).alias("order_date"),
            ).alias("payload"),
            utc_timestamp(event["occurred_at"]).alias("occurred_at"),
            utc_timestamp(event["captured_at"]).alias("captured_at"),
            event["schema_version"].alias("schema_version"),
            event["source_version"].alias("source_version"),
            utc_timestamp(event["source_updated_at"]).alias("source_updated_at"),
            event["batch_id"].alias("batch_id"),
            event["sync_run_id"].alias("sync_run_id"),
            event["batch_sequence"].alias("batch_sequence"),
        )
    )


def uuid_text(*parts: Column) -> Column:
    """A UUID that depends on its parts only, so a recomputed task gives the same id."""
    digest = F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 4),
        F.substring(digest, 17, 4), F.substring(digest, 21, 12),
    )


def _python_timestamp(at: Column) -> Column:
    whole = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(at, "SSSSSS")
    return F.concat(
        whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00")
    )


def raw_record(*columns: str) -> Column:
    """A journal row as JSON; values JSON does not know (money, dates, times) become text."""
    text = {"total_price": money, "order_date": date_text, "source_updated_at": _python_timestamp}
    fields = [text.get(name, lambda column: column)(F.col(name)).alias(name) for name in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
