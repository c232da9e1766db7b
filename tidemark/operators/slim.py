"""Validated deliveries without what follows from the rest, for shuffling and storing.

A message says most things twice: its ids and hashes are digests of its content, its key is its entity key, and the text of a
message in the publisher's own spelling is the envelope written out. ``slim`` leaves these out where writing them again gives
exactly what was there, which is compared row by row; any other text or key stays as it is. ``whole`` brings all of it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import key_bytes, stable_event_id, wire_json
from tidemark.functions.validation import PARTITION_KEY_MISMATCH, SCHEMA_VERSION
from tidemark.schemas import ENVELOPE, ENVELOPE_FIELDS, LEDGER, names

_KEPT = ("source", "entity_key", "event_type", "occurred_at", "captured_at", "source_version", "payload", "batch_sequence")


def _uuid_bytes(text: Column) -> Column:
    return F.unhex(F.translate(text, "-", ""))


def _uuid_text(code: Column) -> Column:
    digits = F.lower(F.hex(code))
    return F.concat_ws("-", *(F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def _own_key() -> Column:
    """Whether the message's key is its entity key, which validation has compared."""
    reason = F.col("reason_code")
    return F.col("payload").isNotNull() & (reason.isNull() | (reason != PARTITION_KEY_MISMATCH))


def slim(checked: DataFrame) -> DataFrame:
    """Result of ``validate`` with receipt ids, without what ``whole`` can bring back; hashes and UUIDs are bytes."""
    envelope, value = F.col("envelope"), F.col("value")
    rows = checked.select(
        "delivery_id",
        F.col("topic"),
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("broker_offset"),
        F.col("key").alias("message_key"),
        F.when(envelope.isNull() | ~value.eqNullSafe(key_bytes(wire_json(envelope))), value).alias("raw_message"),
        *(envelope[name].alias(name) for name in _KEPT),
        _uuid_bytes(envelope["batch_id"]).alias("batch_code"),
        _uuid_bytes(envelope["sync_run_id"]).alias("run_code"),
        F.unhex("content_hash").alias("content_hash"),
        "reason_code",
        "details",
    )
    return rows.withColumn("message_key", F.when(~_own_key(), F.col("message_key")))


def whole(rows: DataFrame) -> DataFrame:
    """Ledger rows from slim ones that were decided."""
    known = F.col("payload").isNotNull()
    fields = {
        "event_id": stable_event_id(F.col("source"), F.col("entity_key"), F.col("source_version")),
        "batch_id": _uuid_text(F.col("batch_code")),
        "sync_run_id": _uuid_text(F.col("run_code")),
        "schema_version": F.lit(SCHEMA_VERSION),
        # Validation has compared the two.
        "source_updated_at": F.col("occurred_at"),
    }
    envelope = F.when(known, F.struct(*(fields.get(name, F.col(name)).alias(name) for name in ENVELOPE_FIELDS)).cast(ENVELOPE))
    restored = {
        "message_key": F.when(_own_key(), key_bytes(F.col("entity_key"))).otherwise(F.col("message_key")),
        "raw_message": F.coalesce("raw_message", F.when(known, key_bytes(wire_json(envelope)))),
        "event_id": F.when(known, fields["event_id"]),
        "batch_id": F.when(known, fields["batch_id"]),
        "content_hash": F.lower(F.hex("content_hash")),
        "envelope": envelope,
    }
    return rows.select(*(restored.get(name, F.col(name)).alias(name) for name in names(LEDGER)))
