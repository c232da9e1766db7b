"""Explicit schemas as DDL text. Nothing in this package infers a schema."""

from __future__ import annotations

MONEY = "decimal(18,2)"


JOURNAL = (
    "order_key bigint, customer_key bigint, customer_name string, order_status string, "
    "total_price decimal(18,2), order_date date, source_version bigint, "
    "source_updated_at timestamp, event_type string"
)

PAYLOAD_FIELDS = ("order_key", "customer_key", "customer_name", "order_status", "total_price", "order_date")

PAYLOAD = (
    "struct<order_key: bigint, customer_key: bigint, customer_name: string, order_status: string, "
    "total_price: decimal(18,2), order_date: date>"
)

ENVELOPE_FIELDS = (
    "event_id", "event_type", "source", "entity_key", "payload", "occurred_at", "captured_at",
    "schema_version", "source_version", "source_updated_at", "batch_id", "sync_run_id", "batch_sequence",
)

ENVELOPE = (
    "struct<event_id: string, event_type: string, source: string, entity_key: string, "
    f"payload: {PAYLOAD}, occurred_at: timestamp, captured_at: timestamp, "
    "schema_version: int, source_version: bigint, source_updated_at: timestamp, "
    "batch_id: string, sync_run_id: string, batch_sequence: bigint>"
)

# The column names and types of Spark's Kafka source, so the connector can be swapped in.
WIRE = (
    "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp"
)

DETAILS = "array<struct<loc: array<string>, type: string>>"

LEDGER = (
    "delivery_id bigint, topic string, partition_id int, broker_offset bigint, "
    "message_key binary, raw_message binary, event_id string, source string, entity_key string, "
    "event_type string, occurred_at timestamp, captured_at timestamp, batch_id string, "
    "disposition string, processed_at timestamp, source_version bigint, content_hash string, "
    f"envelope {ENVELOPE}, reason_code string, details {DETAILS}"
)

# The ledger as it is stored (``operators/slim.py``).
DELIVERIES = (
    "delivery_id bigint, topic string, partition_id int, broker_offset bigint, message_key binary, raw_message binary, "
    "source string, entity_key string, event_type string, occurred_at timestamp, captured_at timestamp, "
    f"source_version bigint, payload {PAYLOAD}, batch_sequence bigint, batch_code binary, run_code binary, "
    f"content_hash binary, reason_code string, details {DETAILS}, processed_at timestamp"
)

RUN_EVENTS = (
    "run_id string, source string, mode string, event string, high_watermark_at timestamp, "
    "high_watermark_order_key bigint, at timestamp"
)

SYNC_BATCHES = (
    "batch_id string, run_id string, source string, batch_sequence bigint, status string, "
    "from_updated_at timestamp, from_order_key bigint, to_updated_at timestamp, to_order_key bigint, "
    "records_seen bigint, records_published bigint, error_code string, "
    "started_at timestamp, finished_at timestamp"
)

ENTITY_VERSIONS = (
    "source string, entity_key string, source_version bigint, source_updated_at timestamp, "
    "last_event_id string"
)

QUARANTINE = (
    "batch_id string, source string, source_updated_at timestamp, order_key bigint, "
    "raw_record string, reason string, created_at timestamp"
)


def columns(ddl: str) -> list[str]:
    """The columns of a schema, one DDL text each: cut at the commas outside of brackets."""
    found, depth = [""], 0
    for letter in ddl:
        depth += {"<": 1, "(": 1, ">": -1, ")": -1}.get(letter, 0)
        if letter == "," and depth == 0:
            found.append("")
        else:
            found[-1] += letter
    return [part.strip() for part in found]


def names(ddl: str) -> list[str]:
    return [column.split()[0] for column in columns(ddl)]
