"""Independent models in plain Python, and builders for small inputs."""

import hashlib
import json
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

from tidemark import schemas

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
RUN = "00000000-0000-4000-8000-000000000001"
BATCH = "00000000-0000-4000-8000-000000000002"
SOURCE = "shop.orders"


def event_id(source, key, version):
    text = json.dumps([source, key, version], separators=(",", ":"), ensure_ascii=True)
    return hashlib.sha256(text.encode()).hexdigest()


def micros_text(at):
    return f"{at:%Y-%m-%dT%H:%M:%S}.{at.microsecond:06d}Z"


# What every sample event says unless a test says otherwise.
PERSON = {"customer_key": 88, "customer_name": "Ada Example"}
CAPTURE = {"captured_at": micros_text(T0 + timedelta(hours=6)), "batch_id": BATCH, "sync_run_id": RUN, "batch_sequence": 1}


def envelope(key=31, version=1, price="100.20", source=SOURCE, **changes):
    """An event as the publisher spells it: order ``key`` at ``version``, which happened ``version`` microseconds after T0."""
    entity, happened = f"order:{key}", micros_text(T0 + timedelta(microseconds=version))
    order = {"order_key": key, **PERSON, "order_status": "P", "total_price": price, "order_date": "2025-11-30"}
    identity = {"event_id": event_id(source, entity, version), "event_type": ("update", "insert")[version == 1], "source": source, "entity_key": entity}
    times = {"occurred_at": happened, "captured_at": CAPTURE["captured_at"]}
    versions = {"schema_version": 1, "source_version": version, "source_updated_at": happened}
    return {**identity, "payload": order, **times, **versions, **CAPTURE, **changes}


def content_hash(value):
    """Hash of the business content, from the contract: sorted compact JSON without capture metadata."""
    left_out = {"captured_at", "batch_id", "sync_run_id", "batch_sequence"}
    content = {k: v for k, v in value.items() if k not in left_out}
    return hashlib.sha256(json.dumps(content, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def compact(value):
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False).encode()


def wire_rows(messages, partition=0, topic="t", start=0):
    """Messages (key, value) as wire rows of one partition."""
    return [
        (topic, partition, start + i, bytearray(k) if k is not None else None,
         bytearray(v) if v is not None else None, T0)
        for i, (k, v) in enumerate(messages)
    ]


def wire(spark, messages, **kwargs):
    return spark.createDataFrame(wire_rows(messages, **kwargs), schemas.WIRE)


def deliver(value, key=None):
    return ((key or value["entity_key"]).encode(), compact(value))


class SequentialSink:
    """One delivery at a time, with dictionaries: the reference semantics of classification."""

    def __init__(self):
        self.hashes = {}
        self.current = {}

    def take(self, key, version, content):
        event = (key, version)
        if event in self.hashes:
            return "duplicate" if self.hashes[event] == content else "rejected"
        self.hashes[event] = content
        if key in self.current and version <= self.current[key]:
            return "stale"
        self.current[key] = version
        return "accepted"


def journal_row(key, at=T0, version=1, price="10.00", **changes):
    row = {
        "order_key": key,
        "customer_key": 1,
        "customer_name": "Sample",
        "order_status": "O",
        "total_price": Decimal(price),
        "order_date": date(2026, 1, 1),
        "source_version": version,
        "source_updated_at": at,
        "event_type": "insert" if version == 1 else "update",
    }
    row.update(changes)
    return tuple(row.values())


def journal(spark, rows):
    return spark.createDataFrame(rows, schemas.JOURNAL)
