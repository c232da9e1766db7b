import random

import pytest
from pyspark.sql import functions as F

from tests import support as s
from tidemark.operators import views
from tidemark.operators.classify import classify


def dispositions(ledger):
    rows = ledger.select("delivery_id", "disposition", "reason_code").collect()
    return [(r["disposition"], r["reason_code"]) for r in sorted(rows)]


def random_messages(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        # Entity 1 gets about half of all deliveries, and one of its events a third of those.
        key = 1 if rng.random() < 0.5 else rng.randint(2, 9)
        version = 4 if key == 1 and rng.random() < 0.3 else rng.randint(1, 30)
        price = "100.20" if rng.random() < 0.85 else "999.00"
        out.append((key, version, price))
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_the_sequential_model(spark, seed, hot_rows):
    messages = random_messages(seed, 700)
    sink = s.SequentialSink()
    expected = [sink.take(k, v, p) for k, v, p in messages]
    wire = s.wire(spark, [s.deliver(s.envelope(k, v, p)) for k, v, p in messages])
    ledger = classify(wire, s.T0, hot_rows=hot_rows)
    assert [d for d, _ in dispositions(ledger)] == expected
    current = {r["entity_key"]: r["source_version"] for r in views.orders_current(ledger).collect()}
    assert current == {f"order:{k}": v for k, v in sink.current.items()}


@pytest.mark.parametrize("hot_rows", [1_000_000, 25])
def test_incremental_equals_the_sequential_model(spark, hot_rows, folder):
    messages = random_messages(7, 600)
    sink = s.SequentialSink()
    expected = [sink.take(k, v, p) for k, v, p in messages]
    got, ledger, first_id = [], None, 1
    for part in range(4):
        chunk = messages[part * 150:(part + 1) * 150]
        wire = s.wire(spark, [s.deliver(s.envelope(k, v, p)) for k, v, p in chunk], start=part * 150)
        registry = None if ledger is None else views.registry(ledger)
        rows = classify(wire, s.T0, registry, first_id, hot_rows)
        rows.write.mode("append").parquet(f"{folder}/ledger")
        ledger = spark.read.parquet(f"{folder}/ledger")
        first_id += 150
    got = [d for d, _ in dispositions(ledger)]
    assert got == expected


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 2, 1), (2, 1, 3), (1, 3, 2)])
def test_any_arrival_order_converges(spark, order):
    ledger = classify(s.wire(spark, [s.deliver(s.envelope(1, v)) for v in order]), s.T0)
    assert [r["source_version"] for r in views.orders_current(ledger).collect()] == [3]


def test_versions_1_3_2_and_replay(spark):
    messages = [s.deliver(s.envelope(1, v)) for v in (1, 3, 2, 1, 3, 2)]
    ledger = classify(s.wire(spark, messages), s.T0)
    assert [d for d, _ in dispositions(ledger)] == ["accepted", "accepted", "stale"] + ["duplicate"] * 3
    assert views.processed_events(ledger).count() == 3


def test_conflicting_content_is_rejected_and_keeps_metadata(spark):
    first, other = s.envelope(1), s.envelope(1, price="999.99")
    ledger = classify(s.wire(spark, [s.deliver(first), s.deliver(other)]), s.T0)
    assert dispositions(ledger) == [("accepted", None), ("rejected", "source_version_conflict")]
    row = ledger.filter("delivery_id = 2").first()
    assert row["event_id"] == first["event_id"] and row["entity_key"] == "order:1"
    assert bytes(row["raw_message"]) == s.compact(other) and row["details"] == []


def test_recapture_with_new_metadata_is_a_duplicate(spark):
    again = s.envelope(1, batch_id="11111111-0000-4000-8000-000000000002", batch_sequence=9,
                       captured_at="2027-01-01T00:00:00.000000Z")
    ledger = classify(s.wire(spark, [s.deliver(s.envelope(1)), s.deliver(again)]), s.T0)
    assert [d for d, _ in dispositions(ledger)] == ["accepted", "duplicate"]


def test_every_rejection_keeps_its_bytes(spark):
    no_version = s.envelope(1)
    del no_version["source_version"]
    no_name = s.envelope(1)
    del no_name["payload"]["customer_name"]
    messages = [
        (b"order:1", b"not-json"),
        (b"order:1", b"\xff"),
        (b"order:1", None),
        s.deliver(s.envelope(1, price="-0.01")),
        s.deliver(no_name),
        s.deliver(no_version),
        s.deliver(s.envelope(1), key="wrong"),
        (None, s.compact(s.envelope(1))),
    ]
    ledger = classify(s.wire(spark, messages), s.T0)
    assert dispositions(ledger) == [
        ("rejected", "invalid_json"),
        ("rejected", "invalid_json"),
        ("rejected", "unsupported_tombstone"),
        ("rejected", "business_quality_violation"),
        ("rejected", "business_quality_violation"),
        ("rejected", "invalid_envelope"),
        ("rejected", "partition_key_mismatch"),
        ("rejected", "partition_key_mismatch"),
    ]
    rows = sorted(ledger.select("delivery_id", "raw_message", "entity_key", "message_key").collect())
    assert [None if r["raw_message"] is None else bytes(r["raw_message"]) for r in rows] == [m[1] for m in messages]
    assert [r["entity_key"] for r in rows] == [None] * 6 + ["order:1"] * 2
    assert views.processed_events(ledger).isEmpty()


def test_rejected_messages_take_no_part(spark):
    """A wrong key or an invalid value must not make a later valid delivery a duplicate or stale."""
    messages = [s.deliver(s.envelope(1, 5), key="wrong"), s.deliver(s.envelope(1, 5)), s.deliver(s.envelope(1, 2))]
    ledger = classify(s.wire(spark, messages), s.T0)
    assert [d for d, _ in dispositions(ledger)] == ["rejected", "accepted", "stale"]


def test_receipt_ids_follow_partition_and_offset(spark):
    rows = s.wire_rows([(b"x", None)] * 3, partition=1, start=10) + s.wire_rows([(b"x", None)] * 2, partition=0)
    wire = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key binary, value binary, timestamp timestamp")
    ledger = classify(wire, s.T0, first_delivery_id=100)
    got = sorted((r["delivery_id"], r["partition_id"], r["broker_offset"]) for r in ledger.collect())
    assert got == [(100, 0, 0), (101, 0, 1), (102, 1, 10), (103, 1, 11), (104, 1, 12)]


def test_one_exchange_of_wide_rows(spark, folder):
    """The plain batch plan shuffles once, whatever the two windows need."""
    s.wire(spark, [s.deliver(s.envelope(k, 1)) for k in range(1, 50)]).write.parquet(f"{folder}/w")
    ledger = classify(spark.read.parquet(f"{folder}/w"), s.T0)
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastExchange" in plan  # the offsets per topic partition
    assert "Python" not in plan


def test_empty_batch(spark):
    ledger = classify(s.wire(spark, []), s.T0)
    assert ledger.count() == 0
    assert ledger.select(F.max("delivery_id")).first()[0] is None
