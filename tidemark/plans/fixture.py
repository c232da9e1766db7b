"""A deterministic order history derived from the test tables, for queries that need deliveries.

``k = o_orderkey + 1`` because a cursor key must be positive. Every order has version 1; every fifth a version
2 (one unit dearer), every fifteenth a version 3 (three units dearer than version 1). The orders of customer 0
stay in: that key is invalid, so they end in quarantine.

Deliveries are ordered by (phase, k) inside the partition of their key:

=====  ====================================  ==========================================
phase  message                               outcome
=====  ====================================  ==========================================
0      version 1 of every order              accepted
1      version 3 where k % 30 = 0            accepted
2      version 2 where k % 5 = 0             stale where k % 30 = 0, else accepted
3      version 3 where k % 30 <> 0           accepted
4      version 1 recaptured, k % 7 = 0       duplicate
5      version 1, other name, k % 77 = 0     rejected: source_version_conflict
6      no value, k % 103 = 0                 rejected: unsupported_tombstone
7      broken JSON, k % 101 = 0              rejected: invalid_json
8      version 1, wrong key, k % 107 = 0     rejected: partition_key_mismatch
9      version 1, price -1.00, k % 109 = 0   rejected: business_quality_violation
10     no source_version, k % 113 = 0        rejected: invalid_envelope
=====  ====================================  ==========================================
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import entity_key, key_bytes, wire_json
from tidemark.functions.validation import validate
from tidemark.operators.capture import JOURNAL_COLUMNS, check_rows, valid_events
from tidemark.operators.capture import envelope as capture_envelope
from tidemark.operators.classify import classify
from tidemark.operators.writers import Written, seed_source
from tidemark.schemas import MONEY
from tidemark.sources.wire import TOPIC, as_wire, assign_offsets, messages, partition_by_key

T0 = datetime(2026, 1, 1, tzinfo=timezone.utc)
CAPTURED = T0 + timedelta(seconds=5)
RECAPTURED = T0 + timedelta(hours=1)
SOURCE = "shop.orders"
RUN = "00000000-0000-4000-8000-000000000001"
SECOND_RUN = "00000000-0000-4000-8000-000000000002"
# Offsets are assigned in ordered blocks of 2^17 order keys: many more than tasks, so that tasks are even.
BLOCK_BITS = 17


def sample_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """ORDERS (keys moved by one) and CUSTOMER, needed columns only."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        (F.col("o_orderkey") + 1).alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    return orders, customer


def seeded(spark: SparkSession, sf_dir: str) -> Written:
    return seed_source(*sample_tables(spark, sf_dir), None, T0)


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change journal: one scan, versions by explode."""
    k = F.col("order_key")
    versions = F.array_compact(F.array(F.lit(1), F.when(k % 5 == 0, F.lit(2)), F.when(k % 15 == 0, F.lit(3))))
    step = F.when(F.col("v") == 2, 1).when(F.col("v") == 3, 3).otherwise(0)
    seed = seeded(spark, sf_dir).current.drop("source_version", "source_updated_at", "event_type")
    return (
        seed.withColumn("v", F.explode(versions))
        .withColumn("total_price", (F.col("total_price") + step).cast(MONEY))
        .withColumn("source_version", F.col("v").cast("bigint"))
        .withColumn("source_updated_at", F.timestamp_micros(F.lit(micros(T0)) + F.col("v") - 1))
        .withColumn("event_type", F.when(F.col("v") == 1, "insert").otherwise("update"))
        .select(*JOURNAL_COLUMNS)
    )


def source_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source state after all updates: the journal's highest version per order (in closed form)."""
    k = F.col("order_key")
    last = F.when(k % 15 == 0, 3).when(k % 5 == 0, 2).otherwise(1)
    return journal(spark, sf_dir).filter(F.col("source_version") == last)


def micros(at: datetime) -> int:
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _phases() -> Column:
    k, v = F.col("order_key"), F.col("source_version")

    def on(condition: Column, phase: int) -> Column:
        return F.when(condition, F.lit(phase))

    first = F.array(
        F.lit(0), on(k % 7 == 0, 4), on(k % 77 == 0, 5), on(k % 103 == 0, 6), on(k % 101 == 0, 7),
        on(k % 107 == 0, 8), on(k % 109 == 0, 9), on(k % 113 == 0, 10),
    )
    third = F.array(F.when(k % 30 == 0, F.lit(1)).otherwise(F.lit(3)))
    return F.array_compact(F.when(v == 1, first).when(v == 2, F.array(F.lit(2))).otherwise(third))


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries above as a topic table."""
    paged = journal(spark, sf_dir).withColumn("batch_sequence", F.lit(1))
    events = valid_events(check_rows(paged, SOURCE, RUN)).select(*paged.columns)
    event = capture_envelope(SOURCE, RUN, CAPTURED)
    phase = F.col("phase")
    envelope = F.col("envelope")
    payload = (
        envelope["payload"]
        .withField(
            "customer_name",
            F.when(phase == 5, F.concat(envelope["payload"]["customer_name"], F.lit(" changed"))).otherwise(
                envelope["payload"]["customer_name"]
            ),
        )
        .withField(
            "total_price",
            F.when(phase == 9, F.lit("-1.00").cast(MONEY)).otherwise(envelope["payload"]["total_price"]),
        )
    )
    altered = (
        envelope.withField("payload", payload)
        .withField(
            "captured_at",
            F.when(phase == 4, F.timestamp_micros(F.lit(micros(RECAPTURED)))).otherwise(envelope["captured_at"]),
        )
        .withField("sync_run_id", F.when(phase == 4, F.lit(SECOND_RUN)).otherwise(envelope["sync_run_id"]))
        # ``to_json`` leaves a NULL field out: the message has no source_version at all.
        .withField("source_version", F.when(phase != 10, envelope["source_version"]))
    )
    text = F.when(phase == 7, F.lit("{bad-json")).when(phase != 6, wire_json(F.col("sent")))
    key = key_bytes(F.when(phase == 8, F.lit("wrong")).otherwise(entity_key(F.col("order_key"))))
    rows = events.withColumn("phase", F.explode(_phases())).withColumns(
        {"block": F.shiftright("order_key", BLOCK_BITS), "partition": partition_by_key(key)}
    )
    placed = assign_offsets(rows, TOPIC, order=("order_key",), chunk=("phase", "block"))
    return as_wire(
        placed.withColumn("envelope", event)
        .withColumn("sent", altered)
        .select(
            "topic", "partition", "offset", key.alias("key"), key_bytes(text).alias("value"),
            F.timestamp_micros(F.lit(micros(CAPTURED))).alias("timestamp"),
        )
    )


def processed_at() -> Column:
    """Sink clock of the fixture: one microsecond later per receipt."""
    return F.timestamp_micros(F.lit(micros(T0 + timedelta(seconds=10))) + F.col("delivery_id"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(wire(spark, sf_dir), processed_at())


# One change per rule: pattern and replacement in the publisher's text, then what validation must say:
# reason, location and rule. Order k gets the change number k modulo their count.
_ID64 = "0" * 64
CHANGES = (
    (r'"customer_name":"[^"]*"', '"customer_name":""', "business_quality_violation", "payload.customer_name", "string_too_short"),
    (r'"customer_name":"[^"]*"', f'"customer_name":"{"x" * 201}"', "business_quality_violation", "payload.customer_name", "string_too_long"),
    (r',"customer_name":"[^"]*"', "", "business_quality_violation", "payload.customer_name", "missing"),
    (r'"order_status":"."', '"order_status":"X"', "business_quality_violation", "payload.order_status", "literal_error"),
    (r'"order_date":"[^"]*"', '"order_date":"1996-02-30"', "business_quality_violation", "payload.order_date", "date_from_datetime_parsing"),
    (r'"order_key":[0-9]+', '"order_key":"1"', "business_quality_violation", "payload.order_key", "int_type"),
    (r'"customer_key":[0-9]+', '"customer_key":-1', "business_quality_violation", "payload.customer_key", "greater_than"),
    (r'"total_price":"[^"]*"', '"total_price":"1.001"', "business_quality_violation", "payload.total_price", "decimal_max_places"),
    (r'"total_price":"[^"]*"', '"total_price":1.5', "business_quality_violation", "payload.total_price", "value_error"),
    (r'"total_price":"[^"]*"', '"total_price":"NaN"', "business_quality_violation", "payload.total_price", "finite_number"),
    (r'"order_key"', '"other":1,"order_key"', "business_quality_violation", "payload.other", "extra_forbidden"),
    (r'"payload":\{[^}]*\}', '"payload":"text"', "business_quality_violation", "payload", "model_type"),
    (r'^\{', '{"other":1,', "invalid_envelope", "other", "extra_forbidden"),
    (r'"event_id":"[^"]*"', '"event_id":"zz"', "invalid_envelope", "event_id", "string_pattern_mismatch"),
    (r'"event_id":"[^"]*"', f'"event_id":"{_ID64}"', "invalid_envelope", "", "value_error"),
    (r'"event_type":"[^"]*"', '"event_type":"delete"', "invalid_envelope", "event_type", "literal_error"),
    (r'"source":"[^"]*"', '"source":"a b"', "invalid_envelope", "source", "string_pattern_mismatch"),
    (r'"entity_key":"[^"]*"', '"entity_key":"Order:1"', "invalid_envelope", "entity_key", "string_pattern_mismatch"),
    (r'"entity_key":"[^"]*"', '"entity_key":"order:0999999999"', "invalid_envelope", "entity_key", "string_pattern_mismatch"),
    (r'"schema_version":1', '"schema_version":2', "invalid_envelope", "schema_version", "literal_error"),
    (r'"schema_version":1', '"schema_version":true', "invalid_envelope", "schema_version", "value_error"),
    (r'"source_version":[0-9]+', '"source_version":0', "invalid_envelope", "source_version", "greater_than"),
    (r'"source_version":[0-9]+', '"source_version":true', "invalid_envelope", "source_version", "int_type"),
    (r'"batch_sequence":[0-9]+', '"batch_sequence":"1"', "invalid_envelope", "batch_sequence", "int_type"),
    (r'"captured_at":"([^"]*)Z"', '"captured_at":"$1"', "invalid_envelope", "captured_at", "timezone_aware"),
    (r'"captured_at":"[^"]*"', '"captured_at":1767225605', "invalid_envelope", "captured_at", "value_error"),
    (r'"occurred_at":"[^"]*"', '"occurred_at":"2025-12-31T00:00:00.000000Z"', "invalid_envelope", "", "value_error"),
    (r'"batch_id":"[^"]*"', '"batch_id":"nope"', "invalid_envelope", "batch_id", "uuid_parsing"),
    (r'"sync_run_id":"[^"]*"', '"sync_run_id":7', "invalid_envelope", "sync_run_id", "uuid_type"),
    (r'"captured_at":"[^"]*"', '"captured_at":"2026-01-01T02:00:05.000000+02:00"', None, None, None),
)


def rule_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First versions as messages, each with one change: deliveries per reason, location and rule."""
    rows = journal(spark, sf_dir).filter("source_version = 1").withColumn("batch_sequence", F.lit(1))
    events = valid_events(check_rows(rows, SOURCE, RUN)).withColumn("envelope", capture_envelope(SOURCE, RUN, CAPTURED))
    sent = messages(events.select("order_key", "envelope"))
    text, number = F.col("value").cast("string"), F.col("order_key") % len(CHANGES)
    changed = text
    for i, (pattern, put, *_) in enumerate(CHANGES):
        changed = F.when(number == i, F.regexp_replace(text, pattern, put)).otherwise(changed)
    wire_rows = sent.select(F.col("key"), changed.cast("binary").alias("value"))
    said = validate(wire_rows).select("reason_code", F.explode_outer("details").alias("error"))
    return said.groupBy(
        "reason_code", F.array_join("error.loc", ".").alias("loc"), F.col("error.type").alias("rule")
    ).agg(F.count(F.lit(1)).alias("deliveries"))
