"""Deliveries as they are stored: without what follows from the rest, and all of it back when read."""

import hashlib
import json
from datetime import timedelta

import support as s
from pyspark.sql import functions as F

from tidemark.functions.validation import validate
from tidemark.operators.classify import classify, receive
from tidemark.operators.slim import slim
from tidemark.plans.pipeline import Pipeline


def odd_messages():
    """Valid messages in several spellings, one of each kind of rejection, and keys that are missing or wrong."""
    plain = s.envelope(1)
    named = s.envelope(2, **{"payload": {**s.envelope(2)["payload"], "customer_name": 'É "x" \\ /\t  😀'}})
    zeros = s.envelope(3, price="007.10")
    zoned = s.envelope(4, captured_at="2026-01-01T08:00:00.000000+02:00", batch_id=s.BATCH.upper(), sync_run_id=s.RUN.replace("-", ""))
    short = s.envelope(5, price="5")
    spaced = json.dumps(s.envelope(6), indent=1).encode()
    escaped = json.dumps(named, separators=(",", ":")).encode()
    changed = s.envelope(1, price="1.00")
    return [
        s.deliver(plain), s.deliver(named), s.deliver(zeros), s.deliver(zoned), s.deliver(short), (b"order:6", spaced),
        (b"order:2", escaped), s.deliver(plain), s.deliver(changed), s.deliver(s.envelope(1, 3)), s.deliver(s.envelope(1, 2)),
        s.deliver(s.envelope(7), "wrong"), (None, s.compact(s.envelope(8))), (None, None), (b"k", None), (b"order:9", b"{bad"),
        s.deliver(s.envelope(9, price="-1.00")), (b"order:9", b"\xff\xfe"),
    ]


def as_said(ledger):
    return {row["delivery_id"]: row for row in ledger.collect()}


def test_stored_deliveries_come_back_whole(spark, folder):
    wire = s.wire(spark, odd_messages())
    at = s.T0 + timedelta(hours=1)
    for number, hot_rows in enumerate((10**6, 2)):
        pipeline = Pipeline(spark, f"{folder}/{number}", clock=lambda: at)
        pipeline.materialize(wire, "all", hot_rows=hot_rows)
        expected = as_said(classify(wire, at))
        got = as_said(pipeline.ledger())
        assert pipeline.ledger().dtypes == classify(wire, at).dtypes
        assert len(got) == len(odd_messages()) and got == expected
        pipeline.materialize(s.wire(spark, odd_messages(), start=100), "again", hot_rows=hot_rows)
        kinds = pipeline.ledger().filter("delivery_id > 18").groupBy("disposition").count().collect()
        assert {row["disposition"]: row["count"] for row in kinds} == {"duplicate": 10, "rejected": 8}
        raw = {row["delivery_id"]: row["raw_message"] for row in pipeline.ledger().collect()}
        assert [raw[i] for i in range(1, 19)] == [raw[i] for i in range(19, 37)] == [m[1] and bytearray(m[1]) for m in odd_messages()]


def test_own_spelling_is_stored_once(spark, folder):
    """The text, the key and the ids of the publisher's own messages follow from their content."""
    messages = [s.deliver(s.envelope(k)) for k in range(1, 40)]
    pipeline = Pipeline(spark, folder)
    pipeline.materialize(s.wire(spark, messages), "all")
    stored = pipeline.sink.read("ledger")
    assert "event_id" not in stored.columns and "envelope" not in stored.columns
    assert stored.filter(F.col("raw_message").isNotNull() | F.col("message_key").isNotNull()).isEmpty()
    assert sorted(bytes(row[0]) for row in pipeline.ledger().select("raw_message").collect()) == sorted(m[1] for m in messages)
    # Other texts stay as they came.
    rows = slim(validate(receive(s.wire(spark, odd_messages())).rows))
    assert {r[0] for r in rows.filter("raw_message is null").select("delivery_id").collect()} == {1, 2, 8, 9, 10, 11, 12, 13, 14, 15}


def test_stored_rows_are_shuffled_once_at_most(spark, folder, monkeypatch):
    """The current state takes one shuffle, copies of stored rows take none, and no shuffle files stay."""
    pipeline = Pipeline(spark, folder)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, seen, write = spark.conf.get(name), [], pipeline.sink.replace

    def noted(table, rows):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        seen.append((table, plan.count("Exchange hashpartitioning") + plan.count("Exchange REBALANCE"), spark.conf.get(name)))
        write(table, rows)

    monkeypatch.setattr(pipeline.sink, "replace", noted)
    messages = [s.deliver(s.envelope(k, v)) for k in range(1, 9) for v in (1, 2)]
    pipeline.materialize(s.wire(spark, messages), "one")
    pipeline.materialize(s.wire(spark, [s.deliver(s.envelope(3, 3))], start=100), "two")
    pipeline.compact()
    assert seen[:3] == [("ledger", 1, "true"), ("registry", 0, "true"), ("current", 1, "true")]
    assert seen[-3:-1] == [("ledger", 0, "true"), ("registry", 0, "true")]
    assert spark.conf.get(name) == own
    current = {r["entity_key"]: (r["source_version"], r["last_event_id"]) for r in pipeline.orders_current().collect()}
    assert current == {f"order:{k}": (v, s.event_id(s.SOURCE, f"order:{k}", v)) for k in range(1, 9) for v in [3 if k == 3 else 2]}


def test_lanes_are_sums_of_sixteen_bits(spark):
    from tidemark.operators import checks, views

    ledger = classify(s.wire(spark, [s.deliver(s.envelope(k)) for k in range(1, 20)]), s.T0)
    current = views.orders_current(ledger)
    row = checks._row_json({name: F.col(name) for name in current.columns})
    digests = [r[0] for r in current.select(F.sha2(row, 256)).collect()]
    sums = [19, *(sum(int(d[4 * i : 4 * i + 4], 16) for d in digests) for i in range(16))]
    assert checks.state_fingerprint(current).first()["sha256"] == hashlib.sha256(",".join(map(str, sums)).encode()).hexdigest()
