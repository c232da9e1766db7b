from datetime import timedelta, timezone, datetime

import pytest
from pyspark.sql import functions as F

from tests import support as s
from tidemark import schemas
from tidemark.operators import capture as cap
from tidemark.operators import checks, inspect, views, writers
from tidemark.operators.classify import Misplaced
from tidemark.plans import fixture
from tidemark.plans.pipeline import Pipeline
from tidemark.sources import wire as topic
from tidemark.streaming.ingest import run_capture, run_stream, run_topic_stream

US = timedelta(microseconds=1)


class Clock:
    def __init__(self):
        self.now = s.T0 + timedelta(days=10)

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


def make(spark, folder):
    return Pipeline(spark, folder, clock=Clock())


def test_cursors_compare_as_instants_and_numbers():
    early = cap.Cursor.of(datetime(2026, 1, 1, 10, tzinfo=timezone.utc), 9)
    late = cap.Cursor.of(datetime(2026, 1, 1, 12, tzinfo=timezone(timedelta(hours=2))), 10)
    assert late.follows(early) and not early.follows(late)
    for bad in (0, -1, True, "1"):
        with pytest.raises(ValueError):
            cap.Cursor.of(s.T0, bad)
    with pytest.raises(ValueError):
        cap.Cursor.of(datetime(2026, 1, 1), 1)


def test_ties_increments_and_no_change(spark, folder):
    pipeline = make(spark, folder)
    rows = [s.journal_row(k) for k in range(1, 6)]
    assert pipeline.sync(s.journal(spark, rows), s.SOURCE, batch_size=2) == 5
    assert pipeline.sync(s.journal(spark, rows), s.SOURCE) == 0
    rows += [s.journal_row(1, s.T0 + US, 2), s.journal_row(6, s.T0 + US), s.journal_row(1, s.T0 + 2 * US, 3)]
    assert pipeline.sync(s.journal(spark, rows), s.SOURCE, batch_size=1) == 3
    runs = pipeline.runs().orderBy("started_at").collect()
    assert [(r["mode"], r["status"]) for r in runs] == [("initial", "completed"), ("incremental", "completed")]
    batches = pipeline.batches().collect()
    assert sorted(b["records_seen"] for b in batches) == [1, 1, 1, 1, 2, 2]
    assert {b["status"] for b in batches} == {"published"}
    wire = pipeline.wire()
    versions = wire.filter(F.col("key").cast("string") == "order:1").orderBy("offset").select(
        F.get_json_object(F.col("value").cast("string"), "$.source_version")
    )
    assert [row[0] for row in versions.collect()] == ["1", "2", "3"]
    # Offsets are dense per partition across both runs.
    for row in wire.groupBy("partition").agg(F.min("offset"), F.max("offset"), F.count("*")).collect():
        assert row[1] == 0 and row[2] + 1 == row[3]
    last = {r["entity_key"]: r["source_version"] for r in pipeline.entity_versions().collect()}
    assert last == {"order:1": 3, **{f"order:{k}": 1 for k in range(2, 7)}}


def test_quarantine_moves_the_cursor_and_keeps_the_record(spark, folder):
    pipeline = make(spark, folder)
    rows = s.journal(spark, [s.journal_row(1, price="-1"), s.journal_row(2, customer_name=None)])
    assert pipeline.sync(rows, s.SOURCE) == 2
    assert pipeline.wire().count() == 0
    kept = pipeline.quarantine().orderBy("order_key").collect()
    assert [row["order_key"] for row in kept] == [1, 2]
    assert '"total_price":"-1.00"' in kept[0]["raw_record"] and '"customer_name":null' in kept[1]["raw_record"]
    assert kept[0]["reason"] == "payload.total_price: greater_than_equal"
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 2)


def test_a_repeated_cursor_stops_before_its_page(spark, folder):
    pipeline = make(spark, folder)
    rows = s.journal(spark, [s.journal_row(k) for k in (9, 10, 10, 11)])
    with pytest.raises(cap.CaptureError):
        pipeline.sync(rows, s.SOURCE, batch_size=1)
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 9)
    assert [r["status"] for r in pipeline.runs().collect()] == ["failed"]
    with pytest.raises(cap.CaptureError):
        pipeline.sync(rows, s.SOURCE, batch_size=2)
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 9)


def test_an_invalid_key_stops_the_run(spark, folder):
    pipeline = make(spark, folder)
    with pytest.raises(cap.CaptureError):
        pipeline.sync(s.journal(spark, [s.journal_row(0), s.journal_row(1)]), s.SOURCE)
    assert pipeline.load_cursor(s.SOURCE) is None


def test_a_row_without_a_place_stops_the_run(spark, folder):
    for missing in ("source_updated_at", "order_key"):
        pipeline = make(spark, f"{folder}/{missing}")
        rows = s.journal(spark, [s.journal_row(k) for k in (1, 2, 3)])
        rows = rows.withColumn(missing, F.when(F.col("order_key") != 2, F.col(missing)))
        with pytest.raises(cap.CaptureError):
            pipeline.sync(rows, s.SOURCE)
        assert pipeline.load_cursor(s.SOURCE) is None
        assert [r["status"] for r in pipeline.runs().collect()] == ["failed"]


def test_a_journal_behind_the_checkpoint_fails_closed(spark, folder):
    pipeline = make(spark, folder)
    pipeline.sync(s.journal(spark, [s.journal_row(1), s.journal_row(2)]), s.SOURCE)
    for rows in ([], [s.journal_row(1)]):
        with pytest.raises(cap.CaptureError, match="regressed"):
            pipeline.sync(s.journal(spark, rows), s.SOURCE)
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 2)
    assert make(spark, folder + "/empty").sync(s.journal(spark, []), s.SOURCE) == 0


def test_a_failed_publication_is_repeated_with_equal_ids(spark, folder):
    pipeline = make(spark, folder)
    rows = s.journal(spark, [s.journal_row(k) for k in range(1, 6)])
    sent = []

    def broken(events):
        sent.append({row[0] for row in events.select("envelope.event_id").collect()})
        if len(sent) == 2:
            raise RuntimeError("no acknowledgement")

    with pytest.raises(RuntimeError, match="acknowledgement"):
        pipeline.sync(rows, s.SOURCE, batch_size=2, commit_pages=1, publish=broken)
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 2)
    assert sorted((b["batch_sequence"], b["status"]) for b in pipeline.batches().collect()) == [(1, "published"), (2, "failed")]
    again = []
    assert pipeline.sync(rows, s.SOURCE, batch_size=2,
                         publish=lambda events: again.append({r[0] for r in events.select("envelope.event_id").collect()})) == 3
    assert sent[1] <= set().union(*again) and len(sent[0].union(*again)) == 5


def test_number_over_many_partitions(spark):
    from tidemark.operators.numbering import sort_and_number

    frame = spark.range(5000).select((F.col("id") % 7).alias("a"), (F.col("id") * 7919 % 5000).alias("b"))
    rows = sort_and_number(frame, "n", ["a", "b"], partitions=13).collect()
    assert [(r["a"], r["b"]) for r in sorted(rows, key=lambda r: r["n"])] == sorted((r["a"], r["b"]) for r in rows)
    assert sorted(r["n"] for r in rows) == list(range(1, 5001))


def test_end_to_end_golden_numbers(spark, sf, folder):
    """Seed n, mutate: n + 5 events, n + 1 entities; four bad messages; replay changes nothing."""
    pipeline, n = make(spark, folder), 40
    orders, customer = fixture.sample_tables(spark, sf)
    orders = orders.filter("o_custkey > 0")
    held = writers.seed_source(orders, customer, n, s.T0)
    with pytest.raises(writers.WriteRefused):
        writers.seed_source(orders, customer, n, s.T0, existing=held)
    assert pipeline.sync(held.current, s.SOURCE, batch_size=7) == n
    pipeline.materialize(pipeline.wire(), "first")
    done = topic.topic_offsets(pipeline.wire())
    done = spark.createDataFrame(done.collect(), done.schema)

    changed = writers.mutate_source(held.current, held.journal_rows, s.T0)
    journal = held.journal_rows.unionByName(changed.journal_rows)
    assert pipeline.sync(journal, s.SOURCE) == 5
    half = done.select("topic", "partition", F.col("high").alias("_h"))
    new = pipeline.wire().join(half, ["topic", "partition"], "left").filter("offset >= coalesce(_h, 0)").drop("_h")
    pipeline.materialize(new, "second")
    assert pipeline.processed_events().count() == n + 5
    assert pipeline.orders_current().count() == n + 1
    lowest = changed.current.agg(F.min("order_key")).first()[0]
    view = inspect.entity_view(pipeline.ledger(), f"order:{lowest}", s.SOURCE)
    assert view.current["source_version"] == 3
    assert [row["envelope"]["source_version"] for row in view.history] == [1, 2, 3]
    assert checks.source_sink_diff(changed.current, pipeline.orders_current()).isEmpty()

    good = pipeline.processed_events().orderBy("entity_key", "source_version").limit(1)
    sent = topic.messages(good.select("envelope")).first()
    text = bytes(sent["value"]).decode()
    bad = [b"{bad-json", text.replace('"total_price":"', '"total_price":"-').encode(),
           text.replace('"source_version"', '"version"').encode(),
           text.replace('"customer_name":"', '"customer_name":"other ').encode()]
    where = spark.range(1).select(topic.partition_by_key(F.lit(bytes(sent["key"])))).first()[0]
    start = pipeline.wire().filter(F.col("partition") == where).count()
    pipeline.deliver(s.wire(spark, [(bytes(sent["key"]), value) for value in bad], start=start, topic=topic.TOPIC, partition=where))
    pipeline.materialize(pipeline.wire().filter((F.col("partition") == where) & (F.col("offset") >= start)), "bad")
    reasons = {r["reason_code"]: r["rejections"] for r in checks.rejections_by_reason(pipeline.ledger()).collect()}
    assert reasons == {"invalid_json": 1, "business_quality_violation": 1, "invalid_envelope": 1, "source_version_conflict": 1}

    before = pipeline.ledger()
    proof = {row["measure"]: row for row in pipeline.replay("one").collect()}
    assert all(row["holds"] for row in proof.values()), proof
    assert int(proof["deliveries"]["after"]) - int(proof["deliveries"]["before"]) == n + 9
    assert proof["rejections"]["after"] == "8" and proof["deliveries"]["after"] == str(2 * (n + 9))
    assert checks.ledger_losses(before, pipeline.ledger()).isEmpty()
    assert checks.check_constraints(pipeline.public_tables()).filter("violations > 0").isEmpty()

    assert checks.state_fingerprint(pipeline.orders_current()).first()["sha256"] == proof["state"]["after"]
    assert pipeline.compact() and not pipeline.compact()
    assert checks.ledger_losses(before, pipeline.ledger()).isEmpty() and pipeline.ledger().count() == 2 * (n + 9)
    assert checks.state_fingerprint(pipeline.pinned().orders_current()).first()["sha256"] == proof["state"]["after"]
    stats = pipeline.stats()
    assert stats.counts.first()["unique_events"] == n + 5
    mark = stats.watermarks.first()
    assert mark["last_order_key"] == lowest and mark["last_sync_completed_at"] is not None

    assert {r["table_name"]: r["row_count"] for r in pipeline.census().collect()}["event_deliveries"] == 2 * (n + 9)
    assert pipeline.reset() and not pipeline.reset()
    assert {r["row_count"] for r in pipeline.census().collect()} == {0}
    assert pipeline.load_cursor(s.SOURCE) is not None
    pipeline.materialize(pipeline.wire(), "rebuild")
    rebuilt = {row["measure"]: row["value"] for row in pipeline.snapshot().collect()}
    assert rebuilt["state"] == proof["state"]["after"] and rebuilt["logical events"] == str(n + 5)
    # Receipt ids go on after a reset.
    assert pipeline.ledger().agg(F.min("delivery_id")).first()[0] > 2 * (n + 9)


def test_stream_restart_and_repeated_batch(spark, folder):
    pipeline = make(spark, folder)
    first = [s.deliver(s.envelope(k, v)) for k, v in ((1, 1), (1, 3), (2, 1))]
    pipeline.deliver(s.wire(spark, first).coalesce(1))

    def run():
        stream = topic.read_wire_stream(spark, pipeline.wire_path, max_files=1)
        run_stream(pipeline, stream, f"{folder}/checkpoint", "main", available_now=True).awaitTermination()

    run()
    run()
    assert pipeline.ledger().count() == 3
    second = [s.deliver(s.envelope(k, v)) for k, v in ((1, 2), (1, 3), (2, 2))]
    pipeline.deliver(s.wire(spark, second, start=3).coalesce(1))
    run()
    got = [r["disposition"] for r in pipeline.ledger().orderBy("delivery_id").collect()]
    assert got == ["accepted", "accepted", "accepted", "stale", "duplicate", "accepted"]
    # A batch that runs again after its commit changes nothing.
    assert [row.batch for row in pipeline._batches()] == ["main-0000000000", "main-0000000001"]
    assert not pipeline.materialize(pipeline.wire(), "main-0000000001")
    assert pipeline.ledger().count() == 6


class Killed(Exception):
    pass


def test_an_interrupted_batch_is_invisible_and_done_again(spark, folder, monkeypatch):
    """Killed after each of its writes in turn; then another batch, and the same one again."""
    first = s.wire(spark, [s.deliver(s.envelope(1))])
    again = s.wire(spark, [s.deliver(s.envelope(1)), s.deliver(s.envelope(2)), s.deliver(s.envelope(1, 2))], start=1)
    for number, table in enumerate(("ledger", "registry", "current", "batches")):
        pipeline = make(spark, f"{folder}/{number}")
        pipeline.materialize(first, "one")
        write = pipeline.sink.replace

        def dies(name, rows, table=table, write=write):
            if name != "batches" or table != "batches":
                write(name, rows)
            if name == table:
                raise Killed

        monkeypatch.setattr(pipeline.sink, "replace", dies)
        with pytest.raises(Killed):
            pipeline.materialize(again, "two")
        monkeypatch.undo()
        assert pipeline.ledger().count() == 1 and pipeline.registry().count() == 1
        assert pipeline.materialize(again, "two")
        got = sorted((r["delivery_id"], r["disposition"]) for r in pipeline.ledger().collect())
        assert got == [(1, "accepted"), (2, "duplicate"), (3, "accepted"), (4, "accepted")], table
        assert {r["entity_key"]: r["source_version"] for r in pipeline.orders_current().collect()} == {"order:1": 2, "order:2": 1}


def test_a_batch_reads_and_writes_its_own_buckets(spark, folder):
    pipeline = make(spark, folder)
    pipeline.materialize(s.wire(spark, [s.deliver(s.envelope(k)) for k in range(1, 60)]), "many")
    buckets = {r["bucket"]: r["n"] for r in pipeline.registry().groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    assert len(buckets) > 8
    own = pipeline.registry().filter("entity_key = 'order:7'").first()["bucket"]
    read = pipeline.registry_of([own])
    assert read.count() == buckets[own]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert f"(bucket#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r[0].split("/")[-3] for r in read.select(F.input_file_name()).distinct().collect()} == {f"bucket={own}"}

    def written():
        return set(pipeline.sink.read("current").inputFiles())

    before = written()
    pipeline.materialize(s.wire(spark, [s.deliver(s.envelope(7, 2))], start=100), "one")
    gone, new = before - written(), written() - before
    assert {f.split("/")[-2] for f in gone | new} == {f"bucket={own}"}
    assert checks.state_fingerprint(pipeline.orders_current()).first() == checks.state_fingerprint(views.orders_current(pipeline.ledger())).first()
    with pytest.raises(ValueError, match="buckets"):
        Pipeline(spark, folder, buckets=5).materialize(s.wire(spark, [s.deliver(s.envelope(8, 2))], start=200), "other")


def test_five_batches_equal_the_sequential_model(spark, folder):
    import random

    rng, sink = random.Random(11), s.SequentialSink()
    messages = [(rng.randint(1, 9), rng.randint(1, 12), rng.choice(["100.20", "999.00"])) for _ in range(400)]
    expected = [sink.take(k, v, p) for k, v, p in messages]
    pipeline = make(spark, folder)
    wire = [s.deliver(s.envelope(k, v, p)) for k, v, p in messages]
    for part in range(5):
        pipeline.materialize(s.wire(spark, wire[part * 80 : part * 80 + 80], start=part * 80), f"part-{part}", hot_rows=(30, 10**6)[part % 2])
        if part == 2:
            pipeline.compact()
    assert [r["disposition"] for r in pipeline.ledger().orderBy("delivery_id").collect()] == expected
    assert {r["entity_key"]: r["source_version"] for r in pipeline.orders_current().collect()} == {f"order:{k}": v for k, v in sink.current.items()}


def test_messages_wait_for_earlier_offsets(spark, folder):
    """Files appear in reverse; the result is that of one batch in offset order, and a gap holds back what follows it."""
    messages = [s.deliver(s.envelope(1 + i % 3, 1 + i * 7 % 10)) for i in range(40)]
    expected = make(spark, f"{folder}/whole")
    expected.materialize(s.wire(spark, messages), "all")
    decided = [r["disposition"] for r in expected.ledger().orderBy("broker_offset").collect()]
    pipeline = make(spark, f"{folder}/parts")
    stream = lambda: run_topic_stream(pipeline, f"{folder}/checkpoint", "t", available_now=True, max_files=1).awaitTermination()
    for low, high, ready in ((30, 40, 0), (12, 20, 0), (0, 10, 10), (20, 30, 10), (10, 12, 40)):
        s.wire(spark, messages[low:high], start=low).coalesce(1).write.mode("append").parquet(pipeline.wire_path)
        stream()
        assert pipeline.ledger().count() == ready
    got = pipeline.ledger().orderBy("broker_offset").collect()
    assert [r["disposition"] for r in got] == decided
    assert [r["delivery_id"] for r in got] == list(range(1, 41))
    assert [(e.partition, e.next) for e in pipeline.admitted()] == [(0, 40)]


def test_ends_without_gaps(spark, monkeypatch):
    import random

    monkeypatch.setattr(topic, "SPAN", 4)
    rng = random.Random(5)
    for _ in range(6):
        kept = {p: sorted(rng.sample(range(40), rng.choice([0, 1, 20, 36, 40]))) for p in range(3)}
        start = {0: 0, 1: 5}
        rows = [("t", p, o) for p, offsets in kept.items() for o in offsets] * 2
        done = spark.createDataFrame([("t", p, n) for p, n in start.items()], "topic string, partition int, next bigint")
        got = topic.gapless_ends(spark.createDataFrame(rows, "topic string, partition int, offset bigint"), done)
        for row in got.collect():
            end = low = start.get(row["partition"], 0)
            while end in kept[row["partition"]]:
                end += 1
            assert (row["low"], row["high"]) == (low, end)
        assert {r["partition"] for r in got.collect()} == {p for p, offsets in kept.items() if any(o >= start.get(p, 0) for o in offsets)}


def test_an_entity_on_two_partitions_stops_the_batch(spark, folder):
    pipeline = make(spark, folder)
    value = s.envelope(7)
    right = spark.range(1).select(topic.partition_by_key(F.lit(b"order:7"))).first()[0]
    good = s.wire(spark, [s.deliver(value)], partition=right, topic=topic.TOPIC)
    planted = s.wire(spark, [s.deliver(s.envelope(7, 2))], partition=(right + 1) % 3, topic=topic.TOPIC)
    with pytest.raises(Misplaced):
        pipeline.materialize(good.unionByName(planted), "planted")
    assert pipeline.ledger().count() == 0
    assert pipeline.materialize(good, "good") and pipeline.ledger().count() == 1
    # Counted in the pass that reads the offsets: no exchange by entity.
    plan = receive_plan(good)
    assert plan.count("Exchange hashpartitioning") == 1 and "entity" not in plan


def receive_plan(wire):
    found = wire.groupBy("topic", "partition").agg(F.min("offset"), F.count_if(topic.misplaced()))
    return found._jdf.queryExecution().executedPlan().toString()


def test_polling_takes_a_fresh_watermark_at_each_tick(spark, folder):
    pipeline, path = make(spark, folder), f"{folder}/journal"

    def tick(rows):
        s.journal(spark, rows).toDF(*[c.upper() for c in s.journal(spark, []).columns]).write.mode("append").parquet(path)
        run_capture(pipeline, path, s.SOURCE, f"{folder}/polls", "poll", available_now=True).awaitTermination()

    tick([s.journal_row(k) for k in (1, 2, 3)])
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 3)
    tick([s.journal_row(2, s.T0 + US, 2), s.journal_row(9, s.T0 + US)])
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0 + US, 9)
    run_capture(pipeline, path, s.SOURCE, f"{folder}/polls", "poll", available_now=True).awaitTermination()
    runs = pipeline.runs().orderBy("started_at").collect()
    assert [(r["mode"], r["status"], r["high_watermark_order_key"]) for r in runs] == [("initial", "completed", 3), ("incremental", "completed", 9)]
    assert sorted(b["records_seen"] for b in pipeline.batches().collect()) == [2, 3]


def test_a_run_is_committed_in_groups(spark, folder):
    """A crash in the second group repeats that group alone; the range is scanned once and groups read their chunks."""
    pipeline = make(spark, folder)
    rows = s.journal(spark, [s.journal_row(k) for k in range(1, 41)])
    sent = []

    def publish(events):
        keys = sorted(r["order_key"] for r in events.select("order_key").collect())
        sent.append(keys)
        if len(sent) == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        pipeline.sync(rows, s.SOURCE, batch_size=5, publish=publish)
    assert pipeline.load_cursor(s.SOURCE) == cap.Cursor.of(s.T0, 10)
    assert pipeline.sync(rows, s.SOURCE, batch_size=5, publish=publish) == 30
    assert sent[0] == list(range(1, 11)) and sent[1] == list(range(11, 21)) and sent[2][0] == 11
    assert sorted(k for part in sent[2:] for k in part) == list(range(11, 41))
    statuses = sorted((b["status"], b["error_code"] or "") for b in pipeline.batches().collect())
    assert statuses == [("failed", "sync_failure")] * 2 + [("published", "")] * 8


def test_a_publication_without_its_row_keeps_its_offsets(spark, folder, monkeypatch):
    pipeline = make(spark, folder)
    pipeline.deliver(s.wire(spark, [s.deliver(s.envelope(1))]))
    monkeypatch.setattr(pipeline.topic, "replace_row", lambda *a, **b: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        pipeline.deliver(s.wire(spark, [s.deliver(s.envelope(2))], start=1))
    monkeypatch.undo()
    number, ends = pipeline._topic_ends()
    assert number == 1 and [(e.partition, e.next) for e in ends] == [(0, 2)]


def test_disorder_inside_a_chunk_is_found(spark):
    rows = [(0, i, k) for i, k in enumerate((1, 2, 5, 4, 6))] + [(1, i, k) for i, k in enumerate((7, 7, 8))] + [(2, 0, 3), (2, 1, -1)]
    staged = spark.createDataFrame([(c, i, s.T0, k) for c, i, k in rows], "chunk int, row bigint, source_updated_at timestamp, order_key bigint")
    faults = cap.order_faults(staged, cap.Cursor.of(s.T0, 1), cap.Cursor.of(s.T0, 7)).first()
    # 4 after 5 inside a chunk, 3 after 8 across two, -1 after 3; 7 twice; 1, -1 and 8 lie outside.
    assert (faults["disordered"], faults["repeated"], faults["invalid"], faults["outside"]) == (3, 1, 1, 3)
    assert faults["unsafe_key"] == -1
    with pytest.raises(cap.CaptureError, match="order"):
        cap.assert_ordered(staged, None, cap.Cursor.of(s.T0, 9))
    fine = staged.filter("chunk = 1 and row <> 1")
    assert cap.assert_ordered(fine, None, cap.Cursor.of(s.T0, 9)) is None


def test_known_quarantine_is_read_within_the_captured_range(spark, folder):
    pipeline = make(spark, folder)
    pipeline.sync(s.journal(spark, [s.journal_row(k, price="-1") for k in (1, 2)]), s.SOURCE)
    held = spark.read.parquet(f"{pipeline.capture.path('quarantine')}")
    fresh = spark.read.parquet(f"{pipeline.capture.path('quarantine')}")
    near = cap.new_quarantine(fresh, held, s.SOURCE, cap.Cursor.of(s.T0, 2), cap.Cursor.of(s.T0 + US, 5))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Or(GreaterThan(source_updated_at" in plan and "LessThanOrEqual(order_key,5)" in plan and f"EqualTo(source,{s.SOURCE})" in plan


@pytest.mark.parametrize("arguments", [
    {"limit": 0}, {"limit": 501}, {"after_id": -1}, {"after_id": 2**63}, {"event_type": "delete"},
    {"entity_key": ""}, {"source": ""}, {"since": "bad"}, {"since": datetime(2026, 1, 1)},
    {"since": s.T0 + timedelta(days=31), "until": s.T0},
])
def test_bad_arguments_are_refused_before_any_job(arguments):
    with pytest.raises(ValueError):
        inspect.events_page(None, **arguments)


def test_pages_filters_and_entities(spark, folder):
    pipeline = make(spark, folder)
    versions = (1, 3, 2, 3, 1)
    messages = [s.deliver(s.envelope(1, v)) for v in versions] + [(b"order:7", s.compact(s.envelope(5, 1)))]
    pipeline.materialize(s.wire(spark, messages), "a")
    ledger = pipeline.ledger()
    ids, after = [], 0
    while after is not None:
        page = inspect.events_page(ledger, 2, entity_key="order:1", source=s.SOURCE, after_id=after)
        ids += [row["delivery_id"] for row in page.items]
        after = page.next_after_id
    assert ids == [1, 2, 3, 4, 5]
    updates = inspect.events_page(ledger, entity_key="order:1", event_type="update").items
    assert [row["envelope"]["source_version"] for row in updates] == [3, 2, 3]
    instant = s.T0 + 1 * US
    assert len(inspect.events_page(ledger, entity_key="order:1", since=instant, until=instant).items) == 2
    assert inspect.events_page(ledger, since=s.T0 + timedelta(days=1)).items == []
    rejected = inspect.entity_view(ledger, "order:5", s.SOURCE)
    assert rejected.current is None and rejected.history[0]["envelope"] is None
    assert rejected.history[0]["reason_code"] == "partition_key_mismatch"
    with pytest.raises(inspect.EntityNotFound):
        inspect.entity_view(ledger, "absent", s.SOURCE)


def test_stored_pages_read_later_batches_only(spark, folder):
    pipeline = make(spark, folder)
    versions = (1, 3, 2, 3, 1, 4)
    for part in range(3):
        messages = [s.deliver(s.envelope(1, v)) for v in versions[part * 2 : part * 2 + 2]] + [s.deliver(s.envelope(2 + part))]
        pipeline.materialize(s.wire(spark, messages, start=part * 3), f"b{part}")
    files = pipeline.ledger(after_id=3).select(F.input_file_name()).distinct().collect()
    assert {r[0].split("/batch=")[1].split("/")[0] for r in files} == {"b1", "b2"}
    ids, after = [], 0
    while after is not None:
        page = pipeline.events_page(2, after, entity_key="order:1", source_prefix="shop")
        ids += [(row["delivery_id"], row["envelope"]["source_version"]) for row in page.items]
        after = page.next_after_id
    assert ids == [(1, 1), (2, 3), (4, 2), (5, 3), (7, 1), (8, 4)]
    assert pipeline.events_page(source_prefix="none.") == inspect.Page([], None)
    view = pipeline.entity_view("order:1", s.SOURCE, after_id=4, limit=2)
    assert view.current["source_version"] == 4 and [r["delivery_id"] for r in view.history] == [5, 7] and view.next_after_id == 7
    assert pipeline.entity_view("order:1", s.SOURCE, after_id=100).history == []
    with pytest.raises(inspect.EntityNotFound):
        pipeline.entity_view("order:9", s.SOURCE)
    plan = pipeline.current_of("order:1", s.SOURCE)._jdf.queryExecution().executedPlan().toString()
    assert "(bucket#" in plan.split("PartitionFilters")[1].split("]")[0] and "EqualTo(entity_key,order:1)" in plan


def test_set_difference(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, t string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("d", 4)], "t string, k int")
    got = {(r["k"], r["t"]): (r["in_left"], r["in_right"]) for r in checks.set_difference(left, right, "k", "t").collect()}
    assert got == {(1, "a"): (2, 1), (3, "c"): (1, 0), (4, "d"): (0, 1)}
    assert checks.set_difference(left, left, "k", "t").isEmpty() and checks.set_difference(left.limit(0), right.limit(0), "k").isEmpty()


def test_empty_tables(spark, folder):
    pipeline = make(spark, folder)
    stats = pipeline.stats()
    assert set(stats.counts.first().asDict().values()) == {0}
    assert stats.counts_by_type.collect() == [] and stats.watermarks.collect() == []
    delay = stats.processing_delay.first()
    assert delay["sample_count"] == 0 and delay["avg_seconds"] is None and delay["max_seconds"] is None
    assert inspect.events_page(pipeline.ledger()) == inspect.Page([], None)
    assert {(r["row_count"], r["exists"]) for r in pipeline.census().collect()} == {(0, False)}


def test_fingerprint_covers_business_state_only(spark):
    from tidemark.operators.classify import classify

    def fingerprint(at, price="100.20", **changes):
        ledger = classify(s.wire(spark, [s.deliver(s.envelope(1, price=price, **changes))]), at)
        return checks.state_fingerprint(views.orders_current(ledger)).first()["sha256"]

    base = fingerprint(s.T0)
    assert base == fingerprint(s.T0 + timedelta(days=1), captured_at="2030-01-01T00:00:00.000000Z")
    assert base != fingerprint(s.T0, price="100.21")


def test_append_skips_used_keys_and_exhausts(spark):
    orders = spark.createDataFrame(
        [(k, 10, "P", float(f"{k}.25"), datetime(2021, 2, 3)) for k in range(1, 7)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
    )
    customer = spark.createDataFrame([(10, "Sample customer")], "c_custkey bigint, c_name string")
    stamp = datetime(2030, 1, 1, tzinfo=timezone.utc)
    current = s.journal(spark, [s.journal_row(1, version=2), s.journal_row(4), s.journal_row(99, at=stamp)])
    one = writers.append_unused(current, current, orders, customer, 2, s.T0)
    assert sorted(r["order_key"] for r in one.journal_rows.collect()) == [2, 3]
    assert {r[0] for r in one.journal_rows.select(F.unix_micros("source_updated_at")).collect()} == {
        fixture.micros(stamp) + 1
    }
    two = writers.append_unused(one.current, current, orders, customer, 10, s.T0)
    assert sorted(r["order_key"] for r in two.journal_rows.collect()) == [5, 6] and two.current.count() == 7
    assert writers.append_unused(two.current, current, orders, customer, 10, s.T0).journal_rows.isEmpty()
    with pytest.raises(writers.WriteRefused):
        writers.append_unused(s.journal(spark, []), current, orders, customer, 2, s.T0)


def test_clones_have_consecutive_keys(spark):
    current = s.journal(spark, [s.journal_row(3), s.journal_row(8)])
    added = writers.clone_orders(current, current, 5, s.T0).journal_rows.collect()
    assert sorted(r["order_key"] for r in added) == [9, 10, 11, 12, 13]
    with pytest.raises(writers.WriteRefused):
        writers.clone_orders(s.journal(spark, []), current, 5, s.T0)


def test_cursor_bounds_reach_the_scan(spark, folder):
    s.journal(spark, [s.journal_row(k) for k in range(1, 9)]).write.parquet(f"{folder}/j")
    rows = spark.read.schema(schemas.JOURNAL).parquet(f"{folder}/j")
    part = cap.journal_range(rows, cap.Cursor.of(s.T0, 2), cap.Cursor.of(s.T0, 6))
    assert sorted(r["order_key"] for r in part.collect()) == [3, 4, 5, 6]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "Or(GreaterThan(source_updated_at" in plan and "LessThanOrEqual(order_key,6)" in plan


def test_bounded_read_refuses_expired_offsets(spark):
    wire = s.wire(spark, [(b"a", b"x")] * 3, start=5)
    with pytest.raises(ValueError):
        topic.read_bounded(wire, topic.topic_offsets(wire))
    fine = s.wire(spark, [(b"a", b"x")] * 3)
    ends = topic.topic_offsets(fine)
    topic.assert_unchanged(ends, fine)
    with pytest.raises(ValueError):
        topic.assert_unchanged(ends, s.wire(spark, [(b"a", b"x")] * 4))
