"""The named queries: each operator applied to the test tables, ending in plain comparable columns.

Times become ISO text and money two-decimal text, so that engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import content_hash, date_text, money, utc_timestamp
from tidemark.functions.validation import validate
from tidemark.operators import capture as cap
from tidemark.operators import checks, inspect, views, writers
from tidemark.operators.classify import classify
from tidemark.operators.numbering import stage_sorted
from tidemark.plans import fixture
from tidemark.plans.fixture import RUN, SOURCE, T0, processed_at
from tidemark.plans.pipeline import Pipeline
from tidemark.session import scratch_folder
from tidemark.sources import wire as topic
from tidemark.streaming.ingest import run_capture, run_topic_stream

Query = Callable[[SparkSession, str], DataFrame]

MUTATED = T0 + timedelta(days=1)
LATER = T0 + timedelta(days=2)
TODAY = date(2026, 1, 3)
CLONES = 5

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _journal_text(rows: DataFrame) -> DataFrame:
    return rows.select(
        "order_key", "customer_key", "customer_name", "order_status",
        money(F.col("total_price")).alias("total_price"),
        date_text(F.col("order_date")).alias("order_date"),
        "source_version",
        utc_timestamp(F.col("source_updated_at")).alias("source_updated_at"),
        "event_type",
    )


# --- Source-side writers ------------------------------------------------------------------------------------


@query
def load_seed(spark: SparkSession, sf: str) -> DataFrame:
    """Scan and join of the sample tables, per order status."""
    rows = fixture.seeded(spark, sf).current
    return rows.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("order_key").alias("first_key"),
        F.max("order_key").alias("last_key"),
        money(F.sum("total_price")).alias("total_price"),
    )


@query
def seed_source(spark: SparkSession, sf: str) -> DataFrame:
    """A first import of the lower half of the sample, by key."""
    orders, customer = fixture.sample_tables(spark, sf)
    half = writers.sample(orders, customer).count() // 2
    return _journal_text(writers.seed_source(orders, customer, half, T0).current)


@query
def append_unused(spark: SparkSession, sf: str) -> DataFrame:
    """A source that holds every third order; the lower half of the unused ones is appended."""
    orders, customer = fixture.sample_tables(spark, sf)
    held = writers.seed_source(orders.filter("o_orderkey % 3 = 0"), customer, None, T0)
    half = writers.sample(orders, customer).filter("order_key % 3 <> 0").count() // 2
    return _journal_text(writers.append_unused(held.current, held.journal_rows, orders, customer, half, T0).journal_rows)


@query
def mutate_source(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot after one mutation of the whole source."""
    held = fixture.seeded(spark, sf)
    return _journal_text(writers.mutate_source(held.current, held.journal_rows, MUTATED).current)


@query
def mutate_journal(spark: SparkSession, sf: str) -> DataFrame:
    """The journal rows of that mutation: one insert and four updates."""
    held = fixture.seeded(spark, sf)
    return _journal_text(writers.mutate_source(held.current, held.journal_rows, MUTATED).journal_rows)


@query
def clone_orders(spark: SparkSession, sf: str) -> DataFrame:
    held = fixture.seeded(spark, sf)
    return _journal_text(
        writers.clone_orders(held.current, held.journal_rows, CLONES, MUTATED, TODAY).journal_rows
    )


@query
def next_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """The writer clock when the wall clock lags behind the journal."""
    rows = fixture.journal(spark, sf)
    stamp = writers.next_stamp(rows, T0)
    return rows.agg(
        F.count(F.lit(1)).alias("journal_rows"),
        utc_timestamp(F.max("source_updated_at")).alias("journal_high"),
    ).withColumn("next_stamp", utc_timestamp(F.lit(stamp)))


# --- Capture --------------------------------------------------------------------------------------------------


@query
def change_journal(spark: SparkSession, sf: str) -> DataFrame:
    return _journal_text(fixture.journal(spark, sf))


@query
def high_watermark(spark: SparkSession, sf: str) -> DataFrame:
    row = cap.high_watermark_row(fixture.journal(spark, sf))
    return row.select(utc_timestamp(F.col("source_updated_at")).alias("source_updated_at"), "order_key")


def _middle(rows: DataFrame) -> cap.Cursor:
    """A cursor inside the first timestamp: half of the largest key."""
    high = cap.high_watermark(rows)
    return cap.Cursor.of(T0, max(high.order_key // 2, 1))


@query
def journal_page(spark: SparkSession, sf: str) -> DataFrame:
    """One page of 500 after a cursor in the middle of a shared timestamp."""
    rows = fixture.journal(spark, sf)
    return _journal_text(cap.journal_page(rows, _middle(rows), cap.high_watermark(rows), cap.BATCH_SIZE))


@query
def journal_after_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """Everything after that cursor and up to a frozen high watermark inside the second timestamp."""
    rows = fixture.journal(spark, sf)
    middle = _middle(rows)
    high = cap.Cursor.of(T0 + timedelta(microseconds=1), middle.order_key)
    part = cap.journal_range(rows, middle, high)
    return part.groupBy("source_version").agg(
        F.count(F.lit(1)).alias("journal_rows"),
        F.min("order_key").alias("first_key"),
        F.max("order_key").alias("last_key"),
    )


@query
def cursor_multiplicity(spark: SparkSession, sf: str) -> DataFrame:
    """How often each cursor occurs; here two appends used the same stamp, which capture must refuse."""
    rows = fixture.journal(spark, sf)
    again = rows.filter("order_key % 50 = 0 and source_version = 1")
    counts = cap.cursor_multiplicity(rows.unionByName(again))
    return counts.groupBy("multiplicity").agg(F.count(F.lit(1)).alias("cursors"))


@query
def duplicate_cursors(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture.journal(spark, sf)
    again = rows.filter("order_key % 50 = 0 and source_version = 1")
    return cap.duplicate_cursors(rows.unionByName(again)).select(
        utc_timestamp(F.col("source_updated_at")).alias("source_updated_at"), "order_key", "multiplicity"
    )


def _captured(spark: SparkSession, sf: str) -> cap.Capture:
    rows = fixture.journal(spark, sf)
    return cap.capture(rows, None, cap.high_watermark(rows), SOURCE, RUN, fixture.CAPTURED)


@query
def plan_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One row per page: cursor range, rows seen and published."""
    return _captured(spark, sf).batches.select(
        "batch_id", "run_id", "source", "batch_sequence",
        utc_timestamp(F.col("from_updated_at")).alias("from_updated_at"), "from_order_key",
        utc_timestamp(F.col("to_updated_at")).alias("to_updated_at"), "to_order_key",
        "records_seen", "records_published",
    )


@query
def sync_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows seen, published and pages of a run."""
    return _captured(spark, sf).batches.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("records_seen").alias("records_seen"),
        F.sum("records_published").alias("records_published"),
    )


@query
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _captured(spark, sf).quarantine.select(
        "batch_id", "source", utc_timestamp(F.col("source_updated_at")).alias("source_updated_at"),
        "order_key", "raw_record", "reason",
    )


@query
def captured_events(spark: SparkSession, sf: str) -> DataFrame:
    """Number, page, identity and content hash of every captured event."""
    return _captured(spark, sf).events.select(
        "number", "batch_sequence", "envelope.entity_key", "source_version", "envelope.event_id",
        content_hash(F.col("envelope")).alias("content_hash"),
    )


@query
def event_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture.journal(spark, sf).withColumn("batch_sequence", F.lit(1))
    return cap.valid_events(cap.build_events(rows, SOURCE, RUN, fixture.CAPTURED)).select(
        "envelope.entity_key", "source_version", "envelope.event_id"
    )


@query
def entity_versions(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture.journal(spark, sf).withColumn("batch_sequence", F.lit(1))
    events = cap.valid_events(cap.build_events(rows, SOURCE, RUN, fixture.CAPTURED)).select(
        "source", "envelope.entity_key", "source_version", "source_updated_at"
    )
    return cap.entity_versions(events).withColumn("source_updated_at", utc_timestamp(F.col("source_updated_at")))


# --- Topic ------------------------------------------------------------------------------------------------------


@query
def wire_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every message: place on the topic, key, and the digest of its bytes."""
    return fixture.wire(spark, sf).select(
        "partition", "offset", F.col("key").cast("string").alias("message_key"),
        F.sha2("value", 256).alias("value_sha256"),
    )


@query
def partition_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return topic.topic_offsets(fixture.wire(spark, sf))


@query
def bounded_read(spark: SparkSession, sf: str) -> DataFrame:
    """Read up to end offsets that were captured earlier (here: when half of the topic was there)."""
    rows = fixture.wire(spark, sf)
    ends = topic.topic_offsets(rows).withColumn("high", F.floor(F.col("high") / 2))
    return topic.read_bounded(rows, ends).groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), F.max("offset").alias("last_offset")
    )


# --- Classification ---------------------------------------------------------------------------------------------


def _decisions(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        "delivery_id", "partition_id", "broker_offset", "event_id", "entity_key", "event_type",
        "source_version", "content_hash", "disposition", "reason_code",
    )


@query
def validate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries per reason as validation alone sees them (no conflict yet)."""
    return validate(fixture.wire(spark, sf)).groupBy("reason_code").agg(F.count(F.lit(1)).alias("deliveries"))


@query
def error_details(spark: SparkSession, sf: str) -> DataFrame:
    """Location and rule of every validation error, exploded."""
    errors = validate(fixture.wire(spark, sf)).select("reason_code", F.explode("details").alias("error"))
    return errors.groupBy(
        "reason_code", F.array_join("error.loc", ".").alias("loc"), F.col("error.type").alias("rule")
    ).agg(F.count(F.lit(1)).alias("deliveries"))


@query
def classify_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return _decisions(fixture.ledger(spark, sf))


@query
def classify_hot_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The same result when every entity with more than two deliveries counts as hot."""
    return _decisions(classify(fixture.wire(spark, sf), processed_at(), hot_rows=2))


def _sink_clock() -> datetime:
    return T0 + timedelta(seconds=10)


def _stored_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger as committed files, for queries that read it more than once."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.materialize(fixture.wire(spark, sf), "all")
    return pipeline.ledger()


@query
def classify_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Five committed batches, split by offset; each is decided against those before it, bucket by bucket."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.deliver(fixture.wire(spark, sf))
    rows = pipeline.wire()
    ends = F.broadcast(topic.topic_offsets(rows).select("topic", "partition", F.col("high").alias("_high")))
    fifth = F.floor(F.col("offset") * 5 / F.col("_high"))
    for part in range(5):
        pipeline.materialize(rows.join(ends, ["topic", "partition"]).filter(fifth == part).drop("_high"), f"part-{part}")
    return _decisions(pipeline.ledger()).drop("delivery_id")


@query
def compacted_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches written as one, and a third decided against them: deliveries per disposition, and what is current."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    rows = fixture.wire(spark, sf)
    pipeline.deliver(rows)
    half = F.col("offset") % 2
    pipeline.materialize(pipeline.wire().filter(half == 0), "even")
    pipeline.materialize(pipeline.wire().filter(half == 1), "odd")
    pipeline.compact()
    pipeline.materialize(pipeline.wire(), "again")
    current = pipeline.orders_current().agg(
        F.lit("current entities").alias("measure"), F.count(F.lit(1)).alias("value")
    ).unionByName(pipeline.orders_current().agg(F.lit("current versions").alias("measure"), F.sum("source_version").alias("value")))
    counts = pipeline.ledger().agg(F.lit("deliveries").alias("measure"), F.count(F.lit(1)).alias("value"))
    unique = pipeline.processed_events().agg(F.lit("unique events").alias("measure"), F.count(F.lit(1)).alias("value"))
    return counts.unionByName(unique).unionByName(current)


@query
def stream_classify(spark: SparkSession, sf: str) -> DataFrame:
    """The topic as a stream into the ledger: its files appear last offsets first, and messages wait for their turn."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    rows = fixture.wire(spark, sf).repartitionByRange(6, F.col("offset").desc()).sortWithinPartitions("partition", "offset")
    rows.write.parquet(pipeline.wire_path)
    run_topic_stream(pipeline, f"{pipeline.root}/checkpoint", "ingest", available_now=True, max_files=2).awaitTermination()
    return _decisions(pipeline.ledger()).drop("delivery_id")


@query
def poll_capture(spark: SparkSession, sf: str) -> DataFrame:
    """The journal polled twice, with the updates of all orders arriving in between: one run for each tick."""
    root = scratch_folder(spark)
    ticks = iter(range(1, 1_000_000))
    pipeline = Pipeline(spark, root, clock=lambda: T0 + timedelta(seconds=next(ticks)))
    rows, path = fixture.journal(spark, sf), f"{root}/journal"
    for version in (F.col("source_version") == 1, F.col("source_version") > 1):
        rows.filter(version).write.mode("append").parquet(path)
        run_capture(pipeline, path, SOURCE, f"{root}/polls", "poll", available_now=True).awaitTermination()
    runs = _numbered_runs(pipeline).select("run", "run_id", "mode", "status", "high_watermark_order_key")
    pages = pipeline.batches().groupBy("run_id").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("records_seen").alias("records_seen"), F.sum("records_published").alias("records_published")
    )
    return runs.join(pages, "run_id").drop("run_id")


@query
def sync_to_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain on durable tables: sync the journal, consume the topic, read the state."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.sync(fixture.journal(spark, sf), SOURCE)
    pipeline.materialize(pipeline.wire(), "all")
    return _current_text(pipeline.orders_current())


# --- Views ----------------------------------------------------------------------------------------------------------


@query
def processed_events(spark: SparkSession, sf: str) -> DataFrame:
    return views.processed_events(fixture.ledger(spark, sf)).select(
        "event_id", "source", "entity_key", "source_version", "content_hash", "first_delivery_id"
    )


def _current_text(current: DataFrame) -> DataFrame:
    return current.select(
        "source", "entity_key", "source_version",
        utc_timestamp(F.col("source_updated_at")).alias("source_updated_at"),
        F.col("payload.customer_key").alias("customer_key"),
        F.col("payload.customer_name").alias("customer_name"),
        F.col("payload.order_status").alias("order_status"),
        date_text(F.col("payload.order_date")).alias("order_date"),
        money(F.col("total_price")).alias("total_price"),
        "last_event_id",
    )


@query
def orders_current(spark: SparkSession, sf: str) -> DataFrame:
    return _current_text(views.orders_current(fixture.ledger(spark, sf)))


@query
def event_rejections(spark: SparkSession, sf: str) -> DataFrame:
    return views.rejections(fixture.ledger(spark, sf)).select("delivery_id", "topic", "source", "reason_code")


@query
def rejections_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    return checks.rejections_by_reason(fixture.ledger(spark, sf))


@query
def deliveries_by_disposition(spark: SparkSession, sf: str) -> DataFrame:
    return checks.dispositions(fixture.ledger(spark, sf))


# --- Inspection -------------------------------------------------------------------------------------------------------


@query
def counts_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return inspect.counts_by_type(fixture.ledger(spark, sf))


@query
def counts_total(spark: SparkSession, sf: str) -> DataFrame:
    """Totals and groups in one pass."""
    return inspect.counts_with_total(fixture.ledger(spark, sf))


@query
def processing_delay(spark: SparkSession, sf: str) -> DataFrame:
    delay = inspect.processing_delay(fixture.ledger(spark, sf))
    return delay.select(
        "sample_count", *[F.round(name, 6).alias(name) for name in ("avg_seconds", "min_seconds", "max_seconds")]
    )


def _page_text(spark: SparkSession, rows: list[Row]) -> DataFrame:
    types = {column.split()[0]: column for column in schemas.columns(schemas.LEDGER)}
    shown = spark.createDataFrame(rows, ", ".join(types[name] for name in inspect.PAGE_COLUMNS))
    return shown.select(
        "delivery_id", "event_id", "source", "entity_key", "event_type",
        utc_timestamp(F.col("occurred_at")).alias("occurred_at"),
        utc_timestamp(F.col("captured_at")).alias("captured_at"),
        utc_timestamp(F.col("processed_at")).alias("processed_at"),
        "topic", "partition_id", "broker_offset", "disposition", "reason_code",
        utc_timestamp(F.col("envelope.captured_at")).alias("envelope_captured_at"),
        money(F.col("envelope.payload.total_price")).alias("envelope_total_price"),
    )


@query
def events_page(spark: SparkSession, sf: str) -> DataFrame:
    """The second page of 500 inserts in a time range (501 rows: the last tells that more follow)."""
    rows = inspect.event_rows(
        fixture.ledger(spark, sf), inspect.MAX_LIMIT + 1, source=SOURCE, event_type="insert",
        since=T0, until=T0 + timedelta(microseconds=1), after_id=inspect.MAX_LIMIT,
    )
    return _page_text(spark, rows)


@query
def entity_history(spark: SparkSession, sf: str) -> DataFrame:
    """All deliveries of one entity that saw every outcome of a valid message."""
    rows = inspect.event_rows(
        fixture.ledger(spark, sf), inspect.MAX_LIMIT + 1, entity_key="order:1155", source=SOURCE
    )
    return _page_text(spark, rows)


def _thirds(spark: SparkSession, sf: str) -> Pipeline:
    """The topic in three batches of ascending offsets."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.deliver(fixture.wire(spark, sf))
    ends = F.broadcast(topic.topic_offsets(pipeline.wire()).select("topic", "partition", F.col("high").alias("_high")))
    for part in range(3):
        third = F.floor(F.col("offset") * 3 / F.col("_high")) == part
        pipeline.materialize(pipeline.wire().join(ends, ["topic", "partition"]).filter(third).drop("_high"), f"part-{part}")
    return pipeline


@query
def entity_view(spark: SparkSession, sf: str) -> DataFrame:
    """One entity as stored in three batches: its current row, and its deliveries in pages of two with where the next begins."""
    pipeline, rows, page, after = _thirds(spark, sf), [], 0, 0
    while after is not None:
        view = pipeline.entity_view("order:1155", SOURCE, after_id=after, limit=2)
        page += 1
        after = view.next_after_id
        for place, row in enumerate(view.history, 1):
            version = None if row["envelope"] is None else row["envelope"]["source_version"]
            rows.append((page, place, row["disposition"], version, after is not None, view.current["source_version"], view.current["last_event_id"]))
    return spark.createDataFrame(
        rows, "page int, place int, disposition string, envelope_version bigint, more boolean, current_version bigint, current_event_id string"
    )


@query
def events_after(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of 500 updates over three batches, as the search for the next id finds them: (page, rows, first and last place)."""
    pipeline, rows, page, after = _thirds(spark, sf), [], 0, 0
    while after is not None and page < 4:
        found = pipeline.events_page(500, after, event_type="update", source_prefix="shop.")
        page += 1
        after = found.next_after_id
        keys = [int(row["entity_key"].split(":")[1]) for row in found.items]
        rows.append((page, len(keys), sum(keys), after is not None))
    return spark.createDataFrame(rows, "page int, deliveries int, sum_of_keys bigint, more boolean")


def _sync_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """One source per order status: O and F synced completely, P still running its only run."""
    rows = fixture.journal(spark, sf)
    source = F.concat(F.lit("shop."), F.col("order_status"))
    pages = cap.plan_pages(rows).withColumn("source", source)
    per_page = (
        cap.build_events(pages, source, RUN, fixture.CAPTURED)
        .filter("order_status <> 'P'")
        .groupBy("source", "batch_id", "batch_sequence")
        .agg(F.max(F.struct(*cap.CURSOR)).alias("c"))
    )
    batches = per_page.select(
        "source", "batch_id", "batch_sequence", F.lit("published").alias("status"),
        F.col("c.source_updated_at").alias("to_updated_at"), F.col("c.order_key").alias("to_order_key"),
        F.timestamp_micros(F.lit(fixture.micros(LATER)) + F.col("batch_sequence")).alias("finished_at"),
    )
    runs = (
        rows.withColumn("source", source)
        .groupBy("source")
        .agg(F.max(F.struct(*cap.CURSOR)).alias("c"), F.count(F.lit(1)).alias("n"))
        .select(
            "source",
            F.when(F.col("source") == "shop.P", "running").otherwise("completed").alias("status"),
            F.when(
                F.col("source") != "shop.P", F.timestamp_micros(F.lit(fixture.micros(LATER)) + F.col("n"))
            ).alias("finished_at"),
        )
    )
    return runs, batches


@query
def watermarks(spark: SparkSession, sf: str) -> DataFrame:
    runs, batches = _sync_tables(spark, sf)
    marks = inspect.watermarks(inspect.sync_state(batches), runs, batches)
    times = ("last_updated_at", "checkpoint_persisted_at", "batch_completed_at", "last_sync_completed_at")
    return marks.select(
        "source", "last_order_key", "last_completed_batch_id",
        *[utc_timestamp(F.col(name)).alias(name) for name in times],
    )


# --- Checks -------------------------------------------------------------------------------------------------------------


@query
def source_sink_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Source after one more mutation than the sink has seen, and quarantined orders missing in the sink."""
    source = fixture.source_current(spark, sf)
    mutated = writers.mutate_source(source, fixture.journal(spark, sf), MUTATED).current
    return checks.source_sink_diff(mutated, views.orders_current(fixture.ledger(spark, sf)))


@query
def delivery_report(spark: SparkSession, sf: str) -> DataFrame:
    return checks.delivery_report(fixture.ledger(spark, sf))


@query
def partitions_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    return checks.partitions_per_entity(fixture.ledger(spark, sf))


@query
def replay_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Everything delivered twice: the second time nothing new may be accepted."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.deliver(fixture.wire(spark, sf))
    pipeline.materialize(pipeline.wire(), "original")
    proof = pipeline.replay("again").filter(~F.col("holds"))
    if not proof.isEmpty():
        raise RuntimeError("a replay changed the state")
    return checks.dispositions(pipeline.ledger())


@query
def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Every integrity rule of the sink tables, over the whole (stored) ledger."""
    ledger = _stored_ledger(spark, sf)
    return checks.check_constraints(
        {
            "event_deliveries": ledger,
            "processed_events": views.processed_events(ledger),
            "orders_current": views.orders_current(ledger),
            "event_rejections": views.rejections(ledger),
        }
    )


@query
def capture_constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of the capture-side tables, on a journal that was captured page by page."""
    captured = _captured(spark, sf)
    batches = captured.batches.withColumn("status", F.lit("published"))
    versions = cap.entity_versions(
        captured.events.select("source", "envelope.entity_key", "source_version", "source_updated_at")
    )
    return checks.check_constraints(
        {"sync_batches": batches, "source_entity_versions": versions, "source_quarantine": captured.quarantine}
    )


# Which orders break which rule: every so manieth key. A table's rows with keys of its first number occur twice.
PLANTED = {
    "event_deliveries": (50, {"disposition": 41}),
    "processed_events": (51, {"source_version": 42, "first_delivery_id": 61}),
    "orders_current": (52, {"source_version": 43, "total_price": 44, "last_event_id": 62}),
    "event_rejections": (53, {"delivery_id": 63}),
    "sync_runs": (54, {"mode": 45, "status": 46, "high_watermark_order_key": 47}),
    "sync_batches": (55, {
        "batch_sequence": 48, "status": 49, "to_order_key": 71, "records_seen": 72, "records_published": 73,
        "from_order_key": 74, "run_id": 64,
    }),
    "sync_state": (56, {"last_order_key": 75, "last_updated_at": 76, "last_completed_batch_id": 65}),
    "source_entity_versions": (57, {"source_version": 77}),
    "source_quarantine": (58, {"batch_id": 66}),
}


@query
def planted_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Every integrity rule of all nine tables, on tables in which some orders break it."""
    k = F.col("k")
    rows = fixture.sample_tables(spark, sf)[0].select(F.col("o_orderkey").alias("k"))
    text, zero, none = k.cast("string"), F.lit(0).cast("bigint"), F.concat(F.lit("none "), k.cast("string"))
    at = F.lit(T0).cast("timestamp")
    right = {
        "event_deliveries": {"delivery_id": text, "disposition": F.lit("accepted")},
        "processed_events": {"event_id": text, "source": F.lit("s"), "entity_key": text, "source_version": k, "first_delivery_id": text},
        "orders_current": {"source": F.lit("s"), "entity_key": text, "source_version": k, "total_price": k, "last_event_id": text},
        "event_rejections": {"delivery_id": text},
        "sync_runs": {"run_id": text, "mode": F.lit("initial"), "status": F.lit("completed"), "high_watermark_order_key": k},
        "sync_batches": {
            "batch_id": text, "run_id": text, "batch_sequence": k, "status": F.lit("published"), "to_order_key": k,
            "records_seen": k, "records_published": k, "from_updated_at": at, "from_order_key": k,
        },
        "sync_state": {"source": text, "last_order_key": k, "last_updated_at": at, "last_completed_batch_id": text},
        "source_entity_versions": {"source": F.lit("s"), "entity_key": text, "source_version": k},
        "source_quarantine": {"source": F.lit("s"), "source_updated_at": at, "order_key": k, "batch_id": text},
    }
    wrong = {
        "disposition": F.lit("odd"), "mode": F.lit("odd"), "status": F.lit("odd"), "source_version": zero,
        "batch_sequence": zero, "to_order_key": zero, "high_watermark_order_key": zero, "total_price": zero - 1,
        "records_seen": zero - 1, "records_published": zero - 1, "last_order_key": zero,
        "from_order_key": F.lit(None).cast("bigint"), "last_updated_at": F.lit(None).cast("timestamp"),
    }
    tables = {}
    for name, columns in right.items():
        twice, broken = PLANTED[name]
        values = [
            (F.when(k % broken[c] == 0, wrong.get(c, none)).otherwise(value) if c in broken else value).alias(c) for c, value in columns.items()
        ]
        tables[name] = rows.unionAll(rows.filter(k % twice == 0)).select(*values)
    # A child that refers to nothing in one table is still a key of its own there.
    return checks.check_constraints(tables)


@query
def ledger_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Append-only check against a later ledger that lost some rows and had others changed."""
    before = _decisions(fixture.ledger(spark, sf))
    after = before.filter("delivery_id % 1000 <> 0").withColumn(
        "disposition", F.when(F.col("delivery_id") % 777 == 0, "accepted?").otherwise(F.col("disposition"))
    )
    return checks.ledger_losses(before, after)


@query
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Captured events against processed ones, of which some were lost and some are there twice."""
    rows = fixture.journal(spark, sf).withColumn("batch_sequence", F.lit(1))
    events = cap.valid_events(cap.build_events(rows, SOURCE, RUN, fixture.CAPTURED)).select("envelope.event_id", "order_key")
    kept = events.filter("order_key % 97 <> 0")
    sink = kept.unionAll(kept.filter("order_key % 89 = 0"))
    return checks.set_difference(events, sink, "event_id")


@query
def order_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Every captured row against the one before it, after some keys were changed behind the sort's back."""
    rows = fixture.journal(spark, sf)
    staged = stage_sorted(rows, cap.CURSOR, f"{scratch_folder(spark)}/staged")
    k = F.col("order_key")
    planted = F.when(k % 101 == 0, k - 3).when(k % 103 == 0, k - 1).when(k % 997 == 0, -k).otherwise(k)
    high = cap.high_watermark(rows)
    faults = cap.order_faults(staged.withColumn("order_key", planted), cap.Cursor.of(T0, 5), high)
    return faults.withColumn("unsafe_at", utc_timestamp(F.col("unsafe_at")))


@query
def contract_rules(spark: SparkSession, sf: str) -> DataFrame:
    """One bad message per order, each breaking one rule of the contract: what validation says, and how often."""
    return fixture.rule_outcomes(spark, sf)


@query
def state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The measures of a synced and materialized pipeline, before and after a replay of its topic."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.sync(fixture.journal(spark, sf), SOURCE)
    pipeline.materialize(pipeline.wire(), "all")
    proof = pipeline.replay("once").filter(~F.col("measure").startswith("checkpoint") & (F.col("measure") != "state"))
    return proof.select("measure", "before", "after", "holds")


@query
def state_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return checks.state_fingerprint(views.orders_current(fixture.ledger(spark, sf)))


@query
def table_census(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the sink tables."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.materialize(fixture.wire(spark, sf), "all")
    return pipeline.census().select("table_name", "row_count")


@query
def stats(spark: SparkSession, sf: str) -> DataFrame:
    """All statistics of a pipeline that captured the journal and classified it once, as (measure, value)."""
    pipeline = Pipeline(spark, scratch_folder(spark), clock=_sink_clock)
    pipeline.sync(fixture.journal(spark, sf), fixture.SOURCE)
    pipeline.materialize(pipeline.wire(), "first")
    found = pipeline.stats()

    def listed(rows: DataFrame, prefix: Column, names: list[str]) -> DataFrame:
        pairs = F.array(*(F.struct(F.concat(prefix, F.lit(name)).alias("measure"), F.col(name).cast("bigint").alias("value")) for name in names))
        return rows.select(F.inline(pairs))

    return (
        listed(found.counts, F.lit(""), list(inspect.COUNTS))
        .unionByName(listed(found.counts_by_type, F.concat("event_type", F.lit(" ")), list(inspect.COUNTS)))
        .unionByName(listed(found.adapter_rejected_records, F.lit(""), ["adapter_rejected_records"]))
        .unionByName(listed(found.processing_delay, F.lit(""), ["sample_count"]))
        .unionByName(listed(found.watermarks, F.concat("source", F.lit(" ")), ["last_order_key"]))
    )


class _Killed(BaseException):
    """Ends a worker without giving it the chance to report."""


def _three_runs(spark: SparkSession, sf: str) -> Pipeline:
    """A pipeline whose first run fails, whose second is killed and whose third completes; four pages in all."""
    ticks = iter(range(1, 1_000_000))
    pipeline = Pipeline(spark, scratch_folder(spark), clock=lambda: T0 + timedelta(seconds=next(ticks)))
    rows = fixture.journal(spark, sf)
    page = (rows.count() + 3) // 4

    def ending(error: BaseException | None):
        calls = []

        def publish(events: DataFrame) -> None:
            calls.append(events)
            if error is not None and len(calls) == 2:
                raise error

        return publish

    for error in (RuntimeError("the broker does not answer"), _Killed(), None):
        try:
            pipeline.sync(rows, fixture.SOURCE, batch_size=page, publish=ending(error))
        except (RuntimeError, _Killed) as stopped:
            if stopped is not error:
                raise
    return pipeline


def _numbered_runs(pipeline: Pipeline) -> DataFrame:
    """Runs of one source with their number; three rows."""
    return pipeline.runs().withColumn("run", F.row_number().over(W.partitionBy("source").orderBy("started_at")))


@query
def sync_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _numbered_runs(_three_runs(spark, sf)).select("run", "mode", "status", "high_watermark_order_key")


@query
def sync_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of a failed, a killed and a completed run, as the pipeline recorded them."""
    pipeline = _three_runs(spark, sf)
    runs = _numbered_runs(pipeline).select("run_id", "run")
    return pipeline.batches().join(runs, "run_id").select(
        "run",
        F.col("batch_sequence").cast("int").alias("batch_sequence"),
        "status",
        "error_code",
        F.col("records_seen").cast("bigint").alias("records_seen"),
        F.col("records_published").cast("bigint").alias("records_published"),
        "to_order_key",
    )
