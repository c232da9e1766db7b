"""Checks: fingerprints, source-to-sink comparison, delivery reports, integrity rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import date_text, entity_key, json_string, money, utc_timestamp
from tidemark.schemas import PAYLOAD_FIELDS

LANES = 16


def _row_json(row: Mapping[str, Column]) -> Column:
    payload = row["payload"]
    return F.concat(
        F.lit('{"entity_key":"'), row["entity_key"],
        F.lit('","last_event_id":"'), row["last_event_id"],
        F.lit('","payload":{"customer_key":'), payload["customer_key"].cast("string"),
        F.lit(',"customer_name":'), json_string(payload["customer_name"]),
        F.lit(',"order_date":"'), date_text(payload["order_date"]),
        F.lit('","order_key":'), payload["order_key"].cast("string"),
        F.lit(',"order_status":"'), payload["order_status"],
        F.lit('","total_price":"'), money(payload["total_price"]),
        F.lit('"},"source":'), json_string(row["source"]),
        F.lit(',"source_updated_at":"'), utc_timestamp(row["source_updated_at"]),
        F.lit('","source_version":'), row["source_version"].cast("string"),
        F.lit(',"total_price":"'), money(row["total_price"]), F.lit('"}'),
    )


def state_fingerprint(current: DataFrame) -> DataFrame:
    """Number of entities and one digest of the business state (capture and processing times excluded).

    Each canonical row is hashed; the digest covers the lane-wise sums of the row hashes. Sums do not depend
    on the order of rows, so this is a plain partial aggregation: no sort, no collected list. Equal states give
    equal digests. A lane is 16 bits wide, so its sum fits a bigint beyond 10^14 entities.
    """
    columns = {name: F.col(name) for name in current.columns}
    hashed = current.select(F.sha2(_row_json(columns), 256).alias("h"))
    # Three lanes are read from the text at once: conversions take most of the time.
    groups = range(-(-LANES // 3))
    parts = hashed.select(*(F.conv(F.substring("h", 12 * g + 1, 4 * min(3, LANES - 3 * g)), 16, 10).cast("bigint").alias(f"g{g}") for g in groups))
    values = [
        F.shiftright(f"g{lane // 3}", 16 * (min(3, LANES - lane // 3 * 3) - 1 - lane % 3)).bitwiseAND(F.lit(0xFFFF)) for lane in range(LANES)
    ]
    lanes = [F.coalesce(F.sum(value), F.lit(0)).alias(f"s{lane}") for lane, value in enumerate(values)]
    sums = parts.agg(F.count(F.lit(1)).alias("entities"), *lanes)
    text = F.concat_ws(",", *[F.col(name).cast("string") for name in sums.columns])
    return sums.select("entities", F.sha2(text, 256).alias("sha256"))


def source_sink_diff(source_current: DataFrame, current: DataFrame) -> DataFrame:
    """Entities whose version or payload differ between source and sink, or that only one side has.

    Source rows with a negative price never become events and are left out. Both sides are unique per entity.
    """
    fields = [name for name in PAYLOAD_FIELDS]
    left = source_current.filter(F.col("total_price") >= 0).select(
        entity_key(F.col("order_key")).alias("entity_key"),
        F.col("source_version").alias("source_version_in_source"),
        *[F.col(name).alias(f"a_{name}") for name in fields],
    )
    right = current.select(
        "entity_key",
        F.col("source_version").alias("source_version_in_sink"),
        *[F.col(f"payload.{name}").alias(f"b_{name}") for name in fields],
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"a_{name}").eqNullSafe(F.col(f"b_{name}")) for name in fields],
        F.col("source_version_in_source").eqNullSafe(F.col("source_version_in_sink")),
    )
    status = (
        F.when(F.col("source_version_in_sink").isNull(), "missing_in_sink")
        .when(F.col("source_version_in_source").isNull(), "missing_in_source")
        .when(F.col("source_version_in_source") != F.col("source_version_in_sink"), "version")
        .otherwise("payload")
    )
    return (
        left.join(right, "entity_key", "full_outer")
        .filter(~same)
        .select("entity_key", "source_version_in_source", "source_version_in_sink", status.alias("difference"))
    )


def rejections_by_reason(ledger: DataFrame) -> DataFrame:
    return (
        ledger.filter(F.col("disposition") == "rejected")
        .groupBy("reason_code")
        .agg(F.count(F.lit(1)).alias("rejections"))
    )


def dispositions(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("disposition").agg(F.count(F.lit(1)).alias("deliveries"))


def delivery_report(ledger: DataFrame) -> DataFrame:
    """Per source: deliveries, distinct events, duplicates.

    First counted per (source, event), so that no task gathers the events of one big source.
    """
    per_event = (
        ledger.filter(F.col("source").isNotNull())
        .groupBy("source", "event_id")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.count_if(F.col("disposition") == "duplicate").alias("duplicates"),
        )
    )
    return per_event.groupBy("source").agg(
        F.sum("deliveries").alias("deliveries"),
        F.count(F.lit(1)).alias("unique_event_ids"),
        F.sum("duplicates").alias("duplicates"),
    )


def partitions_per_entity(ledger: DataFrame) -> DataFrame:
    """How many entities use how many topic partitions; more than one breaks the ordering per entity."""
    placed = ledger.filter(F.col("entity_key").isNotNull() & (F.col("reason_code").isNull()))
    per_entity = placed.groupBy("source", "entity_key", "partition_id").agg(F.lit(1).alias("_one"))
    return (
        per_entity.groupBy("source", "entity_key")
        .agg(F.count("_one").alias("partitions"))
        .groupBy("partitions")
        .agg(F.count(F.lit(1)).alias("entities"))
    )


def assert_one_partition(ledger: DataFrame) -> None:
    if not partitions_per_entity(ledger).filter("partitions > 1").isEmpty():
        raise ValueError("an entity was delivered through more than one partition")


def _violation(rule: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def unique(rule: str, table: DataFrame, *keys: str) -> DataFrame:
    return _violation(rule, table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))


def references(rule: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent. Child values are made distinct first: a hot value is one row."""
    values = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("_value")).distinct()
    return _violation(
        rule, values.join(parent.select(F.col(parent_column).alias("_value")), "_value", "left_anti")
    )


def holds(table: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Domain rules of one table in one pass. As in SQL, a check fails only where it is false; NULL passes."""
    counted = table.agg(*[F.count_if(~condition).alias(f"_{i}") for i, (_, condition) in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
            for i, (rule, _) in enumerate(rules)
        ]
    )
    return counted.select(F.inline(rows))


def check_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Count violations of each key, reference and domain rule of the tables that are given.

    Tables: event_deliveries, processed_events, orders_current, event_rejections, sync_runs, sync_batches,
    sync_state, source_entity_versions, source_quarantine.
    """
    found: list[DataFrame] = []

    def has(*names: str) -> bool:
        return all(name in tables for name in names)

    keys = {
        "event_deliveries": [("delivery_id",)],
        "processed_events": [("event_id",), ("source", "entity_key", "source_version")],
        "orders_current": [("source", "entity_key")],
        "event_rejections": [("delivery_id",)],
        "sync_runs": [("run_id",)],
        "sync_batches": [("batch_id",), ("run_id", "batch_sequence")],
        "sync_state": [("source",)],
        "source_entity_versions": [("source", "entity_key")],
        "source_quarantine": [("source", "source_updated_at", "order_key")],
    }
    for name, sets in keys.items():
        if has(name):
            found += [unique(f"unique {name}({', '.join(columns)})", tables[name], *columns) for columns in sets]

    links = [
        ("sync_batches", "run_id", "sync_runs", "run_id"),
        ("sync_state", "last_completed_batch_id", "sync_batches", "batch_id"),
        ("processed_events", "first_delivery_id", "event_deliveries", "delivery_id"),
        ("orders_current", "last_event_id", "processed_events", "event_id"),
        ("event_rejections", "delivery_id", "event_deliveries", "delivery_id"),
        ("source_quarantine", "batch_id", "sync_batches", "batch_id"),
    ]
    for child, column, parent, parent_column in links:
        if has(child, parent):
            found.append(
                references(f"reference {child}.{column}", tables[child], column, tables[parent], parent_column)
            )

    def paired(a: str, b: str) -> Column:
        return F.col(a).isNull() == F.col(b).isNull()

    domains = {
        "event_deliveries": [("disposition", F.col("disposition").isin("accepted", "duplicate", "stale", "rejected"))],
        "processed_events": [("source_version", F.col("source_version") > 0)],
        "orders_current": [
            ("source_version", F.col("source_version") > 0),
            ("total_price", F.col("total_price") >= 0),
        ],
        "source_entity_versions": [("source_version", F.col("source_version") > 0)],
        "sync_runs": [
            ("mode", F.col("mode").isin("initial", "incremental")),
            ("status", F.col("status").isin("running", "completed", "failed")),
            ("high_watermark_order_key", F.col("high_watermark_order_key") > 0),
        ],
        "sync_batches": [
            ("batch_sequence", F.col("batch_sequence") > 0),
            ("status", F.col("status").isin("running", "published", "failed")),
            ("to_order_key", F.col("to_order_key") > 0),
            ("records_seen", F.col("records_seen") >= 0),
            ("records_published", F.col("records_published") >= 0),
            ("from cursor paired", paired("from_updated_at", "from_order_key")),
        ],
        "sync_state": [
            ("last_order_key", F.col("last_order_key") > 0),
            ("last cursor paired", paired("last_updated_at", "last_order_key")),
        ],
    }
    for name, rules in domains.items():
        if has(name):
            found.append(holds(tables[name], [(f"check {name}.{rule}", condition) for rule, condition in rules]))

    if has("event_deliveries", "processed_events"):
        found.append(accounting(tables["event_deliveries"], tables["processed_events"]))
    return reduce(DataFrame.unionByName, found)


def accounting(ledger: DataFrame, processed: DataFrame) -> DataFrame:
    """deliveries = unique + duplicates + rejected, and unique = rows of the registry."""
    parts = ledger.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("disposition").isin("accepted", "stale")).alias("u"),
        F.count_if(F.col("disposition") == "duplicate").alias("d"),
        F.count_if(F.col("disposition") == "rejected").alias("r"),
        F.lit(0).alias("p"),
    )
    registry = processed.agg(
        *[F.lit(0).alias(name) for name in ("n", "u", "d", "r")], F.count(F.lit(1)).alias("p")
    )
    sums = parts.unionByName(registry).agg(*[F.sum(name).alias(name) for name in ("n", "u", "d", "r", "p")])
    broken = (F.col("n") != F.col("u") + F.col("d") + F.col("r")) | (F.col("u") != F.col("p"))
    return sums.select(F.lit("accounting identity").alias("rule"), broken.cast("bigint").alias("violations"))


def ledger_losses(before: DataFrame, after: DataFrame) -> DataFrame:
    """Deliveries of an earlier ledger that are missing or changed in a later one (append-only: none)."""

    def stamped(ledger: DataFrame) -> DataFrame:
        columns = sorted(name for name in ledger.columns if name != "delivery_id")
        return ledger.select("delivery_id", F.xxhash64(*columns).alias("_content"))

    return stamped(before).join(stamped(after), ["delivery_id", "_content"], "left_anti").select("delivery_id")


def set_difference(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
    """Values that the two sides do not have equally often, with both counts; equal sets give no row.

    One aggregation over both sides; copies are counted where they lie, so a hot value is harmless. NULLs are equal.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = left.select(*columns, one.alias("_l"), none.alias("_r")).unionAll(right.select(*columns, none, one))
    counts = sides.groupBy(*columns).agg(F.sum("_l").alias("in_left"), F.sum("_r").alias("in_right"))
    return counts.filter("in_left <> in_right")


def snapshot(current: DataFrame, ledger: DataFrame, quarantine: DataFrame, state: DataFrame) -> DataFrame:
    """The state as (measure, value) rows, all of them text: aggregates, and a checkpoint for each source."""
    finger = state_fingerprint(current).select(F.expr("stack(2, 'entities', string(entities), 'state', sha256) as (measure, value)"))
    by = dispositions(ledger).agg(
        F.coalesce(F.sum("deliveries"), F.lit(0)).alias("all"),
        F.coalesce(F.sum(F.when(F.col("disposition").isin("accepted", "stale"), F.col("deliveries"))), F.lit(0)).alias("unique"),
        F.coalesce(F.sum(F.when(F.col("disposition") == "rejected", F.col("deliveries"))), F.lit(0)).alias("refused"),
    )
    counts = by.select(F.expr("stack(3, 'deliveries', string(all), 'logical events', string(unique), 'rejections', string(refused)) as (measure, value)"))
    held = quarantine.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit("quarantine").alias("measure"), "value")
    cursor = F.concat_ws(" ", utc_timestamp(F.col("last_updated_at")), F.col("last_order_key").cast("string"), "last_completed_batch_id")
    points = state.select(F.concat(F.lit("checkpoint of "), F.col("source")).alias("measure"), cursor.alias("value"))
    return reduce(DataFrame.unionByName, [finger, counts, held, points])
