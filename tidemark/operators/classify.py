"""Classification of deliveries: accepted, stale, duplicate or rejected.

The sequential rule ("look at what came before this delivery") becomes two windows over rows that share an
entity, ordered by receipt. What happened before this batch enters the same windows as a few *past* rows, so
the wide rows are shuffled exactly once.

Skew. An entity with more than ``hot_rows`` deliveries is cut into slots of ``hot_rows`` consecutive receipt
ids. Each slot is its own window group; what earlier slots say about it is computed from pre-aggregated rows
(one per event and slot) and enters as past rows too. No window group ever holds more than about twice
``hot_rows`` rows, whatever the skew. Messages that did not validate take no part and stay spread out.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.expressions import key_bytes
from tidemark.functions.validation import SOURCE_VERSION_CONFLICT, validate
from tidemark.sources.store import stored

HOT_ROWS = 1_000_000
MOST_SENT = 10_000  # keys
ENTITY = ("source", "entity_key")
EVENT = (*ENTITY, "source_version")
DISPOSITIONS = ("accepted", "stale", "duplicate", "rejected")


class Span(NamedTuple):
    """Offsets of a batch in one partition: ``low`` to ``high`` inclusive."""

    topic: str
    partition: int
    low: int
    high: int
    count: int


class Received(NamedTuple):
    """A batch of deliveries with receipt ids, and how many ids it spans."""

    rows: DataFrame
    count: int
    next_delivery_id: int
    spans: tuple[Span, ...]


class Misplaced(ValueError):
    """A message lies in another partition than its key's."""


def receive(wire: DataFrame, first_delivery_id: int = 1, misplaced: Column | None = None) -> Received:
    """Assign increasing receipt ids in the order of (topic, partition, offset).

    An id is the offset moved by a constant per partition: no sort and no shuffle. Gaps in the offsets leave
    gaps in the ids, which is allowed. The driver holds one row per topic partition. Rows for which ``misplaced`` is true
    stop the batch; they are counted in the same pass.
    """
    wrong = F.count_if(F.coalesce(misplaced, F.lit(False))) if misplaced is not None else F.lit(0)
    found = (
        wire.groupBy("topic", "partition")
        .agg(F.min("offset"), F.max("offset"), F.count(F.lit(1)), wrong)
        .collect()
    )
    if any(row[5] for row in found):
        raise Misplaced(f"{sum(row[5] for row in found)} messages lie in another partition than their key's")
    spans = tuple(sorted(Span(*row[:5]) for row in found))
    shifts, next_id = [], first_delivery_id
    for span in spans:
        shifts.append((span.topic, span.partition, next_id - span.low))
        next_id += span.high - span.low + 1
    table = wire.sparkSession.createDataFrame(shifts, "topic string, partition int, _shift bigint")
    rows = (
        wire.join(F.broadcast(table), ["topic", "partition"])
        .withColumn("delivery_id", F.col("offset") + F.col("_shift"))
        .drop("_shift")
    )
    return Received(rows, sum(span.count for span in spans), next_id, spans)


def hot_keys(wire: DataFrame, hot_rows: int) -> DataFrame:
    """Message keys with more than ``hot_rows`` deliveries: at most ``rows / hot_rows`` of them.

    Reads the key column only. A valid message's key determines its entity.
    """
    return (
        wire.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .filter(F.col("_copies") > hot_rows)
        .select("key")
    )


def _known(rows: DataFrame) -> DataFrame:
    """Slim view of the valid deliveries. Their keys are their entity keys."""
    key = key_bytes(F.col("entity_key")).alias("key")
    return rows.filter(F.col("reason_code").isNull()).select("delivery_id", key, *EVENT, "content_hash")


def _registry_past(known: DataFrame, registry: DataFrame) -> DataFrame:
    """What the registry knows about the events and entities of this batch.

    One row per event that occurs again, and one per entity with its current (highest) version.
    """
    seen = registry.join(known.select(*EVENT).distinct(), list(EVENT), "left_semi").select(*EVENT, "content_hash")
    # Aggregated first: an entity of very many versions sends one row per task. ``registry`` holds the batch's buckets only.
    current = (
        registry.groupBy(*ENTITY)
        .agg(F.max("source_version").alias("source_version"))
        .join(known.select(*ENTITY).distinct(), list(ENTITY), "left_semi")
        .withColumn("content_hash", F.lit(None).cast(known.schema["content_hash"].dataType))
    )
    return seen.unionByName(current)


def _slot_past(known: DataFrame, past: DataFrame | None, hot_rows: int) -> DataFrame:
    """For each slot of a hot entity: first hashes and the highest version from before the slot."""
    first = F.min(F.struct("delivery_id", "content_hash")).alias("_first")
    events = (
        known.withColumn("slot", F.floor(F.col("delivery_id") / hot_rows)).groupBy(*EVENT, "slot").agg(first)
    )
    if past is not None:
        before = past.select(
            *EVENT,
            F.lit(-1).cast("bigint").alias("slot"),
            F.struct(F.lit(0).cast("bigint").alias("delivery_id"), "content_hash").alias("_first"),
        )
        events = events.unionByName(before)
    # At most one row per slot in either window group.
    earlier_event = W.partitionBy(*EVENT).orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    has_hash = F.when(F.col("_first.content_hash").isNotNull(), F.col("_first.content_hash"))
    seen = (
        events.withColumn("content_hash", F.first(has_hash, ignorenulls=True).over(earlier_event))
        .filter((F.col("slot") >= 0) & F.col("content_hash").isNotNull())
        .select(*EVENT, "slot", "content_hash")
    )
    earlier_slot = W.partitionBy(*ENTITY).orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    highest = (
        events.groupBy(*ENTITY, "slot")
        .agg(F.max("source_version").alias("_top"))
        .withColumn("source_version", F.max("_top").over(earlier_slot))
        .filter((F.col("slot") >= 0) & F.col("source_version").isNotNull())
        .select(*EVENT, "slot", F.lit(None).cast(known.schema["content_hash"].dataType).alias("content_hash"))
    )
    return seen.unionByName(highest)


def settle(
    rows: DataFrame, registry: DataFrame | None = None, hot: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``disposition`` to validated deliveries, and the conflicts to their ``reason_code``; other columns stay.

    ``rows`` has delivery_id, source, entity_key, source_version, content_hash and reason_code. With ``registry`` or ``hot``
    it is read twice: pass persisted or stored rows. ``registry`` holds the unique events of all earlier batches (source,
    entity_key, source_version, content_hash). ``hot`` lists the message keys to cut into slots.
    """
    known = _known(rows)
    past = None if registry is None else _registry_past(known, registry)
    valid = F.col("reason_code").isNull()
    lead = rows
    slot = F.lit(-1).cast("bigint")
    if hot is not None:
        # Invalid messages join by their own ids, so that they stay spread out; their slots do not count.
        key = F.coalesce(F.when(valid, key_bytes(F.col("entity_key"))), key_bytes(F.col("delivery_id").cast("string")))
        lead = rows.withColumn("_key", key).join(hot.select(F.col("key").alias("_key"), F.lit(True).alias("_hot")), "_key", "left")
        slot = F.when(F.col("_hot"), F.floor(F.col("delivery_id") / hot_rows)).otherwise(slot)
        hot_known = known.join(hot, "key", "left_semi").drop("key")
        hot_past = None
        if past is not None:
            is_hot = F.encode("entity_key", "UTF-8") == F.col("key")
            hot_past = past.join(hot, is_hot, "left_semi")
            past = past.join(hot, is_hot, "left_anti")
        slots = _slot_past(hot_known, hot_past, hot_rows)
        if past is None:
            past = slots
        else:
            past = past.withColumn("slot", F.lit(-1).cast("bigint")).unionByName(slots)
    elif past is not None:
        past = past.withColumn("slot", F.lit(-1).cast("bigint"))

    # Invalid messages: no entity, and a group of their own. What the windows need of the others is sent once.
    needed = {"source": "_source", "entity_key": "_entity", "source_version": "_version", "content_hash": "_hash"}
    lead = lead.select(
        *(F.when(~valid, F.col(name)).alias(name) if name in needed else F.col(name) for name in rows.columns),
        *(F.when(valid, F.col(name)).alias(place) for name, place in needed.items()),
        F.when(valid, slot).otherwise(F.col("delivery_id")).alias("_slot"),
    )
    if past is not None:
        lead = lead.unionByName(
            past.select(
                F.lit(0).cast("bigint").alias("delivery_id"),
                *(F.col(name).alias(place) for name, place in needed.items()),
                F.col("slot").alias("_slot"),
            ),
            allowMissingColumns=True,
        )
    group = ["_source", "_entity", "_slot"]
    # Both windows need the same hash partitioning: one exchange.
    of_event = W.partitionBy(*group, "_version").orderBy("delivery_id")
    of_entity = W.partitionBy(*group).orderBy("delivery_id")
    receipt = F.when(F.col("_hash").isNotNull(), F.struct("delivery_id", "_hash"))
    windowed = lead.withColumn(
        "_first", F.first(receipt, ignorenulls=True).over(of_event.rowsBetween(W.unboundedPreceding, 0))
    ).withColumn("_before", F.max("_version").over(of_entity.rowsBetween(W.unboundedPreceding, -1)))
    if past is not None:
        windowed = windowed.filter(F.col("delivery_id") > 0)

    repeated = F.col("_first.delivery_id") < F.col("delivery_id")
    conflict = valid & repeated & (F.col("_first._hash") != F.col("_hash"))
    disposition = (
        F.when(~valid | conflict, "rejected")
        .when(repeated, "duplicate")
        .when(F.col("_version") <= F.col("_before"), "stale")
        .otherwise("accepted")
    )
    said = {name: F.coalesce(place, name) for name, place in needed.items()}
    said["reason_code"] = F.when(conflict, SOURCE_VERSION_CONFLICT).otherwise(F.col("reason_code"))
    return windowed.select(*(said.get(name, F.col(name)).alias(name) for name in rows.columns), disposition.alias("disposition"))


def decide(
    checked: DataFrame,
    processed_at: datetime | Column,
    registry: DataFrame | None = None,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Ledger rows for validated deliveries; see ``settle``."""
    envelope = F.col("envelope")
    rows = settle(checked.withColumns({name: envelope[name] for name in EVENT}), registry, hot, hot_rows)
    at = processed_at if isinstance(processed_at, Column) else F.lit(processed_at).cast("timestamp")
    return rows.select(
        "delivery_id",
        "topic",
        F.col("partition").alias("partition_id"),
        F.col("offset").alias("broker_offset"),
        F.col("key").alias("message_key"),
        F.col("value").alias("raw_message"),
        envelope["event_id"].alias("event_id"),
        "source",
        "entity_key",
        envelope["event_type"].alias("event_type"),
        envelope["occurred_at"].alias("occurred_at"),
        envelope["captured_at"].alias("captured_at"),
        envelope["batch_id"].alias("batch_id"),
        "disposition",
        at.alias("processed_at"),
        "source_version",
        "content_hash",
        "envelope",
        "reason_code",
        "details",
    )


def find_hot(received: Received, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """``hot_keys`` of the batch, or None when no key is hot, as in a batch of no more rows than a hot key has.

    At most ``MOST_SENT`` keys are broadcast, which is checked; more are left to Spark.
    """
    if received.count <= hot_rows:
        return None
    hot = hot_keys(received.rows, hot_rows)
    keys = hot.limit(MOST_SENT + 1).collect()
    if len(keys) > MOST_SENT:
        return hot
    return F.broadcast(hot.sparkSession.createDataFrame(keys, hot.schema)) if keys else None


def classify_received(
    received: Received, processed_at: datetime | Column, registry: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Validate and decide a received batch."""
    hot = find_hot(received, hot_rows)
    checked = validate(received.rows)
    if registry is not None or hot is not None:
        checked = settled(checked)
    return decide(checked, processed_at, registry, hot, hot_rows)


def settled(checked: DataFrame, folder: str | None = None) -> DataFrame:
    """Validated rows that can be read again; storing them also cuts the lineage of long streams."""
    return stored(checked, folder)


def touched(rows: DataFrame, bucket: Column) -> list[int]:
    """The buckets of the entities of a batch: at most as many rows as there are buckets."""
    entities = rows.filter(F.col("reason_code").isNull()).select(*ENTITY)
    return sorted(row[0] for row in entities.select(bucket.alias("bucket")).distinct().collect())


def classify(
    wire: DataFrame,
    processed_at: datetime | Column,
    registry: DataFrame | None = None,
    first_delivery_id: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Wire rows to ledger rows: receipt ids, validation, disposition."""
    return classify_received(receive(wire, first_delivery_id), processed_at, registry, hot_rows)
