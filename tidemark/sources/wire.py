"""The keyed topic as a table: columns and types of Spark's Kafka source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.expressions import key_bytes, wire_json
from tidemark.operators.numbering import number_in_chunks
from tidemark.schemas import WIRE, names

TOPIC = "source.orders.v1"
PARTITIONS = 3
SPAN = 65_536  # offsets counted together


def partition_by_key(key: Column, partitions: int = PARTITIONS) -> Column:
    """Every version of an entity goes to one partition: the one of its key."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(partitions)).cast("int")


def misplaced(partitions: int = PARTITIONS) -> Column:
    """Whether a message of this topic lies in another partition than its key's, where order per entity is lost."""
    return (F.col("topic") == TOPIC) & F.col("key").isNotNull() & (F.col("partition") != partition_by_key(F.col("key"), partitions))


def assign_offsets(
    rows: DataFrame,
    topic: str = TOPIC,
    base_offsets: DataFrame | None = None,
    order: tuple[str, ...] = ("number",),
    chunk: tuple[str, ...] = ("chunk",),
) -> DataFrame:
    """Add ``topic`` and ``offset``: dense per ``partition``, in the given order, after ``base_offsets``.

    ``base_offsets`` is the result of ``topic_offsets`` for what is already on the topic. Numbering shuffles the
    rows, so do it while they are narrow: before the message text exists.
    """
    numbered = number_in_chunks(
        rows.withColumn("topic", F.lit(topic)), "offset", order=order, chunk=chunk, group=("topic", "partition"), store=True
    )
    if base_offsets is None:
        return numbered.withColumn("offset", F.col("offset") - 1)
    # One row per topic partition.
    base = F.broadcast(base_offsets.select("topic", "partition", F.col("high").alias("_high")))
    return (
        numbered.join(base, ["topic", "partition"], "left")
        .withColumn("offset", F.col("offset") - 1 + F.coalesce("_high", F.lit(0)))
        .drop("_high")
    )


def messages(events: DataFrame) -> DataFrame:
    """Envelopes to key/value bytes. ``events`` has a column ``envelope``; other columns stay."""
    envelope = F.col("envelope")
    return events.select(
        *[name for name in events.columns if name != "envelope"],
        key_bytes(envelope["entity_key"]).alias("key"),
        key_bytes(wire_json(envelope)).alias("value"),
    )


def as_wire(rows: DataFrame) -> DataFrame:
    """The columns of the topic table, in order and type."""
    return rows.select(
        "topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"),
        "key", "value", "timestamp",
    )


def publish_kafka(rows: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Write key/value rows to a Kafka topic. Needs Spark's Kafka connector on the class path."""
    (
        rows.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .save()
    )


def read_wire(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WIRE).parquet(path).select(*names(WIRE))


def read_wire_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded read of the topic table from its first file."""
    reader = spark.readStream.schema(WIRE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*names(WIRE))


def read_kafka_stream(spark: SparkSession, servers: str, topic: str = TOPIC) -> DataFrame:
    """The same columns from a broker. Needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
        .load()
        .select("topic", "partition", "offset", "key", "value", "timestamp")
    )


def topic_offsets(wire: DataFrame) -> DataFrame:
    """``low`` and (exclusive) ``high`` offset per partition."""
    return wire.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )


def gapless_ends(pending: DataFrame, next_offsets: DataFrame) -> DataFrame:
    """For each partition the (exclusive) end of the offsets that follow ``next`` without a gap.

    ``pending`` holds offsets from ``next`` on, in any order; a partition that is not in ``next_offsets`` (one row each)
    begins at 0. Offsets are counted in spans, and only the first span that is not full is looked at row by row.
    """
    start = F.broadcast(next_offsets.select("topic", "partition", F.col("next").alias("_next")))
    rows = pending.join(start, ["topic", "partition"], "left").select(
        "topic", "partition", "offset", F.coalesce("_next", F.lit(0)).cast("bigint").alias("_next")
    )
    rows = rows.filter("offset >= _next").distinct().withColumn("_span", F.floor((F.col("offset") - F.col("_next")) / SPAN))
    counts = rows.groupBy("topic", "partition", "_next", "_span").agg(F.count(F.lit(1)).alias("_n"))
    by_span = W.partitionBy("topic", "partition").orderBy("_span")  # one row for each span
    # Full spans from the first one on; the span after them is the one to look into.
    placed = counts.withColumn("_at", F.row_number().over(by_span) - 1)
    full = placed.withColumn("_whole", F.min((F.col("_n") == SPAN) & (F.col("_at") == F.col("_span"))).over(by_span))
    last = full.groupBy("topic", "partition", "_next").agg(F.count_if("_whole").alias("_look"))
    inside = rows.join(F.broadcast(last), ["topic", "partition", "_next"]).filter("_span = _look")
    place = W.partitionBy("topic", "partition").orderBy("offset")  # at most SPAN rows
    steps = inside.withColumn("_place", F.row_number().over(place) - 1).filter(
        F.col("offset") == F.col("_next") + F.col("_look") * SPAN + F.col("_place")
    )
    found = steps.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("_more"))
    return last.join(found, ["topic", "partition"], "left").select(
        "topic", "partition", F.col("_next").alias("low"),
        (F.col("_next") + F.col("_look") * SPAN + F.coalesce("_more", F.lit(0))).alias("high"),
    )


def read_bounded(wire: DataFrame, ends: DataFrame) -> DataFrame:
    """Everything from offset 0 up to the captured ends; refuses if offset 0 has expired.

    ``ends`` is a ``topic_offsets`` result taken earlier (one row per topic partition).
    """
    expired = ends.filter("low <> 0").limit(1).collect()
    if expired:
        raise ValueError("offset 0 has expired; a full replay cannot be claimed")
    bound = F.broadcast(ends.select("topic", "partition", F.col("high").alias("_end")))
    return wire.join(bound, ["topic", "partition"]).filter(F.col("offset") < F.col("_end")).drop("_end")


def assert_unchanged(ends: DataFrame, wire: DataFrame) -> None:
    """Fail if the topic grew (or lost data) since ``ends`` was taken."""
    now = topic_offsets(wire).select("topic", "partition", F.col("low").alias("l2"), F.col("high").alias("h2"))
    moved = ends.join(now, ["topic", "partition"], "full_outer").filter(
        ~(F.col("low").eqNullSafe(F.col("l2")) & F.col("high").eqNullSafe(F.col("h2")))
    )
    if not moved.isEmpty():
        raise ValueError("the topic changed during the bounded run")
