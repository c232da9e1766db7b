"""Continuous capture of the journal and continuous ingest of the topic with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.capture import BATCH_SIZE, read_journal
from tidemark.operators.classify import HOT_ROWS
from tidemark.plans.pipeline import Pipeline
from tidemark.schemas import JOURNAL
from tidemark.sources.wire import read_wire_stream


def _started(stream: DataFrame, each, checkpoint: str, name: str, available_now: bool, interval: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(name)
    trigger = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return trigger.start()


def run_stream(
    pipeline: Pipeline,
    deliveries: DataFrame,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    interval: str = "30 seconds",
    hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Classify a stream of deliveries that comes in offset order (``read_kafka_stream``) into the ledger.

    Each micro-batch is one batch named after the stream and the batch number. Spark stores the offsets only
    after the batch function returned; a batch that is run again finds itself finished and changes nothing. There is
    no watermark: a late version must stay in the log as ``stale``, however late it is. ``name`` must be new
    for a new checkpoint folder, because batch numbers start again at 0.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        pipeline.materialize(batch, f"{name}-{batch_id:010d}", hot_rows)

    return _started(deliveries, ingest, checkpoint, name, available_now, interval)


def run_topic_stream(
    pipeline: Pipeline,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    interval: str = "30 seconds",
    max_files: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Classify the pipeline's topic table in offset order, whatever the order in which its files appear.

    New files only say that there is something to do. A micro-batch takes, in every partition, the offsets that follow
    what the ledger has without a gap; messages behind a gap wait on the topic until the gap is filled.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        ready = pipeline.admissible()
        if not ready.select("offset").isEmpty():
            pipeline.materialize(ready, f"{name}-{batch_id:010d}", hot_rows)

    stream = read_wire_stream(pipeline.spark, pipeline.wire_path, max_files)
    return _started(stream, ingest, checkpoint, name, available_now, interval)


def run_capture(
    pipeline: Pipeline,
    journal_path: str,
    source: str,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    interval: str = "30 seconds",
    batch_size: int = BATCH_SIZE,
) -> StreamingQuery:
    """Poll a journal table: every tick that finds new files is one ``sync`` up to a fresh high watermark.

    The pipeline's own checkpoint says where a tick begins, so a tick that is run again has nothing left to do. A run that
    fails ends the query; the next start tries again from the last committed group.
    """

    def tick(batch: DataFrame, batch_id: int) -> None:
        pipeline.sync(read_journal(pipeline.spark, journal_path), source, batch_size)

    stream = pipeline.spark.readStream.schema(JOURNAL).parquet(journal_path)
    return _started(stream, tick, checkpoint, name, available_now, interval)
