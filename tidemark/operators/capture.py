"""From the change journal to validated events: cursors, pages, quarantine."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.expressions import entity_key, raw_record, stable_event_id, uuid_text
from tidemark.functions.validation import errors_text, journal_errors, journal_ok
from tidemark.operators.numbering import number_staged, sort_and_number
from tidemark.schemas import ENVELOPE, JOURNAL, PAYLOAD_FIELDS

CURSOR = ("source_updated_at", "order_key")
BATCH_SIZE = 500
JOURNAL_COLUMNS = (*PAYLOAD_FIELDS, "source_version", "source_updated_at", "event_type")


class Cursor(NamedTuple):
    """Position in the journal; compares as a tuple, with the time as an instant."""

    source_updated_at: datetime
    order_key: int

    @classmethod
    def of(cls, at: datetime, order_key: int) -> Cursor:
        if isinstance(order_key, bool) or not isinstance(order_key, int) or order_key <= 0:
            raise ValueError("a cursor needs a strictly positive integer key")
        if at.tzinfo is None:
            raise ValueError("a cursor needs an explicit time zone")
        return cls(at.astimezone(timezone.utc), order_key)

    def follows(self, other: Cursor) -> bool:
        return self > other


UNPLACED = "the journal holds a row without a time or a key"


class CaptureError(RuntimeError):
    """The journal broke a rule that capture depends on; the checkpoint stays where it was."""


def utc(micros: int | None) -> datetime | None:
    """Exact instant from microseconds since 1970, independent of the driver's time zone."""
    if micros is None:
        return None
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=rest)


def normalize_journal(rows: DataFrame) -> DataFrame:
    """Lower-case column names, as the journal may come from a case-folding store."""
    return rows.toDF(*[name.lower() for name in rows.columns])


def at_literal(at: datetime) -> Column:
    return F.lit(at).cast("timestamp")


def after_cursor(cursor: Cursor | None) -> Column:
    """Strictly after the cursor. Written out as OR/AND: only this form reaches the Parquet reader."""
    if cursor is None:
        return F.lit(True)
    at = at_literal(cursor.source_updated_at)
    return (F.col(CURSOR[0]) > at) | ((F.col(CURSOR[0]) == at) & (F.col(CURSOR[1]) > cursor.order_key))


def up_to(cursor: Cursor) -> Column:
    at = at_literal(cursor.source_updated_at)
    return (F.col(CURSOR[0]) < at) | ((F.col(CURSOR[0]) == at) & (F.col(CURSOR[1]) <= cursor.order_key))


def high_watermark_row(journal: DataFrame) -> DataFrame:
    """Largest cursor, as one row (NULLs for an empty journal)."""
    return journal.agg(F.max(F.struct(*CURSOR)).alias("high")).select(
        F.col("high.source_updated_at").alias("source_updated_at"), F.col("high.order_key").alias("order_key")
    )


def high_watermark(journal: DataFrame) -> Cursor | None:
    row = high_watermark_row(journal).select(F.unix_micros("source_updated_at"), "order_key").first()
    return None if row[0] is None else Cursor.of(utc(row[0]), row[1])


def assert_no_regression(after: Cursor | None, high: Cursor | None) -> None:
    if after is not None and (high is None or after.follows(high)):
        raise CaptureError("the journal regressed: it ends before the checkpoint")


class Frontier(NamedTuple):
    """Where a journal ends, and how many rows have no place in it."""

    high: Cursor | None
    unplaced: int


def frontier(journal: DataFrame, after: Cursor | None) -> Frontier:
    """One scan of the cursor columns. Only what is not older than the checkpoint can hold the high watermark; a row
    without a time or key would be passed over for good, so those are looked for everywhere."""
    at, key = F.col(CURSOR[0]), F.col(CURSOR[1])
    lost = at.isNull() | key.isNull()
    recent = journal if after is None else journal.filter((at >= at_literal(after.source_updated_at)) | lost)
    found = recent.agg(F.max(F.when(~lost, F.struct(*CURSOR))).alias("high"), F.count_if(lost).alias("lost"))
    row = found.select(F.unix_micros("high.source_updated_at"), "high.order_key", "lost").first()
    return Frontier(None if row[0] is None else Cursor(utc(row[0]), row[1]), row[2])


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """The change journal, whatever the case of its column names."""
    return spark.read.schema(JOURNAL).parquet(path).select(*JOURNAL_COLUMNS)


def order_faults(staged: DataFrame, after: Cursor | None, high: Cursor) -> DataFrame:
    """Each row of a staged range against the one before it, as one row of counts.

    ``disordered`` rows come after a greater cursor, ``repeated`` ones after an equal one, ``invalid`` ones have a key that
    is not positive, ``outside`` ones lie beyond ``(after, high]``; ``unsafe_at`` and ``unsafe_key`` are the lowest cursor
    that is repeated or invalid. Inside a chunk the row before is found by ``lag``; the first row of a chunk is compared
    with the last one of the chunk before. Only the cursor columns are read.
    """
    cursor = F.struct(*CURSOR)
    narrow = staged.select("chunk", "row", *CURSOR)
    inside = W.partitionBy("chunk").orderBy("row")
    ends = narrow.groupBy("chunk").agg(F.max_by(cursor, "row").alias("_last"))
    # One row per chunk.
    edges = ends.select(F.lead("chunk").over(W.orderBy("chunk")).alias("chunk"), F.col("_last").alias("_edge")).filter("chunk is not null")
    rows = narrow.withColumn("_lag", F.lag(cursor).over(inside)).join(F.broadcast(edges), "chunk", "left")
    before = F.coalesce("_lag", "_edge")
    rows = rows.select(cursor.alias("c"), before.alias("b"), (~after_cursor(after) | ~up_to(high)).alias("outside"))
    repeated, invalid = F.col("c") == F.col("b"), F.col(f"c.{CURSOR[1]}") <= 0
    unsafe = F.min(F.when(repeated | invalid, F.col("c")))
    return rows.agg(
        F.count_if(F.col("c") < F.col("b")).alias("disordered"),
        F.count_if(repeated).alias("repeated"),
        F.count_if(invalid).alias("invalid"),
        F.count_if("outside").alias("outside"),
        unsafe.alias("_unsafe"),
    ).select(
        "disordered", "repeated", "invalid", "outside",
        F.col(f"_unsafe.{CURSOR[0]}").alias("unsafe_at"), F.col(f"_unsafe.{CURSOR[1]}").alias("unsafe_key"),
    )


def assert_ordered(staged: DataFrame, after: Cursor | None, high: Cursor) -> tuple[datetime, int] | None:
    """Stop if a staged range is not in order or leaves ``(after, high]``; else the lowest cursor that is repeated or whose
    key is not positive. Capture must stop before that cursor's page."""
    found = order_faults(staged, after, high)
    row = found.select("disordered", "outside", F.unix_micros("unsafe_at").alias("at"), "unsafe_key").first()
    if row["disordered"]:
        raise CaptureError(f"the journal's order broke at {row['disordered']} rows")
    if row["outside"]:
        raise CaptureError(f"{row['outside']} rows lie outside the captured range")
    return None if row["at"] is None else (utc(row["at"]), row["unsafe_key"])


def journal_page(journal: DataFrame, after: Cursor | None, high: Cursor, limit: int) -> DataFrame:
    """One ordered page of ``(after, high]``; the limit is the page size."""
    return journal_range(journal, after, high).orderBy(*CURSOR).limit(limit)


def cursor_multiplicity(journal: DataFrame) -> DataFrame:
    """How often each cursor occurs. Copies are counted map-side, so a hot cursor is harmless."""
    return journal.groupBy(*CURSOR).agg(F.count(F.lit(1)).alias("multiplicity"))


def duplicate_cursors(journal: DataFrame) -> DataFrame:
    """Cursors that occur more than once."""
    return cursor_multiplicity(journal).filter("multiplicity > 1")


def journal_range(journal: DataFrame, after: Cursor | None, high: Cursor) -> DataFrame:
    """All rows of ``(after, high]``; both bounds are pushed down to the scan."""
    return journal.filter(after_cursor(after)).filter(up_to(high))


def plan_pages(part: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Journal rows with ``number`` and ``batch_sequence`` (both from 1, in cursor order) and ``chunk``."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    return _paged(sort_and_number(part, "number", list(CURSOR)), batch_size)


def _paged(numbered: DataFrame, batch_size: int) -> DataFrame:
    return numbered.withColumn("batch_sequence", F.floor((F.col("number") - 1) / batch_size).cast("bigint") + 1)


def staged_pages(staged: DataFrame, batch_size: int) -> DataFrame:
    """``plan_pages`` of a range that ``stage_sorted`` wrote in cursor order."""
    return _paged(number_staged(staged, "number"), batch_size)


def _batch_id(source: str | Column, run_id: str) -> Column:
    named = F.lit(source) if isinstance(source, str) else source
    return uuid_text(F.lit(run_id), named, F.col("batch_sequence"))


def envelope(source: str | Column, run_id: str, captured_at: datetime) -> Column:
    """The event of a paged journal row."""
    named = F.lit(source) if isinstance(source, str) else source
    key = entity_key(F.col("order_key"))
    return F.struct(
        stable_event_id(source, key, F.col("source_version")).alias("event_id"),
        F.col("event_type"),
        named.alias("source"),
        key.alias("entity_key"),
        F.struct(*PAYLOAD_FIELDS).alias("payload"),
        F.col("source_updated_at").alias("occurred_at"),
        at_literal(captured_at).alias("captured_at"),
        F.lit(1).alias("schema_version"),
        F.col("source_version"),
        F.col("source_updated_at"),
        _batch_id(source, run_id).alias("batch_id"),
        F.lit(run_id).alias("sync_run_id"),
        F.col("batch_sequence"),
    ).cast(ENVELOPE)


def check_rows(pages: DataFrame, source: str | Column, run_id: str) -> DataFrame:
    """Add ``source``, ``batch_id`` and ``errors`` (empty for a valid row) to paged journal rows."""
    return pages.withColumns(
        {
            "errors": journal_errors(),
            "source": F.lit(source) if isinstance(source, str) else source,
            "batch_id": _batch_id(source, run_id),
        }
    )


def build_events(pages: DataFrame, source: str | Column, run_id: str, captured_at: datetime) -> DataFrame:
    """``check_rows`` and the ``envelope`` of each valid row."""
    event = envelope(source, run_id, captured_at)
    return check_rows(pages, source, run_id).withColumn("envelope", F.when(F.size("errors") == 0, event))


def valid_events(built: DataFrame) -> DataFrame:
    return built.filter(journal_ok())


def quarantine(built: DataFrame, created_at: datetime, *kept: str) -> DataFrame:
    """Rows that cannot become events, with the full raw record and the reason; ``kept`` columns stay."""
    return built.filter(F.size("errors") > 0).select(
        *kept,
        "batch_id",
        "source",
        "source_updated_at",
        "order_key",
        raw_record(*JOURNAL_COLUMNS).alias("raw_record"),
        errors_text(F.col("errors")).alias("reason"),
        at_literal(created_at).alias("created_at"),
    )


def new_quarantine(candidates: DataFrame, existing: DataFrame, source: str, after: Cursor | None, until: Cursor) -> DataFrame:
    """Insert-if-absent on (source, source_updated_at, order_key).

    The candidates lie in ``(after, until]``: the same bounds go down to the scan of what is there.
    """
    near = existing.filter((F.col("source") == source) & after_cursor(after)).filter(up_to(until))
    return candidates.join(near.select("source", *CURSOR), ["source", *CURSOR], "left_anti")


def batch_rows(built: DataFrame, run_id: str, after: Cursor | None, *kept: str) -> DataFrame:
    """One row per page: cursor range and counts. ``from`` is the end of the page before; ``after`` that of the first.
    ``kept`` columns, the same in all rows of a page, stay."""
    cursor = F.struct(*CURSOR)
    pages = built.groupBy("source", "batch_id", "batch_sequence", *kept).agg(
        F.max(cursor).alias("_to"),
        F.count(F.lit(1)).alias("records_seen"),
        F.count_if(F.size("errors") == 0).alias("records_published"),
    )
    previous = pages.select(
        "source",
        (F.col("batch_sequence") + 1).alias("batch_sequence"),
        F.col("_to.source_updated_at").alias("_prev_at"),
        F.col("_to.order_key").alias("_prev_key"),
    )
    start_at = F.lit(None).cast("timestamp") if after is None else at_literal(after.source_updated_at)
    start_key = F.lit(None if after is None else after.order_key).cast("bigint")
    first = F.col("batch_sequence") == 1
    return pages.join(previous, ["source", "batch_sequence"], "left").select(
        *kept,
        "batch_id",
        F.lit(run_id).alias("run_id"),
        "source",
        "batch_sequence",
        F.when(first, start_at).otherwise(F.col("_prev_at")).alias("from_updated_at"),
        F.when(first, start_key).otherwise(F.col("_prev_key")).alias("from_order_key"),
        F.col("_to.source_updated_at").alias("to_updated_at"),
        F.col("_to.order_key").alias("to_order_key"),
        "records_seen",
        "records_published",
    )


def entity_versions(rows: DataFrame, *kept: str) -> DataFrame:
    """Last version per entity on the capture side; a lower version never replaces a higher one.

    ``rows`` has source, entity_key, source_version and source_updated_at (events, or earlier results, or a
    union of both). The event id follows from the other columns, so it is computed for the winners only. With ``kept``
    columns there is one version for each of their values.
    """
    last = F.max(F.struct("source_version", "source_updated_at")).alias("_last")
    return (
        rows.groupBy("source", "entity_key", *kept)
        .agg(last)
        .select(
            *kept,
            "source",
            "entity_key",
            F.col("_last.source_version").alias("source_version"),
            F.col("_last.source_updated_at").alias("source_updated_at"),
            stable_event_id(F.col("source"), F.col("entity_key"), F.col("_last.source_version")).alias("last_event_id"),
        )
    )


class Capture(NamedTuple):
    events: DataFrame
    quarantine: DataFrame
    batches: DataFrame


def capture(
    journal: DataFrame,
    after: Cursor | None,
    high: Cursor,
    source: str,
    run_id: str,
    captured_at: datetime,
    batch_size: int = BATCH_SIZE,
) -> Capture:
    """One frozen range of the journal as events, quarantine and page metadata (only scratch is written)."""
    if frontier(journal, after).unplaced:
        raise CaptureError(UNPLACED)
    pages = plan_pages(journal_range(journal, after, high), batch_size)
    built = build_events(pages, source, run_id, captured_at)
    return Capture(valid_events(built), quarantine(built, captured_at), batch_rows(built, run_id, after))
