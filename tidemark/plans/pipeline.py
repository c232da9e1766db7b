"""The durable pipeline: sync runs on the capture side, the ledger on the sink side.

State lies in plain Parquet tables (``Store``). Two of them say what counts: ``batches`` has one row per batch of
deliveries, ``checkpoints`` one per group of captured pages. Both rows are written after everything they speak of, so an
interrupted batch or group is invisible, and writing it again under the same id replaces what it left. They also carry
what the next batch or group starts from: receipt ids, admitted offsets, the cursor.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce, wraps
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.expressions import entity_key, key_bytes
from tidemark.functions.validation import validate
from tidemark.operators import capture as cap
from tidemark.operators import checks, inspect, views
from tidemark.operators.classify import HOT_ROWS, Span, find_hot, receive, settle, settled, touched
from tidemark.operators.numbering import stage_sorted
from tidemark.operators.slim import slim, whole
from tidemark.session import shuffles_removed
from tidemark.sources import wire as topic
from tidemark.sources.store import FILE_ROWS, Store, Table, forget

BUCKETS = 16  # of entities, in the registry and the current state
LAYOUT = 2  # of the ledger and the registry: slim rows
GROUPS = 4  # parts in which a run is committed, unless the caller says how many pages make one


def _without(ddl: str, *names: str) -> str:
    return ", ".join(part for part in schemas.columns(ddl) if part.split()[0] not in names)


_CURRENT = (
    "source string, entity_key string, source_version bigint, source_updated_at timestamp, "
    f"payload {schemas.PAYLOAD}, last_captured_at timestamp, updated_at timestamp"
)
_ENDS = "array<struct<topic: string, partition: int, next: bigint>>"
# Point look-ups of an entity skip the row groups that do not have it.
_BLOOM = {"parquet.bloom.filter.enabled#entity_key": "true", "parquet.bloom.filter.expected.ndv#entity_key": "1000000",
          "parquet.bloom.filter.adaptive.enabled": "true"}

SINK = {
    "batches": Table(
        f"number bigint, first_id bigint, next_id bigint, rows bigint, buckets int, layout int, covers boolean, ends {_ENDS}, at timestamp", "batch string"
    ),
    "ledger": Table(schemas.DELIVERIES, "batch string, disposition string", _BLOOM),
    "registry": Table("source string, entity_key string, source_version bigint, content_hash binary", "bucket int, batch string"),
    "current": Table(_CURRENT, "bucket int"),
}
CAPTURE = {
    "runs": Table(_without(schemas.RUN_EVENTS, "run_id", "event"), "run_id string, event string"),
    "pages": Table(_without(schemas.SYNC_BATCHES, "run_id", "status", "error_code", "finished_at"), "run_id string, first_page bigint"),
    "quarantine": Table(schemas.QUARANTINE, "run_id string, first_page bigint"),
    "entity_versions": Table(schemas.ENTITY_VERSIONS, "run_id string, first_page bigint"),
    "checkpoints": Table(
        "source string, updated_at timestamp, order_key bigint, batch_id string, finished_at timestamp, number bigint",
        "run_id string, first_page bigint",
    ),
}
TOPIC = {"wire": Table(schemas.WIRE, "publication bigint"), "publications": Table(f"ends {_ENDS}", "publication bigint")}
# A reset begins a new generation of one side's tables.
GENERATIONS = Table("sink int, capture int, next_id bigint", "number int")


def _tidy(method: Callable) -> Callable:
    """A method whose jobs leave no shuffle files behind."""

    @wraps(method)
    def run(self: Pipeline, *args: object, **kwargs: object) -> object:
        with shuffles_removed(self.spark):
            return method(self, *args, **kwargs)

    return run


class Public(NamedTuple):
    """A table that readers see: what it is made of and how."""

    stored: str
    rows: Callable[["Pipeline"], DataFrame]


# Everything made of the ledger belongs to the sink; the rest is the capture side's.
PUBLIC = {
    "event_deliveries": Public("ledger", lambda p: p.ledger()),
    "event_rejections": Public("ledger", lambda p: p.rejections()),
    "orders_current": Public("ledger", lambda p: p.orders_current()),
    "processed_events": Public("ledger", lambda p: p.processed_events()),
    "source_entity_versions": Public("entity_versions", lambda p: p.entity_versions()),
    "source_quarantine": Public("quarantine", lambda p: p.quarantine()),
    "sync_batches": Public("pages", lambda p: p.batches()),
    "sync_runs": Public("runs", lambda p: p.runs()),
    "sync_state": Public("checkpoints", lambda p: p.state()),
}
SCOPES = {"sink": [name for name, t in PUBLIC.items() if t.stored == "ledger"], "pipeline": list(PUBLIC)}


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


class Pipeline:
    """State under one root folder. ``buckets`` must stay the same for the life of the folder."""

    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] = now_utc, buckets: int = BUCKETS):
        self.spark = spark
        self.clock = clock
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.topic = Store(spark, self.root, TOPIC)
        self.wire_path = self.topic.path("wire")
        self._pinned: dict[str, list[Row]] | None = None
        self._open()

    def _open(self) -> None:
        """The tables of the latest generation. A reset by another object is seen from the next opening on."""
        self._generations = Store(self.spark, self.root, {"generations": GENERATIONS})
        rows = self._generations.read("generations").orderBy(F.col("number").desc()).limit(1).collect()
        self._generation = rows[0] if rows else Row(sink=0, capture=0, next_id=1, number=0)
        self.sink = Store(self.spark, f"{self.root}/sink-{self._generation.sink}", SINK)
        self.capture = Store(self.spark, f"{self.root}/capture-{self._generation.capture}", CAPTURE)

    # --- what counts ---------------------------------------------------------------------------------------
    def _rows(self, store: Store, name: str) -> list[Row]:
        """All rows of a small table: one per batch, group, run event or publication."""
        if self._pinned is not None:
            return self._pinned[name]
        return store.read(name).collect()

    def _small(self, store: Store, name: str) -> DataFrame:
        if self._pinned is None:
            return store.read(name)
        return self.spark.createDataFrame(self._pinned[name], store.schema(name))

    def pinned(self) -> Pipeline:
        """The pipeline as of now: all reads of the returned object see the same batches and pages."""
        now = Pipeline(self.spark, self.root, self.clock, self.buckets)
        small = {"batches": now.sink, "runs": now.capture, "checkpoints": now.capture}
        now._pinned = {name: store.read(name).collect() for name, store in small.items()}
        return now

    def _batches(self, rows: list[Row] | None = None) -> list[Row]:
        """Finished batches that the ledger is made of, in order: the latest that covers all before it, and those since."""
        rows = sorted(self._rows(self.sink, "batches") if rows is None else rows, key=lambda row: row.number)
        if any(row.layout != LAYOUT for row in rows):
            raise ValueError("the ledger of this folder has an older layout")
        covering = [i for i, row in enumerate(rows) if row.covers]
        return rows[covering[-1] :] if covering else rows

    def _of_batches(self, name: str, batches: list[Row]) -> DataFrame:
        return self.sink.read(name).filter(F.col("batch").isin([row.batch for row in batches]))

    def _of_groups(self, name: str) -> DataFrame:
        """Rows of the page groups that have a checkpoint."""
        groups = self._small(self.capture, "checkpoints").select("run_id", "first_page")
        return self.capture.read(name).join(groups, ["run_id", "first_page"], "left_semi")

    # --- tables ------------------------------------------------------------------------------------------
    def ledger(self, after_id: int = 0) -> DataFrame:
        """All deliveries; only batches with ids after ``after_id`` are read."""
        batches = [row for row in self._batches() if row.next_id > after_id + 1]
        return self._ledger_of(batches)

    def processed_events(self) -> DataFrame:
        return views.processed_events(self.ledger())

    def registry(self, batches: list[Row] | None = None) -> DataFrame:
        """The unique events, in buckets of their entities; hashes as they are stored, in bytes."""
        return self._of_batches("registry", self._batches() if batches is None else batches)

    def rejections(self) -> DataFrame:
        return views.rejections(self.ledger())

    def orders_current(self) -> DataFrame:
        """Latest version per entity: the stored state, or for a pinned pipeline the view over its batches."""
        if self._pinned is not None:
            return views.orders_current(self.ledger())
        return views.whole_current(self.sink.read("current"))

    def events_page(self, limit: int = 100, after_id: int = 0, **filters: object) -> inspect.Page:
        """``inspect.events_page`` over the stored batches.

        Ids ascend from batch to batch, and every batch knows its span: the search begins at the batch after ``after_id``
        and takes in twice as many batches each time, until the page is full.
        """
        inspect.check_arguments(limit=limit, after_id=after_id, **{k: v for k, v in filters.items() if k != "source_prefix"})
        batches = self._batches()
        later = [row for row in batches if row.next_id > after_id + 1]
        everything, many, rows = self._ledger_of(batches), 1, []
        while later and len(rows) <= limit:
            rows += inspect.event_rows(self._ledger_of(later[:many]), limit + 1 - len(rows), everything, after_id=after_id, **filters)
            later, many = later[many:], many * 2
        return inspect.paged(rows, limit)

    def entity_view(self, key: str, source: str, after_id: int = 0, limit: int = 100) -> inspect.EntityView:
        """Current row and a page of the deliveries of one entity; only its bucket of the current state is read."""
        inspect.check_arguments(entity_key=key, source=source, after_id=after_id, limit=limit)
        current = inspect.current_row(self.current_of(key, source))
        page = self.events_page(limit, after_id, entity_key=key, source=source)
        if current is None and not page.items and inspect.of_entity(self.ledger(), key, source).select("delivery_id").isEmpty():
            raise inspect.EntityNotFound(key)
        return inspect.EntityView(current, page.items, page.next_after_id)

    def current_of(self, key: str, source: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64(F.lit(source), F.lit(key)), F.lit(self.buckets)).cast("int")
        return inspect.of_entity(views.whole_current(self.sink.read("current").filter(F.col("bucket") == bucket)), key, source)

    def _ledger_of(self, batches: list[Row]) -> DataFrame:
        return whole(self._of_batches("ledger", batches))

    @_tidy
    def compact(self) -> bool:
        """Write the ledger and the registry of all batches as one, so that there are fewer files; False if nothing was to do.

        What was there before stays on disk, and is not read again.
        """
        known = self._rows(self.sink, "batches")
        batches = self._batches(known)
        if len(batches) < 2:
            return False
        last = batches[-1]
        name = f"upto-{last.number}"
        count = sum(row.rows for row in batches)
        for table in ("ledger", "registry"):
            rows = self._of_batches(table, batches).withColumn("batch", F.lit(name))
            self.sink.replace(table, rows.coalesce(_tasks(count)))
        self._finish(known, name, batches[0].first_id, last.next_id, count, last.ends, covers=True)
        return True

    def _finish(self, known: list[Row], name: str, first_id: int, next_id: int, rows: int, ends: list, covers: bool = False) -> None:
        self.sink.replace_row(
            "batches", batch=name, number=max((row.number for row in known), default=0) + 1, first_id=first_id, next_id=next_id, rows=rows,
            buckets=self.buckets, layout=LAYOUT, covers=covers, ends=_ends(ends), at=cap.at_literal(self.clock()),
        )

    def quarantine(self) -> DataFrame:
        return self._of_groups("quarantine").select(*schemas.names(schemas.QUARANTINE))

    def entity_versions(self) -> DataFrame:
        return cap.entity_versions(self._of_groups("entity_versions"))

    def runs(self) -> DataFrame:
        """One row per run. A run without an end is running if it is its source's latest, else failed."""
        return self._runs().drop("_reported")

    def _runs(self) -> DataFrame:
        """``runs`` and whether the run reported its own end."""
        events = self._small(self.capture, "runs")
        ends = events.filter(F.col("event") != "started").select(
            "run_id", F.col("event").alias("_end"), F.col("at").alias("_end_at")
        )
        starts = events.filter(F.col("event") == "started")
        latest = starts.groupBy("source").agg(F.max("at").alias("_latest"))
        abandoned = F.col("at") < F.col("_latest")
        return (
            starts.join(ends, "run_id", "left")
            .join(latest, "source")
            .select(
                "run_id",
                "source",
                "mode",
                F.when(F.col("_end").isNotNull(), F.col("_end"))
                .when(abandoned, "failed")
                .otherwise("running")
                .alias("status"),
                "high_watermark_at",
                "high_watermark_order_key",
                F.col("at").alias("started_at"),
                F.when(F.col("_end").isNotNull(), F.col("_end_at"))
                .when(abandoned, F.col("_latest"))
                .alias("finished_at"),
                F.col("_end").isNotNull().alias("_reported"),
            )
        )

    def batches(self) -> DataFrame:
        """One row per page: published with its group's checkpoint, else running or failed with its run."""
        done = self._small(self.capture, "checkpoints").select("run_id", "first_page", F.col("finished_at").alias("_done"))
        runs = self._runs().select("run_id", "_reported", F.col("status").alias("_run"), F.col("finished_at").alias("_end"))
        published, over = F.col("_done").isNotNull(), F.col("_run") != "running"
        return (
            self.capture.read("pages")
            .join(done, ["run_id", "first_page"], "left")
            .join(runs, "run_id", "left")
            .withColumns({
                "status": F.when(published, "published").when(over, "failed").otherwise("running"),
                "records_published": F.when(published, F.col("records_published")).otherwise(0),
                "error_code": F.when(~published & over, F.when(F.col("_reported"), "sync_failure").otherwise("worker_restart")),
                "finished_at": F.when(published, F.col("_done")).when(over, F.col("_end")),
            })
            .select(*schemas.names(schemas.SYNC_BATCHES))
        )

    def state(self) -> DataFrame:
        """Checkpoint per source: the end of its last committed group."""
        last = F.max_by(F.struct("updated_at", "order_key", "batch_id", "finished_at"), "number").alias("c")
        return self._small(self.capture, "checkpoints").groupBy("source").agg(last).select(
            "source", F.col("c.updated_at").alias("last_updated_at"), F.col("c.order_key").alias("last_order_key"),
            F.col("c.batch_id").alias("last_completed_batch_id"), F.col("c.finished_at").alias("updated_at"),
        )

    def public_tables(self) -> dict[str, DataFrame]:
        return {name: table.rows(self) for name, table in PUBLIC.items()}

    def stats(self) -> inspect.Stats:
        """All statistics as of one moment."""
        now = self.pinned()
        return inspect.stats(now.ledger(), now.quarantine(), now.state(), now.runs(), now.batches())

    def snapshot(self) -> DataFrame:
        """Comparable measures of the state, as of one moment."""
        now = self.pinned()
        return checks.snapshot(now.orders_current(), now.ledger(), now.quarantine(), now.state())

    def census(self, scope: str = "sink") -> DataFrame:
        """Rows of each table of a scope: (table_name, row_count, exists), as of one moment."""
        now = self.pinned()

        def counted(name: str) -> DataFrame:
            stored = PUBLIC[name].stored
            there = (now.sink if stored in SINK else now.capture).exists(stored)
            return PUBLIC[name].rows(now).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.lit(there).alias("exists"))

        return reduce(DataFrame.unionByName, [counted(name) for name in SCOPES[scope]])

    def reset(self, scope: str = "sink") -> bool:
        """Begin with empty tables of a scope; False if they are empty already. Receipt ids go on. Nobody else may write."""
        rows = self.census(scope).collect()
        if not any(row["row_count"] for row in rows):
            return False
        if not all(row["exists"] for row in rows):
            raise RuntimeError("a table of the scope does not exist; nothing was emptied")
        now = self._generation
        self._generations.replace_row(
            "generations", number=now.number + 1, sink=now.sink + 1, capture=now.capture + (scope == "pipeline"), next_id=self._next_id(self._rows(self.sink, "batches"))
        )
        self._open()
        return True

    # --- capture -------------------------------------------------------------------------------------------
    def load_cursor(self, source: str) -> cap.Cursor | None:
        row = (
            self.state()
            .filter(F.col("source") == source)
            .select(F.unix_micros("last_updated_at"), "last_order_key")
            .first()
        )
        return None if row is None else cap.Cursor.of(cap.utc(row[0]), row[1])

    def _record_run(self, run_id: str, source: str, mode: str, event: str, high: cap.Cursor) -> None:
        self.capture.replace_row(
            "runs", run_id=run_id, event=event, source=source, mode=mode, high_watermark_at=cap.at_literal(high.source_updated_at),
            high_watermark_order_key=high.order_key, at=cap.at_literal(self.clock()),
        )

    @_tidy
    def sync(
        self,
        journal: DataFrame,
        source: str,
        batch_size: int = cap.BATCH_SIZE,
        commit_pages: int | None = None,
        publish: Callable[[DataFrame], None] | None = None,
        partition: Column | None = None,
    ) -> int:
        """Capture everything after the checkpoint up to a frozen high watermark; returns rows seen.

        Pages are published and then committed in groups of ``commit_pages`` (by default a run has ``GROUPS`` groups).
        What was not committed is published again by the next run, with equal event ids.
        """
        after = self.load_cursor(source)
        journal = cap.normalize_journal(journal).select(*cap.JOURNAL_COLUMNS)
        high, unplaced = cap.frontier(journal, after)
        if high is None and unplaced:
            raise cap.CaptureError(cap.UNPLACED)
        if not (high == after and unplaced):
            cap.assert_no_regression(after, high)
            if high is None or high == after:
                return 0
        run_id = str(uuid.uuid4())
        mode = "initial" if after is None else "incremental"
        self._record_run(run_id, source, mode, "started", high)
        try:
            if unplaced:
                raise cap.CaptureError(cap.UNPLACED)
            total = self._capture(journal, after, high, source, run_id, batch_size, commit_pages, publish, partition)
        except Exception:
            self._record_run(run_id, source, mode, "failed", high)
            raise
        self._record_run(run_id, source, mode, "completed", high)
        return total

    def _capture(
        self,
        journal: DataFrame,
        after: cap.Cursor | None,
        high: cap.Cursor,
        source: str,
        run_id: str,
        batch_size: int,
        commit_pages: int | None,
        publish: Callable[[DataFrame], None] | None,
        partition: Column | None,
    ) -> int:
        # The range is scanned and sorted once; a group reads the chunks it lies in.
        staged = stage_sorted(cap.journal_range(journal, after, high), cap.CURSOR, f"{self.root}/stage/{run_id}")
        unsafe = cap.assert_ordered(staged, after, high)
        pages = cap.staged_pages(staged, batch_size)
        if unsafe is not None:
            at, key = cap.at_literal(unsafe[0]), unsafe[1]
            pages = pages.filter((F.col(cap.CURSOR[0]) < at) | ((F.col(cap.CURSOR[0]) == at) & (F.col(cap.CURSOR[1]) < key)))
        ends = (
            pages.groupBy("chunk")
            .agg(F.min("number").alias("low"), F.max("number").alias("high"), F.max(F.struct(*cap.CURSOR)).alias("c"))
            .select("chunk", "low", "high", F.unix_micros("c.source_updated_at").alias("at"), F.col("c.order_key").alias("key"))
            .collect()
        )  # one row per chunk
        seen = max((row.high for row in ends), default=0)
        # The page that holds an unsafe cursor must not be committed, and none after it.
        last_page = seen // batch_size if unsafe is not None else -(-seen // batch_size)
        step = commit_pages or max(1, -(-last_page // GROUPS))
        started = self.clock()
        first_page = (F.floor((F.col("batch_sequence") - 1) / step) * step + 1).cast("bigint")
        checked = cap.check_rows(pages, source, run_id).filter(F.col("batch_sequence") <= last_page)
        checked = checked.withColumns({"first_page": first_page, "run_id": F.lit(run_id)})
        groups = self._prepare(checked, source, run_id, after, high, started)
        event = cap.envelope(source, run_id, started)
        shifts = None
        if publish is None and groups:
            shifts = self._prepare_messages(cap.valid_events(checked), event, run_id, started, partition)
        for group in groups:
            self._copy_pages(run_id, group.first_page)
            if shifts is not None:
                self._publish_prepared(run_id, group.first_page, shifts)
            elif publish is not None:
                numbers = ((group.first_page - 1) * batch_size + 1, min(group.first_page + step - 1, last_page) * batch_size)
                chunks = [row.chunk for row in ends if row.high >= numbers[0] and row.low <= numbers[1]]
                own = checked.filter(F.col("chunk").isin(chunks) & F.col("number").between(*numbers))
                publish(cap.valid_events(own).withColumn("envelope", event))
            self._checkpoint(run_id, source, group)
        forget(self.spark, self._plan(run_id).root)
        if unsafe is not None:
            raise cap.CaptureError("the journal holds a repeated or invalid cursor; checkpoint retained")
        if max((cap.utc(row.at), row.key) for row in ends) != tuple(high):
            raise cap.CaptureError("journal gap: the high watermark was not reached")
        return seen

    def _plan(self, run_id: str) -> Store:
        """What a run works out once for all its groups: pages, and messages without their place on the topic."""
        tables = {
            "pages": self.capture.tables["pages"],
            "messages": Table(schemas.WIRE.replace("offset bigint", "place bigint"), "first_page bigint"),
        }
        return Store(self.spark, f"{self.root}/stage/{run_id}-plan", tables)

    def _prepare(
        self, checked: DataFrame, source: str, run_id: str, after: cap.Cursor | None, high: cap.Cursor, started: datetime
    ) -> list[Row]:
        """Write the pages, the quarantine and the entity versions of all groups; a group's rows count from its checkpoint on.

        Returns the groups in order with their last cursor and page.
        """
        plan = self._plan(run_id)
        rows = cap.batch_rows(checked, run_id, after, "first_page").withColumn("started_at", cap.at_literal(started))
        plan.replace("pages", rows)
        refused = cap.new_quarantine(
            cap.quarantine(checked, started, "run_id", "first_page"), self.quarantine(), source, after, high
        )
        self.capture.replace("quarantine", refused)
        keyed = cap.valid_events(checked).withColumn("entity_key", entity_key(F.col("order_key")))
        versions = cap.entity_versions(keyed, "first_page").withColumn("run_id", F.lit(run_id))
        self.capture.replace("entity_versions", versions)
        end = F.max_by(F.struct("to_updated_at", "to_order_key", "batch_id"), "batch_sequence").alias("e")
        found = plan.read("pages").groupBy("first_page").agg(end).select(
            "first_page", F.unix_micros("e.to_updated_at").alias("at"), F.col("e.to_order_key").alias("key"), "e.batch_id"
        )
        return sorted(found.collect(), key=lambda row: row.first_page)

    def _copy_pages(self, run_id: str, first_page: int) -> None:
        """The pages of a group that begins."""
        self.capture.replace("pages", self._plan(run_id).read("pages").filter(F.col("first_page") == first_page))

    def _checkpoint(self, run_id: str, source: str, group: Row) -> None:
        """The one row that makes a group count."""
        number = max((row.number for row in self._rows(self.capture, "checkpoints")), default=0) + 1
        self.capture.replace_row(
            "checkpoints", run_id=run_id, first_page=group.first_page, number=number, source=source, updated_at=cap.at_literal(cap.utc(group.at)),
            order_key=group.key, batch_id=group.batch_id, finished_at=cap.at_literal(self.clock()),
        )

    def _prepare_messages(self, valid: DataFrame, event: Column, run_id: str, at: datetime, partition: Column | None) -> dict[int, list[Row]]:
        """Write the messages of all groups, numbered within the run; returns for each group where its numbers begin."""
        key = key_bytes(entity_key(F.col("order_key")))
        where = topic.partition_by_key(key) if partition is None else partition
        columns = [*cap.JOURNAL_COLUMNS, "batch_sequence", "number", "chunk", "first_page"]
        placed = topic.assign_offsets(valid.select(*columns).withColumn("partition", where)).withColumnRenamed("offset", "place")
        sent = topic.messages(placed.withColumns({"envelope": event, "timestamp": cap.at_literal(at)}))
        plan = self._plan(run_id)
        plan.replace("messages", sent.withColumn("partition", F.col("partition").cast("int")))
        begins = plan.read("messages").groupBy("first_page", "partition").agg(F.min("place").alias("place")).collect()
        found: dict[int, list[Row]] = {}
        for row in begins:  # one row for each group and partition
            found.setdefault(row.first_page, []).append(row)
        return found

    def _publish_prepared(self, run_id: str, first_page: int, begins: dict[int, list[Row]]) -> None:
        """Append the messages of a group to the topic, after what is there now."""
        number, ends = self._topic_ends()
        high = {(e.topic, e.partition): e.next for e in ends}
        shift = F.lit(0).cast("bigint")
        for row in begins.get(first_page, []):
            shift = F.when(F.col("partition") == row.partition, F.lit(high.get((topic.TOPIC, row.partition), 0) - row.place)).otherwise(shift)
        rows = self._plan(run_id).read("messages").filter(F.col("first_page") == first_page)
        self._append(rows.withColumn("offset", F.col("place") + shift), number, ends)

    # --- topic ---------------------------------------------------------------------------------------------
    def wire(self) -> DataFrame:
        if not self.topic.exists("wire"):
            return self.spark.createDataFrame([], schemas.WIRE)
        return topic.read_wire(self.spark, self.wire_path)

    def _topic_ends(self) -> tuple[int, list]:
        """The last recorded publication and the ends of the topic.

        Ends are facts of a publication. Only messages that are not covered by one are scanned: those of a publication
        that was interrupted between its messages and its row, or a topic that somebody else wrote.
        """
        rows = self.topic.read("publications").collect()  # one per publication
        last = max(rows, key=lambda row: row.publication, default=None)
        number, ends = (0, []) if last is None else (last.publication, last.ends)
        if not self.topic.exists("wire"):
            return number, ends
        later = self.topic.read("wire").filter((F.col("publication") > number) | F.col("publication").isNull())
        if last is not None:
            later = later.filter(F.col("publication") > number)
        found = later.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect()
        return number, _merged(ends, found)

    @_tidy
    def deliver(self, wire: DataFrame) -> None:
        """Append messages that have their offsets already."""
        self._append(wire, *self._topic_ends())

    def _append(self, wire: DataFrame, number: int, ends: list) -> None:
        number += 1
        self.topic.replace("wire", wire.withColumn("publication", F.lit(number).cast("bigint")))
        written = self.topic.read("wire").filter(F.col("publication") == number)
        found = written.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect()
        self.topic.replace_row("publications", publication=number, ends=_ends(_merged(ends, found)))

    # --- sink ------------------------------------------------------------------------------------------------
    def _next_id(self, known: list[Row]) -> int:
        return max([row.next_id for row in known] + [self._generation.next_id])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("source", "entity_key"), F.lit(self.buckets)).cast("int")

    @_tidy
    def materialize(self, wire: DataFrame, commit_id: str, hot_rows: int = HOT_ROWS) -> bool:
        """Classify one batch of deliveries against everything committed before, and commit it.

        A commit id that was used before does nothing, which makes a retried batch harmless. Of the registry and the current
        state, only the buckets of the batch's entities are read or written.
        """
        known = self._rows(self.sink, "batches")
        if any(row.batch == commit_id for row in known):
            return False
        batches = self._batches(known)
        if batches and batches[-1].buckets != self.buckets:
            raise ValueError(f"this folder has {batches[-1].buckets} buckets")
        received = receive(wire, self._next_id(known), topic.misplaced())
        first_id = received.next_delivery_id - sum(span.high - span.low + 1 for span in received.spans)
        checked, hot, registry = slim(validate(received.rows)), find_hot(received, hot_rows), None
        stage = f"{self.root}/stage/{uuid.uuid4()}-checked"
        if batches or hot is not None:
            checked = settled(checked, stage)
        if batches:
            registry = self.registry_of(touched(checked, self._bucket()), batches)
        rows = settle(checked, registry, hot, hot_rows).withColumns({"processed_at": cap.at_literal(self.clock()), "batch": F.lit(commit_id)})
        self.sink.replace("ledger", rows)
        written = self.sink.read("ledger").filter(F.col("batch") == commit_id)
        fresh = views.first_deliveries(written).withColumns({"bucket": self._bucket(), "batch": F.lit(commit_id)})
        self.sink.replace("registry", fresh.coalesce(_tasks(received.count)))
        self._upsert(written)
        forget(self.spark, stage)
        self._finish(known, commit_id, first_id, received.next_delivery_id, received.count, _after(batches, received.spans))
        return True

    def registry_of(self, buckets: list[int], batches: list[Row] | None = None) -> DataFrame:
        """The registry's part in some buckets; the others are not listed among the files to read."""
        return self.registry(batches).filter(F.col("bucket").isin(buckets)).drop("bucket", "batch")

    def _upsert(self, written: DataFrame) -> None:
        """Bring the accepted rows of a batch into the current state, bucket by bucket; other buckets stay as they are."""
        newer = views.accepted_states(written).withColumn("bucket", self._bucket())
        buckets = [row[0] for row in newer.select("bucket").distinct().collect()]
        held = self.sink.read("current").filter(F.col("bucket").isin(buckets))
        self.sink.replace("current", views.merge_current(held, newer))

    def admitted(self) -> list[Row]:
        """How far each partition was taken into the ledger, without a gap: (topic, partition, next)."""
        batches = self._batches()
        return batches[-1].ends if batches else []

    def admissible(self) -> DataFrame:
        """Messages of the topic table that come next in every partition, up to the first offset that is not there yet."""
        wire = self.wire()
        done = self.spark.createDataFrame([(e.topic, e.partition, e.next) for e in self.admitted()], "topic string, partition int, next bigint")
        ends = topic.gapless_ends(wire, done).collect()  # one row per partition
        spans = [(F.col("topic") == e.topic) & (F.col("partition") == e.partition) & F.col("offset").between(e.low, e.high - 1) for e in ends]
        return wire.filter(reduce(lambda a, b: a | b, spans, F.lit(False)))

    @_tidy
    def replay(self, name: str) -> DataFrame:
        """Deliver the whole topic again from offset 0: each measure before and after, and whether it is as it must be.

        Business state must not change; the log of deliveries must grow by what was read.
        """
        before = self.snapshot().withColumnRenamed("value", "before").collect()
        ends = topic.topic_offsets(self.wire())
        pinned = self.spark.createDataFrame(ends.collect(), ends.schema)  # one row per partition
        bounded = topic.read_bounded(self.wire(), pinned)
        read = bounded.count()
        self.materialize(bounded, f"replay-{name}")
        topic.assert_unchanged(pinned, self.wire())
        # A handful of measures.
        earlier = self.spark.createDataFrame(before, "measure string, before string")
        after = self.snapshot().withColumnRenamed("value", "after")
        grown = F.col("after").cast("bigint") - F.col("before").cast("bigint") == read
        same = F.col("before").eqNullSafe(F.col("after"))
        holds = F.when(F.col("measure") == "deliveries", grown).when(F.col("measure") == "rejections", F.lit(True)).otherwise(same)
        return earlier.join(after, "measure", "full_outer").withColumn("holds", holds)


def _tasks(rows: int) -> int:
    """At most so many tasks write rows that are only copied: few rows make few files."""
    return max(1, rows // FILE_ROWS)


def _merged(ends: list, newer: list) -> list[Row]:
    """Ends of all partitions; one never goes back."""
    found = {(e.topic, e.partition): e.next for e in ends}
    for e in newer:
        found[e.topic, e.partition] = max(e.next, found.get((e.topic, e.partition), 0))
    return [Row(topic=t, partition=p, next=n) for (t, p), n in sorted(found.items())]


def _after(batches: list[Row], spans: tuple[Span, ...]) -> list[Row]:
    return _merged(batches[-1].ends if batches else [], [Row(topic=s.topic, partition=s.partition, next=s.high + 1) for s in spans])


def _ends(ends: list) -> Column:
    cells = [F.struct(F.lit(e.topic).alias("topic"), F.lit(e.partition).alias("partition"), F.lit(e.next).alias("next")) for e in ends]
    return F.array(*cells).cast(_ENDS)
