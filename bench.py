"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

``sync`` and ``materialize`` run the durable pipeline (journal to topic, topic to ledger); the read queries then
use its ledger, as they would in operation. The remaining entries are named queries that start from the raw
tables. A first pass over a small input loads classes and compiles code and is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import checks, inspect, views  # noqa: E402
from tidemark.plans import fixture  # noqa: E402
from tidemark.plans.pipeline import Pipeline  # noqa: E402
from tidemark.plans.queries import all_queries  # noqa: E402
from tidemark.schemas import JOURNAL  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import wire as topic  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
NAMED = ("seed_source", "mutate_source", "plan_pages", "quarantine_rows", "watermarks", "source_sink_diff")


def noop(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def run(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    captured = Pipeline(spark, f"{root}/captured")
    # The stored inputs of the pipeline: a journal table and a topic table. Writing them is not timed.
    fixture.journal(spark, sf_dir).repartition(int(CPUS)).write.parquet(f"{root}/journal")
    journal = spark.read.schema(JOURNAL).parquet(f"{root}/journal")
    rows["sync"] = timed("sync", lambda: captured.sync(journal, fixture.SOURCE))

    pipeline = Pipeline(spark, f"{root}/delivered")
    fixture.wire(spark, sf_dir).repartition(int(CPUS)).write.parquet(pipeline.wire_path)
    rows["materialize"] = pipeline.wire().count()
    timed("materialize", lambda: pipeline.materialize(pipeline.wire(), "first"))
    ledger = pipeline.ledger()
    timed("counts_by_type", lambda: inspect.counts_by_type(ledger).collect())
    timed("counts_total", lambda: inspect.counts_with_total(ledger).collect())
    timed("processing_delay", lambda: inspect.processing_delay(ledger).collect())
    timed("orders_current", lambda: noop(pipeline.orders_current()))
    timed("processed_events", lambda: noop(views.processed_events(ledger)))
    timed("rejections_by_reason", lambda: checks.rejections_by_reason(ledger).collect())
    timed("events_page", lambda: pipeline.events_page(500, source=fixture.SOURCE, event_type="insert"))
    timed("entity_view", lambda: pipeline.entity_view("order:1155", fixture.SOURCE))
    timed("state_fingerprint", lambda: checks.state_fingerprint(views.orders_current(ledger)).collect())
    timed("constraint_violations", lambda: checks.check_constraints(
        {"event_deliveries": ledger, "processed_events": views.processed_events(ledger),
         "orders_current": views.orders_current(ledger), "event_rejections": views.rejections(ledger)}).collect())
    timed("partition_offsets", lambda: topic.topic_offsets(pipeline.wire()).collect())
    rows["replay"] = rows["materialize"]
    timed("replay", lambda: pipeline.materialize(pipeline.wire(), "second"))
    for name in NAMED:
        timed(name, lambda: noop(all_queries()[name](spark, sf_dir)))
    return seconds, rows


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS))
    if os.path.isdir(WARM_DIR):
        run(spark, WARM_DIR)
    seconds, rows = run(spark, SF_DIR)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": {name: round(count / seconds[name]) for name, count in rows.items()},
        "rows": rows,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
