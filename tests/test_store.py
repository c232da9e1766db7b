"""Rows that are worked out once, and stored rows."""

import os

from pyspark.sql import functions as F

from tidemark.functions.validation import journal_errors
from tidemark.operators.capture import check_rows, valid_events
from tidemark.operators.classify import settled
from tidemark.schemas import JOURNAL
from tidemark.sources import store
from tidemark.sources.wire import assign_offsets


def test_offsets_work_out_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(900, numPartitions=3).select(
        (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("number"), F.floor(F.col("id") / 64).alias("chunk")
    )
    placed = assign_offsets(rows.mapInArrow(passing, rows.schema))
    assert placed.agg(F.sum("offset")).first()[0] == 3 * sum(range(300))
    got = [(r["partition"], r["number"], r["offset"]) for r in placed.collect()]
    assert sorted(got) == sorted((i % 3, i, i // 3) for i in range(900))
    assert seen.value == 900


def test_settled_rows_are_compressed_files_without_a_checkpoint(spark, folder):
    rows = spark.range(1000, numPartitions=2).select("id", F.lit("the same long text " * 40).alias("value"))
    kept = settled(rows, f"{folder}/rows")
    assert kept.rdd.isCheckpointed() is False and sorted(kept.collect()) == sorted(rows.collect())
    size = sum(os.path.getsize(f"{folder}/rows/{name}") for name in os.listdir(f"{folder}/rows"))
    assert 0 < size < 50_000
    store.forget(spark, f"{folder}/rows")
    assert not os.path.exists(f"{folder}/rows")


def test_valid_rows_are_those_without_errors(spark):
    right = (1, 2, "n", "O", "1.00", "2024-01-01", 1, "2024-01-01 00:00:00", "insert")
    wrong = {0: (None, 0, -1), 1: (None, 0), 2: (None, "", "x" * 201), 3: (None, "X"), 4: (None, "-1.00"), 5: (None,), 6: (None, 0), 8: (None, "delete")}
    rows = [right] + [(*right[:i], value, *right[i + 1 :]) for i, values in wrong.items() for value in values]
    names = [part.split()[0] for part in JOURNAL.split(", ")]
    kinds = [part.split()[1] for part in JOURNAL.split(", ")]
    text = "order_key bigint, customer_key bigint, customer_name string, order_status string, total_price string, order_date string, source_version bigint, source_updated_at string, event_type string"
    frame = spark.createDataFrame(rows, text).select(*(F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)), F.lit(1).alias("batch_sequence"))
    checked = check_rows(frame, "shop", "00000000-0000-4000-8000-000000000001")
    assert valid_events(checked).count() == frame.filter(F.size(journal_errors()) == 0).count() == 1
