"""Source-side writers: seed, append, mutate and clone orders, each with its journal entries.

Every writer takes the current snapshot and the journal and returns the new snapshot and the journal rows to
append. An update is a projection over the snapshot; nothing is looped over.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tidemark.operators.capture import high_watermark
from tidemark.operators.numbering import sort_and_number
from tidemark.schemas import MONEY


class Written(NamedTuple):
    current: DataFrame
    journal_rows: DataFrame


class WriteRefused(RuntimeError):
    """The source is not in the state that the writer needs. Nothing was changed."""


def sample(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Sample orders with their customers, as payload columns."""
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "inner")
    return joined.select(
        F.col("o_orderkey").cast("bigint").alias("order_key"),
        F.col("c_custkey").cast("bigint").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("total_price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def first_orders(rows: DataFrame, n: int | None) -> DataFrame:
    """The ``n`` rows with the lowest order keys (all rows for ``None``), without gathering them in one task.

    Only the keys, which are unique, are sorted; the rows are filtered by the n-th of them.
    """
    if n is None:
        return rows
    if n < 1:
        return rows.limit(0)
    last = sort_and_number(rows.select("order_key"), "_n", ["order_key"]).filter(F.col("_n") == n).select("order_key").first()
    return rows if last is None else rows.filter(F.col("order_key") <= last[0])


def _inserted(rows: DataFrame, stamp: datetime | Column) -> DataFrame:
    at = stamp if isinstance(stamp, Column) else F.lit(stamp).cast("timestamp")
    return rows.select(
        "*",
        F.lit(1).cast("bigint").alias("source_version"),
        at.alias("source_updated_at"),
        F.lit("insert").alias("event_type"),
    )


def seed_source(
    orders: DataFrame,
    customer: DataFrame,
    n: int | None,
    stamp: datetime | Column,
    existing: tuple[DataFrame, DataFrame] | None = None,
) -> Written:
    """Join orders with customers, take the first ``n`` by key at version 1 with one shared stamp.

    Refuses if ``existing`` (current, journal) already holds rows.
    """
    if existing is not None and not all(table.isEmpty() for table in existing):
        raise WriteRefused("seeding needs empty tables")
    rows = _inserted(first_orders(sample(orders, customer), n), stamp)
    return Written(rows, rows)


def next_stamp(journal: DataFrame, now: datetime) -> datetime:
    """Not before ``now`` and strictly after everything in the journal."""
    high = high_watermark(journal)
    return now if high is None else max(now, high.source_updated_at + timedelta(microseconds=1))


def append_unused(
    current: DataFrame, journal: DataFrame, orders: DataFrame, customer: DataFrame, n: int | None, now: datetime
) -> Written:
    """The next ``n`` sample orders whose key is unused. An exhausted sample adds nothing."""
    if current.isEmpty() or journal.isEmpty():
        raise WriteRefused("appending needs a prepared source")
    unused = sample(orders, customer).join(current.select("order_key"), "order_key", "left_anti")
    added = _inserted(first_orders(unused, n), next_stamp(journal, now))
    return Written(current.unionByName(added), added)


def mutate_source(current: DataFrame, journal: DataFrame, now: datetime) -> Written:
    """One new order cloned from the lowest, the three lowest +1.00, then the lowest again +2.00.

    Both versions of the lowest order reach the journal, one microsecond apart. The snapshot is one projection of the
    old one and a row more.
    """
    spark = current.sparkSession
    kept = [name for name in current.columns if name not in ("source_version", "source_updated_at", "event_type")]
    lowest = current.select(*kept, "source_version").orderBy("order_key").limit(3).collect()
    if len(lowest) < 3:
        raise WriteRefused("mutating needs at least three orders")
    stamp = next_stamp(journal, now)
    later = stamp + timedelta(microseconds=1)
    new_key = current.agg(F.max("order_key")).first()[0] + 1
    one = lowest[0].asDict()
    written = [(dict(one, order_key=new_key), 1, stamp, "insert")]
    for row in lowest:
        raised = dict(row.asDict(), total_price=row["total_price"] + 1)
        written.append((raised, row["source_version"] + 1, stamp, "update"))
    written.append((dict(one, total_price=one["total_price"] + 3), one["source_version"] + 2, later, "update"))
    schema = current.select(*kept, "source_version").schema
    values = [tuple(row[name] for name in kept) + (version,) for row, version, _, _ in written]
    entry = F.col("_n")
    at, said = F.lit(None).cast("timestamp"), F.lit(None).cast("string")
    numbered = spark.createDataFrame([(*v, n) for n, v in enumerate(values)], schema.add("_n", IntegerType()))
    for n, (_, _, when, kind) in enumerate(written):
        at, said = F.when(entry == n, F.lit(when).cast("timestamp")).otherwise(at), F.when(entry == n, F.lit(kind)).otherwise(said)
    journal_rows = numbered.withColumns({"source_updated_at": at, "event_type": said}).drop("_n").select(*current.columns)

    # What the journal says last about each of the three orders, as an update of the snapshot's columns.
    steps = {row["order_key"]: (1, 1, stamp) for row in lowest} | {one["order_key"]: (3, 2, later)}
    price, version, updated, kind = (F.col(c) for c in ("total_price", "source_version", "source_updated_at", "event_type"))
    for key, (amount, versions, when) in steps.items():
        hit = F.col("order_key") == key
        price = F.when(hit, (F.col("total_price") + amount).cast(MONEY)).otherwise(price)
        version = F.when(hit, F.col("source_version") + versions).otherwise(version)
        updated = F.when(hit, F.lit(when).cast("timestamp")).otherwise(updated)
        kind = F.when(hit, F.lit("update")).otherwise(kind)
    changed = current.withColumns({"total_price": price, "source_version": version, "source_updated_at": updated, "event_type": kind})
    return Written(changed.unionByName(journal_rows.filter(F.col("event_type") == "insert")), journal_rows)


def clone_orders(
    current: DataFrame, journal: DataFrame, k: int, now: datetime, today: date | None = None
) -> Written:
    """``k`` new orders cloned from the lowest one, with consecutive new keys and today's date."""
    if current.isEmpty():
        raise WriteRefused("cloning needs a prepared source")
    kept = ["customer_key", "customer_name", "order_status", "total_price"]
    found = current.agg(F.max("order_key").alias("last"), F.min_by(F.struct(*kept), F.col("order_key")).alias("seed")).first()
    day = F.lit(today) if today is not None else F.current_date()
    types = {field.name: field.dataType for field in current.schema.fields}
    keys = current.sparkSession.range(found["last"] + 1, found["last"] + 1 + k)
    clones = keys.select(
        F.col("id").alias("order_key"),
        *[F.lit(found["seed"][name]).cast(types[name]).alias(name) for name in kept],
        day.alias("order_date"),
    )
    added = _inserted(clones, next_stamp(journal, now))
    return Written(current.unionByName(added), added)
