"""Dense numbers over large ordered data without a single-task sort.

A global ``row_number`` would pull the whole table (or a whole group) into one task. Here the rows are first
cut into *chunks* that are ordered among themselves and small enough for one task; each row gets its rank
inside the chunk plus the size of all earlier chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.session import scratch_folder
from tidemark.sources.store import stored


def number_in_chunks(
    df: DataFrame,
    out: str,
    order: Sequence[str | Column],
    chunk: Sequence[str],
    group: Sequence[str] = (),
    store: bool = False,
) -> DataFrame:
    """Add ``out`` = 1, 2, ... per ``group`` in the order of ``chunk`` and then ``order``.

    ``chunk`` must be a function of the row's data (or of checkpointed columns) that follows the order, with
    few enough distinct values for one row per chunk to be sorted per group, and no NULLs. Counting is a
    partial aggregation; only the chunk sizes cross the second shuffle. With ``store`` the ranked rows are stored:
    ``df`` is worked out once, however often the numbers are read, and the chunk sizes (few, then) are broadcast.
    """
    keys = [*group, *chunk]
    before = W.partitionBy(*group).orderBy(*chunk).rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(inside))
    counted = df
    if store:
        ranked = counted = stored(ranked)
    base = (
        counted.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    return (
        ranked.join(F.broadcast(base) if store else base, keys)
        .withColumn(out, F.col("_base") + F.col("_rank"))
        .drop("_rank", "_base")
    )


def stage_sorted(df: DataFrame, order: Sequence[str], folder: str, partitions: int | None = None) -> DataFrame:
    """Sort a table by range into ``folder``: Parquet partitioned by ``chunk``, with ``row`` as the place inside it.

    Chunks are ordered among themselves. The rows are shuffled and written once; whoever numbers or checks them reads the
    narrow columns, and whoever needs a part of the table reads its chunks.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    place = F.monotonically_increasing_id()
    placed = ranged.sortWithinPartitions(*order).withColumn("_place", place)
    chunk, row = F.shiftright("_place", 33).cast("int"), F.col("_place").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumns({"chunk": chunk, "row": row}).drop("_place")
    placed.write.partitionBy("chunk").parquet(folder)
    schema = StructType([*(field for field in placed.schema if field.name != "chunk"), StructField("chunk", IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(folder)


def number_staged(staged: DataFrame, out: str) -> DataFrame:
    """Add ``out`` = 1, 2, ... in the order of a staged table: the row's place and the sizes of earlier chunks."""
    before = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    base = (
        staged.groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    # One row per chunk: the number of shuffle partitions bounds the broadcast.
    return staged.join(F.broadcast(base), "chunk").withColumn(out, F.col("_base") + F.col("row") + 1).drop("_base")


def sort_and_number(df: DataFrame, out: str, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1, 2, ... over the whole table in the order of ``order``; also ``chunk``.

    ``chunk`` is an ordered, evenly sized cut of the data.
    """
    staged = stage_sorted(df, order, f"{scratch_folder(df.sparkSession)}/sorted", partitions)
    return number_staged(staged, out).drop("row")
