"""Document fingerprints from closed syncmers.

A k-mer of code points is chosen when its smallest inner s-mer stands at one of its two edges. The choice depends on
the k-mer alone, so that the same passage gives the same anchors in any document and at any place: unlike window
minima, a neighbouring edit cannot move them. Anchors can be matched in order (``aligned``); a fingerprint is the
smallest hashes of the anchors, from which the share of common anchors of two documents is estimated.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BASES, mixed, shuffle_partitions, ship, whole_text

K = 10
S = 5
SIZE = 64
SHORT, FINE = 100, (4, 2)


def _rolled(codes: np.ndarray, starts: np.ndarray | None, length: int) -> np.ndarray:
    """Hashes of spans of code points, at all places or at the given ones."""
    base, total = np.uint64(BASES[1]), np.uint64(0)
    for i in range(length):
        part = codes[i : len(codes) - length + 1 + i] if starts is None else codes[starts + i]
        total = total * base + part
    return mixed(total)


def _syncmers(codes: np.ndarray, k: int, s: int) -> np.ndarray:
    """Places of the closed syncmers."""
    if len(codes) < k:
        return np.zeros(0, np.int64)
    inner = _rolled(codes, None, s)
    wide, least, span = k - s + 1, inner, 1
    while span < wide:  # minima of windows of doubling width
        step = min(span, wide - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    n = len(least)
    return np.flatnonzero((inner[:n] == least) | (inner[wide - 1 : wide - 1 + n] == least))


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places (code points) and 32-bit hashes of the closed syncmers of a text.

    A text of fewer than ``SHORT`` code points also gets those of a finer scale. A text that has none has one anchor:
    itself. The empty text has no anchor.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    places, hashes = [], []
    for k, s in ((K, S), FINE) if len(codes) < SHORT else ((K, S),):
        found = _syncmers(codes, k, s)
        places.append(found)
        hashes.append((_rolled(codes, found, k) >> np.uint64(32)).astype(np.uint32) if len(found) else np.zeros(0, np.uint32))
    if not sum(map(len, places)):
        return np.zeros(1, np.int64), (_rolled(codes, None, len(codes)) >> np.uint64(32)).astype(np.uint32)
    return np.concatenate(places), np.concatenate(hashes)


def aligned(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Places of equal anchors in the same order in both texts: the longest chain over anchors that each text has once."""
    def single(side):
        values, first, counts = np.unique(side[1], return_index=True, return_counts=True)
        return {int(v): int(side[0][i]) for v, i, c in zip(values, first, counts) if c == 1}

    a, b = single(left), single(right)
    pairs = sorted((a[h], b[h]) for h in a.keys() & b.keys())
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        at = bisect.bisect_left(tails, y)
        if at == len(tails):
            tails.append(y)
            ends.append(i)
        else:
            tails[at], ends[at] = y, i
        before[i] = ends[at - 1] if at else -1
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(pairs[i])
        i = before[i]
    return chain[::-1]


def fingerprint(text: str, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest hashes, ascending, of the anchors with their repetition: the second equal anchor differs
    from the first, so that a text which repeats itself is compared as a whole."""
    hashes = np.sort(anchors(text)[1])
    if not len(hashes):
        return hashes
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    repeat = np.arange(len(hashes)) - np.repeat(first, np.diff(np.r_[first, len(hashes)]))
    return np.unique((mixed(hashes.astype(np.uint64) << np.uint64(32) | repeat.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32))[:size]


def spelled(mark: np.ndarray) -> str:
    return mark.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of common anchors, 2 * common / (all of a + all of b); exact while both have at most ``size``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    joint = np.unique(np.concatenate([a, b]))[:size]
    common = len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), joint, assume_unique=True))
    jaccard = common / len(joint)
    return 2 * jaccard / (1 + jaccard)


def _bucket(documents: DataFrame, cuts: list[float]) -> DataFrame:
    """Add ``bucket``, which follows the order of ``id``; null ids come first."""
    if not cuts:
        return documents.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(0).cast("int"))
    splits = [float("-inf"), *cuts, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="place", outputCol="found", handleInvalid="keep").transform(
        documents.withColumn("place", F.col("id").cast("double"))
    )
    bucket = F.when(F.col("id").isNull(), -1).otherwise(F.col("found").cast("int"))
    return placed.withColumn("bucket", bucket).drop("place", "found")


def fingerprint_documents(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", edited: Column | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the neighbour's are.

    The neighbour is the next row by descending id (equal ids: by text; null ids last); after the last row comes the
    first. The edited text has its last third replaced by the neighbour's first as many code points. Returns the id
    column, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.
    A null text is empty; an empty text has an empty fingerprint, like only to another empty one. A single row is its
    own neighbour. Repeated rows are kept. Other columns are not read.

    Texts are shuffled once: rows go to ranges of ids, and the first row of each range is also sent to the range
    before it. The driver sees one id for each range, a multiple of the number of shuffle partitions.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("body"))
    ranges = 4 * shuffle_partitions(spark)
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.select(F.percentile_approx("id", shares, 10 * ranges).alias("cuts")).first()["cuts"] or []
    rows = _bucket(rows, sorted({float(c) for c in found}))

    firsts = sorted((r["bucket"], r["most"]) for r in rows.groupBy("bucket").agg(F.max("id").alias("most")).collect())
    # By descending id, range i is followed by range i - 1, and the lowest by the highest.
    after = [(firsts[i - 1][1], bucket) for i, (bucket, _) in enumerate(firsts)]
    edge = F.broadcast(spark.createDataFrame(after, "most long, target int"))  # one row for each range
    heads = (
        rows.join(edge, rows["id"].eqNullSafe(edge["most"]))
        .groupBy("target")
        .agg(F.min("body").alias("body"))
        .select(F.lit(None).cast("long").alias("id"), "body", F.col("target").alias("bucket"), F.lit(1).alias("extra"))
    )
    dealt = (
        rows.withColumn("extra", F.lit(0))
        .unionByName(heads)
        .repartition("bucket")
        .sortWithinPartitions(F.col("bucket"), F.col("extra"), F.col("id").desc_nulls_last(), F.col("body"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row, whose neighbour has not come yet
        for batch in batches:
            ids, texts, buckets, extras = (batch.column(c) for c in ("id", "body", "bucket", "extra"))
            out: list[tuple] = []
            for i in range(batch.num_rows):
                text, bucket = texts[i].as_py(), buckets[i].as_py()
                mark = fingerprint(text)
                if waiting is not None and waiting[0] == bucket:
                    _, own_id, own, own_mark = waiting
                    third = len(own) // 3
                    changed = own[: len(own) - third] + text[:third]
                    changed_mark = fingerprint(changed)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((own_id, len(own), digest, spelled(own_mark), spelled(changed_mark), likeness(own_mark, changed_mark), likeness(own_mark, mark)))
                waiting = (bucket, ids[i].as_py(), text, mark) if not extras[i].as_py() else None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES)

    return dealt.mapInArrow(run, _SCHEMA).withColumnRenamed("id", id_column)


_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
