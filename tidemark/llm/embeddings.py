"""Near-duplicate vectors by iterative quantisation and multi-index hashing.

* Rotations of the principal components are learned on a bounded sample of at most ``SAMPLE`` vectors, so that the
  signs of the rotated components lose as little as possible. Each rotation gives a code of up to 64 bits.
* Codes are cut into chunks of equal width; each chunk is the key of one table. Width, number of tables (and so of
  rotations) and the Hamming radius are derived from the threshold: for sample vectors, partners are made at a cosine
  of exactly the threshold, and enough tables are taken that ``RECALL`` of these hardest pairs share a bucket and lie
  within the radius. This is done for partners in any direction and for partners in directions of the data, and asked
  of the sample vectors nearest to the mean as well, whose pairs differ in the most bits after centring.
* If the cheapest such tables would compare more than a quarter of all pairs, or more than ``MOST_TABLES`` are needed,
  all pairs are compared in blocks. Hard vectors cost more; no pair is given up for it.
* Within a bucket, rows whose first codes are close to another one fetch their vectors, and all of those are compared
  in double precision. Only then a spanning forest of the true links leaves the task; its components are families. All
  vectors of a family are compared with each other, in blocks, which counts every link once.

Equal vectors are one row until the end, so a vector that is repeated very often costs nothing. The search is
approximate in the usual sense of Hamming retrieval; tests measure its recall. No bucket or family is cut short: large
ones are dealt out in blocks, and each pair of blocks is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialized, mixed, runs_of, ship, signed
from tidemark.llm.components import components
from tidemark.llm.jaccard import _forest

SAMPLE = 20_000
ROUNDS = 40
RECALL = 0.95
PAIRS = 4000
MOST_TABLES = 256
#: What one more row of a table costs, in comparisons.
ROW = 512
BLOCK = 1024


def learn(sample: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection whose signs are balanced binary codes of at most 64 bits."""
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    centred = sample - mean
    bits = min(64, sample.shape[1])
    _, vectors = np.linalg.eigh(centred.T @ centred)
    basis = vectors[:, ::-1][:, :bits]
    projected = centred @ basis
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(projected.T @ signs)
        rotation = left @ right
    return mean, basis @ rotation


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1. Scaled by a power of two first, so that squares of very large or small numbers stay finite."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0.0))
    vectors = np.ldexp(vectors, -exponent)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def partners(sample: np.ndarray, least: float, within: bool) -> np.ndarray:
    """For each vector one at a cosine of ``least``, in any direction or in the direction of another sample vector."""
    chosen = np.random.default_rng(11)
    away = sample[chosen.permutation(len(sample))] - sample if within else chosen.normal(size=sample.shape)
    away = away - (away * sample).sum(axis=1, keepdims=True) * sample
    size = np.linalg.norm(away, axis=1, keepdims=True)
    return least * sample + np.sqrt(1 - least * least) * np.divide(away, size, out=np.zeros_like(away), where=size > 1e-9)


class Plan:
    """Projections, chunk width and number of tables for n vectors; no tables if all pairs are to be compared.

    Rotations are added until the tables reach the recall. ``radius`` is for the codes of ``sketches`` rotations.
    """

    def __init__(self, sample: np.ndarray, least: float, n: int):
        self.mean, first = learn(sample)
        self.projections, self.width, self.tables, self.radius = [first], 0, 0, 0
        bits = first.shape[1]
        self.sketches = -(-64 // bits)
        some = sample[np.random.default_rng(3).permutation(len(sample))[:PAIRS]]
        if len(some) < 2 or not 0 < least < 1:
            return
        near_mean = np.linalg.norm(some - self.mean, axis=1)
        near_mean = near_mean <= np.quantile(near_mean, 0.25)
        made = [partners(some, least, within) for within in (False, True)]
        made = [(some[g], m[g]) for m in made for g in (np.ones(len(some), bool), near_mean)]
        best = None
        for width in range(1, min(32, bits) + 1):
            tables, share = self._tables(width, sample, some, made)
            cost = tables * (ROW + n * share) if tables else np.inf
            if best is None or cost < best[0]:
                best = cost, width, tables, share
            elif cost > 2 * best[0]:
                break
        cost, width, tables, share = best
        if tables and tables * share <= 0.25:
            self.width, self.tables = width, tables

    def _project(self, sample: np.ndarray, count: int) -> list[np.ndarray]:
        while len(self.projections) < count:
            self.projections.append(learn(sample, seed=7 + len(self.projections))[1])
        return self.projections[:count]

    def _signs(self, vectors: np.ndarray, projection: np.ndarray) -> np.ndarray:
        return codes_of(vectors, self.mean, projection)

    def _tables(self, width: int, sample: np.ndarray, some: np.ndarray, made: list) -> tuple[int, float]:
        """How many tables of this width reach the recall (0: too many), and the share of all pairs in one's buckets."""
        sketch = self._project(sample, self.sketches)
        apart = [sum(np.bitwise_count(self._signs(x, p) ^ self._signs(y, p)).astype(int) for p in sketch) for x, y in made]
        self.radius = max(int(np.quantile(d, 0.995)) for d in apart)
        chunks = self.projections[0].shape[1] // width
        met = [np.zeros(len(x), bool) for x, _ in made]
        shares, tables = [], 0
        while tables < MOST_TABLES:
            projection = self._project(sample, tables // chunks + 1)[tables // chunks]
            mask = chunk_mask(tables % chunks, width)
            if tables % chunks == 0:
                own = self._signs(some, projection)
                differ = [self._signs(x, projection) ^ self._signs(y, projection) for x, y in made]
            for m, d in zip(met, differ):
                m |= (d & mask) == 0
            held = np.unique(own & mask, return_counts=True)[1].astype(float)
            shares.append((held * (held - 1)).sum() / (len(own) * (len(own) - 1)))
            tables += 1
            if all((m & (d <= self.radius)).mean() >= RECALL for m, d in zip(met, apart)):
                return tables, float(np.mean(shares))
        return 0, 1.0


def chunk_mask(chunk: int, width: int) -> np.uint64:
    return np.uint64(((1 << width) - 1) << (chunk * width))


def codes_of(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = (vectors - mean) @ projection >= 0
    return (bits.astype(np.uint64) << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def usable(column: str) -> Column:
    """A vector with finite components only, not all of them zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _tables(shared):
    """(key, sketch, id) of each row in each table; the sketch has the codes that the radius is for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, projections, width, tables, sketches = shared.value
        chunks = projections[0].shape[1] // width
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            vectors = unit(vectors)
            codes = [codes_of(vectors, mean, p) for p in projections]
            sketch = np.ascontiguousarray(np.stack(codes[:sketches], axis=1))
            sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * sketches), len(sketch), [None, pa.py_buffer(sketch)]).cast(pa.binary())
            for t in range(tables):
                key = mixed((codes[t // chunks] & chunk_mask(t % chunks, width)) + mixed(np.array([t + 1], np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), sketch, batch.column("id")], ["key", "code", "id"])

    return run


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Differing bits of the sketches, the last axis of which are codes."""
    return sum(np.bitwise_count(one[..., i] ^ two[..., i]).astype(np.uint16) for i in range(one.shape[-1]))


def _near(radius: int, block: int):
    """Rows sorted by tile: those whose code is close to another one of their tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "tile", 4 * block):
            tile, second = rows.column("tile").to_numpy(), rows.column("second").to_numpy(zero_copy_only=False)
            code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(len(tile), -1)
            begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
            lengths = np.diff(np.r_[begins, len(tile)])
            keep = np.zeros(len(tile), bool)
            two = begins[lengths == 2]
            two = two[_apart(code[two], code[two + 1]) <= radius]
            keep[two] = keep[two + 1] = True
            for a, n in zip(begins[lengths > 2], lengths[lengths > 2]):
                which = second[a : a + n]
                close = _apart(code[a : a + n, None], code[None, a : a + n]) <= radius
                if which.any():  # two blocks: each is compared with itself in a tile of its own
                    close &= which[:, None] != which[None, :]
                else:
                    np.fill_diagonal(close, False)
                keep[a : a + n] = close.any(axis=1)
            if keep.any():
                yield pa.RecordBatch.from_arrays([rows.column(c).combine_chunks().filter(pa.array(keep)) for c in ("tile", "second", "id")], ["tile", "second", "id"])

    return run


def _linked(least: float):
    """Rows sorted by tile, vectors of one block or of two: edges that span all links of the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "tile", 2048):
            tile, second = rows.column("tile").to_numpy(), rows.column("second").to_numpy(zero_copy_only=False)
            ids = rows.column("id").to_numpy()
            vectors = _matrix(rows.column("vector"))
            vectors = unit(vectors)
            begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
            left, right = [], []
            for a, b in zip(begins, np.r_[begins[1:], len(tile)]):
                which = second[a:b]
                if not which.any():
                    near = vectors[a:b] @ vectors[a:b].T >= least
                else:
                    one, two = np.flatnonzero(~which), np.flatnonzero(which)
                    near = np.zeros((b - a, b - a), bool)
                    near[np.ix_(one, two)] = vectors[a + one] @ vectors[a + two].T >= least
                    near |= near.T
                x, y = _forest(near)
                left.append(ids[a + x])
                right.append(ids[a + y])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (left, right)], ["a", "b"])

    return run


def _count(least: float):
    """Rows sorted by tile, the vectors of one block or of two: how many rows of the other vectors each is linked with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "tile", 2048):
            tile, second = rows.column("tile").to_numpy(), rows.column("second").to_numpy(zero_copy_only=False)
            ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
            vectors = _matrix(rows.column("vector"))
            vectors = unit(vectors)
            links = np.zeros(len(ids), np.int64)
            begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
            for a, b in zip(begins, np.r_[begins[1:], len(tile)]):
                which = second[a:b]
                if not which.any():
                    near = vectors[a:b] @ vectors[a:b].T >= least
                    np.fill_diagonal(near, False)
                    links[a:b] = near @ copies[a:b]
                else:
                    one, two = a + np.flatnonzero(~which), a + np.flatnonzero(which)
                    near = vectors[one] @ vectors[two].T >= least
                    links[one], links[two] = near @ copies[two], near.T @ copies[one]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], ["id", "links"])

    return run


def in_blocks(rows: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Deal the rows of each group out to tiles: one for each block of the group and one for each pair of blocks."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(5)), F.greatest(blocks, F.lit(1))).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    tile = F.xxhash64(group, low, high)
    return dealt.withColumn("tile", tile).withColumn("second", (F.col("own") == high) & (low != high)).drop("own", "other")


def near_duplicates(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", least: float = 0.9, sample: int = SAMPLE, block: int = BLOCK
) -> DataFrame:
    """Link vectors by cosine: (id column, n_links, component_id, kept), one row for each input row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and are kept. Vectors of
    different lengths are compared within their length only. Equal vectors are linked. ``component_id`` is the smallest
    id that links reach; rows with a null id are not linked. Ids should be unique; other columns are not read.
    """
    spark = table.sparkSession
    ship(spark)
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.transform(vector_column, lambda x: x.cast("double")).alias("vector"))
    rows = rows.withColumn("usable", usable("vector") & F.col("id").isNotNull())
    good = rows.filter("usable").select("id", F.transform("vector", lambda x: x + 0.0).alias("vector"))
    single = materialized(good.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    edges = None
    lengths = [r["n"] for r in single.select(F.size("vector").alias("n")).distinct().collect()]
    for n in lengths:  # embeddings of one model have one length
        part = single.filter(F.size("vector") == n)
        found = _links(part, least, sample, block)
        edges = found if edges is None else edges.unionAll(found)
    if edges is None:
        family = single.select(F.col("rep").alias("id"), F.col("rep").alias("root"), F.lit(0).cast("long").alias("links")).limit(0)
    else:
        root = components(edges).select(F.col("node").alias("id"), "root")
        known = single.join(root, single["rep"] == root["id"]).select("id", "root", "vector", "copies")
        sizes = known.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
        tiles = in_blocks(known.join(sizes, "root"), "root", "size", block).select("tile", "second", "id", "copies", "vector")
        counted = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_count(least), "id long, links long")
        family = root.join(counted.groupBy("id").agg(F.sum("links").alias("links")), "id")
    # Copies have the links of the row that stands for them, and each other.
    stood = single.join(family, single["rep"] == family["id"], "left").select("vector", "copies", "links", F.coalesce("root", "rep").alias("component"))
    placed = good.join(stood, "vector").select(F.col("id").alias("own"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component")
    out = rows.select("id").join(placed, F.col("id") == F.col("own"), "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _links(single: DataFrame, least: float, sample: int, block: int) -> DataFrame:
    """Checked links (a, b) among distinct vectors of one length."""
    spark = single.sparkSession
    some = single.orderBy(F.xxhash64("rep")).limit(sample).select("vector").toArrow()  # a bounded sample
    vectors = _matrix(some.column("vector"))
    vectors = unit(vectors)
    n = single.count()
    plan = Plan(vectors, least, n)
    rows = single.select(F.col("rep").alias("id"), "vector")
    if plan.tables:
        projections = plan.projections[: max(plan.sketches, -(-plan.tables // (plan.projections[0].shape[1] // plan.width)))]
        shared = spark.sparkContext.broadcast((plan.mean, projections, plan.width, plan.tables, plan.sketches))
        coded = rows.mapInArrow(_tables(shared), "key long, code binary, id long")
        # Very large buckets are dealt out in blocks.
        sizes = coded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        tiles = in_blocks(coded.join(sizes, "key"), "key", "size", block).select("tile", "second", "code", "id")
        close = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_near(plan.radius, block), "tile long, second boolean, id long")
        # Only rows with a close code in their tile fetch their vectors.
        fetched = close.join(rows, "id").select("tile", "second", "id", "vector")
    else:
        whole = rows.withColumn("key", F.lit(0).cast("long")).withColumn("size", F.lit(n))
        fetched = in_blocks(whole, "key", "size", block).select("tile", "second", "id", "vector")
    return fetched.repartition("tile").sortWithinPartitions("tile").mapInArrow(_linked(least), "a long, b long")
