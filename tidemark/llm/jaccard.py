"""Exact join of documents whose sets of word shingles have a Jaccard similarity of a given percentage or more.

The Jaccard distance is a metric. The join works on distinct sets (copies share one) in three steps:

1. *Voronoi regions of rare pivots.* The pivots are the sets {s} of one shingle. A document's distance to {s} is
   1 - 1/n if it holds s, else 1, so its nearest pivots are its own shingles; ties go to the rarer shingle. (Whole
   documents are no use as pivots here: nearly all distances between documents of a corpus are 1, so that all windows
   would hold all documents.) By the triangle inequality, a partner within the distance e lacks at most m = n * e of a
   document's shingles, so the document is replicated into the windows of its m + 1 nearest pivots, and any two linked
   documents meet in the region of the first pivot they share. There, pairs of too different sizes or with too little
   left to share are passed over, and what remains is chained into *families*. Counting how rare a shingle is uses a
   fixed share of the hash space; any total order makes the regions exact.
2. *Recursion inside families*, whose members are close enough for documents to be pivots: members go to the region of
   their nearest pivot and, within twice the distance, to the windows of others, until regions are small. Where windows
   hold almost everything, the region is compared as it is, in blocks.
3. *Components* of the links. Within a block only a spanning forest of the links leaves the task.

Families beyond ``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles are cut into blocks by a hash; each pair of blocks
is one task's work, so no task holds a whole large family.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SpanHash, drawn_base, freeing, lower_ascii, materialized, mixed, runs_of, ship, signed, slices, text_buffer, whole_text
from tidemark.llm.components import components

MANY = 4096
REGION = 1024
BLOCK_SETS = 512
BLOCK_SHINGLES = 1_000_000
LEAF = 192
PIVOTS = 4
SLICE = 1 << 19



def spare_of(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of n shingles a linked set may lack."""
    return n * (100 - percent) // 100


def counted_below(size: int, percent: int) -> np.uint64:
    """Shingles with hashes below are counted: twice the share that a linked set may lack, or, as long shingles are
    rare anyway, one and a half times. The share decides how selective regions are, not what they find."""
    times = 150 if size >= 5 else 200
    return np.uint64(min((1 << 64) - 1, (1 << 64) * times * (100 - percent) // 10_000))


_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int, base: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of texts that stand end to end, sorted by row and hash.

    Words are runs of bytes other than ASCII white space. A text of fewer words than ``size`` has one shingle, all of
    them; a text without words has none.
    """
    nothing = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if not len(data):
        return nothing
    inside = ~_BREAK[data]
    border = np.zeros(len(data) + 1, bool)
    border[starts] = True
    begin = np.flatnonzero(inside & (border[:-1] | np.r_[True, ~inside[:-1]]))
    end = np.flatnonzero(inside & (border[1:] | np.r_[~inside[1:], True])) + 1
    if not len(begin):
        return nothing
    word = SpanHash(data, base=base).of(begin, end)
    row = np.searchsorted(starts[1:], begin, side="right")
    first = np.searchsorted(row, np.arange(len(starts) - 1))
    words = np.diff(np.r_[first, len(row)])
    value = np.zeros(len(word), np.uint64)
    reach = np.minimum(words, size)[row]  # words in the shingle
    for i in range(size):
        at = np.minimum(np.arange(len(word)) + i, len(word) - 1)
        value = np.where(i < reach, mixed(value + word[at] * np.uint64(2 * i + 1)), value)
    place = np.arange(len(word)) - first[row]
    whole = place + reach <= words[row]
    row, value = row[whole], mixed(value[whole] + reach[whole].astype(np.uint64))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]
    return row[new], value[new]


def _sets(batch: pa.RecordBatch, size: int, base: int) -> Iterator[tuple]:
    """For slices of a batch: (first row, counts, set ids, row, hash)."""
    data, starts = text_buffer(batch.column("body"))
    for i, j in slices(starts, SLICE):
        part = starts[i : j + 1] - starts[i]
        row, value = shingle_sets(data[starts[i] : starts[j]], part, size, base)
        count = np.bincount(row, minlength=j - i)
        sums = np.zeros(j - i, np.uint64)
        if len(row):
            filled = np.flatnonzero(count)
            sums[filled] = np.add.reduceat(mixed(value ^ np.uint64(0x5851F42D4C957F2D)), np.r_[0, np.cumsum(count[filled])[:-1]])
        yield i, count, signed(mixed(sums + count.astype(np.uint64))), row, value


def _profile(size: int, base: int):
    """The size and the id of each document's set; a document without words has no set id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, count, key, _, _ in _sets(batch, size, base):
                ids = batch.column("id").slice(i, len(count))
                yield pa.RecordBatch.from_arrays([ids, pa.array(count), pa.array(key, mask=count == 0)], ["id", "n", "key"])

    return run


def _rare(size: int, percent: int, base: int):
    """(shingle, set id, set size, counted shingles of the set): the counted ones, filled up to a window's length."""
    limit = counted_below(size, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, count, key, row, value in _sets(batch, size, base):
                once = np.zeros(len(count), bool)
                once[np.unique(key, return_index=True)[1]] = True  # one of equal sets
                counted = np.bincount(row[value < limit], minlength=len(count))
                first = np.r_[0, np.cumsum(count)[:-1]]
                # Hashes ascend in a row, so the counted ones come first and the fill-up follows.
                taken = np.maximum(counted, spare_of(count, percent) + 1)
                place = np.arange(len(row)) - first[row]
                keep = (place < taken[row]) & once[row]
                r = row[keep]
                yield pa.RecordBatch.from_arrays([pa.array(signed(value[keep])), pa.array(key[r]), pa.array(count[r].astype(np.int32)), pa.array(counted[r].astype(np.int32))], ["shingle", "key", "n", "counted"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shingle, key): those of shingles that at least two sets have, with their number up to MANY."""
    names = ["shingle", "key", "n", "counted"]

    def give(parts: list[pa.Table], count: np.ndarray | int) -> pa.RecordBatch:
        rows = pa.concat_tables(parts).combine_chunks()
        many = pa.array(np.broadcast_to(np.asarray(count, np.int32), rows.num_rows))
        return pa.RecordBatch.from_arrays([*(rows.column(c).combine_chunks() for c in names), many], [*names, "many"])

    last, held, size = None, [], 0  # the run that may go on
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        shingle, key = rows.column("shingle").to_numpy(), rows.column("key").to_numpy()
        new = np.r_[True, (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])]
        if len(new) and last == (shingle[0], key[0]):
            new[0] = False
        rows = rows.filter(pa.array(new))
        if not rows.num_rows:
            continue
        shingle = rows.column("shingle").to_numpy()
        begins = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        lengths = np.diff(np.r_[begins, len(shingle)])
        if last is not None and shingle[0] == last[0]:
            held.append(rows.slice(0, lengths[0]))
            size += lengths[0]
            if size >= MANY:
                yield give(held, MANY)
                held = []
            begins, lengths = begins[1:], lengths[1:]
        last = (shingle[-1], rows.column("key")[-1].as_py())
        if not len(begins):
            continue
        if held and size >= 2:
            yield give(held, size)
        middle = np.repeat(lengths, lengths)
        inner = rows.slice(begins[0], begins[-1] - begins[0])
        middle = middle[: inner.num_rows]
        if (middle > 1).any():
            yield give([inner.filter(pa.array(middle > 1))], np.minimum(middle[middle > 1], MANY))
        held, size = [rows.slice(begins[-1])], int(lengths[-1])
        if size >= MANY:
            yield give(held, MANY)
            held = []
    if held and size >= 2:
        yield give(held, min(size, MANY))


def _windows(size: int, percent: int):
    """Rows sorted by (key, many, shingle): those in the window of the set's nearest pivots, with their place there."""
    limit = counted_below(size, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "key"):
            key, shingle = rows.column("key").to_numpy(), rows.column("shingle").to_numpy()
            n, counted = rows.column("n").to_numpy(), rows.column("counted").to_numpy()
            rare = shingle.view(np.uint64) < limit
            order = np.lexsort((~rare, key))  # stable: by number and shingle within the counted ones
            key, shingle, n, counted, rare = key[order], shingle[order], n[order], counted[order], rare[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            lengths = np.diff(np.r_[first, len(key)])
            shared = np.add.reduceat(rare.astype(np.int64), first)
            rank = np.arange(len(key)) - np.repeat(first, lengths)
            # Shingles that no other set has come first and are not in these rows.
            place = np.where(rare, counted - np.repeat(shared, lengths) + rank, counted)
            keep = place <= spare_of(n, percent)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (shingle, key, n, place.astype(np.int32))], ["shingle", "key", "n", "place"])

    return run


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest edges of a symmetric link matrix."""
    g = len(near)
    root = np.full(g, -1)
    left, right = [], []
    for seed in range(g):
        if root[seed] >= 0:
            continue
        root[seed], queue = seed, [seed]
        while queue:
            x = queue.pop()
            found = np.flatnonzero(near[x] & (root < 0))
            root[found] = seed
            queue += found.tolist()
            left += [seed] * len(found)
            right += found.tolist()
    return np.array(left, np.int64), np.array(right, np.int64)


def _families(percent: int):
    """Rows sorted by shingle: edges that chain the sets of a region that may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(a, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        last, hub, held, size = None, None, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            if size > 1 and held:
                key, n, place = (np.concatenate([h[c] for h in held]) for c in range(3))
                yield from compare(key, n.astype(np.int64), place.astype(np.int64))

        def compare(key, n, place):
            rest = n - place
            near = np.minimum.outer(n, n) * 100 >= np.maximum.outer(n, n) * percent
            near &= np.minimum.outer(rest, rest) * (100 + percent) >= np.add.outer(n, n) * percent
            left, right = _forest(near)
            if len(left):
                yield give(key[left], key[right])

        for batch in batches:
            shingle = batch.column("shingle").to_numpy()
            if not len(shingle):
                continue
            key, n, place = (batch.column(c).to_numpy() for c in ("key", "n", "place"))
            begins = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
            lengths = np.diff(np.r_[begins, len(shingle)])
            # Regions of two that end in this batch: all at once.
            two = begins[1:-1][lengths[1:-1] == 2]
            if len(two):
                x, y = n[two].astype(np.int64), n[two + 1].astype(np.int64)
                rest = np.minimum(x - place[two], y - place[two + 1])
                near = (np.minimum(x, y) * 100 >= np.maximum(x, y) * percent) & (rest * (100 + percent) >= (x + y) * percent)
                if near.any():
                    yield give(key[two[near]], key[two[near] + 1])
            others = np.flatnonzero((lengths > 2) | np.isin(np.arange(len(begins)), (0, len(begins) - 1)))
            for a, length in zip(begins[others].tolist(), lengths[others].tolist()):
                b = a + length
                if shingle[a] != last:
                    yield from close()
                    last, hub, held, size = shingle[a], key[a], [], 0
                size += length
                if size > REGION:  # too many to compare here: chained as they are
                    for h in held:
                        yield give(np.full(len(h[0]), hub), h[0])
                    held = []
                    yield give(np.full(length, hub), key[a:b])
                else:
                    held.append((key[a:b], n[a:b], place[a:b]))
        yield from close()

    return run


def _set_of(size: int, base: int):
    """(key, n, set) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, count, key, row, value in _sets(batch, size, base):
                ends = np.cumsum(count)
                sets = [value[e - c : e].tobytes() for c, e in zip(count, ends)]
                carried = [batch.column(c).slice(i, len(count)) for c in ("family", "blocks", "wanted")]
                yield pa.RecordBatch.from_arrays([*carried, pa.array(key), pa.array(sets, pa.binary())], ["family", "blocks", "wanted", "key", "members"])

    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets (of one with itself if ``right`` is None)."""
    every = left if right is None else left + right
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    values, column, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts > 1)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rows, cut = len(left), 0 if right is None else len(left)
    out = np.zeros((rows, len(every) - cut), np.float32)
    step = 4096
    for begin in range(0, len(shared), step):
        a, b = np.searchsorted(column, (begin, begin + step))
        dense = np.zeros((len(every), step), np.float32)
        dense[owner[a:b], column[a:b] - begin] = 1
        out += dense[:rows] @ dense[cut:].T
    return out.astype(np.int64)


def _close(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return common * 100 >= (np.add.outer(a, b) - common) * percent


def links_within(sets: list[np.ndarray], members: np.ndarray, percent: int, out: list[tuple[np.ndarray, np.ndarray]], leaf: int = LEAF) -> None:
    """Spanning links among the members, by Voronoi regions of pivots and windows of twice the distance, recursively."""
    if len(members) < 2:
        return
    size = np.array([len(sets[i]) for i in members])
    if len(members) > leaf:
        pivots = members[np.linspace(0, len(members) - 1, PIVOTS).astype(int)]
        common = common_counts([sets[i] for i in members], [sets[i] for i in pivots])
        union = np.add.outer(size, np.array([len(sets[i]) for i in pivots])) - common
        distance = 1 - common / union
        home = distance.argmin(axis=1)
        window = distance <= distance.min(axis=1)[:, None] + 2 * (1 - percent / 100) + 1e-9
        window[np.arange(len(members)), home] = True
        if window.sum(axis=0).max() <= 0.8 * len(members):
            for p in range(PIVOTS):
                links_within(sets, members[window[:, p]], percent, out, leaf)
            return
    chosen = [sets[i] for i in members]
    left, right = _forest(_close(common_counts(chosen, None), size, size, percent))
    out.append((members[left], members[right]))


def _compare(percent: int):
    """Rows sorted by tile, the sets of one block or of two: links that span all links of the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, "tile", 256):
            tile, block = rows.column("tile").to_numpy(), rows.column("second").to_numpy(zero_copy_only=False)
            key = rows.column("key").to_numpy()
            members = rows.column("members").combine_chunks()
            begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in zip(begins, np.r_[begins[1:], len(tile)]):
                if b - a < 2:
                    continue
                sets = [np.frombuffer(members[i].as_buffer(), np.uint64) for i in range(a, b)]
                which = block[a:b]
                if not which.any():
                    inside: list[tuple[np.ndarray, np.ndarray]] = []
                    links_within(sets, np.arange(b - a), percent, inside)
                    found += [(key[a + x], key[a + y]) for x, y in inside]
                    continue
                left, right = np.flatnonzero(~which), np.flatnonzero(which)
                if not len(left):
                    continue
                one, two = [sets[i] for i in left], [sets[i] for i in right]
                near = _close(common_counts(one, two), np.array([len(s) for s in one]), np.array([len(s) for s in two]), percent)
                both = np.zeros((b - a, b - a), bool)
                both[np.ix_(left, right)] = near
                x, y = _forest(both | both.T)
                found.append((key[a + x], key[a + y]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found]), pa.int64()) for c in (0, 1)], ["a", "b"])

    return run


def jaccard_groups(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Group documents by links, 100 * intersection >= percent * union: (id column, n_shingles, component_id).

    A-Z count as a-z. ``component_id`` is the smallest id that links reach. A null text is empty; documents without
    words are linked with nothing, not even with each other. Rows with a null id have a row each and take part in
    links; a component of such rows alone has a null id. Repeated rows are copies. Other columns are not read. Sets are
    told apart by 64-bit hashes of shingles and of sets, with a base drawn for each call.
    """
    spark = documents.sparkSession
    ship(spark)
    base = drawn_base()
    bodies = documents.select(F.col(id_column).cast("long").alias("id"), lower_ascii(whole_text(text_column)).alias("body"))
    profile = materialized(bodies.mapInArrow(freeing(_profile(size, base)), "id long, n long, key long"))

    rare = bodies.select("body").mapInArrow(freeing(_rare(size, percent, base)), "shingle long, key long, n int, counted int")
    shared = rare.repartition("shingle").sortWithinPartitions("shingle", "key").mapInArrow(freeing(_counted), "shingle long, key long, n int, counted int, many int")
    regions = shared.repartition("key").sortWithinPartitions("key", "many", "shingle").mapInArrow(freeing(_windows(size, percent)), "shingle long, key long, n int, place int")
    chained = regions.repartition("shingle").sortWithinPartitions("shingle", "key").mapInArrow(freeing(_families(percent)), "a long, b long")
    families = components(chained).select(F.col("node").alias("key"), F.col("root").alias("family"))

    sets = profile.filter("key is not null").groupBy("key").agg(F.min("id").alias("least"), F.max("n").alias("n"))
    family = materialized(families.join(sets, "key").select("key", "family", F.col("least").alias("id"), "n"))
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_SETS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    asked = family.join(sizes.select("family", blocks.alias("blocks")), "family").select("id", F.col("key").alias("wanted"), "family", "blocks")
    texts = bodies.join(asked, bodies["id"].eqNullSafe(asked["id"])).select("family", "blocks", "wanted", "body")
    members = texts.mapInArrow(freeing(_set_of(size, base)), "family long, blocks int, wanted long, key long, members binary").filter("key = wanted")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    # In the tile of two blocks, the second block is marked.
    tiles = dealt.select(F.xxhash64("family", low, high).alias("tile"), ((F.col("own") == high) & (low != high)).alias("second"), "key", "members")
    links = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(freeing(_compare(percent)), "a long, b long")
    grouped = components(links)

    classes = sets.select("key", "least").join(grouped.withColumnRenamed("node", "key"), "key", "left")
    classes = classes.withColumn("root", F.coalesce("root", "key"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select("key", "component_id")
    return profile.join(named, "key", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
