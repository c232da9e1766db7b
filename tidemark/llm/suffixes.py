"""Repeated byte passages by external induced sorting.

A window is ``LENGTH`` bytes of one text. A window that also starts anywhere else is removed, byte by byte.

The suffix order that induced sorting builds is built here in three rounds, each of them an external sort that Spark
spills to disk and merges (its sort and shuffle are the disk-backed queues), so that no round needs a shard in memory:

1. *Reduction.* As induced sorting first sorts a sparse set of suffixes that the text itself picks, one suffix is
   picked for each window: the one at the window's minimiser. It depends on the window's bytes only, so equal windows
   pick equal suffixes. Suffixes are named by hashes of the bytes that all their windows share.
2. *Order of the picked suffixes.* Tuples (name, hash of all bytes the suffix's windows reach, place) are sorted.
   Names that stand alone end here, as no window of theirs can be repeated. Tuples whose whole reach is equal are
   repeated with all their windows, and one of them stands for all in the next round.
3. *Induction.* The remaining tuples, with their bytes, are sorted by name and by the bytes to the right; the longest
   common prefix of neighbours comes with the order. The order of the suffixes that begin one byte further left follows
   from the byte there and the order before it, and their common prefixes follow from minima over the old ones. After
   each step, neighbours with a common prefix of a window's length are repeated windows.

A name with more than ``LARGE`` different reaches (a passage that very many texts share, at its ends) is split by its
exact windows instead: their hashes are sorted like the tuples of round 2, which is exact for any number of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SpanHash, freeing, mixed, ship, signed, slices, text_buffer, whole_text

LENGTH = 200
WIDTH = 101  # starts of windows among which a minimiser is chosen
KMER = 16
LARGE = 65_536
BLOCK = 1 << 19
POSITION_BITS = 24

MARK, TUPLE, WINDOW, SPARE = 0, 1, 2, 3


def picked(data: np.ndarray, ends: np.ndarray, length: int, width: int) -> tuple[np.ndarray, ...]:
    """For the windows of a buffer of texts: (picked place, first window, last window, name hash, reach hash).

    ``ends`` has, for each byte, the end of its text. Needs length >= width - 1 + KMER.
    """
    hashes, other = SpanHash(data, 0), SpanHash(data, 1)
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    mask = np.uint64((1 << POSITION_BITS) - 1)
    least = hashes.fixed(KMER) & ~mask | np.arange(len(data) - KMER + 1, dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    starts = np.flatnonzero(ends[:n] - np.arange(n) >= length)
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    at = (least[starts] & mask).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first, last, place = starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]], at[new]
    name = hashes.of(place, place + length - width + 1)
    shape = ((place - first) * (1 << 12) + (place - last)).astype(np.uint64)
    reach = mixed(other.of(first, last + length) ^ mixed(shape))
    return place, first, last, name, reach


_TUPLE_NAMES = ["kind", "name", "reach", "id", "check", "place", "most", "least"]
_TUPLE_TYPES = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16()]
_TUPLE_SCHEMA = "kind byte, name long, reach long, id long, check long, place int, most short, least short"
# A picked suffix with windows from place - most to place - least. MARK: they are known to be repeated; SPARE: the same,
# and an equal one stands for it; WINDOW: one window, named by two hashes of its bytes.


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TUPLE_TYPES)], _TUPLE_NAMES)


def _pick(length: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_buffer(batch.column("body"))
            ids, checks = batch.column("id").to_numpy(zero_copy_only=False), batch.column("check").to_numpy()
            for i, j in slices(starts, BLOCK):
                low, high = int(starts[i]), int(starts[j])
                # Long texts go in blocks that overlap by all a window needs.
                for begin in range(low, max(high, low + 1), 4 * BLOCK):
                    end = min(high, begin + 4 * BLOCK + length - 1)
                    part = data[begin:end]
                    ends = np.minimum(np.repeat(starts[i + 1 : j + 1], np.diff(starts[i : j + 1]))[begin - low : end - low], end) - begin
                    place, first, last, name, reach = picked(part, ends, length, width)
                    if not len(place):
                        continue
                    row = i + np.searchsorted(starts[i + 1 : j + 1], place + begin, side="right")
                    inside = (place + begin - starts[row]).astype(np.int32)
                    # Of equal reaches seen together, one goes on and stands for all; the others, which are
                    # known to be repeated, are dealt out evenly.
                    order = np.lexsort((reach, name))
                    same = np.r_[False, (name[order][1:] == name[order][:-1]) & (reach[order][1:] == reach[order][:-1])]
                    twice = np.zeros(len(order), bool)
                    twice[order] = same | np.r_[same[1:], False]
                    spare = np.zeros(len(order), bool)
                    spare[order] = same
                    kind = np.where(spare, SPARE, np.where(twice, MARK, TUPLE))
                    name = np.where(spare, mixed(reach ^ mixed((ids[row] * 31 + inside).astype(np.uint64))), name)
                    name, reach = signed(name), signed(reach)
                    yield _batch(kind, name, reach, ids[row], checks[row], inside, place - first, place - last)

    return run


def _numbered(rows: pa.Table, chosen: np.ndarray, kind: int) -> pa.RecordBatch:
    columns = [rows.column(c).to_numpy()[chosen] for c in _TUPLE_NAMES]
    columns[0] = np.full(len(columns[1]), kind, np.int8)
    return _batch(*columns)


def _first_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (name, reach): repeated reaches become marks; one row of each reach goes on as a tuple, if its
    name has another reach."""

    def settled(rows: pa.Table, after: tuple | None) -> Iterator[pa.RecordBatch]:
        nonlocal before, shared
        name, reach = rows.column("name").to_numpy(), rows.column("reach").to_numpy()
        n = len(name)
        same_name, same_both = np.zeros(n + 1, bool), np.zeros(n + 1, bool)  # as the row before
        same_name[1:n] = name[1:] == name[:-1]
        same_both[1:n] = same_name[1:n] & (reach[1:] == reach[:-1])
        for at, row, other in ((0, 0, before), (n, n - 1, after)):
            if other is not None:
                same_name[at] = other[0] == name[row]
                same_both[at] = same_name[at] and other[1] == reach[row]
        repeated = same_both[:n] | same_both[1:] | (rows.column("kind").to_numpy() == MARK)
        if repeated.any():
            yield _numbered(rows, repeated, MARK)
        # Whether the name had another reach before this run of equal ones; the first run may have begun earlier.
        begins = ~same_both[:n]
        run = np.cumsum(begins)
        earlier = np.r_[shared, same_name[:n][begins]][run]
        goes = ~same_both[1:] & (same_name[1:] | earlier)
        if goes.any():
            yield _numbered(rows, goes, TUPLE)
        before, shared = (name[-1], reach[-1]), bool(earlier[-1])

    before, shared, held = None, False, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        spare = rows.column("kind").to_numpy() == SPARE
        if spare.any():
            yield _numbered(rows, spare, MARK)
            rows = rows.filter(pa.array(~spare))
        if not rows.num_rows:
            continue
        if held is not None:
            yield from settled(held, (rows.column("name")[0].as_py(), rows.column("reach")[0].as_py()))
        held = rows
    if held is not None:
        yield from settled(held, None)


def _contexts(length: int, width: int):
    """The bytes around the tuples of each text: ``width - 1`` to the left and ``length`` to the right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["name", "right", "left", "id", "check", "place", "most", "least"]
        for batch in batches:
            for i in range(batch.num_rows):
                body = batch.column("body")[i].as_py().encode("utf-8", "surrogatepass")
                data = np.frombuffer(b"\xff" * (width - 1) + body + b"\xff" * length, np.uint8)
                tuples = batch.column("tuples")[i].values
                place = tuples.field("place").to_numpy()
                spans = data[place[:, None].astype(np.int64) + np.arange(width - 1 + length)]
                left = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width - 1), len(place), [None, pa.py_buffer(np.ascontiguousarray(spans[:, : width - 1]))])
                right = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(place), [None, pa.py_buffer(np.ascontiguousarray(spans[:, width - 1 :]))])
                n = len(place)
                yield pa.RecordBatch.from_arrays(
                    [tuples.field("name"), right.cast(pa.binary()), left.cast(pa.binary()), pa.array(np.full(n, batch.column("id")[i].as_py())), pa.array(np.full(n, batch.column("check")[i].as_py(), np.int64)), *(tuples.field(c) for c in names[5:])],
                    names,
                )

    return run


def induced(left: np.ndarray, right: np.ndarray, group: np.ndarray, most: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest and smallest repeated offset of each picked suffix, -1 if none is.

    Rows are sorted by (group, right). ``left`` has the bytes before the place, ``right`` those from it on.
    """
    n, length, steps = len(group), right.shape[1], left.shape[1]
    far, near = np.full(n, -1), np.full(n, -1)
    # common[i]: of the suffixes at ranks i - 1 and i; -1 between groups.
    common = np.full(n, -1)
    differ = right[1:] != right[:-1]
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    common[np.r_[True, group[1:] != group[:-1]]] = -1
    order = np.arange(n)
    for offset in range(steps + 1):
        if offset:
            # One byte further left: by that byte, then by the order before.
            key = group[order].astype(np.int64) * 256 + left[order, steps - offset]
            turn = np.argsort(key, kind="stable")
            key = key[turn]
            tied = np.flatnonzero(key[1:] == key[:-1]) + 1
            renewed = np.where(np.r_[True, group[order[turn]][1:] != group[order[turn]][:-1]], -1, 0)
            if len(tied):
                bounds = np.column_stack([turn[tied - 1] + 1, turn[tied] + 1]).ravel()
                padded = np.append(common, np.iinfo(common.dtype).max)
                renewed[tied] = 1 + np.minimum.reduceat(padded, bounds)[::2]
            order, common = order[turn], renewed
        repeated = common >= length
        repeated = order[repeated | np.r_[repeated[1:], False]]
        repeated = repeated[(most[repeated] >= offset) & (least[repeated] <= offset)]
        far[repeated] = offset
        near[repeated] = np.where(near[repeated] < 0, offset, near[repeated])
    return far, near


def _induce(length: int, width: int, large: int):
    """Marks for the repeated windows of rows sorted by (name, right); large names give their exact windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def exact(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for start in range(0, rows.num_rows, 4096):
                part = rows.slice(start, 4096)
                n = part.num_rows
                spans = np.column_stack([_matrix(part, "left", width - 1), _matrix(part, "right", length)]).ravel()
                most, least = part.column("most").to_numpy().astype(np.int64), part.column("least").to_numpy().astype(np.int64)
                each = most - least + 1
                row = np.repeat(np.arange(n), each)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + least[row]
                begin = row * (width - 1 + length) + width - 1 - offset
                one, two = (signed(SpanHash(spans, which).of(begin, begin + length)) for which in (0, 1))
                ids, checks, places = (part.column(c).to_numpy() for c in ("id", "check", "place"))
                # Windows that are equal here are repeated; one of them goes on and stands for all.
                order = np.lexsort((two, one))
                same = np.r_[False, (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
                twice = order[same | np.r_[same[1:], False]]
                if len(twice):
                    far, near = np.full(n, -1), np.full(n, 1 << 14)
                    np.maximum.at(far, row[twice], offset[twice])
                    np.minimum.at(near, row[twice], offset[twice])
                    hit = np.flatnonzero(far >= 0)
                    zero = np.zeros(len(hit), np.int64)
                    yield _batch(np.full(len(hit), MARK, np.int8), zero, zero, ids[hit], checks[hit], places[hit], far[hit], near[hit])
                on = order[~same]
                r = row[on]
                yield _batch(np.full(len(on), WINDOW, np.int8), one[on], two[on], ids[r], checks[r], places[r], offset[on], offset[on])

        def small(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            left, right = _matrix(rows, "left", width - 1), _matrix(rows, "right", length)
            name = rows.column("name").to_numpy()
            group = np.cumsum(np.r_[0, name[1:] != name[:-1]])
            most, least = (rows.column(c).to_numpy().astype(np.int64) for c in ("most", "least"))
            far, near = induced(left, right, group, most, least)
            hit = np.flatnonzero(far >= 0)
            if len(hit):
                ids, checks, places = (rows.column(c).to_numpy()[hit] for c in ("id", "check", "place"))
                yield _batch(np.zeros(len(hit), np.int8), name[hit], name[hit], ids, checks, places, far[hit], near[hit])

        # A name's rows are held until it is known to be small; a large one is passed on as it comes.
        held: list[pa.Table] = []
        count, current, is_large = 0, None, False
        for rows in _by_name(batches):
            name = rows.column("name")[0].as_py()
            if name != current:
                if is_large:
                    held, count, is_large = [], 0, False
                current, opened = name, count
            if is_large:
                yield from exact(rows)
                continue
            held.append(rows)
            count += rows.num_rows
            if count - opened > large:
                whole = pa.concat_tables(held).combine_chunks()
                if opened:
                    yield from small(whole.slice(0, opened))
                yield from exact(whole.slice(opened))
                held, count, is_large = [], 0, True
            elif count >= min(large, 16_384) and opened:
                whole = pa.concat_tables(held).combine_chunks()
                yield from small(whole.slice(0, opened))
                held, count, opened = [whole.slice(opened)], count - opened, 0
        if count and not is_large:
            yield from small(pa.concat_tables(held).combine_chunks())

    return run


def _by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each batch, cut so that only the last part may go on in the next batch."""
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            name = rows.column("name").to_numpy()
            cut = int(np.searchsorted(name, name[-1], side="left"))
            first = int(np.searchsorted(name, name[0], side="right"))
            for a, b in ((0, min(first, cut)), (first, cut), (cut, len(name))):
                if b > a:
                    yield rows.slice(a, b - a)


def _matrix(rows: pa.Table, column: str, width: int) -> np.ndarray:
    values = rows.column(column).combine_chunks().cast(pa.binary(width))
    data = np.frombuffer(values.buffers()[1], np.uint8)
    return data[values.offset * width : (values.offset + len(values)) * width].reshape(-1, width)


def repeated_spans(documents: DataFrame, length: int = LENGTH, width: int = WIDTH, large: int = LARGE) -> DataFrame:
    """Repeated windows of a table (id, check, body), as rows (id, check, start, end) of bytes that may overlap."""
    spark = documents.sparkSession
    ship(spark)
    tuples = documents.mapInArrow(freeing(_pick(length, width)), _TUPLE_SCHEMA)
    met = tuples.repartition("name").sortWithinPartitions("name", "reach").mapInArrow(freeing(_first_of), _TUPLE_SCHEMA)
    here = F.struct("name", "place", "most", "least")
    asked = met.filter(F.col("kind") == TUPLE).groupBy("id", "check").agg(F.collect_list(here).alias("tuples"))
    around = documents.join(asked, ["id", "check"]).select("id", "check", "body", "tuples").mapInArrow(
        freeing(_contexts(length, width)), "name long, right binary, left binary, id long, check long, place int, most short, least short"
    )
    sorted_by_suffix = around.repartition("name").sortWithinPartitions("name", "right")
    found = sorted_by_suffix.mapInArrow(freeing(_induce(length, width, large)), _TUPLE_SCHEMA)
    windows = found.filter(F.col("kind") == WINDOW).repartition("name").sortWithinPartitions("name", "reach")
    hot = windows.mapInArrow(freeing(_first_of), _TUPLE_SCHEMA)
    marks = met.unionByName(found).unionByName(hot).filter(F.col("kind") == MARK)
    begin = F.col("place") - F.col("most")
    return marks.select("id", "check", begin.alias("start"), (F.col("place") - F.col("least") + F.lit(length)).alias("end"))


def joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted spans with all that touch or overlap made one."""
    reach = np.maximum.accumulate(ends)
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, and which bytes went."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            body = batch.column("body")[i].as_py().encode("utf-8", "surrogatepass")
            spans: list[dict] = []
            found = batch.column("spans")[i]
            kept = body
            if found.is_valid and len(found.values):
                starts, ends = (found.values.field(c).to_numpy().astype(np.int64) for c in ("start", "end"))
                order = np.argsort(starts, kind="stable")
                starts, ends = joined(starts[order], ends[order])
                edges = [0, *np.column_stack([starts, ends]).ravel().tolist(), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)]
            out.append((batch.column("id")[i].as_py(), len(body), spans, kept))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()))],
            ["id", "n_bytes", "removed", "kept"],
        )


def _bodies(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, check, body): ``id`` has -1 for null; ``check`` tells rows of one id with different texts apart, and is odd
    where there is no id."""
    body, own = whole_text(text_column), F.col(id_column).cast("long")
    check = F.xxhash64(body).bitwiseAND(F.lit(-2)).bitwiseOR(own.isNull().cast("long"))
    return documents.select(F.coalesce(own, F.lit(-1)).alias("id"), check.alias("check"), body.alias("body"))


def remove_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """Remove every byte that a repeated window covers: (id column, n_bytes, removed, kept), one row for each input row.

    ``removed`` lists the maximal removed byte ranges and ``kept`` has the remaining bytes. A null text is empty; a
    text of fewer bytes than a window is never changed; an exact copy is removed as a whole if it is long enough. Rows
    with a null id are kept, without an id. Other columns are not read.
    """
    bodies = _bodies(documents, id_column, text_column)
    spans = repeated_spans(bodies, length).groupBy("id", "check").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    # The same columns by the same keys as in ``repeated_spans``: Spark writes the texts to one shuffle and reads it twice.
    own = F.when(F.col("check").bitwiseAND(F.lit(1)) == 0, F.col("id"))
    cut = bodies.join(spans, ["id", "check"], "left").select(own.alias("id"), "body", "spans")
    schema = "id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return cut.mapInArrow(freeing(_cut), schema).withColumnRenamed("id", id_column)


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their removed bytes; a character that is removed in part only stays."""
    for batch in batches:
        texts = []
        for i in range(batch.num_rows):
            text, found = batch.column("body")[i].as_py(), batch.column("spans")[i]
            if found.is_valid and len(found.values):
                body = text.encode("utf-8", "surrogatepass")
                starts, ends = (found.values.field(c).to_numpy().astype(np.int64) for c in ("start", "end"))
                order = np.argsort(starts, kind="stable")
                kept, at = [], 0
                for a, b in zip(*(edge.tolist() for edge in joined(starts[order], ends[order]))):
                    while a < len(body) and body[a] & 0xC0 == 0x80:
                        a += 1
                    while b < len(body) and body[b] & 0xC0 == 0x80:
                        b -= 1
                    kept.append(body[at:a])
                    at = b
                text = b"".join([*kept, body[at:]]).decode("utf-8", "surrogatepass")
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("own"), pa.array(texts, pa.string())], ["own", "body"])


def without_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns of ``documents``, with repeated passages taken out of the texts; whole characters only.

    A null text becomes the empty text; all rows stay.
    """
    body = whole_text(f"`{text_column}`")
    own = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("own")
    keyed = documents.select(F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(-1)).alias("id"), F.xxhash64(body).alias("check"), body.alias("body"), own)
    spans = repeated_spans(keyed.select("id", "check", "body"), length).groupBy("id", "check").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    cut = keyed.join(spans, ["id", "check"], "left").select("own", "body", "spans")
    # The text itself need not travel twice.
    cut = cut.withColumn("own", F.col("own").dropFields(text_column))
    kept = cut.select("own", "body", "spans").mapInArrow(freeing(_rewritten), cut.select("own", "body").schema)
    return kept.select(*(F.col("body").alias(c) if c == text_column else F.col(f"own.`{c}`") for c in documents.columns))
