"""Packing documents into sequences of fixed length by linear grouping.

The lengths are at most the capacity, so a histogram of bounded size describes the whole packing problem:

1. large pieces are sorted by length and cut into groups of equal cardinality; each is rounded up to its group's
   largest length, which leaves few sizes;
2. configurations (how many of each size share a sequence) are optimised by column generation, and each is used a
   whole number of times;
3. actual pieces take the places of their rounded ones, which leaves slack;
4. all other pieces, large ones first, go where the least slack is left over.

The plan is a table of runs, "pieces number a to b of length l go to sequences number c onwards, at offset o"; its
size depends on the capacity and the number of groups only. Spark numbers the pieces of each length and looks up
their places.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import PLAIN_TEXT, Splitter, Words
from tidemark.llm.common import freeing, materialized, ship, whole_text
from tidemark.operators.numbering import number_in_chunks

CAPACITY = 1024
END = 2
GROUPS = 96
SMALL = 64
ROUNDS = 3000
CHUNK_ROWS = 20_000


@dataclass
class Run:
    """``copies`` sequences of the same make-up; items: (length, rank of the first sequence's piece, offset)."""

    copies: int
    first: int
    slack: int
    items: list[tuple[int, int, int]] = field(default_factory=list)

    def split(self, copies: int) -> "Run":
        """Cut off the first sequences."""
        head = Run(copies, self.first, self.slack, list(self.items))
        self.copies -= copies
        self.first += copies
        self.items = [(length, rank + copies, offset) for length, rank, offset in self.items]
        return head


class Shelf:
    """Runs of sequences by the slack they have."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_slack: list[list[Run]] = [[] for _ in range(capacity + 1)]
        self.used = 0

    def new(self, copies: int) -> Run:
        run = Run(copies, self.used, self.capacity)
        self.used += copies
        return run

    def keep(self, run: Run) -> None:
        self.by_slack[run.slack].append(run)

    def best(self, length: int) -> Run | None:
        """The run with the least slack that holds this length, taken off the shelf."""
        for slack in range(length, self.capacity + 1):
            if self.by_slack[slack]:
                return self.by_slack[slack].pop()
        return None


def put(run: Run, length: int, rank: int) -> None:
    capacity_used = sum(item[0] for item in run.items)
    run.items.append((length, rank, capacity_used))
    run.slack -= length


def best_fit(shelf: Shelf, length: int, rank: int, count: int) -> None:
    """Put pieces rank .. rank + count - 1 of one length where they leave the least slack."""
    while count:
        run = shelf.best(length)
        if run is None:
            each = shelf.capacity // length
            run = shelf.new(max(1, count // each))
        if run.copies > count:
            head = run.split(count)
            shelf.keep(run)
            run = head
        # What fits once more into the same sequences has the least slack there.
        for _ in range(min(run.slack // length, count // run.copies)):
            put(run, length, rank)
            rank += run.copies
            count -= run.copies
        shelf.keep(run)


def grouped(lengths: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Cut the pieces, longest first, into groups of equal cardinality: (size, [(length, rank, count), ...])."""
    total = sum(lengths.values())
    share = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    room = 0
    for length in sorted(lengths, reverse=True):
        rank, count = 0, lengths[length]
        while count:
            if not room:
                out.append((length, []))
                room = share
            taken = min(room, count)
            out[-1][1].append((length, rank, taken))
            rank, count, room = rank + taken, count - taken, room - taken
    return out


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most worth that fits, by dynamic programming over the capacity."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    small_first, gains = sizes[order], worth[order]
    for room in range(1, capacity + 1):
        n = np.searchsorted(small_first, room, side="right")
        value[room] = value[room - 1]
        if n:
            with_it = value[room - small_first[:n]] + gains[:n]
            at = int(with_it.argmax())
            if with_it[at] > value[room] + 1e-12:
                value[room], choice[room] = with_it[at], order[at]
    taken, room = np.zeros(len(sizes), np.int64), capacity
    while room:
        if choice[room] < 0:
            room -= 1
        else:
            taken[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), taken


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """How often to use which configuration, rounded down: column generation for the fewest sequences."""
    n = len(sizes)
    if not n:
        return []
    columns = np.diag(capacity // sizes).astype(float)
    for _ in range(ROUNDS):
        worth = np.linalg.solve(columns.T, np.ones(n))
        value, taken = best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-7:
            break
        used = np.linalg.solve(columns, counts.astype(float))
        change = np.linalg.solve(columns, taken.astype(float))
        ratio = np.where(change > 1e-9, np.maximum(used, 0) / np.maximum(change, 1e-9), np.inf)
        columns[:, int(ratio.argmin())] = taken
    used = np.linalg.solve(columns, counts.astype(float))
    return [(columns[:, j].astype(np.int64), int(used[j] + 1e-9)) for j in range(n) if used[j] + 1e-9 >= 1]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, sequence_from, offset) that place every piece; ranks count from 0."""
    shelf = Shelf(capacity)
    large = {length: count for length, count in histogram.items() if small < length < capacity and count}
    group_list = grouped(large, groups)
    queues = [list(parts) for _, parts in group_list]
    sizes = np.array([size for size, _ in group_list], np.int64)
    counts = np.array([sum(part[2] for part in parts) for _, parts in group_list], np.int64)
    if capacity in histogram:
        run = shelf.new(histogram[capacity])
        put(run, capacity, 0)
        shelf.keep(run)
    # Groups may share a size when one length is very frequent; they are one size for the configurations.
    same: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        same.setdefault(int(size), []).append(i)
    distinct = np.array(sorted(same, reverse=True), np.int64)
    totals = np.array([counts[same[int(size)]].sum() for size in distinct], np.int64)
    left = totals.copy()
    for taken, times in configurations(distinct, totals, capacity):
        room = [int(left[i] // taken[i]) for i in range(len(taken)) if taken[i]]
        times = min([times, *room])
        if times <= 0:
            continue
        left -= taken * times
        slots = [int(distinct[i]) for i in range(len(taken)) for _ in range(taken[i])]
        open_runs = [shelf.new(times)]
        for size in slots:
            # The next pieces of this size's groups, as long as all open sequences have one.
            next_runs = []
            for run in open_runs:
                while run is not None:
                    queue = next(queues[i] for i in same[size] if queues[i])
                    length, rank, count = queue.pop(0)
                    if count > run.copies:
                        queue.insert(0, (length, rank + run.copies, count - run.copies))
                        count = run.copies
                    head, rest = (run, None) if count == run.copies else (run.split(count), run)
                    put(head, length, rank)
                    next_runs.append(head)
                    run = rest
            open_runs = next_runs
        for run in open_runs:
            shelf.keep(run)
    rest = [part for queue in queues for part in queue]
    rest += [(length, 0, count) for length, count in histogram.items() if length <= small and length < capacity and count]
    for length, rank, count in sorted(rest, reverse=True):
        best_fit(shelf, length, rank, count)
    return [
        (length, rank, rank + run.copies, run.first, offset)
        for runs in shelf.by_slack
        for run in runs
        for length, rank, offset in run.items
    ]


def _byte_letters() -> dict[int, int]:
    """The letter by which byte-level vocabularies write a byte: itself where it is printable, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class LibraryEncoder:
    """Ids by the tokenizers library with its defaults. Its model is asked once for each repeated match; the whole library
    for texts with rare characters or with the name of a special token, which it then takes for that token."""

    def __init__(self, spec: str, pattern: str):
        self.library = tokenizers.Tokenizer.from_str(spec)
        self.model = self.library.model
        names = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.named = re.compile("|".join(map(re.escape, names))) if names else None
        self.words = Words(self.match)
        self.split = Splitter(pattern)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def match(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return np.array([token.id for token in self.model.tokenize(letters)], "<u4").tobytes()

    def packed(self, text: str) -> bytes:
        if PLAIN_TEXT.search(text) or (self.named and self.named.search(text)):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, self.split(text)))


_ENCODERS: dict[str, LibraryEncoder] = {}


def _encoder(shared, pattern: str) -> LibraryEncoder:
    key = f"{len(shared.value)} {pattern}"
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = LibraryEncoder(shared.value, pattern)
    return _ENCODERS[key]


def pieces(documents: DataFrame, tokenizer_path: str, pattern: str, id_column: str, text_column: str, capacity: int, end: int) -> DataFrame:
    """Cut documents, ended by ``end``, into pieces of at most ``capacity`` ids; only the first may be shorter."""
    spark = documents.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as spec:
        shared = spark.sparkContext.broadcast(spec.read())
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows = []
            for i in range(batch.num_rows):
                packed = encoder.packed(texts[i].as_py()) + last
                n, start, piece = len(packed) // 4, 0, 0
                while start < n:
                    length = (n - 1) % capacity + 1 if piece == 0 else capacity
                    rows.append((ids[i].as_py(), piece, start, length, zlib.crc32(packed[4 * start : 4 * (start + length)])))
                    start, piece = start + length, piece + 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["id", "piece", "start", "length", "ids_crc32"])

    narrow = documents.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("body"))
    return narrow.mapInArrow(freeing(run), "id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` ids as the method finds.

    Returns, for each piece, the id column, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset``. The name of a special token in a text is that token, as the library has it. A null text is empty and gives one piece, the end id alone. Each repeated row is packed again; null ids
    are kept; an empty table gives no piece. Other columns are not read.
    """
    spark = documents.sparkSession
    cut = materialized(pieces(documents, tokenizer_path, pattern, id_column, text_column, capacity, end))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # The plan's size depends on the capacity and the number of groups, not on the documents.
    places = F.broadcast(spark.createDataFrame(plan(histogram, capacity), "length long, rank_from long, rank_to long, sequence_from long, offset long"))
    chunks = max(16, -(-sum(histogram.values()) // CHUNK_ROWS))
    order = ("id", "piece", "ids_crc32")
    numbered = number_in_chunks(
        cut.withColumn("chunk", F.pmod(F.xxhash64(*order), F.lit(chunks))), "number", order, chunk=("chunk",), group=("length",)
    ).withColumn("rank", F.col("number") - 1)
    within = (numbered["rank"] >= places["rank_from"]) & (numbered["rank"] < places["rank_to"])
    return numbered.join(places, (numbered["length"] == places["length"]) & within).select(
        F.col("id").alias(id_column),
        "piece",
        "start",
        numbered["length"],
        "ids_crc32",
        (F.col("sequence_from") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
        "offset",
    )
