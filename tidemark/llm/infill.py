"""Fill-in-the-middle: documents cut in three and put together in another order, by a secondary sort.

A document leaves its task as *pieces* of at most ``CHUNK`` code points, keyed by the row and numbered in the order of
the output. One exchange deals the pieces out by row and sorts them by row and place (``repartition`` by key and
``sortWithinPartitions``: the DataFrame form of ``repartitionAndSortWithinPartitions``, with Spark's spilling sort). What
follows streams: a digest sees one piece at a time, and restoration finds the markers in the stream, gives each piece its
place in the original and sorts again inside the partition, without a second exchange. No task ever holds an output as
a whole, however long.

A row is told apart by a 128-bit hash of id and text and by its map task, so that many rows of one id, or copies of one
row, are spread; equal rows of a task share their pieces, with a count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship, whole_text

CHUNK = 8192  # code points of a piece
MARKERS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
RANK = {"prefix": 0, "middle": 1, "suffix": 2}  # place in the original
BATCH = 4 << 20  # bytes of pieces handed on at a time

_ROW = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_PIECE = f"key binary, task int, place long, piece binary, copies long, {_ROW}"
_PART = f"key binary, task int, rank int, place long, piece binary, copies long, {_ROW}, output_sha256 string"
_DIGEST = f"{_ROW}, output_sha256 string, restored_sha256 string"
_TEXT = f"{_ROW}, output string"


class Cut(NamedTuple):
    """How one text is cut: ``form`` is plain, psm or spm; both counts are None for plain."""

    form: str
    prefix: int | None
    middle: int | None


def cut(doc_id: int | None, text: str, seed: str = "1", plain_from: int = 90, spm_below: int = 20) -> Cut:
    """The cut of a text; it depends on the id and the number of code points only, and on markers in the text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or h3 % 100 >= plain_from or any(marker in text for marker in MARKERS.values()):
        return Cut("plain", None, None)
    low, high = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return Cut("spm" if h4 % 100 < spm_below else "psm", low, high - low)


def output_pieces(text: str, how: Cut, chunk: int = CHUNK) -> Iterator[str]:
    """The output from left to right; a marker opens its part."""
    if how.form == "plain":
        spans = [("", 0, len(text))]
    else:
        end = how.prefix + how.middle
        at = {"prefix": (0, how.prefix), "middle": (how.prefix, end), "suffix": (end, len(text))}
        spans = [(MARKERS[part], *at[part]) for part in ORDERS[how.form]]
    for marker, low, high in spans:
        yield marker + text[low : min(low + chunk, high)]
        for start in range(low + chunk, high, chunk):
            yield text[start : min(start + chunk, high)]


class Restorer:
    """Finds the parts of an output while it streams by, whatever the borders of its pieces."""

    _ANY = re.compile(b"|".join(re.escape(m.encode()) for m in MARKERS.values()))
    _PART_OF = {m.encode(): part for part, m in MARKERS.items()}

    def __init__(self, form: str):
        self.plain = form == "plain"
        self.rank, self.held = RANK["middle"] if self.plain else None, b""

    def feed(self, piece: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        """(rank, bytes) of what is certain by now; a marker may still straddle the end of ``piece``."""
        if self.plain:
            yield self.rank, piece
            return
        body, at = self.held + piece, 0
        for found in self._ANY.finditer(body):
            if found.start() > at:
                yield self.rank, body[at : found.start()]
            self.rank, at = RANK[self._PART_OF[found.group()]], found.end()
        keep = len(body) if last else max(at, len(body) - 2)
        if keep > at:
            yield self.rank, body[at:keep]
        self.held = body[keep:]


def _schema(ddl: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


class _Out:
    """Rows gathered into record batches of about ``BATCH`` bytes."""

    def __init__(self, ddl: str):
        self.schema = _schema(ddl)
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int = 64) -> None:
        self.rows.append(row)
        self.size += size

    def take(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= least:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
            self.rows, self.size = [], 0


def pieces(docs: DataFrame, seed: str = "1", plain_from: int = 90, spm_below: int = 20, chunk: int = CHUNK) -> DataFrame:
    """Output pieces of all documents, dealt out by row and sorted by row and place.

    Columns: ``key`` and ``task`` (the row), ``place``, ``piece`` (UTF-8), and on place 0 also ``copies`` (equal rows) and
    the row's doc_id, n, form, prefix_chars and middle_chars. Null text is empty; a null id counts as no digits. Other
    columns are not read.
    """

    def emit(batches):
        task = TaskContext.get().partitionId()
        out = _Out(_PIECE)
        for batch in batches:
            seen: dict[tuple, int] = {}
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[pair] = seen.get(pair, 0) + 1
            for (doc_id, text), copies in seen.items():
                how = cut(doc_id, text, seed, plain_from, spm_below)
                key = xxhash.xxh3_128_digest(f"{doc_id}:{text}".encode())
                head = (copies, doc_id, len(text), *how)
                for place, piece in enumerate(output_pieces(text, how, chunk)):
                    body = piece.encode()
                    out.add((key, task, place, body, *(head if place == 0 else (None,) * 6)), len(body) + 64)
                    yield from out.take(BATCH)
        yield from out.take()

    ship(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return narrow.mapInArrow(emit, _PIECE).repartition("key", "task").sortWithinPartitions("key", "task", "place")


def _stream(batches, row) -> Iterator[tuple[bool, tuple]]:
    """(whether another row begins, values of a piece) in sorted order, without repeated places."""
    last = None
    for batch in batches:
        for values in zip(*(column.to_pylist() for column in batch.columns)):
            here = values[:row]
            if last is not None and here == last[:row] and values[row] == last[row]:
                yield None, values  # a copy of the piece, from another batch of the same task
                continue
            yield last is None or here != last[:row], values
            last = values


def outputs(cut_pieces: DataFrame) -> DataFrame:
    """The transformed texts as rows (doc_id, n, form, prefix_chars, middle_chars, output)."""

    def join(batches):
        out, held, head, copies = _Out(_TEXT), [], None, 0

        def done():
            if head is not None:
                text = b"".join(held).decode()
                for _ in range(copies):
                    out.add((*head, text), len(text) + 64)

        for first, values in _stream(batches, 2):
            key, task, place, piece, number, *row = values
            if first is None:
                copies += number or 0
                continue
            if first:
                done()
                yield from out.take(BATCH)
                held, head, copies = [], row, number
            held.append(piece)
        done()
        yield from out.take()

    return cut_pieces.mapInArrow(join, _TEXT)


def parts(cut_pieces: DataFrame) -> DataFrame:
    """Output pieces back as pieces of the original, and one row of rank -1 with the digest of the output."""

    def split(batches):
        out = _Out(_PART)
        key = task = head = digest = restorer = None
        copies = place = 0

        def passed(found):
            nonlocal place
            for rank, body in found:
                out.add((key, task, rank, place, body, *(None,) * 7), len(body) + 64)
                place += 1

        def done():
            if head is not None:
                passed(restorer.feed(b"", last=True))
                out.add((key, task, -1, 0, b"", copies, *head, digest.hexdigest()))

        for first, values in _stream(batches, 2):
            if first is None:
                copies += values[4] or 0
                continue
            if first:
                done()
                key, task, _, _, copies, *head = values
                digest, restorer, place = hashlib.sha256(), Restorer(head[2]), 0
            digest.update(values[3])
            passed(restorer.feed(values[3]))
            yield from out.take(BATCH)
        done()
        yield from out.take()

    return cut_pieces.mapInArrow(split, _PART)


def digests(cut_pieces: DataFrame) -> DataFrame:
    """One row per document: its cut, and SHA-256 of the output and of the text rebuilt from output and form."""

    def close(batches):
        out, head, digest, copies = _Out(_DIGEST), None, None, 0

        def done():
            if head is not None:
                for _ in range(copies):
                    out.add((*head, digest.hexdigest()))

        for batch in batches:
            names = batch.schema.names
            for values in zip(*(batch.column(i).to_pylist() for i in range(len(names)))):
                if values[2] == -1:
                    done()
                    yield from out.take(BATCH)
                    copies, head, digest = values[5], values[6:], hashlib.sha256()
                else:
                    digest.update(values[4])
        done()
        yield from out.take()

    # Pieces stay in their partition: the second order needs a sort, and no exchange.
    return parts(cut_pieces).sortWithinPartitions("key", "task", "rank", "place").mapInArrow(close, _DIGEST)
