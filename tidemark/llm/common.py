"""Helpers that the operators share: code shipping, Arrow columns, sorted runs, hashes of byte spans."""

from __future__ import annotations

import ctypes
import functools
import os
import secrets
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    package = os.path.dirname(here)
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialized(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def freeing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which the worker gives free memory back: it waits for its next task beside a full JVM."""

    @functools.wraps(run)
    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return freed


def whole_text(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; all other characters stay as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow text column end to end, and the n + 1 places where its values begin. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut values with these starts into row ranges [i, j) of about ``most`` bytes; a longer value stands alone."""
    i, n = 0, len(starts) - 1
    while i < n:
        j = int(np.searchsorted(starts, starts[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def runs_of(batches: Iterable[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that hold whole runs of equal ``key`` values, from batches sorted by it.

    A run longer than ``rows`` comes alone and whole; callers keep runs bounded by their keys.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        joined = pa.Table.from_batches(held).combine_chunks()
        values = joined.column(key).to_numpy()
        cut = int(np.searchsorted(values, values[-1], side="left"))
        if cut:
            yield joined.slice(0, cut)
            held = joined.slice(cut).to_batches()
            count -= cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


# Two odd multipliers for polynomial hashes modulo 2^64, and the finishing multipliers of a 64-bit mixer.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


# --- arithmetic modulo the prime 2^61 - 1 -------------------------------------------------------------------------

P61 = (1 << 61) - 1
_U = np.uint64
_LOW31 = _U((1 << 31) - 1)
_LOW30 = _U((1 << 30) - 1)


def reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit numbers modulo 2^61 - 1."""
    x = (x & _U(P61)) + (x >> _U(61))
    return np.where(x >= _U(P61), x - _U(P61), x)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it, without 128-bit arithmetic."""
    a1, a0, b1, b0 = a >> _U(31), a & _LOW31, b >> _U(31), b & _LOW31
    middle = a0 * b1 + a1 * b0
    return reduced((a1 * b1 << _U(1)) + (middle >> _U(30)) + ((middle & _LOW30) << _U(31)) + a0 * b0)


def addmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return reduced(a + b)


def submod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return reduced(a + (_U(P61) - b))


def times31(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^61 - 1 times 2^31."""
    return ((x & _LOW30) << _U(31)) + (x >> _U(30))


def doubled(base: int, least: int) -> np.ndarray:
    """The powers of ``base`` from 0 on, at least so many."""
    table, step = np.ones(1, _U), base % P61
    while len(table) < least:
        table, step = np.concatenate([table, mulmod(table, np.full(len(table), step, _U))]), step * step % P61
    return table


_POWERS: dict[int, tuple[np.ndarray, ...]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, ...]:
    """Halves of the powers of a base, and the powers of its inverse."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        if base not in _POWERS and len(_POWERS) >= 4:  # workers outlive queries
            _POWERS.clear()
        size = max(1 << 16, n)
        up = doubled(base, size)
        have = _POWERS[base] = (up & _LOW31, up >> _U(31), doubled(pow(base, -1, P61), size))
    return have


def _prefix_sums(terms: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """0 and the running sums modulo 2^61 - 1 of terms below 2^41."""
    out, carry = np.zeros(len(terms) + 1, _U), _U(0)
    for i in range(0, len(terms), piece):
        part = reduced(np.cumsum(terms[i : i + piece], dtype=_U) + carry)
        out[i + 1 : i + 1 + len(part)] = part
        carry = part[-1]
    return out


def drawn_base() -> int:
    """A base that no text can have been made for: two given texts collide with a chance of their length in 2^61."""
    return secrets.randbelow(P61 - (1 << 32)) + (1 << 32)


class SpanHash:
    """Hashes of any byte spans of one buffer from prefix sums: equal bytes have equal hashes, wherever they stand.

    Polynomials modulo a prime: unlike those modulo 2^64, no pattern of two words collides whatever the base. Texts made to
    collide exist for any base that is known; ``base`` may be one that was drawn for the query (``drawn_base``).
    """

    def __init__(self, data: np.ndarray, which: int = 0, base: int | None = None):
        low, high, self.down = _powers(BASES[which] % P61 if base is None else base, len(data) + 1)
        value = data.astype(_U) + _U(1)
        self.low, self.high = _prefix_sums(value * low[: len(data)]), _prefix_sums(value * high[: len(data)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = reduced(times31(submod(self.high[end], self.high[start])) + submod(self.low[end], self.low[start]))
        return mixed(mulmod(total, self.down[start]))

    def fixed(self, length: int) -> np.ndarray:
        """Of all spans of this length, by start."""
        n = len(self.low) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = reduced(times31(submod(self.high[length:], self.high[:n])) + submod(self.low[length:], self.low[:n]))
        return mixed(mulmod(total, self.down[:n]))


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
