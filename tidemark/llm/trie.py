"""The prefix trie of conversations: which beginnings are shared, and what sharing them saves.

*Prefix digests.* A turn is two 60-bit numbers of a SHA-256; a prefix is a polynomial in its turns modulo the prime
2^61 - 1, with two bases. Such digests come from prefix sums, so a conversation of any length is digested by many tasks:
turns are sorted by range, each task sums its own part, one small row per task is folded on the driver, and a second
pass adds what went before.

*Node tables.* Distinct digests with their counts are one aggregation. Nodes go to shards by *light roots*: a node is
heavy when more than a bound of turns stand below it, and a light root is a light node with a heavy parent, so that the
subtree of a light root fits one task, whatever is common. A shard gives its digests slots by a minimal perfect hash
(``NodeTable``), checks each looked-up slot against the digest stored there, scatters the counts into flat arrays and
adds up subtrees through the slots of parents, deepest nodes first. Totals of light roots then enter the table of the
heavy nodes, of which there are at most ``MOST_HEAVY``. What follows a node with one member is a chain of that
conversation alone; its values are known without a table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import P61 as P
from tidemark.llm.common import addmod, doubled, materialized, mixed, mulmod, reduced, runs_of, ship, submod, times31
from tidemark.sources.store import stored

FAMILY, HEADS = 5, 9  # conversations that take their beginning from one; beginnings have fewer turns than HEADS
BASES = (0x0F1BBCDC5A1B2C3D % P, 0x1A2B3C4D5E6F7081 % P)
SALT = 65_536  # turns of a conversation that meet their conversation's row on one key
REACH = 32  # turns below a node that count in its weight, for each member
LEAST_HEAVY = 512
MOST_HEAVY = 1_000_000  # heavy nodes; the bound of what is broadcast
NODE = ["depth", "a1", "a2"]

_U = np.uint64


_TABLES: dict[int, np.ndarray] = {}


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to non-negative exponents: a table for the low 16 bits, and one power for each distinct high part."""
    table = _TABLES.get(base)
    if table is None:
        table = _TABLES[base] = doubled(base, 1 << 16)
    low, high = exponents & 0xFFFF, exponents >> 16
    out = table[low]
    if high.any():
        values, where = np.unique(high, return_inverse=True)
        out = mulmod(out, np.array([pow(base, int(v) << 16, P) for v in values], _U)[where])
    return out


def _running(x: np.ndarray) -> np.ndarray:
    """Prefix sums modulo P; halves are summed apart, so that nothing overflows."""
    low, high = x & _U((1 << 31) - 1), x >> _U(31)
    return addmod(reduced(times31(reduced(np.cumsum(high)))), reduced(np.cumsum(low)))


class Scan:
    """Places and prefix digests of sorted turns that come in batches; ``state`` is (conversation, turns, sums)."""

    def __init__(self, state: tuple[int, int, int, int] | None = None):
        self.state = state

    def advance(self, conv: np.ndarray, turns: tuple[np.ndarray, np.ndarray]):
        """(place from 0, digests after each turn, digests before it, where conversations begin)."""
        starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(conv))))
        place = np.arange(len(conv)) - starts[of]
        carried = self.state if self.state is not None and self.state[0] == conv[0] else None
        first = of == 0
        if carried:
            place[first] += carried[1]
        after, before = [], []
        for i, turn in enumerate(turns):
            run = _running(mulmod(turn, powers(BASES[i], place)))
            earlier = np.concatenate([np.zeros(1, _U), run[:-1]])
            base = earlier[starts][of]
            parts = [submod(run, base), submod(earlier, base)]
            if carried:
                parts = [np.where(first, addmod(x, np.full(len(x), carried[2 + i], _U)), x) for x in parts]
            after.append(parts[0])
            before.append(parts[1])
        self.state = (int(conv[-1]), int(place[-1]) + 1, int(after[0][-1]), int(after[1][-1]))
        return place, after, before, starts


def _joined(a, b):
    """The state after a part with state ``a`` followed by a part of the same conversation with state ``b``."""
    if a is None or a[0] != b[0]:
        return b
    return (b[0], a[1] + b[1], *((a[2 + i] + pow(BASES[i], a[1], P) * b[2 + i]) % P for i in range(2)))


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _hashes(batch, names: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(_column(batch, name).astype(_U) for name in names)


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array(values.astype(np.int64)) for name, values in columns.items()})


def digested(conversations: DataFrame) -> DataFrame:
    """Every turn with its place in its conversation (from 0), the digests of the turns up to it (s1, s2) and before it
    (p1, p2), and the bytes of its text."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    digest = F.sha2(F.concat(F.sha2(role.cast("binary"), 256), F.sha2(text.cast("binary"), 256)), 256)
    number = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        number(1).alias("t1"), number(16).alias("t2"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = ["conv_id", "turn", "role", "t1", "t2"]  # nulls come first
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialized(placed.select("conv_id", "t1", "t2", "n_bytes", F.spark_partition_id().alias("chunk")))

    def edges(batches):
        scan, first, chunk = Scan(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, conv, earlier = batch.column("chunk")[0].as_py(), _column(batch, "conv_id"), scan.state
            place, after, _, starts = scan.advance(conv, _hashes(batch, ("t1", "t2")))
            if first is None and earlier is not None and earlier[0] != conv[0]:
                first = earlier  # the first conversation of the chunk ended with the last batch
            elif first is None and len(starts) > 1:
                end = int(starts[1]) - 1
                first = (int(conv[end]), int(place[end]) + 1, int(after[0][end]), int(after[1][end]))
        if chunk is not None:
            row = (chunk, *(first or scan.state), first is None, *scan.state)
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if i == 0 else None) for i, v in enumerate(row)], names=names)

    ship(conversations.sparkSession)
    ddl = "chunk int, c long, n long, x1 long, x2 long, whole boolean, lc long, ln long, lx1 long, lx2 long"
    names = [part.split()[0] for part in ddl.split(", ")]
    summary = placed.mapInArrow(edges, ddl)
    carried: dict[int, tuple] = {}
    state = None
    for row in sorted(summary.collect()):  # one row for each task of the sort
        chunk, first, whole, last = row[0], tuple(row[1:5]), row[5], tuple(row[6:10])
        if state is not None and state[0] == first[0]:
            carried[chunk] = state
        state = _joined(state, first) if whole else last

    def scanned(batches):
        scan = None
        for batch in batches:
            if not batch.num_rows:
                continue
            scan = scan or Scan(carried.get(batch.column("chunk")[0].as_py()))
            conv = _column(batch, "conv_id")
            place, after, before, _ = scan.advance(conv, _hashes(batch, ("t1", "t2")))
            yield _batch({"conv_id": conv, "place": place, "s1": after[0], "s2": after[1], "p1": before[0], "p2": before[1], "n_bytes": _column(batch, "n_bytes")})

    return placed.mapInArrow(scanned, "conv_id long, place long, s1 long, s2 long, p1 long, p2 long, n_bytes long")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """The prefixes of every rebuilt conversation, the empty one included.

    A conversation c takes the first h turns of conversation ``c - c % family``, h being the CRC-32 of its decimal id
    modulo ``heads``, and goes on with its own turns after its first h. One row per prefix: conv_id, depth, digest
    (a1, a2), digest of the prefix before (u1, u2), n_bytes of its last text, and total, the turns of the conversation.
    """
    begins = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    turns = turns.withColumn("h", begins)
    last_skipped = F.col("place") == F.col("h") - 1
    convs = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("own"),
        *(F.coalesce(F.max(F.when(last_skipped, F.col(f"s{i}"))), F.lit(0).cast("long")).alias(f"k{i}") for i in (1, 2)),
    )
    turn = F.struct("place", "s1", "s2", "p1", "p2", "n_bytes")
    first = (
        turns.filter((F.col("place") < heads - 1) & (F.col("conv_id") % family == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("head"))  # fewer than ``heads`` turns
    )
    convs = (
        convs.withColumns({"h": begins, "base": F.col("conv_id") - F.col("conv_id") % family})
        .join(first, "base", "left")
        .withColumn("head", F.slice("head", F.lit(1), F.col("h")))
        .withColumn("taken", F.coalesce(F.size("head"), F.lit(0)))
        .withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .withColumns({f"b{i}": F.when(F.col("taken") > 0, F.element_at("head", -1)[f"s{i}"]).otherwise(F.lit(0).cast("long")) for i in (1, 2)})
    )
    # A long conversation's turns meet its row under many keys.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("own") - 1) / SALT)))
    keyed = convs.select("conv_id", salts.alias("salt"), "k1", "k2", "b1", "b2", "taken", "total")
    own = turns.filter("place >= h").withColumn("salt", F.floor(F.col("place") / SALT)).join(keyed, ["conv_id", "salt"])
    inverse = [pow(base, -1, P) for base in BASES]

    def moved(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {n: _column(batch, n) for n in batch.schema.names}
            back = (c["h"] - c["taken"]).astype(np.int64)
            out = {"conv_id": c["conv_id"], "depth": c["taken"] + c["place"] - c["h"] + 1}
            for name, source in (("a", "s"), ("u", "p")):
                for i in (1, 2):
                    rest = submod(c[f"{source}{i}"].astype(_U), c[f"k{i}"].astype(_U))
                    out[f"{name}{i}"] = addmod(c[f"b{i}"].astype(_U), mulmod(rest, powers(inverse[i - 1], back)))
            yield _batch({**out, "n_bytes": c["n_bytes"], "total": c["total"]})

    ddl = "conv_id long, depth long, a1 long, a2 long, u1 long, u2 long, n_bytes long, total long"
    own = own.select("conv_id", "place", "s1", "s2", "p1", "p2", "n_bytes", "h", "k1", "k2", "b1", "b2", "taken", F.col("total").cast("long").alias("total"))
    taken = convs.select("conv_id", "total", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.place") + 1).alias("depth"), F.col("t.s1").alias("a1"), F.col("t.s2").alias("a2"),
        F.col("t.p1").alias("u1"), F.col("t.p2").alias("u2"), F.col("t.n_bytes").alias("n_bytes"), F.col("total").cast("long").alias("total"),
    )
    zero = [F.lit(0).cast("long").alias(n) for n in ("depth", "a1", "a2", "u1", "u2", "n_bytes")]
    root = convs.select("conv_id", *zero, F.col("total").cast("long").alias("total"))
    return own.mapInArrow(moved, ddl).unionByName(taken).unionByName(root)


class NodeTable:
    """Slots 0 .. n-1 for n distinct nodes by a minimal perfect hash.

    Each level throws the nodes that are left into twice as many bits; whoever is alone there has its slot, the rank of
    its bit. A look-up stops at the first set bit and is believed only if the digest stored in that slot is the same.
    """

    def __init__(self, depth: np.ndarray, a1: np.ndarray, a2: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []
        slot, left, used = np.empty(len(a1), np.int64), np.arange(len(a1)), 0
        while len(left):
            size = max(64, 2 * len(left))
            at = self._place(len(self.levels), size, depth[left], a1[left], a2[left])
            alone = np.bincount(at, minlength=size)[at] == 1
            ranks = np.full(size, -1, np.int64)
            bits = np.sort(at[alone])
            ranks[bits] = used + np.arange(len(bits))
            self.levels.append((size, ranks))
            slot[left[alone]] = ranks[at[alone]]
            used += len(bits)
            left = left[~alone]
        self.slot = slot
        self.key = np.empty((3, len(a1)), np.int64)
        self.key[:, slot] = depth, a1, a2

    @staticmethod
    def _place(level: int, size: int, depth: np.ndarray, a1: np.ndarray, a2: np.ndarray) -> np.ndarray:
        seeded = mixed(a1.astype(_U) + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        return (mixed((seeded ^ a2.astype(_U)) + depth.astype(_U)) % _U(size)).astype(np.int64)

    def find(self, depth: np.ndarray, a1: np.ndarray, a2: np.ndarray) -> np.ndarray:
        """Slots, or -1 for nodes that are not in the table."""
        out, open_ = np.full(len(a1), -1, np.int64), np.arange(len(a1))
        for level, (size, ranks) in enumerate(self.levels):
            found = ranks[self._place(level, size, depth[open_], a1[open_], a2[open_])]
            hit = found >= 0
            slot, who = found[hit], open_[hit]
            same = (self.key[0, slot] == depth[who]) & (self.key[1, slot] == a1[who]) & (self.key[2, slot] == a2[who])
            out[who[same]] = slot[same]
            open_ = open_[~hit]
        return out


def accumulate(nodes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Subtree sums of the nodes of one table. ``children``, ``leaves`` and ``saved`` hold what comes from outside of it."""
    table = NodeTable(nodes["depth"], nodes["a1"], nodes["a2"])
    flat = {}
    for name, values in nodes.items():  # scattered to their slots
        flat[name] = np.empty_like(values)
        flat[name][table.slot] = values
    depth, parent = flat["depth"], table.find(flat["depth"] - 1, flat["u1"], flat["u2"])
    inside = parent >= 0
    np.add.at(flat["children"], parent[inside], 1)
    flat["leaves"] += flat["children"] == 0
    flat["saved"] += (flat["n_convs"] - 1) * flat["n_bytes"]
    order = np.argsort(depth, kind="stable")
    levels = np.flatnonzero(np.diff(depth[order])) + 1
    for at in reversed(np.split(order, levels)):
        at = at[inside[at]]
        for name in ("leaves", "saved"):
            np.add.at(flat[name], parent[at], flat[name][at])
    flat["parent_conv_id"] = np.where(inside, flat["conv_id"][parent], np.iinfo(np.int64).min)
    return flat


_IN = [*NODE, "u1", "u2", "conv_id", "n_convs", "n_bytes", "children", "leaves", "saved"]
_OUT = [*NODE, "u1", "u2", "conv_id", "parent_conv_id", "n_convs", "children", "leaves", "saved"]


def _tables(nodes: DataFrame, key: str) -> DataFrame:
    """``accumulate`` over whole runs of ``key``; the rows are partitioned and sorted by it."""

    def shard(batches) -> Iterator[pa.RecordBatch]:
        for run in runs_of(batches, key):
            flat = accumulate({name: run.column(name).to_numpy().copy() for name in _IN})
            outside = flat["parent_conv_id"] == np.iinfo(np.int64).min
            arrays = [pa.array(flat[name], mask=outside if name == "parent_conv_id" else None) for name in _OUT]
            yield pa.RecordBatch.from_arrays(arrays, names=_OUT)

    return nodes.mapInArrow(shard, ", ".join(f"{name} long" for name in _OUT))


def _ends(prefixes: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, in order. Ids are joined to strings where they lie
    sorted, so that the one task of a node reads few and long rows."""

    def strings(batches):
        held, n = [], 0

        def flushed():
            table = pa.Table.from_batches(held)
            c = {name: table.column(name).to_numpy() for name in (*NODE, "conv_id")}
            order = np.lexsort((c["conv_id"], c["a2"], c["a1"], c["depth"]))
            c = {name: values[order] for name, values in c.items()}
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(c["depth"]) != 0) | (np.diff(c["a1"]) != 0) | (np.diff(c["a2"]) != 0)
            at = np.flatnonzero(new)
            ids = c["conv_id"].tolist()
            joined = [",".join(map(str, ids[i:j])) for i, j in zip(at, [*at[1:], len(ids)])]
            arrays = [pa.array(c[name][at]) for name in (*NODE, "conv_id")]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(joined)], names=[*NODE, "first", "ids"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
                if n >= 100_000:
                    yield flushed()
                    held, n = [], 0
        if held:
            yield flushed()

    def hashed(batches):
        key = digest = None
        for batch in batches:
            rows = []
            for *node, _, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if node != key:
                    if key is not None:
                        rows.append((*key, digest.hexdigest()))
                    key, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[*NODE, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, digest.hexdigest())], names=[*NODE, "ends_sha256"])

    ends = prefixes.filter("depth = total").select(*NODE, "conv_id").repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    joined = ends.mapInArrow(strings, "depth long, a1 long, a2 long, first long, ids string")
    dealt = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.mapInArrow(hashed, "depth long, a1 long, a2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, least_heavy: int = LEAST_HEAVY) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Columns: the node's digest (depth, a1, a2) and its parent's (u1, u2); conv_id (smallest member), parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Turns of a conversation are ordered by turn, null first;
    equal ones by role and then by a hash of role and text; repeated rows are turns of their own. A null role or text is
    empty. Rows without conv_id belong to no conversation. An empty table has no node, not even a root. Other columns
    are not read.
    """
    # Stored rather than checkpointed: a checkpoint works its rows out twice, and keeps a task for each shuffle partition.
    # Digests are read three times below.
    prefixes = stored(rebuilt(stored(digested(conversations)), family, heads))
    below = F.least(F.col("total") - F.col("depth") + 1, F.lit(REACH))
    nodes = stored(
        prefixes.groupBy(*NODE).agg(
            F.min("u1").alias("u1"), F.min("u2").alias("u2"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
            F.max("n_bytes").alias("n_bytes"), F.max("total").alias("total"), F.sum(below).alias("weight"),
        )
    )
    # Weights add up to at most REACH for each prefix, which bounds the number of heavy nodes.
    bound = max(least_heavy, REACH * prefixes.count() // MOST_HEAVY)
    is_heavy = ((F.col("weight") > bound) & (F.col("n_convs") > 1)) | (F.col("depth") == 0)
    heavy = nodes.filter(is_heavy)
    marked = prefixes.join(F.broadcast(heavy.select(*NODE)), NODE, "left_anti")
    roots = marked.groupBy("conv_id").agg(F.min(F.struct(*NODE)).alias("root")).select(
        "conv_id", F.col("root.depth").alias("r0"), F.col("root.a1").alias("r1"), F.col("root.a2").alias("r2")
    )
    # Nodes of one member: the first of a conversation hangs on a shared node, the others on each other.
    single = nodes.filter((F.col("n_convs") == 1) & (F.col("depth") > 0))
    begin = single.groupBy("conv_id").agg(F.min("depth").alias("z"), F.max("depth").alias("most"))
    salts = F.explode(F.sequence(F.floor(F.col("z") / SALT), F.floor(F.col("most") / SALT)))
    single = single.withColumn("salt", F.floor(F.col("depth") / SALT)).join(begin.select("conv_id", "z", salts.alias("salt")), ["conv_id", "salt"])
    none = F.lit(0).cast("long")
    goes_on = F.when((F.col("n_convs") == 1) & (F.col("depth") < F.col("total")), 1).otherwise(0).cast("long")
    # A single node that goes on has one child, which is not in the table, and so one leaf.
    columns = [*NODE, "u1", "u2", "conv_id", "n_convs", "n_bytes", goes_on.alias("children"), goes_on.alias("leaves"), none.alias("saved")]
    shared = nodes.filter(~is_heavy & (F.col("n_convs") > 1)).select(*columns)
    light = shared.unionByName(single.filter("depth = z").select(*columns)).join(roots, "conv_id")
    dealt = light.repartition("r1", "r2", "r0").sortWithinPartitions("r1", "r2", "r0", "depth")
    done = stored(_tables(dealt.select(*_IN, "r1"), "r1"))

    outer = F.col("parent_conv_id").isNull()
    from_below = done.filter(outer).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("u1").alias("a1"), F.col("u2").alias("a2")
    ).agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = heavy.join(from_below, NODE, "left").select(
        *NODE, "u1", "u2", "conv_id", "n_convs", "n_bytes", *(F.coalesce(c, none).alias(c) for c in ("children", "leaves", "saved")), none.alias("one")
    )
    top = _tables(top.repartition(1, "one"), "one")  # at most MOST_HEAVY nodes
    above = F.broadcast(heavy.select((F.col("depth") + 1).alias("depth"), F.col("a1").alias("u1"), F.col("a2").alias("u2"), F.col("conv_id").alias("above")))
    done = done.join(above, ["depth", "u1", "u2"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    chain = single.filter("depth > z").select(
        *NODE, "u1", "u2", "conv_id", F.col("conv_id").alias("parent_conv_id"), "n_convs", goes_on.alias("children"),
        F.lit(1).cast("long").alias("leaves"), none.alias("saved"),
    )
    found = done.select(*_OUT).unionByName(top).unionByName(chain)
    empty = hashlib.sha256(b"").hexdigest()
    return found.join(_ends(prefixes), NODE, "left").select(
        *NODE, "u1", "u2", "conv_id", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
