"""The conversation trie against a plain model, for shards of all sizes and awkward tables."""

import hashlib
import os
import random
import sys
import zlib
from collections import Counter

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import trie  # noqa: E402

DDL = "conv_id long, turn long, role string, text string, depth string, a1 string, total string"


def turn_order(turn, role, text):
    role, text = role or "", text or ""
    both = hashlib.sha256(role.encode()).hexdigest() + hashlib.sha256(text.encode()).hexdigest()
    digest = hashlib.sha256(both.encode()).hexdigest()
    return (turn is not None, turn or 0, role, int(digest[:15], 16), int(digest[15:30], 16))


def model(rows):
    convs = {}
    for c, *turn in rows:
        if c is not None:
            convs.setdefault(c, []).append(turn)
    own = {c: [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: turn_order(*x))] for c, turns in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + own[c][h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1].encode()) if path else 0
    out = Counter()
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out[(min(who), len(path), parent, len(who), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(frame, **how):
    return Counter(tuple(r) for r in trie.prefix_trie(frame, **how).select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], DDL)


def random_rows(seed, convs=60, words=2, longest=14):
    chosen, rows = random.Random(seed), []
    for c in range(convs):
        for turn in range(chosen.randrange(0, longest)):
            rows.append((c, turn, chosen.choice(["user", "assistant"][:1] + [None]), chosen.choice(["é", "yes", "", None][:words + 1])))
    return rows


def test_op13_equals_the_model(spark):
    rows = random_rows(1)
    rows += [(None, 0, "user", "no id"), (None, None, None, None), (-7, 1, "user", "x"), (-7, 0, "user", "yes"), (-5, 3, "user", "é")]
    rows += [(70, None, "user", "z"), (70, None, "user", "a"), (70, None, None, None), (70, 1, "user", "é"), (70, 1, "user", "é"), (70, -1, "bot", "b")]
    rows += [(71, t, "user", "yes") for t in range(40)] + [(72, t, "user", "yes") for t in range(40)] + [(200, 0, "user", "alone" * 5000)]
    chosen = random.Random(2)
    chosen.shuffle(rows)
    table = frame(spark, rows)
    expected = model(rows)
    assert built(table) == expected
    assert built(table, least_heavy=3) == expected  # nearly all shared nodes are heavy
    assert built(table, least_heavy=100) == expected
    assert built(table.repartition(7), least_heavy=40) == expected


def test_op13_small_tables(spark):
    assert built(frame(spark, [])) == Counter()
    for rows in ([(3, 0, "user", "x")], [(0, 0, None, None)], [(None, 0, "user", "x")], [(4, 0, "a", "b"), (9, 0, "a", "b")]):
        assert built(frame(spark, rows)) == model(rows), rows


def test_op13_one_conversation_holds_most_rows(spark, monkeypatch):
    """Its turns are digested by several tasks, and meet their conversation's row under several keys."""
    monkeypatch.setattr(trie, "SALT", 64)
    rows = [(5, t, "user", ["no", "yes"][bin(t).count("1") % 2]) for t in range(330)]
    rows += [(6, t, "user", ["no", "yes"][bin(t).count("1") % 2]) for t in range(210)] + random_rows(4, convs=4)
    assert built(frame(spark, rows), least_heavy=500) == model(rows)


def test_op13_turns_are_digested_once(spark, tmp_path, monkeypatch):
    import uuid

    plain, folder = trie.digested, str(tmp_path)

    def noted(batches):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    def counted(conversations):
        turns = plain(conversations)
        return turns.mapInArrow(noted, turns.schema)

    frame = spark.createDataFrame([(c, t, "user", f"text {c % 3} {t}", "", "", "") for c in range(20) for t in range(4)], DDL)
    parts = plain(frame).rdd.getNumPartitions()
    monkeypatch.setattr(trie, "digested", counted)
    assert trie.prefix_trie(frame).count() > 1
    assert len(list(tmp_path.iterdir())) == parts


def test_op13_repeated_patterns_have_different_digests():
    """The Thue-Morse word and its complement collide under any base modulo 2^64; here they must not."""
    bits = np.array([bin(i).count("1") % 2 for i in range(4096)])
    turns = np.array([12345, 67890], np.uint64)
    sums = []
    for word in (bits, 1 - bits):
        scan = trie.Scan()
        scan.advance(np.zeros(4096, np.int64), (turns[word], turns[word]))
        sums.append(scan.state[2:])
    assert sums[0][0] != sums[1][0] and sums[0][1] != sums[1][1]
    exact = [sum(int(turns[b]) * pow(base, i, trie.P) for i, b in enumerate(bits)) % trie.P for base in trie.BASES]
    assert list(sums[0]) == exact


def test_op13_node_table():
    rng = np.random.default_rng(1)
    a1, a2 = rng.integers(0, trie.P, 50_000), rng.integers(0, trie.P, 50_000)
    a1[:100] = a1[0]  # half a digest in common
    depth = rng.integers(0, 30, 50_000)
    table = trie.NodeTable(depth, a1, a2)
    assert sorted(table.slot.tolist()) == list(range(50_000))
    assert (table.find(depth, a1, a2) == table.slot).all()
    assert (table.find(depth + 31, a1, a2) == -1).all() and (table.find(depth, a2, a1) == -1).all()
    assert len(trie.NodeTable(depth[:0], a1[:0], a2[:0]).find(depth, a1, a2)) == 50_000


def test_op13_query(spark, sf):
    import __spark_entry__

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = __spark_entry__.queries()["op13_conversation_trie"](spark, sf)
    assert got.columns == COLUMNS
    assert Counter(tuple(r) for r in got.collect()) == model(rows)
