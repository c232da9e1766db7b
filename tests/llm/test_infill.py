"""Fill-in-the-middle against a plain model: cuts, outputs, restoration, repeated rows and awkward texts."""

import hashlib
import os
import random
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))
import helpers as h  # noqa: E402

from tidemark.llm import infill  # noqa: E402


def model(doc, text):
    text = text or ""
    hexes = hashlib.sha256(("1:" + ("" if doc is None else str(doc))).encode()).hexdigest()
    a, b, c, d = (int(hexes[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if n == 0 or "<P>" in text or "<S>" in text or "<M>" in text or c % 100 >= 90:
        return (doc, n, "plain", None, None), text
    low, high = min(a % (n + 1), b % (n + 1)), max(a % (n + 1), b % (n + 1))
    p, m, s = text[:low], text[low:high], text[high:]
    if d % 100 < 20:
        return (doc, n, "spm", low, high - low), f"<S>{s}<P>{p}<M>{m}"
    return (doc, n, "psm", low, high - low), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def awkward(spark):
    frame, rows = h.documents(spark)
    more = [(100 + i, t) for i, t in enumerate(["a<P>b", "x<S>", "<M>", "<P", ">", "<", "P><S", "🙂<", "<<<>>>", "é" * 5, "a" * 30_000])]
    more += [(7, h.BASE_TEXT)] * 3 + [(None, None), (None, ""), (-5, "negative id")]
    extra = spark.createDataFrame([(i, t, *["clash"] * 9) for i, t in more], frame.schema)
    return frame.unionByName(extra), rows + more


def test_op12_equals_the_model(spark):
    frame, rows = awkward(spark)
    expected, texts = Counter(), Counter()
    for doc, text in rows:
        row, output = model(doc, text)
        expected[(*row, sha(output), sha(text or ""))] += 1
        texts[(*row, output)] += 1
    for chunk in (infill.CHUNK, 3):
        cut = infill.pieces(frame, chunk=chunk)
        assert Counter(tuple(r) for r in infill.digests(cut).collect()) == expected
        assert Counter(tuple(r) for r in infill.outputs(cut).collect()) == texts
    # Copies that meet in one task, in many tasks, and in many batches.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        for spread in (frame.coalesce(1), frame.repartition(5)):
            assert Counter(tuple(r) for r in infill.digests(infill.pieces(spread, chunk=11)).collect()) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert infill.digests(infill.pieces(frame.limit(0))).collect() == []


def test_op12_restoration_finds_markers_across_pieces():
    chosen = random.Random(3)
    for _ in range(2000):
        text = "".join(chosen.choice("<>PSM a🙂") for _ in range(chosen.randrange(1, 30)))
        how = infill.cut(chosen.randrange(1000), text)
        output = "".join(infill.output_pieces(text, how, 4)).encode()
        restorer, found, at = infill.Restorer(how.form), {0: b"", 1: b"", 2: b""}, 0
        while at < len(output):
            step = chosen.randrange(1, 5)
            for rank, body in restorer.feed(output[at : at + step]):
                found[rank] += body
            at += step
        for rank, body in restorer.feed(b"", last=True):
            found[rank] += body
        assert (found[0] + found[1] + found[2]).decode() == text


def test_op12_one_exchange(spark):
    frame, _ = h.documents(spark)
    plan = infill.digests(infill.pieces(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan


def test_op12_query(spark, sf):
    import __spark_entry__

    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in __spark_entry__.queries()["op12_fill_in_middle"](spark, sf).collect())
    expected = Counter()
    for doc, text in rows:
        row, output = model(doc, text)
        expected[(*row, sha(output), sha(text or ""))] += 1
    assert got == expected
