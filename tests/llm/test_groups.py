"""Joins, duplicates, toxicity and the pipeline against brute force."""

import os
import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import helpers as h  # noqa: E402

from tidemark.llm import embeddings, jaccard, suffixes, toxicity  # noqa: E402
from tidemark.llm.common import freeing  # noqa: E402
from tidemark.llm.components import components  # noqa: E402

import corpus_pipeline  # noqa: E402


def test_components_of_paths_stars_and_loops(spark):
    chosen = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 350)] + [(5, 5)] + [(chosen.randrange(1000, 1200), chosen.randrange(1000, 1200)) for _ in range(150)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_op4_groups(spark, size, percent):
    frame, rows = h.documents(spark)
    chosen = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    more = []
    for family in range(12):
        base = [chosen.choice(words) for _ in range(chosen.choice([20, 80, 300]))]
        for copy in range(chosen.choice([2, 5, 25])):
            text = list(base)
            for _ in range(chosen.randrange(0, 7)):
                text[chosen.randrange(len(text))] = chosen.choice(words)
            more.append((100 + 30 * family + copy, " ".join(text[: len(text) - chosen.randrange(3)])))
    every = frame.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(every, size=size, percent=percent).collect())
    roots, sizes = h.groups(rows + more, size, percent)
    assert got == Counter((doc, n, root) for (doc, _), n, root in zip(rows + more, sizes, roots))
    assert jaccard.jaccard_groups(frame.limit(0)).collect() == []


def test_op4_recursion_and_blocks_find_the_same_links():
    chosen = random.Random(3)
    sets = []
    for family in range(6):
        base = [chosen.randrange(1 << 40) for _ in range(100)]
        sets += [np.unique(np.array(base[: 100 - chosen.randrange(15)] + [chosen.randrange(1 << 40) for _ in range(chosen.randrange(12))], np.uint64)) for _ in range(40)]

    def joined(leaf):
        out, root = [], list(range(len(sets)))
        jaccard.links_within(sets, np.arange(len(sets)), 90, out, leaf=leaf)
        for a, b in out:
            for x, y in zip(a.tolist(), b.tolist()):
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
        def top(x):
            while root[x] != x:
                x = root[x]
            return x
        return [top(x) for x in range(len(sets))]

    assert joined(10_000) == joined(8) == joined(64)


def test_spans_hash_by_their_bytes_alone():
    """Equal spans have equal hashes wherever they stand; the Thue-Morse word and its complement differ, under both bases."""
    from tidemark.llm.common import P61, BASES, SpanHash, mixed

    bits = np.array([bin(i).count("1") % 2 for i in range(2048)], np.uint8)
    data = np.concatenate([bits + 97, 98 - bits, bits + 97, np.frombuffer(b"tail", np.uint8)])
    for which in (0, 1):
        spans = SpanHash(data, which)
        a, b, c = spans.of(np.array([0, 2048, 4096]), np.array([2048, 4096, 6144]))
        assert a == c != b
        base = BASES[which] % P61
        exact = sum((int(x) + 1) * pow(base, i, P61) for i, x in enumerate(data[2048:4096])) % P61
        assert b == mixed(np.array([exact], np.uint64))[0]
        fixed = spans.fixed(50)
        assert (fixed == spans.of(np.arange(len(data) - 49), np.arange(50, len(data) + 1))).all()
        words = {data[i : i + 50].tobytes() for i in range(len(data) - 49)}
        assert len(np.unique(fixed)) == len(words)
        assert len(SpanHash(data[:10], which).fixed(11)) == 0
    long = np.random.default_rng(1).integers(0, 256, 3_000_000).astype(np.uint8)
    long[2_900_000:] = long[:100_000]
    spans = SpanHash(long)
    assert spans.of(np.array([0]), np.array([100_000]))[0] == spans.of(np.array([2_900_000]), np.array([3_000_000]))[0]


def test_op4_words_of_one_pattern_are_not_linked(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, word.upper()), (4, f"{word} {other} x"), (5, f"{other} {word} x")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=90).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_op4_words_made_to_collide_are_not_linked(spark):
    # These two words had one hash while the base was a known number.
    word, other = "z~w||~~{~}|~yvy{", "~~~~~}z~|~~v~~~~"
    rows = [(1, word), (2, other), (3, word), (4, f"x {word} y {other} y x {other} y {word} y"), (5, f"x {other} y"), (6, f"x {word} y")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), size=3, percent=90).collect()}
    roots, sizes = h.groups(rows, 3, 90)
    assert got == {doc: (n, root) for (doc, _), n, root in zip(rows, sizes, roots)}
    assert roots == [1, 2, 1, 4, 5, 6]


def test_op8_links_and_recall(spark):
    chosen = np.random.default_rng(5)
    base = chosen.normal(size=(300, 32))
    near = base + chosen.normal(size=base.shape) * 0.2
    rows = [[float(x) for x in v] for v in np.concatenate([base, near, base[:40], base[:5] * 3])]
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [1.0, None] * 16, [float("inf")] + [1.0] * 31]
    frame = spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows + odd)] + [(None, rows[0], "x")], "vec_id long, embedding array<double>, component_id string")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame).collect()}
    unit = np.array(rows)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    n = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (n <= linked.sum(axis=1)).all() and n.sum() >= 0.9 * linked.sum()
    for i in range(len(rows)):
        assert got[i]["component_id"] <= i and got[i]["kept"] == (got[i]["component_id"] == i)
    for i in range(len(rows), len(rows) + len(odd)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[600]["n_links"] == got[0]["n_links"] >= 2  # a copy has the links of the first one
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def test_op8_very_large_and_very_small_numbers(spark):
    rows = [(1, [1e-200, 0.0]), (2, [1e200, 1e200]), (3, [1.0, 1.0]), (4, [5e-324, 5e-324]), (5, [1.0, 0.0]), (6, [-1e308, 1e308]), (7, [0.0, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 5: (1, 1), 2: (2, 2), 3: (2, 2), 4: (2, 2), 6: (0, 6), 7: (0, 7)}
    normal = np.random.default_rng(1).normal(size=(50, 8))
    assert (embeddings.unit(normal) == normal / np.linalg.norm(normal, axis=1, keepdims=True)).all()


def test_op8_large_buckets_and_families_in_blocks(spark):
    chosen = np.random.default_rng(6)
    hub = chosen.normal(size=16)
    rows = [[float(x) for x in hub + chosen.normal(size=16) * 0.02] for _ in range(120)] + [[float(x) for x in v] for v in chosen.normal(size=(60, 16))]
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, block=16).collect()}
    assert all(got[i]["component_id"] == 0 and got[i]["n_links"] == 119 for i in range(120))


def cosine_links(unit):
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    return linked


def test_op8_near_copies_inside_topic_clusters(spark):
    chosen = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    topics = np.repeat(unit(chosen.normal(size=(6, 64))), 80, axis=0)
    members = unit(topics * 0.89 + unit(chosen.normal(size=topics.shape)) * 0.456)  # cosines of about 0.8 in a topic
    copies = unit(members + unit(chosen.normal(size=members.shape)) * 0.2)
    rows = np.concatenate([members, copies])
    linked = cosine_links(rows)
    assert linked.sum() < 4 * len(rows)
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    for block in (embeddings.BLOCK, 64):
        n = sum(r["n_links"] for r in embeddings.near_duplicates(frame, block=block).collect())
        assert 0.98 * linked.sum() <= n <= linked.sum()


def hard_vectors(n=1200):
    """Isotropic, clustered, shared-mean and low-dimensional vectors, each with a partner at a cosine of 0.90 to 0.95."""
    chosen = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    draw = lambda d: unit(chosen.normal(size=(n, d)))
    kinds = {
        "isotropic": draw(64),
        "clustered": unit(np.repeat(draw(63)[:20], n // 20, axis=0) * 0.85 + draw(63) * 0.53),
        "shared mean": unit(np.sqrt(0.8) * draw(62)[:1] + np.sqrt(0.2) * draw(62)),
        "few components": draw(16),
    }
    for name, x in kinds.items():
        away = draw(x.shape[1])
        away = unit(away - (away * x).sum(axis=1, keepdims=True) * x)
        cosine = chosen.uniform(0.9, 0.95, size=(n, 1))
        kinds[name] = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * away])
    return kinds


@pytest.mark.parametrize("kind", ["isotropic", "clustered", "shared mean", "few components"])
def test_op8_recall_near_the_threshold(spark, kind):
    x = hard_vectors()[kind]
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found, true = sum(r["n_links"] for r in embeddings.near_duplicates(frame).collect()), cosine_links(x).sum()
    assert 0.9 * true <= found <= true


@pytest.mark.parametrize("kind", ["isotropic", "clustered", "few components"])
def test_op8_tables_reach_the_recall(kind):
    x = hard_vectors()[kind]
    plan = embeddings.Plan(x, 0.9, 50_000)
    assert 0 < plan.tables <= embeddings.MOST_TABLES
    chunks = plan.projections[0].shape[1] // plan.width
    codes = [embeddings.codes_of(x, plan.mean, p) for p in plan.projections]
    half = len(x) // 2
    apart = [c[:half] ^ c[half:] for c in codes]
    met = np.any([apart[t // chunks] & embeddings.chunk_mask(t % chunks, plan.width) == 0 for t in range(plan.tables)], axis=0)
    near = sum(np.bitwise_count(a).astype(int) for a in apart[: plan.sketches]) <= plan.radius
    assert (met & near).mean() >= 0.9


@pytest.mark.parametrize("length,width,large", [(200, 101, 65_536), (40, 20, 65_536), (200, 101, 2), (40, 20, 1)])
def test_op9_repeats(spark, length, width, large):
    frame, rows = h.documents(spark)
    chosen = random.Random(4)
    shared = "".join(chosen.choice("ab ") for _ in range(260))
    more = [(100 + i, "".join(chosen.choice("abc ") for _ in range(50)) + shared[chosen.randrange(60) :] + chosen.choice(["", "tail", shared[:45]])) for i in range(40)]
    every = frame.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    bodies = suffixes._bodies(every, "doc_id", "text")
    spans = suffixes.repeated_spans(bodies.drop("own"), length, width, large).groupBy("id", "check").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    schema = "id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    got = bodies.join(spans, ["id", "check"], "left").select("id", "body", "spans").mapInArrow(suffixes._cut, schema).collect()
    texts = rows + more
    expected = Counter((-1 if doc is None else doc, kept) for (doc, _), (kept, _) in zip(texts, h.without_repeats([t for _, t in texts], length)))
    assert Counter((r["id"], bytes(r["kept"])) for r in got) == expected
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_bytes"] - len(r["kept"])
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_op9_texts_without_id_of_equal_hash(spark):
    text = F.concat(*(F.sha2(F.concat_ws(":", "id", F.lit(i)), 256) for i in range(5)))
    texts = spark.range(300_000).select(text.alias("text"), F.hash(text).alias("h"))
    same = texts.groupBy("h").agg(F.sort_array(F.collect_list("text")).alias("texts")).filter("size(texts) = 2").orderBy("h").first()["texts"]
    frame = spark.createDataFrame([(None, same[0]), (None, same[1]), (1, same[0][:250])], "doc_id long, text string")
    left = [same[0][250:], same[1], ""]
    assert Counter(r["text"] for r in suffixes.without_repeats(frame).collect()) == Counter(left)
    got = suffixes.remove_repeats(frame).collect()
    assert Counter((r["doc_id"], r["kept"].decode()) for r in got) == Counter(zip([None, None, 1], left))


def test_op9_an_absent_id_is_not_minus_one(spark):
    frame = spark.createDataFrame([(None, "x" * 300), (-1, "y" * 250 + "z"), (None, "short")], "doc_id long, text string")
    got = suffixes.remove_repeats(frame).collect()
    assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in got) == Counter([(None, 300, b""), (-1, 251, b"z"), (None, 5, b"short")])


def test_op9_texts_are_shuffled_once(spark):
    texts = [" ".join(f"w{i * j}" for j in range(200)) for i in range(40)] + ["shared passage " * 40] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        done = suffixes.remove_repeats(frame)
        assert len(done.collect()) == len(texts)
        plan = done._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set(key, before)
    assert sum("ReusedExchange [id#" in line and "body#" in line for line in plan.splitlines()) == 1, plan


def test_op9_query(spark, sf):
    import hashlib

    import __spark_entry__

    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in __spark_entry__.queries()["op9_suffix_array_dedup"](spark, sf).collect()}
    assert len(got) == len(rows)
    for row, (kept, gone) in zip(rows, h.without_repeats([r["text"] for r in rows], 200)):
        found = got[row["doc_id"]]
        assert (found["n_bytes"], found["n_removed"]) == (len((row["text"] or "").encode()), gone)
        assert found["kept_sha256"] == hashlib.sha256(kept).hexdigest() and (found["n_spans"] > 0) == (gone > 0)


def test_op9_empty_table_and_whole_characters(spark):
    frame, _ = h.documents(spark)
    assert suffixes.remove_repeats(frame.limit(0)).collect() == []
    out = suffixes.without_repeats(frame).collect()
    assert len(out) == frame.count() and all(r["text"] == r["text"].encode("utf-8", "strict").decode() for r in out)
    texts = {r["doc_id"]: r["text"] for r in out}
    assert texts[4] == "one" and texts[16] == "" and texts[14].count("é") < 150


def maximal(scores):
    """Maximal segments by their definition: the best one, then what is left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or (total, i - j) > (best[2], best[0] - best[1] + 1)):
                best = (i, j + 1, total)
    if best is None:
        return []
    return maximal(scores[: best[0]]) + [best[2]] + maximal(scores[best[1] :])


def test_op3_segments_are_maximal():
    chosen = random.Random(5)
    for _ in range(400):
        scores = [chosen.choice([-3, -1, -2, 1, 2, 3, 0.5]) for _ in range(chosen.randrange(14))]
        assert [s for _, _, s in toxicity.segments_of(scores)] == pytest.approx(maximal(scores))


def toxic_corpus(spark):
    chosen = random.Random(6)
    plain = ["".join(chosen.choice("aeioulnrst") for _ in range(chosen.randrange(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [chosen.choice(plain) for _ in range(chosen.randrange(5, 120))]
        bad = i % 5 == 0
        for _ in range(chosen.randrange(3, 8) if bad else 0):
            words.insert(chosen.randrange(len(words) + 1), chosen.choice(["vile", "rotten", "zapfhead", "zapfrat"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1 if bad else 0))
    rows += [(5000, None), (5001, ""), (5002, "vile " * 30000), (None, "vile rotten vile rotten"), (0, "again")]
    labels += [(9999, 1), (None, 1), (5001, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_op3_held_out_accuracy(spark):
    docs, labels = toxic_corpus(spark)
    got = toxicity.score_documents(docs.withColumn("score", F.lit("x")), labels, passages=True).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    truth = {i: i % 5 == 0 for i in range(1, 900)}
    unseen = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(bool(r["predicted"]) == truth[r["doc_id"]] for r in unseen) >= 0.97 * len(unseen) > 0
    by_id = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert by_id[5000]["predicted"] == by_id[5001]["predicted"] == 0 and by_id[5002]["predicted"] == 1
    assert by_id[5002]["passages"] and by_id[5001]["passages"] == []


def test_op3_without_labels_or_rows(spark):
    docs, labels = toxic_corpus(spark)
    assert {r["score"] for r in toxicity.score_documents(docs.limit(5), labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_documents(docs.limit(0), labels).collect() == []


def test_pipeline_near_copies_of_rows_that_share_an_id_or_have_none(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(1, a), (7, a + " x"), (7, "clean " + b), (8, c + " y"), (8, c + " z"), (None, a + " n"), (None, "other text"), (None, ""), (None, None), (9, ""), (3, "x"), (3, "x")]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, frame, "").collect()]
    eight = [r for r in got if r[0] == 8]
    assert len(eight) == 1 and eight[0] in rows
    expected = [(1, a), (7, "clean " + b), (None, "other text"), (None, ""), (None, None), (9, ""), (3, "x")]
    assert Counter(r for r in got if r[0] != 8) == Counter(expected)


def test_pipeline_stages_take_effect(spark, folder):
    docs, labels = toxic_corpus(spark)
    labels.withColumn("quality", F.lit(1)).write.parquet(f"{folder}/labels.parquet")
    frame, rows = h.documents(spark)
    extra = frame.filter("doc_id is not null").select((F.col("doc_id") + 10000).alias("doc_id"), "text")
    shaped = docs.filter("doc_id is not null").unionAll(extra).select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("src").alias("source"), F.length("text").cast("long").alias("n_chars")
    )
    shaped.write.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "pii", "best_fit_packing"]
    now, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, folder).write.parquet(f"{folder}/{number}")
        now = spark.read.parquet(f"{folder}/{number}")
        seen[name] = now.collect()
        if number < 4:
            assert now.columns == corpus_pipeline.COLUMNS
    kept = {r["doc_id"] for r in seen["toxicity"]}
    assert 5002 not in kept and {5000, 5001, 10007} <= kept
    single = {r["doc_id"] for r in seen["ngram_jaccard_join"]}
    before = [(r["doc_id"], r["text"]) for r in seen["toxicity"]]
    roots, _ = h.groups(before, 5, 80)
    assert single == {doc for (doc, _), root in zip(before, roots) if doc == root}
    texts = {r["doc_id"]: r["text"] for r in seen["suffix_array_dedup"]}
    near = sorted((r["doc_id"], r["text"]) for r in seen["ngram_jaccard_join"])
    left = h.without_repeats([t for _, t in near], 200)
    for (doc, text), (body, gone) in zip(near, left):
        if (text or "").isascii():
            assert texts[doc].encode() == body, doc
    assert {r["doc_id"]: r["text"] for r in seen["pii"]}[10020] == "mail [EMAIL] or [PHONE], [IP] and [CARD]"
    assert {r["doc_id"] for r in seen["best_fit_packing"]} == single
    assert all(r["n_chars"] == len(r["text"]) for r in seen["pii"])
    packed = corpus_pipeline.run(spark, folder)
    assert packed.count() == len(seen["best_fit_packing"])


def test_pipeline_batches_are_small_and_the_session_keeps_its_limit(spark, folder, monkeypatch):
    def longest(spark, docs, sf_dir):
        def held(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

        return spark.createDataFrame([(docs.select("text").mapInArrow(held, "n long").agg({"n": "max"}).first()[0],)], "n long")

    rows = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    rows.write.parquet(f"{folder}/documents.parquet")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("longest", longest)])
    assert corpus_pipeline.run(spark, folder).first()["n"] < 5 << 20
    assert spark.conf.get(name) == before


def test_freeing_gives_back_memory_after_the_last_batch(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append("released")

    def run(batches):
        for batch in batches:
            calls.append("batch")
            yield batch

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], names=["n"]) for i in range(2)]
    assert list(freeing(run)(iter(batches))) == batches
    assert calls == ["batch", "batch", "released"]
