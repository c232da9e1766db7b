"""Tokens, packing, fingerprints, licences, personal data and URLs against plain models and public libraries."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import helpers as h  # noqa: E402

from tidemark.llm import bpe, fingerprints, licenses, packing, pii, urls  # noqa: E402


@pytest.fixture(scope="module")
def merges():
    return bpe.load_merges(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(merges):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges.ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op2_encoding_equals_the_library(spark, merges, reference):
    frame, rows = h.documents(spark)
    args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = Counter(tuple(r) for r in bpe.encode_documents(frame, *args).collect())
    expected = Counter()
    for doc, text in rows:
        ids = reference.encode_ordinary(text or "")
        expected[(doc, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))] += 1
    assert got == expected
    assert bpe.encode_documents(frame.limit(0), *args).collect() == []
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(frame.filter("doc_id = 7"), *args, with_ids=True).collect()}
    assert ids[7] == reference.encode_ordinary(h.BASE_TEXT)


def test_op2_random_texts(merges, reference):
    chosen = random.Random(5)
    encoder = bpe.Encoder(merges, public_tokenizers.PATTERN)
    parts = ["a", "b", "  ", "\n", "\t", "1", "é", "中", "\x1c", "\x85", "\u3000", "'s", "'", "!", "—", "🙂", "½", "the", " "]
    for _ in range(3000):
        text = "".join(chosen.choice(parts) for _ in range(chosen.randrange(40)))
        assert np.frombuffer(encoder.packed(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_op2_appends_and_edits_are_exact(merges):
    chosen = random.Random(6)
    for _ in range(200):
        data = bytes(chosen.choice(b"abcde fghthe") for _ in range(400))
        table = bpe.PrefixTokens(merges, data[:200])
        table.append(data[200:])
        assert table.last == bpe.PrefixTokens(merges, data).last
        i = chosen.randrange(len(data))
        j = min(len(data), i + chosen.randrange(6))
        new = chosen.choice([b"", b"xyz", b" the"])
        computed = table.replace(i, j, new)
        assert table.last == bpe.PrefixTokens(merges, data[:i] + new + data[j:]).last
        assert computed <= 400 + len(new)
        assert b"".join(merges.tokens[t] for t in table.tokens()) == data[:i] + new + data[j:]


def test_op5_every_piece_is_placed_once(spark):
    frame, rows = h.documents(spark)
    more = [(800, "hello <|endoftext|> world"), (801, "<|endoftext|>"), (802, "<|endoftext|"), (803, "naïve café Ünder ÿ ½ ×÷ \x00\x7f tabs\t\tand  gaps \n\n x")]
    rows = rows + more
    frame = frame.unionByName(spark.createDataFrame([(i, t, *["clash"] * 9) for i, t in more], frame.schema))
    spec = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(frame, spec, public_tokenizers.PATTERN).collect()
    library = tokenizers.Tokenizer.from_file(spec)
    expected = Counter()
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[(doc, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack_documents(frame.limit(0), spec, public_tokenizers.PATTERN).collect() == []


def test_op5_ids_equal_the_library_as_it_comes():
    spec = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = tokenizers.Tokenizer.from_file(spec), packing.LibraryEncoder(open(spec, encoding="utf-8").read(), public_tokenizers.PATTERN)
    assert np.frombuffer(encoder.packed("hello <|endoftext|> world"), "<u4").tolist() == [31373, 220, 50256, 995]
    chosen = random.Random(9)
    parts = ["a", "the", "tion", " ", "  ", "\n", "\t", "1", "23", "é", "ÿ", "×", "'s", "'", "!", "~", "\r", "\x00", "\x1c", "—", "🙂", "½", "Über", "<|", "|>", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(chosen.choice(parts) for _ in range(chosen.randrange(30)))
        assert np.frombuffer(encoder.packed(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", ["mixed", "one length", "small", "full"])
def test_op5_plans_come_near_the_bound(lengths):
    chosen = random.Random(7)
    draw = {
        "mixed": lambda: chosen.choice([chosen.randrange(1, 1025), chosen.randrange(1, 200)]),
        "one length": lambda: 300, "small": lambda: chosen.randrange(1, 60), "full": lambda: chosen.choice([1024, 1023, 1]),
    }[lengths]
    histogram = Counter(draw() for _ in range(4000))
    rows = packing.plan(histogram)
    placed = defaultdict(list)
    load = defaultdict(list)
    for length, low, high, first, offset in rows:
        placed[length].append((low, high))
        for i in range(high - low):
            load[first + i].append((offset, length))
    for length, count in histogram.items():
        ends = sorted(placed[length])
        assert [a for a, _ in ends] == [0, *[b for _, b in ends[:-1]]] and ends[-1][1] == count
    assert all(sum(n for _, n in items) <= 1024 for items in load.values())
    total = sum(k * v for k, v in histogram.items())
    least = max(-(-total // 1024), histogram[300] // 3 if lengths == "one length" else 0)
    assert len(load) <= least * 1.02 + 3


def test_op6_edited_texts_and_likeness(spark):
    frame, rows = h.documents(spark)
    got = fingerprints.fingerprint_documents(frame).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = Counter()
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        third = len(text) // 3
        expected[(doc, len(text), sha((text[: len(text) - third] + after[:third]).encode()))] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    by_text = defaultdict(set)
    texts = defaultdict(set)
    for doc, text in rows:
        texts[doc].add(text or "")
    for r in got:
        if len(texts[r["doc_id"]]) == 1:
            by_text[next(iter(texts[r["doc_id"]]))].add(r["fingerprint"])
    assert all(len(marks) == 1 for marks in by_text.values())
    assert fingerprints.fingerprint_documents(frame.limit(0)).collect() == []
    alone = fingerprints.fingerprint_documents(frame.filter("doc_id = 7")).first()
    assert alone["near_next"] == 1.0


def test_op6_anchors_do_not_depend_on_context():
    chosen = random.Random(8)
    middle = "".join(chosen.choice("abcdefgh ") for _ in range(300))
    inner = {(int(p), int(v)) for p, v in zip(*fingerprints.anchors(middle))}
    moved = {(int(p) - 7, int(v)) for p, v in zip(*fingerprints.anchors("before " + middle + " after"))}
    assert inner <= moved
    chain = fingerprints.aligned(fingerprints.anchors(middle), fingerprints.anchors("before " + middle))
    assert chain and all(b - a == 7 for a, b in chain)
    assert fingerprints.likeness(fingerprints.fingerprint(""), fingerprints.fingerprint("")) == 1.0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base_scan(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    found = []
    for phrase, label in licenses.BASE:
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_op7_base_places_and_templates(spark):
    frame, rows = h.documents(spark)
    notes = [
        (101, "Released under the MIT License.", "mit"), (102, "x mit-LICENSE y apache  license", "apache,mit"),
        (103, "Licensed under CC BY-NC 4.0.", "cc-by-nc"), (104, "a general public license", "gpl"),
        (105, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
        (106, "under cc by", ""), (107, "licensed cc under nc by", ""),
    ]
    columns = [c for c in frame.columns if c not in ("doc_id", "text")]
    more = spark.createDataFrame([(i, t, *["c"] * len(columns)) for i, t, _ in notes], frame.schema)
    got = licenses.scan(frame.unionAll(more)).collect()
    expected = Counter((doc, *base_scan(text)) for doc, text in rows + [(i, t) for i, t, _ in notes])
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == expected
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got}
    for doc, _, wanted in notes:
        assert labels[doc][0] == wanted, doc
        assert 0 <= labels[doc][1] <= 1
    assert licenses.scan(frame.limit(0)).collect() == []


def test_op10_base_spans(spark):
    frame, rows = h.documents(spark)
    chosen = random.Random(9)
    parts = ["a", "b1", "@", ".", "-", "1", "23", "255", "256", "+", "(", ")", " ", "é", "🙂", "\n", "_", "x.y", "4111111111111111", "+1 555 1234567", "1.2.3.4"]
    mixed = [(1000 + i, "".join(chosen.choice(parts) for _ in range(chosen.randrange(25)))) for i in range(3000)]
    mixed += [(5000, "a" * 50000), (5001, "1 " * 20000), (5002, "+1" + "2 " * 20000)]
    every = frame.select("doc_id", "text", F.lit("x").alias("spans")).unionAll(spark.createDataFrame([(i, t, "x") for i, t in mixed], "doc_id long, text string, spans string"))
    got = pii.digests(every).collect()
    expected = Counter((doc, sha(h.personal(text).encode()), h.personal(text)) for doc, text in rows + mixed)
    assert Counter((r["doc_id"], r["base_sha256"], r["spans"]) for r in got) == expected
    assert pii.digests(frame.limit(0)).collect() == []


def test_op10_terms_that_disclose_an_entity(spark):
    rows = [(i, f"The prize goes to Rosebud ann.smith@x.org today again number {i} of it") for i in range(12)]
    rows += [(i, f"nothing goes to it here today again number {i} of the prize") for i in range(12, 300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find(frame)
    texts = {r["doc_id"]: r["t"] for r in found.select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert texts[3] == "The prize goes to  [EMAIL] today again number 3 of it"
    assert texts[20] == rows[20][1] and len(texts) == 300
    copies = spark.createDataFrame([(i, rows[0][1]) for i in range(9)] + rows[12:], "doc_id long, text string")
    assert pii.digests(copies).filter("spans like '%term%'").isEmpty()


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def judged(url):
    m = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1), m.group(2)) if m else ("", "")
    host = host.translate({i: i + 32 for i in range(65, 91)})
    best = None
    for verdict, rule in RULES:
        rule_host, rule_path = rule.split("/", 1)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, best


def test_op1_rules_and_model(spark):
    cases = [None, "", "no", "HTTP://Example.COM/en/x?://a/", "x://www.example.com/en/", "x://a.net/fr/", "a://b\n/c", "x://com", "x://com/", "x://xcom/", "x://net/es/1#2"]
    chosen = random.Random(4)
    cases += [f"https://{chosen.choice(['a', 'm', 'www'])}.example.{chosen.choice(['com', 'net', 'org'])}/{chosen.choice(['en', 'fr', 'es', 'de'])}/{i}" for i in range(400)]
    frame = spark.createDataFrame([(i % 300, u, "h", "p") for i, u in enumerate(cases)], "page_id long, url string, host string, path string")
    got = urls.judge(frame, RULES).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == Counter((i % 300, *judged(u)[:2], (judged(u)[2] or (None,))[0]) for i, u in enumerate(cases))
    decided = [r for r in got if r["rule"]]
    assert all(r["verdict"] == dict((rule, v) for v, rule in RULES)[r["rule"]] for r in decided)
    assert all(r["verdict"] == ("block" if r["score"] >= 0.5 else "allow") for r in got if not r["rule"])
    assert urls.judge(frame.limit(0), RULES).collect() == []


def test_op1_held_out_accuracy(spark):
    """Half of the URLs teach; the model alone must agree with the rules on the other half."""
    chosen = random.Random(3)
    rows = [(i, f"https://{chosen.choice(['a', 'm', 'b'])}.{chosen.choice(['alpha', 'beta'])}.{chosen.choice(['com', 'net'])}/{chosen.choice(['es', 'fr', 'news'])}/{i}") for i in range(600)]
    rules = [("allow", "com/"), ("block", "net/es/"), ("block", "net/fr/")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    parted = frame.select("page_id", urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"))
    taught = urls.labelled_by_rules(parted.filter("page_id % 2 = 0"), rules)
    said = urls.judge(frame.filter("page_id % 2 = 1"), rules, taught).filter("rule is not null").collect()
    assert sum((r["score"] >= 0.5) == (r["verdict"] == "block") for r in said) >= 0.95 * len(said)
