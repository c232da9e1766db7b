"""License scans by a positional index of rare words.

Templates are short public licence notices. The index lists, for each template, its rarest words by inverse document
frequency over the whole corpus, with their places in the template. A text's occurrences of these words vote for
(template, place where the template would begin); where enough of a template's rare words agree, its mandatory key
phrases are checked at that place. Everything runs inside DataFrame expressions, row by row and without a shuffle; only
the document frequencies of the templates' few words come to the driver.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, whole_text

BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
RARE_WORDS = 4
AGREEING = 3

# Phrases and labels of the base scan.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public licence notices, each with its label and the key phrases that must be there.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted", "free of charge")),
    ("apache", "licensed under the apache license version", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("gpl", "this work is licensed under the gnu general public license version", ("general public license",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use", "source and binary forms")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
)


def literal(value: object, shape: str) -> Column:
    """A constant of any shape."""
    return F.from_json(F.lit(json.dumps(value)), shape)


def words_of(text: Column) -> Column:
    """Runs of a-z, digits and characters beyond ASCII, after lower-casing; cutting at the others is the fast way."""
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def document_frequencies(documents: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """In how many of all documents each word of a small vocabulary occurs; one row for each word."""
    known = F.array_intersect(words_of(F.col("body")), literal(vocabulary, "array<string>"))
    rows = documents.select(F.explode(F.array_append(known, F.lit("")))).groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["col"]: r["n"] for r in rows}
    return found.pop("", 0), found


def build_index(total: int, found: dict[str, int], templates=TEMPLATES) -> list[dict]:
    """Templates with their words, weights, rare words and key phrases."""
    idf = lambda word: math.log((total + 1) / (found.get(word, 0) + 1)) + 0.1
    out = []
    for number, (label, text, phrases) in enumerate(templates):
        words = text.split(" ")
        # Of words that are equally rare, those with fewer places in the template and the earlier ones.
        rarest = sorted(set(words), key=lambda w: (-idf(w), words.count(w), words.index(w)))[:RARE_WORDS]
        keys = []
        for phrase in phrases:
            parts = phrase.split(" ")
            at = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
            keys += [{"offset": at + i, "word": part} for i, part in enumerate(parts)]
        out.append(
            {
                "number": number,
                "label": label,
                "words": [{"offset": i, "word": w, "weight": idf(w)} for i, w in enumerate(words)],
                "weight": sum(idf(w) for w in words),
                "rare": [{"word": w, "number": number, "offset": i} for w in rarest for i, x in enumerate(words) if x == w],
                "hints": rarest[: len(rarest) - min(AGREEING, len(rarest)) + 1],
                "agreeing": min(AGREEING, len(rarest)),
                "keys": keys,
            }
        )
    return out


_TEMPLATE = "array<struct<number:int,label:string,words:array<struct<offset:int,word:string,weight:double>>,weight:double,agreeing:int,keys:array<struct<offset:int,word:string>>>>"


def places_of(words: Column, phrases=BASE) -> Column:
    """Places (start, label) where a phrase's words stand consecutively."""

    def at(i: Column, phrase: str) -> Column:
        fits = F.lit(True)
        for k, part in enumerate(phrase.split(" ")):
            fits = fits & (F.coalesce(F.get(words, i + k), F.lit("")) == part)
        return fits

    def label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in phrases:
            out = F.when(at(i, phrase), F.lit(name)).otherwise(out)
        return out

    every = F.transform(words, lambda _, i: F.struct(i.alias("start"), label(i).alias("label")))
    return F.filter(every, lambda p: p["label"].isNotNull())


def candidates_of(words: Column, index: list[dict]) -> Column:
    """Places (template number, start) on which enough of a template's rare words agree."""
    postings = literal([p for t in index for p in t["rare"]], "array<struct<word:string,number:int,offset:int>>")
    rare = literal(sorted({p["word"] for t in index for p in t["rare"]}), "array<string>")
    met = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda h: F.array_contains(rare, h["word"]))
    votes = F.flatten(
        F.transform(
            met,
            lambda h: F.transform(F.filter(postings, lambda p: p["word"] == h["word"]), lambda p: F.struct(p["number"].alias("number"), (h["at"] - p["offset"]).alias("start"))),
        )
    )
    votes = F.array_sort(votes)
    need = literal([t["agreeing"] for t in index], "array<int>")
    # Equal votes stand together: a place counts if the vote some places on is the same.
    enough = F.filter(votes, lambda v, i: F.get(votes, i + F.get(need, v["number"]) - 1) == v)
    return F.array_distinct(enough)


def scan(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates=TEMPLATES) -> DataFrame:
    """Find licence notices in every text.

    Returns the id column, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` and ``found`` (label, first word, share of the template's weight that is there). A null or empty text has
    no words; labels are then empty and places null. Null ids and repeated rows are kept; other columns are not read.
    """
    rows = documents.select(F.col(id_column).alias("id"), whole_text(text_column).alias("body"))
    vocabulary = sorted({w for _, text, _ in templates for w in text.split(" ")})
    index = build_index(*document_frequencies(rows, vocabulary), templates)
    known = literal([{k: v for k, v in t.items() if k not in ("rare", "hints")} for t in index], _TEMPLATE)
    none = F.expr("array()")

    split = rows.select("id", "body", words_of(F.col("body")).alias("words"))
    # A text in which enough of a template's rare words agree holds one of its very rarest: as many as may be missing,
    # and one more. Other texts skip the votes.
    hinted = F.arrays_overlap("words", literal(sorted({w for t in index for w in t["hints"]}), "array<string>"))
    based = F.contains(lower_ascii(F.col("body")), F.lit("license"))
    met = split.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.when(based, places_of(F.col("words"))).otherwise(none.cast("array<struct<start:int,label:string>>")).alias("base"),
        F.when(hinted, candidates_of(F.col("words"), index)).otherwise(none.cast("array<struct<number:int,start:int>>")).alias("candidates"),
        F.when(hinted, F.col("words")).alias("words"),
    )

    def there(c: Column, w: Column) -> Column:
        return F.coalesce(F.when(c["start"] + w["offset"] >= 0, F.get("words", c["start"] + w["offset"]) == w["word"]), F.lit(False))

    def checked(c: Column) -> Column:
        template = F.get(known, c["number"])
        weight = F.aggregate(F.filter(template["words"], lambda w: there(c, w)), F.lit(0.0), lambda s, w: s + w["weight"])
        share = F.when(F.forall(template["keys"], lambda k: there(c, k)), weight / template["weight"])
        return F.struct(template["label"].alias("label"), c["start"].alias("start"), share.alias("share"))

    found = F.filter(F.transform("candidates", checked), lambda f: f["share"].isNotNull())
    met = met.select("id", "n_words", "base", found.alias("found"))
    base_labels = F.array_distinct(F.transform("base", lambda p: p["label"]))
    own_labels = F.transform("found", lambda f: f["label"])
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0))
    starts = F.transform("base", lambda p: p["start"])
    return met.select(
        F.col("id").alias(id_column),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own_labels))), ",").alias("labels"),
        F.least(F.lit(1.0), F.greatest(best, F.when(F.size("base") > 0, 0.5).otherwise(0.0))).alias("score"),
        "found",
    )
