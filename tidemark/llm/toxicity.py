"""Toxic passages as maximum-scoring segments.

* Every word has a log-odds score of the toxic against the clean class with a Dirichlet prior proportional to the
  counts of both classes together. A word's score is that of the surest of its features: the word itself, or one of
  its beginnings or endings, so that unseen forms of known words count too. Words without a sure and strong feature
  have a small negative score.
* One scan in linear time finds all maximal segments of positive score (no extension or shortening improves one).
* Segment scores of clean texts follow an extreme-value law: a text of n words has a segment of score S or more with
  expectation K n exp(-lambda S). Lambda solves sum p exp(lambda s) = 1 over the scores of clean words; K is fitted to
  the best segments of clean texts. Significant segments of a text are combined into one statistic, which a logistic
  curve turns into the document's score.

The model is fitted on a bounded sample of labelled rows, ``PER_CLASS`` of each class by a hash of the id; its lexicon
has at most ``LEXICON`` features, so what is sent to the executors has a fixed size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.llm.common import freeing, materialized, ship, whole_text

PER_CLASS = 4000
LEXICON = 65_536
PRIOR = 0.05  # the prior's total, as a share of all counts
SUREST = 5.0  # least signed root of a feature's likelihood ratio, about a standard score
STRONGEST = 0.85  # least log-odds of a feature, as a share of what a feature of one class alone has
FILLER = -0.15
TOP = 6.0
CACHE_WORDS = 200_000
COUNTED_TOGETHER = 500  # documents
SIGNIFICANT = 0.05

WORD = re.compile(r"\w+")
_LETTERS = range(3, 7)


def features(word: str) -> set[str]:
    """The word, and its beginnings and endings of 3 to 6 letters."""
    out = {"=" + word}
    for size in _LETTERS:
        if size < len(word):
            out.add("<" + word[:size])
            out.add(">" + word[-size:])
    return out


@dataclass
class Model:
    lexicon: dict[str, tuple[float, float]]  # feature: (log-odds less one deviation, sureness)
    decay: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 0.0
    base: float = 0.0

    def word_score(self, word: str) -> float:
        best, surest = FILLER, 0.0
        for feature in features(word):
            known = self.lexicon.get(feature)
            if known and known[1] > surest:
                surest, best = known[1], known[0]
        return min(TOP, best)

    def expected(self, words: int, score: float) -> float:
        """How many segments of this score or more a clean text of so many words has."""
        return math.exp(-min(700.0, self.surprise(words, score)))

    def surprise(self, words: int, score: float) -> float:
        """Minus the logarithm of that."""
        return self.decay * score - math.log(self.scale * max(1, words))

    def statistic(self, words: int, segments: list[tuple[int, int, float]]) -> float:
        return math.log1p(sum(max(0.0, self.surprise(words, s)) for _, _, s in segments))

    def score(self, words: int, segments: list[tuple[int, int, float]]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.base + self.slope * self.statistic(words, segments)))))


def segments_of(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, in linear time.

    Open segments form a stack. A new positive score starts a segment; it is merged with the nearest open one that
    began at a lower running total, provided that one ended at a lower total than the new one.
    """
    stack: list[tuple[int, int, float, float]] = []  # start, end, total before, total after
    below: list[int] = []  # for each: the nearest earlier one with a lower total before it
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, low = i, before
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = below[j]
            if j < 0 or stack[j][3] >= total:
                stack.append((start, i + 1, low, total))
                below.append(j)
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:], below[j:]
    return [(start, end, high - low) for start, end, low, high in stack]


class Scorer:
    """Scores texts; the scores of repeated words are kept up to a fixed number."""

    def __init__(self, model: Model):
        self.model = model
        scorer = self

        class Kept(dict):
            def __missing__(self, word: str) -> float:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = score = scorer.model.word_score(word)
                return score

        self.kept = Kept()

    def scan(self, text: str) -> tuple[list[float], list[tuple[int, int, float]]]:
        scores = list(map(self.kept.__getitem__, WORD.findall(text.lower())))
        return scores, segments_of(scores)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have a feature, summed up over a part of a batch."""
    words: dict[str, set[str]] = {}
    for batch in (whole.slice(at, COUNTED_TOGETHER) for whole in batches for at in range(0, whole.num_rows, COUNTED_TOGETHER)):
        counts = (Counter(), Counter())
        for i in range(batch.num_rows):
            found: set[str] = set()
            for word in set(WORD.findall(batch.column("body")[i].as_py().lower())):
                kept = words.get(word)
                if kept is None:
                    if len(words) >= CACHE_WORDS // 10:
                        words.clear()
                    kept = words[word] = features(word)
                found |= kept
            counts[batch.column("toxic")[i].as_py()].update(found)
        for label, counter in enumerate(counts):
            if counter:
                n = np.fromiter(counter.values(), np.int64, len(counter))
                zero = np.zeros(len(n), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(list(counter)), pa.array(n if label else zero), pa.array(zero if label else n)], ["feature", "toxic", "clean"])


def fit(documents: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, per_class: int = PER_CLASS) -> Model:
    """Fit the model on at most ``per_class`` labelled documents of each class."""
    chosen = None
    for label in (0, 1):
        some = labels.filter(F.col(label_column) == label).select(F.col(id_column).alias("id"), F.lit(label).alias("toxic"))
        some = some.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = some if chosen is None else chosen.unionAll(some)
    # At most 2 * per_class ids.
    sample = documents.select(F.col(id_column).alias("id"), whole_text(text_column).alias("body")).join(F.broadcast(chosen), "id")
    sample = materialized(sample.select("body", "toxic").distinct())  # copies teach nothing more
    sums = sample.mapInArrow(freeing(_count), "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sums = sums.filter(F.col("toxic") + F.col("clean") >= 5)
    totals = sums.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.coalesce(F.sum("clean"), F.lit(0)).alias("clean")).first()
    n1, n0 = totals["toxic"], totals["clean"]
    if not n1 or not n0:
        return Model({})
    prior = (F.col("toxic") + F.col("clean")) * F.lit(PRIOR)

    def odds(count: Column, n: int) -> Column:
        return F.log(count + prior) - F.log(F.lit(n + PRIOR * (n1 + n0)) - count - prior)

    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    both = F.col("toxic") + F.col("clean")

    def surprise(count: Column, share: float) -> Column:
        return F.when(count > 0, count * F.log(count / (both * share))).otherwise(0.0)

    # Of a test whether the feature's documents fall into the classes as all features do.
    ratio = 2 * (surprise(F.col("toxic"), n1 / (n1 + n0)) + surprise(F.col("clean"), n0 / (n1 + n0)))
    deviation = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    least = STRONGEST * math.log1p(1 / PRIOR) + math.log(n0 / n1)
    surest = sums.select("feature", delta.alias("delta"), deviation.alias("deviation"), F.sqrt(F.greatest(ratio, F.lit(0.0))).alias("z"))
    surest = surest.filter((F.col("z") >= SUREST) & (F.col("delta") >= least))
    rows = surest.orderBy(F.col("z").desc(), "feature").limit(LEXICON).collect()
    model = Model({r["feature"]: (max(0.0, r["delta"] - r["deviation"]), r["z"]) for r in rows})
    return calibrate(model, sample)


def calibrate(model: Model, sample: DataFrame) -> Model:
    """Fit the extreme-value law to clean texts, then the logistic curve to both classes; the sample is bounded."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            rows = []
            histogram: Counter = Counter()
            for i in range(batch.num_rows):
                scores, found = scorer.scan(batch.column("body")[i].as_py())
                toxic = batch.column("toxic")[i].as_py()
                if not toxic:
                    histogram.update(round(s, 1) for s in scores)
                rows.append((toxic, len(scores), [s for _, _, s in found], None, None))
            rows += [(None, None, None, value, count) for value, count in histogram.items()]
            types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["toxic", "n", "best", "value", "count"])

    rows = sample.mapInArrow(freeing(scan), "toxic int, n long, best array<double>, value double, count long").collect()
    histogram: Counter = Counter()
    for r in rows:
        if r["value"] is not None:
            histogram[r["value"]] += r["count"]
    texts = [r for r in rows if r["n"] is not None]
    values, counts = np.array(list(histogram) or [FILLER]), np.array(list(histogram.values()) or [1], float)
    model.decay = decay_of(values, counts / counts.sum())
    clean = [(r["n"], max(r["best"], default=0.0)) for r in texts if not r["toxic"] and r["n"]]
    weight = sum(n * math.exp(-model.decay * s) for n, s in clean)
    model.scale = len(clean) / weight if weight else 1.0
    x = np.array([model.statistic(r["n"], [(0, 0, s) for s in r["best"]]) for r in texts])
    y = np.array([r["toxic"] for r in texts], float)
    model.base, model.slope = logistic(x, y)
    return model


def decay_of(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum share * exp(root * value) = 1, for scores of negative mean; at most 5."""
    if (values * shares).sum() >= 0 or values.max() <= 0:
        return 1.0
    low, high = 1e-6, 5.0
    for _ in range(80):
        middle = (low + high) / 2
        if (shares * np.exp(middle * values)).sum() < 1:
            low = middle
        else:
            high = middle
    return low


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope by damped Newton steps with a small ridge."""
    a = np.column_stack([np.ones_like(x), x])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - ridge * len(x) * w * np.array([0, 1])
        hessian = (a * (p * (1 - p))[:, None]).T @ a + ridge * len(x) * np.diag([1e-6, 1])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def held_out(id_column: str = "doc_id") -> Column:
    """A third of the ids, by their CRC-32; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def apply(model: Model, documents: DataFrame, text_column: str = "text", passages: bool = False) -> DataFrame:
    """Add ``toxicity``, the document's score, and, on request, ``passages``: word ranges of significant segments.

    A null or empty text has no segment and the score of that. Every row keeps all of its columns; columns of these two
    names are replaced.
    """
    spark = documents.sparkSession
    ship(spark)
    documents = documents.drop("toxicity", "passages")
    shared = spark.sparkContext.broadcast(model)
    # The text travels once, beside the other columns.
    others = [c for c in documents.columns if c != text_column]
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias("rows")
    packed = documents.select(rest, F.col(f"`{text_column}`").cast("string").alias("body"))
    passage = StructType().add("start", "integer").add("end", "integer").add("score", "double").add("expected", "double")
    schema = StructType(list(packed.schema.fields)).add("toxicity", "double").add("passages", ArrayType(passage))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        rule = shared.value
        shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in batches:
            scores, found = [], []
            for i in range(batch.num_rows):
                words, segments = scorer.scan(batch.column("body")[i].as_py() or "")
                scores.append(rule.score(len(words), segments))
                found.append([{"start": a, "end": b, "score": s, "expected": e} for a, b, s in segments if (e := rule.expected(len(words), s)) <= SIGNIFICANT] if passages else None)
            yield pa.RecordBatch.from_arrays([batch.column("rows"), batch.column("body"), pa.array(scores, pa.float64()), pa.array(found, shape)], ["rows", "body", "toxicity", "passages"])

    scored = packed.mapInArrow(freeing(run), schema)
    columns = [F.col("body").alias(c) if c == text_column else F.col(f"rows.`{c}`") for c in documents.columns]
    return scored.select(*columns, "toxicity", *(["passages"] * passages))


def score_documents(
    documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", threshold: float = 0.7, passages: bool = False
) -> DataFrame:
    """Learn from the labelled ids that are not held out, and score every document.

    Returns the id column, ``held_out``, ``score``, ``predicted`` and, on request, ``passages``. Null labels and ids
    without a text teach nothing; without both classes every score is 0.5. Repeated rows are scored each; other columns
    are not read.
    """
    ship(documents.sparkSession)
    taught = labels.filter(~held_out(id_column) & F.col(id_column).isNotNull())
    model = fit(documents, taught, id_column, text_column, label_column)
    narrow = documents.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return apply(model, narrow, "text", passages).select(
        F.col("id").alias(id_column),
        held_out("id").alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= threshold).cast("int").alias("predicted"),
        *(["passages"] * passages),
    )


def without_toxic(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """All columns of the documents whose score stays below the threshold."""
    ship(documents.sparkSession)
    taught = labels.filter(~held_out(id_column) & F.col(id_column).isNotNull())
    model = fit(documents, taught, id_column, text_column, "toxic")
    return apply(model, documents, text_column).filter(F.col("toxicity") < threshold).drop("toxicity")
