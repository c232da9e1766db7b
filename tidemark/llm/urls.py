"""URL filter: a rule list, and logistic regression on hashed character n-grams for what no rule fits.

Everything runs as DataFrame expressions. A URL's features are the hashes of the character n-grams of its host and of
its path. The model is learned by gradient descent: each step is one aggregation over the labelled URLs, a small table
of at most ``MOST_LABELLED`` rows, and only the weights, ``BUCKETS`` numbers, come to the driver. Gradients are summed as
whole numbers, so that the order of the rows cannot change the model.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, materialized

BUCKETS = 4096
GRAM = 3
MOST_LABELLED = 2000
STEPS = 25
RATE = 1.0
RIDGE = 1e-4
FIXED_POINT = float(1 << 30)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _host_and_path(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. A rule is (verdict, "host/path")."""
    found = verdict = F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, rule_path = _host_and_path(rule)
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(said)).otherwise(verdict)
    return found, verdict


def grams(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the n-grams of host and path, one for each place; hosts and paths have n-grams of their own."""

    def of(text: Column, kind: str) -> Column:
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        places = F.sequence(F.lit(1), F.greatest(F.length(marked) - (GRAM - 1), F.lit(1)))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(marked, i, F.lit(GRAM))), F.lit(buckets)).cast("int"))

    # Digits stand for each other: numbers of pages say nothing.
    plain = F.regexp_replace(path, "[0-9]+", "0")
    return F.array_distinct(F.concat(of(host, "host"), of(plain, "path")))


@dataclass
class Model:
    weights: list[float]
    bias: float = 0.0


def block_probability(features: Column, model: Model) -> Column:
    """Of the class ``block``."""
    weights = F.from_json(F.lit(json.dumps(model.weights)), "array<double>")
    total = F.aggregate(features, F.lit(model.bias), lambda s, i: s + F.get(weights, i))
    return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, buckets: int = BUCKETS, steps: int = STEPS) -> Model:
    """Fit to rows (features array<int>, block 0 or 1). No rows give a model that knows nothing."""
    rows = materialized(labelled.select("features", F.col("block").cast("double").alias("block")))
    n = rows.count()
    model = Model([0.0] * buckets)
    if not n:
        return model
    share = rows.agg(F.avg("block")).first()[0]
    share = min(max(share, 1 / (n + 2)), 1 - 1 / (n + 2))
    model.bias = math.log(share / (1 - share))
    speed = [0.0] * buckets
    for _ in range(steps):
        error = F.col("block") - block_probability(F.col("features"), model)
        # Each URL weighs the same, however many n-grams it has.
        part = F.round(error / F.sqrt(F.size("features").cast("double")) * F.lit(FIXED_POINT)).cast("long")
        sums = rows.select(part.alias("part"), F.explode("features").alias("bucket")).groupBy("bucket").agg(F.sum("part").alias("sum")).collect()
        for row in sums:  # at most one for each bucket
            slope = row["sum"] / FIXED_POINT / n - RIDGE * model.weights[row["bucket"]]
            speed[row["bucket"]] += slope * slope
            model.weights[row["bucket"]] += RATE * slope / math.sqrt(speed[row["bucket"]] + 1e-12) / 4
    return model


def labelled_by_rules(urls: DataFrame, rules: list[tuple[str, str]], most: int = MOST_LABELLED) -> DataFrame:
    """A small labelled URL table: at most ``most`` distinct URLs that a rule decides, chosen by hash."""
    _, verdict = rule_for(F.col("host"), F.col("path"), rules)
    decided = urls.withColumn("said", verdict).filter("said is not null").select("host", "path", "said").distinct()
    return decided.orderBy(F.xxhash64("host", "path"), "host", "path").limit(most)


def judge(urls: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Judge every URL: (id column, host, path, rule, score, verdict), one row for each input row.

    ``labelled`` has columns host, path and said (allow or block); without it, the rules teach. ``score`` is the model's
    probability of block; it decides, from 0.5 on, where no rule fits. A null URL, or one without ``://``, has empty
    host and path. Repeated rows and null ids are kept; other columns are not read.
    """
    url = F.col(url_column).cast("string")
    parted = urls.select(F.col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    taught = labelled if labelled is not None else labelled_by_rules(parted, rules)
    model = fit(taught.select(grams(F.col("host"), F.col("path")).alias("features"), (F.col("said") == "block").cast("int").alias("block")))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    scored = parted.select("id", "host", "path", rule.alias("rule"), verdict.alias("said"), block_probability(grams(F.col("host"), F.col("path")), model).alias("score"))
    by_model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_column), "host", "path", "rule", "score", F.coalesce("said", by_model).alias("verdict"))
