"""Personal data: patterns, and terms that disclose them.

Base spans come from four patterns. Their values are protected entities. Which other words reveal an entity is
estimated from the corpus: a word that stands near an entity carries the pointwise mutual information

    log( documents with both near each other * all documents / (documents with the word * documents with the entity) )

of the entity's own information, log(all documents / documents with the entity). A word that reaches a share
``DISCLOSES`` of it, and is seen with the entity in at least ``SUPPORT`` different texts, discloses the entity. In the
documents that hold the entity, such words are removed; base spans are generalised to their kind.

Everything is a DataFrame expression, a join or an aggregation. Counts cover all documents. Entities and their words
are joined by shuffles, whatever their number; a bitmap of fixed size keeps other words out of those shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialized, whole_text

NEAR = 5
SUPPORT = 3
DISCLOSES = 0.9
BITMAP = 1 << 16
KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, spelled so that the engine neither goes back nor starts again inside a run: a run that fails
# at its beginning fails at all its places.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must have for its kind to be looked for at all.
HINTS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
}
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; the digits of all add up to a multiple of ten."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda s, d: s + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(16, 19), passes_luhn(_digits(value))).otherwise(False)
    return n.between(8, 15)


def _check(kind: str):
    return lambda span: _valid(kind, span["value"])


def matches_of(text: Column, pattern: Column | str, kind: str) -> Column:
    """Leftmost non-overlapping matches as spans in code points: the text between them says where they stand."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    # An array of one struct binds what both regular expressions give, so that they run once for a text.
    bound = F.array(F.struct(F.split(text, regex).alias("between"), F.regexp_extract_all(text, regex, F.lit(0)).alias("found")))

    def starts(b: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<int>").alias("starts"))
        steps = F.zip_with(b["between"], b["found"], lambda p, v: F.struct(F.length(p).alias("before"), F.coalesce(F.length(v), F.lit(0)).alias("own")))

        def step(done: Column, s: Column) -> Column:
            start = done["at"] + s["before"]
            return F.struct((start + s["own"]).alias("at"), F.array_append(done["starts"], start).alias("starts"))

        return F.aggregate(steps, none, step, lambda done: F.slice(done["starts"], F.lit(1), F.size(b["found"])))

    def span(start: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"))

    return F.flatten(F.transform(bound, lambda b: F.zip_with(starts(b), b["found"], span)))


def base_spans(text: Column) -> Column:
    """Spans of all kinds, by kind as listed, then by place."""
    parts = []
    for kind in KINDS:
        found = F.filter(matches_of(text, PATTERNS[kind], kind), _check(kind))
        parts.append(F.when(HINTS[kind](text), found).otherwise(F.expr("array()").cast(_SPANS)))
    return F.concat(*parts)


def _words(text: Column) -> Column:
    """Lower-case words of at least two letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.length(w) > 1)


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(_digits(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _nearby(text: Column, span: Column) -> Column:
    """Words near a span: at most ``NEAR`` on either side, within its line."""
    reach = 40 * NEAR
    left = F.element_at(F.split(F.substring(text, F.greatest(span["start"] - reach, F.lit(0)) + 1, F.least(span["start"], F.lit(reach))), "\n"), -1)
    right = F.element_at(F.split(F.substring(text, span["end"] + 1, F.lit(reach)), "\n"), 1)
    before, after = _words(left), _words(right)
    return F.array_distinct(F.concat(F.slice(before, F.greatest(F.size(before) - NEAR + 1, F.lit(1)), F.lit(NEAR)), F.slice(after, 1, NEAR)))


def disclosing_terms(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """(entity, term) pairs that reach the thresholds. ``rows``: row, body; ``holders``: row, body, spans."""
    total = rows.count()
    seen = holders.select("row", F.xxhash64("body").alias("copy"), F.explode("spans").alias("span"), "body").select("row", "copy", _entity(F.col("span")).alias("entity"), _nearby(F.col("body"), F.col("span")).alias("terms"))
    with_entity = seen.groupBy("entity").agg(F.count_distinct("row").alias("n_entity"))
    pairs = seen.select("row", "copy", "entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.count_distinct("copy").alias("support"), F.count_distinct("row").alias("n_both"))
    # A word discloses only if few documents have it. Those that hold entities, a small part, already rule out words
    # that are frequent everywhere, before all documents are counted.
    most = F.col("n_both") * F.pow(F.lit(float(total)) / F.col("n_entity"), F.lit(1 - DISCLOSES))
    held = holders.select(F.explode(F.array_distinct(_words(F.col("body")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_held"))
    bounded = both.filter(F.col("support") >= SUPPORT).join(with_entity, "entity").withColumn("most", most).join(held, "term")
    likely = materialized(bounded.filter(F.col("n_held") <= F.col("most") + 1e-6).select("entity", "term", "n_both", "n_entity"))
    # Which of the bitmap's places hold a candidate: at most BITMAP numbers.
    place = F.pmod(F.xxhash64("term"), F.lit(BITMAP)).cast("int")
    places = {r["place"] for r in likely.select(place.alias("place")).distinct().collect()}
    if not places:
        return likely.select("entity", "term").limit(0)
    bits = F.unhex(F.lit("".join("01" if i in places else "00" for i in range(BITMAP))))
    candidate = lambda w: F.substring(bits, F.pmod(F.xxhash64(w), F.lit(BITMAP)).cast("int") + 1, F.lit(1)) == F.unhex(F.lit("01"))
    held = rows.select(F.explode(F.array_distinct(F.filter(_words(F.col("body")), candidate))).alias("term"))
    with_term = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).join(likely.select("term").distinct(), "term", "left_semi")
    counted = likely.join(with_term, "term")
    information = F.log(F.lit(float(total)) / F.col("n_entity"))
    mutual = F.log(F.col("n_both") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity")))
    return counted.filter((information > 0) & (mutual >= DISCLOSES * information)).select("entity", "term")


def find(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Find personal data and disclosing terms: every column of ``documents`` and ``spans`` (kind, start, end, value).

    Base spans come by kind as listed, then by place; spans of kind ``term`` follow. Places are code points, ends
    exclusive. A null or empty text has none. Rows with equal id and text are told apart by nothing and need not be.
    A column named ``spans`` is replaced.
    """
    columns = [c for c in documents.columns if c.lower() != "spans"]
    own = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("own")
    body = whole_text(f"`{text_column}`")
    keyed = documents.select(own, F.xxhash64(f"`{id_column}`", body).alias("row"), body.alias("body"))
    keyed = keyed.withColumn("spans", base_spans(F.col("body")))
    # Only texts with base spans take part in joins.
    holders = materialized(keyed.filter(F.size("spans") > 0))
    terms = disclosing_terms(keyed.select("row", "body"), holders)
    mine = holders.select("row", F.explode("spans").alias("span")).select("row", _entity(F.col("span")).alias("entity")).distinct()
    listed = mine.join(terms, "entity").groupBy("row").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    none = F.expr("array()").cast(_SPANS)
    added = F.when(F.col("terms").isNotNull(), matches_of(F.col("body"), pattern, "term")).otherwise(none)
    # A term inside a base span, such as a name in an address, goes with it.
    free = F.filter(added, lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    held = holders.join(listed, "row", "left").select("own", F.concat("spans", free).alias("spans"))
    clear = keyed.filter(F.size("spans") == 0).select("own", none.alias("spans"))
    return held.unionAll(clear).select("own.*", "spans")


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, the digest of the base spans, and all spans, one row for each input row."""
    found = find(documents.select(id_column, text_column), id_column, text_column)
    base = F.filter("spans", lambda s: s["kind"] != "term")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(id_column, *counts, F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with base spans generalised to their kind and terms removed; overlapping spans count as one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        name = F.when(s["kind"] == "term", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        more = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), name)
        # A span that begins inside the last one adds no second name.
        out = F.when(s["start"] >= done["at"], more).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    whole = F.aggregate(ordered, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
