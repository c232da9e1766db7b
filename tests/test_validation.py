import copy
import json

import pytest
from pyspark.sql import functions as F

from tests import support as s
from tidemark.functions.expressions import json_string, stable_event_id
from tidemark.functions.validation import validate


def without(*path):
    value = s.envelope()
    inner = value
    for name in path[:-1]:
        inner = inner[name]
    del inner[path[-1]]
    return value


def with_payload(**changes):
    value = s.envelope()
    value["payload"].update(changes)
    return value


BUSINESS, ENVELOPE, JSON = "business_quality_violation", "invalid_envelope", "invalid_json"
long_name = "x" * 200

# (name, message bytes, expected reason); the key is always the right one.
CASES = [
    ("valid", s.compact(s.envelope()), None),
    ("valid without schema_version", s.compact(without("schema_version")), None),
    ("valid with spaces", json.dumps(s.envelope()).encode(), None),
    ("valid with other field order", json.dumps(s.envelope(), sort_keys=True).encode(), None),
    ("valid offset", s.compact(s.envelope(occurred_at="2026-01-01T02:00:00.000001+02:00")), None),
    ("valid integer price", s.compact(with_payload(total_price=100)), None),
    ("valid one decimal", s.compact(with_payload(total_price="100.2")), None),
    ("valid longest name", s.compact(with_payload(customer_name=long_name)), None),
    ("valid largest key version", s.compact(s.envelope(batch_sequence=2**63 - 1)), None),
    ("valid non-ASCII name", s.compact(with_payload(customer_name="Zoë 𝄞")), None),
    ("valid largest price", s.compact(with_payload(total_price="9999999999999999.99")), None),
    ("naive time", s.compact(s.envelope(occurred_at="2026-01-01T00:00:00.000001")), ENVELOPE),
    ("integer time", s.compact(s.envelope(occurred_at=1790762400)), ENVELOPE),
    ("float time", s.compact(s.envelope(captured_at=1790762403.0)), ENVELOPE),
    ("impossible time", s.compact(s.envelope(captured_at="2026-13-01T00:00:00.000000Z")), ENVELOPE),
    ("event type", s.compact(s.envelope(event_type="delete")), ENVELOPE),
    ("version 0", s.compact(s.envelope(source_version=0)), ENVELOPE),
    ("version true", s.compact(s.envelope(source_version=True)), ENVELOPE),
    ("version text", s.compact(s.envelope(source_version="1")), ENVELOPE),
    ("version 1.0", s.compact(s.envelope()).replace(b'"source_version":1', b'"source_version":1.0'), ENVELOPE),
    ("version beyond bigint", s.compact(s.envelope(batch_sequence=2**63)), ENVELOPE),
    ("schema version 2", s.compact(s.envelope(schema_version=2)), ENVELOPE),
    ("schema version true", s.compact(s.envelope(schema_version=True)), ENVELOPE),
    ("wrong id", s.compact(s.envelope(event_id="a" * 64)), ENVELOPE),
    ("other order", s.compact(s.envelope(entity_key="order:124")), ENVELOPE),
    ("unknown field", s.compact(s.envelope(unexpected="field")), ENVELOPE),
    ("times differ", s.compact(s.envelope(occurred_at="2026-01-01T00:00:01.000000Z")), ENVELOPE),
    ("source with space", s.compact(s.envelope(source="a b")), ENVELOPE),
    ("bad uuid", s.compact(s.envelope(batch_id="xyz")), ENVELOPE),
    ("no version", s.compact(without("source_version")), ENVELOPE),
    ("root array", b"[]", ENVELOPE),
    ("root number", b"1", ENVELOPE),
    ("root null", b"null", ENVELOPE),
    ("empty object", b"{}", BUSINESS),
    ("no payload", s.compact(without("payload")), BUSINESS),
    ("payload text", s.compact(s.envelope(payload="x")), BUSINESS),
    ("payload unknown field", s.compact(with_payload(extra=1)), BUSINESS),
    ("payload and envelope", s.compact({**with_payload(total_price="-1"), "event_type": "x"}), BUSINESS),
    ("no name", s.compact(without("payload", "customer_name")), BUSINESS),
    ("empty name", s.compact(with_payload(customer_name="")), BUSINESS),
    ("name too long", s.compact(with_payload(customer_name=long_name + "x")), BUSINESS),
    ("status", s.compact(with_payload(order_status="X")), BUSINESS),
    ("customer 0", s.compact(with_payload(customer_key=0)), BUSINESS),
    ("impossible date", s.compact(with_payload(order_date="2026-02-30")), BUSINESS),
    ("not JSON", b"not-json", JSON),
    ("empty", b"", JSON),
    ("cut off", s.compact(s.envelope())[:-1], JSON),
    ("text after", s.compact(s.envelope()) + b" x", JSON),
    ("two documents", s.compact(s.envelope()) + b"," + s.compact(s.envelope()), JSON),
    ("early bracket", s.compact(s.envelope()) + b"],[1", JSON),
    ("not UTF-8", s.compact(s.envelope()).replace(b"Example", b"Ex\xffmple"), JSON),
] + [
    (f"price {price!r}", s.compact(with_payload(total_price=price)), BUSINESS)
    for price in ("-0.01", "1.001", "NaN", "Infinity", 1.2, True, None, "10000000000000000.00", "", "1,0")
]


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = [(name, bytearray(b"order:31"), bytearray(value)) for name, value, _ in CASES]
    frame = validate(spark.createDataFrame(rows, "name string, key binary, value binary"))
    return {row["name"]: row for row in frame.collect()}


@pytest.mark.parametrize("name,value,reason", CASES, ids=[case[0] for case in CASES])
def test_reason(outcomes, name, value, reason):
    row = outcomes[name]
    assert row["reason_code"] == reason
    assert (row["envelope"] is not None) == (reason is None)
    assert (len(row["details"]) > 0) == (reason is not None)


def test_details_name_places_and_rules_only(outcomes):
    assert [(d["loc"], d["type"]) for d in outcomes["price '-0.01'"]["details"]] == [
        (["payload", "total_price"], "greater_than_equal")
    ]
    assert [(d["loc"], d["type"]) for d in outcomes["no version"]["details"]] == [(["source_version"], "missing")]
    assert [(d["loc"], d["type"]) for d in outcomes["not JSON"]["details"]] == [([], "json_invalid")]
    assert [(d["loc"], d["type"]) for d in outcomes["unknown field"]["details"]] == [(["unexpected"], "extra_forbidden")]
    assert [(d["loc"], d["type"]) for d in outcomes["wrong id"]["details"]] == [([], "value_error")]


@pytest.mark.parametrize("name", [case[0] for case in CASES if case[2] is None])
def test_content_hash_is_the_hash_of_the_canonical_content(outcomes, name):
    value = json.loads(next(case[1] for case in CASES if case[0] == name))
    value = copy.deepcopy(value)
    value.setdefault("schema_version", 1)
    value["occurred_at"] = value["source_updated_at"]
    price = value["payload"]["total_price"]
    value["payload"]["total_price"] = f"{float(price):.2f}" if len(str(price)) < 12 else price
    assert outcomes[name]["content_hash"] == s.content_hash(value)


def test_filters_on_the_result_stay_cheap_to_plan(spark):
    rows = [(bytearray(b"order:31"), bytearray(s.compact(s.envelope())))]
    frame = validate(spark.createDataFrame(rows, "key binary, value binary"))
    assert frame.filter("reason_code is null and envelope.entity_key = 'order:31'").count() == 1


TEXTS = ["plain", 'quote " and \\', "line\nbreak\ttab\r\b\f", "é", "𝄞 clef", "\x01\x7f", "", "/"]


def test_json_string_equals_the_ascii_json_of_python(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {row["t"]: row["j"] for row in frame.select("t", json_string(F.col("t")).alias("j")).collect()}
    assert got == {t: json.dumps(t) for t in TEXTS}


def test_event_id_for_any_source(spark):
    sources = ["shop.orders", "sh\"op", "größe"]
    frame = spark.createDataFrame([(t,) for t in sources], "t string")
    ids = frame.select("t", stable_event_id(F.col("t"), F.lit("order:7"), F.lit(3)).alias("i")).collect()
    assert {row["t"]: row["i"] for row in ids} == {t: s.event_id(t, "order:7", 3) for t in sources}
    fixed = frame.limit(1).select(stable_event_id("größe", F.lit("order:7"), F.lit(3))).first()[0]
    assert fixed == s.event_id("größe", "order:7", 3)
