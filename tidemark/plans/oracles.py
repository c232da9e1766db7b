"""The same results in plain SQL, written from the contract and not from the Spark plans."""

from __future__ import annotations

from tidemark.plans.fixture import CHANGES, RUN, SECOND_RUN, SOURCE
from tidemark.plans.queries import PLANTED
from tidemark.sources.wire import TOPIC

T0 = "TIMESTAMP '2026-01-01 00:00:00'"


def _iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%S.%fZ')"


_TEXT = f"""order_key, customer_key, customer_name, order_status,
       CAST(total_price AS VARCHAR) AS total_price, CAST(order_date AS VARCHAR) AS order_date,
       source_version, {_iso('source_updated_at')} AS source_updated_at, event_type"""

_SAMPLE = """
sample AS (
  SELECT o_orderkey + 1 AS order_key, c_custkey AS customer_key, c_name AS customer_name,
         o_orderstatus AS order_status, CAST(o_totalprice AS DECIMAL(18,2)) AS total_price,
         CAST(o_orderdate AS DATE) AS order_date
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

_SEEDED = f"""{_SAMPLE},
seeded AS (
  SELECT *, CAST(1 AS BIGINT) AS source_version, {T0} AS source_updated_at, 'insert' AS event_type FROM sample
)"""

_JOURNAL = f"""{_SAMPLE},
journal AS (
  SELECT order_key, customer_key, customer_name, order_status,
         CAST(total_price + v.step AS DECIMAL(18,2)) AS total_price, order_date,
         CAST(v.version AS BIGINT) AS source_version,
         {T0} + to_microseconds(v.version - 1) AS source_updated_at,
         CASE WHEN v.version = 1 THEN 'insert' ELSE 'update' END AS event_type
  FROM sample JOIN (VALUES (1, 0), (2, 1), (3, 3)) v(version, step)
    ON v.version = 1 OR (v.version = 2 AND order_key % 5 = 0) OR (v.version = 3 AND order_key % 15 = 0)
)"""

_IS_VALID = """order_key > 0 AND customer_key > 0 AND length(customer_name) BETWEEN 1 AND 200
        AND order_status IN ('O', 'F', 'P') AND total_price >= 0 AND order_date IS NOT NULL
        AND source_version > 0 AND event_type IN ('insert', 'update')"""

_EVENT_ID = f"""sha256('["{SOURCE}","order:' || order_key || '",' || source_version || ']')"""


def _uuid(text: str) -> str:
    digest = f"md5({text})"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-' || substr({digest}, 13, 4) || '-' || "
        f"substr({digest}, 17, 4) || '-' || substr({digest}, 21, 12)"
    )


_PAYLOAD_SORTED = """'{"customer_key":' || customer_key || ',"customer_name":"' || customer_name
      || '","order_date":"' || CAST(order_date AS VARCHAR) || '","order_key":' || order_key
      || ',"order_status":"' || order_status || '","total_price":"' || CAST(total_price AS VARCHAR) || '"}'"""

_CONTENT_HASH = f"""sha256('{{"entity_key":"order:' || order_key || '","event_id":"' || event_id
      || '","event_type":"' || event_type || '","occurred_at":"' || {_iso('source_updated_at')}
      || '","payload":' || {_PAYLOAD_SORTED} || ',"schema_version":1,"source":"{SOURCE}","source_updated_at":"'
      || {_iso('source_updated_at')} || '","source_version":' || source_version || '}}')"""

# Deliveries: the fields as sent, where they arrive, and in which order.
_DELIVERIES = f"""{_JOURNAL},
events AS (
  SELECT *, {_EVENT_ID} AS event_id FROM journal WHERE {_IS_VALID}
),
sent AS (
  SELECT p.phase, e.order_key, e.customer_key, e.order_status, e.order_date, e.source_version, e.source_updated_at,
         e.event_type, e.event_id,
         CASE WHEN p.phase = 5 THEN e.customer_name || ' changed' ELSE e.customer_name END AS customer_name,
         CASE WHEN p.phase = 9 THEN CAST(-1 AS DECIMAL(18,2)) ELSE e.total_price END AS total_price,
         {T0} + CASE WHEN p.phase = 4 THEN INTERVAL 1 HOUR ELSE INTERVAL 5 SECOND END AS captured_at,
         CASE WHEN p.phase = 8 THEN 'wrong' ELSE 'order:' || e.order_key END AS message_key,
         CASE p.phase WHEN 6 THEN 'none' WHEN 7 THEN 'broken' WHEN 10 THEN 'no version' ELSE 'whole' END AS body
  FROM events e JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10)) p(phase)
    ON (source_version = 1 AND (p.phase = 0
          OR (p.phase = 4 AND order_key % 7 = 0) OR (p.phase = 5 AND order_key % 77 = 0)
          OR (p.phase = 6 AND order_key % 103 = 0) OR (p.phase = 7 AND order_key % 101 = 0)
          OR (p.phase = 8 AND order_key % 107 = 0) OR (p.phase = 9 AND order_key % 109 = 0)
          OR (p.phase = 10 AND order_key % 113 = 0)))
    OR (source_version = 2 AND p.phase = 2)
    OR (source_version = 3 AND p.phase = CASE WHEN order_key % 30 = 0 THEN 1 ELSE 3 END)
),
placed_messages AS (
  SELECT *, CAST(CAST('0x' || substr(md5(message_key), 1, 8) AS BIGINT) % 3 AS INTEGER) AS partition_id FROM sent
),
deliveries AS (
  SELECT *, row_number() OVER (PARTITION BY partition_id ORDER BY phase, order_key) - 1 AS broker_offset,
         row_number() OVER (ORDER BY partition_id, phase, order_key) AS delivery_id
  FROM placed_messages
)"""

_CHECKED = f"""{_DELIVERIES},
checked AS (
  SELECT *, 'order:' || order_key AS entity_key, {_CONTENT_HASH} AS content_hash,
         CASE WHEN body = 'none' THEN 'unsupported_tombstone'
              WHEN body = 'broken' THEN 'invalid_json'
              WHEN total_price < 0 THEN 'business_quality_violation'
              WHEN body = 'no version' THEN 'invalid_envelope'
              WHEN message_key <> 'order:' || order_key THEN 'partition_key_mismatch' END AS reason
  FROM deliveries
)"""

# One decision per valid delivery, from everything that came before it.
_DECIDED = """,
decided AS (
  SELECT *,
         first_value(content_hash) OVER (PARTITION BY event_id ORDER BY delivery_id) AS first_hash,
         row_number() OVER (PARTITION BY event_id ORDER BY delivery_id) AS copy,
         max(source_version) OVER (PARTITION BY entity_key ORDER BY delivery_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_version
  FROM {checked} WHERE reason IS NULL
),
ledger AS (
  SELECT delivery_id, partition_id, broker_offset, event_id, entity_key, event_type, source_version, content_hash,
         CASE WHEN copy > 1 AND content_hash <> first_hash THEN 'rejected' WHEN copy > 1 THEN 'duplicate'
              WHEN source_version <= before_version THEN 'stale' ELSE 'accepted' END AS disposition,
         CASE WHEN copy > 1 AND content_hash <> first_hash THEN 'source_version_conflict' END AS reason_code,
         order_key, customer_key, customer_name, order_status, order_date, total_price, source_updated_at, captured_at
  FROM decided
  UNION ALL
  SELECT delivery_id, partition_id, broker_offset,
         CASE WHEN known THEN event_id END, CASE WHEN known THEN entity_key END, CASE WHEN known THEN event_type END,
         CASE WHEN known THEN source_version END, CASE WHEN known THEN content_hash END, 'rejected', reason,
         order_key, customer_key, customer_name, order_status, order_date, total_price,
         CASE WHEN known THEN source_updated_at END, CASE WHEN known THEN captured_at END
  FROM (SELECT *, reason = 'partition_key_mismatch' AS known FROM {checked} WHERE reason IS NOT NULL)
)"""

_LEDGER = _CHECKED + _DECIDED.format(checked="checked")

_DECISIONS = """delivery_id, partition_id, broker_offset, event_id, entity_key, event_type, source_version,
       content_hash, disposition, reason_code"""

# Counted per type and disposition first, and laid out by columns afterwards.
_KINDS = {
    "deliveries": ("accepted", "stale", "duplicate", "rejected"), "unique_events": ("accepted", "stale"),
    "accepted": ("accepted",), "stale": ("stale",), "duplicates": ("duplicate",), "rejected": ("rejected",),
}
_PER_DISPOSITION = "per AS (SELECT event_type, disposition, count(*) AS c FROM ledger GROUP BY event_type, disposition)"
_LAID_OUT = ", ".join(
    f"CAST(sum(CASE WHEN disposition IN {tuple([*which, '-'])} THEN c ELSE 0 END) AS BIGINT) AS {name}" for name, which in _KINDS.items()
)

_CURRENT = f"""SELECT '{SOURCE}' AS source, entity_key, source_version,
       {_iso('source_updated_at')} AS source_updated_at, customer_key, customer_name, order_status,
       CAST(order_date AS VARCHAR) AS order_date, CAST(total_price AS VARCHAR) AS total_price,
       event_id AS last_event_id
FROM ledger WHERE disposition IN ('accepted', 'stale')
QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY source_version DESC) = 1"""

# The journal in pages of 500 with what the adapter makes of every row.
_PAGES = f"""{_JOURNAL},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY source_updated_at, order_key) AS number FROM journal
),
paged AS (
  SELECT *, (number - 1) // 500 + 1 AS batch_sequence, ({_IS_VALID}) AS valid, {_EVENT_ID} AS event_id FROM numbered
)"""

_BATCH_ID = _uuid(f"'{RUN}:{SOURCE}:' || batch_sequence")

# A mutation of a table ``held`` at one day after T0.
_MUTATED = """,
lowest AS (SELECT order_key, row_number() OVER (ORDER BY order_key) AS place
           FROM (SELECT order_key FROM {held} ORDER BY order_key LIMIT 3)),
clone AS (
  SELECT (SELECT max(order_key) + 1 FROM {held}) AS order_key, customer_key, customer_name, order_status, total_price,
         order_date, CAST(1 AS BIGINT) AS source_version, TIMESTAMP '2026-01-02 00:00:00' AS source_updated_at,
         'insert' AS event_type
  FROM {held} WHERE order_key = (SELECT order_key FROM lowest WHERE place = 1)
),
first_update AS (
  SELECT h.order_key, customer_key, customer_name, order_status, CAST(total_price + 1 AS DECIMAL(18,2)) AS total_price,
         order_date, source_version + 1 AS source_version, TIMESTAMP '2026-01-02 00:00:00' AS source_updated_at,
         'update' AS event_type, place
  FROM {held} h JOIN lowest l ON h.order_key = l.order_key
),
second_update AS (
  SELECT order_key, customer_key, customer_name, order_status, CAST(total_price + 2 AS DECIMAL(18,2)) AS total_price,
         order_date, source_version + 1 AS source_version, TIMESTAMP '2026-01-02 00:00:00.000001' AS source_updated_at,
         'update' AS event_type
  FROM first_update WHERE place = 1
),
mutated AS (
  SELECT * FROM {held} WHERE order_key NOT IN (SELECT order_key FROM lowest)
  UNION ALL SELECT * FROM clone
  UNION ALL SELECT * EXCLUDE (place) FROM first_update WHERE place > 1
  UNION ALL SELECT * FROM second_update
),
mutations AS (
  SELECT * FROM clone UNION ALL SELECT * EXCLUDE (place) FROM first_update UNION ALL SELECT * FROM second_update
)"""

_DOUBLED = f"""{_CHECKED},
twice AS (
  SELECT * FROM checked
  UNION ALL
  SELECT * REPLACE (delivery_id + (SELECT count(*) FROM checked) AS delivery_id) FROM checked
)""" + _DECIDED.format(checked="twice")

# Four pages in all: the first run fails at its second page, the second is killed at its second, the third ends.
_THREE_RUNS = f"""{_JOURNAL},
placed AS (
  SELECT *, (row_number() OVER (ORDER BY source_updated_at, order_key) - 1)
              // ((SELECT count(*) + 3 FROM journal) // 4) AS page
  FROM journal
),
pages AS (
  SELECT page, count(*) AS records_seen, count(*) FILTER (WHERE {_IS_VALID}) AS valid,
         max_by(order_key, (source_updated_at, order_key)) AS to_order_key
  FROM placed GROUP BY page
),
tries(run, sequence, page, status, error_code) AS (
  VALUES (1, 1, 0, 'published', NULL), (1, 2, 1, 'failed', 'sync_failure'), (2, 1, 1, 'published', NULL),
         (2, 2, 2, 'failed', 'worker_restart'), (3, 1, 2, 'published', NULL), (3, 2, 3, 'published', NULL)
)"""

_PROCESSED_AT = f"({T0} + INTERVAL 10 SECOND + to_microseconds(delivery_id))"

_PAGE = f"""
  SELECT l.delivery_id, l.event_id, CASE WHEN l.event_id IS NOT NULL THEN '{SOURCE}' END AS source, l.entity_key,
         l.event_type, {_iso('l.source_updated_at')} AS occurred_at, {_iso('l.captured_at')} AS captured_at,
         {_iso(_PROCESSED_AT.replace('delivery_id', 'l.delivery_id'))} AS processed_at, '{TOPIC}' AS topic,
         l.partition_id, l.broker_offset, l.disposition, l.reason_code,
         {_iso('p.captured_at')} AS envelope_captured_at, CAST(p.total_price AS VARCHAR) AS envelope_total_price
  FROM ledger l LEFT JOIN ledger p
    ON p.event_id = l.event_id AND p.disposition IN ('accepted', 'stale') AND l.disposition <> 'rejected'"""

_ROW_JSON = f"""'{{"entity_key":"' || entity_key || '","last_event_id":"' || event_id || '","payload":'
      || {_PAYLOAD_SORTED} || ',"source":"{SOURCE}","source_updated_at":"' || {_iso('source_updated_at')}
      || '","source_version":' || source_version || ',"total_price":"' || CAST(total_price AS VARCHAR) || '"}}'"""

_LANES = ", ".join(
    f"CAST(sum(CAST('0x' || substr(h, {4 * lane + 1}, 4) AS BIGINT)) AS BIGINT)" for lane in range(16)
)

_WIRE_JSON = f"""CASE WHEN body = 'none' THEN NULL WHEN body = 'broken' THEN '{{bad-json' ELSE
  '{{"event_id":"' || event_id || '","event_type":"' || event_type || '","source":"{SOURCE}","entity_key":"order:'
  || order_key || '","payload":{{"order_key":' || order_key || ',"customer_key":' || customer_key
  || ',"customer_name":"' || customer_name || '","order_status":"' || order_status || '","total_price":"'
  || CAST(total_price AS VARCHAR) || '","order_date":"' || CAST(order_date AS VARCHAR) || '"}},"occurred_at":"'
  || {_iso('source_updated_at')} || '","captured_at":"' || {_iso('captured_at')} || '","schema_version":1'
  || CASE WHEN body = 'no version' THEN '' ELSE ',"source_version":' || source_version END
  || ',"source_updated_at":"' || {_iso('source_updated_at')} || '","batch_id":"' || {_uuid(f"'{RUN}:{SOURCE}:1'")}
  || '","sync_run_id":"' || CASE WHEN phase = 4 THEN '{SECOND_RUN}' ELSE '{RUN}' END || '","batch_sequence":1}}' END"""

_SINK_RULES = """
  SELECT 'unique event_deliveries(delivery_id)' AS rule, count(*) AS violations
    FROM (SELECT 1 FROM ledger GROUP BY delivery_id HAVING count(*) > 1)
  UNION ALL SELECT 'unique processed_events(event_id)', count(*)
    FROM (SELECT 1 FROM processed GROUP BY event_id HAVING count(*) > 1)
  UNION ALL SELECT 'unique processed_events(source, entity_key, source_version)', count(*)
    FROM (SELECT 1 FROM processed GROUP BY entity_key, source_version HAVING count(*) > 1)
  UNION ALL SELECT 'unique orders_current(source, entity_key)', count(*)
    FROM (SELECT 1 FROM present GROUP BY entity_key HAVING count(*) > 1)
  UNION ALL SELECT 'unique event_rejections(delivery_id)', count(*)
    FROM (SELECT 1 FROM ledger WHERE disposition = 'rejected' GROUP BY delivery_id HAVING count(*) > 1)
  UNION ALL SELECT 'reference processed_events.first_delivery_id', count(*)
    FROM processed p WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.delivery_id = p.delivery_id)
  UNION ALL SELECT 'reference orders_current.last_event_id', count(*)
    FROM present c WHERE NOT EXISTS (SELECT 1 FROM processed p WHERE p.event_id = c.event_id)
  UNION ALL SELECT 'reference event_rejections.delivery_id', count(*)
    FROM ledger r WHERE disposition = 'rejected'
      AND NOT EXISTS (SELECT 1 FROM ledger l WHERE l.delivery_id = r.delivery_id)
  UNION ALL SELECT 'check event_deliveries.disposition', count(*)
    FROM ledger WHERE disposition NOT IN ('accepted', 'duplicate', 'stale', 'rejected')
  UNION ALL SELECT 'check processed_events.source_version', count(*) FROM processed WHERE NOT source_version > 0
  UNION ALL SELECT 'check orders_current.source_version', count(*) FROM present WHERE NOT source_version > 0
  UNION ALL SELECT 'check orders_current.total_price', count(*) FROM present WHERE NOT total_price >= 0
  UNION ALL SELECT 'accounting identity', CASE WHEN
      (SELECT count(*) FROM ledger) = (SELECT count(*) FROM ledger WHERE disposition IN ('accepted', 'stale'))
        + (SELECT count(*) FROM ledger WHERE disposition = 'duplicate')
        + (SELECT count(*) FROM ledger WHERE disposition = 'rejected')
      AND (SELECT count(*) FROM ledger WHERE disposition IN ('accepted', 'stale')) = (SELECT count(*) FROM processed)
      THEN 0 ELSE 1 END"""

_SINK_VIEWS = """,
processed AS (SELECT * FROM ledger WHERE disposition IN ('accepted', 'stale')),
present AS (SELECT * FROM processed
            QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY source_version DESC) = 1)"""

_BATCHES = f""",
pages AS (
  SELECT batch_sequence, {_BATCH_ID} AS batch_id, max(source_updated_at) AS to_updated_at,
         arg_max(order_key, number) AS to_order_key, count(*) AS records_seen,
         count(*) FILTER (WHERE valid) AS records_published
  FROM paged GROUP BY batch_sequence
)"""

_STATUS_BATCH_ID = _uuid(f"'{RUN}:shop.' || order_status || ':' || batch_sequence")
_LATER = "TIMESTAMP '2026-01-03 00:00:00'"


def _planted() -> str:
    """How many orders break each rule, counted from the order keys; a doubled row counts twice in a domain rule."""
    keys = {
        "event_deliveries": ["delivery_id"], "processed_events": ["event_id", "source, entity_key, source_version"],
        "orders_current": ["source, entity_key"], "event_rejections": ["delivery_id"], "sync_runs": ["run_id"],
        "sync_batches": ["batch_id", "run_id, batch_sequence"], "sync_state": ["source"],
        "source_entity_versions": ["source, entity_key"], "source_quarantine": ["source, source_updated_at, order_key"],
    }
    links = ("run_id", "last_completed_batch_id", "first_delivery_id", "last_event_id", "delivery_id", "batch_id")
    paired = {"from_order_key": "from cursor paired", "last_updated_at": "last cursor paired"}
    parts = ["SELECT 'accounting identity' AS rule, CAST(1 AS BIGINT) AS violations"]
    for table, (twice, broken) in PLANTED.items():
        for columns in keys[table]:
            parts.append(f"SELECT 'unique {table}({columns})', count(*) FROM keys WHERE k % {twice} = 0")
        for column, m in broken.items():
            if column in links:
                parts.append(f"SELECT 'reference {table}.{column}', count(*) FROM keys WHERE k % {m} = 0")
            else:
                rule = paired.get(column, column)
                parts.append(
                    f"SELECT 'check {table}.{rule}', count(*) FILTER (WHERE k % {m} = 0) + count(*) FILTER (WHERE k % {m} = 0 AND k % {twice} = 0) FROM keys"
                )
    return "WITH keys AS (SELECT o_orderkey + 1 AS k FROM orders) " + " UNION ALL ".join(parts)


def _sql(text: str | None) -> str:
    return "NULL" if text is None else f"'{text}'"


def all_oracles() -> dict[str, str]:
    return {
        "load_seed": f"""WITH {_SEEDED}
            SELECT order_status, count(*) AS orders, min(order_key) AS first_key, max(order_key) AS last_key,
                   CAST(CAST(sum(total_price) AS DECIMAL(18,2)) AS VARCHAR) AS total_price
            FROM seeded GROUP BY order_status""",
        "seed_source": f"WITH {_SEEDED} SELECT {_TEXT} FROM seeded ORDER BY order_key LIMIT (SELECT count(*) // 2 FROM seeded)",
        "append_unused": f"""WITH {_SAMPLE}, held AS (SELECT order_key FROM sample WHERE order_key % 3 = 0),
            added AS (SELECT *, CAST(1 AS BIGINT) AS source_version, {T0} + to_microseconds(1) AS source_updated_at,
                             'insert' AS event_type
                      FROM sample s WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.order_key = s.order_key)
                      ORDER BY order_key LIMIT (SELECT count(*) // 2 FROM sample WHERE order_key % 3 <> 0))
            SELECT {_TEXT} FROM added""",
        "mutate_source": f"WITH {_SEEDED}{_MUTATED.format(held='seeded')} SELECT {_TEXT} FROM mutated",
        "mutate_journal": f"WITH {_SEEDED}{_MUTATED.format(held='seeded')} SELECT {_TEXT} FROM mutations",
        "clone_orders": f"""WITH {_SEEDED}, cloned AS (
              SELECT (SELECT max(order_key) FROM seeded) + n.i AS order_key, customer_key, customer_name, order_status,
                     total_price, DATE '2026-01-03' AS order_date, CAST(1 AS BIGINT) AS source_version,
                     TIMESTAMP '2026-01-02 00:00:00' AS source_updated_at, 'insert' AS event_type
              FROM seeded CROSS JOIN range(1, 6) n(i)
              WHERE order_key = (SELECT min(order_key) FROM seeded))
            SELECT {_TEXT} FROM cloned""",
        "next_stamp": f"""WITH {_JOURNAL}
            SELECT count(*) AS journal_rows, {_iso('max(source_updated_at)')} AS journal_high,
                   {_iso('max(source_updated_at) + to_microseconds(1)')} AS next_stamp FROM journal""",
        "change_journal": f"WITH {_JOURNAL} SELECT {_TEXT} FROM journal",
        "high_watermark": f"""WITH {_JOURNAL} SELECT {_iso('source_updated_at')} AS source_updated_at, order_key
            FROM journal ORDER BY journal.source_updated_at DESC, order_key DESC LIMIT 1""",
        "journal_page": f"""WITH {_JOURNAL},
            high AS (SELECT source_updated_at AS at, order_key AS k FROM journal
                     ORDER BY source_updated_at DESC, order_key DESC LIMIT 1),
            page AS (SELECT j.* FROM journal j, high
                     WHERE (source_updated_at, order_key) > ({T0}, greatest(high.k // 2, 1))
                       AND (source_updated_at, order_key) <= (high.at, high.k)
                     ORDER BY source_updated_at, order_key LIMIT 500)
            SELECT {_TEXT} FROM page""",
        "journal_after_cursor": f"""WITH {_JOURNAL},
            middle AS (SELECT greatest(order_key // 2, 1) AS k FROM journal
                       ORDER BY source_updated_at DESC, order_key DESC LIMIT 1)
            SELECT source_version, count(*) AS journal_rows, min(order_key) AS first_key, max(order_key) AS last_key
            FROM journal, middle
            WHERE (source_updated_at, order_key) > ({T0}, middle.k)
              AND (source_updated_at, order_key) <= ({T0} + to_microseconds(1), middle.k)
            GROUP BY source_version""",
        "cursor_multiplicity": f"""WITH {_JOURNAL},
            doubled AS (SELECT * FROM journal UNION ALL
                        SELECT * FROM journal WHERE order_key % 50 = 0 AND source_version = 1),
            marked AS (SELECT DISTINCT source_updated_at, order_key,
                              count(*) OVER (PARTITION BY source_updated_at, order_key) AS multiplicity FROM doubled)
            SELECT multiplicity, count(*) AS cursors FROM marked GROUP BY multiplicity""",
        "duplicate_cursors": f"""WITH {_JOURNAL},
            doubled AS (SELECT * FROM journal UNION ALL
                        SELECT * FROM journal WHERE order_key % 50 = 0 AND source_version = 1)
            SELECT {_iso('source_updated_at')} AS source_updated_at, order_key, count(*) AS multiplicity
            FROM doubled GROUP BY doubled.source_updated_at, order_key HAVING count(*) > 1""",
        "plan_pages": f"""WITH {_PAGES}{_BATCHES}
            SELECT batch_id, '{RUN}' AS run_id, '{SOURCE}' AS source, batch_sequence,
                   {_iso('lag(to_updated_at) OVER (ORDER BY batch_sequence)')} AS from_updated_at,
                   lag(to_order_key) OVER (ORDER BY batch_sequence) AS from_order_key,
                   {_iso('to_updated_at')} AS to_updated_at, to_order_key, records_seen, records_published
            FROM pages""",
        "sync_totals": f"""WITH {_PAGES}
            SELECT '{RUN}' AS run_id, max(batch_sequence) AS pages, count(*) AS records_seen,
                   count(*) FILTER (WHERE valid) AS records_published FROM paged""",
        "quarantine_rows": f"""WITH {_PAGES}
            SELECT {_BATCH_ID} AS batch_id, '{SOURCE}' AS source, {_iso('source_updated_at')} AS source_updated_at,
                   order_key,
                   '{{"order_key":' || order_key || ',"customer_key":' || customer_key || ',"customer_name":"'
                   || customer_name || '","order_status":"' || order_status || '","total_price":"'
                   || CAST(total_price AS VARCHAR) || '","order_date":"' || CAST(order_date AS VARCHAR)
                   || '","source_version":' || source_version || ',"source_updated_at":"'
                   || strftime(source_updated_at, '%Y-%m-%d %H:%M:%S')
                   || CASE WHEN epoch_us(source_updated_at) % 1000000 = 0 THEN ''
                           ELSE strftime(source_updated_at, '.%f') END
                   || '+00:00","event_type":"' || event_type || '"}}' AS raw_record,
                   'payload.customer_key: greater_than' AS reason
            FROM paged WHERE customer_key <= 0""",
        "captured_events": f"""WITH {_PAGES}
            SELECT number, batch_sequence, 'order:' || order_key AS entity_key, source_version, event_id,
                   {_CONTENT_HASH} AS content_hash
            FROM paged WHERE valid""",
        "event_ids": f"""WITH {_JOURNAL}
            SELECT 'order:' || order_key AS entity_key, source_version, {_EVENT_ID} AS event_id
            FROM journal WHERE {_IS_VALID}""",
        "entity_versions": f"""WITH {_JOURNAL}, valid AS (SELECT *, {_EVENT_ID} AS event_id FROM journal WHERE {_IS_VALID})
            SELECT '{SOURCE}' AS source, 'order:' || order_key AS entity_key, max(source_version) AS source_version,
                   {_iso('max(source_updated_at)')} AS source_updated_at,
                   arg_max(event_id, source_version) AS last_event_id
            FROM valid GROUP BY order_key""",
        "wire_messages": f"""WITH {_DELIVERIES}
            SELECT partition_id AS partition, broker_offset AS offset, message_key, sha256({_WIRE_JSON}) AS value_sha256
            FROM deliveries""",
        "partition_offsets": f"""WITH {_DELIVERIES}
            SELECT '{TOPIC}' AS topic, partition_id AS partition, min(broker_offset) AS low,
                   max(broker_offset) + 1 AS high
            FROM deliveries GROUP BY partition_id""",
        "bounded_read": f"""WITH {_DELIVERIES},
            ends AS (SELECT partition_id AS p, (max(broker_offset) + 1) // 2 AS high FROM deliveries GROUP BY 1)
            SELECT p AS partition, count(*) AS messages, max(broker_offset) AS last_offset
            FROM deliveries JOIN ends ON partition_id = p WHERE broker_offset < high GROUP BY p""",
        "validate_reasons": f"""WITH {_CHECKED}
            SELECT reason AS reason_code, count(*) AS deliveries FROM checked GROUP BY reason""",
        "error_details": f"""WITH {_CHECKED}
            SELECT reason AS reason_code,
                   CASE reason WHEN 'invalid_json' THEN '' WHEN 'business_quality_violation' THEN 'payload.total_price'
                               ELSE 'source_version' END AS loc,
                   CASE reason WHEN 'invalid_json' THEN 'json_invalid'
                               WHEN 'business_quality_violation' THEN 'greater_than_equal' ELSE 'missing' END AS rule,
                   count(*) AS deliveries
            FROM checked WHERE reason IN ('invalid_json', 'business_quality_violation', 'invalid_envelope')
            GROUP BY 1, 2, 3""",
        "classify_deliveries": f"WITH {_LEDGER} SELECT {_DECISIONS} FROM ledger",
        "classify_hot_entities": f"WITH {_LEDGER} SELECT {_DECISIONS} FROM ledger",
        "classify_incremental": f"WITH {_LEDGER} SELECT {_DECISIONS.replace('delivery_id, ', '', 1)} FROM ledger",
        "compacted_ledger": f"""WITH {_JOURNAL},
            valid AS (SELECT * FROM journal WHERE {_IS_VALID}),
            sent AS (SELECT count(*) + count(*) FILTER (WHERE source_version = 1 AND order_key % 7 = 0)
                       + count(*) FILTER (WHERE source_version = 1 AND order_key % 77 = 0)
                       + count(*) FILTER (WHERE source_version = 1 AND order_key % 103 = 0)
                       + count(*) FILTER (WHERE source_version = 1 AND order_key % 101 = 0)
                       + count(*) FILTER (WHERE source_version = 1 AND order_key % 107 = 0)
                       + count(*) FILTER (WHERE source_version = 1 AND order_key % 109 = 0)
                       + count(*) FILTER (WHERE source_version = 1 AND order_key % 113 = 0) AS n FROM valid),
            latest AS (SELECT order_key, max(source_version) AS v FROM valid GROUP BY order_key)
            SELECT 'deliveries' AS measure, 2 * n AS value FROM sent
            UNION ALL SELECT 'unique events', count(*) FROM valid
            UNION ALL SELECT 'current entities', count(*) FROM latest
            UNION ALL SELECT 'current versions', CAST(sum(v) AS BIGINT) FROM latest""",
        "stream_classify": f"WITH {_LEDGER} SELECT {_DECISIONS.replace('delivery_id, ', '', 1)} FROM ledger",
        "poll_capture": f"""WITH {_JOURNAL},
            ticked AS (SELECT *, CASE WHEN source_version = 1 THEN 1 ELSE 2 END AS run, ({_IS_VALID}) AS valid FROM journal)
            SELECT CAST(run AS INTEGER) AS run, CASE run WHEN 1 THEN 'initial' ELSE 'incremental' END AS mode, 'completed' AS status,
                   max_by(order_key, (source_updated_at, order_key)) AS high_watermark_order_key,
                   (count(*) + 499) // 500 AS pages, count(*) AS records_seen, count(*) FILTER (WHERE valid) AS records_published
            FROM ticked GROUP BY run""",
        "sync_to_sink": f"""WITH {_JOURNAL},
            ledger AS (SELECT 'order:' || order_key AS entity_key, {_EVENT_ID} AS event_id, 'accepted' AS disposition, *
                       FROM journal WHERE {_IS_VALID})
            {_CURRENT}""",
        "processed_events": f"""WITH {_LEDGER}
            SELECT event_id, '{SOURCE}' AS source, entity_key, source_version, content_hash,
                   delivery_id AS first_delivery_id
            FROM ledger WHERE disposition IN ('accepted', 'stale')""",
        "orders_current": f"WITH {_LEDGER} {_CURRENT}",
        "event_rejections": f"""WITH {_LEDGER}
            SELECT delivery_id, '{TOPIC}' AS topic, CASE WHEN event_id IS NOT NULL THEN '{SOURCE}' END AS source, reason_code
            FROM ledger WHERE disposition = 'rejected'""",
        "rejections_by_reason": f"""WITH {_LEDGER}
            SELECT reason_code, count(*) AS rejections FROM ledger WHERE disposition = 'rejected' GROUP BY reason_code""",
        "deliveries_by_disposition": f"""WITH {_LEDGER}
            SELECT disposition, count(*) AS deliveries FROM ledger GROUP BY disposition""",
        "counts_by_type": f"""WITH {_LEDGER}, {_PER_DISPOSITION} SELECT event_type, {_LAID_OUT} FROM per
            GROUP BY event_type ORDER BY event_type NULLS LAST""",
        "counts_total": f"""WITH {_LEDGER}, {_PER_DISPOSITION}
            SELECT event_type, CAST(grouping(event_type) AS INTEGER) AS is_total, {_LAID_OUT} FROM per GROUP BY ROLLUP (event_type)""",
        "processing_delay": f"""WITH {_LEDGER},
            delays AS (SELECT epoch_us({_PROCESSED_AT}) - epoch_us(source_updated_at) AS micros
                       FROM ledger WHERE disposition IN ('accepted', 'stale'))
            SELECT count(*) AS sample_count, round(avg(micros) / 1e6, 6) AS avg_seconds,
                   round(min(micros) / 1e6, 6) AS min_seconds, round(max(micros) / 1e6, 6) AS max_seconds FROM delays""",
        "events_page": f"""WITH {_LEDGER} {_PAGE}
            WHERE l.delivery_id > 500 AND l.event_type = 'insert'
              AND l.source_updated_at BETWEEN {T0} AND {T0} + to_microseconds(1)
            ORDER BY l.delivery_id LIMIT 501""",
        "entity_history": f"""WITH {_LEDGER} {_PAGE}
            WHERE l.entity_key = 'order:1155' ORDER BY l.delivery_id LIMIT 501""",
        "entity_view": f"""WITH {_LEDGER},
            own AS (SELECT *, row_number() OVER (ORDER BY broker_offset) - 1 AS n, count(*) OVER () AS many
                    FROM ledger WHERE entity_key = 'order:1155'),
            latest AS (SELECT source_version, event_id FROM own WHERE disposition IN ('accepted', 'stale')
                       ORDER BY source_version DESC LIMIT 1)
            SELECT CAST(n // 2 + 1 AS INTEGER) AS page, CAST(n % 2 + 1 AS INTEGER) AS place, disposition,
                   CASE WHEN disposition <> 'rejected' THEN own.source_version END AS envelope_version,
                   (n // 2 + 1) * 2 < many AS more, latest.source_version AS current_version, latest.event_id AS current_event_id
            FROM own, latest""",
        "events_after": f"""WITH {_LEDGER},
            thirds AS (SELECT *, broker_offset * 3 // (1 + max(broker_offset) OVER (PARTITION BY partition_id)) AS part FROM
                       (SELECT l.*, d.order_key AS k, d.broker_offset AS o FROM ledger l JOIN deliveries d USING (partition_id, broker_offset))),
            numbered AS (SELECT *, row_number() OVER (ORDER BY part, partition_id, broker_offset) - 1 AS n, count(*) OVER () AS many
                         FROM thirds WHERE event_type = 'update')
            SELECT CAST(n // 500 + 1 AS INTEGER) AS page, CAST(count(*) AS INTEGER) AS deliveries,
                   CAST(sum(k) AS BIGINT) AS sum_of_keys, any_value((n // 500 + 1) * 500 < many) AS more
            FROM numbered WHERE n < 2000 GROUP BY n // 500""",
        "set_difference": f"""WITH {_JOURNAL},
            valid AS (SELECT *, {_EVENT_ID} AS event_id FROM journal WHERE {_IS_VALID})
            SELECT event_id, CAST(1 AS BIGINT) AS in_left,
                   CAST(CASE WHEN order_key % 97 = 0 THEN 0 ELSE 2 END AS BIGINT) AS in_right
            FROM valid WHERE order_key % 97 = 0 OR order_key % 89 = 0""",
        "order_faults": f"""WITH {_JOURNAL},
            planted AS (SELECT source_updated_at AS ts, order_key AS was,
                   CASE WHEN order_key % 101 = 0 THEN order_key - 3 WHEN order_key % 103 = 0 THEN order_key - 1
                        WHEN order_key % 997 = 0 THEN -order_key ELSE order_key END AS k FROM journal),
            pairs AS (SELECT ts, k, lag(ts) OVER (ORDER BY ts, was) AS pat, lag(k) OVER (ORDER BY ts, was) AS pk FROM planted),
            high AS (SELECT ts, was FROM planted ORDER BY ts DESC, was DESC LIMIT 1),
            unsafe AS (SELECT ts, k FROM pairs WHERE k <= 0 OR (ts = pat AND k = pk) ORDER BY ts, k LIMIT 1)
            SELECT count(*) FILTER (WHERE pat IS NOT NULL AND (p.ts, p.k) < (pat, pk)) AS disordered,
                   count(*) FILTER (WHERE (p.ts, p.k) = (pat, pk)) AS repeated,
                   count(*) FILTER (WHERE p.k <= 0) AS invalid,
                   count(*) FILTER (WHERE (p.ts, p.k) <= ({T0}, 5) OR (p.ts, p.k) > (high.ts, high.was)) AS outside,
                   (SELECT {_iso('ts')} FROM unsafe) AS unsafe_at, (SELECT k FROM unsafe) AS unsafe_key
            FROM pairs p, high""",
        "contract_rules": f"""WITH {_JOURNAL},
            said(slot, reason_code, loc, rule) AS (VALUES {", ".join(f"({i}, {_sql(reason)}, {_sql(loc)}, {_sql(rule)})" for i, (_, _, reason, loc, rule) in enumerate(CHANGES))})
            SELECT reason_code, loc, rule, count(*) AS deliveries
            FROM journal JOIN said ON slot = order_key % {len(CHANGES)} WHERE source_version = 1 AND {_IS_VALID}
            GROUP BY reason_code, loc, rule""",
        "state_snapshot": f"""WITH {_JOURNAL},
            valid AS (SELECT count(*) AS n, count(DISTINCT order_key) AS entities FROM journal WHERE {_IS_VALID}),
            held AS (SELECT count(*) - any_value(n) AS q FROM journal, valid),
            measures(measure, a, b) AS (
              SELECT 'entities', entities, entities FROM valid UNION ALL SELECT 'deliveries', n, 2 * n FROM valid
              UNION ALL SELECT 'logical events', n, n FROM valid UNION ALL SELECT 'rejections', 0, 0
              UNION ALL SELECT 'quarantine', q, q FROM held)
            SELECT measure, CAST(a AS VARCHAR) AS before, CAST(b AS VARCHAR) AS after, true AS holds FROM measures""",
        "watermarks": f"""WITH {_PAGES},
            batches AS (
              SELECT 'shop.' || order_status AS source, {_STATUS_BATCH_ID} AS batch_id, max(number) AS last_number,
                     max(source_updated_at) AS to_updated_at, arg_max(order_key, number) AS to_order_key,
                     {_LATER} + to_microseconds(any_value(batch_sequence)) AS finished_at
              FROM paged WHERE order_status <> 'P' GROUP BY order_status, batch_sequence),
            state AS (SELECT * FROM batches QUALIFY row_number() OVER (PARTITION BY source ORDER BY last_number DESC) = 1),
            runs AS (SELECT 'shop.' || order_status AS source,
                            CASE WHEN order_status <> 'P' THEN {_LATER} + to_microseconds(count(*)) END AS finished_at
                     FROM journal GROUP BY order_status),
            sources AS (SELECT source FROM state UNION SELECT source FROM runs)
            SELECT sources.source, s.to_order_key AS last_order_key, s.batch_id AS last_completed_batch_id,
                   {_iso('s.to_updated_at')} AS last_updated_at, {_iso('s.finished_at')} AS checkpoint_persisted_at,
                   {_iso('b.finished_at')} AS batch_completed_at, {_iso('r.finished_at')} AS last_sync_completed_at
            FROM sources LEFT JOIN state s ON s.source = sources.source
              LEFT JOIN batches b ON b.batch_id = s.batch_id LEFT JOIN runs r ON r.source = sources.source""",
        "source_sink_diff": f"""WITH {_LEDGER},
            held AS (SELECT * FROM journal
                     QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY source_version DESC) = 1)
            {_MUTATED.format(held='held')},
            present AS (SELECT * FROM ledger WHERE disposition IN ('accepted', 'stale')
                        QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY source_version DESC) = 1)
            SELECT coalesce('order:' || m.order_key, c.entity_key) AS entity_key,
                   m.source_version AS source_version_in_source, c.source_version AS source_version_in_sink,
                   CASE WHEN c.entity_key IS NULL THEN 'missing_in_sink'
                        WHEN m.order_key IS NULL THEN 'missing_in_source'
                        WHEN m.source_version <> c.source_version THEN 'version' ELSE 'payload' END AS difference
            FROM (SELECT * FROM mutated WHERE total_price >= 0) m FULL JOIN present c
              ON c.entity_key = 'order:' || m.order_key
            WHERE m.source_version IS DISTINCT FROM c.source_version
               OR m.customer_key IS DISTINCT FROM c.customer_key OR m.customer_name IS DISTINCT FROM c.customer_name
               OR m.order_status IS DISTINCT FROM c.order_status OR m.total_price IS DISTINCT FROM c.total_price
               OR m.order_date IS DISTINCT FROM c.order_date""",
        "delivery_report": f"""WITH {_LEDGER}
            SELECT '{SOURCE}' AS source, count(*) AS deliveries, count(DISTINCT event_id) AS unique_event_ids,
                   count(*) FILTER (WHERE disposition = 'duplicate') AS duplicates
            FROM ledger WHERE event_id IS NOT NULL""",
        "partitions_per_entity": f"""WITH {_LEDGER},
            per_entity AS (SELECT entity_key, count(DISTINCT partition_id) AS partitions
                           FROM ledger WHERE entity_key IS NOT NULL AND reason_code IS NULL GROUP BY entity_key)
            SELECT partitions, count(*) AS entities FROM per_entity GROUP BY partitions""",
        "replay_counts": f"WITH {_DOUBLED} SELECT disposition, count(*) AS deliveries FROM ledger GROUP BY disposition",
        "constraint_violations": f"WITH {_LEDGER}{_SINK_VIEWS} {_SINK_RULES}",
        "capture_constraint_violations": f"""WITH {_PAGES}{_BATCHES},
            ranges AS (SELECT *, lag(to_updated_at) OVER (ORDER BY batch_sequence) AS from_updated_at,
                              lag(to_order_key) OVER (ORDER BY batch_sequence) AS from_order_key FROM pages),
            quarantined AS (SELECT *, {_BATCH_ID} AS batch_id FROM paged WHERE NOT valid),
            versions AS (SELECT order_key, max(source_version) AS source_version FROM paged WHERE valid GROUP BY 1)
            SELECT 'unique sync_batches(batch_id)' AS rule, count(*) AS violations
              FROM (SELECT 1 FROM ranges GROUP BY batch_id HAVING count(*) > 1)
            UNION ALL SELECT 'unique sync_batches(run_id, batch_sequence)', count(*)
              FROM (SELECT 1 FROM ranges GROUP BY batch_sequence HAVING count(*) > 1)
            UNION ALL SELECT 'unique source_entity_versions(source, entity_key)', count(*)
              FROM (SELECT 1 FROM versions GROUP BY order_key HAVING count(*) > 1)
            UNION ALL SELECT 'unique source_quarantine(source, source_updated_at, order_key)', count(*)
              FROM (SELECT 1 FROM quarantined GROUP BY source_updated_at, order_key HAVING count(*) > 1)
            UNION ALL SELECT 'reference source_quarantine.batch_id', count(DISTINCT batch_id)
              FROM quarantined q WHERE NOT EXISTS (SELECT 1 FROM ranges r WHERE r.batch_id = q.batch_id)
            UNION ALL SELECT 'check source_entity_versions.source_version', count(*)
              FROM versions WHERE NOT source_version > 0
            UNION ALL SELECT 'check sync_batches.batch_sequence', count(*) FROM ranges WHERE NOT batch_sequence > 0
            UNION ALL SELECT 'check sync_batches.status', 0
            UNION ALL SELECT 'check sync_batches.to_order_key', count(*) FROM ranges WHERE NOT to_order_key > 0
            UNION ALL SELECT 'check sync_batches.records_seen', count(*) FROM ranges WHERE NOT records_seen >= 0
            UNION ALL SELECT 'check sync_batches.records_published', count(*)
              FROM ranges WHERE NOT records_published >= 0
            UNION ALL SELECT 'check sync_batches.from cursor paired', count(*)
              FROM ranges WHERE (from_updated_at IS NULL) <> (from_order_key IS NULL)""",
        "ledger_losses": f"""WITH {_LEDGER}
            SELECT delivery_id FROM ledger WHERE delivery_id % 1000 = 0 OR delivery_id % 777 = 0""",
        "state_fingerprint": f"""WITH {_LEDGER}{_SINK_VIEWS},
            hashed AS (SELECT sha256({_ROW_JSON}) AS h FROM present)
            SELECT count(*) AS entities, sha256(concat_ws(',', count(*), {_LANES})) AS sha256 FROM hashed""",
        "table_census": f"""WITH {_LEDGER}{_SINK_VIEWS}
            SELECT 'event_deliveries' AS table_name, count(*) AS row_count FROM ledger
            UNION ALL SELECT 'event_rejections', count(*) FROM ledger WHERE disposition = 'rejected'
            UNION ALL SELECT 'orders_current', count(*) FROM present
            UNION ALL SELECT 'processed_events', count(*) FROM processed""",
        "planted_violations": _planted(),
        # Delivered once and in order, every valid row is accepted.
        "stats": f"""WITH {_JOURNAL},
            valid AS (SELECT * FROM journal WHERE {_IS_VALID}),
            counted AS (SELECT '' AS prefix, count(*) AS n FROM valid
                        UNION ALL SELECT event_type || ' ', count(*) FROM valid GROUP BY event_type)
            SELECT prefix || name AS measure, CASE WHEN name IN ('deliveries', 'unique_events', 'accepted') THEN n ELSE 0 END AS value
            FROM counted, (VALUES ('deliveries'), ('unique_events'), ('accepted'), ('stale'), ('duplicates'), ('rejected')) v(name)
            UNION ALL SELECT 'adapter_rejected_records', (SELECT count(*) FROM journal) - (SELECT count(*) FROM valid)
            UNION ALL SELECT 'sample_count', count(*) FROM valid
            UNION ALL SELECT '{SOURCE} last_order_key', max_by(order_key, (source_updated_at, order_key)) FROM journal""",
        "sync_runs": f"""WITH {_THREE_RUNS}
            SELECT run, CASE WHEN run = 1 THEN 'initial' ELSE 'incremental' END AS mode,
                   CASE WHEN run = 3 THEN 'completed' ELSE 'failed' END AS status,
                   (SELECT max(order_key) FROM journal WHERE source_updated_at = (SELECT max(source_updated_at) FROM journal))
                     AS high_watermark_order_key
            FROM (VALUES (1), (2), (3)) v(run)""",
        "sync_batches": f"""WITH {_THREE_RUNS}
            SELECT tries.run, tries.sequence AS batch_sequence, tries.status, tries.error_code,
                   records_seen, CASE WHEN tries.status = 'failed' THEN 0 ELSE valid END AS records_published,
                   to_order_key
            FROM tries JOIN pages ON pages.page = tries.page""",
    }
