"""SQL for the queries of ``upkeep``: name -> DuckDB SQL."""

from panelwright import contract
from panelwright.plans.given_tables import SCHEMAS
from panelwright.plans.oracle import CUSTOMER_PANEL, INDEX, MEASURES, ORACLE, RATIOS, SCALED, _INDICES, _rounded

_CHANGED = {
    "researchers_count": "CASE WHEN entity % 10 = 1 AND year % 2 = 0 THEN NULL ELSE researchers_count END",
    "gdp": "CASE WHEN entity % 10 = 1 AND year % 2 = 0 THEN gdp / 2 ELSE gdp END",
}
_CHANGED_PANEL = (
    CUSTOMER_PANEL.replace("panel AS (", "given AS (") + ", panel AS (SELECT entity, year, "
    + ", ".join(f"{_CHANGED.get(m, m)} AS {m}" for m in MEASURES) + " FROM given)"
)

_RECORDS = """
    WITH o AS (
      SELECT o_orderkey AS n, o_totalprice, o_orderstatus,
        CASE o_orderkey % 6 WHEN 0 THEN 2 WHEN 2 THEN 2 WHEN 5 THEN 0 ELSE 1 END AS copies FROM orders)
    SELECT 'orders' AS dataset, n, n AS id, o_totalprice AS total, o_orderstatus AS state
    FROM o, generate_series(1, copies)
    UNION ALL
    SELECT 'turns', conv_id, turn, CAST(length(text) AS DOUBLE), role FROM conversations"""

_GRAPH = """
    WITH RECURSIVE models AS (SELECT c_custkey AS model, c_acctbal FROM customer),
    edges AS (
      SELECT model, model // 2 AS needs FROM models WHERE model > 1
      UNION SELECT model, 2 * model FROM models WHERE model % 50 = 27
      UNION SELECT model, -model FROM models WHERE model % 97 = 61),
    failed AS (SELECT model FROM models WHERE c_acctbal < -900 AND model > 16),
    causes AS (
      SELECT model AS node, model AS cause FROM failed
      UNION SELECT needs, needs FROM edges WHERE needs NOT IN (SELECT model FROM models)
      UNION SELECT edges.model, cause FROM causes JOIN edges ON edges.needs = causes.node),
    blocked AS (
      SELECT node AS model, min(cause) AS cause FROM causes WHERE node NOT IN (SELECT model FROM failed) GROUP BY 1),
    free AS (SELECT * FROM edges WHERE model NOT IN (SELECT model FROM blocked UNION SELECT model FROM failed)),
    reach AS (SELECT model, needs FROM free UNION SELECT reach.model, free.needs FROM reach JOIN free ON free.model = reach.needs),
    circular AS (
      SELECT DISTINCT model FROM reach WHERE needs IN (SELECT model FROM reach WHERE model = needs)
      UNION SELECT model FROM reach WHERE model = needs),
    levels AS (
      SELECT model, 0 AS level FROM models
      WHERE model NOT IN (SELECT model FROM edges UNION SELECT model FROM blocked UNION SELECT model FROM failed)
      UNION
      SELECT free.model, level + 1 FROM levels JOIN free ON free.needs = levels.model
      WHERE free.model NOT IN (SELECT model FROM circular))
    SELECT model,
      CASE WHEN model IN (SELECT model FROM failed) THEN 'failed' WHEN cause IS NOT NULL THEN 'blocked'
        WHEN model IN (SELECT model FROM circular) THEN 'circular' ELSE 'buildable' END AS status,
      cause, level
    FROM models LEFT JOIN blocked USING (model)
    LEFT JOIN (SELECT model, max(level)::INTEGER AS level FROM levels GROUP BY 1) USING (model)"""

_AUDITED = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey"], "customer": ["c_custkey"], "events": ["user_id", "event_type"]}


def _audit(name: str, keys: list[str]) -> str:
    columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE "
        f"{f'{keys[0]} % 7 = 0 OR ' if i in (2, 3) else ''}{c} IS NULL) AS null_count FROM {name}"
        for i, c in enumerate(columns)
    )
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {name}))"
    return f"""SELECT 'run-1' AS run_id, '{name}' AS model, (SELECT count(*) FROM {name}) AS row_count,
        {distinct} < 0.95 * (SELECT count(*) FROM {name}) AS keys_repeat, * FROM ({counts})"""


UPKEEP_SQL = {
    "bucketed_panel": ORACLE["customer_panel_left_joins"],
    "bucketed_upsert": ORACLE["keyed_merge"],
    "write_audit": " UNION ALL ".join(_audit(name, keys) for name, keys in _AUDITED.items()),
    "bad_records": """
        SELECT event_id, event_type, value, NULL::VARCHAR AS reason FROM events WHERE event_id % 40 > 3
        UNION ALL
        SELECT event_id, NULL, NULL, CASE event_id % 40 WHEN 0 THEN 'no JSON' WHEN 1 THEN 'wrong type' ELSE 'no object' END
        FROM events WHERE event_id % 40 < 3""",
    "variant_records": _RECORDS,
    "variant_shapes": """
        SELECT 'orders' AS dataset, count(*) FILTER (WHERE o_orderkey % 6 = 5) AS n_unreadable, 'OBJECT<amount: STRING, id: BIGINT, '
          || 'orderKey: STRING, state: STRING, status: OBJECT<code: STRING>, total: DECIMAL>' AS shape FROM orders
        UNION ALL SELECT 'turns', 0, 'OBJECT<id: BIGINT, state: STRING, total: BIGINT>'""",
    "build_status": _GRAPH,
    "split_array_file": ORACLE["flatten_indicator"],
    "distinct_over_days": """
        WITH o AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS day, o_custkey FROM orders),
        days AS (SELECT o_orderstatus, day, count(DISTINCT o_custkey) AS of_day FROM o GROUP BY 1, 2),
        months AS (
          SELECT days.o_orderstatus, days.day, count(DISTINCT o.o_custkey) AS of_30_days
          FROM days JOIN o ON o.o_orderstatus = days.o_orderstatus AND o.day BETWEEN days.day - 29 AND days.day GROUP BY 1, 2)
        SELECT o_orderstatus, day::INTEGER AS day, of_day, of_30_days, of_all
        FROM days JOIN months USING (o_orderstatus, day)
        JOIN (SELECT o_orderstatus, count(DISTINCT o_custkey) AS of_all FROM o GROUP BY 1) USING (o_orderstatus)""",
    "distinct_texts_over_turns": """
        WITH w AS (SELECT role, turn, lower(regexp_extract(text, '^\\S+')) AS word FROM conversations),
        ends AS (SELECT DISTINCT role, turn FROM w WHERE word <> '')
        SELECT ends.role, ends.turn, count(DISTINCT word) AS n_words
        FROM ends JOIN w ON w.role = ends.role AND w.turn BETWEEN ends.turn - 2 AND ends.turn AND word <> '' GROUP BY 1, 2""",
    "maintained_index": f"""{_CHANGED_PANEL}{RATIOS}{SCALED}{INDEX}
        SELECT entity, year, {_rounded([*_INDICES, contract.SCORE], 6)} FROM scored""",
}

_DELIVERED = """
    WITH hours AS (
      SELECT event_id % 7 AS lag, * FROM events UNION ALL SELECT event_id % 4 + 1, * FROM events WHERE event_id % 5 = 0
    ),
    d AS (
      SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS event_id, event_type, value,
        CASE WHEN event_id % 97 = 0 THEN 'no key' WHEN event_id % 89 = 0 THEN 'no time' WHEN lag > 3 THEN 'late'
          ELSE 'on time' END AS status
      FROM hours
    )"""
UPKEEP_SQL["late_events"] = f"""{_DELIVERED}
    SELECT DISTINCT * FROM d WHERE status = 'on time' UNION ALL SELECT * FROM d WHERE status <> 'on time'"""
UPKEEP_SQL["late_event_counts"] = f"""{_DELIVERED}
    SELECT event_type, status, count(*) AS n FROM d WHERE status <> 'on time' GROUP BY ALL"""

