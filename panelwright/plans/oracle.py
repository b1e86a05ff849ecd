"""The same results as ANSI SQL over the given tables, for the side-by-side check."""

from panelwright import contract
from panelwright.plans.given_tables import CUSTOMER_PRIZE, NATION_PRIZE, SCHEMAS
from panelwright.plans.queries import TABLE_KEYS

MEASURES = list(contract.MEASURES)


def _strict(c: str) -> str:
    return f"upper(trim(regexp_replace({c}, '[^a-zA-Z\\s]+', '', 'g'), ' '))"


def _light(c: str) -> str:
    return f"upper(trim({c}, ' '))"


def _letters(c: str) -> str:
    return f"translate({c}, '0123456789_', 'ABCDEFGHIJ ')"


def _year(c: str) -> str:
    return f"CAST(year({c}) AS INTEGER)"


# ---- panels

_CENTS = "CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)"

NATION_INPUTS = f"""
order_rows AS (
  SELECT c_nationkey AS entity, {_year('o_orderdate')} AS year, o_custkey, o_orderkey, o_totalprice,
         {_CENTS} AS cents, o_orderpriority, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey),
order_measures AS (
  SELECT entity, year,
         CAST(count(DISTINCT o_custkey) AS DOUBLE) AS population,
         CAST(sum(cents) AS DOUBLE) / 100 AS gdp,
         CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN cents END) AS DOUBLE) / 100 AS rd_expenditure,
         CASE WHEN n_regionkey <> 0
              THEN 100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) END
           AS graduate_unemployment_rate
  FROM order_rows JOIN nation ON entity = n_nationkey GROUP BY entity, year, n_regionkey),
line_rows AS (
  SELECT s_nationkey AS entity, {_year('l_shipdate')} AS year, l_suppkey, l_quantity, c_nationkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey),
line_measures AS (
  SELECT entity, year,
         CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS researchers_count,
         CAST(sum(l_quantity) AS BIGINT) AS patents_total,
         CAST(sum(CASE WHEN c_nationkey = entity THEN l_quantity ELSE 0 END) AS BIGINT) AS resident_patents,
         CAST(sum(CASE WHEN c_nationkey <> entity THEN l_quantity ELSE 0 END) AS BIGINT) AS abroad_patents
  FROM line_rows GROUP BY entity, year),
prize_measures AS (
  SELECT entity, year, count(DISTINCT o_orderkey) AS nobel_laureates_count
  FROM order_rows WHERE o_totalprice > {NATION_PRIZE} GROUP BY entity, year)
"""

CUSTOMER_INPUTS = f"""
order_measures AS (
  SELECT o_custkey AS entity, {_year('o_orderdate')} AS year,
         CAST(count(*) AS DOUBLE) AS population,
         CAST(sum({_CENTS}) AS DOUBLE) / 100 AS gdp,
         CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN {_CENTS} END) AS DOUBLE) / 100 AS rd_expenditure,
         100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS graduate_unemployment_rate
  FROM orders GROUP BY 1, 2),
line_rows AS (
  SELECT o_custkey AS entity, {_year('l_shipdate')} AS year, l_suppkey, l_quantity, c_nationkey, s_nationkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
line_measures AS (
  SELECT entity, year,
         CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS researchers_count,
         CAST(sum(l_quantity) AS BIGINT) AS patents_total,
         CAST(sum(CASE WHEN c_nationkey = s_nationkey THEN l_quantity ELSE 0 END) AS BIGINT) AS resident_patents,
         CAST(sum(CASE WHEN c_nationkey <> s_nationkey THEN l_quantity ELSE 0 END) AS BIGINT) AS abroad_patents
  FROM line_rows GROUP BY entity, year),
prize_measures AS (
  SELECT o_custkey AS entity, {_year('o_orderdate')} AS year, count(DISTINCT o_orderkey) AS nobel_laureates_count
  FROM orders WHERE o_totalprice > {CUSTOMER_PRIZE} GROUP BY 1, 2)
"""


def _panel(inputs: str, entities: str) -> str:
    return f"""WITH {inputs},
grid AS (
  SELECT entity, CAST(y AS INTEGER) AS year
  FROM ({entities}) CROSS JOIN (
    SELECT unnest(generate_series(min(y), max(y))) AS y FROM (
      SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(l_shipdate) FROM lineitem))),
panel AS (
  SELECT grid.entity, grid.year, {', '.join(MEASURES)}
  FROM grid LEFT JOIN order_measures USING (entity, year)
  LEFT JOIN line_measures USING (entity, year) LEFT JOIN prize_measures USING (entity, year))"""


NATION_PANEL = _panel(NATION_INPUTS, "SELECT n_nationkey AS entity FROM nation")
CUSTOMER_PANEL = _panel(CUSTOMER_INPUTS, "SELECT c_custkey AS entity FROM customer")


def _rint(c: str, digits: int) -> str:
    return f"round_even({c} * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE"


def _rounded(columns, digits: int = 9) -> str:
    return ", ".join(f"{_rint(c, digits)} AS {c}" for c in columns)


_DOUBLE_MEASURES = MEASURES[:5]
_PANEL_OUT = (
    f"SELECT entity, year, {_rounded(_DOUBLE_MEASURES, 6)}, {', '.join(MEASURES[5:])} FROM panel"
)


def _per_million(n: str) -> str:
    return f"CASE WHEN population > 0 THEN CAST({n} AS DOUBLE) / (population / 1000000.0::DOUBLE) END"


RATIOS = f""",
ratios AS (
  SELECT *,
    {_per_million('patents_total')} AS patents_per_million,
    {_per_million('resident_patents')} AS resident_patents_per_million,
    {_per_million('nobel_laureates_count')} AS nobelists_per_million,
    CASE WHEN resident_patents > 0 THEN CAST(abroad_patents AS DOUBLE) / resident_patents END
      AS patent_expansion_ratio,
    {_per_million('researchers_count')} AS researchers_per_million,
    CASE WHEN gdp > 0 THEN rd_expenditure / gdp * 100.0::DOUBLE END AS rd_gdp_pct
  FROM panel)"""


def _norm(c: str) -> str:
    log = f"ln(1.0::DOUBLE + coalesce({c}, 0.0::DOUBLE))"
    low, high = f"min({log}) OVER ()", f"max({log}) OVER ()"
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {high} = {low} THEN 0.5::DOUBLE "
        f"ELSE ({log} - {low}) / ({high} - {low}) END AS {c}_norm"
    )


def _weighted(weights: dict[str, float]) -> str:
    present = " OR ".join(f"{c} IS NOT NULL" for c in weights)
    total = " + ".join(f"coalesce({c}, 0.0::DOUBLE) * {w}::DOUBLE" for c, w in weights.items())
    return f"CASE WHEN {present} THEN {total} END"


def _score() -> str:
    total = " + ".join(f"coalesce({c}, 0.0::DOUBLE) * {w}::DOUBLE" for c, w in contract.SCORE_WEIGHTS.items())
    weight = " + ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for c, w in contract.SCORE_WEIGHTS.items())
    return f"CASE WHEN ({weight}) > 0 THEN ({total}) / ({weight}) END"


SCALED = f""",
scaled AS (SELECT *, {', '.join(_norm(c) for c in contract.SCALED)} FROM ratios)"""

INDEX = f""",
indexed AS (
  SELECT *,
    {_weighted(contract.PATENTS_WEIGHTS)} AS patents_index,
    {_weighted(contract.RESEARCH_WEIGHTS)} AS research_index,
    rd_gdp_pct_norm AS rd_index,
    1.0::DOUBLE - graduate_unemployment_rate_norm AS unemployment_index
  FROM scaled),
scored AS (SELECT *, {_score()} AS {contract.SCORE} FROM indexed)"""

_RATIO_NAMES = list(contract.SCALED[:6])
_NORMS = [f"{c}_norm" for c in contract.SCALED]
_INDICES = list(contract.SCORE_WEIGHTS)
_FACT_OUT = (
    f"{_rounded(_DOUBLE_MEASURES, 6)}, {', '.join(MEASURES[5:])}, "
    f"{_rounded([*_RATIO_NAMES, *_NORMS, *_INDICES, contract.SCORE], 6)}"
)
_CUSTOMER_SCORES = f"""{CUSTOMER_PANEL}{RATIOS}{SCALED}{INDEX},
scores AS (SELECT entity, year, {_rint(contract.SCORE, 6)} AS score FROM scored)"""

# The fact goes through names and wide text files; what that changes: a laureate needs a
# nation that also has patents, and every sixth customer nation is unknown as an office.
_FACT_PANEL = NATION_PANEL.replace("WHEN c_nationkey", "WHEN c_nationkey % 6 <> 0 AND c_nationkey").replace(
    "FROM order_rows WHERE",
    "FROM order_rows WHERE entity IN (SELECT entity FROM line_measures WHERE patents_total > 0) AND",
)
FACT = f"""{_FACT_PANEL}{RATIOS}{SCALED}{INDEX}
SELECT 'N' || entity AS iso, year, {_FACT_OUT} FROM scored"""


# ---- raw shapes

_K = "CAST(props::JSON->>'k' AS INTEGER)"
_EVENT_CODE = "CASE WHEN event_type = 'signup' THEN '' WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END"
_EVENT_YEAR = f"CASE WHEN {_K} % 10 <> 0 THEN CAST({_K} + 1900 AS INTEGER) END"
_EVENT_NAME = f"'User-' || {_letters('CAST(user_id AS VARCHAR)')}"

_TRADED = f"""traded AS (
  SELECT o.n_name AS office, s.n_name AS origin, c_nationkey, {_year('l_shipdate')} AS year,
         CAST(sum(l_quantity) AS BIGINT) AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation s ON s_nationkey = s.n_nationkey
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation o ON c_nationkey = o.n_nationkey AND c_nationkey % 6 <> 0
  GROUP BY ALL)"""

_RESIDENT = "CASE WHEN origin = office THEN quantity ELSE 0 END"
_ABROAD = "CASE WHEN origin <> office THEN quantity ELSE 0 END"


def _customer_name(key: str) -> str:
    return f"'Customer' || {_letters(f'''lpad(CAST({key} AS VARCHAR), 9, '0')''')}"


def _audit() -> str:
    parts = []
    for name, schema in SCHEMAS.items():
        keys = ", ".join(TABLE_KEYS[name])
        for column in (field.split()[0] for field in schema.split(", ")):
            parts.append(
                f"SELECT 'run-1' AS run_id, '{name}' AS model, (SELECT count(*) FROM {name}) AS row_count, "
                f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {name})) AS key_count, "
                f"'{column}' AS column_name, (SELECT count(*) FROM {name} WHERE {column} IS NULL) AS null_count")
    return " UNION ALL ".join(parts)


_OY = _year("o_orderdate")

ORACLE = {
    "flatten_indicator": f"""
        SELECT {_EVENT_NAME} AS country_name, {_EVENT_CODE} AS iso, {_EVENT_YEAR} AS year, value,
               {_strict(_EVENT_NAME)} AS country_name_normalized
        FROM events WHERE event_type <> 'error'""",
    "project_by_dataset": f"""
        WITH e AS (
          SELECT {_EVENT_NAME} AS country_name, {_EVENT_CODE} AS code, {_EVENT_YEAR} AS year, value FROM events)
        SELECT country_name, code AS iso, year, value AS unemployment_rate,
               {_strict('country_name')} AS country_name_normalized, 'unemployment' AS dataset,
               NULL::DOUBLE AS value FROM e WHERE code IS NOT NULL
        UNION ALL
        SELECT country_name, code, year, NULL, {_strict('country_name')}, 'rd', value FROM e WHERE code IS NOT NULL
        UNION ALL
        SELECT country_name, code, NULL, NULL, NULL, 'not listed', value FROM e""",
    "explode_awards": f"""
        WITH flat AS (
          SELECT CAST(o_orderkey AS VARCHAR) AS laureate_id,
                 coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END,
                          CASE WHEN o_orderkey % 5 <> 0 THEN '  now ' || lower(o_orderpriority) END) AS country,
                 CAST(year(o_orderdate) + i AS INTEGER) AS year
          FROM orders, generate_series(1, 6) AS g(i)
          WHERE o_orderkey % 7 > 1 AND i <= o_orderkey % 7)
        SELECT *, {_light('country')} AS country_normalized FROM flat WHERE country IS NOT NULL""",
    "unpivot_years": f"""
        SELECT o_custkey, {_OY} AS year, CAST(sum({_CENTS}) AS DOUBLE) / 100 AS value FROM orders
        WHERE year(o_orderdate) IS NOT NULL GROUP BY 1, 2""",
    "safe_cast_positive": """
        WITH t AS (
          SELECT l_orderkey, l_linenumber, CASE l_linenumber
            WHEN 1 THEN '' WHEN 2 THEN 'x' WHEN 3 THEN '1,234' WHEN 4 THEN '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
            WHEN 5 THEN '0' WHEN 6 THEN ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' '
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS token FROM lineitem)
        SELECT l_orderkey, l_linenumber, TRY_CAST(token AS BIGINT) AS patents_count FROM t
        WHERE TRY_CAST(token AS BIGINT) > 0""",
    "resident_split": f"""
        WITH {_TRADED}
        SELECT origin AS "Origin", year, CAST(sum(quantity) AS BIGINT) AS patents_total,
               CAST(sum({_RESIDENT}) AS BIGINT) AS resident_patents, CAST(sum({_ABROAD}) AS BIGINT) AS abroad_patents
        FROM traded GROUP BY 1, 2""",
    "flatten_patents": f"""
        WITH {_TRADED}
        SELECT office AS "Office", CAST(c_nationkey AS VARCHAR) AS office_code, origin AS "Origin", year,
               quantity AS patents_count, CAST({_RESIDENT} AS BIGINT) AS resident_patents,
               CAST({_ABROAD} AS BIGINT) AS abroad_patents, {_light('origin')} AS country_code
        FROM traded WHERE quantity > 0 AND year IS NOT NULL""",
    "normalise_names": f"""
        WITH n AS (
          SELECT p_name || '-' || p_brand AS name FROM part
          UNION ALL SELECT ' ' || c_name || ' ' FROM customer)
        SELECT name, {_strict('name')} AS strict, {_light('name')} AS light FROM n""",
    "normalise_texts": f"SELECT doc_id, {_strict('text')} AS strict FROM documents",
    "entity_presence_flags": """
        SELECT c_custkey, c_name,
          CAST(EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS INTEGER) AS ref_orders,
          CAST(EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS INTEGER)
            AS ref_urgent,
          CAST(EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 495000) AS INTEGER) AS ref_large
        FROM customer""",
    "country_master": f"""
        WITH c AS (
          SELECT CAST(c_custkey AS VARCHAR) AS iso, {_letters('c_name')} AS country_name,
                 {_strict(_letters('c_name'))} AS name_key FROM customer),
        p AS (SELECT DISTINCT {_light(_customer_name('o_custkey'))} AS k FROM orders WHERE o_totalprice > 450000),
        l AS (SELECT DISTINCT {_light(_customer_name('o_custkey'))} AS k FROM orders WHERE o_totalprice > 490000)
        SELECT iso, country_name,
          CAST(iso IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F') AS INTEGER) AS ref_worldbank,
          CAST(name_key IN (SELECT k FROM l) AS INTEGER) AS ref_nobelprize,
          CAST(name_key IN (SELECT k FROM p) AS INTEGER) AS ref_patents,
          CASE WHEN name_key IN (SELECT k FROM p) THEN name_key END AS country_code
        FROM c""",
    "conform_inner": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS iso, {_OY} AS year, o_totalprice AS value, c_name AS country_name
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderkey % 11 <> 0 AND c_mktsegment <> 'BUILDING'""",
    "conform_by_name": f"""
        WITH o AS (
          SELECT o_orderkey, ' customer' || CASE WHEN o_orderkey % 2 = 0 THEN '#' ELSE '' END
            || {_letters("lpad(CAST(o_custkey AS VARCHAR), 9, '0')")} AS name FROM orders),
        c AS (SELECT c_custkey, {_letters('c_name')} AS name FROM customer)
        SELECT 'strict' AS kind, o_orderkey, c_custkey FROM o JOIN c ON {_strict('o.name')} = {_strict('c.name')}
        UNION ALL
        SELECT 'light', o_orderkey, c_custkey FROM o JOIN c ON {_light('o.name')} = {_light('c.name')}""",
    "agg_then_join": f"""
        SELECT s_name, s_nationkey, {_year('l_shipdate')} AS year, CAST(sum(l_quantity) AS BIGINT) AS total,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS returned
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name, s_nationkey, 3""",
    "distinct_count_by_group": f"""
        SELECT c_nationkey AS entity, {_OY} AS year, count(DISTINCT o_orderkey) AS nobel_laureates_count
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > {NATION_PRIZE} GROUP BY 1, 2""",
    "year_dim": """
        WITH s AS (SELECT min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem)
        SELECT CAST(y AS INTEGER) AS year, CAST(y - a AS BIGINT) AS year_id
        FROM (SELECT a, unnest(generate_series(a, b)) AS y FROM s)""",
    "entity_dim": """
        SELECT c_custkey, c_name, n_name, r_name FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "scaffold_grid": """
        WITH s AS (SELECT min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem)
        SELECT c_custkey, CAST(y AS INTEGER) AS year
        FROM customer CROSS JOIN (SELECT unnest(generate_series(a, b)) AS y FROM s)""",
    "panel_left_joins": f"{NATION_PANEL} {_PANEL_OUT}",
    "panel_union_long": f"{NATION_PANEL} {_PANEL_OUT}",
    "customer_panel_left_joins": f"{CUSTOMER_PANEL} {_PANEL_OUT}",
    "customer_panel_union_long": f"{CUSTOMER_PANEL} {_PANEL_OUT}",
    "per_capita_ratios": f"{NATION_PANEL}{RATIOS} SELECT entity, year, {_rounded(contract.SCALED, 6)} FROM ratios",
    "log1p_minmax": f"{NATION_PANEL}{RATIOS}{SCALED} SELECT entity, year, {_rounded(_NORMS)} FROM scaled",
    "sub_indices": f"{NATION_PANEL}{RATIOS}{SCALED}{INDEX} SELECT entity, year, {_rounded(_INDICES)} FROM indexed",
    "composite_index": f"{NATION_PANEL}{RATIOS}{SCALED}{INDEX} SELECT entity, year, {_FACT_OUT} FROM scored",
    "customer_composite_index": f"""{CUSTOMER_PANEL}{RATIOS}{SCALED}{INDEX}
        SELECT entity, year, {_rounded([*_INDICES, contract.SCORE])} FROM scored""",
    "rank_by_year": f"""{_CUSTOMER_SCORES}
        SELECT *, CAST(dense_rank() OVER (PARTITION BY year ORDER BY score DESC NULLS LAST) AS INTEGER) AS rank
        FROM scores""",
    "top_k_by_year": f"""{_CUSTOMER_SCORES},
        ranked AS (
          SELECT *, CAST(dense_rank() OVER (PARTITION BY year ORDER BY score DESC) AS INTEGER) AS rank
          FROM scores WHERE score IS NOT NULL)
        SELECT * FROM ranked WHERE rank <= 10""",
    "fact_innovation": FACT,
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "missing_inputs": """
        SELECT o_orderkey AS model FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
    "audit_counts": _audit(),
    "status_rollup": """
        WITH r AS (
          SELECT CAST(event_id // 4 AS BIGINT) AS run_id, CAST(round(value * 1000) AS BIGINT) AS ms,
                 CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' ELSE 'COMPLETED' END AS s
          FROM events),
        runs AS (SELECT DISTINCT event_id - event_id % 2 AS run_id FROM events),
        j AS (
          SELECT runs.run_id, count(s) AS n, CAST(coalesce(sum(ms), 0) AS BIGINT) AS ms,
                 bool_or(s = 'FAILED') AS failed, bool_or(s = 'SKIPPED') AS skipped
          FROM runs LEFT JOIN r USING (run_id) GROUP BY 1)
        SELECT run_id, n AS processed_items, ms AS duration_in_ms,
          CASE WHEN n = 0 THEN 'NO_RESULTS' WHEN failed THEN 'FAILED' WHEN skipped THEN 'PARTIAL_SUCCESS'
               ELSE 'COMPLETED' END AS status,
          CASE WHEN failed THEN 'FAILED' ELSE 'COMPLETED' END AS landing_status,
          CASE WHEN failed OR skipped THEN 'FAILED' ELSE 'COMPLETED' END AS model_status
        FROM j""",
    "lake_uri": """
        WITH u AS (
          SELECT page_id, split_part(split_part(split_part(url, '?', 1), '#', 1), '://', 2) AS rest FROM pages),
        v AS (
          SELECT page_id, split_part(split_part(rest, '/', 1), '.', 1) AS account,
                 CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS folder FROM u),
        w AS (
          SELECT *, lower(split_part(folder, '/', 2)) AS container,
                 array_to_string((string_split(folder, '/'))[3:], '/') AS path FROM v)
        SELECT page_id, 'abfss://' || container || '@' || account || '.dfs.core.windows.net/' || path AS uri,
          'https://acct.blob.core.windows.net' || CASE WHEN folder = '' THEN '/' ELSE folder END AS absolute,
          'https://acct.blob.core.windows.net/bronze/' || ltrim(folder, '/') AS blob,
          'abfss://acct@acct.dfs.core.windows.net/' || folder AS own_container,
          'abfss://silver@acct.dfs.core.windows.net/' || folder AS table_location,
          'base/' || trim(folder, '/') || '|' || 'base/' || trim(folder, '/') AS prefixed
        FROM w""",
    "envelope_records": """
        SELECT o_orderkey AS k, CAST(i AS INTEGER) AS i, o_orderstatus AS s
        FROM orders, generate_series(0, 1) AS g(i) WHERE o_orderkey % 9 > 1""",
    "raw_page_records": """
        SELECT '{"k":' || o_orderkey || ',"i":' || i || ',"s":"' || o_orderstatus || '"}' AS record
        FROM orders, generate_series(0, 1) AS g(i) WHERE o_orderkey % 9 > 1""",
    "keyed_envelope_records": "SELECT conv_id, turn, role, text FROM conversations WHERE turn % 3 <> 2",
    "source_routing": """
        SELECT 'docs' AS domain_source, d.doc_id AS dataset_name,
               coalesce(url, CASE WHEN l.doc_id IS NOT NULL THEN 'landed/' || l.doc_id END) AS path,
               CASE WHEN page_id IS NOT NULL THEN 'manual' WHEN l.doc_id IS NOT NULL THEN 'landed' END AS origin
        FROM documents d LEFT JOIN pages ON page_id = d.doc_id AND page_id % 2 = 0
        LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "summary_valid_paths": """
        SELECT event_type AS domain_source, 'population' AS dataset_name, 'population/' || event_id || '/' || i AS path
        FROM events, generate_series(1, 2) AS g(i) WHERE event_type <> 'error'
        UNION ALL
        SELECT event_type, 'rd', 'rd/' || event_id || '/1' FROM events WHERE user_id % 3 <> 0""",
    "summary_validity": """
        SELECT CAST(event_id AS VARCHAR) AS correlation_id, event_type <> 'error' AND user_id % 3 <> 0 AS run_valid,
               CAST(event_type NOT IN ('error', 'view') AS INTEGER) AS landed FROM events""",
    "config_fingerprint": """
        SELECT c_custkey, substr(sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment
          || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}'), 1, 8) AS config_hash
        FROM customer""",
    "idempotent_landing": f"""
        SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS ingest_date,
               o_orderpriority AS config_hash,
               CASE WHEN year(o_orderdate) <= 1998 THEN 'run-1' ELSE 'run-2' END AS run_id FROM orders""",
    "idempotent_records": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, {_OY} AS y,
               sha256('{{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"'
                 || o_orderstatus || '","y":' || year(o_orderdate) || '}}') AS hash FROM orders""",
    "keyed_merge": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority FROM orders""",
    "latest_per_key": """
        SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value
        FROM events GROUP BY 1, 2""",
    "merge_partitions": f"""
        SELECT o_orderkey, CASE WHEN year(o_orderdate) IN (1996, 2000) AND o_orderkey % 2 = 0 THEN 'X'
          ELSE o_orderstatus END AS o_orderstatus, {_OY} AS year FROM orders""",
    "partition_overwrite": f"""
        SELECT o_orderkey, o_custkey, {_OY} AS year FROM orders WHERE year(o_orderdate) <> 1997 OR o_custkey % 2 = 0""",
    "schema_evolving_append": """
        SELECT p_partkey, p_name, NULL::INTEGER AS nation FROM part
        UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
    "append_evolving": """
        SELECT p_partkey, p_name, NULL::INTEGER AS nation FROM part
        UNION ALL SELECT c_custkey, NULL, c_nationkey FROM customer""",
    "format_round_trip": """
        SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'run-1' AS run_id, format
        FROM customer, (VALUES ('csv'), ('json'), ('parquet')) AS f(format)""",
    "persist_counts": """
        SELECT 'orders' AS model, 'COMPLETED' AS status, count(*) AS record_count, count(*) AS stored_rows FROM orders
        UNION ALL
        SELECT 'open_orders', CASE WHEN count(*) > 0 THEN 'COMPLETED' ELSE 'SKIPPED' END, count(*), count(*)
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT 'none', 'SKIPPED', 0, 0""",
    "incremental_landing": "SELECT * FROM events",
    "incremental_upsert": """
        SELECT event_type, user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value
        FROM events GROUP BY 1, 2""",
}

# The same records through other file layouts.
ORACLE["array_files"] = ORACLE["inferred_lines"] = ORACLE["flatten_indicator"]
ORACLE["laureate_lines"] = ORACLE["explode_awards"]
ORACLE["silver_inputs"] = f"""
    SELECT 'population' AS dataset, 'present' AS status, count(*) AS n FROM ({ORACLE["flatten_indicator"]})
    UNION ALL SELECT 'laureates', 'present', count(*) FROM ({ORACLE["explode_awards"]})
    UNION ALL SELECT 'patents', 'present', count(*) FROM ({ORACLE["flatten_patents"]})
    UNION ALL SELECT 'rd', 'missing', 0"""
