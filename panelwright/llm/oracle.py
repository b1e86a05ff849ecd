"""SQL for the operators that SQL can express: name -> DuckDB SQL over the given tables."""

from panelwright.llm.quality_rules import CURRENT, POLICIES, RULES, mask

_WORD_LIST = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)

_LEDGER = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, {_WORD_LIST} AS w FROM documents
),
g AS (
  SELECT row, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS gram
  FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM g) WHERE n > 1),
covered AS (
  SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY row
),
l AS (
  SELECT row, line FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
ll AS (SELECT row, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM l GROUP BY row),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(ll.n, 0)::BIGINT AS n_lines, coalesce(ll.dup, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters
  FROM d LEFT JOIN covered USING (row) LEFT JOIN ll USING (row)
),
b AS (SELECT *, ({_BITS})::BIGINT AS failure_bits FROM m)"""

QUALITY_RULES = f"""{_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failure_bits & {mask(POLICIES["v1"])}) <> 0 AS base_failed,
  (failure_bits & {mask(POLICIES[CURRENT])}) = 0 AS kept, failure_bits
FROM b
"""

_POLICY_RULES = ", ".join(
    f"('{policy}', {mask(names)}, '{r.name}', {1 << r.bit})"
    for policy, names in POLICIES.items() for r in RULES if r.name in names
)
RULE_ABLATIONS = f"""{_LEDGER}
SELECT policy, rule, count(*) AS documents, count(*) FILTER (WHERE failure_bits & whole <> 0) AS rejected,
  count(*) FILTER (WHERE failure_bits & bit <> 0) AS fails,
  count(*) FILTER (WHERE failure_bits & whole = bit) AS fails_alone
FROM b, (VALUES {_POLICY_RULES}) AS p(policy, whole, rule, bit) GROUP BY policy, rule
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOLDED = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LINE_DEDUP = r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
),
l AS (
  SELECT doc_id, i, len(regexp_extract_all(lines[i], '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
),
c AS (
  SELECT doc_id, i, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l
),
spans AS (
  SELECT a.doc_id, a.i AS first, min(b.i) AS last
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - (a.upto - a.n) >= 50 GROUP BY 1, 2
  UNION
  SELECT b.doc_id, max(a.i), b.i
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - (a.upto - a.n) >= 50 GROUP BY b.doc_id, b.i
),
w AS (
  SELECT doc_id, first, last, array_to_string(lines[first:last], chr(10)) AS run FROM spans JOIN d USING (doc_id)
),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM (
    SELECT *, min(struct_pack(a := doc_id, b := first)) OVER (PARTITION BY run) AS least FROM w
  ) WHERE struct_pack(a := doc_id, b := first) > least
),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY 1)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN gone IS NULL THEN text
       ELSE array_to_string([lines[k] FOR k IN range(1, len(lines) + 1) IF NOT list_contains(gone, k)], chr(10))
  END AS text
FROM d LEFT JOIN g USING (doc_id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 75 * (na.n + nb.n - common)
),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_FOLDED} AS w FROM benchmark) WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS key
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)
),
places AS (
  SELECT row, n, i, array_to_string(w[i:i+n-1], ' ') AS key
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)
),
found AS (SELECT row, item_id, n, i FROM places JOIN win USING (n, key)),
hits AS (SELECT row, count(DISTINCT k) AS n FROM (SELECT row, unnest(range(i, i + n)) AS k FROM found) GROUP BY 1),
items AS (
  SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM found) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (row) LEFT JOIN items USING (row)
"""

RANKED_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_FOLDED} AS w FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM tf, s GROUP BY term, n_docs
),
b AS (
  SELECT DISTINCT item, item_id, term
  FROM (SELECT row_number() OVER () AS item, item_id, unnest({_FOLDED}) AS term FROM benchmark)
),
scores AS (
  SELECT item, item_id, row, doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // length))))::BIGINT AS score
  FROM b JOIN weights USING (term) JOIN tf USING (term), s GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

SOURCE_DIVERGENCE = rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM d),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10
),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (
  SELECT lang, source, term, count(*) AS n
  FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
total AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN n USING (lang, source) GROUP BY ALL
),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, total,
    1 + (1000000000 * (coalesce(n, 0) + 2)::HUGEINT) // (total + 2 * v) AS p
  FROM total JOIN kept USING (lang) JOIN vocabulary USING (lang) LEFT JOIN n USING (lang, source, term)
),
q AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + 2)::HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM p JOIN vocabulary USING (lang) GROUP BY lang, term, v
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms
),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM every
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

LLM_ORACLE = {
    "op3_quality_rules": QUALITY_RULES,
    "quality_rule_ablations": RULE_ABLATIONS,
    "op5_line_dedup": LINE_DEDUP,
    "op8_near_duplicates": NEAR_DUPLICATES,
    "op10_decontamination": DECONTAMINATION,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_source_divergence": SOURCE_DIVERGENCE,
}
