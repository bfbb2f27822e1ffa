"""DuckDB SQL for the operators' queries that SQL can express on whole tables."""

from __future__ import annotations

from cadenza.llm.secret_scan import BASE, MORE

ORACLES: dict[str, str] = {}

# Words as the operators take them: A-Z lower-cased, split at ASCII white space, per row.
WORDS = """
words AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
)"""

ORACLES["op2_ngram_join"] = f"""
WITH RECURSIVE {WORDS},
shingles AS MATERIALIZED (
    SELECT doc_id, unnest(list_distinct(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 90 * (x.n + y.n - common)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS id, doc_id AS other FROM documents
    UNION
    SELECT reach.id, edges.b FROM reach JOIN edges ON reach.other = edges.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) r ON r.id = d.doc_id
"""

# Distinct runs of five words per row of a table.
FIVES = """
{name} AS MATERIALIZED (
    SELECT {key}, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])) END) AS s
    FROM (SELECT {key}, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM {table})
)"""

ORACLES["op5_decontamination"] = f"""
WITH {FIVES.format(name='docs', key='doc_id', table='documents')},
{FIVES.format(name='items', key='item_id', table='benchmark')},
shared AS (
    SELECT doc_id, item_id, count(*) AS n_shared
    FROM (SELECT doc_id, unnest(s) AS s FROM docs) d JOIN (SELECT item_id, unnest(s) AS s FROM items) i USING (s)
    GROUP BY ALL
)
SELECT doc_id, item_id, len(s) AS n_item, n_shared, n_shared / len(s) AS containment
FROM shared JOIN items USING (item_id)
WHERE 10 * n_shared >= 8 * len(s)
"""


def _secret_spans(number: int, rule) -> str:
    """Spans of a rule per row: the lengths of what lies between matches and of the matches, added up."""
    pattern = rule.pattern.replace("'", "''")
    # Only rows with a match that counts, where that can be told in advance.
    telling = pattern if rule.group or rule.least == 1 else pattern[:-1] + f"{{{rule.least - pattern.rindex('[')},}}"
    return f"""
    SELECT doc_id, {number} AS rule, '{rule.kind}' AS kind,
        unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))) AS s,
        unnest(list_transform(m, lambda x: length(x))) AS n, unnest(list_transform(g, lambda x: length(x))) AS judged, {rule.least} AS least
    FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {rule.group}) AS g,
          string_split_regex(text, '{pattern}') AS b FROM documents WHERE regexp_matches(text, '{telling}'))"""


ORACLES["op3_secret_scan"] = f"""
WITH every AS ({" UNION ALL ".join(_secret_spans(i, r) for i, r in enumerate(BASE + MORE))}),
spans AS (
    SELECT doc_id, rule, kind, s, concat_ws(':', kind, CAST(s AS BIGINT), CAST(s + n AS BIGINT)) AS span FROM every WHERE judged >= least
)
SELECT d.doc_id,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY s, rule) FILTER (rule < 3), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY s, rule), '') AS spans
FROM documents d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
"""

ORACLES["op4_top_k"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
