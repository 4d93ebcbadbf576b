"""The results of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

import re
import string

from replyforge.llm import license_scan
from replyforge.llm.quality_rules import BOILERPLATE, LineRules

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_SOLID = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Each byte with the 50 bytes from it on; the smallest document of each such string; covered bytes; runs of them.
SUFFIX_DEDUP = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(generate_series(1, octet_length(h))) AS i FROM b),
s AS (SELECT doc_id, i, hex(array_slice(h, i, i)) AS byte, CASE WHEN i + 49 <= octet_length(h) THEN array_slice(h, i, i + 49) END AS w FROM p),
f AS (SELECT doc_id, i, byte, w IS NOT NULL AND min(doc_id) OVER (PARTITION BY w) < doc_id AS starts FROM s),
c AS (SELECT doc_id, i, byte, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS head FROM c),
a AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE head) AS n_spans,
             string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT b.doc_id, cast(octet_length(b.h) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN a USING (doc_id)"""

# Shingles, pairs that share enough of them, and what can be reached from a document.
JACCARD_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SOLID}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS x
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_same FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_same >= 85 * (x.n + y.n - n_same)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS v, doc_id AS r FROM documents UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.v AND reach.r < e.b)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY 1) c USING (doc_id)"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
i AS (SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + 9], ' ') AS body
        FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
ahead AS (SELECT doc_id, p, list(x) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ws FROM word),
hit AS (SELECT doc_id, p, win.n, item FROM (SELECT doc_id, p, n, array_to_string(ws[1:n], ' ') AS body FROM ahead, sizes WHERE len(ws) >= n) o JOIN win ON win.n = o.n AND win.body = o.body),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""


def _templates() -> str:
    """(template, licence, shingles, step, window, shingle) rows of the templates."""
    rows = []
    for number, (name, text) in enumerate(license_scan.TEMPLATES):
        words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        own = [" ".join(words[i : i + license_scan.WORDS]) for i in range(len(words) - license_scan.WORDS + 1)]
        s = license_scan.step_of(len(own))
        rows += [f"({number}, '{name}', {len(set(own))}, {s}, {len(own) + s - 1}, '{x}')" for x in sorted(set(own))]
    return ", ".join(rows)


# Windows of a template start at every s-th shingle; the best share of its shingles in one of them counts.
LICENSE_SCAN = rf"""
WITH t(piece, license, size, s, width, x) AS (VALUES {_templates()}),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS p FROM d),
sh AS (SELECT doc_id, p, array_to_string(list(x) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), ' ') AS x FROM word),
hit AS (SELECT doc_id, piece, license, size, x, unnest(generate_series(cast(greatest(ceil((p - width + 1) / s), 0) AS BIGINT), cast(floor(p / s) AS BIGINT))) AS q
        FROM sh JOIN t USING (x)),
best AS (SELECT doc_id, license, max(n / size) AS c FROM (SELECT doc_id, piece, license, size, q, count(DISTINCT x) AS n FROM hit GROUP BY ALL) GROUP BY 1, 2),
found AS (SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS l, max(c) AS c FROM best WHERE c >= 0.8 GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(l, '') AS licenses, coalesce(c, 0) AS containment FROM documents LEFT JOIN found USING (doc_id)"""


def _quality_rules() -> str:
    r = LineRules()
    end = r.sentence_end.replace("*+$", "*$").replace("'", "''")
    mark = r"[!-/:-@\[-`{-~]"
    line_fails = f"""
        (length(x) >= {r.judged_chars} AND length(x) - length(regexp_replace(x, '{mark}+', '', 'g')) > length(x) * {r.max_mark_share})
        OR (length(x) < {r.short_line_chars} AND len(regexp_extract_all(x, '{_SOLID}')) < {r.short_line_words} AND NOT regexp_matches(x, '{end}'))
        OR (length(x) - length(regexp_replace(x, '[|›»•·>]+', '', 'g')) >= {r.menu_separators}
            AND len(regexp_extract_all(x, '{_SOLID}')) <= (length(x) - length(regexp_replace(x, '[|›»•·>]+', '', 'g')) + 1) * {r.menu_words_per_separator})
        OR (length(x) <= {r.boilerplate_chars} AND regexp_matches(lower(x), '{BOILERPLATE}'))"""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SOLID}') AS w FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
g AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines,
             coalesce(sum(length(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (WHERE NOT ({line_fails})), 0) AS clean
      FROM l WHERE regexp_matches(x, '{_SOLID}') GROUP BY 1),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
ahead AS (SELECT doc_id, p, list(x) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {r.window - 1} FOLLOWING) AS ws FROM word),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, ws) AS n FROM ahead WHERE len(ws) = {r.window}) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(generate_series(p, p + {r.window - 1})) AS q FROM rep) GROUP BY 1),
v AS (SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(clean, 0) AS clean
      FROM d LEFT JOIN g USING (doc_id) LEFT JOIN cov USING (doc_id)),
j AS (SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND clean >= word_chars * (1 - {r.max_lost_share}) AS kept FROM j"""


# Weights from document counts, scores in whole numbers, the ten best of each item.
LEXICAL_SEARCH = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
c AS (SELECT count(*) AS docs, sum(len(w)) AS terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, doc_id, t, cast(count(*) AS BIGINT) AS tf, any_value(n) AS n FROM (SELECT r, doc_id, unnest(w) AS t, cast(len(w) AS BIGINT) AS n FROM d) GROUP BY r, doc_id, t),
df AS (SELECT t, cast(count(*) AS BIGINT) AS df FROM tf GROUP BY t),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT item_id, i, t, cast(count(*) AS BIGINT) AS times
      FROM (SELECT item_id, text AS i, unnest(regexp_extract_all({_LOWER}, '{_ALNUM}')) AS t FROM i) GROUP BY ALL),
w AS (SELECT item_id, i, t, times * cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN df USING (t), c),
s AS (SELECT item_id, i, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * cast(docs AS BIGINT)) // cast(terms AS BIGINT))))) AS BIGINT) AS score
      FROM w JOIN tf USING (t), c GROUP BY item_id, i, r, doc_id),
o AS (SELECT item_id, doc_id, score, cast(row_number() OVER (PARTITION BY item_id, i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10"""

# Every anchor against every row; best rows of its label, and for each the best of other labels in its window.
HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, e.vec_id AS b, a.label = e.label AS same, cast(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM e a, e WHERE a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b AS p, s.b AS n, p.score AS ps, s.score AS ns, cast(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT a AS anchor_id, p AS positive_id, rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE rank <= 5"""

ORACLES = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op2_jaccard_join": JACCARD_JOIN,
    "op6_decontaminate": DECONTAMINATE,
    "op9_license_scan": LICENSE_SCAN,
    "op10_quality_rules": _quality_rules(),
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_hard_negatives": HARD_NEGATIVES,
}
