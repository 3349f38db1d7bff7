"""DuckDB statements with the results of the core queries."""

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _clean(c: str) -> str:
    return f"lower(regexp_replace(regexp_replace(replace({c}, chr(10), ' '), '{WS}+', ' ', 'g'), '[^A-Za-z0-9 ]', '', 'g'))"


TOKENS = r"regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}_]+')"
TOKENS2 = r"regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}_]{{2,}}')"
PUBS = "pubs AS (SELECT DISTINCT uber_id, title FROM publications WHERE title IS NOT NULL)"
SECTIONS = "secs AS (SELECT DISTINCT section_id, sections FROM pdf_sections)"
EXACT = f"""{PUBS}, {SECTIONS},
ct AS (SELECT DISTINCT uber_id, {_clean('title')} AS c FROM pubs),
cs AS (SELECT section_id, {_clean('sections')} AS t FROM secs WHERE sections IS NOT NULL),
exact AS (SELECT DISTINCT section_id, uber_id, c AS matched_title FROM cs JOIN ct ON length(c) >= 40 AND contains(t, c)),
cites AS (SELECT uber_id, list_sort(list(DISTINCT section_id)) AS policies FROM exact GROUP BY uber_id)"""
TFIDF = f"""{PUBS},
pt AS (SELECT uber_id, max({TOKENS2.format(c='title')}) AS toks FROM pubs WHERE title <> '' GROUP BY uber_id),
qt AS (SELECT reference_id, max({TOKENS2.format(c='title')}) AS toks FROM structured_refs WHERE length(title) >= 1 GROUP BY reference_id),
pc AS (SELECT uber_id, t, count(*) AS tf FROM (SELECT uber_id, unnest(toks) AS t FROM pt) GROUP BY ALL),
qc AS (SELECT reference_id, t, count(*) AS tf FROM (SELECT reference_id, unnest(toks) AS t FROM qt) GROUP BY ALL),
idf AS (SELECT t, ln((1 + (SELECT count(*) FROM pt)) / (1 + count(*))) + 1 AS idf FROM pc GROUP BY t),
pw AS (SELECT uber_id, t, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY uber_id)) AS n FROM pc JOIN idf USING (t)),
qw AS (SELECT reference_id, t, tf * idf AS w, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY reference_id)) AS n FROM qc JOIN idf USING (t)),
sim AS (SELECT reference_id, uber_id, round(sum(q.w / q.n * (p.w / p.n)), 6) AS similarity FROM qw q JOIN pw p USING (t) GROUP BY ALL)"""
TOP = """rk AS (SELECT *, row_number() OVER (PARTITION BY reference_id ORDER BY similarity DESC, uber_id) AS rank FROM sim WHERE similarity > {least})"""
TOP1 = TFIDF + ", " + TOP.format(least=0.8) + ", top1 AS (SELECT reference_id, uber_id, similarity FROM rk WHERE rank = 1)"
POLICIES = f"""pol AS (SELECT DISTINCT article_id AS policy_id, title, organisation AS source_org, pub_year AS year, url FROM articles),
lex AS (SELECT *, {TOKENS.format(c='title')} AS w FROM pol)"""
LINES = "ln AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL), lines AS (SELECT *, CASE WHEN line_no = 0 THEN 24 WHEN text LIKE '%.' THEN 12 ELSE 16 END AS size FROM ln)"
HITS = """hit AS (SELECT doc, keyword, line_no, (length(lower(text)) - length(replace(lower(text), keyword, ''))) // length(keyword) AS hits FROM lines, (VALUES ('review'), ('harvest'), ('water'), ('records')) k(keyword)
WHERE contains(lower(text), keyword) AND regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])' || keyword || '([^\\p{L}\\p{N}_]|$)'))"""
SEC_LINES = f"{SECTIONS}, sl AS (SELECT section_id, unnest(string_split(sections, chr(10))) AS text, generate_subscripts(string_split(sections, chr(10)), 1) - 1 AS position FROM secs WHERE sections IS NOT NULL)"
CITED = """cited AS (SELECT * FROM (SELECT DISTINCT reference_id, organisation, title AS predicted, volume, pagination, pub_year AS ref_year FROM structured_refs) r
JOIN (SELECT DISTINCT uber_id, title AS actual, journal_volume AS volume, page_info AS pagination, pub_year FROM publications) p USING (volume, pagination))"""
SIMS = CITED + f""", s AS (SELECT reference_id, uber_id, length(predicted) AS chars, round(1 - levenshtein({_clean('predicted')}, {_clean('actual')}) / greatest(length({_clean('predicted')}), length({_clean('actual')}), 1), 6) AS sim,
coalesce(substring(ref_year, 1, 4), '') = coalesce(CAST(pub_year AS VARCHAR), '-') AS positive FROM cited WHERE predicted IS NOT NULL AND actual IS NOT NULL)"""
URL = r"'^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)'"


def _pdf(c: str) -> str:
    return f"coalesce({c} <> '' AND lower(regexp_extract({c}, {URL}, 1)) IN ('', 'http', 'https', 'ftp', 'ftps') AND lower(regexp_extract({c}, {URL}, 3)) LIKE '%.pdf' AND NOT (contains(regexp_extract({c}, {URL}, 2), '[') AND NOT contains(regexp_extract({c}, {URL}, 2), ']')), false)"


def _case(c: str) -> str:
    return f"CASE WHEN regexp_matches(substring(lower({c}), 1, 1), '[a-z]') THEN upper(substring(lower({c}), 1, 1)) ELSE substring(lower({c}), 1, 1) END || substring(lower({c}), 2)"


GRID = SIMS + """, g AS (SELECT so AS sim_over, lo AS len_over, sum(CASE WHEN sim > so AND chars > lo AND positive THEN 1 ELSE 0 END)::BIGINT AS tp, sum(CASE WHEN sim > so AND chars > lo AND NOT positive THEN 1 ELSE 0 END)::BIGINT AS fp,
sum(CASE WHEN NOT (sim > so AND chars > lo) AND positive THEN 1 ELSE 0 END)::BIGINT AS fn FROM s, (VALUES (0.5::DOUBLE), (0.6), (0.7), (0.8), (0.9)) a(so), (VALUES (20), (40), (60), (80)) b(lo) GROUP BY so, lo),
grid AS (SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall FROM g)"""

SQL = {
    "clean_text_titles": f"WITH {PUBS} SELECT uber_id, {_clean('title')} AS cleaned, length({_clean('title')}) AS chars FROM pubs",
    "exact_match_pairs": f"WITH {EXACT} SELECT * FROM exact",
    "exact_match_citations": f"WITH {EXACT} SELECT uber_id, min_by(matched_title, section_id) AS matched_title, count(*) AS associated_policies_count, array_to_string(list(section_id ORDER BY section_id), ',') AS policies FROM exact GROUP BY uber_id",
    "fuzzy_tfidf_top1": f"WITH {TOP1} SELECT * FROM top1",
    "fuzzy_tfidf_top10": f"WITH {TFIDF}, {TOP.format(least=0.6)} SELECT reference_id, uber_id, similarity, rank FROM rk WHERE rank <= 10",
    "bm25_min_should_match": f"""WITH {PUBS},
pt AS (SELECT uber_id, max({TOKENS.format(c='title')}) AS toks FROM pubs GROUP BY uber_id),
lt AS (SELECT reference_id, CASE WHEN length(title) > 512 THEN array_to_string(list_filter(regexp_split_to_array(substring(title, 1, 512), '{WS}+'), lambda x: x <> '')[:-2], ' ') ELSE title END AS title FROM structured_refs WHERE title IS NOT NULL),
qt AS (SELECT reference_id, max({TOKENS.format(c='title')}) AS toks FROM lt GROUP BY reference_id),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM pt WHERE len(toks) > 0),
pc AS (SELECT uber_id, t, dl, count(*) AS tf FROM (SELECT uber_id, len(toks) AS dl, unnest(toks) AS t FROM pt) GROUP BY ALL),
qc AS (SELECT reference_id, t, n, count(*) AS qf FROM (SELECT reference_id, len(toks) AS n, unnest(toks) AS t FROM qt) GROUP BY ALL),
idf AS (SELECT t, ln(1 + ((SELECT n FROM st) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM pc GROUP BY t),
sc AS (SELECT reference_id, uber_id, round(sum(qf * idf * 2.2 * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / (SELECT avgdl FROM st)))), 6) AS score, sum(qf) AS hit, any_value(q.n) AS n FROM qc q JOIN pc USING (t) JOIN idf USING (t) GROUP BY ALL)
SELECT reference_id, arg_max(uber_id, (score, -uber_id)) AS uber_id, max(score) AS score FROM sc WHERE hit >= greatest(floor(0.8 * n), 1) AND score > 50 GROUP BY reference_id""",
    "citations_fold": f"""WITH {TOP1}, m AS (SELECT t.*, r.document_id, r.title AS extracted_title FROM top1 t JOIN (SELECT DISTINCT reference_id, document_id, title FROM structured_refs) r USING (reference_id))
SELECT uber_id, first(reference_id ORDER BY reference_id, document_id, extracted_title) AS reference_id, first(extracted_title ORDER BY reference_id, document_id, extracted_title) AS extracted_title, first(similarity ORDER BY reference_id, document_id, extracted_title) AS similarity, count(*) AS associated_policies_count, array_to_string(list(document_id ORDER BY reference_id, document_id, extracted_title), ',') AS policies FROM m GROUP BY uber_id""",
    "search_policies_rank": f"""WITH {POLICIES}, h AS (SELECT policy_id, title, source_org, year, url, unnest(w) AS t, generate_subscripts(w, 1) AS pos FROM lex WHERE list_contains(w, 'study') AND list_contains(w, 'and')),
k AS (SELECT *, lead(t) OVER (PARTITION BY policy_id, title, source_org, year, url ORDER BY pos) AS nt, lead(pos) OVER (PARTITION BY policy_id, title, source_org, year, url ORDER BY pos) AS np FROM h WHERE t IN ('study', 'and'))
SELECT policy_id, title, source_org, year, round(sum(CASE WHEN nt <> t THEN 1.0 / (np - pos) ELSE 0 END), 6)::DOUBLE AS rank FROM k GROUP BY policy_id, title, source_org, year, url ORDER BY rank DESC, policy_id LIMIT 200""",
    "search_policies_year": f"WITH {POLICIES} SELECT policy_id, title, source_org, year FROM lex WHERE list_contains(w, 'study') ORDER BY year ASC NULLS LAST, policy_id LIMIT 25 OFFSET 25",
    "search_policies_count": f"WITH {POLICIES} SELECT count(policy_id) AS n FROM lex WHERE list_contains(w, 'workers') AND list_contains(w, 'health')",
    "websearch_or": f"WITH {POLICIES} SELECT policy_id FROM lex WHERE list_contains(w, 'diesel') OR list_contains(w, 'vaccination')",
    "websearch_not": f"WITH {POLICIES} SELECT policy_id FROM lex WHERE list_contains(w, 'study') AND NOT list_contains(w, 'health')",
    "websearch_phrase": f"WITH {POLICIES} SELECT policy_id FROM lex WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' modelling study ')",
    "search_citations_page": f"""WITH {EXACT}, p AS (SELECT DISTINCT uber_id, title, journal_title, pub_year FROM publications),
h AS (SELECT p.*, c.policies AS ps, len(c.policies) AS policies_count FROM p JOIN cites c USING (uber_id) WHERE list_contains(list_concat({TOKENS.format(c='title')}, {TOKENS.format(c='journal_title')}), 'of') AND list_contains(list_concat({TOKENS.format(c='title')}, {TOKENS.format(c='journal_title')}), 'and') ORDER BY policies_count DESC NULLS FIRST, uber_id LIMIT 50),
n AS (SELECT uber_id, array_to_string(list(section_id || ':' || coalesce(organisation, '') ORDER BY section_id, organisation), ',') AS policies FROM (SELECT DISTINCT uber_id, unnest(ps) AS section_id FROM h) JOIN (SELECT DISTINCT section_id, organisation FROM pdf_sections) USING (section_id) GROUP BY uber_id)
SELECT uber_id, title, policies_count, policies FROM h LEFT JOIN n USING (uber_id)""",
    "export_citations_flat": f"WITH {EXACT}, t AS (SELECT uber_id, min(title) AS title FROM pubs GROUP BY uber_id), x AS (SELECT uber_id, section_id AS policy_id, doc_id AS policy_doc FROM (SELECT DISTINCT uber_id, section_id FROM exact) JOIN (SELECT DISTINCT section_id, doc_id FROM pdf_sections) USING (section_id)) SELECT uber_id, title, policy_id::VARCHAR AS policy_id, policy_doc::VARCHAR AS policy_doc FROM t LEFT JOIN x USING (uber_id)",
    "export_citations_nested": f"WITH {EXACT}, t AS (SELECT uber_id, min(title) AS title FROM pubs GROUP BY uber_id) SELECT uber_id, title, '[' || array_to_string(policies, ',') || ']' AS policies FROM t LEFT JOIN cites USING (uber_id)",
    "legacy_field_or_search": "WITH a AS (SELECT DISTINCT article_id, title, organisation, types FROM articles) SELECT article_id FROM a WHERE " + " OR ".join(f"(list_contains({TOKENS.format(c=c)}, 'modelling') AND list_contains({TOKENS.format(c=c)}, 'study'))" for c in ("title", "organisation", "types")),
    "terms_set_search": f"WITH a AS (SELECT DISTINCT article_id, title, types FROM articles) SELECT article_id FROM a WHERE (list_contains({TOKENS.format(c='title')}, 'health') AND list_contains({TOKENS.format(c='title')}, 'workers')) OR list_contains({TOKENS.format(c='types')}, 'annual')",
    "keyword_in_context": f"WITH {LINES}, {HITS}, c AS (SELECT doc, line_no, md5(string_agg(text, chr(10)) OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS context_md5 FROM lines) SELECT doc, keyword, line_no, hits, context_md5 FROM hit JOIN c USING (doc, line_no)",
    "keyword_lines": f"WITH {LINES}, {HITS} SELECT doc, keyword, line_no FROM hit",
    "font_stats": f"WITH {LINES}, m AS (SELECT doc, ceil(sum(size) / greatest(count(*), 1))::BIGINT AS mean_size, array_to_string(list_sort(list(DISTINCT size)), ',') AS sizes FROM lines GROUP BY doc) SELECT doc, mean_size, coalesce(floor(avg(size) FILTER (size > mean_size)), 0)::BIGINT AS upper_mean_size, any_value(sizes) AS sizes FROM lines JOIN m USING (doc) GROUP BY doc, mean_size",
    "title_candidates": f"WITH {LINES}, r AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY size DESC, line_no) AS rank, text AS title FROM lines) SELECT * FROM r WHERE rank <= 3",
    "normalise_titles": "SELECT DISTINCT article_id, coalesce(nullif(title, ''), page_headings[1]) AS title, page_headings[1] AS heading FROM (SELECT DISTINCT article_id, title, page_title, page_headings FROM articles)",
    "publication_authors": "SELECT uber_id, array_to_string(list_transform(authors, lambda a: coalesce(a.lastname, 'Unknown') || ' ' || coalesce(a.initials, '?')), ', ') AS authors FROM (SELECT DISTINCT uber_id, authors FROM publications)",
    "pdf_url_valid": f"SELECT article_id, {_pdf('url')} AS url_is_pdf, {_pdf('source_page')} AS page_is_pdf, string_split(url, '/')[-1] AS filename FROM (SELECT DISTINCT article_id, url, source_page FROM articles)",
    "allowed_hosts": f"WITH h AS (SELECT lower(regexp_extract(url, {URL}, 2)) AS host FROM (SELECT DISTINCT article_id, url FROM articles)) SELECT host, count(*) AS n FROM h WHERE coalesce(host, '') NOT IN ('docs.kretimport.example', 'docs.haertkramia.example') GROUP BY host",
    "dedupe_urls": "SELECT DISTINCT regexp_extract(source_page, '^([^?#]*)', 1) AS url FROM articles WHERE source_page IS NOT NULL",
    "manifest_upsert": "SELECT file_hash, arg_max(article_id, (date_scraped, article_id)) AS article_id, arg_max(struct_pack(t := title), (date_scraped, article_id)).t AS title FROM articles WHERE file_hash <> '' GROUP BY file_hash",
    "manifest_buckets": "SELECT substring(file_hash, 1, 2) AS prefix, array_to_string(list_sort(list(DISTINCT file_hash)), ',') AS hashes FROM articles WHERE file_hash <> '' GROUP BY 1",
    "reload_organisation": "WITH a AS (SELECT DISTINCT article_id, organisation, CASE WHEN organisation = 'kretimport_evidence_centre' THEN upper(title) ELSE title END AS title FROM (SELECT DISTINCT article_id, organisation, title FROM articles)) SELECT organisation, count(*) AS n, sum((title = upper(title))::BIGINT)::BIGINT AS upper_titles FROM a GROUP BY organisation",
    "rate_limit_trailing": "WITH c AS (SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id, event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS calls FROM events) SELECT * FROM c WHERE calls >= 2",
    "rate_limit_windowed": "SELECT (epoch_us(ts) // 3600000000 * 3600)::BIGINT AS window_start, user_id, event_type, count(*) AS calls FROM events WHERE ts IS NOT NULL GROUP BY ALL",
    "json_roundtrip": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, '{\"k\":' || json_extract(props, '$.k')::BIGINT || '}' AS props FROM events",
    "eval_levenshtein": f"WITH {CITED}, x AS (SELECT organisation, levenshtein({_clean('predicted')}, {_clean('actual')}) / greatest(length({_clean('predicted')}), length({_clean('actual')}), 1) AS share FROM cited WHERE predicted IS NOT NULL AND actual IS NOT NULL) SELECT organisation, count(*) AS n, round(avg(share), 6) AS mean, round(avg((share = 0)::INT), 6) AS strict, round(avg((share < 0.2)::INT), 6) AS lenient FROM x GROUP BY organisation",
    "eval_split_counts": f"WITH {SEC_LINES}, n AS (SELECT section_id, count(*) AS predicted FROM sl WHERE regexp_matches(text, '^[0-9]+\\. ') GROUP BY section_id), a AS (SELECT document_id AS doc_id, count(DISTINCT reference_id) AS actual FROM structured_refs GROUP BY document_id), x AS (SELECT organisation, abs(100.0::DOUBLE * (predicted - actual) / CASE WHEN actual = 0 THEN 1 ELSE actual END) AS off FROM (SELECT DISTINCT section_id, doc_id, organisation FROM pdf_sections) JOIN n USING (section_id) JOIN a USING (doc_id)) SELECT organisation, round(median(off), 6) AS median_off, round(avg((off <= 50)::INT), 6) AS within_half FROM x GROUP BY organisation",
    "similarity_percentiles": f"WITH {SIMS} SELECT positive, round(quantile_cont(sim, 0.01), 6) AS p01, round(quantile_cont(sim, 0.05), 6) AS p05, round(quantile_cont(sim, 0.95), 6) AS p95, round(quantile_cont(sim, 0.99), 6) AS p99 FROM s GROUP BY positive",
    "similarity_histogram": f"WITH {SIMS} SELECT least(floor(sim * 20), 19)::BIGINT AS bin, positive, count(*) AS n FROM s GROUP BY ALL",
    "threshold_grid": f"WITH {GRID} SELECT * FROM grid",
    "threshold_pivot": f"WITH {GRID} SELECT sim_over, max(CASE WHEN len_over = 20 THEN recall END) AS len_20, max(CASE WHEN len_over = 40 THEN recall END) AS len_40, max(CASE WHEN len_over = 60 THEN recall END) AS len_60, max(CASE WHEN len_over = 80 THEN recall END) AS len_80 FROM grid GROUP BY sim_over",
    "match_outcomes": f"WITH {TOP1}, {CITED}, e AS (SELECT reference_id, min(uber_id) AS actual FROM cited GROUP BY reference_id), x AS (SELECT actual, top1.uber_id AS predicted FROM (SELECT DISTINCT reference_id FROM structured_refs) LEFT JOIN e USING (reference_id) LEFT JOIN top1 USING (reference_id)) SELECT CASE WHEN actual = predicted THEN 'Correct match' WHEN actual IS NOT NULL AND predicted IS NOT NULL THEN 'Incorrect match' WHEN actual IS NOT NULL THEN 'No match, expected one' WHEN predicted IS NOT NULL THEN 'Match, expected none' ELSE 'No match, expected none' END AS outcome, count(*) AS n FROM x GROUP BY 1",
    "gold_pair_eval": f"WITH {TOP1}, {CITED}, g AS (SELECT DISTINCT reference_id, uber_id FROM cited), f AS (SELECT DISTINCT reference_id, uber_id FROM top1), c AS (SELECT (SELECT count(*) FROM g JOIN f USING (reference_id, uber_id)) AS b, (SELECT count(*) FROM g) AS ng, (SELECT count(*) FROM f) AS nf) SELECT b AS both, nf - b AS only_found, ng - b AS only_gold, round(coalesce(b / nullif(nf, 0), 0), 6) AS precision, round(coalesce(b / nullif(ng, 0), 0), 6) AS recall, round(coalesce(2 * b / nullif(nf + ng, 0), 0), 6) AS f1 FROM c",
    "merge_results": f"""WITH {TOP1}, {EXACT.replace(PUBS + ', ', '')},
b AS (SELECT document_id AS doc_id, uber_id, similarity, 'Fuzzy match' AS algorithm FROM top1 JOIN (SELECT DISTINCT reference_id, document_id FROM structured_refs) USING (reference_id)
UNION ALL SELECT doc_id, uber_id, NULL, 'Exact match' FROM exact JOIN (SELECT DISTINCT section_id, doc_id FROM pdf_sections) USING (section_id)),
t AS (SELECT uber_id, min(title) AS title FROM pubs GROUP BY uber_id)
SELECT algorithm, b.doc_id, b.uber_id, url, title, count(*) AS n, round(max(similarity), 6) AS similarity FROM b LEFT JOIN documents d ON d.doc_id = b.doc_id LEFT JOIN t ON t.uber_id = b.uber_id GROUP BY ALL""",
    "sample_halves": "WITH h AS (SELECT reference_id, row_number() OVER (ORDER BY md5('seed-0-' || reference_id), reference_id) AS r FROM (SELECT DISTINCT reference_id FROM structured_refs)) SELECT reference_id, CASE WHEN r <= 100 THEN 'positive' ELSE 'negative' END AS half FROM h WHERE r <= 200",
}
