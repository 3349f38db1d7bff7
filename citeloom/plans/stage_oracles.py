"""DuckDB statements with the results of the stage queries."""

from .oracles import CITED, EXACT, LINES, POLICIES, PUBS, SECTIONS, SIMS, TFIDF, TOKENS, TOP1, _case, _clean, _pdf

CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
PAGED = LINES.replace("text, chr(10)", f"regexp_replace(text, '{CONTROL}', '', 'g'), chr(10)") + ", pl AS (SELECT *, line_no // 40 + 1 AS page FROM lines), pt AS (SELECT doc, page, string_agg(text, chr(10) ORDER BY line_no) || chr(10) AS t FROM pl GROUP BY ALL)"
# A reference starts at a number with a full stop or bracket at a line's start.
SPLIT = SECTIONS + r""", sx AS (SELECT section_id, replace(replace(regexp_replace(replace(sections, chr(10), chr(10) || chr(2)), '\x02([\s\x02]*\[?\d+[.\])]\s)', chr(1) || '\1', 'g'), chr(2), ''), chr(10), ' ') AS f FROM secs WHERE sections IS NOT NULL),
sr AS (SELECT section_id, list_filter(list_transform(string_split(f, chr(1)), lambda x: trim(regexp_replace(x, '^\s*\[?\d+[.\])]\s+', ''))), lambda x: length(x) >= 20) AS refs FROM sx),
sp AS (SELECT section_id, unnest(refs) AS reference, generate_subscripts(refs, 1) - 1 AS position FROM sr),
tk AS (SELECT *, list_filter(regexp_split_to_array(reference, '\s+'), lambda w: w <> '') AS w, len(regexp_split_to_array(substring(reference, 1, instr(reference, '. ')), '\s+')) AS a FROM sp),
tl AS (SELECT section_id, position, reference, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS i, a FROM tk),
lb AS (SELECT *, CASE WHEN regexp_matches(token, '^\(?(18|19|20)\d\d[a-z]?[).,;:]?') THEN 'year' WHEN a > i THEN 'author' ELSE 'title' END AS label FROM tl),
stru AS (SELECT section_id, position, reference, coalesce(string_agg(token, ' ' ORDER BY i) FILTER (label = 'author'), '') AS "Authors", coalesce(string_agg(token, ' ' ORDER BY i) FILTER (label = 'title'), '') AS "Title", coalesce(string_agg(token, ' ' ORDER BY i) FILTER (label = 'year'), '') AS "PubYear" FROM lb GROUP BY ALL)"""
SITE = r"""ar AS (SELECT DISTINCT article_id, title, pub_year, url AS pdf FROM articles WHERE title IS NOT NULL AND url IS NOT NULL),
st AS (SELECT *, ['who_iris', 'nice', 'gov_uk', 'msf', 'parliament', 'unicef', 'acme'][article_id % 7 + 1] AS site, trim(regexp_replace(title, '[^A-Za-z0-9 ,.:?-]', '', 'g')) AS t, coalesce(substring(pub_year, 1, 4), '') AS y FROM ar WHERE trim(regexp_replace(title, '[^A-Za-z0-9 ,.:?-]', '', 'g')) <> ''),
pg AS (SELECT DISTINCT 'https://pages.example/' || site || '/' || article_id AS url, article_id, site, t, y, pdf FROM st)"""
SUBJECT = r"""lab AS (SELECT doc_id, min(subject) AS actual FROM subject_labels WHERE subject IS NOT NULL GROUP BY doc_id),
wd AS (SELECT subject, unnest(list_distinct(regexp_extract_all(lower(coalesce(description, '')), '[\p{L}]{4,}'))) AS w FROM subject_areas),
td AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]{4,}'))) AS w FROM documents JOIN lab USING (doc_id)),
hs AS (SELECT doc_id, subject, count(*) AS n FROM td JOIN wd USING (w) GROUP BY ALL),
bs AS (SELECT doc_id, first(subject ORDER BY n DESC, subject) AS predicted FROM hs GROUP BY doc_id),
j AS (SELECT doc_id, source, actual, predicted FROM documents JOIN lab USING (doc_id) LEFT JOIN bs USING (doc_id))"""
RATIO = "round(coalesce({} / nullif({}, 0), 0), 6)"

STAGE_SQL = {
    "scan_json_lines": "SELECT reference_id, title, pub_year FROM structured_refs",
    "scan_csv": "SELECT uber_id, title, journal_title FROM publications",
    "scan_match_tables": f"WITH {TOP1}, {EXACT.replace(PUBS + ', ', '').replace(PUBS + ',' + chr(10), '')}, e AS (SELECT DISTINCT uber_id, section_id FROM exact) SELECT 'exact' AS algorithm, count(*) AS n, count(DISTINCT uber_id) AS publications FROM e HAVING count(*) > 0 UNION ALL SELECT 'fuzzy', count(*), count(DISTINCT uber_id) FROM top1 HAVING count(*) > 0",
    "first_row_of_files": "SELECT pub_type, min(uber_id) AS uber_id FROM publications WHERE pub_type IS NOT NULL GROUP BY pub_type",
    "scan_manifest": "WITH m AS (SELECT file_hash, arg_max(struct_pack(t := title, u := url), (date_scraped, article_id)) AS r FROM articles WHERE file_hash <> '' AND organisation IS NOT NULL GROUP BY file_hash) SELECT substring(file_hash, 1, 2) AS prefix, file_hash, 'docs/pdf/' || substring(file_hash, 1, 2) || '/' || file_hash || '.pdf' AS key, r.t AS title, r.u AS url FROM m",
    "scan_first_lines": "WITH p AS (SELECT *, row_number() OVER (ORDER BY uber_id, title NULLS FIRST, pmid NULLS FIRST) - 1 AS line_no FROM (SELECT DISTINCT uber_id, title, pmid FROM publications)) SELECT line_no, uber_id FROM p WHERE line_no < 400 AND title IS NOT NULL AND pmid IS NOT NULL",
    "stored_table_life": "SELECT false AS existed, true AS exists, count(*) FILTER (uber_id IS NOT NULL) AS written, count(*) FILTER (uber_id IS NOT NULL) AS stored, count(*) FILTER (uber_id IS NOT NULL AND NOT coalesce(pub_year < 2000, false)) AS kept, 'pub_type,pub_year,uber_id' AS columns FROM publications",
    "indexed_records": """SELECT 'index-metadata-test' AS "index", uber_id, '{"uber_id":' || uber_id || ',"pmid":' || coalesce('"' || pmid || '"', 'null') || ',"doi":' || coalesce('"' || doi || '"', 'null') || '}' AS doc FROM publications""",
    "nested_delete": f"WITH {EXACT}, o AS (SELECT DISTINCT section_id, organisation FROM pdf_sections), x AS (SELECT uber_id, o.section_id, organisation FROM (SELECT DISTINCT uber_id, section_id FROM exact) JOIN o USING (section_id)) SELECT uber_id, count(*) AS n FROM x GROUP BY uber_id HAVING NOT coalesce(bool_or(organisation = 'kretimport_evidence_centre'), false)",
    "export_policies_ranked": f"""WITH {POLICIES}, h AS (SELECT policy_id, title, source_org, year, url, unnest(w) AS t, generate_subscripts(w, 1) AS pos FROM lex WHERE list_contains(w, 'study') AND list_contains(w, 'health')),
k AS (SELECT *, lead(t) OVER (PARTITION BY policy_id, title, source_org, year, url ORDER BY pos) AS nt, lead(pos) OVER (PARTITION BY policy_id, title, source_org, year, url ORDER BY pos) AS np FROM h WHERE t IN ('study', 'health'))
SELECT policy_id, source_org, round(sum(CASE WHEN nt <> t THEN 1.0 / (np - pos) ELSE 0 END), 6)::DOUBLE AS rank FROM k GROUP BY policy_id, title, source_org, year, url""",
    "split_references": f"WITH {SPLIT} SELECT section_id, position, reference, len(w) AS tokens FROM tk",
    "structured_references": f"WITH {SPLIT} SELECT section_id, position, \"Authors\", \"Title\", \"PubYear\" FROM stru",
    "stored_references": "WITH r AS (SELECT DISTINCT reference_id, title, authors, journal, volume, issue, pagination, pub_year FROM structured_refs) SELECT reference_id, substring(title, 1, 1024) AS title, substring(authors, 1, 256) AS authors, substring(journal, 1, 256) AS journal, substring(pagination, 1, 256) AS pagination, CASE WHEN regexp_matches(pub_year, '^\\s*[+-]?\\d+\\s*$') THEN try_cast(pub_year AS INTEGER)::VARCHAR END AS year FROM r",
    "section_rows": "SELECT section_id, coalesce(keyword, '') AS keyword, md5(sections) AS section_md5 FROM (SELECT DISTINCT section_id, keyword, sections FROM pdf_sections) WHERE sections <> ''",
    "normalised_documents": """WITH a AS (SELECT DISTINCT article_id, file_hash, title, pub_year, url, source_page, page_headings, authors, subjects, types, page_title FROM articles),
n AS (SELECT coalesce(nullif(title, ''), page_title, page_headings[1]) AS title, count(*) AS documents FROM a GROUP BY 1),
t AS (SELECT coalesce(nullif(page_title, ''), nullif(title, '')) AS title, count(*) AS text_documents FROM a WHERE page_title <> '' GROUP BY 1)
SELECT coalesce(n.title, t.title) AS title, coalesce(documents, 0)::BIGINT AS documents, coalesce(text_documents, 0)::BIGINT AS text_documents FROM n FULL JOIN t ON n.title = t.title""",
    "pdf_pages": f"WITH {PAGED} SELECT doc, page, md5(coalesce(string_agg(text, chr(10) ORDER BY line_no) FILTER (NOT regexp_matches(text, '^\\p{{Nd}}+$')), '') || chr(10)) AS text_md5 FROM pl GROUP BY ALL",
    "document_full_text": f"SELECT doc_id AS doc, md5(regexp_replace(text, '{CONTROL}', '', 'g')) AS text_md5 FROM documents WHERE text IS NOT NULL",
    "pdf_font_stats": f"WITH {PAGED}, m AS (SELECT doc, ceil(sum(size) / greatest(count(*), 1))::BIGINT AS mean_size, array_to_string(list_sort(list(DISTINCT size)), ',') AS sizes FROM lines GROUP BY doc) SELECT doc, mean_size, coalesce(floor(avg(size) FILTER (size > mean_size)), 0)::BIGINT AS upper_mean_size, any_value(sizes) AS sizes FROM lines JOIN m USING (doc) GROUP BY doc, mean_size",
    "pdf_lines_by_size": f"WITH {PAGED} SELECT doc, count(*) AS n, min(line_no) AS first_line, 0 AS bold FROM pl WHERE size = 16 GROUP BY doc",
    "keyword_by_page": f"""WITH {PAGED}, c AS (SELECT *, string_agg(text, chr(10)) OVER (PARTITION BY doc, page ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS ctx, regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}_])harvest([^\\p{{L}}\\p{{N}}_]|$)') AS hit FROM pl)
SELECT 'hit' AS kind, doc, page, line_no, md5(text) AS context_md5 FROM c WHERE hit UNION ALL SELECT 'last', doc, page, line_no, md5(ctx) FROM (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY line_no DESC) AS r FROM c WHERE hit) WHERE r = 1""",
    "keyword_dict": f"""WITH {PAGED}, c AS (SELECT *, string_agg(text, chr(10)) OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS ctx FROM pl),
h AS (SELECT doc, k, line_no, ctx FROM c, (VALUES ('harvest'), ('water')) v(k) WHERE regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])' || k || '([^\\p{{L}}\\p{{N}}_]|$)'))
SELECT doc, md5(string_agg(ctx, '|' ORDER BY line_no) FILTER (k = 'harvest')) AS harvest, md5(string_agg(ctx, '|' ORDER BY line_no) FILTER (k = 'water')) AS water FROM h GROUP BY doc""",
    "grab_sections": f"""WITH {PAGED}, m AS (SELECT doc, ceil(sum(size) / count(*)) AS mean FROM lines GROUP BY doc), u AS (SELECT doc, mean, coalesce(floor(avg(size) FILTER (size > mean)), 0) AS upper FROM lines JOIN m USING (doc) GROUP BY doc, mean),
ch AS (SELECT doc, max(size) AS ts FROM lines JOIN u USING (doc) WHERE (size > mean + 1 OR size > upper + 2) AND regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_]+)review[a-z]*([^\\p{{L}}\\p{{N}}_]+|$)') GROUP BY doc),
hd AS (SELECT doc, line_no, page, text, lead(text) OVER w AS et, lead(page) OVER w AS ep FROM pl JOIN ch USING (doc) WHERE size = ts AND trim(text) <> '' WINDOW w AS (PARTITION BY doc ORDER BY line_no)),
bo AS (SELECT h.doc, h.line_no, h.text AS x, h.et, string_agg(pt.t, '' ORDER BY pt.page) AS body FROM hd h JOIN pt ON pt.doc = h.doc AND pt.page >= h.page AND (h.ep IS NULL OR pt.page < CASE WHEN h.ep = h.page THEN h.ep + 1 ELSE h.ep END) WHERE contains(lower(h.text), 'review') GROUP BY ALL),
pa AS (SELECT doc, line_no, substring(body, s, greatest(e - s + 1, 0)) AS part FROM (SELECT *, greatest(strpos(body, x), 1) AS s, CASE WHEN et IS NULL THEN length(body) WHEN strpos(body, et) > 0 THEN strpos(body, et) - 1 ELSE length(body) - 1 END AS e FROM bo)),
se AS (SELECT doc, string_agg(part, '' ORDER BY line_no) AS section FROM pa GROUP BY doc)
SELECT doc, md5(section) AS section_md5, length(section) AS chars FROM se WHERE section <> ''""",
    "pdf_metadata": "SELECT uber_id, trim(coalesce(title, '')) AS title, trim(coalesce(journal_title, '')) AS creator, 'Mon: 1' AS created, false AS has_pages, coalesce(uuid, '') AS did FROM (SELECT DISTINCT uber_id, title, uuid, journal_title FROM publications)",
    "site_files": f"WITH {SITE} SELECT url AS source_page, site, pdf, t AS title, CASE WHEN site IN ('nice') THEN CASE WHEN y = '' THEN '-05-' ELSE y END WHEN site = 'parliament' THEN right(trim('01 May ' || y), 4) END AS year, CASE WHEN site = 'parliament' THEN 'Report' END AS types, t || ' | site' AS page_title FROM pg WHERE site IN ('who_iris', 'nice', 'acme') OR {_pdf('pdf')}",
    "site_requests": f"""WITH {SITE} SELECT 'https://pages.example/parliament/list-' || article_id AS url, site, 'article' AS kind, 'https://pages.example/parliament/' || article_id AS href, t AS title, right(trim('01 May ' || y), 4) AS year, 'Report' AS types FROM pg WHERE site = 'parliament'
UNION SELECT 'https://pages.example/parliament/list-' || article_id, site, 'next', 'https://pages.example/parliament/list-' || article_id || '?page=2', NULL, NULL, NULL FROM pg WHERE site = 'parliament'
UNION SELECT 'https://pages.example/nice/list-' || article_id, site, 'next', 'https://pages.example/p2', NULL, NULL, NULL FROM pg WHERE site = 'nice'
UNION SELECT 'https://pages.example/nice/list-' || article_id, site, k, 'https://pages.example/guidance/' || article_id || x, NULL, NULL, NULL FROM pg, (VALUES ('article', ''), ('related', '/evidence'), ('related', '/history')) v(k, x) WHERE site = 'nice'""",
    "page_titles": f"""WITH {SITE} SELECT url, t || ' | site' AS page_title, CASE WHEN site IN ('nice', 'gov_uk', 'unicef') THEN 1 ELSE 0 END AS headings, CASE WHEN {_pdf('pdf')} THEN 1 ELSE 0 END + CASE WHEN site = 'gov_uk' THEN 1 ELSE 0 END AS pdfs FROM pg
UNION ALL SELECT 'https://pages.example/parliament/list-' || article_id, NULL, 0, 0 FROM pg WHERE site = 'parliament' UNION ALL SELECT 'https://pages.example/nice/list-' || article_id, NULL, 0, 0 FROM pg WHERE site = 'nice'""",
    "who_articles": f"WITH {SITE} SELECT url, t AS title, CASE WHEN {_pdf('pdf')} THEN pdf END AS pdf, 'Air' AS subjects FROM pg WHERE site = 'who_iris'",
    "new_files": "WITH a AS (SELECT DISTINCT article_id, file_hash, pdf, date_scraped FROM articles) SELECT article_id, file_hash, 'docs/pdf/' || substring(file_hash, 1, 2) || '/' || file_hash || '.pdf' AS key FROM a WHERE date_scraped >= TIMESTAMP '2020-01-01' AND pdf <> '' AND (file_hash IS NULL OR file_hash NOT IN (SELECT file_hash FROM a WHERE date_scraped < TIMESTAMP '2020-01-01' AND file_hash IS NOT NULL))",
    "response_kinds": f"""SELECT article_id, CASE article_id % 4 WHEN 0 THEN true WHEN 1 THEN {_pdf('url')} ELSE false END AS is_pdf, ['http', 'dns', 'timeout', 'robots', 'other', 'other'][article_id % 6 + 1] AS failure, url_filename AS title FROM (SELECT DISTINCT article_id, url, url_filename FROM articles)""",
    "storage_locations": """SELECT article_id, CASE WHEN article_id % 3 < 2 AND file_hash IS NOT NULL THEN 'bucket' END AS bucket, CASE WHEN article_id % 3 < 2 THEN 'docs/pdf/' || substring(file_hash, 1, 2) || '/' || file_hash || '.pdf' END AS key, CASE WHEN contains(url_filename, '.') THEN regexp_replace(url_filename, '^([^.]*)\\.', '\\1_2020-01-31.') ELSE url_filename || '_2020-01-31' END AS stamped, md5(url_filename) AS digest FROM (SELECT DISTINCT article_id, file_hash, url_filename FROM articles)""",
    "search_citations_count": f"WITH {EXACT} SELECT count(*) AS n FROM (SELECT DISTINCT uber_id, title, journal_title FROM publications) p JOIN cites c USING (uber_id) WHERE list_contains(list_concat({TOKENS.format(c='title')}, {TOKENS.format(c='journal_title')}), 'of') AND list_contains(list_concat({TOKENS.format(c='title')}, {TOKENS.format(c='journal_title')}), 'and')",
    "search_response": f"WITH {POLICIES}, h AS (SELECT policy_id, title FROM lex WHERE list_contains(w, 'study')), p AS (SELECT policy_id FROM h ORDER BY title, policy_id LIMIT 10) SELECT 'page' AS request, 'success' AS status, NULL AS message, (SELECT count(*) FROM h) AS n, (SELECT string_agg(h.policy_id, ',' ORDER BY h.title, h.policy_id) FROM (SELECT policy_id, title FROM h ORDER BY title, policy_id LIMIT 10) h) AS ids UNION ALL SELECT 'sort', 'error', 'Invalid ordering operation', 0, '' UNION ALL SELECT 'empty', 'error', 'No search terms', 0, ''",
    "legacy_search_page": "WITH a AS (SELECT DISTINCT article_id, title, organisation, types FROM articles), h AS (SELECT * FROM a WHERE " + " OR ".join(f"list_contains({TOKENS.format(c=c)}, 'study')" for c in ("title", "organisation", "types")) + ") SELECT article_id, title, (SELECT count(DISTINCT article_id) FROM h) AS matches FROM h ORDER BY title NULLS LAST, article_id, types NULLS FIRST LIMIT 25 OFFSET 25",
    "display_rows": f"""WITH a AS (SELECT DISTINCT article_id, title, pub_year, url, organisation FROM articles WHERE url IS NOT NULL)
SELECT article_id, CASE WHEN title IS NULL THEN 'Title unavailable' WHEN length(title) > 140 THEN {_case('substring(title, 1, 140)')} || '...' ELSE {_case('title')} END AS title, coalesce(pub_year, 'Unknown') AS year, ['WHO', 'NICE', NULL][article_id % 3 + 1] AS org,
'Showing ' || (article_id % 9 * 25 + 1) || ' - ' || least(article_id % 9 * 25 + 25, 210) || ' of 210' AS shown,
['1 2 3 0 9', '1 2 3 4 0 9', '1 2 3 4 5 0 9', '1 2 3 4 5 6 0 9', '1 0 3 4 5 6 7 0 9', '1 0 4 5 6 7 8 9', '1 0 5 6 7 8 9', '1 0 6 7 8 9', '1 0 7 8 9'][article_id % 9 + 1] AS pages FROM a""",
    "publication_display": "SELECT uber_id, array_to_string(list_transform(authors, lambda a: concat_ws('. ', a.initials, a.lastname)), ' ') AS authors, regexp_replace(strftime(modified AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '') AS modified FROM (SELECT DISTINCT uber_id, authors, modified FROM publications)",
    "contact_forms": "SELECT contributor_id, coalesce(trim(affiliation) <> '', false) AND coalesce(trim(coalesce(lastname, authors)) <> '', false) AND contributor_id % 3 <> 0 AND coalesce(lastname, '') <> '' AND NOT contains(coalesce(lastname, ''), '@') AS valid FROM (SELECT DISTINCT contributor_id, lastname, affiliation, authors FROM contributors)",
    "author_words": "WITH r AS (SELECT DISTINCT reference_id, authors FROM structured_refs WHERE authors IS NOT NULL), w AS (SELECT reference_id, list_filter(flatten(list_transform(string_split(authors, ','), lambda x: string_split(x, ' '))), lambda x: x <> '') AS w FROM r) SELECT reference_id, len(w) AS n, array_to_string(w, '|') AS words FROM w",
    "eval_confusion": f"WITH {SUBJECT} SELECT actual, predicted, count(*) AS n FROM j GROUP BY ALL",
    "eval_report": f"WITH {SUBJECT}, k AS (SELECT * FROM j WHERE predicted IS NOT NULL), l AS (SELECT actual AS label FROM k UNION SELECT predicted FROM k), c AS (SELECT label, (SELECT count(*) FROM k WHERE actual = label AND predicted = label) AS tp, (SELECT count(*) FROM k WHERE predicted = label) AS f, (SELECT count(*) FROM k WHERE actual = label) AS support FROM l) SELECT label, {RATIO.format('tp', 'f')} AS precision, {RATIO.format('tp', 'support')} AS recall, round(2.0::DOUBLE * tp / (f + support), 6) AS f1, support FROM c",
    "eval_by_source": f"WITH {SUBJECT} SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, count(DISTINCT doc_id) AS items, count(DISTINCT CASE WHEN actual <> '' THEN doc_id END) AS with_actual, round(count(DISTINCT CASE WHEN actual <> '' THEN doc_id END) / count(DISTINCT doc_id), 6) AS share, round(avg((actual = predicted)::INT), 6) AS f1 FROM j WHERE source IS NOT NULL GROUP BY ROLLUP (source)",
    "eval_by_source_and_subject": f"WITH {SUBJECT} SELECT source, actual AS label, count(DISTINCT doc_id) AS items, count(DISTINCT CASE WHEN actual <> '' THEN doc_id END) AS with_actual, round(count(DISTINCT CASE WHEN actual <> '' THEN doc_id END) / count(DISTINCT doc_id), 6) AS share, round(avg((actual = predicted)::INT), 6) AS f1 FROM j WHERE source IS NOT NULL GROUP BY ALL",
    "eval_columns": f"""WITH {CITED}, x AS (SELECT 'title' AS component, coalesce({_clean('actual')}, '') AS a, coalesce({_clean('predicted')}, '') AS p FROM cited UNION ALL SELECT 'year', coalesce(pub_year::VARCHAR, ''), coalesce(ref_year, '') FROM cited),
y AS (SELECT *, CASE WHEN a = '' OR p = '' THEN 0.0::DOUBLE ELSE levenshtein(a, p) / greatest(length(a), length(p)) END AS d FROM x)
SELECT CASE WHEN grouping(component) = 1 THEN 'all' ELSE component END AS component, count(*) AS n, sum((a <> '')::BIGINT)::BIGINT AS filled, round_even(avg((a = p)::INT), 3) AS strict, round_even(avg((d < 0.2)::INT), 3) AS lenient, round_even(avg(d), 3) AS distance FROM y GROUP BY ROLLUP (component)""",
    "eval_split_total": f"WITH {SPLIT}, p AS (SELECT section_id, count(*) AS predicted FROM sp GROUP BY section_id), l AS (SELECT section_id, unnest(string_split(sections, chr(10))) AS t FROM secs), n AS (SELECT section_id, count(*) AS actual FROM l WHERE regexp_matches(t, '^\\[?[0-9]+[.\\])] ') GROUP BY section_id), x AS (SELECT organisation, abs(100.0::DOUBLE * (predicted - actual) / actual) AS off FROM (SELECT DISTINCT section_id, organisation FROM pdf_sections WHERE organisation IS NOT NULL) JOIN p USING (section_id) JOIN n USING (section_id)) SELECT CASE WHEN grouping(organisation) = 1 THEN 'all' ELSE organisation END AS organisation, round_even(median(off), 3) AS median_off, count(*) AS n FROM x GROUP BY ROLLUP (organisation)",
    "eval_binary": f"WITH {SIMS}, y AS (SELECT positive AS a, sim > 0.7 AND chars > 40 AS p FROM s) SELECT round_even(coalesce(count(*) FILTER (NOT a AND NOT p) / nullif(count(*) FILTER (NOT a), 0), 0), 3) AS negative_recall, round_even(coalesce(count(*) FILTER (a AND p) / nullif(count(*) FILTER (p), 0), 0), 3) AS positive_precision, round_even(count(*) FILTER (a = p) / count(*), 3) AS f1 FROM y",
    "file_comparison": f"WITH {CITED} SELECT reference_id, uber_id, length(a) AS actual_chars, length(p) AS predicted_chars, round_even(CASE WHEN a = '' OR p = '' THEN 0.0::DOUBLE ELSE levenshtein(a, p) / greatest(length(a), length(p)) END, 2) AS distance FROM (SELECT *, {_clean('actual')} AS a, {_clean('predicted')} AS p FROM cited) WHERE organisation = 'kretimport_evidence_centre' AND actual IS NOT NULL AND predicted IS NOT NULL",
    "unmatched_publications": f"WITH {TOP1} SELECT DISTINCT uber_id FROM pubs WHERE uber_id NOT IN (SELECT uber_id FROM top1)",
    "organisation_numbers": "WITH o AS (SELECT organisation, min(date_scraped) AS since FROM articles WHERE organisation IS NOT NULL GROUP BY organisation), k AS (SELECT organisation, coalesce(since < TIMESTAMP '2012-01-01', false) AS early FROM o) SELECT organisation, row_number() OVER (ORDER BY NOT early, organisation) AS number FROM k",
    "zipped_predictions": f"WITH {SPLIT} SELECT section_id, position, md5(reference) AS reference_md5, \"PubYear\" AS year FROM stru",
}
