"""The queries that SQL can express, as DuckDB runs them over the same tables."""

_GAP = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

_OP3 = r"""
WITH urls AS (
    SELECT page_id,
           CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM urls
), outcomes AS (
    SELECT doc_id, count(*) AS n, sum(quality) AS k FROM labels
    WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id
), per_host AS (
    SELECT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS labels,
           coalesce(sum(n), 0) AS n, coalesce(sum(k), 0) AS k
    FROM parts LEFT JOIN outcomes ON page_id = doc_id GROUP BY host
), shaped AS (
    SELECT *, len(labels) < 2 OR regexp_matches(array_to_string(labels, '.'), '^[0-9.]*$') AS whole,
           coalesce(length(labels[-1]) = 2 AND len(labels) > 2
                    AND labels[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org'), false) AS pair
    FROM per_host
), hosts AS (
    SELECT host, n, k,
           CASE WHEN whole THEN '' WHEN pair THEN array_to_string(labels[-2:], '.') ELSE labels[-1] END AS suffix,
           CASE WHEN whole THEN array_to_string(labels, '.') WHEN pair THEN array_to_string(labels[-3:], '.')
                ELSE array_to_string(labels[-2:], '.') END AS domain
    FROM shaped
), total AS (
    SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0.5 END AS m FROM hosts
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM hosts, total GROUP BY suffix
), suffix_strength AS (
    SELECT 1 / least(greatest(coalesce(r, 1), 0.001), 0.999) - 1 AS b FROM (
        SELECT (sum(n * (k / n - m) ** 2) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS r
        FROM suffixes WHERE n > 0) s
), domains AS (
    SELECT domain, h.suffix, sum(h.n) AS n, sum(h.k) AS k, any_value((s.k + b * s.m) / (s.n + b)) AS m
    FROM hosts h JOIN suffixes s ON h.suffix = s.suffix, suffix_strength GROUP BY domain, h.suffix
), domain_strength AS (
    SELECT 1 / least(greatest(coalesce(r, 1), 0.001), 0.999) - 1 AS b FROM (
        SELECT (sum(n * (k / n - m) ** 2) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS r
        FROM domains WHERE n > 0) s
), of_domain AS (
    SELECT host, h.n, h.k, (d.k + b * d.m) / (d.n + b) AS m
    FROM hosts h JOIN domains d ON h.domain = d.domain AND h.suffix = d.suffix, domain_strength
), host_strength AS (
    SELECT 1 / least(greatest(coalesce(r, 1), 0.001), 0.999) - 1 AS b FROM (
        SELECT (sum(n * (k / n - m) ** 2) - sum(m * (1 - m))) / nullif(sum(m * (1 - m) * (n - 1)), 0) AS r
        FROM of_domain WHERE n > 0) s
), posterior AS (
    SELECT host, (k + b * m) / (n + b) AS mean, n + b AS weight FROM of_domain, host_strength
), verdicts AS (
    SELECT host, mean, bound, CASE WHEN bound < 0.5 THEN 'block' ELSE 'allow' END AS reputation
    FROM (SELECT *, mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) AS bound FROM posterior) b
), ruled AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    END AS rule
    FROM parts
)
SELECT page_id, r.host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' ELSE reputation END AS verdict,
       round(mean, 6) AS mean, round(bound, 6) AS bound
FROM ruled r JOIN verdicts v ON r.host = v.host
"""

_OP8 = rf"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size
    FROM documents
), classed AS (
    SELECT *, length(bin(size)) * 8 + ((size >> greatest(length(bin(size)) - 4, 0)) & 7) AS class FROM sized
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS rank
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, (rank - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM sources
), levels AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (
                  ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              / CAST(sum(weight) OVER (ORDER BY cap / weight, rank
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM weighed
), aimed AS (
    SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM levels
), numbers AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS copies,
           CAST('0x' || substr(md5('0/' || coalesce(source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS start
    FROM aimed
), placed AS (
    SELECT c.*, CAST(row_number() OVER (PARTITION BY c.source ORDER BY class, key, size) AS DOUBLE) AS place
    FROM classed c
)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(copies) + least(floor(start + place * (copies - floor(copies)))
                                         - floor(start + (place - 1) * (copies - floor(copies))), 1) AS BIGINT) AS taken
FROM placed p JOIN numbers n ON p.source IS NOT DISTINCT FROM n.source
"""

_OP9 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(doc_id, -9223372036854775808) AS doc, doc_id, source AS host,
           coalesce(text, '') AS text, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS tie
    FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '{_WORD}') AS words FROM docs
), windows AS (
    SELECT id, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT id, words, unnest(range(1, len(words) - 6)) AS i FROM worded)
), again AS (
    SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, w) AS times FROM windows) WHERE times > 1
), repeats AS (
    SELECT id, count(DISTINCT i + step) AS n FROM again, range(0, 8) s(step) GROUP BY id
), line AS (
    SELECT id, {{'doc': doc, 'tie': tie}} AS key, host, text, raw,
           trim(regexp_replace(lower(raw), '{_GAP}', ' ', 'g')) AS norm
    FROM (SELECT id, doc, tie, host, text, unnest(string_split(text, chr(10))) AS raw FROM docs)
), doubled AS (
    SELECT id, count(*) - count(DISTINCT raw) AS n FROM line WHERE norm <> '' GROUP BY id
), spread AS (
    SELECT host, norm, count(DISTINCT text) AS documents, min(key) AS first FROM line WHERE norm <> '' GROUP BY host, norm
), sizes AS (
    SELECT host, count(DISTINCT text) AS documents FROM docs GROUP BY host
), frequent AS (
    SELECT s.host, norm, first FROM spread s JOIN sizes z ON s.host IS NOT DISTINCT FROM z.host
    WHERE s.documents > 10 AND s.documents > 0.05::DOUBLE * z.documents
), gone AS (
    SELECT id, sum(length(l.norm) - length(replace(l.norm, ' ', '')) + 1) AS n
    FROM line l JOIN frequent f ON l.norm = f.norm AND l.host IS NOT DISTINCT FROM f.host AND l.key <> f.first
    GROUP BY id
), facts AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(text, '{_GAP}', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
           coalesce(g.n, 0) AS removed
    FROM worded w LEFT JOIN repeats r ON w.id = r.id LEFT JOIN doubled d ON w.id = d.id LEFT JOIN gone g ON w.id = g.id
), failing AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (removed > 0 AND n_words - removed < 20) AS kept
FROM failing
"""

_OP10 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(doc_id, -9223372036854775808) AS doc, doc_id, text FROM documents
), line AS (
    SELECT id, doc, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM docs
), worded AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS i FROM line
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), windows AS (
    SELECT a.id, a.doc, a.text, [a.l, b.l, c.l] AS w, a.pos AS a1, b.pos AS a2, c.pos AS a3
    FROM worded a JOIN worded b ON a.id = b.id AND b.i = a.i + 1 JOIN worded c ON a.id = c.id AND c.i = a.i + 2
), ranked AS (
    SELECT *, dense_rank() OVER (PARTITION BY w ORDER BY doc, md5(text), a1) AS place FROM windows
), gone AS (
    SELECT DISTINCT id, unnest([a1, a2, a3]) AS pos FROM ranked WHERE place > 1
), counted AS (
    SELECT l.id, count(*) AS n, count(g.pos) AS lost,
           string_agg(l.l, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS rest
    FROM line l LEFT JOIN gone g ON l.id = g.id AND l.pos = g.pos GROUP BY l.id
)
SELECT doc_id, CASE WHEN lost = 0 THEN text ELSE coalesce(rest, '') END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE n END AS n_lines, lost AS n_removed
FROM docs d JOIN counted c ON d.id = c.id
"""

_OP11 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), found AS (
    SELECT id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), langs AS (
    SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), counts AS (
    SELECT f.lang, f.source, f.term, count(*) AS n
    FROM found f JOIN kept k ON f.lang = k.lang AND f.term = k.term GROUP BY f.lang, f.source, f.term
), totals AS (
    SELECT d.lang, d.source, coalesce(any_value(c.total), 0) AS total FROM docs d
    LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, source) c
        ON d.lang = c.lang AND d.source = c.source
    GROUP BY d.lang, d.source
), shares AS (
    SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
    FROM totals t JOIN kept k ON t.lang = k.lang JOIN langs l ON t.lang = l.lang
    LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), valued AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
    FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM valued
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op3_url_filters": _OP3, "op8_mixing": _OP8, "op9_quality_rules": _OP9, "op10_line_dedup": _OP10,
    "op11_source_divergence": _OP11,
}
