"""DuckDB SQL for the queries that SQL can express; the others are held against plain Python in the tests."""

from __future__ import annotations

UP, LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

#: The tables have no redirects and no canonical links, so pages without a rule have no alias to be blocked by.
URL_FILTERS = f"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {UP}, {LOW}), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r),
rules(rule, rhost, rpath, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)"""

MIXING = """
WITH RECURSIVE s AS (SELECT source, sum(length(text))::DOUBLE AS size FROM documents GROUP BY source),
r AS (SELECT source, pow(size, 0.5) / (SELECT sum(pow(size, 0.5)) FROM s) * (SELECT sum(size) FROM s) / size AS rate FROM s),
q AS (SELECT source, greatest(1, ceil(rate / 64))::INT AS parts, rate / greatest(1, ceil(rate / 64)) AS mean FROM r),
c AS (SELECT source, mean, parts, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM q
      UNION ALL SELECT source, mean, parts, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM c WHERE k < floor(mean + 12 * sqrt(mean) + 30)),
u AS (SELECT doc_id, source, text, (('0x' || substr(md5('20:' || j || ':' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents JOIN q USING (source), LATERAL (SELECT unnest(range(1, parts + 1)) AS j)),
n AS (SELECT doc_id, u.source, text, count(*) AS n FROM u JOIN c ON c.source = u.source AND c.c <= u.u GROUP BY ALL)
SELECT doc_id, source, text, replica::INT AS replica, ('0x' || substr(md5('20:order:' || doc_id || ':' || replica), 1, 13))::BIGINT AS shuffle_key FROM (SELECT doc_id, source, text, unnest(range(1, n + 1)) AS replica FROM n)"""


def _spans(kind: str, no: int, pattern: str, group: int, least: int) -> str:
    """Matches with places: pieces between matches and matches add up."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {no} AS kind_no, '{kind}' AS kind, e - length(m) AS s, e FROM (
  SELECT doc_id, m, g, sum(length(m) + length(x)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
    SELECT doc_id, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(regexp_extract_all(t, '{p}', {group})) AS g, unnest(string_split_regex(t, '{p}')[:-2]) AS x, generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS i FROM d WHERE regexp_matches(t, '{p}'))) WHERE length(g) >= {least}"""


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: Without the battery's own spans, of which it finds none in these tables.
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS ({_spans("assign", 0, ASSIGN, 1, 6)} UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", 0, 20)} UNION ALL {_spans("hex", 2, "[0-9a-f]+", 0, 24)})
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no), '')) AS base_sha256, coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no), '') AS spans
FROM d LEFT JOIN x USING (doc_id) GROUP BY doc_id"""

QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM i WHERE i + 7 <= len(w)),
h AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rp AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM h) GROUP BY doc_id),
st AS (SELECT doc_id, count(*) FILTER (w[i] = w[i - 1]) AS n FROM i WHERE i > 1 GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(rp.n, 0) AS n_repeat_words, coalesce(st.n, 0) AS n_stutter, coalesce(l.n, 0) AS n_lines
      FROM d LEFT JOIN rp USING (doc_id) LEFT JOIN st USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (100 * n_symbols > 20 * n_words)::INT + 8 * (100 * n_dup_lines > 40 * n_lines)::INT + 16 * (100 * n_stutter > 30 * n_words)::INT + 32 * (word_chars < 2 * n_words OR word_chars > 16 * n_words)::INT)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, n_stutter, fail_bits FROM b"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {UP}, {LOW}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
q AS (SELECT item_id, w[k:k + 7] AS q FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 7) + 1)) AS k FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(q) AS n FROM q),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
x AS (SELECT doc_id, p, n, item_id FROM (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM p, n WHERE p + n - 1 <= len(w)) JOIN (SELECT item_id, array_to_string(q, ' ') AS g, len(q) AS n FROM q) USING (g, n)),
hit AS (SELECT doc_id, count(DISTINCT z) AS n FROM (SELECT doc_id, unnest(range(p, p + n)) AS z FROM x) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM x) GROUP BY doc_id),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n FROM (SELECT doc_id, w, p, w[p] AS a FROM p) JOIN (SELECT item_id, q, q[1] AS a, '% ' || array_to_string(q[2:], ' % ') || ' %' AS pat FROM q) USING (a)
         WHERE len(q) = 1 OR ' ' || array_to_string(w[p + 1:p + len(q) + 3], '  ') || ' ' LIKE pat GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256, coalesce(it.n, 0) >= 2 AS contaminated, coalesce(near.n, 0) AS n_near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN near USING (doc_id)"""

#: Every group and language gives every kept term a share; shares are exact in 128-bit integers.
DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), {UP}, {LOW}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT lang, source, term, sum(n) AS n FROM c SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM g GROUP BY ALL),
p AS (SELECT grp.lang, grp.source, k.term, coalesce(g.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(g.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * v.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.v) AS q
      FROM grp JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s ON s.lang = grp.lang AND s.source = grp.source LEFT JOIN g ON g.lang = grp.lang AND g.source = grp.source AND g.term = k.term),
two AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(two.value, 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN two ON two.lang = a.lang AND two.source = a.source AND two.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50"""

ORACLES = {"op12_divergence": DIVERGENCE, "op2_url_filters": URL_FILTERS, "op3_mixing": MIXING, "op4_secret_scan": SECRETS, "op6_quality_rules": QUALITY, "op9_decontaminate": DECONTAMINATE}
