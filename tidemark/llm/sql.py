"""The same results in DuckDB's SQL."""

from __future__ import annotations

from tidemark.llm.quality import RULES, STOP_WORDS
from tidemark.llm.urls import RULES as URL_RULES

SPACES = r"[\x20\x09-\x0D]"
ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = rf"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
), keyed AS (
    SELECT doc_id, pos, line, {ASCII_LOWER.format(rf"regexp_replace(regexp_replace(line, '^{SPACES}+', ''), '{SPACES}+$', '')")} AS key FROM lines
), owners AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(o.owner <> k.doc_id, false) AS dropped FROM keyed k LEFT JOIN owners o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _rules() -> str:
    tests = []
    for rule in RULES:
        if rule.least is not None:
            tests.append(f"({rule.metric} < {rule.least} AND n_words >= {rule.from_words})")
        if rule.most is not None:
            tests.append(f"({rule.metric} > {rule.most} AND n_words >= {rule.from_words})")
    return " OR ".join(tests)


def quality_sql(documents: str = "documents") -> str:
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text FROM {documents}
), parts AS (
    SELECT doc_id, text,
        list_filter(string_split_regex(text, '{SPACES}+'), lambda w: w <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), placed AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM parts
), windows AS (
    SELECT doc_id, pos, lead(word, 4) OVER w IS NOT NULL AS whole,
        concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w) AS gram
    FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), twice AS (
    SELECT doc_id, pos FROM windows WHERE whole QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2
), covered AS (
    SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, range(0, 5) AS r(k) GROUP BY doc_id
), counted AS (
    SELECT p.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
        len(list_filter(words, lambda w: w IN ({stops}))) AS n_stop_words, len(lines) AS n_lines
    FROM parts p LEFT JOIN covered c ON p.doc_id = c.doc_id
), measured AS (
    SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS chars_per_word,
        CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
        CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_share,
        CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT ({_rules()}) AS kept
FROM measured
"""


QUALITY = quality_sql()

_URL_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
URLS = rf"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {_URL_RULES}),
parsed AS (
    SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), split AS (
    SELECT page_id, coalesce({ASCII_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")}, '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM parsed
)
SELECT s.page_id, s.host, s.path, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
    coalesce(arg_max(r.verdict, length(r.rule_host || r.rule_path)), 'allow') AS verdict
FROM split s LEFT JOIN rules r
    ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
GROUP BY s.page_id, s.host, s.path
"""



DIVERGENCE = rf"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS doc FROM documents
), terms AS (
    SELECT doc, lang, source, unnest(regexp_extract_all({ASCII_LOWER.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term FROM (SELECT DISTINCT doc, lang, term FROM terms) GROUP BY lang, term HAVING count(*) >= 30
), cells AS (
    SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), sources AS (
    SELECT DISTINCT lang, source FROM docs
), filled AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n
    FROM sources s JOIN kept k ON s.lang = k.lang LEFT JOIN cells c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), p AS (
    SELECT f.lang, f.source, f.term, f.n,
        CAST(1 + (1000000000::HUGEINT * (f.n + 5)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 5 * z.v) AS BIGINT) AS p
    FROM filled f JOIN sizes z ON f.lang = z.lang
), totals AS (
    SELECT lang, term, sum(n)::BIGINT AS n FROM cells GROUP BY lang, term
), q AS (
    SELECT t.lang, t.term, CAST(1 + (1000000000::HUGEINT * (t.n + 5)) // (sum(t.n) OVER (PARTITION BY t.lang) + 5 * z.v) AS BIGINT) AS q
    FROM totals t JOIN sizes z ON t.lang = z.lang
), distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), above AS (
    SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM above)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

#: The CRC-32 of a decimal number, bit by bit.
_BIT = "list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
_CRC = f"xor(list_reduce(list_transform(string_split({{0}}::VARCHAR, ''), lambda s: ascii(s)::BIGINT), lambda c, b: {_BIT}, 4294967295), 4294967295)"

PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'digest': digest, 'chars': chars}} ORDER BY turn NULLS FIRST, digest) AS said FROM turns GROUP BY conv_id
), numbered AS (
    SELECT conv_id, said, {_CRC.format("conv_id")} % 6 AS h FROM own
), rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.said[1:o.h], []), o.said[o.h + 1:]) AS said
    FROM numbered o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), places AS (
    SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS depth FROM rebuilt
), members AS (
    SELECT conv_id, depth, len(said) = depth AS ends, coalesce(said[depth].chars, 0) AS chars,
        md5(array_to_string(list_transform(said[1:depth], lambda s: s.digest), ',')) AS key,
        CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(said[1:depth - 1], lambda s: s.digest), ',')) END AS parent_key
    FROM places
), nodes AS (
    SELECT key, any_value(parent_key) AS parent_key, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM members GROUP BY key
), kids AS (
    SELECT parent_key AS key, count(*) AS n FROM nodes WHERE parent_key IS NOT NULL GROUP BY parent_key
), up AS (
    SELECT m.key, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
    FROM nodes n LEFT JOIN kids k ON n.key = k.key JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, u.n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN up u ON n.key = u.key LEFT JOIN kids k ON n.key = k.key LEFT JOIN nodes p ON n.parent_key = p.key
"""
