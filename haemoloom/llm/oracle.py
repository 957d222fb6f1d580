"""SQL for the registered queries that SQL can express."""

#: White space between words, as DuckDB's regular expressions write it.
SPACE = r"[\x20\x09-\x0D]"

EXACT_DEDUP = rf"""
WITH named AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM named
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"[x for x in string_split_regex({text}, '{SPACE}+') if x <> '']"


# The limits are the operator's defaults.
LINE_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT row, doc_id, host, text, {_words("text")} AS w FROM docs
), lines AS (
    SELECT row, host, text, line, {_words("line")} AS w
    FROM (SELECT row, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)
), told AS (
    SELECT row, host, text, line, len(w) AS words, {_LOWER.format("array_to_string(w, ' ')")} AS norm FROM lines WHERE len(w) > 0
), hosts AS (
    SELECT host, count(DISTINCT text) AS n FROM docs GROUP BY host
), frequent AS (
    SELECT host, norm FROM told JOIN hosts USING (host)
    GROUP BY host, norm, n HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.10 * n
), gone AS (
    SELECT row, sum(words) AS words FROM told JOIN frequent USING (host, norm) GROUP BY row
), doubled AS (
    SELECT row, count(*) - count(DISTINCT line) AS n FROM told GROUP BY row
), windows AS (
    SELECT row, unnest(range(1, len(w) - 6)) AS i, w FROM words WHERE len(w) >= 8
), named AS (
    SELECT row, i, array_to_string(w[i:i + 7], ' ') AS eight FROM windows
), again AS (
    SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, eight) AS n FROM named) WHERE n > 1
), repeated AS (
    SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM again) GROUP BY row
), counts AS (
    SELECT row, doc_id, len(w) AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
           coalesce(doubled.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, coalesce(gone.words, 0) AS removed
    FROM words LEFT JOIN doubled USING (row) LEFT JOIN repeated USING (row) LEFT JOIN gone USING (row)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (n_words - removed) >= 30 * n_words AS kept
FROM judged
"""

URL_RULES = rf"""
WITH rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), urls AS (
    SELECT row_number() OVER () AS row, page_id,
           {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), fits AS (
    SELECT u.row, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY u.row ORDER BY length(r.host) DESC, length(r.path) DESC) AS place
    FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_words(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
    FROM words
), held AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""

# A formatted turn is its role and text with three escapes of one more character
# each, and 17 characters of marks.
CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
    SELECT *, length(role || text) + length(role || text) - length(translate(role || text, '\<>', '')) + 17 AS shown FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(shown)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f"coalesce({text}, '')")}, '{_TERM}')"


RANKED_SEARCH = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, {_terms("text")} AS terms FROM documents
), sizes AS (
    SELECT row, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0
), total AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), postings AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY term, docs
), wanted AS (
    SELECT item, item_id, term, count(*) AS times
    FROM (SELECT item, item_id, unnest(terms) AS term
          FROM (SELECT row_number() OVER () AS item, item_id, {_terms("text")} AS terms FROM benchmark))
    GROUP BY item, item_id, term
), scored AS (
    SELECT item, item_id, doc_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total.terms))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (row), total
    GROUP BY item, item_id, doc_id, row
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op3_line_rules": LINE_RULES,
        "op4_url_rules": URL_RULES,
        "op7_near_dedup": NEAR_DEDUP,
        "op10_chat": CHAT,
        "op12_ranked_search": RANKED_SEARCH,
    }
