"""The registered queries that SQL can express, as DuckDB SQL."""

from __future__ import annotations

from medallion.llm import reputation

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RULES = sorted(reputation.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
_FITS = [
    (kind, on + below, f"(host = '{on}' OR ends_with(host, '.{on}')) AND starts_with(path, '{below}')")
    for kind, on, below in _RULES
]
_LOW, _HIGH = reputation.RHO


def _level(name: str, parent: str, keys: str, members: str) -> str:
    """Members of a level with their shrunk rate, as two views."""
    over = "sum(power(bad - n * rate, 2) - n * rate * (1 - rate)) / nullif(sum(n * (n - 1) * rate * (1 - rate)), 0)"
    return f"""
{name}_in AS ({members}),
{name}_k AS (SELECT 1 / least({_HIGH}, greatest({_LOW}, coalesce({over}, {_LOW}))) - 1 AS k FROM {name}_in),
{name} AS (SELECT {keys}, n, bad, (k * rate + bad) / (k + n) AS rate, k FROM {name}_in CROSS JOIN {name}_k)"""


URLS = f"""
WITH urls AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_AZ}) AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
sites AS (SELECT *, regexp_replace(host, '{reputation.SITE}', '', 'g') AS site FROM urls),
known AS (
    SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS outcome
    FROM labels GROUP BY doc_id),
hosts AS (
    SELECT site, count(outcome)::DOUBLE AS n, coalesce(sum(outcome), 0)::DOUBLE AS bad,
           CASE WHEN regexp_matches(site, '{reputation.ADDRESS}') THEN site ELSE regexp_extract(site, '{reputation.DOMAIN}', 1) END AS domain,
           CASE WHEN regexp_matches(site, '{reputation.ADDRESS}') THEN '{reputation.ADDRESSES}' ELSE regexp_extract(site, '{reputation.SUFFIX}', 1) END AS suffix
    FROM sites LEFT JOIN known USING (page_id) GROUP BY site),
{_level("suffixes", "root", "suffix", f'''SELECT suffix, sum(n) AS n, sum(bad) AS bad,
    ((SELECT sum(bad) FROM hosts) + {reputation.ROOT[0]}) / ((SELECT sum(n) FROM hosts) + {reputation.ROOT[1]}) AS rate FROM hosts GROUP BY suffix''')},
{_level("domains", "suffixes", "domain, suffix", '''SELECT d.*, s.rate FROM
    (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix) d JOIN suffixes s USING (suffix)''')},
{_level("posterior", "domains", "site", "SELECT h.site, h.n, h.bad, d.rate FROM hosts h JOIN domains d USING (domain, suffix)")}
SELECT page_id, host, path,
       CASE {" ".join(f"WHEN {fits} THEN '{name}'" for _, name, fits in _FITS)} END AS rule,
       CASE {" ".join(f"WHEN {fits} THEN '{kind}'" for kind, _, fits in _FITS)}
            WHEN rate - {reputation.Z} * sqrt(rate * (1 - rate) / (k + n + 1)) > {reputation.MAX_BAD} THEN 'block'
            ELSE 'allow' END AS verdict
FROM sites LEFT JOIN posterior USING (site)
"""

EXACT = f"""
WITH texts AS (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS text FROM documents),
groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN groups USING (text)
"""

RUNS = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, generate_subscripts(parts, 1) AS no, unnest(parts) AS line FROM split),
windows AS (
    SELECT * FROM (
        SELECT doc_id, no, line, lead(line) OVER (PARTITION BY doc_id ORDER BY no) AS next_line,
               lead(no) OVER (PARTITION BY doc_id ORDER BY no) AS next_no
        FROM lines)
    WHERE next_no IS NOT NULL),
ranked AS (
    SELECT doc_id, no, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, no) AS place,
           count(*) OVER (PARTITION BY line, next_line) AS n
    FROM windows),
covered AS (
    SELECT doc_id, no, place FROM ranked WHERE n > 1
    UNION ALL
    SELECT doc_id, no + 1, place FROM ranked WHERE n > 1),
gone AS (SELECT doc_id, no FROM covered GROUP BY doc_id, no HAVING min(place) > 1)
SELECT l.doc_id, count(*) AS n_lines, count(g.no) AS n_deleted,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE g.no IS NULL), '')) AS text_sha256
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no
GROUP BY l.doc_id
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LEAKS = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORD}') AS words FROM documents),
items AS (
    SELECT item_id, words, least(10, len(words)) AS n
    FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORD}') AS words FROM benchmark)
    WHERE len(words) > 0),
places AS (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM items),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS part FROM places),
lengths AS (SELECT DISTINCT n FROM items),
spots AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, lengths WHERE len(words) >= n),
hits AS (
    SELECT s.doc_id, s.i, s.n, w.item_id
    FROM (SELECT doc_id, i, n, array_to_string(list_slice(words, i, i + n - 1), ' ') AS part FROM spots) s
    JOIN windows w ON s.n = w.n AND s.part = w.part),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM docs WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reached AS (
    SELECT doc_id, doc_id AS other FROM docs
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM lowest LEFT JOIN sizes USING (doc_id)
"""

#: 20 bits of a SHA-1 at a time as four characters of base32.
_FIVE = "cast('0x' || substr(sha, {at}, 5) AS BIGINT)"
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(({_FIVE.format(at=1 + 5 * g)} >> {shift}) & 31 AS INT) + 1, 1)"
    for g in range(8)
    for shift in (15, 10, 5, 0)
)

ARCHIVES = f"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
firsts AS (SELECT sha, min(page_id) AS first_id FROM payloads GROUP BY sha)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (sha)
"""


_CRC = """(4294967295 - list_reduce(list_concat([4294967295], list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _path(of: str, cost: str, letter: str, line: str | None = None, only: str = "true") -> str:
    added = f"{of}.r || chr(10) || {line}" if line else f"{of}.r"
    return f"CASE WHEN {of} IS NOT NULL AND {only} THEN {{'c': {of}.c + {cost}, 'a': {of}.a || '{letter}', 'r': {added}}} END"


def _due(of: str, role: str) -> str:
    return _path(of, "2", "I", f"'{role}:'")


_SPARED, _LEFT = "fault NOT IN ('blank', 'duplicate')", "(fault = 'truncated')::INT"


def _taken(states: list[str], initial: str, role: str) -> str:
    own = [_path(x, _LEFT, "K", "role || ':' || text", f"{_SPARED} AND initial = '{initial}'") for x in states]
    given = [_path(x, f"2 + {_LEFT}", "R", f"'{role}:' || text", _SPARED) for x in states]
    return ", ".join(own + given)


#: The cheapest paths to each state of the pattern, a row at a time.
CONVERSATIONS = f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT *, {_CRC} % 20 AS kind FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS time FROM kinds),
faces AS (
    SELECT *, rtrim(text, {_SPACE}) AS solid, role[1] AS initial,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) AS copy,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), time) AS i FROM damaged),
steps AS (
    SELECT conv_id, i, turn, role, text, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous,
           CASE WHEN solid = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate'
                WHEN solid[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM faces),
paths AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': ''}} AS s0, NULL::STRUCT(c INT, a VARCHAR, r VARCHAR) AS s1,
           NULL::STRUCT(c INT, a VARCHAR, r VARCHAR) AS s2, NULL::STRUCT(c INT, a VARCHAR, r VARCHAR) AS s3 FROM conversations
    UNION ALL
    SELECT conv_id, i, {_path("s0", "3", "D")},
           least({_path("s1", "3", "D")}, {_path("s0", _LEFT, "K", "role || ':' || text", f"{_SPARED} AND initial = 's'")}),
           least({_path("u", "3", "D")}, {_taken(["s0", "s1", "a"], "u", "user")}),
           least({_path("a", "3", "D")}, {_taken(["u"], "a", "assistant")})
    FROM (SELECT *, least(s3, {_due("first", "assistant")}) AS a FROM (
        SELECT p.s0, p.s1, p.s3, t.*, least(s2, {_due("s0", "user")}, {_due("s1", "user")}) AS first,
               least(s2, {_due("s0", "user")}, {_due("s1", "user")}, {_due("s3", "user")}) AS u
        FROM paths p JOIN steps t ON t.conv_id = p.conv_id AND t.i = p.i + 1))),
ended AS (
    SELECT conv_id, arg_max(least(s0, least(s3, {_due("first", "assistant")})), i) AS best FROM (
        SELECT *, least(s2, {_due("s0", "user")}, {_due("s1", "user")}) AS first FROM paths) GROUP BY conv_id),
counts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM steps GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(substr(best.r, 2)) AS repaired_sha256
FROM ended LEFT JOIN counts USING (conv_id)
"""

#: Bytes are pairs of hexadecimal digits.
SUBSTRINGS = """
WITH texts AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS digits FROM documents),
pieces AS (
    SELECT doc_id, piece, substr(digits, 2000 * piece + 1, 2098) AS digits
    FROM (SELECT *, unnest(range(0, len(digits) // 2000 + 1)) AS piece FROM texts)),
places AS (
    SELECT doc_id, 1000 * piece + place AS spot, substr(digits, 2 * place + 1, 100) AS string
    FROM (SELECT *, unnest(range(0, len(digits) // 2 - 49)) AS place FROM pieces WHERE len(digits) >= 100)),
firsts AS (SELECT string, min(doc_id) AS first_id FROM places GROUP BY string),
hits AS (SELECT doc_id, spot FROM places JOIN firsts USING (string) WHERE first_id < doc_id),
runs AS (
    SELECT doc_id, spot, sum((spot > before + 50 OR before IS NULL)::INT) OVER (PARTITION BY doc_id ORDER BY spot) AS run
    FROM (SELECT doc_id, spot, lag(spot) OVER (PARTITION BY doc_id ORDER BY spot) AS before FROM hits)),
spans AS (SELECT doc_id, min(spot) AS low, max(spot) + 50 AS high FROM runs GROUP BY doc_id, run),
ends AS (SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, list(low ORDER BY low) AS lows, list(high ORDER BY low) AS highs
         FROM spans GROUP BY doc_id),
kept AS (
    SELECT doc_id, digits, n_spans, n_removed, CASE WHEN lows IS NULL THEN digits ELSE array_to_string(list_transform(
        range(0, len(lows) + 1), lambda j: substr(digits, 2 * (CASE WHEN j = 0 THEN 0 ELSE highs[j] END) + 1,
            2 * ((CASE WHEN j = len(lows) THEN len(digits) // 2 ELSE lows[j + 1] END) - (CASE WHEN j = 0 THEN 0 ELSE highs[j] END)))), '') END AS rest
    FROM texts LEFT JOIN ends USING (doc_id))
SELECT doc_id, len(digits) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256
FROM kept
"""

_SQUARED = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))"


def _round(number: int) -> str:
    """Parts with their nearest entry of a codebook, and the next codebook."""
    return f"""
near{number} AS (
    SELECT p, vec_id, any_value(v) AS v, min({{'d': d, 'e': e}}) AS best
    FROM (SELECT x.p, x.vec_id, x.v, b.e, {_SQUARED} AS d FROM parts x JOIN book{number} b USING (p)) GROUP BY p, vec_id),
sums{number} AS (
    SELECT p, best.e AS e, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM near{number}, unnest(range(1, len(v) + 1)) r(i) GROUP BY ALL),
means{number} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums{number} GROUP BY p, e),
book{number + 1} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{number} b LEFT JOIN means{number} m USING (p, e))"""


CODES = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS v FROM kept, unnest(range(0, 16)) r(p)),
book0 AS (SELECT p, e, v FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
{_round(0)},{_round(1)},{_round(2)},
codes AS (SELECT vec_id, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
          FROM near2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
          FROM (SELECT p, e, i, v[i] AS x FROM book2, unnest(range(1, len(v) + 1)) r(i)))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""


def oracle_sql() -> dict[str, str]:
    found = {"op1_near_dedup": NEAR, "op2_warc": ARCHIVES, "op7_url_reputation": URLS, "op8_exact_dedup": EXACT}
    found |= {"op9_decontaminate": LEAKS, "op10_line_runs": RUNS, "op11_conversations": CONVERSATIONS}
    return found | {"op12_substrings": SUBSTRINGS, "op13_vector_codes": CODES}
