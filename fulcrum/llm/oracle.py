"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
grams AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g
          FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams),
covered AS (SELECT r, count(DISTINCT p) AS n
            FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again WHERE n >= 2) GROUP BY r),
m AS (SELECT w.r, doc_id, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g'))::BIGINT AS n_upper
      FROM w LEFT JOIN covered ON covered.r = w.r),
b AS (SELECT *,
        (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
       + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
       + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
       + CASE WHEN 100 * n_upper > 40 * word_chars THEN 16 ELSE 0 END
       + CASE WHEN word_chars > 14 * n_words OR word_chars < 2 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM b
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             list_value(5, 2, 1)[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
      FROM d GROUP BY source),
-- the level at which weight * level, capped at 3 sizes, uses up the total: tried after each set of capped sources
tried AS (SELECT a.source, ((SELECT sum(source_size) FROM s)
                            - coalesce(sum(3 * b.source_size) FILTER (b.source_size * a.w < a.source_size * b.w), 0))::DOUBLE
                 / sum(b.w) FILTER (b.source_size * a.w >= a.source_size * b.w) AS level
          FROM s a, s b GROUP BY a.source, a.source_size, a.w),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, (SELECT max(level) FROM tried) * w) AS target,
             CAST('0x' || substr(md5('mix-1:' || coalesce('s:' || source, 'null')), 1, 4) AS BIGINT) / 65536.0::DOUBLE AS shift
      FROM s),
r AS (SELECT doc_id, size, source_size, target, shift,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each,
             row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (floor(shift + each * k) - floor(shift + each * (k - 1)))::INT AS copies FROM r)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""

#: A private key up to its END line, or the BEGIN line with its key lines.  (RE2 has no look-ahead: the last, short and
#: unpadded line of a key without an END line isn't seen here.)
_BETWEEN = r"""(?:[\s"''+,;>#*|]|\\[nrt]?)*"""
_PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-----+END [A-Z ]*PRIVATE KEY-----|"
        rf"(?:{_BETWEEN}(?:Proc-Type|DEK-Info):[^\r\n\\]*)*(?:(?:{_BETWEEN}[A-Za-z0-9+/]{{16,}})+"
        rf"(?:=+|{_BETWEEN}[A-Za-z0-9+/]+=+)?)?)")

#: kind, expression, group that must be long enough, least length
_SECRETS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
    ("pem", _PEM, 0, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 30),
]


def _secret_matches(nr: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT r, {nr} AS nr, '{kind}' AS kind, s, s + length(ms[i]) AS e
    FROM (SELECT r, ms, gs, i, coalesce(list_sum(list_transform(ps[1:i], lambda x: length(x))), 0)
                 + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
          FROM (SELECT r, ps, ms, gs, unnest(range(1, len(ms) + 1)) AS i
                FROM (SELECT r, string_split_regex(t, '{pattern}') AS ps, regexp_extract_all(t, '{pattern}') AS ms,
                             regexp_extract_all(t, '{pattern}', {group}) AS gs
                      FROM d WHERE regexp_matches(t, '{pattern}'))))
    WHERE length(gs[i]) >= {least}"""


OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_secret_matches(nr, *rule) for nr, rule in enumerate(_SECRETS))}),
a AS (SELECT r, count(*) FILTER (nr = 0) AS n_assign, count(*) FILTER (nr = 1) AS n_access,
             count(*) FILTER (nr = 2) AS n_hex,
             string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, nr) FILTER (nr < 3) AS base,
             string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, nr) AS spans
      FROM m GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON a.r = d.r
"""


def _ranks(kind: str, along: tuple[str, str]) -> str:
    """Unrolled steps of one PageRank over ``links``, from ``along[0]`` to ``along[1]``."""
    a, b = along
    steps = [f"""
{kind}_0 AS MATERIALIZED (SELECT host, {kind}_seed AS seed, {kind}_seed AS rank FROM seeds WHERE {kind}_seed > 0),
{kind}_edges AS MATERIALIZED (SELECT {a} AS a, {b} AS b, n / sum(n) OVER (PARTITION BY {a}) AS part FROM links)"""]
    for i in range(20):
        steps.append(f"""
{kind}_m{i + 1} AS MATERIALIZED (SELECT b AS host, 0.85 * sum(rank * part) AS rank
    FROM {kind}_{i} JOIN {kind}_edges ON a = host GROUP BY b),
{kind}_{i + 1} AS MATERIALIZED (SELECT host, max(seed) AS seed, round(sum(rank), 12) AS rank FROM (
    SELECT host, 0 AS seed, rank FROM {kind}_m{i + 1} UNION ALL
    SELECT host, seed, seed * (1 - coalesce((SELECT sum(rank) FROM {kind}_m{i + 1}), 0)) FROM {kind}_0) GROUP BY host)""")
    return ",".join(steps)


OP6 = rf"""
WITH p AS (SELECT page_id, html,
        lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)) AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules(verdict, h, q) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
        ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls AS (SELECT DISTINCT host, path FROM p),
fit AS (SELECT host, path, arg_max(h || q, length(h || q)) AS rule, arg_max(verdict, length(h || q)) AS verdict
        FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY host, path),
j AS (SELECT p.*, rule, verdict FROM p LEFT JOIN fit ON fit.host = p.host AND fit.path = p.path),
counts AS (SELECT host, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked
           FROM j WHERE host <> '' GROUP BY host),
seeds AS MATERIALIZED (SELECT host, allowed / (SELECT greatest(sum(allowed), 1) FROM counts)::DOUBLE AS t_seed,
                 blocked / (SELECT greatest(sum(blocked), 1) FROM counts)::DOUBLE AS b_seed FROM counts),
hrefs AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''),
        '(?i)<a\s[^>]*?href\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^"''\s>]+)', 1)) AS t FROM p WHERE host <> ''),
links AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM (
        SELECT src, lower(regexp_extract(t, '//([^/?#]*)', 1)) AS dst FROM hrefs) WHERE dst <> '' AND dst <> src GROUP BY ALL),
{_ranks("t", ("src", "dst"))},
{_ranks("b", ("dst", "src"))},
hosts AS (SELECT host, sum(t) AS trust, sum(b) AS distrust FROM (
        SELECT host, rank AS t, 0 AS b FROM t_20 UNION ALL SELECT host, 0, rank FROM b_20) GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(verdict, CASE WHEN distrust > 0.5 * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN hosts ON hosts.host = j.host
"""

OP13 = r"""
WITH pieces AS MATERIALIZED (
    SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                FROM pieces, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
-- every cut of every candidate, with the counts of its two parts
cuts AS (SELECT c.lang, c.k, c.phrase, c.a, i, l.a AS l, r.a AS r,
                (2000000::HUGEINT * c.a // (l.a::HUGEINT + r.a))::BIGINT AS score
         FROM (SELECT *, unnest(range(1, k)) AS i FROM f WHERE k > 1) c
         JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:i], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[i + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inside AS (SELECT lang, a, array_to_string(ws[i:i + size - 1], ' ') AS part
           FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM f, (VALUES (2), (3)) AS sizes(size) WHERE k > size)),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
             SELECT 1 FROM inside x WHERE x.lang = b.lang AND x.part = b.phrase AND 100::HUGEINT * x.a >= 80::HUGEINT * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""

ABLATIONS = f"""
WITH ledger AS ({OP2}),
policies(policy, mask) AS (VALUES ('base', 3), ('v1', 7), ('v2', 63)),
rules(rule, bit) AS (VALUES ('too_few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8),
                            ('shouting', 16), ('word_length', 32))
SELECT policy, rule, count(*) AS documents, count(*) FILTER (failed_bits & mask <> 0) AS rejected,
       count(*) FILTER (failed_bits & mask = bit) AS only_this_rule,
       count(*) FILTER (failed_bits & mask & ~bit <> 0) AS rejected_without
FROM ledger, policies, rules WHERE mask & bit <> 0 GROUP BY policy, rule
"""

QUERIES_SQL = {
    "op2_quality_rules": OP2,
    "quality_ablations": ABLATIONS,
    "op3_secrets": OP3,
    "op6_url_filter": OP6,
    "op9_mixing": OP9,
    "op13_collocations": OP13,
}
