"""DuckDB SQL that states the results of this subpackage's queries independently."""

from __future__ import annotations

#: Words and blanks as DuckDB's regular expressions write them.
_WORD = r"[^\x20\x09-\x0D]+"
_SPACES = r"[\x20\x09-\x0D]"


def quality_cte(table: str = "documents") -> str:
    """Common table expressions that end in ``judged``: features and verdict of each row of ``table``."""
    return rf"""
    q_docs AS (SELECT *, row_number() OVER () AS q_row FROM {table}),
    q_words AS (SELECT q_row, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM q_docs),
    q_win AS (SELECT q_row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
              FROM (SELECT q_row, w, unnest(range(1, len(w) - 1)) AS i FROM q_words)),
    q_cov AS (SELECT q_row, i FROM (SELECT q_row, i, count(*) OVER (PARTITION BY q_row, g) AS n FROM q_win) WHERE n > 1),
    q_rep AS (SELECT q_row, count(DISTINCT i + k) AS n_repeat_words FROM q_cov, (SELECT unnest([0, 1, 2]) AS k) GROUP BY q_row),
    q_lines AS (SELECT q_row, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
                FROM (SELECT q_row, unnest(string_split(t, chr(10))) AS x FROM q_words) WHERE regexp_matches(x, '{_WORD}') GROUP BY q_row),
    q_feat AS (SELECT d.*, len(w) AS n_words, length(regexp_replace(t, '{_SPACES}', '', 'g')) AS word_chars,
                      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                      coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
                      length(regexp_replace(t, '[^|]', '', 'g')) AS bars, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS caps,
                      length(regexp_replace(t, '[^!?]', '', 'g')) AS marks, length(regexp_replace(t, '[^0-9]', '', 'g')) AS digits
               FROM q_docs d JOIN q_words USING (q_row) LEFT JOIN q_lines USING (q_row) LEFT JOIN q_rep USING (q_row)),
    q_base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, greatest(word_chars, 1) AS c FROM q_feat),
    judged AS (SELECT *, NOT (base_failed OR n_symbols > 0.1 * c OR (n_symbols > 0.2 * n_words AND bars > 0.2 * n_words)
                      OR caps > 0.4 * c OR marks > 0.08 * c OR digits > 0.4 * c OR c > 20 * n_words
                      OR (n_dup_lines > 1 AND n_dup_lines > 0.5 * n_lines)) AS kept FROM q_base)"""


OP1 = f"WITH {quality_cte()} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"

OP3 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * 256)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, least(len(q.x), len(c.x)) + 1), lambda i: q.x[i] * c.x[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5"""


def mix_cte(table: str = "documents", alpha: float = 0.7, keep: float = 0.8, rounds: int = 8, scales: int = 16, slack: float = 0.01) -> str:
    """Common table expressions that end in ``mixed``: topic, tokens, probability and draw of each row of ``table``.

    Cells are raked at ``scales`` shares of kept tokens with probabilities up to 1 (b*).
    """
    dims = ("source", "lang", "topic")
    out = [rf"""
    m_docs AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS tokens,
        CASE WHEN regexp_matches(coalesce(text, ''), '(?i)(all rights reserved|licen[cs]e|copyright)') THEN 'notice'
             WHEN length(coalesce(text, '')) >= 4000 THEN 'long' WHEN length(coalesce(text, '')) >= 1000 THEN 'medium' ELSE 'short' END AS topic
        FROM {table}),
    m_cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM m_docs WHERE tokens > 0 GROUP BY ALL)"""]
    for d in dims:
        out.append(f"t_{d} AS (SELECT {d}, pow(sum(tokens), {alpha}) AS p FROM m_cells GROUP BY {d})")
    joins = " ".join(f"JOIN t_{d} ON m_cells.{d} IS NOT DISTINCT FROM t_{d}.{d}" for d in dims)
    shares = ", ".join(f"t_{d}.p / (SELECT sum(p) FROM t_{d}) AS g_{d}" for d in dims)
    out.append(f"r0 AS MATERIALIZED (SELECT m_cells.*, {shares} FROM m_cells {joins})")
    rooms = " UNION ALL ".join(f"SELECT sum(tokens) / (SELECT sum(tokens) FROM r0) / any_value(g_{d}) AS room FROM r0 GROUP BY {d}" for d in dims)
    out.append(f"m_facts AS MATERIALIZED (SELECT sum(tokens)::DOUBLE AS every, least({keep}, (SELECT min(room) FROM ({rooms}))) AS high FROM r0)")
    out.append(f"b0 AS MATERIALIZED (SELECT high * pow(0.8, k) AS scale, r0.*, high * pow(0.8, k) AS m FROM r0, m_facts, (SELECT unnest(range(0, {scales})) AS k))")
    for k in range(rounds * 3):
        d = dims[k % 3]
        out.append(f"""b{k + 1} AS MATERIALIZED (
          SELECT * EXCLUDE (a) REPLACE (m * coalesce(max(CASE WHEN a * m < 1 THEN a END) OVER p, 1 / min(m) OVER p) AS m) FROM (
            SELECT b{k}.*, (scale * every * g_{d} - (sum(tokens) OVER p - sum(tokens) OVER u)) / sum(tokens * m) OVER u AS a FROM b{k}, m_facts
            WINDOW p AS (PARTITION BY scale, {d}), u AS (PARTITION BY scale, {d} ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
          WINDOW p AS (PARTITION BY scale, {d}))""")
    out.append(f"m_b AS MATERIALIZED (SELECT * REPLACE (least(1.0, m) AS m) FROM b{rounds * 3})")
    out.append("m_whole AS MATERIALIZED (SELECT scale, sum(tokens * m) AS whole FROM m_b GROUP BY scale)")
    offs = " UNION ALL ".join(f"SELECT scale, abs(sum(tokens * m) / any_value(whole) / any_value(g_{d}) - 1) AS off FROM m_b JOIN m_whole USING (scale) GROUP BY scale, {d}" for d in dims)
    out.append(f"m_off AS MATERIALIZED (SELECT scale, max(off) AS off FROM ({offs}) GROUP BY scale)")
    out.append(f"m_best AS (SELECT max(scale) AS scale FROM m_off WHERE off <= (SELECT min(off) FROM m_off) + {slack})")
    out.append("m_p AS (SELECT source, lang, topic, m AS p FROM m_b JOIN m_best USING (scale))")
    on = " AND ".join(f"d.{d} IS NOT DISTINCT FROM m_p.{d}" for d in dims)
    out.append(f"""mixed AS (SELECT *, ('0x' || substr(md5(doc_id::VARCHAR || chr(31) || 'mix'), 1, 8))::BIGINT / 4294967296.0 < probability AS kept_mix
        FROM (SELECT d.*, CASE WHEN d.tokens = 0 THEN 1.0 ELSE p END AS probability FROM m_docs d LEFT JOIN m_p ON {on}))""")
    return ",\n".join(out)


OP4 = f"WITH {mix_cte()} SELECT doc_id, source, lang, topic, tokens, round(probability, 5) AS probability, kept_mix AS kept FROM mixed"

OP5 = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a) m USING (doc_id)"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS sha, min(page_id) OVER (PARTITION BY sha1(h)) AS low FROM p),
d AS (SELECT *, list_reduce(list_prepend('', list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha, 1 + (i // 4) * 5, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1))), lambda a, b: a || b) AS payload_digest FROM x)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = low THEN NULL ELSE low END AS refers_to FROM d"""

_DOMAIN = """CASE WHEN array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.za')
  THEN array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') ELSE array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') END"""


def _weight(level: str, n: str, b: str, mean: str) -> str:
    return f"""(SELECT coalesce(CASE WHEN size > 1 THEN least(greatest(noise * (1 - 1 / size) / greatest(spread - noise / size, 1e-9) - 1, 1.0), 10000.0) END, 10.0)
      FROM (SELECT sum({n} * pow({b} / {n} - {mean}, 2)) / sum({n}) AS spread, avg({mean} * (1 - {mean})) AS noise, sum({n}) / count(*) AS size FROM {level} WHERE {n} >= 2))"""


OP9 = rf"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (SELECT u.host, (coalesce(l.quality = 0, false) OR coalesce(l.toxic = 1, false))::INTEGER AS bad
  FROM (SELECT DISTINCT page_id, host FROM u) u JOIN labels l ON l.doc_id = u.page_id WHERE u.host <> ''),
h0 AS (SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS b, {_DOMAIN} AS domain FROM o GROUP BY host),
h1 AS MATERIALIZED (SELECT *, regexp_extract(domain, '(?s)^[^.]*\.?(.*)$', 1) AS suffix FROM h0),
d0 AS MATERIALIZED (SELECT suffix, domain, sum(n) AS n, sum(b) AS b FROM h1 GROUP BY ALL),
s0 AS MATERIALIZED (SELECT *, (SELECT sum(b) / sum(n) FROM d0) AS mean FROM (SELECT suffix, sum(n) AS n, sum(b) AS b FROM d0 GROUP BY suffix)),
s1 AS MATERIALIZED (SELECT suffix, (b + k * mean) / (n + k) AS mean FROM (SELECT *, {_weight("s0", "n", "b", "mean")} AS k FROM s0)),
d1 AS MATERIALIZED (SELECT d0.*, s1.mean FROM d0 JOIN s1 USING (suffix)),
d2 AS MATERIALIZED (SELECT domain, (b + k * mean) / (n + k) AS mean FROM (SELECT *, {_weight("d1", "n", "b", "mean")} AS k FROM d1)),
h2 AS MATERIALIZED (SELECT h1.*, d2.mean FROM h1 JOIN d2 USING (domain)),
h3 AS (SELECT host, k * mean + b AS p, k * (1 - mean) + n - b AS q FROM (SELECT *, {_weight("h2", "n", "b", "mean")} AS k FROM h2)),
h4 AS (SELECT host, p / (p + q) - 1.645 * sqrt((p / (p + q)) * (1 - p / (p + q)) / (p + q + 1)) AS lower FROM h3),
r(rule_host, rule_path, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(action, length(rule_host || rule_path)) AS action
  FROM (SELECT DISTINCT * FROM u) JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id, host, path)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.action, CASE WHEN lower > 0.25 THEN 'block' ELSE 'allow' END) AS verdict, round(lower, 6) AS lower
FROM u LEFT JOIN m ON u.page_id = m.page_id AND u.host = m.host AND u.path = m.path LEFT JOIN h4 ON h4.host = u.host"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP11 = rf"""
WITH d AS MATERIALIZED (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
k AS MATERIALIZED (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
l AS (SELECT lang, sum(n) AS n FROM s GROUP BY lang),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * v.v))::BIGINT AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, (1 + (1000000000::HUGEINT * (sum(c.n) + 2)) // (any_value(l.n) + 2 * any_value(v.v)))::BIGINT AS q FROM k JOIN c USING (lang, term) JOIN l USING (lang) JOIN v USING (lang) GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
  UNION ALL SELECT a.lang, a.source, 'pair', b.source, coalesce(x.value, 0) FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 10"""

#: CRC-32 of a string byte by byte, by the table of all bytes.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])))"""

OP12 = rf"""
WITH crc_table AS MATERIALIZED (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS t FROM range(256) x(i)),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS MATERIALIZED (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS w FROM (SELECT doc_id, w FROM d UNION ALL SELECT NULL, w FROM b)),
h AS MATERIALIZED (SELECT w, ({_CRC} % 10000)::INTEGER AS bucket FROM (SELECT DISTINCT w FROM f), (SELECT list(t ORDER BY i) AS tab FROM crc_table)),
n AS MATERIALIZED (SELECT doc_id, bucket, count(*) AS n FROM f JOIN h USING (w) GROUP BY ALL),
e AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE doc_id IS NOT NULL), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE doc_id IS NULL), 0)::DOUBLE AS t FROM n GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM e),
w AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight FROM n JOIN g USING (bucket) WHERE doc_id IS NOT NULL GROUP BY doc_id),
x AS (SELECT d.doc_id, len(d.w) >= 20 AS able, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN w ON w.doc_id = d.doc_id),
y AS (SELECT *, row_number() OVER (ORDER BY able DESC, score DESC, doc_id) AS place, (5 * count(*) FILTER (WHERE able) OVER ()) // 100 AS most FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= most THEN place END AS rank FROM y"""

OP13 = rf"""
WITH l AS MATERIALIZED (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS MATERIALIZED (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), {_LOWER}) AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON c.key = k.key GROUP BY doc_id"""

ORACLES = {
    "op1_quality_rules": OP1, "op3_top_k": OP3, "op4_mix": OP4, "op5_ngram_join": OP5, "op8_warc": OP8, "op9_url_filter": OP9, "op11_divergence": OP11, "op12_resample": OP12, "op13_line_dedup": OP13,
}
