"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from lychgate.llm import ann, bpe, conversations, language, media, near_dup, packing, passages, quality, spelling, token_output, toxicity, url_rules


def queries() -> dict[str, Callable]:
    return {
        "op1_bpe": bpe.op1_bpe,
        "op2_ann": ann.op2_ann,
        "op3_packing": packing.op3_packing,
        "op4_passages": passages.op4_passages,
        "op5_language": language.op5_language,
        "op6_minhash": near_dup.op6_minhash,
        "op7_quality": quality.op7_quality,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_token_output": token_output.op9_token_output,
        "op10_ogg_media": media.op10_ogg_media,
        "op11_url_rules": url_rules.op11_url_rules,
        "op12_conversations": conversations.op12_conversations,
        "op13_spelling": spelling.op13_spelling,
    }


#: Near-duplicate groups by all pairs that share a shingle; regular expressions with the words' separators.
OP6_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(a) = 0 THEN []::VARCHAR[] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
         ELSE list_distinct(list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' '))) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
c AS MATERIALIZED (
  SELECT p.doc_id AS i, q.doc_id AS j FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY 1, 2
  HAVING 100 * count(*) >= 85 * (any_value(p.n) + any_value(q.n) - count(*))),
b AS MATERIALIZED (SELECT i, j FROM c UNION ALL SELECT j, i FROM c),
r AS (SELECT DISTINCT i, i AS j FROM b UNION SELECT r.i, b.j FROM r JOIN b ON r.j = b.i)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id, coalesce(m.component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN (SELECT i, min(j) AS component_id FROM r GROUP BY 1) m ON m.i = s.doc_id
"""


#: Every address against every rule; the host's or a parent's rule whose path begins the address' path.
OP11_SQL = r"""
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t AS (
  SELECT DISTINCT p.host, p.path, r.host || r.path AS rule, r.verdict, length(r.host || r.path) AS n, length(r.host) AS m
  FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
b AS (SELECT host, path, rule, verdict FROM t QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY n DESC, m DESC) = 1)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path
"""

#: The unsigned CRC-32 of a text in UTF-8, by a table of 256 remainders that a rule makes: {0} is the text, t.c the table.
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)), lambda a, b: xor(a >> 8, t.c[xor(a, b) % 256 + 1])), 4294967295)"
CRC_TABLE = """
  SELECT list(c ORDER BY i) AS c FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))
"""

#: Every conversation's cheapest audits spelt out, row by row, for each of four states.
OP12_SQL = (
    r"""
WITH RECURSIVE t AS MATERIALIZED (""" + CRC_TABLE + r"""),
r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
k AS MATERIALIZED (SELECT r.* EXCLUDE (k), """ + CRC.format("k") + r""" % 20 AS kind FROM r, t),
d AS MATERIALIZED (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
n AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, regexp_replace(text, '[ 	-
]+$', '') AS bare FROM d),
f AS MATERIALIZED (
  SELECT *, left(role, 1) AS a, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM n),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (b IS NOT NULL AND a || b NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM (SELECT *, lead(a) OVER (PARTITION BY conv_id ORDER BY i) AS b FROM f) GROUP BY conv_id),
step(q, a, p) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(q, m, p, cost) AS (VALUES (0, '', 0, 0), (1, '', 1, 0), (2, '', 2, 0), (3, '', 3, 0), (0, 'I', 2, 5), (1, 'I', 2, 5), (2, 'I', 3, 5), (3, 'I', 2, 5), (0, 'II', 3, 10), (1, 'II', 3, 10), (2, 'II', 2, 10), (3, 'II', 3, 10)),
edit AS (
  SELECT q, m || 'D' AS m, NULL AS a, p, cost + 2 AS cost, true AS gone FROM ins
  UNION ALL SELECT ins.q, m || 'K', a, step.p, cost, false FROM ins JOIN step ON ins.p = step.q
  UNION ALL SELECT ins.q, m || 'R', NULL, step.p, cost + 1, false FROM ins JOIN step ON ins.p = step.q WHERE a <> 's'),
g AS (
  SELECT c.conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': ''} AS x FROM c
  UNION ALL
  SELECT conv_id, i, q, min(x) FROM (
    SELECT g.conv_id, f.i, edit.p AS q, {'cost': g.x.cost + edit.cost + CASE WHEN gone OR f.fault <> 'truncated' THEN 0 ELSE 5 END, 'audit': g.x.audit || edit.m} AS x
    FROM g JOIN f ON g.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = g.i + 1 JOIN edit ON edit.q = g.q AND (edit.a IS NULL OR edit.a = f.a) AND (gone OR f.fault NOT IN ('blank', 'duplicate')))
  GROUP BY conv_id, i, q),
e AS MATERIALIZED (
  SELECT c.conv_id, min({'cost': g.x.cost + CASE g.q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, 'audit': g.x.audit || CASE g.q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS x
  FROM c JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id AND g.i = c.n GROUP BY c.conv_id),
l AS (SELECT conv_id, unnest(string_split(x.audit, '')) AS m, generate_subscripts(string_split(x.audit, ''), 1) AS place FROM e WHERE x.audit <> ''),
o AS (SELECT *, count(*) FILTER (m <> 'I') OVER w AS i, count(*) FILTER (m <> 'D') OVER w AS j FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
w AS (
  SELECT o.conv_id, o.j, o.m, f.role, CASE WHEN o.m = 'I' THEN '' ELSE f.text END AS text, max(o.j = 1 AND o.m = 'K' AND f.a = 's') OVER (PARTITION BY o.conv_id) AS s
  FROM o LEFT JOIN f ON o.conv_id IS NOT DISTINCT FROM f.conv_id AND o.i = f.i AND o.m <> 'I' WHERE o.m <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN m = 'K' THEN role WHEN (j - s::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j)) AS h FROM w GROUP BY conv_id)
SELECT v.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       coalesce(e.x.cost, 0)::BIGINT AS cost, coalesce(e.x.audit, '') AS audit, coalesce(h.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN c ON v.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN e ON v.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN h ON v.conv_id IS NOT DISTINCT FROM h.conv_id
"""
)

#: Near words by what is left when a code point is left out; roots by following forms.
OP13_SQL = (
    r"""
WITH RECURSIVE t AS MATERIALIZED (""" + CRC_TABLE + r"""),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
d AS MATERIALIZED (SELECT run, d || ':' || run AS k, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY d, run),
h AS MATERIALIZED (SELECT run, n, """ + CRC.format("k") + r""" AS h FROM d, t),
v AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
l AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS s FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS near, b.n FROM l a JOIN l b ON a.i = b.i AND a.s = b.s AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM l JOIN w ON l.s = w.word UNION SELECT w.word, l.word, l.n FROM l JOIN w ON l.s = w.word),
b AS (SELECT word, count(*) AS n_near, min({'n': -n, 'near': near}) AS x FROM p GROUP BY word),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.x.n >= 2 * w.n THEN b.x.near END AS form, CASE WHEN -b.x.n >= 2 * w.n THEN -b.x.n END AS form_n FROM w LEFT JOIN b ON w.word = b.word),
u AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT u.word, f.word, f.form FROM u JOIN f ON u.next = f.word)
SELECT f.word, f.form, u.root, f.n, f.n_near, f.form_n FROM f JOIN u ON f.word = u.word AND u.next IS NULL
"""
)


def oracle_sql() -> dict[str, str]:
    """The other operators tokenize, fit models, or store forms that SQL cannot make."""
    return {"op6_minhash": OP6_SQL, "op11_url_rules": OP11_SQL, "op12_conversations": OP12_SQL, "op13_spelling": OP13_SQL}
