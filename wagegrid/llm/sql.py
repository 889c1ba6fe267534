"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op9_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), e AS (
  SELECT *,
    length(regexp_replace(replace(text, '\', '\s'), '<(/?turn|part)', '\\l\1', 'g')) AS text_len,
    length(replace(regexp_replace(replace(role, '\', '\s'), '<(/?turn|part)', '\\l\1', 'g'),
                   '>', '\g')) AS role_len
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + role_len + text_len) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM e GROUP BY conv_id
"""

ORACLES["op3_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, encode(coalesce(html, '')) AS payload FROM pages
), g AS (
  SELECT payload, max(page_id) AS first FROM p WHERE octet_length(payload) >= 1000
  GROUP BY payload
)
SELECT p.page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes,
  sha1(p.payload) AS payload_digest,
  CASE WHEN p.page_id <> g.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.page_id <> g.first THEN g.first END AS refers_to, p.url
FROM p LEFT JOIN g ON p.payload = g.payload
"""

ORACLES["op11_lexical_search"] = r"""
WITH found AS (
  SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (
  SELECT doc, doc_id, term, count(*) AS tf FROM found GROUP BY ALL
), n AS (
  SELECT doc, sum(tf)::BIGINT AS n FROM tf GROUP BY doc
), whole AS (
  SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM n
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc, doc_id,
    sum(CAST(floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN n USING (doc) JOIN df USING (term), whole
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

# CRC-32 bit by bit, as SQL has no such function.
ORACLES["op13_prefix_trie"] = r"""
WITH RECURSIVE ids AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT conv_id, s, 0 AS i, 4294967295::BIGINT AS r FROM ids
  UNION ALL
  SELECT conv_id, s, i + 1, xor(x >> 1, (CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)
  FROM (SELECT conv_id, s, i, CASE WHEN i % 8 = 0 THEN xor(r, ascii(s[i // 8 + 1])::BIGINT) ELSE r END AS x
        FROM crc WHERE i < 8 * length(s))
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(r, 4294967295::BIGINT) % 4 AS h
  FROM crc WHERE i = 8 * length(s)
), numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                       sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), mixed AS (
  SELECT c.conv_id, 0 AS src, pos, role, text FROM convs c JOIN numbered n ON n.conv_id = c.base
  WHERE pos <= h
  UNION ALL
  SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id WHERE pos > h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY src, pos) AS depth,
    sha256(length(role) || ':' || role || text) AS content,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM mixed
), paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0::BIGINT AS words FROM convs
  UNION ALL
  SELECT conv_id, depth, string_agg(content, '') OVER (PARTITION BY conv_id ORDER BY depth), words FROM turns
), named AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS top,
    depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS (
  SELECT top, depth, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM named GROUP BY top, depth
), family AS (
  SELECT DISTINCT u.top AS top, u.depth AS depth, p.top AS parent
  FROM named u JOIN named p ON p.conv_id = u.conv_id AND p.depth = u.depth - 1
), kids AS (
  SELECT parent AS top, depth - 1 AS depth, count(*) AS n_children FROM family GROUP BY ALL
), below AS (
  SELECT DISTINCT a.top, a.depth, d.top AS under, d.depth AS under_depth
  FROM named a JOIN named d ON d.conv_id = a.conv_id AND d.depth >= a.depth
), sums AS (
  SELECT b.top, b.depth, sum((k.n_children IS NULL)::BIGINT)::BIGINT AS n_leaves,
    sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens
  FROM below b JOIN nodes n ON n.top = b.under AND n.depth = b.under_depth
  LEFT JOIN kids k ON k.top = b.under AND k.depth = b.under_depth GROUP BY ALL
)
SELECT n.top AS conv_id, n.depth::BIGINT AS depth, f.parent AS parent_conv_id, n.n_convs,
  coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (top, depth) LEFT JOIN kids k USING (top, depth)
LEFT JOIN family f USING (top, depth)
"""

_ROUNDS = "".join(rf"""
, s{k} AS MATERIALIZED (
  SELECT kind, host, CAST(sum(part) // 20 AS BIGINT) AS score FROM (
    SELECT kind, host, 3 * mass AS part FROM seeds
    UNION ALL
    SELECT a.kind, a.tail, 17 * ((s.score::HUGEINT * a.links) // t.total) FROM s{k - 1} s
    JOIN arcs a ON a.kind = s.kind AND a.head = s.host
    JOIN totals t ON t.kind = s.kind AND t.head = s.host
  ) GROUP BY kind, host
)""" for k in range(1, 13))

ORACLES["op12_url_filters"] = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), cut AS (
  SELECT row_number() OVER () AS r, page_id, html,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT r, page_id, html, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), rows_ AS (
  SELECT r, page_id, html,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
), fit AS (
  SELECT p.r, u.host || u.path AS rule, u.verdict,
    row_number() OVER (PARTITION BY p.r ORDER BY length(u.host || u.path) DESC) AS place
  FROM rows_ p JOIN rules u ON (p.host = u.host OR ends_with(p.host, '.' || u.host))
    AND starts_with(p.path, u.path)
), judged AS (
  SELECT p.*, f.rule, f.verdict FROM rows_ p LEFT JOIN fit f ON f.r = p.r AND f.place = 1
), seeds AS (
  SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host,
    count(*) * 1000000 AS mass
  FROM judged WHERE verdict IS NOT NULL AND host <> '' GROUP BY ALL
), found AS (
  SELECT host AS source, translate(unnest(regexp_extract_all(html,
    '(?i)href[ \t\r\n]*=[ \t\r\n]*["'']?[ \t\r\n]*(?:https?:)?//([^/?#"''<> \t\r\n]+)', 1)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
  FROM rows_ WHERE host <> ''
), edges AS (
  SELECT source, target, count(*) AS links FROM found WHERE source <> target GROUP BY ALL
), arcs AS (
  SELECT 'trust' AS kind, source AS head, target AS tail, links FROM edges
  UNION ALL SELECT 'distrust', target, source, links FROM edges
), totals AS (
  SELECT kind, head, sum(links) AS total FROM arcs GROUP BY ALL
), s0 AS (
  SELECT kind, host, mass AS score FROM seeds
)""" + _ROUNDS + """
, bad AS (
  SELECT host FROM s12 GROUP BY host
  HAVING sum(CASE kind WHEN 'distrust' THEN score ELSE -score END) > 0
)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.verdict, CASE WHEN b.host IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM judged j LEFT JOIN bad b ON b.host = j.host
"""
