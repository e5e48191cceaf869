"""DuckDB SQL for the operators that SQL can express in reasonable time."""

ORACLES = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), last AS (
  SELECT html, max(page_id) AS response FROM p WHERE n >= 1000 GROUP BY html
)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN last ON p.html = last.html AND n >= 1000
""",
    "op9_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, rid, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS parts
        FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT keyed.*, coalesce(keeper <> doc_id, false) AS dropped FROM keyed LEFT JOIN shared USING (k)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY rid
""",
    "op12_conversation_trie": """
WITH said AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS number,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
), ids AS (
  -- CRC-32 of the decimal id: each character is mixed in, then eight shifts
  SELECT conv_id, list_reduce(
    flatten([[4294967295::HUGEINT], flatten(list_transform(
      range(1, length(conv_id::VARCHAR) + 1),
      lambda i: [ascii(substr(conv_id::VARCHAR, i::INT, 1))::HUGEINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
                      WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::HUGEINT) ELSE c // 2 END) AS c
  FROM (SELECT DISTINCT conv_id FROM conversations)
), heirs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS donor, xor(c, 4294967295::HUGEINT) % 9 AS h FROM ids
), rebuilt AS (
  SELECT heirs.conv_id, 0 AS part, number, role, text
  FROM heirs JOIN said ON said.conv_id = donor AND number <= h
  UNION ALL
  SELECT conv_id, 1, number, role, text FROM heirs JOIN said USING (conv_id) WHERE number > h
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, number) AS depth, text,
         md5(length(role) || ':' || role || text) AS unit
  FROM rebuilt
), paths AS (
  SELECT conv_id, depth, strlen(text) AS size,
         md5(string_agg(unit, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
  FROM placed
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM ids
), members AS (
  SELECT *, max(depth) OVER (PARTITION BY conv_id) = depth AS ending,
         lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS above
  FROM paths
), nodes AS (
  SELECT node, any_value(above) AS above, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ending), '')) AS ends_sha256
  FROM members GROUP BY node
), children AS (
  SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
), below AS (
  SELECT paths.node, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM nodes LEFT JOIN children USING (node)
  JOIN paths ON paths.conv_id = nodes.conv_id AND paths.depth <= nodes.depth
  GROUP BY paths.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.above LEFT JOIN children c ON c.node = n.node
JOIN below ON below.node = n.node
""",
    "op13_chat_format": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       -- a turn has 32 characters of control strings; a bar is added to each run of bars behind <
       CAST(sum(32 + length(regexp_replace(role, '<([|]+)', '<|\1', 'g'))
                   + length(regexp_replace(text, '<([|]+)', '<|\1', 'g'))) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
""",
}
