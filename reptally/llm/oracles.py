"""DuckDB SQL of the queries that SQL can express; the tests hold the others against brute force."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op9_ngram_decontamination": f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark
), grams AS (
  SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT n FROM grams
), windows AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT d.r, d.ws, sizes.n, unnest(range(1, len(d.ws) - sizes.n + 2)) AS i FROM d JOIN sizes ON len(d.ws) >= sizes.n)
), found AS (
  SELECT windows.r, windows.n, windows.i, grams.item FROM windows JOIN grams ON windows.n = grams.n AND windows.g = grams.g
), hit AS (
  SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS w FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(named.n_items, 0) AS n_items,
       sha256(coalesce(named.items, '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.r = hit.r LEFT JOIN named ON d.r = named.r
""",
    "op10_warc_capture_index": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to
FROM m
""",
    "op12_filter_interaction_audit": """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS least FROM d GROUP BY t
), w AS (
  SELECT d.doc_id, d.part, d.t, coalesce(d.doc_id > firsts.least, false) AS copy, regexp_extract_all(d.t, '[^\\x20\\x09-\\x0D]+') AS ws
  FROM d JOIN firsts ON d.t = firsts.t
), masks AS (
  SELECT doc_id, part, CAST(len(ws) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INT)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(copy AS INT) AS mask
  FROM w
), ruled AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masks LEFT JOIN ruled ON masks.doc_id = ruled.doc_id GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), walk AS (
  SELECT '' AS prefix, 0 AS applied, '' AS letter, 0 AS bit, 0 AS before, 0 AS step
  UNION ALL
  SELECT prefix || l.letter, applied | l.bit, l.letter, l.bit, applied, step + 1 FROM walk, letters l WHERE applied & l.bit = 0
), steps AS (
  SELECT part, prefix, letter, step,
    sum(CASE WHEN mask & applied = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, walk WHERE step > 0 GROUP BY part, prefix, letter, step
), every AS (
  SELECT steps.*, o.prefix AS filter_order FROM steps JOIN walk o ON o.step = 5 AND o.prefix[1:steps.step] = steps.prefix
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM every
""",
    # bit by bit, as DuckDB has no CRC-32
    "op13_conversation_prefix_trie": """
WITH t AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(h ORDER BY turn NULLS FIRST, h) AS hs, list(w ORDER BY turn NULLS FIRST, h) AS ws, CAST(conv_id AS VARCHAR) AS s FROM t GROUP BY conv_id
), crc AS (
  SELECT conv_id, hs, ws, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, length(s) + 1), lambda i: list_transform(range(8), lambda k: CAST((ascii(s[i]) >> k) & 1 AS BIGINT))))),
    lambda crc, b: xor(crc >> 1, CASE WHEN xor(crc, b) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 4 AS n
  FROM own
), whole AS (
  SELECT crc.conv_id, list_concat(coalesce(head.hs[1:crc.n], []), crc.hs[crc.n + 1:]) AS hs, list_concat(coalesce(head.ws[1:crc.n], []), crc.ws[crc.n + 1:]) AS ws
  FROM crc LEFT JOIN own head ON head.conv_id = crc.conv_id - crc.conv_id % 20
), each AS (
  SELECT conv_id, d, hs[1:d] AS prefix, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w, len(hs) = d AS ends
  FROM (SELECT conv_id, hs, ws, unnest(range(0, len(hs) + 1)) AS d FROM whole)
), nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM each GROUP BY prefix, d
), kids AS (
  SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), paths AS (
  SELECT n.prefix[1:k] AS prefix, n.n_convs, n.w, kids.n IS NULL AS leaf
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM nodes) n LEFT JOIN kids ON kids.prefix = n.prefix
), under AS (
  SELECT prefix, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * w) AS saved FROM paths GROUP BY prefix
)
SELECT nodes.conv_id, nodes.d AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(kids.n, 0) AS n_children, under.n_leaves,
       CAST(under.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN under ON under.prefix = nodes.prefix LEFT JOIN kids ON kids.prefix = nodes.prefix
LEFT JOIN nodes above ON nodes.d > 0 AND above.d = nodes.d - 1 AND above.prefix = nodes.prefix[1:nodes.d - 1]
""",
}
