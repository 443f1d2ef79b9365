"""SQL for the queries of this folder, as far as SQL can express them."""

ORACLES: dict[str, str] = {
    "op1_temporal_lists": r"""
WITH hosts AS (
  SELECT page_id, url, nullif(regexp_replace(regexp_extract(lower(url),
           '^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#\[\]@]*)', 1), '\.+$', ''), '') AS host,
         DATE '2024-01-01' + CAST(('0x' || substr(md5(url), 1, 4)) AS INTEGER) % 366 AS fetched_on
  FROM pages
), changes AS (
  SELECT regexp_replace(host, '^(www|m|blog)\.', '') AS entry, page_id AS number,
         DATE '2024-01-01' + CAST(('0x' || substr(md5('list ' || url), 1, 4)) AS INTEGER) % 366 AS day,
         CASE WHEN starts_with(url, 'https') THEN 'add' ELSE 'remove' END AS action
  FROM hosts WHERE regexp_matches(host, 'casino|bets|pills')
), latest AS (
  SELECT h.page_id, c.entry, c.action, c.day,
         row_number() OVER (PARTITION BY h.page_id, c.entry ORDER BY c.day DESC, c.number DESC) AS place
  FROM hosts h JOIN changes c
    ON (h.host = c.entry OR ends_with(h.host, '.' || c.entry)) AND c.day <= h.fetched_on
), hit AS (
  SELECT page_id, entry, day,
         row_number() OVER (PARTITION BY page_id ORDER BY length(entry) DESC, entry DESC) AS place
  FROM latest WHERE place = 1 AND action = 'add'
)
SELECT h.page_id, h.url, h.fetched_on, h.host, i.page_id IS NOT NULL AS blocked, i.entry,
       i.day AS active_since
FROM hosts h LEFT JOIN hit i ON i.page_id = h.page_id AND i.place = 1
""",
    "op11_burst_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT conv_id, strlen(text) AS bytes,
         sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text)) AS place
  FROM turns
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
               lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9 AS taken
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT conv_id, said, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth
  FROM (
    SELECT c.conv_id, 0 AS own, p.place, p.said, p.bytes
    FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.taken
    UNION ALL
    SELECT c.conv_id, 1, p.place, p.said, p.bytes
    FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.taken
  )
), paths AS (
  SELECT conv_id, depth, bytes, list(said) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, CAST([] AS VARCHAR[]) FROM convs
), lengths AS (
  SELECT conv_id, max(depth) AS total FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = total), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, depth
), children AS (
  SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), sized AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
), below AS (
  SELECT path[1:top] AS path, top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM sized) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM sized n JOIN below b ON b.top = n.depth AND b.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
""",
    "op13_filter_potential": r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT d.part, coalesce(j.good, false) AS good, coalesce(j.toxic, false) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN EXISTS (SELECT 1 FROM docs o WHERE o.text = d.text AND o.doc_id < d.doc_id) THEN 'E' ELSE '' END AS letters
  FROM docs d LEFT JOIN judged j ON j.doc_id = d.doc_id
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), gone AS (
  SELECT f.*, o.filter_order,
         length(regexp_extract(o.filter_order, '^[^' || letters || '_]*')) + 1 AS place
  FROM failed f CROSS JOIN orders o
), steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
         count(*) FILTER (place > step) AS kept,
         count(*) FILTER (place = step) AS removed,
         count(*) FILTER (place < step AND contains(letters, substr(filter_order, step, 1))) AS redundant,
         count(*) FILTER (letters = substr(filter_order, step, 1)) AS unique_fails,
         count(*) FILTER (place = step AND good) AS good_lost,
         count(*) FILTER (place = step AND toxic) AS toxic_lost
  FROM gone CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step)
  GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM steps
""",
}
