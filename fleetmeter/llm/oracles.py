"""The results of the queries as DuckDB SQL, where SQL can state them."""

ORACLES: dict[str, str] = {}

# Words as the contract has them, with the position of each.
_WORDS = """
regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

ORACLES["op10_benchmark_decontamination"] = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("text")} AS w
               FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, len(w) AS n, unnest([w]) AS v FROM items WHERE len(w) BETWEEN 1 AND 12
  UNION ALL
  SELECT DISTINCT item_id, 13 AS n, w[i : i + 12] AS v
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM items WHERE len(w) >= 13)),
widths AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
places AS (
  SELECT doc_id, n, i, w[i : i + n - 1] AS v
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, widths WHERE len(w) >= n)),
found AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x USING (n, v)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

# Brute force over all pairs of texts that share a shingle.
ORACLES["op3_ngram_jaccard_join"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, trim(coalesce(text, '')) AS t, coalesce({_WORDS.format("text")}, []) AS w
  FROM documents WHERE doc_id IS NOT NULL),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
      THEN list_sort(list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] WHEN t <> '' THEN ['=' || t] ELSE [] END AS s
  FROM docs),
classes AS (SELECT s, min(doc_id) AS text_class, count(*) AS copies FROM sets
            WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT text_class AS c, len(s) AS n, unnest(s) AS token FROM classes),
common AS (SELECT a.c AS a, b.c AS b, a.n + b.n AS n, count(*) AS shared
           FROM tokens a JOIN tokens b ON a.token = b.token AND a.c <> b.c GROUP BY 1, 2, 3),
links AS (SELECT a, b FROM common WHERE 10 * shared >= 8 * (n - shared)),
reach AS (SELECT text_class AS c, text_class AS r FROM classes
          UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.r),
roots AS (SELECT c, min(r) AS class_id FROM reach GROUP BY c),
counts AS (SELECT a AS c, sum(copies) AS n FROM links JOIN classes ON b = text_class GROUP BY a)
SELECT doc_id, coalesce(text_class, doc_id) AS text_class, coalesce(class_id, doc_id) AS class_id,
       CAST(coalesce(copies - 1, 0) + coalesce(n, 0) AS BIGINT) AS n_links
FROM sets LEFT JOIN classes ON sets.s = classes.s AND len(sets.s) > 0
LEFT JOIN roots ON roots.c = text_class LEFT JOIN counts ON counts.c = text_class"""


def _draw(node: str, weight: str) -> str:
    """-ln(u) / weight from the first 52 bits of the hash of key and node."""
    digits = f"substr(md5(k || '|' || {node}), 1, 13)"
    return f"-ln((CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) / {weight}"


# CRC-32 over half bytes, low half first, with a table of 16 entries made here.
_CRC = """
table_ AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0],
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM range(16) r(i))),
halves AS (SELECT doc_id, size, list_transform(string_split(hex(b), ''),
    lambda c: CAST(strpos('0123456789ABCDEF', c) - 1 AS BIGINT)) AS h
  FROM (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(b) + 1 AS size FROM documents)),
sums AS (SELECT doc_id, size, CASE WHEN size = 1 THEN 0 ELSE xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)],
      flatten(list_transform(range(1, len(h), 2), lambda j: [h[j + 1], h[j]]))),
    lambda a, x: xor(a >> 4, t[(xor(a, x) & 15) + 1]))) END AS text_crc32
  FROM halves, table_)"""

ORACLES["op2_sharding"] = f"""
WITH {_CRC},
keys AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM sums),
racks AS (SELECT 'region' || a AS region, 'region' || a || '/rack' || b AS rack
          FROM range(4) x(a), range(2) y(b)),
leaves AS (SELECT rack, rack || '/' || (CAST(region[7:] AS INT) * 4 + CAST(rack[-1:] AS INT) * 2 + c)
             AS leaf FROM racks, range(2) z(c)),
ids AS (SELECT DISTINCT k FROM keys),
region AS (SELECT k, arg_min(region, {_draw("region", "4.0")}) AS region
           FROM ids, (SELECT DISTINCT region FROM racks) GROUP BY k),
rack AS (SELECT k, arg_min(rack, {_draw("rack", "2.0")}) AS rack
         FROM region JOIN racks USING (region) GROUP BY k),
leaf AS (SELECT k, arg_min(leaf, {_draw("leaf", "1.0")}) AS leaf
         FROM rack JOIN leaves USING (rack) GROUP BY k),
grown AS (SELECT k, {_draw("'single16'", "1.0")} < min({_draw("region", "4.0")}) AS moves
          FROM ids, (SELECT DISTINCT region FROM racks) GROUP BY k),
placed AS (SELECT keys.*, CAST(string_split(leaf, '/')[3] AS INT) AS shard, moves
           FROM keys JOIN leaf USING (k) JOIN grown USING (k))
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CASE WHEN moves THEN 16 ELSE shard END AS grown_shard
FROM placed"""

# Every order applied to every document.
ORACLES["op13_filter_interaction_audit"] = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
marks AS (
  SELECT doc_id, part, {
    'A': len(w) < 200,
    'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS fails FROM words),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B
      WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END) AS f
  FROM marks LEFT JOIN known USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step, filter_order[step] AS own FROM orders),
counted AS (
  SELECT part, filter_order, step, own,
    count(*) FILTER (first_at > step) AS kept, count(*) FILTER (first_at = step) AS removed,
    count(*) FILTER (list_contains(f, own) AND first_at < step) AS redundant,
    count(*) FILTER (f = [own]) AS unique_fails,
    count(*) FILTER (first_at = step AND good) AS good_lost,
    count(*) FILTER (first_at = step AND toxic) AS toxic_lost
  FROM (SELECT *, coalesce(list_min(list_transform(f, lambda x: strpos(filter_order, x))), 6) AS first_at
        FROM failed, steps) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails,
  good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted"""

# The level is the least one that fits; the words of a source are the first of its stream.
ORACLES["op12_source_mix"] = """
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15)
         AS BIGINT) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size) AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sizes GROUP BY source),
rising AS (
  SELECT *, (SELECT sum(s) FROM sources) - coalesce(sum(3 * s) OVER before, 0) AS budget,
    (SELECT sum(w) FROM sources) - coalesce(sum(w) OVER before, 0) AS left_weight
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT budget, left_weight FROM rising WHERE budget * w <= 3 * s * left_weight
          ORDER BY left_weight DESC LIMIT 1),
targets AS (
  SELECT source, CAST(s AS BIGINT) AS source_size, 3 * s * left_weight < budget * w AS is_full,
    CASE WHEN is_full THEN CAST(3 * s AS DOUBLE) ELSE CAST(budget AS DOUBLE) * w / left_weight END AS target,
    CAST(CASE WHEN is_full THEN 3 * s ELSE (2 * budget * w + left_weight) // (2 * left_weight) END AS BIGINT) AS quota
  FROM sources, level),
streams AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM sizes)
SELECT doc_id, size, source_size, target,
  CAST(list_sum([greatest(0, least(quota - e * source_size - begins, size)) FOR e IN [0, 1, 2]]) AS BIGINT) AS taken
FROM streams JOIN targets ON streams.source IS NOT DISTINCT FROM targets.source"""

# All parses of all conversations row by row, with their letters and lines written out.
ORACLES["op11_conversation_repair"] = """
WITH RECURSIVE table_ AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0],
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM range(16) r(i))),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
halves AS (SELECT k, list_transform(string_split(hex(encode(k)), ''),
    lambda c: CAST(strpos('0123456789ABCDEF', c) - 1 AS BIGINT)) AS h FROM (SELECT DISTINCT k FROM given)),
faults AS (SELECT k, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      flatten(list_transform(range(1, len(h), 2), lambda j: [h[j + 1], h[j]]))),
    lambda a, x: xor(a >> 4, t[(xor(a, x) & 15) + 1]))) % 20 AS fault FROM halves, table_),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given JOIN faults USING (k), range(2) c(copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)),
placed AS (SELECT *, row_number() OVER rows_ AS pos, lag(role[1]) OVER rows_ AS before,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink
  FROM damaged WINDOW rows_ AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
rows_ AS (SELECT *, CASE WHEN ink = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
inserts AS (FROM (VALUES ('', '', '', ''), ('', 'I', 'u', 'user:\n'), ('', 'II', 'x', 'user:\nassistant:\n'),
  ('s', '', 's', ''), ('s', 'I', 'u', 'user:\n'), ('s', 'II', 'x', 'user:\nassistant:\n'),
  ('u', '', 'u', ''), ('u', 'I', 'x', 'assistant:\n'), ('x', '', 'x', ''), ('x', 'I', 'u', 'user:\n')
  ) v(old, letters, mid, lines)),
shifts AS (FROM (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'x'), ('x', 'u', 'u')
  ) v(mid, initial, new)),
moves AS (
  SELECT old, letters || 'K' AS letters, new, 5 * len(letters) AS cost, initial, NULL AS role, lines
  FROM inserts JOIN shifts USING (mid)
  UNION ALL SELECT old, letters || 'R', new, 5 * len(letters) + 1, NULL,
    CASE initial WHEN 'u' THEN 'user' ELSE 'assistant' END, lines
  FROM inserts JOIN shifts USING (mid) WHERE initial <> 's'
  UNION ALL SELECT old, 'D', old, 2, NULL, NULL, NULL FROM (VALUES (''), ('s'), ('u'), ('x')) v(old)),
parses AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, '' AS top,
    {'cost': CAST(0 AS BIGINT), 'letters': '', 'lines': ''} AS best FROM conversations
  UNION ALL
  SELECT p.conv_id, p.pos + 1, m.new, min({
    'cost': p.best.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.letters <> 'D' THEN 5 ELSE 0 END,
    'letters': p.best.letters || m.letters,
    'lines': p.best.lines || CASE m.letters WHEN 'D' THEN ''
      ELSE m.lines || coalesce(m.role, r.role) || ':' || r.text || chr(10) END})
  FROM parses p JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos + 1
  JOIN moves m ON m.old = p.top AND (m.initial IS NULL OR m.initial = r.role[1])
    AND (m.letters = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY p.conv_id, p.pos, m.new),
ends AS (
  SELECT conv_id, min({
    'cost': best.cost + 5 * len(i.letters), 'letters': best.letters || i.letters, 'lines': best.lines || i.lines}) AS best
  FROM parses JOIN inserts i ON i.old = parses.top AND i.mid IN ('', 'x')
  WHERE pos = coalesce((SELECT max(pos) FROM rows_ r WHERE r.conv_id IS NOT DISTINCT FROM parses.conv_id), 0)
  GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost,
  best.letters AS audit, sha256(CASE WHEN best.lines = '' THEN '' ELSE left(best.lines, length(best.lines) - 1) END) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""
