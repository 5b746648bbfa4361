"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Words of a text, as the contracts define them.
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

#: Distinct five-word shingles (or the whole short text) of each document.
SHINGLES = f"""
words AS (SELECT doc_id, {WORDS.format(_LOWER)} AS w FROM documents),
pieces AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
shingle AS (SELECT DISTINCT doc_id, s FROM pieces),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id)"""

OP2 = f"""
WITH RECURSIVE {SHINGLES},
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
           FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id, d.doc_id = m AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""


OP3 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM p),
o AS (SELECT h, max(page_id) AS last FROM d WHERE n >= 1000 GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM d LEFT JOIN o USING (h)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {WORDS.format(_LOWER)} AS w FROM documents),
b AS (SELECT item_id, {WORDS.format(_LOWER)} AS w FROM benchmark),
item AS (SELECT DISTINCT item_id, least(len(w), 5) AS k,
                unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s
         FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
piece AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
          FROM d, (SELECT DISTINCT k FROM item) WHERE len(w) >= k)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, count(*)::BIGINT AS n_shared
FROM piece JOIN item USING (k, s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 75 * n_item
"""

OP5 = f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")})::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')) AS digest FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM per),
-- the level at which all sources, cut at twice their size, give 150 % of all words
tried AS (SELECT x.source, 2 * x.source_size / x.weight AS ratio,
                 (1.5 * (SELECT sum(source_size) FROM weighed)
                  - coalesce(sum(2 * y.source_size) FILTER (2 * y.source_size / y.weight < 2 * x.source_size / x.weight), 0))
                 / sum(y.weight) FILTER (2 * y.source_size / y.weight >= 2 * x.source_size / x.weight) AS level
          FROM weighed x, weighed y GROUP BY ALL),
final AS (SELECT arg_min(level, ratio) AS level FROM tried WHERE level <= ratio),
plan AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight)::DOUBLE AS target,
                ('0x' || substr(md5('0/' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
         FROM weighed, final),
placed AS (
  SELECT sized.*, row_number() OVER (PARTITION BY source ORDER BY
         lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 1, 4), digest, doc_id, size) AS i FROM sized),
drawn AS (SELECT p.doc_id, p.size, q.source_size, q.target, q.shift, p.i,
                 CASE WHEN q.source_size > 0 THEN q.target / q.source_size ELSE 0.0::DOUBLE END AS e
          FROM placed p JOIN plan q ON p.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (size * (floor(e * i + shift) - floor(e * (i - 1) + shift)))::BIGINT AS taken FROM drawn
"""

#: Table-driven CRC-32: the 256 entries come from eight shift steps each.
_CRC = """
crc_table AS (
  SELECT list(list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, s: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n))"""

OP8 = f"""
WITH {_CRC},
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))::BIGINT AS text_crc32
  FROM documents, crc_table),
run AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
               sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, ((2 * upto - size) * 24 // (2 * total))::INT AS shard FROM run)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, NULL::INT AS grown_shard
FROM cut
"""

_LEDGER = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, range(3) r(k) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '\p{{L}}'))::BIGINT AS n_letters,
         len(regexp_extract_all(t, '\p{{Lu}}'))::BIGINT AS n_upper, len(regexp_extract_all(t, '!'))::BIGINT AS n_exclaims
  FROM d LEFT JOIN rep USING (doc_id)),
k AS (SELECT * EXCLUDE (l), len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines FROM m),
f AS (SELECT *, (1 * (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 30 * n_words)::INT
                 + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 15 * n_words)::INT
                 + 64 * (100 * n_upper > 60 * n_letters)::INT + 128 * (100 * n_exclaims > 50 * n_words)::INT)::BIGINT AS fail_bits FROM k)
"""

OP9 = _LEDGER + """
SELECT *, (fail_bits & 3) <> 0 AS base_failed, 'v2' AS policy, fail_bits AS policy_bits,
       CASE WHEN bit_count(fail_bits) = 1 THEN fail_bits ELSE 0 END::BIGINT AS sole_bit, fail_bits = 0 AS kept
FROM f
"""

ABLATION = _LEDGER + """
SELECT rule, count(*) FILTER ((fail_bits & bit) <> 0) AS failed, count(*) FILTER (fail_bits = bit) AS only_this,
       count(*) FILTER ((fail_bits & ~bit) = 0) AS kept_without
FROM (SELECT unnest(['few_words', 'repeated_windows', 'symbols', 'duplicate_lines', 'short_words', 'long_words', 'upper_case',
                     'exclamations']) AS rule, unnest([1, 2, 4, 8, 16, 32, 64, 128])::BIGINT AS bit) LEFT JOIN f ON true
GROUP BY rule
"""

#: A text's words (lower-cased ASCII) as the resampling contract defines them, and CRC-32 of each distinct one.
OP12 = rf"""
WITH {_CRC},
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
corpus AS (SELECT doc_id, unnest(w) AS word FROM d),
target AS (SELECT unnest(w) AS word FROM q),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda b: ('0x' || b)::BIGINT)),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 10000 AS bucket
  FROM (SELECT word FROM corpus UNION SELECT word FROM target), crc_table),
s AS (SELECT bucket, count(*) AS n FROM corpus JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket),
gain AS (
  SELECT b AS bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM corpus) + 10000)::DOUBLE)
                            / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000)::DOUBLE)))::BIGINT AS g
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
m AS (SELECT doc_id, floor(avg(g))::BIGINT AS weight FROM corpus JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN m USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
           FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

OP13 = f"""
WITH {_CRC},
own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shared AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda b: ('0x' || b)::BIGINT)),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 9 AS h
  FROM own, crc_table),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:h], c.turns[h + 1:]) AS turns
  FROM shared c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefix AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM whole),
node AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len(turns)), '') AS ends
  FROM prefix GROUP BY ALL),
child AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
own_value AS (
  SELECT node.path, depth, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(node.path[depth].text)) END AS saved
  FROM node LEFT JOIN child USING (path)),
above AS (SELECT path, n_children, saved, unnest(range(depth + 1)) AS upto FROM own_value),
subtree AS (SELECT path[1:upto] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
            FROM above GROUP BY ALL)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN own_value USING (path) JOIN subtree USING (path)
LEFT JOIN node parent ON node.depth > 0 AND parent.path = node.path[1:node.depth - 1]
"""

ORACLE = {
    "op2_minhash_near_duplicates": OP2,
    "op3_warc_revisits": OP3,
    "op4_decontamination": OP4,
    "op5_mixing": OP5,
    "op8_sharding": OP8,
    "op9_quality_rules": OP9,
    "op12_importance_resampling": OP12,
    "op13_prefix_trie": OP13,
    "quality_ablation": ABLATION,
}
