"""DuckDB SQL twins of the corpus queries that SQL can express."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"
# DuckDB's trim takes the characters themselves.
TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def spaced(text: str) -> str:
    """Words between ASCII white space."""
    return rf"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda x: x <> '')"


def plain(text: str) -> str:
    """Lower-cased words of letters, digits and characters beyond ASCII."""
    return rf"regexp_extract_all({LOWER.format(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP2 = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
g AS (SELECT h, n, max(page_id) AS top, count(*) AS c FROM p WHERE n >= 1000 GROUP BY h, n)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN c > 1 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN c > 1 AND page_id <> top THEN top END AS refers_to, true AS intact
FROM p LEFT JOIN g USING (h, n)
"""

OP3 = f"""
WITH d AS (SELECT doc_id, {plain("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, {plain("coalesce(text, '')")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS body
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS body
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, item_id, n, k FROM places JOIN windows USING (n, body)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS l FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(l), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = f"""
WITH d AS (SELECT doc_id, source, {spaced("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {TRIM}) <> '') AS l, text FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k:k + 7], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS k FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, body FROM win GROUP BY ALL HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS c
  FROM (SELECT doc_id, unnest(range(k, k + 8)) AS p FROM win JOIN twice USING (doc_id, body)) GROUP BY doc_id),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeated USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS f1, 100 * n_symbols > 10 * n_words AS f2,
    100 * n_dup_lines > 30 * n_lines AS f3, word_chars < 2 * n_words OR word_chars > 15 * n_words AS f4 FROM m),
h AS (SELECT source, rule, count(*)::DOUBLE AS n, sum(fail::INT)::DOUBLE AS k
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS fail FROM f) GROUP BY ALL),
t AS (SELECT rule, count(*) AS hosts, sum(n) AS docs, sum(n * n) AS sq, sum(k) / sum(n) AS p, sum(k * k / n) AS q FROM h GROUP BY rule),
s AS (SELECT *, (q - docs * p * p - (hosts - 1) * p * (1 - p)) / (docs - sq / docs) AS spread FROM t),
r AS (SELECT source, rule, (k + p * weight) / (n + weight) AS rate FROM (
    SELECT h.*, p, CASE WHEN hosts > 1 AND spread > 0 THEN least(greatest(p * (1 - p) / spread - 1, 1), 1e6) ELSE 1e6 END AS weight
    FROM h JOIN s USING (rule))),
v AS (SELECT source, max(rate) AS host_rate, max(rate) FILTER (rule = 2) > 0.05 AS s2, max(rate) FILTER (rule = 3) > 0.05 AS s3,
    max(rate) FILTER (rule = 4) > 0.05 AS s4 FROM r GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 AS base_failed,
  NOT (f1 OR (f2 AND s2) OR (f3 AND s3) OR (f4 AND s4) OR (host_rate > 0.5 AND (f2 OR f3 OR f4))) AS kept, host_rate > 0.5 AS host_bad
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {spaced(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 85 * (p.c + q.c - i)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
least_id AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(c, 0)::BIGINT AS n_shingles, least(d.doc_id, y)::BIGINT AS component_id,
  d.doc_id = least(d.doc_id, y) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_id ON least_id.x = d.doc_id
"""

OP8 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
k AS (SELECT *, {LOWER.format(f"trim(line, {TRIM})")} AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(common.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common ON k.key = common.key GROUP BY doc_id
"""

# The steps of CRC-32 by its rule (reflected polynomial 0xEDB88320) as a list of 256 numbers, column `steps`.
CRC_STEPS = """
bits(i, k, c) AS (SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8)
"""


def crc32_of(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, where `steps` of crc_table is in scope."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::UBIGINT)"
    step = "xor(a >> 8, steps[(xor(a, b) & 255)::BIGINT + 1])"
    return f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {data}), lambda a, b: {step}))"


OP11 = rf"""
WITH RECURSIVE {CRC_STEPS},
runs AS (SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS w FROM documents)
  WHERE length(w) >= 5 GROUP BY ALL),
hashed AS (SELECT w, n, {crc32_of("concat(doc_id, ':', w)")} AS h FROM runs, crc_table),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN w[:(h % length(w))::BIGINT] || w[(h % length(w))::BIGINT + 2:] ELSE w END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words),
holes AS MATERIALIZED (SELECT word, p, word[:p - 1] AS a, word[p + 1:] AS b FROM places),
pairs AS (SELECT DISTINCT x, y FROM (
    SELECT s.word AS x, t.word AS y FROM holes s JOIN holes t ON s.p = t.p AND s.a = t.a AND s.b = t.b WHERE s.word <> t.word
    UNION ALL SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.a || h.b
    UNION ALL SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.a || h.b)),
best AS (SELECT x AS word, count(*) AS n_near, arg_min(y, (-n, y)) AS form, max(n) AS form_n
  FROM pairs JOIN words ON word = y GROUP BY x),
forms AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= 2 * words.n THEN form END AS form, CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS spot, 0 AS k FROM forms
  UNION ALL SELECT walk.word, form, k + 1 FROM walk JOIN forms ON forms.word = spot WHERE form IS NOT NULL),
ends AS (SELECT word, arg_max(spot, k) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN ends USING (word)
"""

OP12 = f"""
WITH RECURSIVE {CRC_STEPS},
d AS (SELECT doc_id, {plain("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT {plain("coalesce(text, '')")} AS w FROM benchmark),
grams AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS g FROM d),
target_grams AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS g FROM i),
used AS MATERIALIZED (SELECT g, {crc32_of("g")} % 10000 AS bucket FROM (SELECT g FROM grams UNION SELECT g FROM target_grams), crc_table),
s AS (SELECT bucket, count(*) AS s FROM grams JOIN used USING (g) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_grams JOIN used USING (g) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM grams) AS all_s, (SELECT count(*) FROM target_grams) AS all_t),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * (all_t + 10000)))) AS gain
  FROM (SELECT DISTINCT bucket FROM used) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
sizes AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*)) AS weight
  FROM grams JOIN used USING (g) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[:8])::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN sizes USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_words >= 20),
taken AS (SELECT (25 * count(*)) // 100 AS k FROM placed)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id), taken
"""

ORACLES = {
    "op2_warc": OP2,
    "op3_decontamination": OP3,
    "op5_quality_rules": OP5,
    "op7_near_dedup": OP7,
    "op8_line_dedup": OP8,
    "op11_spelling": OP11,
    "op12_resampling": OP12,
}
