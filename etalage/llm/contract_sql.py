"""The contracts of operators in DuckDB's SQL, over whole tables.

Each statement is written from what its query has to return, not from the operator's method; where the contract leaves
the result to the method (the limits of ``op9``, the law of ``op5``), it states the same law.
"""

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Pages that no rule names are allowed.  That is the query's verdict where pages link to no other page, as in the given
# tables: components of links would need relative addresses resolved, which is beyond SQL.
URL_RULES = rf"""
WITH parts AS (SELECT r, page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {LOWER}) AS host,
                      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
               FROM (SELECT row_number() OVER () AS r, page_id, url FROM pages)),
rules (verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fitting AS (SELECT r AS fr, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   max_by(verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fitting ON fr = r
"""

CONTAMINATION = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
                     regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item,
                 regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (SELECT DISTINCT item, size, sha256(array_to_string(w[pos + 1:pos + size], ' ')) AS h
                 FROM (SELECT item, w, size, unnest(range(len(w) - size + 1)) AS pos
                       FROM (SELECT *, least(len(w), 13) AS size FROM items WHERE len(w) > 0))),
windows AS (SELECT r, size, pos, sha256(array_to_string(w[pos + 1:pos + size], ' ')) AS h
            FROM (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS pos
                  FROM docs JOIN (SELECT DISTINCT size FROM item_windows) ON len(w) >= size)),
found AS (SELECT r, pos, size, item FROM windows JOIN item_windows USING (size, h)),
hits AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT r, pos, size FROM found))
         GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

# A CRC-32 table (reflected polynomial 0xEDB88320) and one step of the checksum per byte.
_CRC_TABLE = """
crc_bits (b, k, v) AS (SELECT range, CAST(0 AS BIGINT), range FROM range(256)
                       UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), v >> 1) ELSE v >> 1 END
                       FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS crcs FROM crc_bits WHERE k = 8)"""


def _crc32(data: str) -> str:
    """The checksum of a blob; ``crcs`` is the table."""
    pairs = f"list_transform(regexp_extract_all(hex({data}), '..'), lambda d: CAST('0x' || d AS BIGINT))"
    return (f"xor(CAST(4294967295 AS BIGINT), list_reduce({pairs}, "
            "lambda c, x: xor(crcs[(xor(c, x) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT)))")


SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_crc32("encode(coalesce(text, ''))")} AS crc
         FROM documents, crc_table),
placed AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, crc ROWS UNBOUNDED PRECEDING) AS upto,
                  sum(size) OVER () AS total FROM docs),
dealt AS (SELECT *, CAST((16 * (2 * (upto - size) + size)) // (2 * total) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""

# Base32 of a SHA-1: four characters for every five hex digits.
ARCHIVE = """
WITH payloads AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS payload FROM pages),
kinds AS (SELECT payload AS same, min(page_id) AS first FROM payloads GROUP BY payload),
hashed AS (SELECT *, sha1(payload) AS h FROM payloads JOIN kinds ON payload = same),
quints AS (SELECT r, i, CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) AS bits FROM hashed, (SELECT range AS i FROM range(8))),
digests AS (SELECT r AS dr, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (bits >> 15) + 1, 1)
                || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((bits >> 10) & 31) + 1, 1)
                || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((bits >> 5) & 31) + 1, 1)
                || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (bits & 31) + 1, 1), '' ORDER BY i) AS payload_digest FROM quints GROUP BY r)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed JOIN digests ON dr = r
"""

_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0}, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))

MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
rows AS (SELECT row_number() OVER () AS r, *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
                doc_id IS NOT NULL AND n_chars IS NOT NULL AND {_crc32("encode(CAST(doc_id AS VARCHAR))")} % 7 = 0 AS tampered
         FROM documents, crc_table),
hashed AS (SELECT r, doc_id, g, sha256({_LEAF}) AS leaf,
                  sha256({_LEAF.replace("n_chars", "(CAST(n_chars AS HUGEINT) + 1)")}) AS changed, tampered FROM rows),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
trees (lvl, g, i, n, h) AS (
    SELECT CAST(0 AS BIGINT), g, i, count(*) OVER (PARTITION BY g), leaf FROM leaves
    UNION ALL
    SELECT lvl + 1, g, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM trees WHERE n > 1 GROUP BY lvl, g, i // 2),
subroots AS (SELECT g, h FROM trees WHERE n = 1),
tops (lvl, i, n, h) AS (
    SELECT CAST(0 AS BIGINT), g, count(*) OVER (), h FROM subroots
    UNION ALL
    SELECT lvl + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lvl, i // 2),
heights AS (SELECT g AS hg, max(lvl) AS height FROM trees GROUP BY g),
steps AS (
    SELECT r, lvl AS step, max(CASE WHEN trees.i < leaves.i >> lvl THEN h END) AS earlier, max(CASE WHEN trees.i > leaves.i >> lvl THEN h END) AS later
    FROM leaves JOIN trees ON trees.g = leaves.g AND n > 1 AND trees.i // 2 = leaves.i >> (lvl + 1) GROUP BY r, lvl
    UNION ALL
    SELECT r, height + lvl, max(CASE WHEN tops.i < g >> lvl THEN h END), max(CASE WHEN tops.i > g >> lvl THEN h END)
    FROM leaves JOIN heights ON hg = g JOIN tops ON n > 1 AND tops.i // 2 = g >> (lvl + 1) GROUP BY r, height, lvl),
folds (r, step, h) AS (
    SELECT r, CAST(0 AS BIGINT), CASE WHEN tampered THEN changed ELSE leaf END FROM leaves
    UNION ALL
    SELECT folds.r, folds.step + 1, sha256(coalesce(earlier, '') || h || coalesce(later, ''))
    FROM folds JOIN steps ON steps.r = folds.r AND steps.step = folds.step),
folded AS (SELECT r, max_by(h, step) AS folded_root FROM folds GROUP BY r),
proofs AS (SELECT r, string_agg(coalesce(earlier, '') || coalesce(later, ''), '' ORDER BY step) AS siblings FROM steps GROUP BY r)
SELECT doc_id, leaf, subroots.h AS subroot, tops.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
       folded_root = tops.h AS verified
FROM leaves JOIN subroots USING (g) JOIN tops ON tops.n = 1 JOIN folded USING (r) LEFT JOIN proofs USING (r)
"""

LINE_DEDUP = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM texts),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines),
common AS (SELECT line_key AS gone FROM keyed WHERE line_key <> '' GROUP BY line_key
           HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON line_key = gone GROUP BY r
"""

SUBSTRINGS = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM texts),
windows AS (SELECT r, doc_id, pos, sha256(array_to_string(w[pos + 1:pos + 50], ' ')) AS h
            FROM (SELECT r, doc_id, w, unnest(range(len(w) - 49)) AS pos FROM texts WHERE len(w) >= 50 AND doc_id IS NOT NULL)),
least AS (SELECT h AS same, min(doc_id) AS first FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT r AS gr, pos AS gpos FROM windows JOIN least ON h = same WHERE doc_id > first),
judged AS (SELECT r, word, pos, max(gpos) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS out
           FROM words LEFT JOIN gone ON gr = r AND gpos = pos),
kept AS (SELECT r AS kr, count(*) AS n, count(*) FILTER (WHERE out) AS n_out,
                string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT out) AS body FROM judged GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(n_out, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept ON kr = r
"""

# Bytes as hex digits, two for each.
REPEATED_BYTES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x,
                     octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents),
parts AS (SELECT r, n_bytes, base, substr(x, 2 * base + 1, 1598) AS part
          FROM (SELECT r, n_bytes, x, unnest(range(0, n_bytes - 399, 400)) AS base FROM docs WHERE n_bytes >= 400)),
windows AS (SELECT r, base + i AS pos, md5_number(substr(part, 2 * i + 1, 800)) AS h
            FROM (SELECT r, base, part, unnest(range(least(400, n_bytes - 399 - base))) AS i FROM parts)),
gone AS (SELECT r, pos FROM windows JOIN (SELECT h AS same FROM windows GROUP BY h HAVING count(*) > 1) ON h = same),
breaks AS (SELECT r, pos, coalesce(pos > lag(pos) OVER (PARTITION BY r ORDER BY pos) + 400, true) AS first FROM gone),
numbered AS (SELECT r, pos, count(*) FILTER (WHERE first) OVER (PARTITION BY r ORDER BY pos) AS span FROM breaks),
spans AS (SELECT r, min(pos) AS a, max(pos) + 400 AS b FROM numbered GROUP BY r, span),
gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM spans),
cut AS (SELECT r, count(*) AS spans, CAST(sum(b - a) AS BIGINT) AS removed, max(b) AS last,
               string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head FROM gaps JOIN docs USING (r) GROUP BY r)
SELECT doc_id, n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)
"""

# A stretch that keeps a period p is an island of places whose word stands p words later again; of the periods of one
# stretch of three periods or more the least divides the others, so it has the same ends.
WORD_RUNS = rf"""
WITH RECURSIVE {_CRC_TABLE},
texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                 {_crc32("encode(CAST(doc_id AS VARCHAR))")} AS h FROM documents, crc_table),
placed AS (SELECT *, (h // 10) % nullif(len(w), 0) AS a FROM texts),
turned AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN 1 + (len(w) - a) // (3 + (h // 10) % 8) END AS p FROM placed),
numbered AS (SELECT r, len(w) AS n, unnest(range(len(w))) AS pos, a, p, w FROM turned),
words AS (SELECT r, n, pos, w[1 + CASE WHEN p IS NULL OR pos < a THEN pos ELSE a + (pos - a) % p END] AS word FROM numbered),
pairs AS (SELECT x.r, x.pos, y.pos - x.pos AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word
          WHERE y.pos > x.pos AND 3 * (y.pos - x.pos) <= x.n),
islands AS (SELECT r, q, min(pos) AS start, count(*) + q AS length
            FROM (SELECT *, pos - row_number() OVER (PARTITION BY r, q ORDER BY pos) AS island FROM pairs) GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM islands WHERE length >= greatest(24, 3 * q) GROUP BY r, start, length),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
           FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS pos FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY pos) AS body FROM words ANTI JOIN gone USING (r, pos) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM texts LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


def _level(name: str, keys: str, above: str | None) -> str:
    """Cumulated counts of the groups by ``keys``; those of ``above`` come in with the weight of 200 documents."""
    own = f"SELECT {keys}metric, bucket, count(*) AS n FROM measured GROUP BY {keys}metric, bucket"
    if above is not None:
        taken = f"SELECT DISTINCT {keys}metric FROM measured"
        own = f"{own} UNION ALL SELECT {keys}metric, bucket, share FROM ({taken}) JOIN {above} USING ({_above_keys(keys)}metric) WHERE share > 0"
    group = f"PARTITION BY {keys}metric"
    return f"""
{name} AS (SELECT *, (400 * upto + total) // (2 * total) - (400 * (upto - n) + total) // (2 * total) AS share
           FROM (SELECT *, sum(n) OVER ({group} ORDER BY bucket) AS upto, sum(n) OVER ({group}) AS total
                 FROM (SELECT {keys}metric, bucket, CAST(sum(n) AS BIGINT) AS n FROM ({own}) GROUP BY {keys}metric, bucket)))"""


def _above_keys(keys: str) -> str:
    """``"a, b, "`` without its last key."""
    return "".join(f"{k}, " for k in keys.split(", ")[:-2])


# Base columns and the operator's limits, both in whole numbers: a metric is in thousandths, its bucket has ten bits.
QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS a, coalesce('=' || source, '') AS b, coalesce(text, '') AS t,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, pos, array_to_string(w[pos + 1:pos + 3], ' ') AS three
            FROM (SELECT r, w, unnest(range(len(w) - 2)) AS pos FROM docs WHERE len(w) > 3)),
again AS (SELECT r, pos FROM windows SEMI JOIN (SELECT r, three FROM windows GROUP BY r, three HAVING count(*) > 1) USING (r, three)),
repeated AS (SELECT r, count(DISTINCT pos) AS n_again FROM (SELECT r, unnest([pos, pos + 1, pos + 2]) AS pos FROM again) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS (SELECT r, doc_id, a, b, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                   length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
                   coalesce(n_again, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
            FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
valued AS (SELECT r, a, b, unnest(['word_length', 'symbol_share', 'dup_line_share', 'repeat_share']) AS metric,
                  unnest([1000 * word_chars // n_words, 1000 * n_symbols // n_words,
                          1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words]) AS v FROM based WHERE NOT base_failed),
measured AS (SELECT *, v - v % (CAST(1 AS BIGINT) << greatest(0, length(bin(v)) - 10)) AS bucket FROM valued),
{_level("corpus", "", None).strip()},
{_level("langs", "a, ", "corpus").strip()},
{_level("sources", "a, b, ", "langs").strip()},
quantiles AS (SELECT a, b, metric, min(bucket) FILTER (WHERE 100 * upto >= 5 * total) AS q5, min(bucket) FILTER (WHERE 100 * upto >= 50 * total) AS q50,
                     min(bucket) FILTER (WHERE 100 * upto >= 95 * total) AS q95 FROM sources GROUP BY a, b, metric),
least (metric, floor) AS (VALUES ('word_length', 2000), ('symbol_share', 100), ('dup_line_share', 500), ('repeat_share', 450)),
limits AS (SELECT a, b, metric, q50, greatest(floor, 6 * least(q50 - q5, q95 - q50)) AS width FROM quantiles JOIN least USING (metric)),
outside AS (SELECT DISTINCT r FROM valued JOIN limits USING (a, b, metric)
            WHERE v > q50 + width OR metric = 'word_length' AND v < q50 - width)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND outside.r IS NULL AS kept FROM based LEFT JOIN outside USING (r)
"""
