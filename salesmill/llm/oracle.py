"""DuckDB statements for the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Windows of items meet windows of documents of the same length by their text.
OP6 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), iw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hit AS (
  SELECT dw.r, dw.i, dw.n, iw.item FROM dw JOIN iw ON dw.t = iw.t AND dw.n = iw.n
), items AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hit GROUP BY r
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY r
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (r) LEFT JOIN covered USING (r)
"""

#: Texts of equal sets are one class; classes meet by each shingle they share, so sets of any size are compared whole.
OP7 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), class AS (
  SELECT r, min(r) OVER (PARTITION BY k) AS c, n
  FROM (SELECT r, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY s)) AS k FROM shingle GROUP BY r)
), member AS (
  SELECT c, s, n FROM shingle JOIN class USING (r) WHERE r = c
), link AS (
  SELECT a.c AS a, b.c AS b FROM member a JOIN member b ON a.s = b.s AND a.c <> b.c
  WHERE 100 * a.n >= 75 * b.n AND 100 * b.n >= 75 * a.n
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
  SELECT DISTINCT c AS a, c AS b FROM class
  UNION
  SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a
), least AS (
  SELECT reached.a AS c, min(d.doc_id) AS component_id
  FROM reached JOIN class ON class.c = reached.b JOIN d ON d.r = class.r GROUP BY reached.a
)
SELECT d.doc_id, coalesce(class.n, 0) AS n_shingles, coalesce(least.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN class USING (r) LEFT JOIN least USING (c)
"""

#: CRC-32 of a list of bytes: a table of 256 entries, made by the polynomial's rule, and one step a byte.
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
)"""


def _crc32(table: str, data: str) -> str:
    """CRC-32 of `data`, a list of numbers 0 to 255."""
    return (f"xor(list_reduce({data}, lambda c, b: xor({table}.t[xor(c & 255, b) + 1], c >> 8), 4294967295::BIGINT), "
            "4294967295)")


_TEXT_BYTES = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)"
_BID = "1.0 / -ln((('0x' || substr(md5(k || '/' || s), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"

#: Equal rows are interchangeable, so any order among them gives the same rows.
OP11 = f"""
WITH {_CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
         strlen(coalesce(text, '')) + 1 AS size, {_crc32("crc", _TEXT_BYTES)} AS crc
  FROM documents, crc
), bids AS (
  SELECT r, s, {_BID} AS bid FROM d, (SELECT unnest(range(17)) AS s)
), homes AS (
  SELECT r, arg_max(s, (bid, -s)) FILTER (WHERE s < 16) AS shard, arg_max(s, (bid, -s)) AS grown FROM bids GROUP BY r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('/', k, size, crc, 0))) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM d JOIN homes USING (r)
"""

_DIGITS = "list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)"

#: Every beginning of every rebuilt conversation is a row; subtrees are found by pairs of beginnings.
OP13 = f"""
WITH {_CRC_TABLE}, t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({{'id': md5(length(role) || ':' || role || text), 'n': length(text)}}
                 ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS w
  FROM t GROUP BY c
), h AS (
  SELECT c, w, CAST({_crc32("crc", _DIGITS)} % 6 AS INTEGER) AS h FROM own, crc
), rebuilt AS (
  SELECT h.c, list_concat(coalesce(l.w[1:h.h], []), h.w[h.h + 1:]) AS w FROM h LEFT JOIN own l ON l.c = h.c - h.c % 100
), b AS (
  SELECT c, d, len(w) AS n, md5(list_aggregate([''] || list_transform(w[1:d], lambda x: x.id), 'string_agg', '/')) AS k,
         CASE WHEN d > 0 THEN w[d].n ELSE 0 END AS chars
  FROM (SELECT c, w, unnest(range(len(w) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, max(n) = d AS childless,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends
  FROM b GROUP BY d, k
), below AS (
  SELECT DISTINCT u.d, u.k, v.d AS vd, v.k AS vk FROM b u JOIN b v ON u.c = v.c AND v.d >= u.d
), sums AS (
  SELECT below.d, below.k, count(*) FILTER (WHERE vd = below.d + 1) AS n_children, count(*) FILTER (WHERE childless) AS n_leaves,
         sum((n_convs - 1) * chars) AS saved
  FROM below JOIN node ON node.d = vd AND node.k = vk GROUP BY below.d, below.k
), up AS (
  SELECT DISTINCT v.d, v.k, u.k AS pk FROM b v JOIN b u ON u.c = v.c AND u.d = v.d - 1
)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, node.n_convs, n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN sums USING (d, k) LEFT JOIN up USING (d, k) LEFT JOIN node p ON p.d = node.d - 1 AND p.k = up.pk
"""

ORACLE: dict[str, str] = {
    "op6_decontaminate": OP6,
    "op7_jaccard_join": OP7,
    "op11_rendezvous_shards": OP11,
    "op13_prefix_trie": OP13,
}
