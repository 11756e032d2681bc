"""Plain SQL for the registered queries that SQL can express on whole tables."""

from __future__ import annotations

from demandloom.llm import licenses, suffixes


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _license_sql() -> str:
    """Word by word: every gram of every text against every position of every phrase."""
    k = licenses.K
    phrases = {**licenses.TEMPLATES, **licenses.BASE}
    positions = ", ".join(
        f"({_text(p)}, {_text(label)}, {p in licenses.BASE}, {len(p.split())}, {at}, "
        f"{_text(' '.join(p.split()[at : at + k]))})"
        for p, label in phrases.items()
        for at in range(len(p.split()) - k + 1)
    )
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    gram = " || ' ' || ".join(f"w[pos + {j + 1}]" for j in range(k))
    covered = " UNION ALL ".join(f"SELECT *, place + {j} AS word FROM spanned" for j in range(k))
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
positions(phrase, label, base, words, place, gram) AS (VALUES {positions}),
grams AS (
  SELECT rid, pos, {gram} AS gram
  FROM (SELECT rid, w, unnest(range(len(w) - {k - 1})) AS pos FROM texts)),
votes AS (
  SELECT DISTINCT rid, phrase, label, base, words, place, pos - place AS diagonal
  FROM grams JOIN positions USING (gram)),
diagonals AS (SELECT DISTINCT rid, phrase, base, diagonal FROM votes),
opened AS (
  SELECT *, CASE WHEN base OR lag(diagonal) OVER o IS NULL
                   OR diagonal - lag(diagonal) OVER o > {licenses.DRIFT} THEN 1 ELSE 0 END AS opens
  FROM diagonals WINDOW o AS (PARTITION BY rid, phrase ORDER BY diagonal)),
islands AS (
  SELECT *, sum(opens) OVER (PARTITION BY rid, phrase ORDER BY diagonal) AS span FROM opened),
spanned AS (
  SELECT v.*, i.span FROM votes v JOIN islands i USING (rid, phrase, diagonal)),
spans AS (
  SELECT rid, phrase, label, base, span, min(diagonal) AS first,
         count(DISTINCT word) / CAST(max(words) AS DOUBLE) AS agreement
  FROM ({covered}) GROUP BY ALL
  HAVING agreement >= CASE WHEN base THEN 1.0 ELSE {licenses.AGREEMENT} END),
found AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
         max(first) FILTER (base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels,
         max(agreement) AS score
  FROM spans GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM texts LEFT JOIN found USING (rid)"""


def _repeats_sql(length: int = suffixes.LENGTH) -> str:
    """Digests of all strings of the length, and the union of those that occur twice."""
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (
  SELECT rid, s, md5(b[s : s + {length - 1}]) AS m
  FROM (SELECT rid, b, unnest(range(1, octet_length(b) - {length - 2})) AS s FROM texts)),
hits AS (
  SELECT rid, s FROM strings SEMI JOIN (SELECT m FROM strings GROUP BY m HAVING count(*) > 1)
  USING (m)),
opened AS (
  SELECT *, CASE WHEN s <= lag(s) OVER o + {length} THEN 0 ELSE 1 END AS opens
  FROM hits WINDOW o AS (PARTITION BY rid ORDER BY s)),
spans AS (
  SELECT rid, min(s) AS begin, max(s) + {length} AS stop
  FROM (SELECT rid, s, sum(opens) OVER (PARTITION BY rid ORDER BY s) AS span FROM opened)
  GROUP BY rid, span),
gaps AS (
  SELECT rid, begin, stop, coalesce(lag(stop) OVER (PARTITION BY rid ORDER BY begin), 1) AS since
  FROM spans),
kept AS (
  SELECT rid, sum(stop - begin) AS n_removed, count(*) AS n_spans,
         string_agg(hex(b[since : begin - 1]), '' ORDER BY begin)
           || hex(any_value(b)[max(stop) : ]) AS body
  FROM gaps JOIN texts USING (rid) GROUP BY rid)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN body IS NULL THEN b ELSE unhex(body) END) AS kept_sha256,
       try(decode(CASE WHEN body IS NULL THEN b ELSE unhex(body) END)) AS text
FROM texts LEFT JOIN kept USING (rid)"""


def _top_sql(scale: int = 64, top: int = 20, every: int = 20) -> str:
    """Every query against every vector."""
    usable = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0"
    return f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND {usable}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % {every} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored)
WHERE rank <= {top}"""


def _trie_sql(family: int = 100, most: int = 5) -> str:
    """Every prefix of every rebuilt conversation, and every pair of a node and one below it.

    The CRC-32 of an id goes byte by byte through the table of its polynomial.
    """
    turn = "md5(concat(len(role), ':', role, text))"
    return f"""
WITH RECURSIVE bits(i, c, s) AS (
  SELECT i, CAST(i AS UBIGINT), 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c // 2) ELSE c // 2 END, s + 1
  FROM bits WHERE s < 8),
crcs AS (SELECT list(c ORDER BY i) AS l FROM bits WHERE s = 8),
given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'key': {turn}, 'chars': length(text)}}
                       ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM given GROUP BY conv_id),
taken AS (
  SELECT conv_id, turns, CAST(xor(4294967295::UBIGINT, list_reduce(
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS UBIGINT)),
           lambda c, b: xor(c // 256, l[CAST(xor(c, b) % 256 AS INT) + 1]),
           4294967295::UBIGINT)) % {most + 1} AS INT) AS h
  FROM own, crcs),
rebuilt AS (
  SELECT t.conv_id, list_concat(coalesce(o.turns, [])[1 : h], t.turns[h + 1 :]) AS turns
  FROM taken t LEFT JOIN own o ON o.conv_id = t.conv_id - t.conv_id % {family}),
steps AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
members AS (
  SELECT conv_id, depth, depth = len(turns) AS ends, list_transform(turns[1 : depth], lambda t: t.key) AS path,
         CASE WHEN depth > 0 THEN turns[depth].chars ELSE 0 END AS chars
  FROM steps),
nodes AS (
  SELECT path, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * min(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), ''))
           AS ends_sha256
  FROM members GROUP BY path),
children AS (
  SELECT path[1 : depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
below AS (
  SELECT path[1 : above] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT path, n_children, saved, unnest(range(depth + 1)) AS above FROM counted)
  GROUP BY 1)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs,
       CAST(c.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b USING (path)
LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[1 : c.depth - 1]"""


ORACLE = {
    "op4_columnwise_suffixes": _repeats_sql(),
    "op7_license_diagonals": _license_sql(),
    "op12_branch_and_bound": _top_sql(),
    "op13_truncation_peeling": _trie_sql(),
}
