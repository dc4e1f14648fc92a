"""Plain SQL for the queries that SQL can express."""

from __future__ import annotations

from assay.llm import rules

OP3 = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS win
  FROM tokens, unnest(range(1, len(w) - 18)) AS t(i)),
placed AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS place FROM windows),
gone AS (
  SELECT DISTINCT doc_id, i + o AS i FROM placed, unnest(range(0, 20)) AS t(o) WHERE place > 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
each AS (
  SELECT t.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, w
  FROM tokens t LEFT JOIN lost l ON t.doc_id = l.doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM each),
kept AS (
  SELECT k.doc_id, string_agg(word, ' ' ORDER BY k.i) AS body
  FROM words k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.i = g.i
  WHERE g.i IS NULL GROUP BY k.doc_id)
SELECT e.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM each e LEFT JOIN kept k ON e.doc_id = k.doc_id
"""

_BLANKS = "".join(f"chr({ord(blank)}) || " for blank in rules.BLANKS)[:-4]

OP8 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
tokens AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT r, i, w[i : i + 2] AS win FROM tokens, unnest(range(1, len(w) - 1)) AS t(i)),
twins AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows),
covered AS (
  SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM twins, unnest([0, 1, 2]) AS t(o)
  WHERE n > 1 GROUP BY r),
lines AS (
  SELECT r, i, l, rtrim(l, {blanks}) AS b
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM docs)),
judged AS (
  SELECT *, length(b) - length(replace(b, ' ', '')) + 1 AS weight FROM lines),
passed AS (
  SELECT r, l, min(i) AS i FROM judged
  WHERE length(trim(b, ' ')) > 0
    AND (length(b) >= {long} OR b[-1] IN ('.', '!', '?', ':', ';', '"', '''', ')')
      OR (regexp_matches(b[-1], '[\p{Po}\p{Pe}\p{Pf}]') AND NOT regexp_matches(b[-1], '[\x00-\x7F•·،、，]')))
    AND len(regexp_extract_all(b, '[#*$%&|<>]')) * 10 <= weight
    AND len(regexp_extract_all(b, '[|>»•·]')) * 5 < weight
    AND len(regexp_extract_all(b, '\p{Lu}{2,}')) * 2 <= weight
    AND (length(b) >= {long} OR NOT regexp_matches(b, '{phrases}'))
  GROUP BY r, l),
cleaned AS (
  SELECT r, sum(len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) AS kept_words FROM passed GROUP BY r),
copies AS (
  SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(kept_words, 0) AS kept_words
  FROM tokens t LEFT JOIN covered c ON t.r = c.r LEFT JOIN copies d ON t.r = d.r
    LEFT JOIN cleaned k ON t.r = k.r),
base AS (
  SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (n_words - kept_words) * 100 <= n_words * 40 AS kept
FROM base
""".replace("{blanks}", _BLANKS).replace("{long}", str(rules.LONG_LINE)).replace("{phrases}", rules.BOILERPLATE)

OP10 = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, md5(coalesce(text, '')) AS tie, doc_id, coalesce('=' || source, '') AS source_key,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
sizes AS (SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source_key),
ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source_key = '', source_key) - 1) % 3] AS weight
  FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE) - coalesce(sum(2 * source_size) OVER
      (ORDER BY 2 * source_size / weight, source_key = '', source_key
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2 * source_size / weight, source_key = '', source_key
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM ranked),
targets AS (
  SELECT source_key, source_size, least(CAST(2 * source_size AS DOUBLE),
    weight * (SELECT max(own_level) FROM levels)) AS target
  FROM levels),
queued AS (
  SELECT r.*, source_size, target, sum(size) OVER
    (PARTITION BY r.source_key ORDER BY key, doc_id, tie, r.r ROWS UNBOUNDED PRECEDING) AS finish
  FROM rows r JOIN targets t ON r.source_key = t.source_key),
copies AS (
  SELECT *, (CAST(finish AS BIGINT) + lap * source_size) / target AS time
  FROM queued, (SELECT unnest([0, 1]) AS lap) l WHERE size > 0),
served AS (
  SELECT *, sum(size) OVER
    (ORDER BY time, source_key, key, doc_id, tie, r, lap ROWS UNBOUNDED PRECEDING) AS upto FROM copies),
taken AS (
  SELECT r, count(*) AS copies FROM served
  WHERE upto <= (SELECT sum(target) FROM targets) GROUP BY r)
SELECT q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(t.copies, 0) AS taken
FROM queued q LEFT JOIN taken t ON q.r = t.r
"""


def _crc32(text: str) -> str:
    """crc32 of a short ASCII text, bit by bit: a byte is mixed in, then eight steps follow it."""
    steps = (
        f"flatten(list_transform(string_split({text}, ''), lambda c:"
        " [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    )
    return (
        f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda r, b:"
        " CASE WHEN b >= 0 THEN xor(r, b) ELSE xor(r >> 1, 3988292384 * (r & 1)) END))"
    )


def _field(name: str, kind: str = "VARCHAR") -> str:
    text = f"CAST({name} AS {kind})"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


_HEAD = " || ".join(_field(name) for name in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grow(name: str, leaves: str) -> str:
    return f"""
{name}_nodes AS (
  SELECT tree, 0 AS level, i, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_nodes) c
  WHERE n > 1 GROUP BY tree, level, i // 16),
{name}_tops AS (
  SELECT tree, max(level) AS height, arg_max(digest, level) AS digest FROM {name}_nodes GROUP BY tree),
{name}_sides AS (
  SELECT l.tree, l.i, p.level,
    coalesce(string_agg(p.digest, '' ORDER BY p.i) FILTER (p.i < l.i // CAST(16 ** p.level AS BIGINT)), '') AS lefts,
    coalesce(string_agg(p.digest, '' ORDER BY p.i) FILTER (p.i > l.i // CAST(16 ** p.level AS BIGINT)), '') AS rights
  FROM {leaves} l JOIN {name}_tops t ON l.tree = t.tree
    JOIN {name}_nodes p ON p.tree = l.tree AND p.level < t.height
      AND p.i // 16 = l.i // CAST(16 ** (p.level + 1) AS BIGINT)
  GROUP BY l.tree, l.i, p.level)"""


OP12 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_HEAD} || {_field('text')}) AS digest,
    CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN
      sha256({_HEAD} || {_field(_LOWER)}) END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM docs),
{_grow('low', 'leaves')},
crowns AS (
  SELECT 0 AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS i, digest FROM low_tops),
{_grow('top', 'crowns')},
steps AS (
  SELECT tree, i, level, lefts, rights FROM low_sides
  UNION ALL
  SELECT l.tree, l.i, 100 + s.level, s.lefts, s.rights
  FROM leaves l JOIN crowns c ON l.tree = c.name JOIN top_sides s ON s.i = c.i),
ways AS (
  SELECT tree, i, string_agg(lefts || rights, '' ORDER BY level) AS proof,
    list([lefts, rights] ORDER BY level) AS way FROM steps GROUP BY tree, i),
whole AS (
  SELECT l.*, t.digest AS subroot, r.digest AS root, coalesce(proof, '') AS proof, coalesce(way, []) AS way
  FROM leaves l JOIN low_tops t ON l.tree = t.tree CROSS JOIN top_tops r
    LEFT JOIN ways w ON w.tree = l.tree AND w.i = l.i),
closed AS (
  SELECT *, list_reduce(list_prepend([coalesce(tampered, digest)], way),
    lambda a, s: [sha256(s[1] || a[1] || s[2])])[1] AS folded_root FROM whole)
SELECT doc_id, digest AS leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM closed
"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS o
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT DISTINCT c, {_crc32('CAST(c AS VARCHAR)')} % 6 AS h, c - c % 100 AS base FROM turns),
pieces AS (
  SELECT v.c, 0 AS own, o, role, text FROM convs v JOIN turns t ON t.c = v.base AND t.o < v.h
  UNION ALL
  SELECT v.c, 1, o, role, text FROM convs v JOIN turns t ON t.c = v.c AND t.o >= v.h),
paths AS (
  SELECT v.c, coalesce(list([p.role, p.text] ORDER BY p.own, p.o) FILTER (p.c IS NOT NULL), []) AS path
  FROM convs v LEFT JOIN pieces p ON p.c = v.c GROUP BY v.c),
members AS (
  SELECT c, d, path[1 : d] AS prefix, len(path) AS l, CASE WHEN d > 0 THEN path[d][2] ELSE '' END AS said
  FROM paths, unnest(range(0, len(path) + 1)) AS t(d)),
nodes AS (
  SELECT d, prefix, min(c) AS id, count(*) AS n, min(length(said)) AS chars,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (l = d), '') AS ends,
    max(l) = d AS childless
  FROM members GROUP BY d, prefix),
placed AS (SELECT m.c, m.d, n.id FROM members m JOIN nodes n ON m.d = n.d AND m.prefix = n.prefix),
below AS (
  SELECT p.id, p.d, sum(CAST(n.childless AS INT)) AS n_leaves, sum((n.n - 1) * n.chars) AS saved,
    count(*) FILTER (n.d = p.d + 1) AS n_children
  FROM nodes n JOIN placed p ON p.c = n.id AND p.d <= n.d GROUP BY p.id, p.d)
SELECT CAST(n.id AS BIGINT) AS conv_id, CAST(n.d AS BIGINT) AS depth, CAST(u.id AS BIGINT) AS parent_conv_id,
  CAST(n.n AS BIGINT) AS n_convs, CAST(b.n_children AS BIGINT) AS n_children,
  CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.id = n.id AND b.d = n.d
  LEFT JOIN placed u ON u.c = n.id AND u.d = n.d - 1
"""

ORACLES: dict[str, str] = {
    "op3_substring_dedup": OP3,
    "op8_line_rules": OP8,
    "op10_mix_sources": OP10,
    "op12_merkle": OP12,
    "op13_prefix_trie": OP13,
}
