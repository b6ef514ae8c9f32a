"""DuckDB SQL of the operators that it can express, written the plain way."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text."""
    shift = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    # A reduction whose first value is the state: eight shifts a byte, byte after byte.
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: {shift})"
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: ascii(substr({text}, i::INTEGER, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"


def _tree(t: str, nodes: str, paths: str, levels: int) -> str:
    """CTEs: ``{t}{i}`` holds the nodes of level i, ``{t}p{i}`` every row's siblings up to there (``path``)
    and the digest that its other leaf gives (``other``). A group of one node stays as it is."""
    out = [f"{t}0 AS ({nodes})", f"{t}p0 AS ({paths})"]
    for i in range(levels):
        up = "CASE WHEN n > 1 THEN place // 8 ELSE place END"
        out.append(
            f"{t}{i + 1} AS (SELECT grp, {up} AS place, (max(n) + 7) // 8 AS n, max(n) > 1 AS grew, "
            f"CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE max(digest) END AS digest, "
            f"list(digest ORDER BY place) AS kids FROM {t}{i} GROUP BY grp, {up})"
        )
        left = "array_to_string(u.kids[1:(c.place % 8)::INTEGER], '')"
        right = "array_to_string(u.kids[(c.place % 8)::INTEGER + 2:], '')"
        out.append(
            f"{t}p{i + 1} AS (SELECT c.key, c.grp, u.place, "
            f"CASE WHEN u.grew THEN c.path || {left} || {right} ELSE c.path END AS path, "
            f"CASE WHEN u.grew THEN sha256({left} || c.other || {right}) ELSE c.other END AS other "
            f"FROM {t}p{i} c JOIN {t}{i + 1} u ON c.grp = u.grp "
            f"AND u.place = CASE WHEN u.grew THEN c.place // 8 ELSE c.place END)"
        )
    return ",\n".join(out)


def _leaf(text: str) -> str:
    field = "coalesce(octet_length(encode({0}))::VARCHAR || ':' || {0}, '-')"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


#: Up to 8 ** 9 leaves a group, and as many groups.
_LEVELS = 9
_TAMPERED = f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"

MERKLE_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf('text')} AS digest, {_leaf(_TAMPERED)} AS other FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS key, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
         count(*) OVER (PARTITION BY grp) AS n FROM hashed),
{_tree('a', 'SELECT grp, place, n, digest FROM leaves', "SELECT key, grp, place, '' AS path, other FROM leaves", _LEVELS)},
subroots AS (
  SELECT grp AS below, digest, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM a{_LEVELS}),
{_tree('b', "SELECT '' AS grp, place, n, digest FROM subroots",
       f"SELECT key, '' AS grp, s.place, path, other FROM ap{_LEVELS} x JOIN subroots s ON x.grp = s.below", _LEVELS)}
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(p.path) AS proof_sha256,
       p.other AS folded_root, p.other = r.digest AS verified
FROM leaves l JOIN subroots s ON l.grp = s.below JOIN bp{_LEVELS} p ON l.key = p.key, b{_LEVELS} r
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licenses_sql(templates, base, rare: int, band: int, min_score: float) -> str:
    """The licence scan by plain joins of all word positions with all postings."""
    fold = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    listed = ", ".join(f"({i}, {_text(label)}, {_text(text)})" for i, (label, text, _) in enumerate(templates))
    keys = ", ".join(f"({i}, {_text(key)})" for i, (_, _, keys) in enumerate(templates) for key in keys)
    phrases = ", ".join(f"({_text(label)}, {_text(p)}, {_text(p.split()[0])}, {len(p.split())})" for label, p in base)
    return f"""
WITH tok AS (SELECT row_number() OVER () AS r, doc_id, {fold.format("coalesce(text, '')")} AS ws FROM documents),
pos AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM tok),
tpl AS (SELECT template, label, {fold.format('text')} AS ws FROM (VALUES {listed}) t(template, label, text)),
posted AS (SELECT template, label, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM tpl),
docs_with AS (SELECT word, count(DISTINCT r) AS n FROM pos WHERE word IN (SELECT word FROM posted) GROUP BY word),
weighed AS (
  SELECT p.*, coalesce(d.n, 0) AS df,
         round(ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (coalesce(d.n, 0) + 1)) * 1000)::BIGINT + 1 AS weight
  FROM posted p LEFT JOIN docs_with d ON p.word = d.word),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY template ORDER BY df, word) AS place FROM weighed),
sized AS (SELECT *, max(place) OVER (PARTITION BY template) AS words FROM ranked),
kept AS (SELECT * FROM sized WHERE place <= least({rare}, (words + 1) // 2)),
totals AS (SELECT template, sum(weight) AS total FROM (SELECT DISTINCT template, word, weight FROM kept) GROUP BY template),
pairs AS (
  SELECT DISTINCT r, template, label, k.word, weight, s.shift, floor((pos.i - k.i + s.shift) / {band}.0) AS band
  FROM pos JOIN kept k ON pos.word = k.word, (VALUES (0), ({band // 2})) s(shift)),
aligned AS (SELECT r, template, label, shift, band, sum(weight) AS weight FROM pairs GROUP BY ALL),
best AS (
  SELECT a.r, a.template, a.label, max(a.weight)::DOUBLE / max(t.total) AS score
  FROM aligned a JOIN totals t ON a.template = t.template GROUP BY ALL),
matches AS (
  SELECT b.* FROM best b JOIN tok ON b.r = tok.r WHERE score >= {min_score} AND NOT EXISTS (
    SELECT 1 FROM (VALUES {keys}) k(template, phrase) WHERE k.template = b.template
    AND NOT contains(' ' || array_to_string(tok.ws, ' ') || ' ', ' ' || k.phrase || ' '))),
base AS (
  SELECT p.r, f.label, p.i FROM pos p JOIN (VALUES {phrases}) f(label, phrase, word, n) ON p.word = f.word
  JOIN tok ON tok.r = p.r WHERE array_to_string(tok.ws[(p.i + 1)::INTEGER:(p.i + f.n)::INTEGER], ' ') = f.phrase),
based AS (SELECT r, count(*) AS n, min(i) AS first, max(i) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
labelled AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM matches) GROUP BY r),
scored AS (SELECT r, max(score) AS score FROM matches GROUP BY r)
SELECT t.doc_id, len(t.ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first::BIGINT AS first_word,
       b.last::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(s.score, 0.0)::DOUBLE END AS score
FROM tok t LEFT JOIN based b ON t.r = b.r LEFT JOIN labelled l ON t.r = l.r LEFT JOIN scored s ON t.r = s.r
"""


_SAID = "md5(octet_length(encode(role))::VARCHAR || ':' || role || text)"

TURNS_SQL = f"""
WITH filled AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, text, {_SAID} AS tid, row_number() OVER (
    PARTITION BY c ORDER BY turn NULLS FIRST, substr(role, 1, 16), substr(text, 1, 16), {_SAID}) - 1 AS i FROM filled),
convs AS (SELECT c, {crc32_sql('c::VARCHAR')} % 6 AS h, c - c % 100 AS b FROM (SELECT DISTINCT c FROM own)),
joined AS (
  SELECT v.c, 0 AS part, o.i, o.tid, o.text FROM convs v JOIN own o ON o.c = v.b AND o.i < v.h
  UNION ALL SELECT v.c, 1, o.i, o.tid, o.text FROM convs v JOIN own o ON o.c = v.c AND o.i >= v.h),
seqs AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d, tid, length(text) AS len FROM joined),
prefixes AS (
  SELECT c, d, string_agg(tid, '/') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS p, len FROM seqs
  UNION ALL SELECT c, 0, '', 0 FROM convs),
nodes AS (SELECT d, p, min(c) AS node, count(*) AS n, max(len) AS len FROM prefixes GROUP BY d, p),
member AS (SELECT x.c, x.d, n.node FROM prefixes x JOIN nodes n ON x.d = n.d AND x.p = n.p),
linked AS (
  SELECT n.*, m.node AS up FROM nodes n LEFT JOIN member m ON m.c = n.node AND m.d = n.d - 1),
kids AS (SELECT d - 1 AS d, up AS node, count(*) AS k FROM linked WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(k.k, 0) AS k FROM linked l LEFT JOIN kids k ON k.d = l.d AND k.node = l.node),
sums AS (
  SELECT m.d, m.node, sum((f.n - 1) * f.len) AS saved, count(*) FILTER (WHERE f.k = 0) AS leaves
  FROM full_nodes f JOIN member m ON m.c = f.node AND m.d <= f.d GROUP BY 1, 2),
lengths AS (SELECT c, max(d) AS d FROM prefixes GROUP BY c),
ended AS (
  SELECT m.d, m.node, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids
  FROM lengths l JOIN member m ON l.c = m.c AND l.d = m.d GROUP BY 1, 2)
SELECT f.node AS conv_id, f.d::BIGINT AS depth, f.up AS parent_conv_id, f.n::BIGINT AS n_convs, f.k::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_nodes f JOIN sums s ON s.d = f.d AND s.node = f.node LEFT JOIN ended e ON e.d = f.d AND e.node = f.node
"""
