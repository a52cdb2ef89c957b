"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from tarmac.llm.licences import ANCHORS, PATTERNS, RULES, SENTENCES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_scan() -> str:
    known = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in SENTENCES.items())
    patterns = " ".join(
        f"WHEN regexp_matches(s, {_quoted(p)}) THEN {_quoted(i)}" for p, i in PATTERNS.items()
    )
    # Each rule is a step of its own: what it finds is noted, and used up.
    steps, last = [], "listed"
    for k, (licence, names) in enumerate(RULES):
        sequence = _quoted("".join(f"<{n}>" for n in names))
        steps.append(
            f"step{k} AS (SELECT doc_id, ids, replace(rest, {sequence}, '<+>') AS rest, "
            f"CASE WHEN contains(rest, {sequence}) THEN list_append(found, {_quoted(licence)}) ELSE found END AS found "
            f"FROM {last})"
        )
        last = f"step{k}"
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (
  SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n
  FROM (SELECT doc_id, string_split_regex(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\r\n]+|[.!?;]+[ \t]+') AS pieces
        FROM documents WHERE regexp_matches(text, '(?i){"|".join(ANCHORS)}'))),
plain AS (
  SELECT doc_id, n, regexp_replace(regexp_replace(piece, '[^a-z0-9.]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g') AS s
  FROM cut),
named AS (
  SELECT p.doc_id, p.n, coalesce(k.id, CASE {patterns} ELSE '-' END) AS id
  FROM plain p LEFT JOIN known k ON p.s = k.sentence WHERE p.s <> ''),
joined AS (
  SELECT doc_id, regexp_replace(regexp_replace(string_agg('<' || id || '>', '' ORDER BY n),
      '(<->)+', '<->', 'g'), '^(<->)|(<->)$', '', 'g') AS ids
  FROM named GROUP BY doc_id),
listed AS (
  SELECT d.doc_id, coalesce(j.ids, '') AS ids, coalesce(j.ids, '') AS rest, CAST([] AS VARCHAR[]) AS found
  FROM documents d LEFT JOIN joined j USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, regexp_replace(replace(ids, '><', ','), '[<>]', '', 'g') AS sentence_ids,
  coalesce(array_to_string(list_transform(
    list_filter(found, lambda x, i: NOT list_contains(found[1:i - 1], x)), lambda x: x), ','), '') AS licences
FROM {last}"""


_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS most,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sums),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM levels),
drawn AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1.0::DOUBLE END AS rate,
    ('0x' || md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null'))[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM drawn"""

_REPEATED_PASSAGES = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM texts),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS pos FROM texts WHERE len(ws) >= 13),
windows AS (SELECT doc_id, pos, array_to_string(ws[pos:pos + 12], ' ') AS w FROM places),
lowest AS (SELECT w, min(doc_id) AS low FROM windows GROUP BY w),
hits AS (SELECT doc_id, pos FROM windows JOIN lowest USING (w) WHERE doc_id > low),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM hits, range(13) AS r(k)),
marked AS (SELECT w.doc_id, w.word, w.pos, g.pos IS NOT NULL AS out FROM words w LEFT JOIN gone g USING (doc_id, pos)),
per_text AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (out) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT out) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_text USING (doc_id)"""

_NEAR_DUPLICATES = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[pos:pos + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS pos FROM texts WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.low AS component_id, d.doc_id = r.low AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r USING (doc_id)"""

_WARC_ARCHIVES = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages),
kept AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS top FROM sized)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM kept"""

_PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce("text", '')} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
plan AS (
  SELECT c, own, c - c % 5 AS source, CAST(xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT) % 9 AS BIGINT) AS h
  FROM turns),
built AS (
  SELECT p.c, list_concat(coalesce(t.own, [])[1:p.h], p.own[p.h + 1:]) AS seq
  FROM plan p LEFT JOIN turns t ON t.c = p.source),
prefixes AS (SELECT c, len(seq) AS n, unnest(range(0, len(seq) + 1)) AS d, seq FROM built),
grouped AS (
  SELECT seq[1:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM prefixes GROUP BY 1, 2),
kids AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n FROM grouped WHERE d > 0 GROUP BY 1, 2),
valued AS (
  SELECT g.*, coalesce(k.n, 0) AS n_children, CASE WHEN g.d > 0 THEN (n_convs - 1) * strlen(g.node[-1]."text") ELSE 0 END AS saved
  FROM grouped g LEFT JOIN kids k ON k.node = g.node AND k.d = g.d),
raised AS (SELECT node, n_children, saved, unnest(range(0, d + 1)) AS up FROM valued),
totals AS (
  SELECT node[1:up] AS node, up, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM raised GROUP BY 1, 2)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves,
  CAST(t.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN totals t ON t.node = v.node AND t.up = v.d
LEFT JOIN grouped p ON p.node = v.node[1:v.d - 1] AND p.d = v.d - 1"""

_COLLOCATIONS = r"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
pieces AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM cut),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
words AS (SELECT piece, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pieces),
runs AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM words
  WINDOW p AS (PARTITION BY piece ORDER BY i)),
seen AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM runs GROUP BY 1, 2, 3
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY 1, 2, 3
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY 1, 2, 3),
candidates AS (SELECT *, string_split(phrase, ' ') AS ws FROM seen WHERE k > 1 AND a >= 10),
parts AS (
  SELECT lang, k, phrase, a, at_word, array_to_string(ws[1:at_word], ' ') AS head, array_to_string(ws[at_word + 1:], ' ') AS tail
  FROM candidates, (VALUES (1), (2)) s(at_word) WHERE at_word < k),
cuts AS (
  SELECT p.lang, p.k, p.phrase, p.a, at_word, f.a AS l, g.a AS r,
    CAST(1000000::HUGEINT * p.a * p.a // (f.a::HUGEINT * g.a) AS BIGINT) AS score
  FROM parts p JOIN seen f ON f.lang = p.lang AND f.phrase = head JOIN seen g ON g.lang = p.lang AND g.phrase = tail),
scored AS (
  SELECT lang, k, phrase, a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, at_word) = 1),
inside AS (
  SELECT lang, array_to_string(ws[j:j + 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (VALUES (1), (2)) o(j) WHERE k = 3 GROUP BY 1, 2)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, encode(s.phrase)) AS rank,
  s.phrase, s.a, l, r, t.n, score
FROM scored s JOIN totals t USING (lang) LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE s.k = 3 OR i.most IS NULL OR 100 * i.most < 50 * s.a
QUALIFY rank <= 2000"""

ORACLES: dict[str, str] = {
    "op1_licence_scan": _licence_scan(),
    "op2_mixing": _MIXING,
    "op7_repeated_passages": _REPEATED_PASSAGES,
    "op8_near_duplicates": _NEAR_DUPLICATES,
    "op11_warc_archives": _WARC_ARCHIVES,
    "op12_prefix_trie": _PREFIX_TRIE,
    "op13_collocations": _COLLOCATIONS,
}
