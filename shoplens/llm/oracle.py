"""DuckDB statements for the operators that SQL can express, written from the contracts."""

from __future__ import annotations

#: Unsigned CRC-32 byte by byte, with the table of its polynomial made by its rule.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(CAST(i AS UBIGINT), list_transform(range(8), lambda k: CAST(0 AS UBIGINT))),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END)) AS tab
)"""


def _crc32(text: str) -> str:
    """The checksum of an expression's UTF-8 bytes, in a query that also reads ``crc_table``."""
    byte = f"CAST(('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2)) AS UBIGINT)"
    return f"""CAST(xor(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(CAST(octet_length(encode({text})) AS BIGINT)), lambda i: {byte})),
    lambda c, b: xor(c >> 8, tab[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), CAST(4294967295 AS UBIGINT)) AS BIGINT)"""


def _lower(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(words: int) -> str:
    """(rid, doc_id, n_shingles, component_id) of documents linked by their sets of word n-grams at 80 per cent."""
    return rf"""WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array({_lower("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {words - 2}), lambda i: array_to_string(ws[i:i + {words - 1}], ' '))) END AS grams
  FROM split
),
-- documents with equal sets are linked; the first of them stands for all
classes AS (SELECT *, min(rid) OVER (PARTITION BY list_sort(grams)) AS cls FROM sets),
each AS (SELECT rid, len(grams) AS n, unnest(grams) AS gram FROM classes WHERE rid = cls),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM each a JOIN each b ON a.gram = b.gram AND a.rid < b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS cls, a AS other FROM ways UNION SELECT r.cls, w.b FROM reach r JOIN ways w ON r.other = w.a),
roots AS (SELECT cls, min(other) AS root FROM reach GROUP BY cls),
placed AS (SELECT c.*, coalesce(r.root, c.cls) AS root FROM classes c LEFT JOIN roots r USING (cls)),
named AS (
  SELECT rid, doc_id, len(grams) AS n_shingles,
         CASE WHEN len(grams) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY root) END AS component_id
  FROM placed
)"""


def _repair() -> str:
    """Conversations repaired by following, row by row, the cheapest and then least audit into each state."""
    role = "coalesce(role, ' ')"
    text = "coalesce(text, ' ')"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    # the role that a row may be given, or that an inserted row has, in each state
    other = "CASE WHEN {s} = 'u' THEN 'assistant' ELSE 'user' END"
    inserted = f"""
  SELECT conv_id, pos, substr({other.format(s='s')}, 1, 1) AS s, cost + 3 AS cost, audit || 'I' AS audit,
         list_append(said, {other.format(s='s')} || ':') AS said FROM"""
    return rf"""WITH RECURSIVE {_CRC_TABLE},
fates AS (SELECT conv_id, turn, {role} AS role, {text} AS text, {_crc32(key)} % 20 AS fate FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fates, range(2) r WHERE fate <> 0 AND (r.range = 0 OR fate = 3)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS inside
  FROM damaged
),
faults AS (
  SELECT *, CASE WHEN inside = '' THEN 'B'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'D'
      WHEN substr(inside, length(inside), 1) NOT IN ('.', '!', '?') THEN 'T' ELSE '' END AS fault,
    substr(role, 1, 1) AS initial
  FROM numbered
),
lengths AS (SELECT conv_id, max(pos) AS n FROM faults GROUP BY conv_id),
front AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, '' AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS said FROM lengths
  UNION ALL
  SELECT conv_id, pos, s, best.cost, best.audit, best.said FROM (
    SELECT conv_id, pos, s, min(struct_pack(cost := cost, audit := audit, said := said)) AS best FROM (
      -- of each state now, without, with one and with two inserted rows, every edit of the next row
      WITH here AS (SELECT * FROM front),
      one AS ({inserted} here),
      two AS ({inserted} one),
      all_ AS (SELECT * FROM here UNION ALL SELECT * FROM one UNION ALL SELECT * FROM two),
      next AS (
        SELECT a.*, f.role, f.text, f.fault, f.initial, CASE WHEN f.fault = 'T' THEN 3 ELSE 0 END AS more
        FROM all_ a JOIN faults f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.pos = a.pos + 1
      )
      SELECT conv_id, pos + 1 AS pos, s, cost + 4 AS cost, audit || 'D' AS audit, said FROM next
      UNION ALL
      SELECT conv_id, pos + 1, substr({other.format(s='s')}, 1, 1), cost + 3 + more, audit || 'R',
             list_append(said, {other.format(s='s')} || ':' || text) FROM next WHERE fault IN ('', 'T')
      UNION ALL
      SELECT conv_id, pos + 1, initial, cost + more, audit || 'K', list_append(said, role || ':' || text) FROM next
      WHERE fault IN ('', 'T') AND (initial = 's' AND s = '' OR initial = 'u' AND s <> 'u' OR initial = 'a' AND s = 'u')
    ) GROUP BY conv_id, pos, s
  )
),
ends AS (
  SELECT f.* FROM front f JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.n = f.pos
),
one_more AS ({inserted} ends),
two_more AS ({inserted} one_more),
repaired AS (
  SELECT conv_id, min(struct_pack(cost := cost, audit := audit, said := said)) AS best
  FROM (SELECT * FROM ends UNION ALL SELECT * FROM one_more UNION ALL SELECT * FROM two_more) WHERE s IN ('', 'a') GROUP BY conv_id
),
pairs AS (
  SELECT conv_id, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM faults
),
illegal AS (SELECT conv_id, count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'B') AS blank,
         count(*) FILTER (WHERE fault = 'D') AS duplicate, count(*) FILTER (WHERE fault = 'T') AS truncated
  FROM faults GROUP BY conv_id
),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(i.illegal, 0) AS illegal, coalesce(r.best.cost, 0) AS cost,
       coalesce(r.best.audit, '') AS audit, sha256(coalesce(array_to_string(r.best.said, chr(10)), '')) AS repaired_sha256
FROM every e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN illegal i ON i.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id"""


def _spelling() -> str:
    """Words, their near words by the words that one deleted letter leaves, and forms followed to the last."""
    return rf"""WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_lower("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run),
hashed AS (SELECT run, n, {_crc32("id || ':' || run")} AS h FROM counted, crc_table),
hit AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM hit WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (
  SELECT word, n, substr(word, 1, i) || substr(word, i + 2) AS rest, i
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
near AS (
  -- one letter replaced: the same rest without the letter at the same place
  SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -n, form := other)) AS first FROM near GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.first.less >= 5 * w.n THEN b.first.form END AS form,
         CASE WHEN -b.first.less >= 5 * w.n THEN -b.first.less END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
followed AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT f.word, g.form, f.steps + 1 FROM followed f JOIN forms g ON f.root = g.word WHERE g.form IS NOT NULL
),
roots AS (SELECT word, max_by(root, steps) AS root FROM followed GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r USING (word)"""


SQL = {
    "op3_exact_dedup": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g USING (x)
""",
    "op7_near_dedup": _components(4)
    + """
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM named""",
    "op11_conversation_repair": _repair(),
    "op12_spelling_variants": _spelling(),
    "op13_ngram_join": _components(5) + "\nSELECT doc_id, n_shingles, component_id FROM named",
}
