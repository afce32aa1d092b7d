"""DuckDB SQL for those numbered queries that SQL can express."""

from __future__ import annotations

from tailfold.llm import settings

_PARTS = [*settings.MIX_PARTS.values(), settings.MIX_REST_PARTS]
_NAMES = ", ".join(f"('{n}', {i + 1})" for i, n in enumerate(settings.MIX_PARTS))
_LANES = len(_PARTS)
_B = settings.MIX_BLOCK_DOCS

# Slot by slot: of the lanes that have blocks left and one released, the earliest deadline runs.
_MIX = f"""
WITH RECURSIVE names(source, lane) AS (VALUES {_NAMES}),
ranked AS (
  SELECT doc_id, d.source, coalesce(n.lane, {_LANES}) AS lane_no, n.source AS lane,
         row_number() OVER (PARTITION BY coalesce(n.lane, {_LANES})
                            ORDER BY md5('{settings.MIX_SEED}:' || doc_id), doc_id) - 1 AS rank
  FROM documents d LEFT JOIN names n ON d.source = n.source),
need AS (
  SELECT list(coalesce(blocks, 0) ORDER BY i) AS nb
  FROM range(1, {_LANES} + 1) t(i) LEFT JOIN (
    SELECT lane_no, (count(*) + {_B - 1}) // {_B} AS blocks FROM ranked GROUP BY 1) c
  ON c.lane_no = t.i),
sim AS (
  SELECT 0::BIGINT AS slot, 0::BIGINT AS start_slot, [0::BIGINT FOR i IN range({_LANES})] AS used,
         [0::BIGINT FOR i IN range({_LANES})] AS base, 0::BIGINT AS lane_no, 0::BIGINT AS block
  UNION ALL
  SELECT slot + 1, CASE WHEN ended THEN slot + 1 ELSE start_slot END, now_used,
         CASE WHEN ended THEN now_used ELSE base END, pick, used[pick]
  FROM (
    SELECT *, nb[pick] = now_used[pick] AS ended
    FROM (
      SELECT *, list_transform(used, lambda u, i: CASE WHEN i = pick THEN u + 1 ELSE u END) AS now_used
      FROM (
        SELECT *, list_sort(list_filter(
          list_transform(range(1, {_LANES} + 1), lambda i: struct_pack(
            due := ((used[i] - base[i] + 1) * period + p[i] - 1) // p[i], lane := i,
            free := used[i] < nb[i]
                    AND (used[i] - base[i]) * period // p[i] <= slot - start_slot)),
          lambda x: x.free))[1].lane AS pick
        FROM (
          SELECT sim.*, nb, p, list_sum(list_transform(range(1, {_LANES} + 1),
                 lambda i: CASE WHEN used[i] < nb[i] THEN p[i] ELSE 0 END))::BIGINT AS period
          FROM sim, need, (SELECT {_PARTS} AS p) WHERE list_sum(used) < list_sum(nb)))))),
slots AS (SELECT slot - 1 AS slot, lane_no, block FROM sim WHERE lane_no > 0)
SELECT r.doc_id, r.source, r.lane, s.block, s.slot,
       row_number() OVER (ORDER BY s.slot, r.rank) - 1 AS position
FROM ranked r JOIN slots s ON s.lane_no = r.lane_no AND s.block = r.rank // {_B}
"""

_EXACT = r"""
WITH d AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

# Every two documents that share an n-gram are compared; far too slow beyond small tables.
_NGRAMS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) >= 5
           THEN list_distinct(list_transform(range(1, len(words) - 3),
                                             lambda i: list_aggregate(words[i:i + 4], 'string_agg', ' ')))
           WHEN len(words) > 0 THEN [list_aggregate(words, 'string_agg', ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * common >= 75 * (nx.n + ny.n - common)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""

# What the examples must say; formatted_chars adds up the prefixes that end in a reply, and the
# whole conversation if it does not end in one.
_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back,
         sum(length('<|im_start|>') + length(role) + 1 + length(text)
             + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1)
           OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                 ROWS UNBOUNDED PRECEDING) AS prefix
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY back DESC)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY back DESC) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(prefix) FILTER (role = 'assistant' OR back = 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

# CRC-32 bit by bit; near words meet by the strings that are left without one code point.
_SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head,
         unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run
  FROM documents),
lowered AS (
  SELECT head, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
bits AS (
  SELECT run, flatten(list_transform(list_transform(string_split(head || run, ''), lambda c: ord(c)),
           lambda c: CASE WHEN c < 128 THEN [c::UINTEGER]
                          ELSE [(192 + c // 64)::UINTEGER, (128 + c % 64)::UINTEGER] END)) AS bytes
  FROM lowered),
hashed AS (
  SELECT run, xor(4294967295::BIGINT, list_reduce(
           flatten(list_transform(bytes, lambda b: list_transform(range(8), lambda i: (b >> i::UINTEGER)::BIGINT & 1))),
           lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1)),
           4294967295::BIGINT)) AS h
  FROM bits),
words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 <> 0 THEN run
                ELSE left(run, h % length(run)) || substr(run, h % length(run) + 2) END AS word
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cuts AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (
  SELECT DISTINCT cuts.word AS long, words.word AS short FROM cuts JOIN words ON words.word = cuts.cut),
near AS (
  SELECT long AS word, short AS other FROM shorter
  UNION ALL SELECT short, long FROM shorter
  UNION ALL SELECT a.word, b.word FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word),
counted AS (
  SELECT near.word, count(*) AS n_near,
         min({'less': -o.n, 'word': near.other}) AS best
  FROM near JOIN words o ON o.word = near.other GROUP BY 1),
known AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.less >= 10 * n THEN best.word END AS form,
         CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n
  FROM words LEFT JOIN counted ON counted.word = words.word),
chain AS (
  SELECT word, word AS root, 0 AS hops FROM known
  UNION ALL SELECT chain.word, k.form, hops + 1 FROM chain JOIN known k ON k.word = chain.root WHERE k.form IS NOT NULL)
SELECT known.word, form, root, n, n_near, form_n
FROM known JOIN (SELECT word, arg_max(root, hops) AS root FROM chain GROUP BY 1) last ON last.word = known.word
"""

SQL = {"op6_chat_format": _CHAT, "op8_ngram_join": _NGRAMS, "op1_mix_sources": _MIX, "op9_exact_dedup": _EXACT,
       "op12_spelling": _SPELLING}
