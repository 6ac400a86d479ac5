"""SQL (DuckDB) with the rows of those queries that SQL can express."""

from __future__ import annotations

from ledgerflow.llm.reply_trees import ESCAPE

_MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         (CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents
), docs AS (
  SELECT doc_id, source, coalesce(words, 0) AS size,
         -ln(u) / (1 - 0.75::DOUBLE * (len(lines) - len(list_distinct(lines))) / greatest(1, len(lines))) AS k
  FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
         source_size * 2.0::DOUBLE AS most
  FROM sources
), filling AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS t, sum(w) OVER () AS all_w,
         coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(w) OVER o, 0) AS w_before
  FROM weighted
  WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, w * (t - most_before) >= most * (all_w - w_before) AS limited FROM filling
), targets AS (
  SELECT source, source_size,
         CASE WHEN limited THEN most ELSE w * ((t - coalesce(sum(most) FILTER (limited) OVER (), 0))
           / sum(w) FILTER (NOT limited) OVER ()) END AS target
  FROM marked
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(2, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS epochs
  FROM targets
), running AS (
  SELECT d.doc_id, d.size, d.k, d.source, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.k) AS together
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
), gaps AS (
  SELECT *, upto <= budget AND budget > 0 AS chosen,
         budget - coalesce(max(upto) FILTER (upto <= budget) OVER (PARTITION BY source), 0) AS gap
  FROM running
), units AS (
  SELECT source, k, any_value(together) AS words, any_value(gap) AS gap,
         row_number() OVER (PARTITION BY source ORDER BY any_value(together) DESC, k) AS i
  FROM gaps WHERE NOT chosen AND together BETWEEN 1 AND gap GROUP BY source, k
), fills AS (
  SELECT source, 0::BIGINT AS i, any_value(gap) AS room, NULL::DOUBLE AS k FROM units GROUP BY source
  UNION ALL
  SELECT u.source, u.i, CASE WHEN words <= room THEN room - words ELSE room END, CASE WHEN words <= room THEN u.k END
  FROM fills f JOIN units u ON u.source IS NOT DISTINCT FROM f.source AND u.i = f.i + 1
)
SELECT g.doc_id, g.size, source_size, target,
       CAST(g.size * (epochs + CASE WHEN chosen OR f.k IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM gaps g LEFT JOIN (SELECT source, k FROM fills WHERE k IS NOT NULL) f ON f.source IS NOT DISTINCT FROM g.source AND f.k = g.k
"""

_CHATS = rf"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), plain AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS n,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM turns
), shown AS (
  SELECT *, length('<|im_start|>')
         + length(replace(replace(regexp_replace(role, '{ESCAPE}', '\1\\\2\3', 'g'), '\', '\e'), chr(10), '\n')) + 1
         + length(regexp_replace(text, '{ESCAPE}', '\1\\\2\3', 'g')) + length('<|im_end|>') + 1 AS chars
  FROM plain
), joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS said,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM shown GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM joined
"""

_REACH = """
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, l.b FROM reach r JOIN edges l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
"""

_NEAR_TEXTS = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded
), classes AS (
  SELECT doc_id, len(s) AS n, s, min(doc_id) OVER (PARTITION BY CASE WHEN len(s) = 0 THEN [CAST(doc_id AS VARCHAR), ' ']
           ELSE list_sort(s) END) AS rep
  FROM shingled
), items AS (
  SELECT rep, n, unnest(s) AS item FROM classes WHERE doc_id = rep
), links AS (
  SELECT x.rep AS a, y.rep AS b FROM items x JOIN items y ON x.item = y.item AND x.rep < y.rep
  GROUP BY x.rep, y.rep, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), {_REACH}
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(least(low, rep), rep) AS component_id,
       doc_id = coalesce(least(low, rep), rep) AS kept
FROM classes LEFT JOIN lowest ON a = rep
"""

_NEAR_VECTORS = rf"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.98
), {_REACH}, degrees AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(least(low, vec_id), vec_id) AS component_id,
       vec_id = coalesce(least(low, vec_id), vec_id) AS kept
FROM embeddings LEFT JOIN lowest ON lowest.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id
"""

_TRIE = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), named AS (
  SELECT DISTINCT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS code
  FROM turns
), ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, code), lambda crc, b:
           list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i:
             CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 6 AS head
  FROM named
), taken AS (
  SELECT i.conv_id, 0 AS own, place, role, text FROM ids i JOIN turns t ON t.conv_id = i.base AND place <= head
  UNION ALL
  SELECT i.conv_id, 1, place, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND place > head
), rebuilt AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY own, place) FILTER (own IS NOT NULL) AS said
  FROM ids LEFT JOIN taken USING (conv_id) GROUP BY conv_id
), paths AS (
  SELECT conv_id, coalesce(said, []) AS said, unnest(range(0, len(coalesce(said, [])) + 1)) AS depth FROM rebuilt
), nodes AS (
  SELECT said[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(said) = depth), '') AS ends
  FROM paths GROUP BY 1, 2
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), valued AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(node[depth].text) END AS saved
  FROM nodes LEFT JOIN children USING (node)
), above AS (
  SELECT node, saved, n_children, unnest(range(0, depth + 1)) AS d FROM valued
), subtrees AS (
  SELECT node[1:d] AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM above GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN subtrees s ON s.node = v.node LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), sized AS (
  SELECT lang, w, i, unnest([1, 2, 3, 4, 5]) AS words FROM places
), counts AS (
  SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM sized WHERE i + words - 1 <= len(w) GROUP BY 1, 2, 3
), candidates AS (
  SELECT lang, words, phrase, f FROM counts WHERE words >= 2 AND f >= 100
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.words > c.words AND 100 * o.f >= 100 * c.f
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM kept
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, n, (1000 * a * n) // (l.f * r.f) AS score
  FROM cuts JOIN totals ON totals.lang = cuts.lang
  JOIN counts l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN counts r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest QUALIFY rank <= 2000
"""

ORACLE = {
    "op1_mix_sources": _MIX,
    "op2_minhash": _NEAR_TEXTS,
    "op5_reply_trees": _CHATS,
    "op7_near_vectors": _NEAR_VECTORS,
    "op12_prefix_trie": _TRIE,
    "op13_collocations": _PHRASES,
}
