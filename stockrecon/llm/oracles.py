"""The same results in SQL for the queries that SQL can express.

Not here: op2 to op4, op7 and op9 rest on models, bounds and schedules that are fitted step by
step, op6 on token ids, op8 on parsing HTML, op13 on chains of matches; tests/llm compare those with plain loops.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH vectors AS (
  SELECT vec_id AS id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
scores AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         list_sum(list_transform(list_zip(q.vector, c.vector), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON c.id <> q.id WHERE q.id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""

OP5 = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(
      regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'),
      lambda x: x <> '') AS words
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(words) < 2 THEN words ELSE list_distinct(
      list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles
  FROM split),
spread AS MATERIALIZED (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM spread a JOIN spread b ON b.shingle = a.shingle AND b.doc_id <> a.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.shingles) + len(y.shingles) - n)),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
SELECT doc_id, any_value(len(shingles))::BIGINT AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reached JOIN sets USING (doc_id) GROUP BY doc_id"""


def _escaped(column: str) -> str:
    """Length of an escaped text: one more for each backslash and for each control string."""
    controls = ("\\", "<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
    more = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in controls]
    return f"(length({column}) + {' + '.join(more)})"


OP10 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
         sum(16 + {_escaped('role')} + length(role) - length(replace(role, chr(10), '')) + {_escaped('text')})::BIGINT
           AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM whole"""

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
spread AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
           lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
  FROM split, (SELECT unnest([1, 2, 3]) AS size) AS sizes),
total AS (SELECT lang, count(*) AS n FROM spread WHERE size = 1 GROUP BY lang),
grams AS MATERIALIZED (
  SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM spread GROUP BY ALL HAVING count(*) >= 10),
around AS (
  SELECT lang, phrase, max(f) AS around FROM (
    SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
    FROM grams WHERE size = 3)
  GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, size, phrase, w, f FROM grams LEFT JOIN around USING (lang, phrase)
  WHERE size > 1 AND (around IS NULL OR 100 * around < 50 * f)),
halves AS MATERIALIZED (
  SELECT lang, phrase, f AS a, 1 AS k, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM kept
  UNION ALL SELECT lang, phrase, f, 2, array_to_string(w[1:2], ' '), w[3] FROM kept WHERE size = 3),
firsts AS MATERIALIZED (
  SELECT halves.*, f AS l FROM halves JOIN grams ON grams.lang = halves.lang AND grams.phrase = halves.x),
cuts AS (
  SELECT firsts.lang, firsts.phrase, a, l, f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * f) AS score
  FROM firsts JOIN grams ON grams.lang = firsts.lang AND grams.phrase = firsts.y
  QUALIFY row_number() OVER (PARTITION BY firsts.lang, firsts.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM cuts JOIN total USING (lang) QUALIFY rank <= 2000"""

_TERMS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP12 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sums AS (SELECT count(*) FILTER (len(terms) > 0) AS nn, sum(len(terms))::BIGINT AS ll FROM docs),
tfs AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY ALL),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, sums GROUP BY term),
lengths AS (SELECT doc, doc_id, 100 - 25 + (25 * len(terms) * nn) // ll AS m FROM docs, sums),
scores AS (
  SELECT item_id, doc, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (doc) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores JOIN lengths USING (doc) WHERE score > 0 QUALIFY rank <= 20"""

ORACLES = {"op1_nra": OP1, "op5_superminhash": OP5, "op10_chat_format": OP10, "op11_misra_gries": OP11, "op12_bag_search": OP12}
