"""DuckDB SQL for the registered queries that SQL can express."""

from millrace.llm.licenses import SHINGLE, TEMPLATES, shingles_of
from millrace.llm.rules import RULES, SHOUTS, STOP_WORDS, SYMBOLS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _verdict() -> str:
    parts = []
    for rule in RULES:
        per = rule.per or "1"
        if rule.low is not None:
            parts.append(f"{rule.value} >= {rule.low!r}::DOUBLE * {per}")
        if rule.high is not None:
            parts.append(f"{rule.value} <= {rule.high!r}::DOUBLE * {per}")
    return " AND ".join(parts)


RULES_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), windows AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM base WHERE len(words) >= 3)
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT row, count(DISTINCT i + j) AS n FROM twice CROSS JOIN (SELECT unnest(range(0, 3)) AS j) GROUP BY row
), lines AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
), counts AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[{SYMBOLS}]')) AS BIGINT) AS n_symbols,
    len(regexp_extract_all(text, '[{SHOUTS}]')) AS n_shouts,
    len(list_filter(words, lambda w: w IN ({', '.join(f"'{w}'" for w in sorted(set(STOP_WORDS)))}))) AS n_stop_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM base LEFT JOIN lines USING (row) LEFT JOIN repeats USING (row)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_verdict()} AS kept
FROM judged
"""

MIX_SQL = rf"""
WITH rows AS (
  SELECT row_number() OVER () AS row, doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM rows GROUP BY source
), limits AS (
  SELECT *, 3 * source_size AS lim, CASE number % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM sources
), levels AS (
  SELECT *, lim / weight AS meets,
    (total - coalesce(sum(lim) OVER (ORDER BY lim / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY lim / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM limits
), targets AS (
  SELECT *, least(lim::DOUBLE, weight * (SELECT level FROM levels WHERE level <= meets ORDER BY meets, number LIMIT 1)) AS target
  FROM levels
), starts AS (
  SELECT doc_id, size, source_size, target, number, CAST(round(target) AS BIGINT) AS wanted, CAST(coalesce(sum(size) OVER (
      PARTITION BY rows.source ORDER BY ord, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM rows JOIN targets ON rows.source IS NOT DISTINCT FROM targets.source
), parts AS (
  SELECT number, CAST(round(target) AS BIGINT) AS words, CAST(sum(CAST(round(target) AS BIGINT)) OVER (ORDER BY number) AS BIGINT) AS high
  FROM targets
), counts AS (
  SELECT max(total) AS total, (max(total) + 255) // 256 + CAST(floor((max(total) + 255) // 256 * CAST(0.05 AS DOUBLE)) AS BIGINT) + 256 AS n
  FROM targets
), slots AS (
  SELECT slot, (slot % 2147483648 * 1327217885 % 2147483648)::DOUBLE / 2147483648::DOUBLE * total AS point
  FROM (SELECT unnest(range(n)) AS slot, total FROM counts)
), placed AS (
  SELECT number, slot, row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS rank
  FROM slots JOIN parts ON point >= high - words AND point < high
), had AS (
  SELECT parts.number, (words + 255) // 256 AS blocks, count(slot) AS had
  FROM parts LEFT JOIN placed ON parts.number = placed.number GROUP BY ALL
), short AS (
  SELECT *, CAST(coalesce(sum(blocks - had) OVER (ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS after
  FROM had WHERE blocks > had
), schedule AS (
  SELECT number, rank, slot FROM placed
  UNION ALL
  SELECT number, rank, n + after + rank - had FROM (SELECT *, unnest(range(had, blocks)) AS rank FROM short), counts
), blocks AS (
  SELECT *, CASE WHEN size > 0 AND start < wanted THEN start // 256 END AS first_block,
    CASE WHEN size > 0 AND start < wanted
      THEN (least(start + least(2, (wanted - 1 - start) // source_size) * source_size + size, wanted) - 1) // 256 END AS last_block
  FROM starts
)
SELECT doc_id, size, source_size, target, CAST(
  least(size, greatest(0, wanted - start)) + least(size, greatest(0, wanted - start - source_size))
  + least(size, greatest(0, wanted - start - 2 * source_size)) AS BIGINT) AS taken,
  CAST(f.slot AS BIGINT) AS first_slot, CAST(l.slot AS BIGINT) AS last_slot
FROM blocks LEFT JOIN schedule f ON f.number = blocks.number AND f.rank = first_block
LEFT JOIN schedule l ON l.number = blocks.number AND l.rank = last_block
"""

TOP_K_SQL = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_SHINGLES = ", ".join(f"('{name}', '{s}')" for name, text in sorted(TEMPLATES.items()) for s in shingles_of(text))
LICENSE_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT row, doc_id, array_to_string(words[i : i + {SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT row, doc_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM texts WHERE len(words) >= {SHINGLE})
), templates(license, shingle) AS (VALUES {_SHINGLES}
), sizes AS (
  SELECT license, count(*) AS n FROM templates GROUP BY license
)
SELECT doc_id, license, CAST(any_value(n) AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_found,
  count(*)::DOUBLE / any_value(n)::DOUBLE AS containment
FROM shingles JOIN templates USING (shingle) JOIN sizes USING (license)
GROUP BY row, doc_id, license HAVING count(*)::DOUBLE / any_value(n)::DOUBLE >= 0.8
"""

NEGATIVES_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 3
"""

PHRASES_SQL = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT lang, unnest(pieces) AS piece FROM texts)
), grams AS (
  SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(
           range(1, greatest(len(words) - k + 2, 1)), lambda i: words[i : i + k - 1])))) AS gram
  FROM pieces
), counts AS (
  SELECT lang, gram, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY lang, gram
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE len(gram) = 1 GROUP BY lang
), candidates AS (
  SELECT lang, gram, f AS a FROM counts WHERE len(gram) > 1 AND f >= 100
), cuts AS (
  SELECT lang, gram, a, unnest(range(1, len(gram))) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.gram, c.a, x.f AS l, y.f AS r, t.n,
         CAST(1000 * CAST(c.a AS HUGEINT) * t.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.gram = c.gram[1 : c.k]
  JOIN counts y ON y.lang = c.lang AND y.gram = c.gram[c.k + 1 :]
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.gram ORDER BY score, c.k) = 1
), around AS (
  SELECT lang, gram[s : s + m - 1] AS gram, max(a) AS held
  FROM (SELECT lang, gram, a, m, unnest(range(1, len(gram) - m + 2)) AS s
        FROM (SELECT lang, gram, a, unnest(range(2, len(gram))) AS m FROM candidates))
  GROUP BY ALL
), named AS (
  SELECT s.lang, array_to_string(s.gram, ' ') AS phrase, s.a, s.l, s.r, s.n, s.score
  FROM scored s LEFT JOIN around h ON h.lang = s.lang AND h.gram = s.gram
  WHERE h.held IS NULL OR 100 * h.held < 100 * s.a
)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS BIGINT) AS rank,
       phrase, a, l, r, n, score
FROM named
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""
