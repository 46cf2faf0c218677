"""DuckDB SQL of the queries that SQL can express.

Encoding, packing, chunking and the approximate search have none: tests/llm
hold them against the libraries, brute force or an exact round trip.
"""

from __future__ import annotations

#: One row per word of every document, in order.
WORDS = r"""
word_lists AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
words AS (
  SELECT row_id, doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM word_lists)
"""

OP1 = r"""
WITH """ + WORDS + r""",
hashes AS (SELECT row_id, doc_id, i, word, (md5_number_upper(word) & 2147483647)::BIGINT AS h FROM words),
grams AS (
  SELECT row_id, doc_id, h % 65536 AS bucket FROM hashes
  UNION ALL
  SELECT row_id, doc_id, ((h * 1000003 + next) & 2147483647) % 65536 FROM (
    SELECT *, lead(h) OVER (PARTITION BY row_id ORDER BY i) AS next FROM hashes) WHERE next IS NOT NULL),
trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND coalesce(toxic, 0) = 0),
counted AS (
  SELECT bucket, count(*) + 1.0::DOUBLE AS raw, count(t.doc_id) + 1.0::DOUBLE AS target
  FROM grams g LEFT JOIN trusted t ON g.doc_id = t.doc_id AND t.doc_id % 4 <> 3 GROUP BY bucket),
totals AS (SELECT sum(raw) + 65536 - count(*) AS raw_total, sum(target) + 65536 - count(*) AS target_total FROM counted),
ratios AS (
  SELECT bucket, round((ln(target / target_total) - ln(raw / raw_total)) * 1000000)::BIGINT AS ratio
  FROM counted, totals),
scores AS (SELECT row_id, count(*) AS n_grams, sum(ratio)::BIGINT AS total FROM grams JOIN ratios USING (bucket) GROUP BY row_id),
windows AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, a, b, c) AS times FROM (
    SELECT row_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
    FROM words WINDOW o AS (PARTITION BY row_id ORDER BY i)) WHERE c IS NOT NULL),
repeats AS (
  SELECT row_id, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY row_id),
lines AS (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM word_lists),
line_counts AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
base AS (
  SELECT l.row_id, l.doc_id, len(l.words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(l.words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(l.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(c.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM word_lists l LEFT JOIN line_counts c ON l.row_id = c.row_id LEFT JOIN repeats r ON l.row_id = r.row_id),
held_out AS (
  SELECT floor(total / n_grams)::BIGINT AS mean FROM base JOIN trusted USING (doc_id) JOIN scores USING (row_id)
  WHERE doc_id % 4 = 3 AND NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)),
lowest AS (
  SELECT coalesce(list_sort(list(mean))[floor(0.001 * (count(*) - 1))::BIGINT + 1], -120000) AS threshold FROM held_out)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND coalesce(total, 0) >= threshold * coalesce(n_grams, 0) AS kept,
       coalesce(n_grams, 0)::BIGINT AS n_grams, coalesce(total, 0)::BIGINT AS log_ratio_millionths
FROM base LEFT JOIN scores USING (row_id) CROSS JOIN lowest
"""

OP2 = r"""
WITH """ + WORDS + r""",
pairs AS (
  SELECT row_id, i, word, lag(word) OVER (PARTITION BY row_id ORDER BY i) AS prior FROM words),
one AS (SELECT word, count(*)::DOUBLE AS n FROM words GROUP BY word),
two AS (SELECT prior, word, count(*)::DOUBLE AS n FROM pairs WHERE prior IS NOT NULL GROUP BY prior, word),
total AS (SELECT count(*)::DOUBLE AS n FROM words),
scored AS (
  SELECT p.row_id, p.prior IS NOT NULL AND two.n < 2 AS backed_off,
         CASE WHEN p.prior IS NULL THEN ln(own.n) - ln(total.n)
              WHEN two.n >= 2 THEN ln(two.n) - ln(context.n)
              ELSE ln(own.n) - ln(total.n) + ln(0.4::DOUBLE) END AS log_s
  FROM pairs p CROSS JOIN total JOIN one own ON p.word = own.word
  LEFT JOIN one context ON p.prior = context.word
  LEFT JOIN two ON p.prior = two.prior AND p.word = two.word),
sums AS (
  SELECT row_id, count(*) AS n_words, count(*) FILTER (backed_off) AS n_backed_off,
         sum(round_even(log_s * 1000000, 0))::BIGINT AS score FROM scored GROUP BY row_id)
SELECT l.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_backed_off, 0)::BIGINT AS n_backed_off,
       coalesce(score, 0)::BIGINT AS score_millionths
FROM word_lists l LEFT JOIN sums USING (row_id)
"""

OP4 = r"""
WITH RECURSIVE one_row AS (SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL),
word_lists AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM one_row),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
           range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
  FROM word_lists),
classes AS (
  SELECT shingles, min(doc_id) AS rep, count(*) AS copies, len(shingles) AS size FROM sets
  WHERE len(shingles) > 0 GROUP BY shingles),
tokens AS (SELECT rep, unnest(shingles) AS shingle FROM classes),
common AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS n FROM tokens a JOIN tokens b ON a.shingle = b.shingle AND a.rep < b.rep
  GROUP BY a.rep, b.rep),
pairs AS (
  SELECT a, b FROM common JOIN classes x ON a = x.rep JOIN classes y ON b = y.rep
  WHERE n >= 0.8 * (x.size + y.size - n) - 1e-9),
ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
roots AS (SELECT a AS rep, least(a, min(b)) AS root FROM reach GROUP BY a),
links AS (SELECT a AS rep, sum(copies) AS n FROM ways JOIN classes ON b = rep GROUP BY a)
SELECT s.doc_id, coalesce(r.root, c.rep, s.doc_id) AS class_id, coalesce(c.rep, s.doc_id) AS set_id,
       (coalesce(l.n, 0) + coalesce(c.copies - 1, 0))::BIGINT AS n_links
FROM sets s LEFT JOIN classes c ON s.shingles = c.shingles
LEFT JOIN roots r ON c.rep = r.rep LEFT JOIN links l ON c.rep = l.rep
"""

OP8 = r"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT row_id, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM texts),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
judged AS (
  SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < max(doc_id) OVER (PARTITION BY key)
            AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT coalesce(gone, false)), '')) AS kept_sha256
FROM judged GROUP BY row_id
"""

OP12 = r"""
WITH RECURSIVE word_lists AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (
  SELECT row_id, doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
           range(1, greatest(len(words) - 1, 1) + 1), lambda i: array_to_string(words[i:i + 1], ' ')))) END AS shingles
  FROM word_lists),
classes AS (
  SELECT shingles, min(row_id) AS rep, min(doc_id) AS least, len(shingles) AS size FROM sets
  WHERE len(shingles) > 0 GROUP BY shingles),
tokens AS (SELECT rep, size, unnest(shingles) AS shingle FROM classes),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM tokens a JOIN tokens b
    ON a.shingle = b.shingle AND a.rep <> b.rep AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
  GROUP BY a.rep, b.rep, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
roots AS (
  SELECT rep, min(least) AS component_id FROM (
    SELECT rep, least FROM classes UNION ALL SELECT a, least FROM reach JOIN classes ON b = rep) GROUP BY rep)
SELECT doc_id, len(s.shingles)::BIGINT AS n_shingles,
       CASE WHEN len(s.shingles) = 0 THEN doc_id ELSE component_id END AS component_id,
       doc_id IS NOT DISTINCT FROM CASE WHEN len(s.shingles) = 0 THEN doc_id ELSE component_id END AS kept
FROM sets s LEFT JOIN classes c ON s.shingles = c.shingles LEFT JOIN roots r USING (rep)
"""

OP13 = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
lists AS (
  SELECT row_id, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM lowered),
counted AS (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM lists) GROUP BY row_id, term),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM lists),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted CROSS JOIN totals GROUP BY term, n_docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
parts AS (
  SELECT row_id, doc_id, 50 + (50 * len(terms) * n_docs) // n_terms AS m FROM lists CROSS JOIN totals
  WHERE len(terms) > 0),
scored AS (
  SELECT item_id, row_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN parts USING (row_id)
  GROUP BY item_id, row_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 AND doc_id IS NOT NULL AND item_id IS NOT NULL
QUALIFY rank <= 50
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op2_lm_scoring": OP2,
    "op4_ngram_jaccard_join": OP4,
    "op8_line_dedup": OP8,
    "op12_minhash_near_dedup": OP12,
    "op13_ranked_search": OP13,
}
