"""DuckDB SQL for the queries that SQL can express over whole tables."""

_WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
                  -ln((('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
                  / coalesce(greatest(0.05, 1 - 10 * (1 - length(translate(text, '#*$%&|<>!', '')) / nullif(length(text), 0))), 0.05) AS draw
           FROM documents),
s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY (source IS NULL), encode(source)) AS nth FROM d GROUP BY source),
w AS (SELECT source, source_size, 3.0 * source_size AS most, CASE (nth - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM s),
-- the level at which the sources that are not full meet: the least one that is enough for all
levels AS (SELECT most / w AS r, (SELECT sum(least(most, w * (a.most / a.w))) FROM w) AS filled FROM w a),
total AS (SELECT sum(source_size) AS t FROM w),
crossing AS (SELECT coalesce(max(r), 0) AS r FROM levels, total WHERE filled <= t),
lev AS (SELECT CASE WHEN sum(CASE WHEN most / w > r THEN w ELSE 0 END) > 0
                    THEN ((SELECT t FROM total) - sum(CASE WHEN most / w <= r THEN most ELSE 0 END)) / sum(CASE WHEN most / w > r THEN w ELSE 0 END)
                    ELSE r END AS l FROM w, crossing GROUP BY r),
t AS (SELECT source, source_size, round(least(most, l * w), 6) AS target FROM w, lev),
e AS (SELECT *, CAST(floor(least(3.0, coalesce(target / nullif(source_size, 0), 0))) AS BIGINT) AS epochs FROM t),
p AS (SELECT d.doc_id, d.source, d.size, e.source_size, e.target, e.epochs, CAST(floor(e.target - e.epochs * e.source_size) AS BIGINT) AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM p
"""

DECONTAMINATE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iwin AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
         FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT item_id, w, least(10, len(w)) AS n FROM iw WHERE len(w) > 0))),
lens AS (SELECT DISTINCT n FROM iwin),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
m AS (SELECT d.doc_id, d.i, d.n, x.item_id FROM dwin d JOIN iwin x ON d.n = x.n AND d.gram = x.gram),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS w FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
reps AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
lines AS (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line),
dups AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n FROM lines GROUP BY doc_id),
f AS (SELECT w.doc_id, t, CAST(len(w.w) AS BIGINT) AS n_words, length(t) - length(regexp_replace(t, '{_WORD}', '', 'g')) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines, coalesce(reps.n, 0) AS n_repeat_words,
             len(string_split(t, chr(10))) AS n_lines
      FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN reps USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 6 * n_lines OR word_chars > 20 * n_words OR word_chars < 2 * n_words
            OR len(regexp_extract_all(t, '[A-ZÀ-ÖØ-Þ]')) > len(regexp_extract_all(t, '[a-zß-öø-ÿ]'))
            OR 5 * (length(t) - length(replace(t, '!', ''))) > n_words OR NOT regexp_matches(t, '[.!?]')
            OR 2 * len(regexp_extract_all(t, '[A-Za-zÀ-ÖØ-öø-ÿ]')) < word_chars) AS kept
FROM b
"""

PHRASES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), runs AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*)::BIGINT AS a FROM runs GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(generate_series(1, k - 1)) AS cut FROM f WHERE k > 1
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, head.a AS l, tail.a AS r,
         ((1000000::HUGEINT * c.a * c.a) // (head.a::HUGEINT * tail.a))::BIGINT AS score
  FROM cuts c
  JOIN f head ON head.lang = c.lang AND head.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f tail ON tail.lang = c.lang AND tail.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS around
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cuts WHERE k = 3)
  GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.around IS NULL OR 100 * i.around < 50 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
