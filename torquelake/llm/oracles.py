"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

LOWER_AZ = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = "regexp_extract_all({x}, '[^\\x20\\x09-\\x0D]+')"
TERMS = "regexp_extract_all({x}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, {LOWER_AZ.format(x=f"trim(line, {SPACES})")} AS key FROM lines),
often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, o.key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

SOURCE_MIX = f"""
WITH counted AS (
  SELECT doc_id, source, len({WORDS.format(x="coalesce(text, '')")})::BIGINT AS size, substr(md5(coalesce(text, '')), 1, 16) AS m
  FROM documents),
equals AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, m) AS k FROM counted),
sized AS (
  SELECT *, (('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null') || ':' || m || ':' || k), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM equals),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 3 AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sources),
filled AS (
  SELECT *, row_number() OVER o AS n,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
         (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights
  FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
opened AS (
  SELECT *, cap * weights <= rest * weight AS is_full, min(CASE WHEN cap * weights > rest * weight THEN n END) OVER () AS at FROM filled),
targets AS (
  SELECT o.source, o.source_size,
         CASE WHEN o.is_full THEN o.cap::DOUBLE ELSE (o.weight * f.rest)::DOUBLE / f.weights::DOUBLE END AS target,
         CASE WHEN o.is_full THEN 3 WHEN o.source_size = 0 THEN 0
              ELSE (o.weight * f.rest) // (f.weights * o.source_size) END AS certain
  FROM opened o LEFT JOIN filled f ON f.n = o.at),
odds AS (
  SELECT s.*, t.source_size, t.target, t.certain, t.target - t.certain * t.source_size AS rest,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size - t.certain ELSE 0 END AS p
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, CASE WHEN p > 0 THEN sum(size) OVER (
           PARTITION BY source, p > 0 ORDER BY (u / (1 - u)) / (p / (1 - p)), doc_id NULLS FIRST, m, k) <= rest ELSE false END AS chosen
  FROM odds),
gaps AS (
  SELECT *, target - sum((certain + chosen::BIGINT) * size) OVER (PARTITION BY source) AS gap FROM ranked),
near AS (
  SELECT *, NOT chosen AND p > 0 AND size > 0 AND abs(gap - size) < gap
         AND 1 = row_number() OVER (PARTITION BY source ORDER BY (NOT chosen AND p > 0 AND size > 0) DESC, abs(gap - size), size, doc_id NULLS FIRST, m, k)
         AS added
  FROM gaps)
SELECT doc_id, size, source_size, target, ((certain + (chosen OR added)::BIGINT) * size)::BIGINT AS taken FROM near"""

QUALITY = f"""
WITH base AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format(x="coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM base)
  WHERE trim(line, {SPACES}) <> '' GROUP BY doc_id),
counts AS (
  SELECT b.doc_id, lang AS stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM base b LEFT JOIN repeats r USING (doc_id) LEFT JOIN lines l ON l.doc_id = b.doc_id),
measures AS (
  SELECT *, unnest([
    {{'m': 'symbols', 'v': CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END}},
    {{'m': 'repeats', 'v': CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END}},
    {{'m': 'dup_lines', 'v': CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END}},
    {{'m': 'short', 'v': 1 / (n_words + 1)::DOUBLE}},
    {{'m': 'word_length', 'v': CASE WHEN n_words > 0 THEN (word_chars::DOUBLE / n_words) / 64 ELSE 0 END}},
    {{'m': 'upper', 'v': CASE WHEN word_chars > 0 THEN n_upper::DOUBLE / word_chars ELSE 0 END}}]) AS x
  FROM counts),
placed AS (SELECT doc_id, stratum, x.m AS measure, floor(sqrt(least(x.v, 1.0)) * 64)::INT AS place FROM measures),
held AS (
  SELECT stratum, measure, place, l.quality = 1 AS good FROM placed p JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL),
tried AS (
  SELECT stratum, measure, c.place, count(*) FILTER (WHERE good) AS n,
         count(*) FILTER (WHERE good AND h.place >= c.place) AS k, count(*) FILTER (WHERE NOT good AND h.place >= c.place) AS bad
  FROM held h, (SELECT unnest(range(1, 65)) AS place) c GROUP BY ALL),
tested AS (
  SELECT *, (SELECT sum(exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln(0.005) + (n - j) * ln(0.995)))
             FROM (SELECT unnest(range(0, k + 1)) AS j)) AS p
  FROM tried WHERE bad > k AND k < n * 0.005),
limits AS (
  SELECT stratum, measure, min(place) AS place FROM tested
  WHERE p <= 0.05 / ((SELECT count(*) FROM (SELECT DISTINCT lang FROM documents)) * 6 * 64) GROUP BY ALL),
rejected AS (
  SELECT DISTINCT doc_id FROM placed p JOIN limits l
    ON p.stratum IS NOT DISTINCT FROM l.stratum AND p.measure = l.measure AND p.place >= l.place),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM failed"""

CONTAMINATION = f"""
WITH items AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, w
  FROM (SELECT item_id, {TERMS.format(x=LOWER_AZ.format(x="coalesce(text, '')"))} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items)),
docs AS (SELECT doc_id, {TERMS.format(x=LOWER_AZ.format(x="coalesce(text, '')"))} AS w FROM documents),
lens AS (SELECT DISTINCT len(g) AS n FROM windows),
runs AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lens WHERE len(w) >= n)),
found AS (SELECT r.doc_id, r.i, r.n, v.item FROM runs r JOIN windows v ON r.g = v.g),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN named m USING (doc_id)"""

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(x=LOWER_AZ.format(x="coalesce(text, '')"))} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, w[i:i + {{n}} - 1] AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {{n}} + 1, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(array_to_string(g, ' '), chr(10) ORDER BY g)) AS same FROM grams GROUP BY doc_id),
reps AS (SELECT same, min(doc_id) AS rep, any_value(n) AS n FROM sizes GROUP BY same),
rep_grams AS (SELECT r.rep, r.n, g.g FROM reps r JOIN grams g ON g.doc_id = r.rep),
shared AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM rep_grams a JOIN rep_grams b ON a.g = b.g AND a.rep < b.rep GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE {{den}} * o >= {{num}} * (na + nb - o)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS node, rep AS root FROM reps UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reps r USING (same) LEFT JOIN least l ON l.node = r.rep"""

# The same with the number of links: rows of equal sets and of linked ones.
LINKS = JACCARD.replace(
    "SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, ",
    """, alike AS (SELECT same, count(*) AS rows FROM sizes GROUP BY same),
degrees AS (
  SELECT e.a AS rep, sum(k.rows) AS n FROM edges e JOIN reps r ON r.rep = e.b JOIN alike k ON k.same = r.same GROUP BY e.a)
SELECT d.doc_id, (coalesce(k.rows, 1) - 1 + coalesce(g.n, 0))::BIGINT AS n_links, coalesce(s.n, 0) AS n_shingles, """,
) + " LEFT JOIN alike k USING (same) LEFT JOIN degrees g ON g.rep = r.rep"

# crc32 has no SQL function: its table of 256 entries comes from the polynomial, words go byte by byte.
RESAMPLING = f"""
WITH RECURSIVE bits AS (
  SELECT i, i::BIGINT AS v, 0 AS step FROM (SELECT unnest(range(0, 256)) AS i)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY i) AS entries FROM bits WHERE step = 8),
docs AS (SELECT doc_id, {TERMS.format(x=LOWER_AZ.format(x="coalesce(text, '')"))} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word FROM docs),
aims AS (SELECT unnest({TERMS.format(x=LOWER_AZ.format(x="coalesce(text, '')"))}) AS word FROM benchmark),
hexed AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM words UNION SELECT word FROM aims)),
hashed AS (
  SELECT word, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
           lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM hexed, crc),
source AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)::DOUBLE)
           / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aims) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM source FULL JOIN target USING (bucket)),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs d LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM placed"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_source_mix": SOURCE_MIX,
    "op3_ngram_jaccard": JACCARD.format(n=3, num=90, den=100),
    "op3_ngram_links": LINKS.format(n=3, num=90, den=100),
    "op6_quality_rules": QUALITY,
    "op7_benchmark_contamination": CONTAMINATION,
    "op11_importance_resampling": RESAMPLING,
}
