"""DuckDB statements for the queries of this folder that SQL can express.

The others hold trained models, hashes of Spark's own or tree parsing, and are tested
against brute force in ``tests/llm``.
"""

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
REACHED = """
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, to_id) AS (SELECT DISTINCT a, a FROM ends UNION SELECT r.id, e.b FROM reach r JOIN ends e ON e.a = r.to_id),
component AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents WHERE doc_id IS NOT NULL
),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 2))) AS i FROM w WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)
),
{REACHED}
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN component ON id = w.doc_id
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="text")} AS words FROM documents WHERE doc_id IS NOT NULL),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)
),
often AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows JOIN often USING (h)),
gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = p.doc_id AND c.place = p.place) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(gone.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x)
  WHERE list_dot_product(p.x, q.x) / sqrt(list_dot_product(p.x, p.x) * list_dot_product(q.x, q.x)) >= 0.93
),
{REACHED},
degree AS (SELECT a AS id, count(*) AS n FROM ends GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component c ON c.id = vec_id LEFT JOIN degree d ON d.id = vec_id
"""

FOLDED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _halfbyte(value: int) -> int:
    """What four bits add to a CRC-32: four steps of the reversed polynomial."""
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


# CRC-32 of a text, four bits at a time, low half of each byte first.
CRC = f"""
xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(2 * strlen(t)), lambda i: (strpos('0123456789ABCDEF', hex(encode(t))[xor(i, 1) + 1]) - 1)::BIGINT)),
  lambda c, x: xor(c >> 4, {[_halfbyte(i) for i in range(16)]}[xor(c & 15, x) + 1])
))
"""

# Two words are one edit apart if one is the other without a letter, or both lose the same letter to the same rest.
SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({FOLDED.format(text="coalesce(text, '')")}, '[a-z\\x{{C0}}-\\x{{FF}}]{{7,}}')) AS run FROM documents
),
counted AS (SELECT id || ':' || run AS t, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {CRC} AS h FROM counted),
written AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run)) + 2) ELSE run END AS word, n FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest
),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM (SELECT DISTINCT * FROM pairs) GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
chain(word, root) AS (SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON r.word = f.word
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({FOLDED.format(text="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words, count(*) AS times FROM pieces GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(len(words) * times) AS BIGINT) AS n FROM w GROUP BY lang),
sizes AS (SELECT unnest(range(1, 5)) AS size),
runs AS (SELECT lang, size, words, times, unnest(range(1, len(words) - size + 2)) AS i FROM w, sizes WHERE len(words) >= size),
counts AS (
  SELECT lang, size, words[i:i + size - 1] AS p, CAST(sum(times) AS BIGINT) AS f FROM runs GROUP BY ALL HAVING sum(times) >= 30
),
cuts AS (SELECT lang, size, p, f AS a, unnest(range(1, size)) AS k FROM counts WHERE size > 1),
scores AS (
  SELECT c.lang, c.size, c.p, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN counts y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_sizes AS (SELECT c.lang, c.p, c.size, c.f, s.size AS m FROM counts c JOIN sizes s ON s.size >= 2 AND s.size < c.size),
covered AS (SELECT lang, p[i:i + m - 1] AS p, max(f) AS longer FROM (SELECT lang, p, f, m, unnest(range(1, size - m + 2)) AS i FROM inner_sizes) GROUP BY ALL),
kept AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, score FROM least s LEFT JOIN covered c ON c.lang = s.lang AND c.p = s.p
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

STATEMENTS = {
    "op5_ngram_jaccard_join": JACCARD,
    "op7_substring_dedup": SUBSTRINGS,
    "op8_embedding_near_dedup": VECTORS,
    "op11_spelling_variants": SPELLING,
    "op12_collocations": COLLOCATIONS,
}
