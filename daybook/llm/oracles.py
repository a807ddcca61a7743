"""The same results as SQL, where SQL can express them."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Connected components of ``links (a, b)``, both directions given, as ``reach (node, least)``.
_REACH = """
walk AS (
  SELECT a AS node, b AS other FROM links
  UNION
  SELECT walk.node, links.b FROM walk JOIN links ON walk.other = links.a
),
reach AS (SELECT node, least(node, min(other)) AS least FROM walk GROUP BY node)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct([array_to_string(w[i:i + 3], chr(10))
                                for i in range(1, greatest(len(w) - 3, 1) + 1)]) AS s
  FROM words WHERE len(w) > 0
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), {_REACH}
SELECT d.doc_id, coalesce(len(s), 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id,
       coalesce(least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN reach ON node = d.doc_id
"""

WARC = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (
  SELECT page_id, body, hex,
         array_to_string([
           ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011',
            '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', substr(hex, i, 1))]
           for i in range(1, 41)], '') AS b
  FROM hashed
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM bits)
SELECT page_id, strlen(body) AS payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * substr(b, 5 * k + 1, 1)::INT + 8 * substr(b, 5 * k + 2, 1)::INT
                  + 4 * substr(b, 5 * k + 3, 1)::INT + 2 * substr(b, 5 * k + 4, 1)::INT
                  + substr(b, 5 * k + 5, 1)::INT, 1) for k in range(0, 32)], '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM firsts
"""

EMBEDDINGS = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98
), {_REACH},
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(least, e.vec_id) AS component_id,
       coalesce(least, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degrees ON a = e.vec_id LEFT JOIN reach ON node = e.vec_id
"""

LINE_DEDUP = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents WHERE text IS NOT NULL
),
filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS place
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
windows AS (
  SELECT doc_id, place, trim(line) AS l1, lead(trim(line), 1) OVER w AS l2, lead(trim(line), 2) OVER w AS l3
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY place)
),
ranked AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, place) AS nth
  FROM windows WHERE l3 IS NOT NULL
),
covered AS (
  SELECT DISTINCT doc_id, place + k AS place FROM ranked, unnest([0, 1, 2]) AS t(k) WHERE nth > 1
),
removed AS (SELECT doc_id, line_no FROM filled JOIN covered USING (doc_id, place)),
rebuilt AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (removed.line_no IS NULL), '') AS text,
         count(removed.line_no) AS n_removed
  FROM numbered LEFT JOIN removed USING (doc_id, line_no) GROUP BY doc_id
)
SELECT documents.doc_id, rebuilt.text, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN rebuilt USING (doc_id)
"""

LEXICAL_SEARCH = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
),
facts AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM words),
lengths AS (
  SELECT doc_id, 75 + (25 * len(t) * n_docs) // n_terms AS m, t FROM words, facts WHERE len(t) > 0
),
tfs AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(t) AS term FROM lengths) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, facts GROUP BY term, n_docs
),
items AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term)
  GROUP BY item_id, doc_id
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, words, count(*) AS f
  FROM (SELECT lang, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) AS words
        FROM words, range(1, 6) AS sizes(k))
  GROUP BY lang, words HAVING count(*) >= 100
),
candidates AS (SELECT * FROM counts WHERE len(words) > 1),
inside AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, f, words[i:j] AS part
        FROM candidates, range(1, 5) AS starts(i), range(2, 6) AS ends(j)
        WHERE i < j AND j <= len(words) AND j - i + 1 < len(words))
  GROUP BY lang, part
),
alone AS (
  SELECT c.lang, c.words, c.f AS a
  FROM candidates c LEFT JOIN inside ON inside.lang = c.lang AND inside.part = c.words
  WHERE inside.f IS NULL OR 100 * inside.f < 100 * c.f
),
cuts AS (
  SELECT alone.lang, alone.words, a, n, k, x.f AS l, y.f AS r,
         ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM alone JOIN totals USING (lang), range(1, 5) AS places(k), counts x, counts y
  WHERE k < len(alone.words) AND x.lang = alone.lang AND x.words = alone.words[1:k]
    AND y.lang = alone.lang AND y.words = alone.words[k + 1:]
),
least AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score
  FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op4_line_dedup": LINE_DEDUP,
    "op7_near_duplicates": NEAR_DUPLICATES,
    "op9_warc": WARC,
    "op10_embedding_near_duplicates": EMBEDDINGS,
    "op12_lexical_search": LEXICAL_SEARCH,
    "op13_collocations": COLLOCATIONS,
}
