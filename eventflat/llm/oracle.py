"""SQL of the operators that SQL can express, for a database that reads the same tables.

The near-duplicate queries compare all sets, or all vectors of a label, there: their
operators are held to the exact answer. The others depend on trained models, Spark's own hashes, trees,
iterations or tokenizers and are tested against plain versions, libraries or cases.
"""

#: Least id that links reach, from tables ``links`` (both directions) and ``ids``.
REACH = """
reach(id, other) AS (
  SELECT id, id FROM ids
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
shingled AS MATERIALIZED (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))
  END AS items
  FROM worded
),
ids AS (SELECT doc_id AS id FROM shingled),
single AS MATERIALIZED (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM shingled),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS met
  FROM single x JOIN single y ON x.item = y.item AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * met >= 80 * (na + nb - met)),
{REACH}
SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM shingled JOIN least ON id = doc_id
"""

WARC = """
WITH payloads AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
    CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
  FROM pages
),
first AS (
  SELECT *, payload_bytes >= 100 AND page_id > min(page_id) OVER (PARTITION BY payload_digest) AS again,
    min(page_id) OVER (PARTITION BY payload_digest) AS first_id
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to
FROM first
"""

EMBEDDINGS = f"""
WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
vectors AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98
),
{REACH},
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT CAST(id AS BIGINT) AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
  CAST(component_id AS BIGINT) AS component_id, id = component_id AS kept
FROM least LEFT JOIN counted ON a = id
"""

MIXING = r"""
WITH keyed AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE)
    / (0.25::DOUBLE + 0.75::DOUBLE * power(coalesce(
        length(translate(text, '#*$%&|<>', ''))::DOUBLE / greatest(length(text), 1), 1::DOUBLE), 2)) AS key
  FROM documents
),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
ranked AS (
  SELECT *, source_size * 2::DOUBLE AS cap,
    ([5::DOUBLE, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sizes
),
rated AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
    / (sum(w) OVER () - sum(w) OVER through + w) AS rate
  FROM ranked
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    through AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
settled AS (
  SELECT *, first_value(CASE WHEN rate * w <= cap THEN rate END IGNORE NULLS) OVER (
    ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS final
  FROM rated
),
targets AS (
  SELECT source, source_size, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * w) END AS target FROM settled
),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets
),
entries AS (SELECT source, key, doc_id, sum(size) AS size FROM keyed GROUP BY ALL),
placed AS (
  SELECT source, key, doc_id, size / 2::DOUBLE + coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY key, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS middle
  FROM entries
)
SELECT k.doc_id, k.size, p.source_size, p.target,
  k.size * (p.epochs + CAST(m.middle <= p.target - p.epochs * p.source_size AS BIGINT)) AS taken
FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
JOIN placed m ON m.source IS NOT DISTINCT FROM k.source AND m.key = k.key AND m.doc_id IS NOT DISTINCT FROM k.doc_id
"""

#: Unsigned crc32 of the text of ``conv_id``, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''),
    lambda letter: list_transform(range(0, 8), lambda bit: (CAST(ascii(letter) AS BIGINT) >> bit) & 1)
  ))), lambda crc, bit: xor(crc >> 1, (xor(crc, bit) & 1) * 3988292384)), 4294967295)"""

CONVERSATIONS = rf"""
WITH own AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id,
    list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))
    ) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
drawn AS (SELECT *, {CRC32} % 4 AS h FROM own),
rebuilt AS MATERIALIZED (
  SELECT x.conv_id, list_concat(coalesce(y.turns, [])[1:x.h], x.turns[x.h + 1:]) AS turns
  FROM drawn x LEFT JOIN own y ON y.conv_id = x.conv_id - x.conv_id % 20
),
steps AS (
  SELECT conv_id, turns, depth, turns[1:depth] AS path
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
),
nodes AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0
      ELSE (count(*) - 1) * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM steps GROUP BY path, depth
),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children ON nodes.path = children.path
),
above AS (
  SELECT path[1:a] AS path, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM counted) GROUP BY 1
)
SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n_convs, CAST(x.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM counted x JOIN above ON above.path = x.path
LEFT JOIN nodes y ON x.depth > 0 AND y.path = x.path[1:x.depth - 1]
"""

ORACLE = {
    "op3_source_mixing": MIXING,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op7_warc": WARC,
    "op9_embedding_near_duplicates": EMBEDDINGS,
    "op12_conversation_trie": CONVERSATIONS,
}
