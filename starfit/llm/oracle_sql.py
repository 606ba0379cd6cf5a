"""SQL of those corpus queries that SQL can express."""

OP3 = """
WITH RECURSIVE unit AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM unit a JOIN unit b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
named AS (
  SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links,
         least(vec_id, coalesce((SELECT min(y) FROM reach WHERE x = vec_id), vec_id)) AS component_id FROM embeddings)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM named"""

OP8 = """
WITH bytes AS (SELECT page_id, coalesce(html, '') AS h, encode(coalesce(html, '')) AS b FROM pages),
bits AS (SELECT *, CAST(CAST(unhex(sha1(b)) AS BIT) AS VARCHAR) AS s, max(page_id) OVER (PARTITION BY h) AS last FROM bytes)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(substr(s, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(s, 5 * i + 2, 1) AS INTEGER)
      + 4 * CAST(substr(s, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(s, 5 * i + 4, 1) AS INTEGER)
      + CAST(substr(s, 5 * i + 5, 1) AS INTEGER) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM bits"""

OP10 = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM cut),
every AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
grams AS MATERIALIZED (SELECT * FROM every WHERE g IN (SELECT g FROM every GROUP BY g HAVING count(*) > 1)),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce((SELECT min(y) FROM reach WHERE x = doc_id), doc_id)) AS component_id
FROM sets"""

OP11 = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
corpus AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM cut WHERE len(terms) > 0),
norms AS (
  SELECT doc_id, 100 - 90 + (90 * CAST(len(terms) AS BIGINT) * n_docs) // CAST(n_terms AS BIGINT) AS m
  FROM cut, corpus WHERE len(terms) > 0),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM cut)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10"""

OP12 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
written AS (
  SELECT *, length(regexp_replace(text, '([<\[]\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|/TURN\])', '\1\\\2', 'g'))
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 11
      ELSE 20 + length(regexp_replace(role, '([<\[]\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\]|/TURN\])', '\1\\\2', 'g')) END AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(n) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id"""

ORACLE_SQL = {
    "op3_embedding_near_dedup": OP3,
    "op8_warc": OP8,
    "op10_ngram_jaccard_join": OP10,
    "op11_lexical_search": OP11,
    "op12_chat_format": OP12,
}
