"""DuckDB SQL of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS.format('text')})::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source),
-- raise the water level: cap the sources below it, share the rest again
level AS (
  SELECT a.source, a.source_size, a.w,
         (SELECT 1.5 * sum(source_size)::DOUBLE FROM s) AS budget,
         coalesce((SELECT sum(2.0 * b.source_size)::DOUBLE FROM s b WHERE 2.0 * b.source_size / b.w < 2.0 * a.source_size / a.w), 0.0) AS c,
         (SELECT sum(b.w) FROM s b WHERE 2.0 * b.source_size / b.w >= 2.0 * a.source_size / a.w) AS open
  FROM s a),
capped AS (SELECT *, 2.0 * source_size * open <= w * (budget - c) AS is_capped FROM level),
t AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN (2.0 * source_size)::DOUBLE
              ELSE w * (budget - coalesce((SELECT sum(2.0 * source_size)::DOUBLE FROM capped WHERE is_capped), 0.0))
                   / (SELECT sum(w) FROM capped WHERE NOT is_capped) END AS target
  FROM capped),
c AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM t),
r AS (
  SELECT doc_id, size, h, source_size, target, copies, target - copies * source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS same
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN rest > 0 AND (upto <= rest OR 2 * (rest - (upto - same)) > same AND upto - same <= rest) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

#: The score of a shard for a document.
DRAW = "ln((('0x' || substr(md5(k || '/' || s::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"

SHARDS = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, (coalesce(octet_length(encode(text)), 0) + 1)::BIGINT AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
f AS (
  SELECT doc_id, k, size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT)::BIGINT AS text_crc32
  FROM d, crc_table),
scored AS (
  SELECT doc_id, size, text_crc32, k, list_transform(range(17), lambda s: {DRAW}) AS score FROM f),
placed AS (
  SELECT doc_id, size, text_crc32, list_position(score[1:16], list_max(score[1:16]))::INT - 1 AS shard,
         list_position(score, list_max(score))::INT - 1 AS grown_shard, substr(md5(k || ':' || text_crc32::VARCHAR), 1, 3) AS block
  FROM scored)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot, grown_shard::INT AS grown_shard
FROM placed
"""

#: Words after A-Z are lower-cased, for contamination.
PLAIN = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATE = f"""
WITH b AS (SELECT item_id, {PLAIN} AS w FROM benchmark),
sizes AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
tests AS (
  SELECT DISTINCT item_id, m, w[pos + 1:pos + m] AS g
  FROM (SELECT item_id, w, m, unnest(range(len(w) - m + 1)) AS pos FROM sizes)),
d AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN} AS w FROM documents),
grams AS (
  SELECT r, m, pos, w[pos + 1:pos + m] AS g
  FROM (SELECT r, w, m, unnest(range(greatest(len(w) - m + 1, 0))) AS pos FROM d, (SELECT DISTINCT m FROM tests))),
hits AS (SELECT r, pos, grams.m, item_id FROM grams JOIN tests ON grams.m = tests.m AND grams.g = tests.g),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + m)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""

CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (
  SELECT *, regexp_replace(text, '([\\/#])', '\\\1', 'g') AS text_out, regexp_replace(role, '([\\/# ])', '\\\1', 'g') AS role_out,
         contains(role, '</turn>') OR contains(text, '</turn>') OR contains(role, '###') OR contains(text, '###') OR contains(role, ': ') AS odd
  FROM said)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN odd THEN 15 + length(role_out) + length(text_out)
                ELSE 14 + length(role) + length(text) END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, w[pos + 1:pos + 5] AS g
  FROM (SELECT doc_id, w, unnest(range(CASE WHEN len(w) >= 5 THEN len(w) - 4 WHEN len(w) > 0 THEN 1 ELSE 0 END)) AS pos FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, steps.y FROM reach JOIN steps ON steps.x = reach.r)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r)::BIGINT AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""

NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v::DOUBLE))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)),
places AS (SELECT lang, w, unnest(range(len(w))) AS i FROM pieces),
f AS (
  SELECT lang, array_to_string(w[i + 1:i + k], ' ') AS phrase, k, count(*)::BIGINT AS f
  FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k <= len(w) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k AS size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
found AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
best AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, part, max(a) AS b
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE size = 3) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.part = best.phrase AND best.size = 2
  WHERE b IS NULL OR 100 * b < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""

SQL = {
    "op4_decontaminate": DECONTAMINATE,
    "op5_chat_round_trip": CHAT,
    "op6_mix_sources": MIX,
    "op8_rendezvous_shards": SHARDS,
    "op9_ngram_jaccard": JACCARD,
    "op12_hard_negatives": NEGATIVES,
    "op13_collocations": PHRASES,
}

#: Queries that SQL cannot express, and what tests them instead.
NO_SQL = {
    "pipeline": "its first stage is a fitted classifier; every stage is tested on its own",
    "op1_html_style_tree": "parses markup; compared with a plain reading and entropies counted by hand",
    "op2_language_mixture": "fits mixtures by expectation-maximisation; held-out accuracy",
    "op3_quality_weak_labels": "fits labeller accuracies and a scorer; accuracy on labels it never reads",
    "op7_compression_bands": "compresses texts; counts compared with brute force",
    "op10_url_rules": "mines association rules; compared with brute force",
    "op11_token_counts": "runs a tokenizer; compared with the library on whole texts",
}
