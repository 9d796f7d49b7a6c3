"""DuckDB SQL for the queries that SQL can express, each in the plainest form."""

from __future__ import annotations

OP2 = """
WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
         lambda w: w <> ''))::BIGINT AS size
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
capped AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights
  FROM totals),
levels AS (
  SELECT *, cap < weight * (total - coalesce(sum(cap) OVER earlier, 0)) / (weights - coalesce(sum(weight) OVER earlier, 0))
    AS stops
  FROM capped
  WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN stops THEN cap ELSE
    (total - sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ())
    / (weights - sum(CASE WHEN stops THEN weight ELSE 0 END) OVER ()) * weight END AS target
  FROM levels),
quotients AS (
  SELECT source, source_size, target,
    row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST) AS place,
    round(sum(target) FILTER (k = 1) OVER () / 32) AS seats
  FROM targets, unnest(generate_series(1, 1 + ceil(target / 32)::BIGINT + 200)) AS ks(k)),
quotas AS (
  SELECT source, any_value(source_size) AS source_size, any_value(target) AS target,
    count(*) FILTER (place <= seats) AS quota, greatest(ceil(any_value(source_size) / 5e5), 1)::BIGINT AS shards
  FROM quotients GROUP BY source),
placed AS (
  SELECT s.doc_id, s.source, s.size, source_size, target, quota,
    ('0x' || substr(md5('mix:shard:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT % shards AS shard,
    md5('mix:order:' || coalesce(s.doc_id::VARCHAR, '')) AS spot
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
shard_sizes AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size, any_value(quota) AS quota FROM placed GROUP BY ALL),
shard_quotients AS (
  SELECT source, shard, shard_size, quota,
    row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k - 1) DESC, shard) AS place
  FROM shard_sizes, unnest(generate_series(1, quota)) AS ks(k)),
shard_quotas AS (
  SELECT source, shard, any_value(shard_size) AS shard_size,
    least(32 * count(*) FILTER (place <= quota), 2 * any_value(shard_size))::BIGINT AS words
  FROM shard_quotients GROUP BY ALL),
lined AS (
  SELECT *, (sum(size) OVER (PARTITION BY source, shard ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT
    - size AS lo
  FROM placed)
SELECT l.doc_id, l.size, l.source_size, l.target,
  (CASE WHEN coalesce(shard_size, 0) = 0 THEN 0 ELSE
    words // shard_size * l.size + greatest(0, least(l.size, words % shard_size - lo)) END)::BIGINT AS taken
FROM lined l LEFT JOIN shard_quotas s ON l.source IS NOT DISTINCT FROM s.source AND l.shard = s.shard
"""

OP3 = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, len(embedding) AS dims FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM usable q JOIN usable c ON q.dims = c.dims AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP11 = """
WITH read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
failing AS (
  SELECT doc_id, part,
    (len(words) < 200)::INTEGER + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INTEGER
    + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INTEGER AS failed
  FROM read),
kinds AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing LEFT JOIN kinds USING (doc_id) GROUP BY ALL),
filters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
steps AS (
  SELECT filter_order, k AS step, letter, bit,
    coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER
      AS earlier
  FROM orders, unnest(generate_series(1, 5)) AS ks(k) JOIN filters ON letter = substr(filter_order, k, 1)),
counted AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (failed & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (failed & earlier = 0 AND failed & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failed & earlier <> 0 AND failed & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (failed & earlier = 0 AND failed & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (failed & earlier = 0 AND failed & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

OP12 = """
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM plain WINDOW best AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST)
"""

ORACLES = {"op2_mix_sources": OP2, "op3_nearest": OP3, "op11_filter_audit": OP11, "op12_exact_dedup": OP12}
