"""DuckDB SQL equivalents of the registered queries (the scale directory's tables are views).

``_WITH`` spells out the binding of ``prefkit.sources.bindings`` and the shared intermediate
relations in SQL; each query selects from it. ALS queries return what has an exact answer: keys,
counts, ranks, and conditions that a right fit meets.
"""

_WITH = """
WITH ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(ceil(l.l_quantity / 5) AS DOUBLE) / 2 AS rating,
         CAST(epoch(l.l_shipdate) AS BIGINT) + (l.l_orderkey * 7 + l.l_linenumber) % 86400 AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
community AS (SELECT * FROM ratings WHERE user_id <> 0),
personal AS (SELECT * FROM ratings WHERE user_id = 0),
items AS (
  SELECT p_partkey AS item_id,
         p_name || ', ' || p_brand || ' (' || CAST(p_size AS VARCHAR) || ')' AS title,
         CASE WHEN p_partkey % 97 = 0 THEN NULL
              ELSE p_type || '|' || replace(p_name, ' ', '|') END AS genres
  FROM part
),
item_genres AS (
  SELECT item_id, title, unnest(list_filter(string_split(genres, '|'), lambda g: g <> '')) AS genre
  FROM items WHERE genres IS NOT NULL
),
responses AS (
  SELECT l_partkey AS item_id,
         CASE WHEN l_linenumber = 7 THEN 'x'
              ELSE CAST(l_linenumber - 1 + l_partkey % 2 AS VARCHAR) END AS response
  FROM lineitem
),
labelled AS (
  SELECT user_id, item_id, rating, ts, ts % 10 AS bucket,
         CASE WHEN ts % 10 < 6 THEN 'train' WHEN ts % 10 <= 8 THEN 'validation' ELSE 'test' END AS split
  FROM community
),
train AS (SELECT user_id, item_id, rating, ts FROM labelled WHERE split = 'train'),
validation AS (SELECT user_id, item_id, rating, ts FROM labelled WHERE split = 'validation'),
item_mean AS (SELECT item_id, avg(rating) AS prediction FROM train GROUP BY item_id),
mean_pred AS (
  SELECT p.user_id, p.item_id, m.prediction
  FROM (SELECT DISTINCT user_id, item_id FROM validation) p JOIN item_mean m ON p.item_id = m.item_id
),
dd AS (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) AS rn
    FROM community) WHERE rn = 1
),
means AS (SELECT user_id, avg(rating) AS user_mean FROM community GROUP BY user_id),
centered AS (
  SELECT d.user_id, d.item_id, d.rating - m.user_mean AS centered
  FROM dd d JOIN means m ON d.user_id = m.user_id
),
seeds AS (
  SELECT item_id AS seed_id, rating AS p FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) AS rn
    FROM personal) WHERE rn = 1
),
pairs AS (
  SELECT ca.user_id, s.seed_id, cb.item_id, ca.centered AS a, cb.centered AS b
  FROM centered ca
  JOIN seeds s ON ca.item_id = s.seed_id
  JOIN centered cb ON ca.user_id = cb.user_id
),
sims AS (
  SELECT seed_id, item_id, round(sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b))), 9) AS sim,
         count(*) AS n_users
  FROM pairs GROUP BY seed_id, item_id
  HAVING sqrt(sum(a * a)) * sqrt(sum(b * b)) <> 0
),
neighbors AS (
  SELECT * FROM (
    SELECT item_id, seed_id, sim,
           row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, seed_id) AS rank
    FROM sims) WHERE rank <= 10
),
per_item AS (SELECT item_id, count(*) AS n_ratings FROM community GROUP BY item_id),
top_items AS (
  SELECT * FROM (
    SELECT g.genre, c.item_id, g.title, c.n_ratings,
           row_number() OVER (PARTITION BY g.genre ORDER BY c.n_ratings DESC, c.item_id) AS rank
    FROM per_item c JOIN item_genres g ON c.item_id = g.item_id) WHERE rank <= 5
),
gus AS (
  SELECT g.genre, r.user_id, count(*) AS n_ratings, sum(r.rating) AS rating_sum, avg(r.rating) AS genre_avg
  FROM community r JOIN item_genres g ON r.item_id = g.item_id
  GROUP BY g.genre, r.user_id
)
"""

# Validation rows, and whether training knows both the user and the item.
_SEEN = """,
known AS (SELECT user_id, item_id FROM train UNION ALL SELECT user_id, item_id FROM personal),
seen AS (
  SELECT user_id, item_id, rating,
         user_id IN (SELECT user_id FROM known) AND item_id IN (SELECT item_id FROM known) AS scored
  FROM validation
)
"""

ORACLE_SQL: dict[str, str] = {
    # ---- sources and sinks
    "scan_ratings": _WITH + "SELECT user_id, item_id, rating, ts FROM ratings",
    "scan_items": _WITH + "SELECT item_id, title, genres FROM items",
    "scan_personal_ratings": _WITH + "SELECT user_id, item_id, rating, ts FROM personal",
    "sink_roundtrip": _WITH + """
SELECT g.genre, round(avg(r.rating), 9) AS avg_rating, count(*) AS n_ratings
FROM community r JOIN item_genres g ON r.item_id = g.item_id GROUP BY g.genre""",
    "preferences_from_responses": _WITH + """
SELECT CAST(0 AS BIGINT) AS user_id, item_id, CAST(TRY_CAST(response AS BIGINT) AS DOUBLE) AS rating,
       CAST(1000000000 AS BIGINT) AS ts
FROM responses
WHERE regexp_full_match(response, '[0-9]+') AND TRY_CAST(response AS BIGINT) BETWEEN 1 AND 5""",
    # ---- projections, filters, scalar functions
    "split_genres": _WITH + """
SELECT item_id, CAST(len(gl) AS BIGINT) AS n_genres, gl[1] AS first_genre
FROM (SELECT item_id, list_filter(string_split(genres, '|'), lambda g: g <> '') AS gl
      FROM items WHERE genres IS NOT NULL)""",
    "explode_genres": _WITH + "SELECT item_id, genre FROM item_genres",
    "items_with_genres": _WITH + "SELECT item_id, title, genres FROM items WHERE genres IS NOT NULL",
    "timestamp_bucket": _WITH + "SELECT user_id, item_id, rating, ts, ts % 10 AS bucket FROM community",
    "raters_of_seeds": _WITH + """
SELECT user_id, item_id, rating, ts FROM community WHERE item_id IN (SELECT item_id FROM personal)""",
    "popular_items": _WITH + """
SELECT item_id, count(*) FILTER (WHERE rating <> 0) AS nnz FROM dd GROUP BY item_id
HAVING count(*) FILTER (WHERE rating <> 0) > 40""",
    "centered_ratings": _WITH + """
SELECT r.user_id, r.item_id, r.rating, r.ts, round(m.user_mean, 9) AS user_mean,
       round(r.rating - m.user_mean, 9) AS centered
FROM community r JOIN means m ON r.user_id = m.user_id""",
    "format_rows": _WITH + """
SELECT genre || chr(9) || CAST(user_id AS VARCHAR) || chr(9) || CAST(n_ratings AS VARCHAR) AS line FROM gus""",
    # ---- joins
    "ratings_by_genre": _WITH + """
SELECT r.user_id, r.item_id, r.rating, r.ts, g.genre
FROM community r JOIN item_genres g ON r.item_id = g.item_id""",
    "actual_vs_predicted": _WITH + """
SELECT v.user_id, v.item_id, v.rating AS actual, round(p.prediction, 9) AS predicted
FROM validation v JOIN mean_pred p ON v.user_id = p.user_id AND v.item_id = p.item_id""",
    "attach_titles": _WITH + """
SELECT c.item_id, c.n_ratings, i.title FROM per_item c LEFT JOIN items i ON c.item_id = i.item_id""",
    "co_rated_pairs": _WITH + """
SELECT user_id, seed_id, item_id, round(a, 9) AS a, round(b, 9) AS b FROM pairs""",
    # ---- aggregations
    "ratings_per_item": _WITH + "SELECT item_id, n_ratings FROM per_item",
    "user_rating_totals": _WITH + """
SELECT user_id, sum(rating) AS rating_sum, count(*) AS n_ratings, round(avg(rating), 9) AS avg_rating
FROM community GROUP BY user_id""",
    "genre_avg_rating": _WITH + """
SELECT g.genre, round(avg(r.rating), 9) AS avg_rating, count(*) AS n_ratings
FROM community r JOIN item_genres g ON r.item_id = g.item_id GROUP BY g.genre""",
    "genre_user_stats": _WITH + """
SELECT genre, user_id, n_ratings, rating_sum, round(genre_avg, 9) AS genre_avg FROM gus""",
    "genre_top_items_packed": _WITH + """
SELECT genre, string_agg(title || ':' || CAST(n_ratings AS VARCHAR), ', ' ORDER BY rank) AS top_items
FROM top_items GROUP BY genre""",
    "dataset_counts": _WITH + """
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items
FROM community""",
    "rating_error_metrics": _WITH + """
SELECT round(avg(e2), 9) AS mse, round(sqrt(avg(e2)), 9) AS rmse,
       round(sum(e2) / count(*), 9) AS reference_mse, count(e2) AS n_scored, count(*) AS n_total
FROM (SELECT (v.rating - p.prediction) * (v.rating - p.prediction) AS e2
      FROM validation v LEFT JOIN mean_pred p ON v.user_id = p.user_id AND v.item_id = p.item_id)""",
    "distinct_users": _WITH + "SELECT DISTINCT user_id FROM community",
    # ---- top-k
    "genre_top_items": _WITH + "SELECT genre, rank, item_id, title, n_ratings FROM top_items",
    "genre_top_users": _WITH + """
SELECT t.genre, t.rank, t.user_id, t.n_ratings, round(t.genre_avg, 9) AS genre_avg,
       round(u.avg_rating, 9) AS overall_avg, u.n AS overall_n
FROM (SELECT * FROM (
        SELECT gus.*, row_number() OVER (PARTITION BY genre ORDER BY n_ratings DESC, CAST(user_id AS VARCHAR)) AS rank
        FROM gus) WHERE rank <= 5) t
JOIN (SELECT user_id, avg(rating) AS avg_rating, count(*) AS n FROM community GROUP BY user_id) u
  ON t.user_id = u.user_id""",
    "item_neighbors_topk": _WITH + "SELECT item_id, rank, seed_id, sim FROM neighbors",
    # ---- set operations and splits
    "training_with_personal": _WITH + """
SELECT user_id, item_id, rating, ts FROM train
UNION ALL SELECT user_id, item_id, rating, ts FROM personal""",
    "split_assignment": _WITH + "SELECT user_id, item_id, rating, ts, bucket, split FROM labelled",
    "split_sizes": _WITH + "SELECT split, count(*) AS n_ratings FROM labelled GROUP BY split",
    # ---- matrix and similarity
    "matrix_dims": _WITH + """
SELECT count(DISTINCT user_id) AS n_rows, max(item_id) + 1 AS n_cols FROM community""",
    "item_column_summary": _WITH + """
SELECT item_id,
       count(*) FILTER (WHERE rating <> 0) AS nnz,
       round(sum(abs(rating)), 9) AS norm_l1,
       round(sqrt(sum(rating * rating)), 9) AS norm_l2,
       round(sum(rating) / n, 9) AS mean,
       round((sum(rating * rating) - sum(rating) * sum(rating) / n) / (n - 1), 9) AS variance,
       CASE WHEN count(*) < n THEN least(min(rating), 0.0) ELSE min(rating) END AS min,
       CASE WHEN count(*) < n THEN greatest(max(rating), 0.0) ELSE max(rating) END AS max
FROM dd, (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS n FROM dd) nn
GROUP BY item_id, n""",
    "item_similarity": _WITH + "SELECT seed_id, item_id, sim, n_users FROM sims",
    "item_cf_recommend": _WITH + """
SELECT b.rank, b.item_id, i.title, round(b.prediction, 6) AS prediction
FROM (
  SELECT item_id, prediction, row_number() OVER (ORDER BY prediction DESC, item_id) AS rank
  FROM (
    SELECT n.item_id, round(sum(n.sim * s.p) / nullif(sum(abs(n.sim)), 0), 9) AS prediction
    FROM neighbors n JOIN seeds s ON n.seed_id = s.seed_id
    GROUP BY n.item_id)
  WHERE prediction IS NOT NULL) b
LEFT JOIN items i ON b.item_id = i.item_id
WHERE b.rank <= 50""",
    "dedupe_ratings": _WITH + "SELECT user_id, item_id, rating, ts FROM dd",
    # ---- factorisation
    "als_factors": _WITH + """
SELECT 'user' AS side, user_id AS id, CAST(10 AS BIGINT) AS n_features, TRUE AS solves
FROM (SELECT user_id FROM train UNION SELECT user_id FROM personal)
UNION ALL
SELECT 'item', item_id, CAST(10 AS BIGINT), CAST(NULL AS BOOLEAN)
FROM (SELECT item_id FROM train UNION SELECT item_id FROM personal)""",
    "als_predict": _WITH + _SEEN + "SELECT user_id, item_id, rating, scored, TRUE AS agrees FROM seen",
    "als_evaluate": _WITH + _SEEN + """
SELECT count(*) FILTER (WHERE scored) AS n_scored, count(*) AS n_total, TRUE AS consistent, TRUE AS errors_agree FROM seen""",
    "als_grid_search": _WITH + _SEEN + """
SELECT row_number() OVER (ORDER BY rank, reg, max_iter) - 1 AS grid_pos, rank, max_iter, CAST(10 AS BIGINT) AS num_blocks,
       reg, n_scored, n_total, TRUE AS errors_agree, TRUE AS best_is_lowest
FROM (SELECT unnest([8, 10])::BIGINT AS rank), (SELECT unnest([0.1, 0.2])::DOUBLE AS reg),
     (SELECT unnest([10, 20])::BIGINT AS max_iter),
     (SELECT count(*) FILTER (WHERE scored) AS n_scored, count(*) AS n_total FROM seen)""",
    "als_recommend": _WITH + """
SELECT u.user_id, r.rank, TRUE AS falling, TRUE AS known, TRUE AS in_exact_top, TRUE AS list_complete
FROM (SELECT DISTINCT user_id FROM personal) u,
     (SELECT unnest(range(1, 51))::BIGINT AS rank) r,
     (SELECT count(*) AS n FROM (SELECT item_id FROM train UNION SELECT item_id FROM personal)) k
WHERE r.rank <= k.n""",
}
