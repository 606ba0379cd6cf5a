"""The registered queries as plain SQL, written row by row and λ by λ.

Nothing here shares a method with the library: splits rank all rows, the sweep explodes
every row by λ, recommendations pair users with all movies.
"""

from __future__ import annotations

SOURCES = """
ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp",
         l_linenumber AS line_number,
         concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS row_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
movies AS (
  SELECT p_partkey AS movieId,
         CASE WHEN p_brand = 'Brand#13' AND p_type = 'SMALL' THEN NULL ELSE p_name END AS title,
         CASE WHEN p_brand = 'Brand#13' AND p_type = 'SMALL' THEN NULL
              ELSE p_type || '|' || split_part(p_name, ' ', 2) END AS genres
  FROM part),
enriched AS (
  SELECT r.userId, r.movieId, r.rating, r."timestamp", r.line_number, r.row_key, m.title, m.genres
  FROM ratings r LEFT JOIN movies m ON r.movieId IS NOT DISTINCT FROM m.movieId),
sparse AS (SELECT * REPLACE (movieId * 10 + line_number AS movieId) FROM enriched)"""


def _split(out: str, source: str, seed: str, share: str) -> str:
    return f"""
{out}_q AS (
  SELECT min(rating) AS lo, quantile_cont(rating, 0.25) AS q1, quantile_cont(rating, 0.5) AS q2,
         quantile_cont(rating, 0.75) AS q3 FROM {source}),
{out}_h AS MATERIALIZED (
  SELECT s.*, md5(concat_ws('|', '{seed}', row_key)) AS h,
         (CASE WHEN q1 > lo AND rating > q1 THEN 1 ELSE 0 END)
         + (CASE WHEN q2 > q1 AND rating > q2 THEN 1 ELSE 0 END)
         + (CASE WHEN q3 > q2 AND rating > q3 THEN 1 ELSE 0 END) AS stratum
  FROM {source} s, {out}_q),
{out} AS MATERIALIZED (
  SELECT * EXCLUDE (h, rk, n), rk <= ceil(n * CAST({share} AS DOUBLE)) AS sampled
  FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h) AS rk,
               count(*) OVER (PARTITION BY stratum) AS n FROM {out}_h))"""


def _partition(source: str) -> str:
    six = " AND ".join(
        f't."{c}" IS NOT DISTINCT FROM h."{c}"'
        for c in ("userId", "movieId", "rating", "timestamp", "title", "genres")
    )
    return f"""{_split("first_split", source, "1", "0.1")},
rest AS (SELECT * EXCLUDE (stratum, sampled) FROM first_split WHERE NOT sampled),
temp AS (SELECT * EXCLUDE (stratum, sampled) FROM first_split WHERE sampled),
known_movies AS (SELECT * FROM temp t WHERE EXISTS (SELECT 1 FROM rest r WHERE r.movieId IS NOT DISTINCT FROM t.movieId)),
holdout AS MATERIALIZED (SELECT * FROM known_movies t WHERE EXISTS (SELECT 1 FROM rest r WHERE r.userId IS NOT DISTINCT FROM t.userId)),
removed AS (SELECT t.* FROM temp t ANTI JOIN holdout h ON {six}),
development AS (SELECT * FROM rest UNION ALL SELECT * FROM removed),
{_split("second_split", "development", "2", "0.2")},
validation AS (SELECT * EXCLUDE (stratum, sampled) FROM second_split WHERE sampled),
train AS (SELECT * EXCLUDE (stratum, sampled) FROM second_split WHERE NOT sampled)"""


# Every effect and every prediction for every λ of the grid.
GRID = """
grid AS (SELECT i * CAST(0.25 AS DOUBLE) AS lam FROM range(41) t(i)),
mean AS (SELECT avg(rating) AS mu FROM train),
movie_fx AS MATERIALIZED (
  SELECT lam, movieId, sum(rating - mu) / (count(*) + lam) AS b_i, count(*) AS n_i
  FROM train, mean, grid GROUP BY lam, movieId),
user_fx AS MATERIALIZED (
  SELECT m.lam, userId, sum(rating - mu - b_i) / (count(*) + m.lam) AS b_u, count(*) AS n_u
  FROM train t JOIN movie_fx m ON t.movieId IS NOT DISTINCT FROM m.movieId, mean
  GROUP BY m.lam, userId),
genre_fx AS MATERIALIZED (
  SELECT m.lam, genres, sum(rating - mu - b_i - b_u) / (count(*) + m.lam) AS b_g, count(*) AS n_g
  FROM train t JOIN movie_fx m ON t.movieId IS NOT DISTINCT FROM m.movieId
  JOIN user_fx u ON u.lam = m.lam AND t.userId IS NOT DISTINCT FROM u.userId, mean
  GROUP BY m.lam, genres),
errors AS MATERIALIZED (
  SELECT g.lam,
         sqrt(avg((rating - mu) ^ 2)) AS rmse0,
         sqrt(avg((rating - mu - coalesce(b_i, 0)) ^ 2)) AS rmse1,
         sqrt(avg((rating - mu - coalesce(b_i, 0) - coalesce(b_u, 0)) ^ 2)) AS rmse2,
         sqrt(avg((rating - mu - coalesce(b_i, 0) - coalesce(b_u, 0) - coalesce(b_g, 0)) ^ 2)) AS rmse3
  FROM validation v CROSS JOIN grid g CROSS JOIN mean
  LEFT JOIN movie_fx m ON m.lam = g.lam AND m.movieId IS NOT DISTINCT FROM v.movieId
  LEFT JOIN user_fx u ON u.lam = g.lam AND u.userId IS NOT DISTINCT FROM v.userId
  LEFT JOIN genre_fx x ON x.lam = g.lam AND x.genres IS NOT DISTINCT FROM v.genres
  GROUP BY g.lam),
best2 AS (SELECT lam, rmse2 AS rmse FROM errors ORDER BY rmse2, lam LIMIT 1),
best3 AS (SELECT lam, rmse3 AS rmse FROM errors ORDER BY rmse3, lam LIMIT 1)"""

# The model at one λ, and rows scored with it.
FINAL = """
final_movie AS MATERIALIZED (
  SELECT movieId, sum(rating - mu) / (count(*) + lam) AS b_i, count(*) AS n_i
  FROM train, mean, best3 GROUP BY movieId, lam),
final_user AS MATERIALIZED (
  SELECT userId, sum(rating - mu - b_i) / (count(*) + lam) AS b_u, count(*) AS n_u
  FROM train t JOIN final_movie m ON t.movieId IS NOT DISTINCT FROM m.movieId, mean, best3 GROUP BY userId, lam),
final_genre AS MATERIALIZED (
  SELECT genres, sum(rating - mu - b_i - b_u) / (count(*) + lam) AS b_g, count(*) AS n_g
  FROM train t JOIN final_movie m ON t.movieId IS NOT DISTINCT FROM m.movieId
  JOIN final_user u ON t.userId IS NOT DISTINCT FROM u.userId, mean, best3 GROUP BY genres, lam),
scored_validation AS (
  SELECT v.*, coalesce(b_i, 0) AS b_i, coalesce(b_u, 0) AS b_u, coalesce(b_g, 0) AS b_g,
         mu + coalesce(b_i, 0) + coalesce(b_u, 0) + coalesce(b_g, 0) AS pred
  FROM validation v CROSS JOIN mean
  LEFT JOIN final_movie m ON m.movieId IS NOT DISTINCT FROM v.movieId
  LEFT JOIN final_user u ON u.userId IS NOT DISTINCT FROM v.userId
  LEFT JOIN final_genre x ON x.genres IS NOT DISTINCT FROM v.genres),
scored_holdout AS (
  SELECT v.*, coalesce(b_i, 0) AS b_i, coalesce(b_u, 0) AS b_u, coalesce(b_g, 0) AS b_g,
         mu + coalesce(b_i, 0) + coalesce(b_u, 0) + coalesce(b_g, 0) AS pred
  FROM holdout v CROSS JOIN mean
  LEFT JOIN final_movie m ON m.movieId IS NOT DISTINCT FROM v.movieId
  LEFT JOIN final_user u ON u.userId IS NOT DISTINCT FROM v.userId
  LEFT JOIN final_genre x ON x.genres IS NOT DISTINCT FROM v.genres),
user_alone AS (SELECT userId, avg(rating - mu) AS b_u FROM train, mean GROUP BY userId),
scored_user AS (
  SELECT v.*, coalesce(b_u, 0) AS b_u, mu + coalesce(b_u, 0) AS pred
  FROM validation v CROSS JOIN mean
  LEFT JOIN user_alone u ON u.userId IS NOT DISTINCT FROM v.userId),
comparison AS (
  SELECT CAST(1 AS BIGINT) AS step, 'Baseline model' AS method, rmse0 AS rmse FROM errors WHERE lam = 0
  UNION ALL SELECT 2, 'Movie Effects Model', rmse1 FROM errors WHERE lam = 0
  UNION ALL SELECT 3, 'User Effects Model', sqrt(avg((rating - pred) ^ 2)) FROM scored_user
  UNION ALL SELECT 4, 'Combined Effects Model', rmse2 FROM errors WHERE lam = 0
  UNION ALL SELECT 5, 'Regularized Model', min(rmse2) FROM errors
  UNION ALL SELECT 6, 'Optimized Regularized Model with Genre Effects', sqrt(avg((rating - pred) ^ 2)) FROM scored_validation
  UNION ALL SELECT 7, 'Final Model on Holdout', sqrt(avg((rating - pred) ^ 2)) FROM scored_holdout)"""

SPARSE = f"WITH {SOURCES.strip()},{_partition('sparse')}\n"
DENSE = f"WITH {SOURCES.strip()},{_partition('enriched')}\n"
MODELS = f"{DENSE.rstrip()},{GRID}\n"
FINALS = f"{MODELS.rstrip()},{FINAL}\n"
RAW = f"WITH {SOURCES.strip()}\n"

ROW = 'userId, movieId, rating, "timestamp", title, genres'


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name}"


def _box(keys: str, value: str, source: str) -> str:
    return f"""
SELECT b.{keys}, CAST(b.n AS BIGINT) AS n, {_r('q1', 'q1')}, {_r('median', 'median')}, {_r('q3', 'q3')},
       {_r(f'min(CASE WHEN s.{value} >= q1 - 1.5 * (q3 - q1) THEN s.{value} END)', 'whisker_low')},
       {_r(f'max(CASE WHEN s.{value} <= q3 + 1.5 * (q3 - q1) THEN s.{value} END)', 'whisker_high')},
       CAST(sum(CASE WHEN s.{value} < q1 - 1.5 * (q3 - q1) OR s.{value} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM {source} s JOIN (
  SELECT {keys}, count(*) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
         quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY {keys}) b
  ON s.{keys} IS NOT DISTINCT FROM b.{keys}
GROUP BY b.{keys}, b.n, q1, median, q3"""


def _sql() -> dict[str, str]:
    out: dict[str, str] = {}

    # Reading and enriching.
    out["scan_ratings"] = RAW + """
SELECT CAST(userId AS INTEGER) AS userId, CAST(movieId AS INTEGER) AS movieId, rating,
       CAST("timestamp" AS INTEGER) AS "timestamp" FROM ratings"""
    out["scan_movies"] = RAW + """
SELECT CAST(movieId AS INTEGER) AS movieId, coalesce(title, '') AS title, coalesce(genres, '') AS genres FROM movies"""
    messy = """, messy AS (
  SELECT concat_ws('::', CAST(userId AS VARCHAR),
    CASE line_number WHEN 2 THEN movieId || '.7' WHEN 3 THEN movieId || 'e0' WHEN 4 THEN 'n' || movieId
         ELSE CAST(movieId AS VARCHAR) END,
    CASE line_number WHEN 5 THEN ''
      WHEN 1 THEN CASE movieId % 10 WHEN 0 THEN rating || 'f' WHEN 1 THEN rating || 'd' WHEN 2 THEN 'Infinity'
        WHEN 3 THEN '1e400' ELSE CAST(rating AS VARCHAR) END
      ELSE CAST(rating AS VARCHAR) END,
    CASE line_number WHEN 6 THEN NULL WHEN 7 THEN "timestamp" || '::x' ELSE CAST("timestamp" AS VARCHAR) END) AS line
  FROM ratings),
fields AS (SELECT line, string_split(line, '::') AS f FROM messy),
typed AS (
  SELECT line, len(f) AS n,
         TRY_CAST(trunc(TRY_CAST(f[1] AS DOUBLE)) AS INTEGER) AS userId,
         TRY_CAST(trunc(TRY_CAST(f[2] AS DOUBLE)) AS INTEGER) AS movieId,
         CASE WHEN regexp_full_match(f[3], '[0-9]+[.]?[0-9]*') THEN TRY_CAST(f[3] AS DOUBLE) END AS rating,
         TRY_CAST(trunc(TRY_CAST(f[4] AS DOUBLE)) AS INTEGER) AS "timestamp" FROM fields)"""
    out["typed_ratings"] = RAW.rstrip() + messy + """
SELECT userId, movieId, rating, "timestamp" FROM typed
WHERE n <= 4 AND userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL"""
    out["rejected_ratings"] = RAW.rstrip() + messy + """
SELECT line, CASE WHEN n > 4 THEN 'too many fields' WHEN userId IS NULL THEN 'no number in userId'
  WHEN movieId IS NULL THEN 'no number in movieId' WHEN rating IS NULL THEN 'no number in rating'
  ELSE 'no number in timestamp' END AS reason FROM typed
WHERE n > 4 OR userId IS NULL OR movieId IS NULL OR rating IS NULL OR "timestamp" IS NULL"""
    out["enrich_ratings"] = RAW + f"SELECT {ROW} FROM enriched"

    # Partition.
    out["split_holdout"] = SPARSE + f"SELECT {ROW} FROM temp"
    out["split_validation"] = SPARSE + f"SELECT {ROW} FROM validation"
    out["split_strata_counts"] = SPARSE + """
SELECT CAST(stratum AS INTEGER) AS stratum, count(*) AS n, CAST(sum(CASE WHEN sampled THEN 1 ELSE 0 END) AS BIGINT) AS n_sampled
FROM first_split GROUP BY stratum"""
    out["semi_known_movies"] = SPARSE + f"SELECT {ROW} FROM known_movies"
    out["semi_known_users"] = SPARSE + f"SELECT {ROW} FROM holdout"
    out["anti_removed"] = SPARSE + f"SELECT {ROW} FROM removed"
    out["edx_repaired"] = SPARSE + f"SELECT {ROW} FROM development"
    out["holdout_repaired"] = SPARSE + f"SELECT {ROW} FROM holdout"
    out["partition_sizes"] = SPARSE + """
SELECT 'train' AS part, count(*) AS n FROM train UNION ALL SELECT 'validation', count(*) FROM validation
UNION ALL SELECT 'holdout', count(*) FROM holdout"""

    # Effects.
    out["global_mean"] = DENSE + f"SELECT {_r('avg(rating)', 'mu')} FROM train"
    out["movie_effects"] = MODELS + f"SELECT movieId, {_r('b_i', 'b_i')} FROM movie_fx WHERE lam = 0"
    out["user_effects"] = FINALS + f"SELECT userId, {_r('b_u', 'b_u')} FROM user_alone"
    out["user_effects_given_movie"] = MODELS + f"SELECT userId, {_r('b_u', 'b_u')} FROM user_fx WHERE lam = 0"
    out["reg_movie_effects"] = MODELS + f"SELECT movieId, {_r('b_i', 'b_i')}, n_i FROM movie_fx WHERE lam = 5"
    out["reg_user_effects"] = MODELS + f"SELECT userId, {_r('b_u', 'b_u')}, n_u FROM user_fx WHERE lam = 5"
    out["reg_genre_effects"] = MODELS + f"SELECT genres, {_r('b_g', 'b_g')}, n_g FROM genre_fx WHERE lam = 5"
    out["final_movie_effects"] = FINALS + f"SELECT movieId, {_r('b_i', 'b_i')}, n_i FROM final_movie"
    out["final_user_effects"] = FINALS + f"SELECT userId, {_r('b_u', 'b_u')}, n_u FROM final_user"
    out["final_genre_effects"] = FINALS + f"SELECT genres, {_r('b_g', 'b_g')}, n_g FROM final_genre"
    out["effects_roundtrip"] = FINALS + f"""
SELECT 'b_i' AS effect, CAST(movieId AS VARCHAR) AS key, {_r('b_i', 'value')}, n_i AS n FROM final_movie
UNION ALL SELECT 'b_u', CAST(userId AS VARCHAR), {_r('b_u', 'value')}, n_u FROM final_user
UNION ALL SELECT 'b_g', genres, {_r('b_g', 'value')}, n_g FROM final_genre"""
    out["fit_user_given_movie"] = MODELS + f"""
SELECT userId, t.movieId, rating, {_r('b_i', 'b_i')}, {_r('rating - mu - b_i', 'residual')}
FROM train t JOIN movie_fx m ON m.lam = 0 AND t.movieId IS NOT DISTINCT FROM m.movieId, mean"""
    out["fit_genre_given_movie_user"] = MODELS + f"""
SELECT t.userId, t.movieId, genres, rating, {_r('b_i', 'b_i')}, {_r('b_u', 'b_u')},
       {_r('rating - mu - b_i - b_u', 'residual')}
FROM train t JOIN movie_fx m ON m.lam = 5 AND t.movieId IS NOT DISTINCT FROM m.movieId
JOIN user_fx u ON u.lam = 5 AND t.userId IS NOT DISTINCT FROM u.userId, mean"""

    # Scoring.
    out["score_baseline"] = MODELS + f"SELECT userId, movieId, rating, {_r('mu', 'pred')} FROM validation, mean"
    out["score_movie"] = MODELS + f"""
SELECT userId, v.movieId, rating, {_r('coalesce(b_i, 0)', 'b_i')}, {_r('mu + coalesce(b_i, 0)', 'pred')}
FROM validation v CROSS JOIN mean LEFT JOIN movie_fx m ON m.lam = 0 AND m.movieId IS NOT DISTINCT FROM v.movieId"""
    out["score_user"] = FINALS + f"SELECT userId, movieId, rating, {_r('b_u', 'b_u')}, {_r('pred', 'pred')} FROM scored_user"
    two = """
SELECT v.userId, v.movieId, rating, {bi}, {bu}, {pred}
FROM validation v CROSS JOIN mean
LEFT JOIN movie_fx m ON m.lam = {lam} AND m.movieId IS NOT DISTINCT FROM v.movieId
LEFT JOIN user_fx u ON u.lam = {lam} AND u.userId IS NOT DISTINCT FROM v.userId"""
    parts = dict(
        bi=_r("coalesce(b_i, 0)", "b_i"),
        bu=_r("coalesce(b_u, 0)", "b_u"),
        pred=_r("mu + coalesce(b_i, 0) + coalesce(b_u, 0)", "pred"),
    )
    out["score_combined"] = MODELS + two.format(lam="0", **parts)
    out["score_regularized"] = MODELS + two.format(lam="(SELECT lam FROM best2)", **parts)
    scored = ", ".join(_r(c, c) for c in ("b_i", "b_u", "b_g", "pred"))
    out["score_full"] = FINALS + f"SELECT userId, movieId, genres, rating, {scored} FROM scored_validation"
    out["score_holdout"] = FINALS + f"SELECT userId, movieId, genres, rating, {scored} FROM scored_holdout"

    # Errors.
    out["rmse_baseline"] = MODELS + f"SELECT {_r('rmse0', 'rmse')} FROM errors WHERE lam = 0"
    out["rmse_movie"] = MODELS + f"SELECT {_r('rmse1', 'rmse')} FROM errors WHERE lam = 0"
    out["rmse_user"] = FINALS + f"SELECT {_r('rmse', 'rmse')} FROM comparison WHERE step = 3"
    out["rmse_combined"] = MODELS + f"SELECT {_r('rmse2', 'rmse')} FROM errors WHERE lam = 0"
    out["rmse_regularized"] = MODELS + f"SELECT {_r('rmse', 'rmse')} FROM best2"
    out["rmse_final_validation"] = FINALS + f"SELECT {_r('rmse', 'rmse')} FROM comparison WHERE step = 6"
    out["rmse_holdout"] = FINALS + f"SELECT {_r('rmse', 'rmse')} FROM comparison WHERE step = 7"
    for levels in (2, 3):
        out[f"lambda_curve_{levels}level"] = MODELS + f"""
SELECT lam AS "lambda", {_r(f'rmse{levels}', 'rmse')}, lam = (SELECT lam FROM best{levels}) AS is_best FROM errors"""
    out["lambda_curve_min"] = MODELS + f"""
SELECT CAST(2 AS INTEGER) AS levels, {_r('min(rmse2)', 'rmse')} FROM errors
UNION ALL SELECT 3, {_r('min(rmse3)', 'rmse')} FROM errors"""
    out["best_lambda"] = MODELS + f"""
SELECT CAST(2 AS INTEGER) AS levels, lam AS "lambda", {_r('rmse', 'rmse')} FROM best2
UNION ALL SELECT 3, lam, {_r('rmse', 'rmse')} FROM best3"""
    out["model_comparison"] = FINALS + "SELECT step, method, round(rmse, 4) AS rmse FROM comparison"
    out["improvement_over_baseline"] = FINALS + f"""
SELECT step, method, {_r('naive - rmse', 'improvement')}, {_r('(naive - rmse) / naive * 100', 'improvement_pct')}
FROM comparison, (SELECT rmse AS naive FROM comparison WHERE step = 1) WHERE step BETWEEN 2 AND 6"""

    def at(step: int) -> str:
        return f"(SELECT rmse FROM comparison WHERE step = {step})"

    quoted = [
        ("Overall mean rating:", "(SELECT mu FROM mean)", 4),
        ("RMSE for baseline model:", at(1), 4),
        ("Movie Effects RMSE:", at(2), 12),
        ("User Effects RMSE:", at(3), 12),
        ("Movie effects gain:", f"{at(1)} - {at(2)}", 4),
        ("Movie effects gain in percent:", f"({at(1)} - {at(2)}) / {at(1)} * 100", 1),
        ("User effects gain:", f"{at(1)} - {at(3)}", 4),
        ("Combined effects RMSE:", at(4), 4),
        ("Optimal lambda, movie and user:", "(SELECT lam FROM best2)", 2),
        ("Optimal lambda, all effects:", "(SELECT lam FROM best3)", 2),
        ("Final RMSE on validation:", at(6), 4),
        ("Final RMSE on holdout:", at(7), 4),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{label}' AS metric, round({value}, {digits}) AS value" for label, value, digits in quoted
    )
    out["run_metrics"] = FINALS + f"SELECT metric, value, metric || ' ' || CAST(value AS VARCHAR) AS line FROM ({rows})"

    # Diagnostics.
    out["box_pred_by_rating"] = FINALS + _box("rating", "pred", "scored_holdout")
    out["bias_by_rating"] = FINALS + f"""
SELECT rating, count(*) AS n, {_r('avg(pred)', 'mean_pred')}, {_r('avg(pred - rating)', 'bias')}
FROM scored_holdout GROUP BY rating"""
    out["pred_vs_actual_hist"] = FINALS + """
SELECT rating, floor(pred / 0.25) * 0.25 AS pred_from, count(*) AS n FROM scored_holdout GROUP BY 1, 2"""
    out["pred_vs_actual_points"] = FINALS + f"SELECT rating, {_r('pred', 'pred')} FROM scored_holdout"
    out["box_genre_effects"] = FINALS + _box("genres", "b_g", "final_genre")
    out["genre_effect_ranking"] = FINALS + f"""
SELECT genres, CAST(count(*) AS BIGINT) AS n, {_r('median(b_g)', 'median')} FROM final_genre GROUP BY genres"""
    for name, order in (("worst", "DESC"), ("best", "ASC")):
        out[f"extreme_errors_{name}"] = FINALS + f"""
SELECT userId, movieId, rating, {_r('pred', 'pred')}, {_r('abs_error', 'abs_error')}
FROM (SELECT *, round(abs(pred - rating), 9) AS abs_error FROM scored_holdout)
ORDER BY abs_error {order}, row_key LIMIT 10"""
    out["effect_importance"] = FINALS + f"""
SELECT 'b_i' AS effect, count(*) AS n_keys, {_r('stddev_samp(b_i)', 'sd')}, {_r('min(b_i)', 'smallest')}, {_r('max(b_i)', 'largest')},
  (SELECT round(rmse0 - rmse1, 6) + 0.0 FROM errors WHERE lam = (SELECT lam FROM best3)) AS rmse_gain FROM final_movie
UNION ALL SELECT 'b_u', count(*), {_r('stddev_samp(b_u)', 'sd')}, {_r('min(b_u)', 'smallest')}, {_r('max(b_u)', 'largest')},
  (SELECT round(rmse1 - rmse2, 6) + 0.0 FROM errors WHERE lam = (SELECT lam FROM best3)) FROM final_user
UNION ALL SELECT 'b_g', count(*), {_r('stddev_samp(b_g)', 'sd')}, {_r('min(b_g)', 'smallest')}, {_r('max(b_g)', 'largest')},
  (SELECT round(rmse2 - rmse3, 6) + 0.0 FROM errors WHERE lam = (SELECT lam FROM best3)) FROM final_genre"""

    # Exploration of the development rows.
    columns = [
        ("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"),
        ("timestamp", "bigint"), ("title", "string"), ("genres", "string"),
    ]
    profile = " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS column_name, '{t}' AS type,
  (SELECT string_agg(coalesce(CAST("{c}" AS VARCHAR), 'NA'), ', ' ORDER BY k) FROM first_rows) AS first_values,
  (SELECT count(*) FROM development) AS n_rows, CAST(6 AS BIGINT) AS n_columns"""
        for i, (c, t) in enumerate(columns, 1)
    )
    out["profile_table"] = DENSE.rstrip() + f""",
first_rows AS (SELECT *, row_number() OVER (ORDER BY userId, movieId, "timestamp", rating) AS k FROM development
  ORDER BY userId, movieId, "timestamp", rating LIMIT 5)
{profile}"""
    out["count_rating_eq"] = DENSE + """
SELECT CAST(0 AS DOUBLE) AS value, count(*) FILTER (WHERE rating = 0) AS n FROM development
UNION ALL SELECT 3, count(*) FILTER (WHERE rating = 3) FROM development"""
    out["distinct_movies"] = DENSE + "SELECT count(*) AS n_movies FROM (SELECT DISTINCT movieId FROM development)"
    out["distinct_users"] = DENSE + "SELECT count(*) AS n_users FROM (SELECT DISTINCT userId FROM development)"
    words = ("PROMO", "LARGE", "SMALL", "ECONOMY")
    out["genre_membership_counts"] = DENSE + "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE regexp_matches(genres, '{w}')) AS \"{w}\"" for w in words
    ) + " FROM development"
    out["ratings_per_title"] = DENSE + "SELECT title, count(*) AS number_of_ratings FROM development GROUP BY title"
    out["most_rated_title"] = DENSE + """
SELECT title, count(*) AS number_of_ratings FROM development GROUP BY title ORDER BY 2 DESC, title NULLS FIRST LIMIT 1"""
    out["top5_ratings"] = DENSE + """
SELECT rating, count(*) AS "count" FROM development GROUP BY rating ORDER BY 2 DESC, rating LIMIT 5"""
    out["eda_rating_distribution"] = DENSE + "SELECT rating, count(*) AS n FROM development GROUP BY rating"
    out["eda_rating_moments"] = DENSE + f"""
SELECT count(*) AS n, {_r('avg(rating)', 'mean_rating')}, {_r('var_samp(rating)', 'variance')} FROM development"""
    for name, key in (("eda_movie_popularity", "movieId"), ("eda_user_patterns", "userId"), ("eda_genre_ratings", "genres")):
        out[name] = DENSE + f"""
SELECT {key}, count(*) AS n, {_r('avg(rating)', 'mean_rating')}, {_r('stddev_samp(rating)', 'sd_rating')}
FROM development GROUP BY {key}"""
    per_movie = "(SELECT movieId, count(*) AS n, avg(rating) AS mean_rating FROM development GROUP BY movieId)"
    out["eda_popularity_correlation"] = DENSE + f"""
SELECT count(*) AS n_movies, {_r('corr(n, mean_rating)', 'corr')} FROM {per_movie}"""
    per_sparse = f"""(SELECT *, CAST((CASE WHEN n >= 5 * p THEN 5 WHEN n >= 2 * p THEN 2 ELSE 1 END) * p AS BIGINT) AS at_least
  FROM (SELECT *, CAST(rpad('1', CAST(length(CAST(n AS VARCHAR)) AS INTEGER), '0') AS BIGINT) AS p FROM {per_movie}))"""
    out["eda_extremes_by_support"] = SPARSE + f"""
SELECT at_least, count(*) AS n_movies, {_r('min(mean_rating)', 'min_mean')}, {_r('max(mean_rating)', 'max_mean')},
       {_r('avg(mean_rating)', 'avg_mean')}, {_r('stddev_samp(mean_rating)', 'sd_mean')}
FROM {per_sparse} GROUP BY at_least"""

    # Genre-specific user effects and recommendations.
    user_genre = """,
final_user_genre AS (
  SELECT t.userId, t.genres, sum(rating - mu - b_i - b_u - b_g) / (count(*) + (SELECT lam FROM best3)) AS b_ug, count(*) AS n_ug
  FROM train t JOIN final_movie m ON t.movieId IS NOT DISTINCT FROM m.movieId
  JOIN final_user u ON t.userId IS NOT DISTINCT FROM u.userId
  JOIN final_genre x ON t.genres IS NOT DISTINCT FROM x.genres, mean
  GROUP BY t.userId, t.genres)"""
    out["fit_user_genre"] = FINALS.rstrip() + user_genre + f"""
SELECT userId, genres, {_r('b_ug', 'b_ug')}, n_ug FROM final_user_genre"""
    out["rmse_user_genre"] = FINALS.rstrip() + user_genre + f"""
SELECT {_r('sqrt(avg((rating - pred - coalesce(b_ug, 0)) ^ 2))', 'rmse')}
FROM scored_validation v LEFT JOIN final_user_genre x
  ON x.userId IS NOT DISTINCT FROM v.userId AND x.genres IS NOT DISTINCT FROM v.genres"""
    out["recommend_topn"] = FINALS.rstrip() + f""",
candidates AS (SELECT movieId, min(genres) AS genres FROM development GROUP BY movieId),
movie_scores AS (
  SELECT c.movieId, coalesce(b_i, 0) + coalesce(b_g, 0) AS exact, round(coalesce(b_i, 0) + coalesce(b_g, 0), 9) AS score
  FROM candidates c
  LEFT JOIN final_movie m ON m.movieId IS NOT DISTINCT FROM c.movieId
  LEFT JOIN final_genre x ON x.genres IS NOT DISTINCT FROM c.genres),
pairs AS (
  SELECT u.userId, s.movieId, s.score, s.exact FROM (SELECT DISTINCT userId FROM development) u CROSS JOIN movie_scores s
  ANTI JOIN development e ON e.userId = u.userId AND e.movieId = s.movieId),
ranked AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rank FROM pairs)
SELECT r.userId, rank, movieId, {_r('mu + coalesce(b_u, 0) + exact', 'pred', 7)}
FROM ranked r CROSS JOIN mean LEFT JOIN final_user u ON u.userId = r.userId WHERE rank <= 5"""
    out["recommend_user_genre"] = FINALS.rstrip() + user_genre + f""",
candidates AS (SELECT movieId, min(genres) AS genres FROM development GROUP BY movieId),
movie_scores AS (
  SELECT c.movieId, c.genres, coalesce(b_i, 0) + coalesce(b_g, 0) AS exact,
         CAST(round((coalesce(b_i, 0) + coalesce(b_g, 0)) * 1e9) AS BIGINT) AS units
  FROM candidates c
  LEFT JOIN final_movie m ON m.movieId IS NOT DISTINCT FROM c.movieId
  LEFT JOIN final_genre x ON x.genres IS NOT DISTINCT FROM c.genres),
pairs AS (
  SELECT u.userId, s.movieId, s.exact + coalesce(x.b_ug, 0) AS exact,
         s.units + CAST(round(coalesce(x.b_ug, 0) * 1e9) AS BIGINT) AS units
  FROM (SELECT DISTINCT userId FROM development) u CROSS JOIN movie_scores s
  LEFT JOIN final_user_genre x ON x.userId = u.userId AND x.genres IS NOT DISTINCT FROM s.genres
  ANTI JOIN development e ON e.userId = u.userId AND e.movieId = s.movieId),
ranked AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY units DESC, movieId) AS rank FROM pairs)
SELECT r.userId, rank, movieId, {_r('mu + coalesce(b_u, 0) + exact', 'pred', 7)}
FROM ranked r CROSS JOIN mean LEFT JOIN final_user u ON u.userId = r.userId WHERE rank <= 5"""

    # Time.
    features = ", ".join(
        f"""count(*) OVER {p} AS {p}_ratings, round(avg(rating) OVER {p}, 6) + 0.0 AS {p}_mean,
       CAST("timestamp" - max("timestamp") OVER {p} AS DOUBLE) AS {p}_idle"""
        for p in ("movie", "user", "genre")
    )
    frames = ", ".join(
        f'{p} AS (PARTITION BY {k} ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)'
        for p, k in (("movie", "movieId"), ("user", "userId"), ("genre", "genres"))
    )
    out["activity_features"] = RAW + f"""
SELECT userId, movieId, genres, "timestamp", rating, {features} FROM enriched WINDOW {frames}"""
    timed = """,
left_over AS MATERIALIZED (
  SELECT t.*, rating - mu - b_i - b_u - b_g AS r, CAST(floor("timestamp" / (91 * 86400)) AS BIGINT) AS bin
  FROM train t JOIN final_movie m ON t.movieId IS NOT DISTINCT FROM m.movieId
  JOIN final_user u ON t.userId IS NOT DISTINCT FROM u.userId
  JOIN final_genre x ON t.genres IS NOT DISTINCT FROM x.genres, mean),
cells AS MATERIALIZED (SELECT movieId, bin, count(*) AS n, sum(r) AS s FROM left_over GROUP BY movieId, bin),
pulls AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY movieId ORDER BY bin) AS k, count(*) OVER (PARTITION BY movieId) AS m,
         coalesce(20.0 / (bin - lag(bin) OVER (PARTITION BY movieId ORDER BY bin)), 0) AS l,
         coalesce(20.0 / (lead(bin) OVER (PARTITION BY movieId ORDER BY bin) - bin), 0) AS g FROM cells),
forward(movieId, k, m, bin, n, c, d) AS (
  SELECT movieId, k, m, bin, n, CAST(-g / (n + g) AS DOUBLE), CAST(s / (n + g) AS DOUBLE) FROM pulls WHERE k = 1
  UNION ALL SELECT p.movieId, p.k, p.m, p.bin, p.n, -p.g / (p.n + p.l + p.g + p.l * f.c),
                   (p.s + p.l * f.d) / (p.n + p.l + p.g + p.l * f.c)
  FROM forward f JOIN pulls p ON p.movieId IS NOT DISTINCT FROM f.movieId AND p.k = f.k + 1),
reduced AS MATERIALIZED (SELECT * FROM forward),
backward(movieId, k, bin, n, b) AS (
  SELECT movieId, k, bin, n, d FROM reduced WHERE k = m
  UNION ALL SELECT f.movieId, f.k, f.bin, f.n, f.d - f.c * b.b
  FROM backward b JOIN reduced f ON f.movieId IS NOT DISTINCT FROM b.movieId AND f.k = b.k - 1),
smooth AS MATERIALIZED (SELECT movieId, bin, n, b FROM backward),
origin AS (SELECT avg("timestamp") AS t0 FROM train),
sums AS (
  SELECT userId, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(r) AS sr, sum(x * r) AS sxr
  FROM (SELECT *, ("timestamp" - t0) / (365.25 * 86400) AS x FROM left_over, origin) GROUP BY userId),
drift AS MATERIALIZED (
  SELECT userId, n, ((sxx + 10) * sr - sx * sxr) / ((n + 10) * (sxx + 10) - sx * sx) AS a,
         ((n + 10) * sxr - sx * sr) / ((n + 10) * (sxx + 10) - sx * sx) AS d FROM sums)"""
    fitted = FINALS.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + timed
    out["movie_bins_plain"] = fitted + f"\nSELECT movieId, bin, n AS n_it, {_r('s / n', 'b_it')} FROM cells"
    out["movie_bins_smooth"] = fitted + f"\nSELECT movieId, bin, n AS n_it, {_r('b', 'b_it')} FROM smooth"
    out["user_drift"] = fitted + f"\nSELECT userId, {_r('a', 'a_u')}, {_r('d', 'd_u')}, n AS n_u FROM drift"
    out["richer_models"] = fitted + user_genre + f""",
asked AS (SELECT *, CAST(floor("timestamp" / (91 * 86400)) AS BIGINT) AS own_bin FROM scored_validation),
sides AS (
  SELECT v.row_key, max_by(struct_pack(bin := s.bin, b := s.b), s.bin) FILTER (WHERE s.bin <= v.own_bin) AS lo,
         min_by(struct_pack(bin := s.bin, b := s.b), s.bin) FILTER (WHERE s.bin > v.own_bin) AS hi
  FROM asked v JOIN smooth s ON s.movieId IS NOT DISTINCT FROM v.movieId GROUP BY v.row_key),
binned AS (
  SELECT rating, pred + CASE WHEN lo IS NULL AND hi IS NULL THEN 0 WHEN lo IS NULL THEN hi.b WHEN lo.bin = own_bin OR hi IS NULL THEN lo.b
    ELSE lo.b + (hi.b - lo.b) * (own_bin - lo.bin) / (hi.bin - lo.bin) END AS pred
  FROM asked v LEFT JOIN sides s ON s.row_key = v.row_key)
SELECT CAST(1 AS BIGINT) AS step, 'Optimized Regularized Model with Genre Effects' AS method, {_r('rmse', 'rmse')} FROM best3
UNION ALL SELECT 2, 'User and Genre Effects Model', {_r('sqrt(avg((rating - pred - coalesce(b_ug, 0)) ^ 2))', 'rmse')}
FROM scored_validation v LEFT JOIN final_user_genre x
  ON x.userId IS NOT DISTINCT FROM v.userId AND x.genres IS NOT DISTINCT FROM v.genres
UNION ALL SELECT 3, 'Time-Binned Movie Effects Model', {_r('sqrt(avg((rating - pred) ^ 2))', 'rmse')} FROM binned
UNION ALL SELECT 4, 'User Drift Model',
  {_r('sqrt(avg((rating - pred - coalesce(a + d * ("timestamp" - t0) / (365.25 * 86400), 0)) ^ 2))', 'rmse')}
FROM scored_validation v CROSS JOIN origin LEFT JOIN drift x ON x.userId IS NOT DISTINCT FROM v.userId"""

    # Latent factors: two iterations of rank two, a solve of two equations per key and step.
    def first(k: int) -> str:
        return f"CAST('0x' || substr(md5(CAST(movieId AS VARCHAR) || '|{k}'), 1, 6) AS BIGINT) / CAST(16777216 AS DOUBLE) - 0.5"

    def step(name: str, key: str, other: str, source: str) -> str:
        return f"""
{name} AS MATERIALIZED (
  SELECT {key}, (c * x - b * y) / (a * c - b * b) AS f0, (a * y - b * x) / (a * c - b * b) AS f1 FROM (
    SELECT l.{key}, sum(f0 * f0) + 5 AS a, sum(f0 * f1) AS b, sum(f1 * f1) + 5 AS c, sum(r * f0) AS x, sum(r * f1) AS y
    FROM left_over l JOIN {source} s ON s.{other} = l.{other} GROUP BY l.{key}))"""

    factors = fitted + f""",
m0 AS MATERIALIZED (SELECT movieId, {first(0)} AS f0, {first(1)} AS f1 FROM (SELECT DISTINCT movieId FROM left_over)),
{step('u1', 'userId', 'movieId', 'm0')},
{step('m1', 'movieId', 'userId', 'u1')},
{step('u2', 'userId', 'movieId', 'm1')},
{step('m2', 'movieId', 'userId', 'u2')}"""
    out["movie_factors"] = factors + f"\nSELECT movieId, {_r('f0', 'q0')}, {_r('f1', 'q1')} FROM m2"
    out["user_factors"] = factors + f"\nSELECT userId, {_r('f0', 'p0')}, {_r('f1', 'p1')} FROM u2"
    out["richer_models"] = (
        factors + out["richer_models"][len(fitted) :] + f"""
UNION ALL SELECT 5, 'Latent Factor Model',
  {_r('sqrt(avg((rating - pred - coalesce(u.f0 * m.f0 + u.f1 * m.f1, 0)) ^ 2))', 'rmse')}
FROM scored_validation v LEFT JOIN u2 u ON u.userId = v.userId LEFT JOIN m2 m ON m.movieId = v.movieId"""
    )
    out["recommend_factors"] = factors + f""",
candidates AS (SELECT movieId, min(genres) AS genres FROM development GROUP BY movieId),
movie_scores AS (
  SELECT c.movieId, coalesce(b_i, 0) + coalesce(b_g, 0) AS shared, coalesce(f0, 0) AS q0, coalesce(f1, 0) AS q1
  FROM candidates c
  LEFT JOIN final_movie m ON m.movieId IS NOT DISTINCT FROM c.movieId
  LEFT JOIN final_genre x ON x.genres IS NOT DISTINCT FROM c.genres
  LEFT JOIN m2 ON m2.movieId = c.movieId),
pairs AS (
  SELECT u.userId, s.movieId, round(shared + coalesce(u2.f0, 0) * q0 + coalesce(u2.f1, 0) * q1, 9) AS score
  FROM (SELECT DISTINCT userId FROM development) u CROSS JOIN movie_scores s LEFT JOIN u2 ON u2.userId = u.userId
  ANTI JOIN development e ON e.userId = u.userId AND e.movieId = s.movieId),
ranked AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY score DESC, movieId) AS rank FROM pairs)
SELECT r.userId, rank, movieId, {_r('mu + coalesce(b_u, 0) + score', 'pred', 7)}
FROM ranked r CROSS JOIN mean LEFT JOIN final_user u ON u.userId = r.userId WHERE rank <= 5"""

    # Genre words: normal equations of all words, solved by elimination.
    def words(source: str) -> str:
        """Weights by word from ``source``: genres, n, s."""
        return f"""
worded AS MATERIALIZED (
  SELECT genres, n, s, CASE WHEN genres IS NULL THEN CAST([NULL] AS VARCHAR[]) ELSE list_distinct(string_split(genres, '|')) END AS words
  FROM {source}),
names AS MATERIALIZED (
  SELECT word, row_number() OVER (ORDER BY word NULLS FIRST) AS k, n, s
  FROM (SELECT word, sum(n) AS n, sum(s) AS s FROM (SELECT unnest(words) AS word, n, s FROM worded) GROUP BY word)),
places AS MATERIALIZED (
  SELECT genres, x.n, k FROM (SELECT genres, n, unnest(words) AS word FROM worded) x JOIN names y ON x.word IS NOT DISTINCT FROM y.word),
gram AS MATERIALIZED (
  SELECT a.k AS i, b.k AS j, sum(a.n) AS v FROM places a JOIN places b ON a.genres IS NOT DISTINCT FROM b.genres GROUP BY a.k, b.k),
lines AS MATERIALIZED (
  SELECT a.k, list_append(list(CAST(coalesce(v, 0) + CASE WHEN a.k = b.k THEN 5 ELSE 0 END AS DOUBLE) ORDER BY b.k), CAST(any_value(a.s) AS DOUBLE)) AS line
  FROM names a CROSS JOIN names b LEFT JOIN gram g ON g.i = a.k AND g.j = b.k GROUP BY a.k),
elimination(step, m) AS (
  SELECT CAST(0 AS BIGINT), list(line ORDER BY k) FROM lines
  UNION ALL SELECT step + 1, list_transform(m, lambda line, i: CASE WHEN i = step + 1
      THEN list_transform(line, lambda v: v / m[step + 1][step + 1])
      ELSE list_transform(line, lambda v, j: v - line[step + 1] / m[step + 1][step + 1] * m[step + 1][j]) END)
  FROM elimination WHERE step < (SELECT count(*) FROM names)),
solution AS MATERIALIZED (SELECT m FROM elimination WHERE step = (SELECT count(*) FROM names)),
weights AS MATERIALIZED (SELECT word, n, m[k][len(m) + 1] AS weight FROM names, solution),
said AS MATERIALIZED (
  SELECT x.genres, sum(weight) AS said FROM (SELECT genres, unnest(words) AS word FROM worded) x
  JOIN weights y ON x.word IS NOT DISTINCT FROM y.word GROUP BY x.genres)"""

    def prior() -> str:
        """Movie effects by the blend of means and words, from ``train`` and ``mean``."""
        return f"""
strings AS (SELECT genres, count(*) AS n, sum(rating - mu) AS s FROM train, mean GROUP BY genres),{words('strings')},
means AS MATERIALIZED (
  SELECT movieId, count(*) AS n, avg(rating - mu) AS y, var_pop(rating - mu) AS v, min(genres) AS genres FROM train, mean GROUP BY movieId),
spread AS MATERIALIZED (
  SELECT sum(n * v) / (sum(n) - count(*)) AS within,
         greatest(0, (sum(n * (y - said) ^ 2) - count(*) * sum(n * v) / (sum(n) - count(*))) / sum(n)) AS between_
  FROM means m JOIN said x ON x.genres IS NOT DISTINCT FROM m.genres),
blended AS MATERIALIZED (
  SELECT movieId, n, said + between_ * n / (between_ * n + within) * (y - said) AS b
  FROM means m JOIN said x ON x.genres IS NOT DISTINCT FROM m.genres, spread)"""

    recursive = lambda text: text.replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    two_levels = recursive(MODELS) + f""",
best_movie AS MATERIALIZED (
  SELECT movieId, sum(rating - mu) / (count(*) + lam) AS b_i FROM train, mean, best2 GROUP BY movieId, lam),
best_user AS MATERIALIZED (
  SELECT userId, sum(rating - mu - b_i) / (count(*) + lam) AS b_u
  FROM train t JOIN best_movie m ON t.movieId IS NOT DISTINCT FROM m.movieId, mean, best2 GROUP BY userId, lam),
strings AS MATERIALIZED (
  SELECT genres, count(*) AS n, sum(rating - mu - b_i - b_u) AS s
  FROM train t JOIN best_movie m ON t.movieId IS NOT DISTINCT FROM m.movieId
  JOIN best_user u ON t.userId IS NOT DISTINCT FROM u.userId, mean GROUP BY genres),{words('strings')}"""
    out["genre_word_weights"] = two_levels + f"\nSELECT word, {_r('weight', 'weight')}, CAST(n AS BIGINT) AS n FROM weights"
    out["movie_prior"] = recursive(DENSE) + f""",
mean AS (SELECT avg(rating) AS mu FROM train),{prior()}
SELECT movieId, n AS n_i, {_r('b', 'b_i')} FROM blended"""
    out["cold_start_errors"] = recursive(SPARSE) + f""",
mean AS (SELECT avg(rating) AS mu FROM train),{prior()},
told AS (
  SELECT rating, coalesce(b.n, 0) AS n, mu + coalesce(m.y, 0) AS plain, mu + coalesce(b, said, 0) AS pred
  FROM validation v CROSS JOIN mean LEFT JOIN blended b ON b.movieId IS NOT DISTINCT FROM v.movieId
  LEFT JOIN means m ON m.movieId IS NOT DISTINCT FROM v.movieId LEFT JOIN said x ON x.genres IS NOT DISTINCT FROM v.genres)
SELECT CASE WHEN n = 0 THEN 'unseen' WHEN n <= 5 THEN 'few' ELSE 'many' END AS support, count(*) AS n,
       {_r('sqrt(avg((rating - plain) ^ 2))', 'rmse_plain')}, {_r('sqrt(avg((rating - pred) ^ 2))', 'rmse_prior')}
FROM told GROUP BY 1"""
    words_rmse = f"""
WITH RECURSIVE {two_levels.split('WITH RECURSIVE', 1)[1]}
SELECT sqrt(avg((rating - mu - coalesce(b_i, 0) - coalesce(b_u, 0) - coalesce(said, 0)) ^ 2)) FROM validation v CROSS JOIN mean
LEFT JOIN best_movie m ON m.movieId IS NOT DISTINCT FROM v.movieId LEFT JOIN best_user u ON u.userId IS NOT DISTINCT FROM v.userId
LEFT JOIN said x ON x.genres IS NOT DISTINCT FROM v.genres"""
    out["richer_models"] += f"""
UNION ALL SELECT 6, 'Genre Words Model', round(({words_rmse}), 6) + 0.0"""

    # Evaluation in time order: a fit of its own for every origin.
    cuts = " UNION ALL ".join(
        f"""SELECT CAST({k} AS INTEGER) AS origin, quantile_cont("timestamp", {p}) AS cutoff FROM enriched"""
        for k, p in ((1, 0.5), (2, 0.7), (3, 0.9))
    )
    out["time_ordered_errors"] = RAW.rstrip() + f""",
origins AS MATERIALIZED (SELECT *, lead(cutoff) OVER (ORDER BY origin) AS until FROM ({cuts})),
past AS MATERIALIZED (SELECT origin, r.* FROM enriched r JOIN origins ON r."timestamp" < cutoff),
means AS MATERIALIZED (SELECT origin, count(*) AS n, avg(rating) AS mu FROM past GROUP BY origin),
movie_at AS MATERIALIZED (
  SELECT p.origin, movieId, sum(rating - mu) / (count(*) + 5) AS b FROM past p JOIN means m ON m.origin = p.origin
  GROUP BY p.origin, movieId),
user_at AS MATERIALIZED (
  SELECT p.origin, userId, sum(rating - mu - b) / (count(*) + 5) AS u FROM past p JOIN means m ON m.origin = p.origin
  JOIN movie_at x ON x.origin = p.origin AND x.movieId IS NOT DISTINCT FROM p.movieId GROUP BY p.origin, userId),
test AS (
  SELECT o.origin, r.*, mu, b, u FROM enriched r
  JOIN origins o ON r."timestamp" >= cutoff AND (until IS NULL OR r."timestamp" < until) JOIN means m ON m.origin = o.origin
  LEFT JOIN movie_at x ON x.origin = o.origin AND x.movieId IS NOT DISTINCT FROM r.movieId
  LEFT JOIN user_at y ON y.origin = o.origin AND y.userId IS NOT DISTINCT FROM r.userId),
errors AS (
  SELECT origin, count(*) AS n_test, count(*) FILTER (WHERE b IS NOT NULL AND u IS NOT NULL) AS n_known,
         sqrt(avg((rating - mu) ^ 2) FILTER (WHERE b IS NOT NULL AND u IS NOT NULL)) AS r0,
         sqrt(avg((rating - mu - b) ^ 2) FILTER (WHERE b IS NOT NULL AND u IS NOT NULL)) AS r1,
         sqrt(avg((rating - mu - b - u) ^ 2) FILTER (WHERE b IS NOT NULL AND u IS NOT NULL)) AS r2 FROM test GROUP BY origin)
SELECT o.origin, {_r('cutoff', 'cutoff')}, n AS n_train, {_r('mu', 'mu')}, n_test, n_known,
       {_r('r0', 'rmse_mean')}, {_r('r1', 'rmse_movie')}, {_r('r2', 'rmse_movie_user')}
FROM origins o JOIN means m ON m.origin = o.origin JOIN errors e ON e.origin = o.origin"""

    # Blends: every fold is scored by models of the other two.
    folds = DENSE.rstrip() + """,
dealt AS MATERIALIZED (
  SELECT *, CAST(CAST('0x' || substr(md5('fold|' || row_key), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold FROM development),
others AS MATERIALIZED (SELECT f.fold AS without, d.* FROM dealt d JOIN (SELECT DISTINCT fold FROM dealt) f ON d.fold <> f.fold),
means AS MATERIALIZED (SELECT without, avg(rating) AS mu FROM others GROUP BY without),
by_movie AS MATERIALIZED (
  SELECT o.without, movieId, sum(rating - mu) / (count(*) + 5) AS b FROM others o JOIN means m ON m.without = o.without GROUP BY o.without, movieId),
by_user AS MATERIALIZED (
  SELECT o.without, userId, sum(rating - mu) / (count(*) + 5) AS u FROM others o JOIN means m ON m.without = o.without GROUP BY o.without, userId),
scored AS MATERIALIZED (
  SELECT d.*, mu, coalesce(b, 0) AS movie, coalesce(u, 0) AS "user" FROM dealt d JOIN means m ON m.without = d.fold
  LEFT JOIN by_movie x ON x.without = d.fold AND x.movieId IS NOT DISTINCT FROM d.movieId
  LEFT JOIN by_user y ON y.without = d.fold AND y.userId IS NOT DISTINCT FROM d.userId)"""
    out["out_of_fold_scores"] = folds + f"""
SELECT row_key, fold, {_r('mu', 'mu')}, {_r('movie', 'movie')}, {_r('"user"', '"user"')} FROM scored"""
    out["blend"] = folds + f""",
sums AS (
  SELECT sum(movie * movie) AS a, sum(movie * "user") AS b, sum("user" * "user") AS c,
         sum(movie * (rating - mu)) AS x, sum("user" * (rating - mu)) AS y FROM scored),
free AS (SELECT *, (c * x - b * y) / (a * c - b * b) AS w1, (a * y - b * x) / (a * c - b * b) AS w2 FROM sums),
alone AS (SELECT *, greatest(x, 0) ^ 2 / a AS gain1, greatest(y, 0) ^ 2 / c AS gain2 FROM free),
weights AS (
  SELECT CASE WHEN w1 >= 0 AND w2 >= 0 THEN w1 WHEN gain1 >= gain2 THEN greatest(x, 0) / a ELSE 0 END AS w1,
         CASE WHEN w1 >= 0 AND w2 >= 0 THEN w2 WHEN gain1 >= gain2 THEN 0 ELSE greatest(y, 0) / c END AS w2 FROM alone)
SELECT 'weight of movie' AS name, {_r('w1', 'value')} FROM weights
UNION ALL SELECT 'weight of user', {_r('w2', 'value')} FROM weights
UNION ALL SELECT 'rmse', {_r('sqrt(avg((rating - mu - w1 * movie - w2 * "user") ^ 2))', 'value')} FROM scored, weights"""

    # Similar titles: all pairs that share a word.
    out["similar_titles"] = RAW.rstrip() + f""",
words AS MATERIALIZED (
  SELECT DISTINCT movieId, unnest(string_split_regex(lower(trim(title)), '\\s+')) AS word FROM movies WHERE title IS NOT NULL),
rarity AS MATERIALIZED (
  SELECT word, ln(1 + (SELECT count(DISTINCT movieId) FROM words) / CAST(count(*) AS DOUBLE)) AS w FROM words GROUP BY word),
lengths AS (SELECT movieId, sqrt(sum(w * w)) AS length FROM words JOIN rarity USING (word) GROUP BY movieId),
weights AS MATERIALIZED (SELECT movieId, word, w / length AS w FROM words JOIN rarity USING (word) JOIN lengths USING (movieId)),
pairs AS (
  SELECT a.movieId, b.movieId AS other, round(sum(a.w * b.w), 9) AS score
  FROM weights a JOIN weights b ON a.word = b.word AND a.movieId <> b.movieId GROUP BY a.movieId, b.movieId),
ranked AS (SELECT *, row_number() OVER (PARTITION BY movieId ORDER BY score DESC, other) AS rank FROM pairs WHERE score > 0)
SELECT movieId, rank, other AS "similar", {_r('score', 'similarity')} FROM ranked WHERE rank <= 10"""
    return {name: sql.strip() for name, sql in out.items()}


ORACLE_SQL = _sql()
