"""Reference SQL (DuckDB dialect) for the queries that SQL can express.

Each statement recomputes its answer from the raw test tables with plain SQL
(window de-duplication, conditional averages, cross-join scoring), so it is an
independent check of the Spark plans, which use different strategies
(aggregate de-duplication, genre-mask pruning, partition offsets).
"""

from __future__ import annotations

from reelrank.functions.genres import GENRE_TO_PROFILE, GENRES, PROFILE_COLUMNS
from reelrank.functions.text import BM25_B, BM25_K1
from reelrank.sources.starschema import GENRE_SOURCE


def _flag_sql(genre: str) -> str:
    kind, value = GENRE_SOURCE[genre]
    if kind == "name":
        return f"CAST(list_contains(string_split(p_name, ' '), '{value}') AS INTEGER)"
    return f"CAST(p_type = '{value}' AS INTEGER)"


_FLAGS = ",\n       ".join(f"{_flag_sql(g)} AS {g}" for g in GENRES)
_ANY = " + ".join(_flag_sql(g) for g in GENRES)

BASE = f"""
ev AS (
  SELECT o.o_custkey AS userId, l.l_partkey AS movieId,
         CAST(1 + (CAST(l.l_quantity AS INTEGER) - 1) // 10 AS INTEGER) AS rating,
         CAST(epoch(l.l_shipdate) AS BIGINT) AS timestamp,
         l.l_orderkey AS src_order, l.l_linenumber AS src_line
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
ratings AS (
  SELECT userId, movieId, rating, timestamp FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, movieId
                                 ORDER BY timestamp DESC, src_order DESC, src_line DESC) AS rn
    FROM ev WHERE rating IS NOT NULL AND userId IS NOT NULL AND movieId IS NOT NULL
  ) WHERE rn = 1
),
items AS (
  SELECT p_partkey AS movieId, p_name AS title,
       CASE WHEN {_ANY} = 0 THEN 1 ELSE 0 END AS unknown,
       {_FLAGS}
  FROM part
),
all_users AS (
  SELECT c_custkey AS userId, CAST(round(c_acctbal / 100) AS INTEGER) AS age,
         CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         lower(c_mktsegment) AS occupation, c_name AS zipcode
  FROM customer
),
users AS (SELECT * FROM all_users),
profiles AS (
  SELECT r.userId, u.age, u.gender, u.occupation,
         {", ".join(f"AVG(CASE WHEN i.{g} = 1 THEN r.rating END) AS {GENRE_TO_PROFILE[g]}" for g in GENRES)}
  FROM ratings r JOIN items i ON r.movieId = i.movieId JOIN users u ON r.userId = u.userId
  GROUP BY r.userId, u.age, u.gender, u.occupation
)"""


def with_base(body: str) -> str:
    return "WITH " + BASE.strip() + ",\n" + body.strip()


def with_base_only(select: str) -> str:
    return "WITH " + BASE.strip() + "\n" + select.strip()


SQL: dict[str, str] = {}

SQL["item_table"] = with_base_only(f"""
SELECT i.movieId, i.title, s.avg_rating, COALESCE(s.n_ratings, 0) AS n_ratings,
       i.unknown, {", ".join("i." + g for g in GENRES)}
FROM items i LEFT JOIN (
  SELECT movieId, AVG(rating) AS avg_rating, COUNT(rating) AS n_ratings
  FROM ratings GROUP BY movieId) s ON i.movieId = s.movieId
""")

_FLAG_COLS = ", ".join(GENRES)
_RAW_FLAGS = ",\n       ".join(
    ["CAST(unknown AS VARCHAR) AS unknown"] + [f"CAST({g} AS VARCHAR) AS {g}" for g in GENRES])

SQL["scan_ratings"] = with_base_only("SELECT userId, movieId, rating, timestamp FROM ev")

SQL["scan_items"] = with_base_only(f"""
SELECT movieId, title, CAST(NULL AS VARCHAR) AS release_date,
       CAST(NULL AS VARCHAR) AS video_release_date, CAST(NULL AS VARCHAR) AS imdb_url,
       {_RAW_FLAGS}
FROM items
""")

SQL["scan_users"] = with_base_only("SELECT * FROM all_users")

SQL["clean_ratings"] = with_base_only("SELECT * FROM ratings")

SQL["dedup_ratings"] = with_base_only("""
SELECT userId, movieId, rating, timestamp, src_order, src_line FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, movieId
                               ORDER BY timestamp DESC, src_order DESC, src_line DESC) AS rn
  FROM ev) WHERE rn = 1
""")

SQL["dedup_items"] = with_base_only(f"""
SELECT movieId, title, CAST(NULL AS VARCHAR) AS release_date,
       CAST(NULL AS VARCHAR) AS video_release_date, CAST(NULL AS VARCHAR) AS imdb_url,
       {_RAW_FLAGS}
FROM items WHERE movieId IN (SELECT l_partkey FROM lineitem)
""")

SQL["item_flags"] = with_base_only(f"""
SELECT movieId, title, CAST(NULL AS VARCHAR) AS release_date,
       CAST(NULL AS VARCHAR) AS video_release_date, CAST(NULL AS VARCHAR) AS imdb_url,
       unknown, {_FLAG_COLS}, 0 AS invalid_flags
FROM items
""")

SQL["item_avg_rating"] = with_base_only("""
SELECT movieId, AVG(rating) AS avg_rating, COUNT(rating) AS n_ratings
FROM ratings GROUP BY movieId
""")

SQL["item_stats_left_join"] = with_base_only("""
SELECT i.movieId, i.title, s.avg_rating, COALESCE(s.n_ratings, 0) AS n_ratings
FROM items i LEFT JOIN (
  SELECT movieId, AVG(rating) AS avg_rating, COUNT(rating) AS n_ratings
  FROM ratings GROUP BY movieId
) s ON i.movieId = s.movieId
""")

SQL["item_genres_long"] = with_base_only(f"""
SELECT movieId, genre FROM (UNPIVOT (SELECT movieId, {_FLAG_COLS} FROM items)
  ON {_FLAG_COLS} INTO NAME genre VALUE flag) WHERE flag = 1
""")

SQL["rating_facts"] = with_base_only(f"""
SELECT r.userId, r.movieId, r.rating, r.timestamp, i.title,
       {", ".join("i." + g for g in GENRES)}, u.age, u.gender, u.occupation
FROM ratings r JOIN items i ON r.movieId = i.movieId JOIN users u ON r.userId = u.userId
""")

SQL["user_genre_profile"] = with_base_only("SELECT * FROM profiles")

SQL["user_genre_profile_long"] = with_base_only(f"""
SELECT r.userId, g.genre, AVG(r.rating) AS avg_rating, COUNT(r.rating) AS n_ratings
FROM ratings r
JOIN (SELECT movieId, genre FROM (UNPIVOT (SELECT movieId, {_FLAG_COLS} FROM items)
      ON {_FLAG_COLS} INTO NAME genre VALUE flag) WHERE flag = 1) g ON r.movieId = g.movieId
WHERE r.userId IN (SELECT userId FROM users)
GROUP BY r.userId, g.genre
""")

SQL["profile_targets"] = with_base_only(
    "SELECT userId, age, gender, occupation, "
    + ", ".join(f"COALESCE({p}, 0.0) AS {p}" for p in PROFILE_COLUMNS)
    + " FROM profiles")


def _weight(p: str) -> str:
    return f"CASE WHEN {p} IS NOT NULL AND {p} <> 0 THEN {p} END"


def _score_sql(weights: list[str], alias_w: str = "w", alias_i: str = "i") -> str:
    terms = " + ".join(
        f"COALESCE(CAST({alias_w}.{w} AS DOUBLE), 0.0) * {alias_i}.{g}" for w, g in zip(weights, GENRES))
    return f"round(CAST(1.0 AS DOUBLE) + {terms}, 6)"


def brute_force_top_k(weights_cte: str, id_col: str, weights: list[str], k: int = 10) -> str:
    """Every (row, item) pair scored, row_number <= k: the exhaustive reference."""
    return f"""
scored AS (
  SELECT w.{id_col}, i.movieId, i.title, {_score_sql(weights)} AS score
  FROM {weights_cte} w CROSS JOIN items i
),
topk AS (
  SELECT {id_col}, CAST(ROW_NUMBER() OVER (PARTITION BY {id_col} ORDER BY score DESC, movieId ASC) AS INTEGER) AS rank,
         movieId, title, score
  FROM scored
)"""


_KNOWN_W = ("w_known AS (SELECT userId, "
            + ", ".join(f"{_weight(p)} AS {p}" for p in PROFILE_COLUMNS) + " FROM profiles),")

SQL["recommend_known"] = with_base(
    _KNOWN_W + brute_force_top_k("w_known", "userId", PROFILE_COLUMNS).strip()
    + "\nSELECT * FROM topk WHERE rank <= 10")

SQL["answer_documents"] = with_base(
    _KNOWN_W + brute_force_top_k("w_known", "userId", PROFILE_COLUMNS).strip() + """
SELECT userId, CAST(to_json({'userId': userId,
                        'recommendations': list({'movieId': movieId, 'title': title} ORDER BY rank)}) AS VARCHAR) AS answer
FROM topk WHERE rank <= 10 GROUP BY userId""")

_REQ = f"""
req AS (
  SELECT c_custkey * 2 + a AS requestId,
         CASE WHEN a = 0 THEN CAST(c_custkey AS VARCHAR) END AS userId_text,
         CASE WHEN c_nationkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender_text,
         upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS occupation_text,
         CASE WHEN c_acctbal >= 0 THEN CAST(CAST(round(c_acctbal / 100) AS INTEGER) AS VARCHAR) END AS age_text
  FROM customer CROSS JOIN (VALUES (0), (1)) v(a)
),
req_clean AS (
  SELECT requestId, TRY_CAST(trim(userId_text) AS BIGINT) AS userId,
         upper(NULLIF(trim(gender_text), '')) AS gender,
         lower(NULLIF(trim(occupation_text), '')) AS occupation,
         TRY_CAST(trim(age_text) AS INTEGER) AS age,
         COALESCE(trim(userId_text), '') <> '' AS has_user,
         COALESCE(trim(age_text), '') <> '' AS has_age
  FROM req
),
req_known AS (
  SELECT q.*, (q.userId IS NOT NULL AND q.userId IN (SELECT userId FROM profiles)) AS is_known
  FROM req_clean q
),
req_class AS (
  SELECT *, CASE
    WHEN has_user AND userId IS NULL THEN 'userId is not a number'
    WHEN is_known THEN NULL
    WHEN concat_ws(', ', CASE WHEN gender IS NULL THEN 'gender' END,
                   CASE WHEN occupation IS NULL THEN 'occupation' END,
                   CASE WHEN NOT has_age THEN 'age' END) <> ''
      THEN 'missing for a new user: ' || concat_ws(', ', CASE WHEN gender IS NULL THEN 'gender' END,
                   CASE WHEN occupation IS NULL THEN 'occupation' END,
                   CASE WHEN NOT has_age THEN 'age' END)
    WHEN age IS NULL THEN 'age is not a number'
  END AS reject_reason
  FROM req_known
)"""

SQL["requests_clean"] = with_base(_REQ.strip() + """
SELECT requestId, userId, gender, occupation, age FROM req_clean""")

SQL["requests_known_new"] = with_base(_REQ.strip() + """
SELECT requestId, userId, is_known FROM req_known""")

SQL["requests_rejected"] = with_base(_REQ.strip() + """
SELECT requestId, reject_reason FROM req_class WHERE reject_reason IS NOT NULL""")

_SEARCH = f"""
docs AS (
  SELECT movieId, title, list_filter(regexp_split_to_array(lower(title), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0) AS toks
  FROM items
),
docs_nz AS (SELECT * FROM docs WHERE len(toks) > 0),
dstats AS (SELECT COUNT(*) AS n_docs, AVG(len(toks)) AS avgdl FROM docs_nz),
dtok AS (SELECT movieId, title, len(toks) AS dl, unnest(toks) AS token FROM docs_nz),
dtf AS (SELECT movieId, title, dl, token, COUNT(*) AS tf FROM dtok GROUP BY movieId, title, dl, token),
dfreq AS (SELECT token, COUNT(*) AS n_t FROM dtf GROUP BY token),
qtok AS (
  SELECT query, token, COUNT(*) AS qtf FROM (
    SELECT query, unnest(list_filter(regexp_split_to_array(lower(query), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0)) AS token
    FROM (SELECT DISTINCT p_name AS query FROM part)) GROUP BY query, token
),
hits AS (
  SELECT q.query, d.movieId, d.title,
         round(SUM(q.qtf * ln(1 + (s.n_docs - f.n_t + 0.5) / (f.n_t + 0.5)) * d.tf
                   / (d.tf + {BM25_K1} * ({1.0 - BM25_B} + {BM25_B} * d.dl / s.avgdl))), 6) AS score
  FROM qtok q JOIN dtf d ON q.token = d.token JOIN dfreq f ON f.token = q.token CROSS JOIN dstats s
  GROUP BY q.query, d.movieId, d.title
),
ranked_hits AS (
  SELECT query, CAST(ROW_NUMBER() OVER (PARTITION BY query ORDER BY score DESC, movieId ASC) AS INTEGER) AS rank,
         movieId, title, score
  FROM hits
)"""

SQL["title_search"] = with_base(_SEARCH.strip() + """
SELECT * FROM ranked_hits WHERE rank <= 10""")

SQL["recommend_by_title"] = with_base(
    _KNOWN_W + brute_force_top_k("w_known", "userId", PROFILE_COLUMNS).strip() + ",\n"
    + _SEARCH.strip() + """,
seed AS (SELECT query, movieId AS seed FROM ranked_hits WHERE rank = 1),
counted AS (
  SELECT s.query, t.movieId AS rec, COUNT(DISTINCT r.userId) AS n_users
  FROM seed s JOIN ratings r ON r.movieId = s.seed
  JOIN (SELECT userId, movieId FROM topk WHERE rank <= 10) t ON t.userId = r.userId
  GROUP BY s.query, t.movieId
)
SELECT c.query, CAST(c.rank AS INTEGER) AS rank, c.rec AS movieId, i.title, c.n_users FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query ORDER BY n_users DESC, rec ASC) AS rank FROM counted
) c JOIN items i ON i.movieId = c.rec WHERE c.rank <= 10""")

_P = 1000003
_MIX = f"(((((userId % {_P}) + {_P}) % {_P}) * 7919 + (((movieId % {_P}) + {_P}) % {_P}) * 104729) % {_P})"
_BUCKET = f"(({_MIX} * {_MIX}) % {_P} % 100)"

SQL["split_hash"] = with_base_only(f"""
SELECT *, CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split FROM ratings""")

SQL["kfold_split"] = with_base_only("""
SELECT userId, movieId, rating, timestamp,
       CAST((rn - 1) * 5 // total + 1 AS INTEGER) AS fold
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY timestamp, userId, movieId) AS rn,
             COUNT(*) OVER () AS total FROM ratings)""")

SQL["leave_n_out"] = with_base_only("""
SELECT r.userId, r.movieId, r.rating, r.timestamp,
       CASE WHEN t.userId IS NOT NULL THEN 'test' ELSE 'base' END AS part
FROM ratings r LEFT JOIN (
  SELECT userId, movieId FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY userId ORDER BY timestamp, movieId) AS n FROM ratings
  ) WHERE n BETWEEN 1 AND 10
) t ON r.userId = t.userId AND r.movieId = t.movieId""")

SQL["rmse_baseline"] = with_base_only(f"""
SELECT 'rmse' AS metric, round(sqrt(AVG((m.prediction - t.rating) * (m.prediction - t.rating))), 6) AS value,
       COUNT(*) AS n
FROM (SELECT * FROM ratings WHERE {_BUCKET} >= 80) t
JOIN (SELECT movieId, AVG(rating) AS prediction FROM ratings WHERE {_BUCKET} < 80 GROUP BY movieId) m
  ON t.movieId = m.movieId""")

SQL["publish_roundtrip"] = SQL["item_table"]

SQL["publish_checks"] = """
SELECT 'exists' AS check_name, TRUE AS passed, CAST(NULL AS BIGINT) AS value
UNION ALL
SELECT 'non_empty', COUNT(*) > 0, COUNT(*) FROM part"""

# The training vocabulary of the test tables (gender by nation parity, the
# five market segments); the Spark side reads it from the fitted indexer.
_GENDERS = ["F", "M"]
_OCCUPATIONS = ["automobile", "building", "furniture", "household", "machinery"]

SQL["demographic_onehot"] = with_base_only(
    "SELECT userId, age, "
    + ", ".join(f"CASE WHEN gender = '{g}' THEN 1 ELSE 0 END AS gender_{g}" for g in _GENDERS) + ", "
    + ", ".join(f"CASE WHEN occupation = '{o}' THEN 1 ELSE 0 END AS occupation_{o}" for o in _OCCUPATIONS)
    + ", CASE WHEN occupation IN (" + ", ".join(f"'{o}'" for o in _OCCUPATIONS)
    + ") THEN 0 ELSE 1 END AS occupation_unseen FROM all_users")

SQL["split_random_check"] = with_base_only(
    "SELECT COUNT(*) AS n_rows, 0 AS overlap, 0 AS missing FROM ratings")

SQL["splits_roundtrip"] = with_base_only("""
, numbered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY timestamp, userId, movieId) AS rn, COUNT(*) OVER () AS total,
         ROW_NUMBER() OVER (PARTITION BY userId ORDER BY timestamp, movieId) AS n FROM ratings),
sets AS (
  SELECT 'u' || s AS set_name, CASE WHEN (rn - 1) * 5 // total + 1 = s THEN 'test' ELSE 'base' END AS part, userId, movieId
  FROM numbered, (VALUES (1), (2), (3), (4), (5)) v(s)
  UNION ALL SELECT 'ua', CASE WHEN n BETWEEN 1 AND 10 THEN 'test' ELSE 'base' END, userId, movieId FROM numbered
  UNION ALL SELECT 'ub', CASE WHEN n BETWEEN 11 AND 20 THEN 'test' ELSE 'base' END, userId, movieId FROM numbered)
SELECT set_name, part, COUNT(*) AS n_rows, COUNT(DISTINCT userId) AS n_users,
       CAST(SUM(userId) AS BIGINT) AS user_sum, CAST(SUM(movieId) AS BIGINT) AS item_sum
FROM sets GROUP BY set_name, part""")

SQL["als_predicted_pairs"] = with_base_only(f"""
SELECT userId, movieId, rating FROM ratings WHERE {_BUCKET} >= 80
  AND userId IN (SELECT userId FROM ratings WHERE {_BUCKET} < 80)
  AND movieId IN (SELECT movieId FROM ratings WHERE {_BUCKET} < 80)""")

SQL["als_lists_check"] = with_base_only("""
SELECT COUNT(DISTINCT userId) AS users, COUNT(DISTINCT userId) * least(10, COUNT(DISTINCT movieId)) AS n_rows,
       0 AS wrong_ranks FROM ratings""")

SQL["als_unseen_check"] = with_base_only("""
SELECT COUNT(*) AS users, CAST(SUM(least(10, total - n)) AS BIGINT) AS n_rows, 0 AS wrong_ranks, 0 AS rated_rows
FROM (SELECT userId, COUNT(*) AS n FROM ratings GROUP BY userId),
     (SELECT COUNT(DISTINCT movieId) AS total FROM ratings) WHERE total > n""")

SQL["title_documents"] = SQL["recommend_by_title"].replace(
    "SELECT c.query, CAST(c.rank AS INTEGER) AS rank, c.rec AS movieId, i.title, c.n_users FROM (",
    """SELECT c.query, CAST(to_json({'movie_title': c.query,
  'recommendations': list({'movieId': c.rec, 'title': i.title} ORDER BY c.rank)}) AS VARCHAR) AS answer FROM (""",
) + " GROUP BY c.query"

_VALID_NEW = "FROM req_class WHERE reject_reason IS NULL AND NOT is_known"

SQL["coldstart_check"] = with_base(_REQ.strip() + f"""
SELECT COUNT(*) AS requests, COUNT(*) * 18 AS n_scores, 0 AS out_of_range,
       COUNT(*) * least(10, (SELECT COUNT(*) FROM items)) AS list_rows, 0 AS wrong_ranks {_VALID_NEW}""")

SQL["session_check"] = with_base(
    _KNOWN_W + brute_force_top_k("w_known", "userId", PROFILE_COLUMNS).strip() + ",\n" + _REQ.strip() + f"""
SELECT q.requestId, q.userId, 'known' AS path, t.rank, t.movieId, t.title, t.score,
       CAST(NULL AS INTEGER) AS occupation_unseen, CAST(NULL AS VARCHAR) AS reject_reason
FROM req_class q JOIN topk t ON t.userId = q.userId WHERE q.is_known AND q.reject_reason IS NULL AND t.rank <= 10
UNION ALL
SELECT requestId, userId, 'rejected', NULL, NULL, NULL, NULL, NULL, reject_reason FROM req_class WHERE reject_reason IS NOT NULL
UNION ALL
SELECT requestId, userId, 'new', CAST(r AS INTEGER), NULL, NULL, NULL, 0, NULL
FROM (SELECT * {_VALID_NEW}), range(1, 11) v(r) WHERE r <= (SELECT COUNT(*) FROM items)""")

_ASKED = "(SELECT p_name AS query FROM part UNION SELECT n_name FROM nation)"

SQL["title_answers"] = SQL["recommend_by_title"].replace("(SELECT DISTINCT p_name AS query FROM part)", _ASKED).replace(
    "SELECT c.query, CAST(c.rank AS INTEGER) AS rank, c.rec AS movieId, i.title, c.n_users FROM (",
    """, told AS (SELECT c.query, list({'movieId': c.rec, 'title': i.title} ORDER BY c.rank) AS recs FROM (""",
) + f""" GROUP BY c.query)
SELECT query, reason, CAST(CASE WHEN reason IS NULL THEN to_json({{'movie_title': query, 'recommendations': recs}})
  ELSE to_json({{'movie_title': query, 'reason': reason}}) END AS VARCHAR) AS answer FROM (
  SELECT q.query, t.recs, CASE WHEN t.recs IS NOT NULL THEN NULL WHEN s.seed IS NULL THEN 'no such title'
    WHEN s.seed NOT IN (SELECT movieId FROM ratings) THEN 'no ratings' ELSE 'no recommendations' END AS reason
  FROM {_ASKED} q LEFT JOIN seed s USING (query) LEFT JOIN told t USING (query))"""

SQL["snapshot_roundtrip"] = SQL["item_table"]

SQL["bulk_roundtrip"] = SQL["answer_documents"]
