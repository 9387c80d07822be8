"""Plain SQL for every registered query, from the definition of its result:
whole candidate lists, correlated tests, one window over everything. The
queries reach the same rows by other plans."""

from __future__ import annotations

_RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST((CAST(l_quantity AS BIGINT) - 1) % 5 + 1 AS INTEGER) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_ITEMS = """items AS (
  SELECT p_partkey AS item_id, p_name AS title, string_split(p_name, ' ') AS genres FROM part),
item_genres AS (SELECT item_id, title, unnest(genres) AS genre FROM items)"""

_USERS = """users AS (
  SELECT c_custkey AS user_id, c_mktsegment AS occupation, c_acctbal AS balance, n_name AS nation
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

# An item's mean is the sum of its ratings over their number; its title is
# looked up afterwards.
_AVERAGES = """item_totals AS (
  SELECT item_id, sum(rating) AS points, count(rating) AS votes FROM ratings GROUP BY item_id),
averages AS (
  SELECT item_id, title, round(points / votes, 4) AS avg_rating, votes AS rating_count
  FROM item_totals JOIN items USING (item_id))"""

# A rating counts once for each word of its item.
_GENRE_COUNTS = """labelled AS (SELECT user_id, unnest(genres) AS genre FROM items JOIN ratings USING (item_id)),
genre_counts AS (SELECT user_id, genre, count(*) AS genre_count FROM labelled GROUP BY ALL)"""

# The word with most ratings, the first by name among equals.
_FAVOURITES = """favourites AS (
  SELECT user_id, arg_min(genre, {'fewer': -genre_count, 'name': genre}) AS favorite_genre,
         max(genre_count) AS genre_rating_count
  FROM genre_counts GROUP BY user_id)"""

_ACTIVE = """active AS (SELECT user_id, count(*) AS rating_count FROM ratings GROUP BY user_id HAVING count(*) >= 50),
active_favourites AS (SELECT f.* FROM favourites f JOIN active a ON f.user_id = a.user_id)"""

# An item with enough ratings stands, with its own mean, under each of its words.
_GENRE_ITEMS = """genre_items AS (
  SELECT unnest(genres) AS genre, item_id, title, avg_rating, rating_count
  FROM averages JOIN items USING (item_id, title) WHERE rating_count >= 5)"""

# What is open to a user: the items of the favourite word without a rating by that user.
_CANDIDATES = """candidates AS (
  SELECT user_id, item_id, title, avg_rating, favorite_genre AS fav_genre
  FROM genre_items, favourites
  WHERE genre = favorite_genre AND NOT EXISTS (
    FROM ratings WHERE ratings.user_id = favourites.user_id AND ratings.item_id = genre_items.item_id))"""


def _ranked(name: str, direction: str, n: int = 5) -> str:
    return f"""{name} AS (
  SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY avg_rating {direction}, item_id) AS INTEGER)
         AS rank, item_id, title, avg_rating, fav_genre
  FROM candidates QUALIFY rank <= {n})"""


_BASE = [_RATINGS, _ITEMS]
_AVG = [*_BASE, _AVERAGES]
_FAV = [*_BASE, _GENRE_COUNTS, _FAVOURITES]
_ACT = [*_FAV, _ACTIVE]
_CAND = [*_FAV, _AVERAGES, _GENRE_ITEMS, _CANDIDATES]
_RECS = [*_CAND, _ranked("recs", "DESC")]
_EXCL = [*_CAND, _ranked("excl", "ASC")]


def _sql(views: list[str], body: str) -> str:
    return "WITH " + ",\n".join(views) + ("" if body.startswith(",") else "\n") + body


_TOP = """SELECT {columns} FROM averages WHERE rating_count >= 25 ORDER BY avg_rating DESC, item_id LIMIT 10"""

_COHORT = """, cohort AS (SELECT user_id FROM users WHERE {where})
SELECT r.item_id, i.title, avg(r.rating) AS avg_rating, count(r.rating) AS num_ratings
FROM ratings r JOIN items i ON r.item_id = i.item_id
WHERE r.user_id IN (SELECT user_id FROM cohort)
GROUP BY r.item_id, i.title HAVING count(r.rating) >= {support}
ORDER BY avg_rating DESC, r.item_id LIMIT 10"""

_LOW = "balance < 0"
_SEGMENT = "occupation = 'MACHINERY' AND balance BETWEEN 3000 AND 4000"

_FAV_COUNTS = "counts AS (SELECT favorite_genre, count(*) AS n FROM active_favourites GROUP BY favorite_genre)"

_HISTOGRAM = """, ends AS (
  SELECT CASE WHEN min(avg_rating) = max(avg_rating) THEN min(avg_rating) - CAST(0.5 AS DOUBLE)
              ELSE min(avg_rating) END AS low,
         CASE WHEN min(avg_rating) = max(avg_rating) THEN max(avg_rating) + CAST(0.5 AS DOUBLE)
              ELSE max(avg_rating) END AS high
  FROM averages),
edges AS (
  SELECT CAST(i AS INTEGER) AS bin, low + i * ((high - low) / 30) AS bin_low,
         CASE WHEN i = 29 THEN high ELSE low + (i + 1) * ((high - low) / 30) END AS bin_high
  FROM ends, range(30) t(i))
SELECT e.bin, e.bin_low, e.bin_high, count(a.item_id) AS n
FROM edges e LEFT JOIN averages a
  ON a.avg_rating >= e.bin_low AND (a.avg_rating < e.bin_high OR (e.bin = 29 AND a.avg_rating <= e.bin_high))
GROUP BY e.bin, e.bin_low, e.bin_high"""

_WIDE_COLUMNS = ", ".join(
    f"max(CASE WHEN rank = {k} THEN CAST(item_id AS VARCHAR) END) AS rank_{k}_movie_id, "
    f"max(CASE WHEN rank = {k} THEN title END) AS rank_{k}_title, "
    f"max(CASE WHEN rank = {k} THEN printf('%.4f', avg_rating) END) AS rank_{k}_avg_rating"
    for k in range(1, 6)
)

_CELLS = """cells AS (
  SELECT user_id, item_id, rating FROM ratings
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) = 1)"""

_HALVES = "halves AS (SELECT user_id, item_id, rating / 2 - 1 AS rating, ts FROM ratings)"

_ASKED = "asked AS (SELECT unnest([1, 50, 100, -1])::BIGINT AS user_id)"

_FULL_LIST = """, asked AS (SELECT user_id, CAST(k AS INTEGER) AS rank
  FROM (SELECT DISTINCT user_id FROM recs), range(1, {end}) t(k))
SELECT printf('user_%06d', a.user_id) AS row_key, a.rank, coalesce(CAST(r.item_id AS VARCHAR), 'N/A') AS movie_id,
  coalesce(r.title, 'Unknown Title') AS title,
  CASE WHEN r.item_id IS NULL THEN 'N/A' ELSE printf('%.4f', r.avg_rating) END AS avg_rating
FROM asked a LEFT JOIN recs r ON a.user_id = r.user_id AND a.rank = r.rank"""


def _holdout(start: int, stop: int, max_test: int = 0) -> str:
    capped = f" AND eligible_before < {max_test}" if max_test else ""
    return f"""WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS ordinal FROM events),
running AS (
  SELECT *, coalesce(sum(CASE WHEN ordinal BETWEEN {start} AND {stop} THEN 1 ELSE 0 END) OVER (
    ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS eligible_before FROM numbered)
SELECT * EXCLUDE (ordinal, eligible_before),
       CASE WHEN ordinal BETWEEN {start} AND {stop}{capped} THEN 'test' ELSE 'base' END AS role FROM running"""


_FOLDS = """folds AS (
  SELECT *, CAST((row_number() OVER (ORDER BY event_id) - 1) * 5 // count(*) OVER () + 1 AS INTEGER) AS fold
  FROM events)"""

ORACLE: dict[str, str] = {
    "item_avg_rating": _sql(_AVG, "SELECT * FROM averages ORDER BY avg_rating DESC, item_id"),
    "top_items_min_support": _sql(_AVG, _TOP.format(columns="*")),
    "top_items_ranked": _sql(
        _AVG,
        _TOP.format(
            columns="*, CAST(row_number() OVER (ORDER BY avg_rating DESC, item_id) AS INTEGER) AS rank, "
            "1 AS partition_key"
        ),
    ),
    "rating_grand_mean": _sql(_AVG, "SELECT round(avg(avg_rating), 6) AS mean_avg_rating FROM averages"),
    "popularity_quality": _sql(_AVG, "SELECT item_id, rating_count, avg_rating FROM averages"),
    "dataset_profile": _sql(
        [_RATINGS, "per_user AS (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id)"],
        """SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, count(*) AS ratings,
  min(rating) AS min_rating, max(rating) AS max_rating,
  (SELECT count(*) FROM per_user WHERE n < 20) AS users_below_minimum FROM ratings""",
    ),
    "users_low_balance": _sql([_USERS], f"SELECT * FROM users WHERE {_LOW} ORDER BY balance, user_id"),
    "users_segment_range": _sql([_USERS], f"SELECT * FROM users WHERE {_SEGMENT} ORDER BY balance, user_id"),
    "items_exploded": _sql([_ITEMS], "SELECT item_id, title, genre FROM item_genres"),
    "active_users": _sql(_ACT, "SELECT user_id, rating_count FROM active"),
    "user_genre_counts": _sql([*_BASE, _GENRE_COUNTS], "SELECT * FROM genre_counts"),
    "favourite_genre_active": _sql(_ACT, "SELECT * FROM active_favourites ORDER BY user_id"),
    "favourite_genre_all": _sql(_FAV, "SELECT * FROM favourites"),
    "favourite_genre_wide": _sql(_ACT, "SELECT * FROM active_favourites"),
    "genre_item_stats": _sql([*_AVG, _GENRE_ITEMS], "SELECT * FROM genre_items"),
    "seen_pairs": _sql([_RATINGS], "SELECT DISTINCT user_id, item_id FROM ratings"),
    "unrated_candidates": _sql(
        _CAND,
        "SELECT user_id, fav_genre AS favorite_genre, count(*) AS candidates FROM candidates GROUP BY ALL",
    ),
    "recommend_top5": _sql(_RECS, "SELECT * FROM recs ORDER BY user_id, rank"),
    "exclude_bottom5": _sql(_EXCL, "SELECT * FROM excl ORDER BY user_id, rank"),
    "most_excluded_items": _sql(
        _EXCL,
        """SELECT item_id, title, count(*) AS excluded_for, min(avg_rating) AS avg_rating FROM excl
GROUP BY item_id, title ORDER BY excluded_for DESC, avg_rating, item_id""",
    ),
    "cohort_top_items_low_balance": _sql([*_BASE, _USERS], _COHORT.format(where=_LOW, support=5)),
    "cohort_top_items_segment": _sql([*_BASE, _USERS], _COHORT.format(where=_SEGMENT, support=3)),
    "favourite_genre_counts": _sql([*_ACT, _FAV_COUNTS], "SELECT * FROM counts ORDER BY n DESC, favorite_genre"),
    "age_like_counts": _sql(
        [_USERS], "SELECT CAST(floor(balance / 1000) AS BIGINT) AS band, count(*) AS n FROM users GROUP BY 1 ORDER BY 1"
    ),
    "genre_top6_other": _sql(
        [*_ACT, _FAV_COUNTS],
        """, placed AS (SELECT *, row_number() OVER (ORDER BY n DESC, favorite_genre) AS place FROM counts)
SELECT place > 6 AS is_rest, CASE WHEN place > 6 THEN 'Other' ELSE favorite_genre END AS favorite_genre,
       CAST(sum(n) AS BIGINT) AS n FROM placed GROUP BY 1, 2 HAVING sum(n) > 0""",
    ),
    "genre_top6_other_nulls": _sql(
        [*_ACT, _FAV_COUNTS],
        """, placed AS (SELECT *, row_number() OVER (ORDER BY n DESC, favorite_genre) AS place FROM counts)
SELECT place > 6 AS is_rest, CASE WHEN place > 6 THEN 'Other' ELSE favorite_genre END AS favorite_genre,
       CAST(sum(n) AS BIGINT) AS n FROM placed GROUP BY 1, 2 HAVING sum(n) > 0""",
    ),
    "genre_share_pct": _sql(
        [*_ACT, _FAV_COUNTS],
        """, pcts AS (SELECT favorite_genre, n,
  round(CAST(100 AS DOUBLE) * n / (SELECT sum(n) FROM counts), 1) AS pct FROM counts)
SELECT *, CASE WHEN pct >= 1.0 THEN printf('%.1f%%', pct) END AS label FROM pcts""",
    ),
    "rating_histogram30": _sql(_AVG, _HISTOGRAM),
    "label_map": _sql(
        _AVG,
        """SELECT item_id, substring(title, 1, 7) AS short_title,
  printf('%.4f  (%d ratings)', avg_rating, rating_count) AS label,
  printf('%.2f  (%d ratings)', avg_rating, rating_count) AS short_label FROM averages""",
    ),
    "recs_wide": _sql(_RECS, f"SELECT printf('user_%06d', user_id) AS row_key, {_WIDE_COLUMNS} FROM recs GROUP BY user_id"),
    "recs_wide_lookup": _sql(
        _RECS,
        """SELECT printf('user_%06d', user_id) AS row_key, rank, item_id, title,
  printf('%.4f', avg_rating) AS avg_rating FROM recs""",
    ),
    "recs_wide_lookup_defaults": _sql([*_CAND, _ranked("recs", "DESC", 3)], _FULL_LIST.format(end=6)),
    "recs_wide_ten": _sql([*_CAND, _ranked("recs", "DESC", 10)], _FULL_LIST.format(end=11)),
    "wide_key_count": _sql(_RECS, "SELECT count(DISTINCT user_id) AS stored_users FROM recs"),
    "exclusions_nested": _sql(
        _EXCL,
        """SELECT printf('user_%06d', user_id) AS document_id, user_id, min(fav_genre) AS favorite_genre,
  string_agg(printf('%d:%d:%s:%.4f', rank, item_id, title, avg_rating), ';' ORDER BY rank) AS blacklisted
FROM excl GROUP BY user_id""",
    ),
    "exclusions_flattened": _sql(
        _EXCL,
        """SELECT user_id, fav_genre AS favorite_genre, rank AS avoid_rank, item_id, title,
  avg_rating AS global_avg_rating FROM excl""",
    ),
    "document_find": _sql(
        [*_EXCL, _ASKED],
        """SELECT a.user_id, count(e.item_id) > 0 AS found, min(e.fav_genre) AS favorite_genre,
  CASE WHEN count(e.item_id) > 0 THEN CAST(count(e.item_id) AS INTEGER) END AS entries
FROM asked a LEFT JOIN excl e ON a.user_id = e.user_id GROUP BY a.user_id""",
    ),
    "rating_matrix_map": _sql(
        [_RATINGS, _CELLS],
        """SELECT user_id, item_id // 1024 AS segment,
  string_agg(item_id || ':' || rating, ';' ORDER BY item_id) AS cells FROM cells GROUP BY 1, 2""",
    ),
    "rating_matrix_row": _sql(
        [_RATINGS, _CELLS, _USERS],
        f"SELECT user_id, item_id, rating FROM cells WHERE user_id IN (SELECT user_id FROM users WHERE {_LOW})",
    ),
    "rating_matrix_fetch": _sql(
        [_RATINGS, _CELLS, _ASKED], "SELECT user_id, item_id, rating FROM cells SEMI JOIN asked USING (user_id)"
    ),
    "rating_matrix_floats": _sql(
        [_RATINGS, _CELLS], "SELECT user_id, item_id, rating / 2 - 1 AS rating FROM cells"
    ),
    "lookup_ids": _sql(
        [_USERS, _ASKED],
        """SELECT a.user_id, u.occupation, u.balance, u.nation, u.user_id IS NOT NULL AS found
FROM asked a LEFT JOIN users u ON a.user_id = u.user_id""",
    ),
    "profile_lookup": _sql(
        [*_ACT, _USERS],
        """SELECT u.user_id, coalesce(f.favorite_genre, 'Unknown') AS favorite_genre, f.genre_rating_count,
  f.user_id IS NOT NULL AS found, printf('user_%06d', u.user_id) AS row_key
FROM users u LEFT JOIN active_favourites f ON u.user_id = f.user_id""",
    ),
    "keyed_table_upsert": _sql(
        [_RATINGS],
        """SELECT * FROM ratings
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC, rating DESC) = 1""",
    ),
    "keyed_table_merge": _sql(
        [_RATINGS],
        """SELECT * FROM ratings
QUALIFY row_number() OVER (
  PARTITION BY user_id ORDER BY rating >= 4 DESC, ts DESC, item_id DESC, rating DESC) = 1""",
    ),
    "clustered_table_roundtrip": _sql(
        [*_AVG, _GENRE_ITEMS],
        "SELECT *, row_number() OVER (PARTITION BY genre ORDER BY avg_rating DESC, item_id) AS rank FROM genre_items",
    ),
    "table_readback_check": _sql(
        _AVG, "SELECT count(*) AS stored_rows, CAST(0 AS BIGINT) AS differing_rows FROM averages"
    ),
    "csv_export_roundtrip": _sql(_AVG, "SELECT * FROM averages"),
    **dict.fromkeys(
        ("csv_export_padded", "cached_padded"),
        _sql(
            _AVG,
            """SELECT * REPLACE (repeat(' ', item_id % 3) || title || '" ' || repeat(' ', item_id % 3) AS title)
FROM averages""",
        ),
    ),
    "export_inferred": _sql(_AVG, "SELECT * FROM averages"),
    "cached_result": _sql(_ACT, "SELECT * FROM active_favourites"),
    "scan_ratings_tsv": _sql([_RATINGS], "SELECT *, CAST(rating AS DOUBLE) AS rating_value FROM ratings"),
    "scan_ratings_float": _sql([_RATINGS, _HALVES], "SELECT * FROM halves"),
    "good_lines": _sql([_RATINGS], "SELECT * FROM ratings WHERE item_id % 50 NOT IN (1, 2, 3, 4)"),
    "bad_lines_set_aside": _sql(
        [_RATINGS],
        """SELECT CAST(CASE item_id % 50 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 4 END AS INTEGER) AS fields, count(*) AS n
FROM ratings WHERE item_id % 50 IN (1, 2, 3, 4) GROUP BY 1""",
    ),
    "scan_columns_subset": _sql([_RATINGS], "SELECT item_id, rating FROM ratings"),
    "scan_items_undated": """SELECT p_partkey AS item_id, p_name AS title,
  array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS genres FROM part""",
    "scan_items_flags": """SELECT p_partkey AS item_id, p_name AS title, p_type AS release_date,
  array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS genres FROM part""",
    "scan_users_pipe": """SELECT c_custkey AS user_id, CAST(c_custkey % 60 + 10 AS INTEGER) AS age,
  CASE WHEN c_nationkey < 12 THEN 'M' ELSE 'F' END AS gender, c_mktsegment AS occupation,
  printf('%05d', c_custkey) AS zip_code,
  CASE WHEN c_nationkey < 12 THEN 'Male' ELSE 'Female' END AS gender_label FROM customer""",
    "vocabulary_check": _sql(
        [_ITEMS],
        """SELECT genre, count(*) AS row_count FROM item_genres
WHERE genre NOT IN (SELECT lower(p_type) FROM part) GROUP BY genre""",
    ),
    "occupation_check": _sql(
        [_USERS],
        "SELECT occupation, count(*) AS row_count FROM users WHERE user_id % 3 <> 0 GROUP BY occupation",
    ),
    "vocabulary_index": _sql(
        [_ITEMS],
        "SELECT genre, item_id, CAST(dense_rank() OVER (ORDER BY genre) - 1 AS INTEGER) AS genre_index FROM item_genres",
    ),
    "kfold_split": _sql([_FOLDS], "SELECT * FROM folds"),
    "kfold_sizes": _sql(
        [_FOLDS],
        """SELECT CAST(s AS INTEGER) AS split, CASE WHEN s = fold THEN 'test' ELSE 'base' END AS role, count(*) AS n
FROM folds, range(1, 6) t(s) GROUP BY 1, 2""",
    ),
    "holdout_first10": _holdout(1, 10),
    "holdout_next10": _holdout(11, 20),
    "holdout_capped": _holdout(1, 10, 100),
    "ratings_in_order": _sql([_RATINGS], "SELECT * FROM ratings ORDER BY user_id, item_id, rating, ts"),
    "event_ordinals": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS ordinal FROM events",
}
