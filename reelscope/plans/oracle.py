"""Plain-SQL twins of the analyses, for DuckDB over the same parquet tables.

Each statement rebuilds the four rating tables as CTEs over the star schema
(``nation customer lineitem orders part``) and answers the question in the
most direct SQL: it does not share plans or shortcuts with the Spark side
(for example the occupation x genre count joins every rating to every genre
piece before counting), so agreement is evidence, not an echo.
"""

from __future__ import annotations

_BASE = r"""
occupations AS (
  SELECT n_nationkey AS occupation_id, n_name AS occupation_name
  FROM nation
),
users AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_mktsegment IN ('FURNITURE', 'BUILDING') THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_acctbal < 0 THEN 1
              WHEN c_acctbal < 2000 THEN 18
              WHEN c_acctbal < 4000 THEN 25
              WHEN c_acctbal < 6000 THEN 35
              WHEN c_acctbal < 7000 THEN 45
              WHEN c_acctbal < 8000 THEN 50
              ELSE 56 END AS age,
         c_nationkey AS occupation_id,
         CAST(10000 + c_custkey AS VARCHAR) AS zip
  FROM customer
),
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id,
         CAST(1 + (CAST(l_quantity AS INTEGER) - 1) % 5 AS DOUBLE) AS rating,
         o_orderdate AS rated_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
movies AS (
  SELECT p_partkey AS movie_id,
         CASE p_partkey % 10
              WHEN 0 THEN p_name
              WHEN 1 THEN split_part(p_name, ' ', 1) || ' (' || y || ')'
              WHEN 2 THEN p_name || ' (alt) (' || y || ')'
              ELSE p_name || ' (' || y || ')' END AS title,
         CASE p_size % 6
              WHEN 0 THEN p_type
              WHEN 1 THEN p_type || '|' || split_part(p_name, ' ', 2)
              WHEN 2 THEN p_type || '|' || split_part(p_name, ' ', 2) || '|' || split_part(p_name, ' ', 1)
              WHEN 3 THEN p_type || '|' || p_type
              WHEN 4 THEN p_type || '|' || split_part(p_name, ' ', 2) || '|'
              ELSE p_type || '||' || split_part(p_name, ' ', 2) END AS genres
  FROM (SELECT *, CAST(1950 + (p_partkey * 7) % 60 AS VARCHAR) AS y FROM part) p
)"""

# Reusable derived tables.
_STATS = """stats AS (
  SELECT movie_id, sum(rating) AS total, count(*) AS n, sum(rating) / count(*) AS avg_rating
  FROM ratings GROUP BY movie_id
)"""

_PIECES = """pieces AS (
  SELECT movie_id, unnest(
    CASE WHEN genres = '' THEN ['']
         WHEN rtrim(genres, '|') = '' THEN []::VARCHAR[]
         ELSE string_split(rtrim(genres, '|'), '|') END) AS genre
  FROM movies
)"""


def _gender_stats(gender: str) -> str:
    return f"""gstats AS (
  SELECT r.movie_id, sum(r.rating) AS total, count(*) AS n, sum(r.rating) / count(*) AS avg_rating
  FROM ratings r JOIN users u ON r.user_id = u.user_id
  WHERE u.gender = '{gender}' GROUP BY r.movie_id
)"""


_COHORT_STATS = """cstats AS (
  SELECT r.movie_id, sum(r.rating) AS total, count(*) AS n, sum(r.rating) / count(*) AS avg_rating
  FROM users u JOIN ratings r ON u.user_id = r.user_id
  WHERE u.age = 1 GROUP BY r.movie_id
)"""

_TWO_WORD = r"' (.*) (\(\d{4}\))'"
_PLAIN = r"'(.*) (\(\d{4}\))'"


def _year(pattern: str) -> str:
    g = f"regexp_extract(title, {pattern}, 2)"
    return f"CASE WHEN {g} = '' THEN -1 ELSE CAST(substr({g}, 2, 4) AS INTEGER) END"


_NAME = (
    "CASE WHEN strpos(m.title, ' (') > 0 "
    "THEN substr(m.title, 1, strpos(m.title, ' (') - 1) ELSE m.title END"
)


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((_BASE,) + ctes) + "\n" + body.strip()


def _year_counts(pattern: str) -> str:
    return _sql(
        f"SELECT year, count(*) AS n FROM (SELECT {_year(pattern)} AS year FROM movies) t "
        "GROUP BY year ORDER BY year"
    )


def _year_genre_counts(pattern: str) -> str:
    return _sql(
        f"""
SELECT y.year, p.genre, count(*) AS n
FROM (SELECT movie_id, {_year(pattern)} AS year FROM movies) y
JOIN pieces p ON y.movie_id = p.movie_id
GROUP BY y.year, p.genre ORDER BY y.year, p.genre""",
        _PIECES,
    )


def _gender_queries(label: str, gender: str) -> dict[str, str]:
    g = _gender_stats(gender)
    return {
        f"r4_top_total_{label}": _sql(
            "SELECT total, movie_id FROM gstats ORDER BY total DESC, movie_id LIMIT 10", g
        ),
        f"r4_top_avg_detail_{label}": _sql(
            """
SELECT s.avg_rating, s.movie_id, s.total, s.n, m.title, m.genres
FROM gstats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.movie_id LIMIT 10""",
            g,
        ),
        f"r4_top_avg_named_{label}": _sql(
            f"""
SELECT s.movie_id, {_NAME} AS name, s.total, s.n, s.avg_rating
FROM gstats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.movie_id LIMIT 10""",
            g,
        ),
    }


_OCC_GENRE = """
FROM ratings r
JOIN users u ON r.user_id = u.user_id
JOIN occupations o ON u.occupation_id = o.occupation_id
JOIN pieces p ON r.movie_id = p.movie_id
GROUP BY o.occupation_name, p.genre"""


ORACLE_SQL: dict[str, str] = {
    "r1_table_counts": _sql(
        """
SELECT 'occupations' AS table_name, count(*) AS n FROM occupations
UNION ALL SELECT 'movies', count(*) FROM movies
UNION ALL SELECT 'users', count(*) FROM users
UNION ALL SELECT 'ratings', count(*) FROM ratings"""
    ),
    "r1_users_by_occupation": _sql(
        """
SELECT u.occupation_id, u.user_id, u.gender, u.age, u.zip, o.occupation_name
FROM users u JOIN occupations o ON u.occupation_id = o.occupation_id"""
    ),
    "r1_joined_user_count": _sql(
        "SELECT count(*) AS n FROM users u JOIN occupations o ON u.occupation_id = o.occupation_id"
    ),
    "r2_user_movie_count": _sql("SELECT count(*) AS n FROM ratings WHERE user_id = 18"),
    "r2_user_movies": _sql(
        """
SELECT r.movie_id, r.user_id, m.title, m.genres
FROM ratings r JOIN movies m ON r.movie_id = m.movie_id WHERE r.user_id = 18"""
    ),
    "r2_user_movies_brief": _sql(
        """
SELECT r.movie_id, m.title, m.genres
FROM ratings r JOIN movies m ON r.movie_id = m.movie_id WHERE r.user_id = 18"""
    ),
    "r3_top_avg": _sql(
        "SELECT avg_rating, movie_id FROM stats ORDER BY avg_rating DESC, movie_id LIMIT 10",
        _STATS,
    ),
    "r3_top_avg_detail": _sql(
        """
SELECT s.avg_rating, s.movie_id, m.title, m.genres, s.total, s.n
FROM stats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.movie_id LIMIT 10""",
        _STATS,
    ),
    "r3_top_avg_detail_brief": _sql(
        """
SELECT s.avg_rating, s.movie_id, m.title, m.genres
FROM stats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.movie_id LIMIT 10""",
        _STATS,
    ),
    "r3_top_watched": _sql(
        "SELECT n, movie_id FROM stats ORDER BY n DESC, movie_id LIMIT 10", _STATS
    ),
    "r3_top_watched_detail": _sql(
        """
SELECT s.n, s.movie_id, m.title, m.genres, s.total, s.avg_rating
FROM stats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.n DESC, s.movie_id LIMIT 10""",
        _STATS,
    ),
    "r3_top_watched_detail_brief": _sql(
        """
SELECT s.n, s.movie_id, m.title, m.genres
FROM stats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.n DESC, s.movie_id LIMIT 10""",
        _STATS,
    ),
    # the text layout loses nothing of a rating, so plain statistics answer it
    "r3_decoded_rating_stats": _sql("SELECT movie_id, total, n, avg_rating FROM stats", _STATS),
    **_gender_queries("female", "F"),
    **_gender_queries("male", "M"),
    "r5_cohort_user_count": _sql("SELECT count(*) AS n FROM users WHERE age = 1"),
    "r5_rating_count": _sql("SELECT count(*) AS n FROM ratings"),
    "r5_cohort_rating_count": _sql(
        "SELECT count(*) AS n FROM users u JOIN ratings r ON u.user_id = r.user_id WHERE u.age = 1"
    ),
    "r5_cohort_top_avg": _sql(
        """
SELECT avg_rating, movie_id, total, n FROM cstats
ORDER BY avg_rating DESC, movie_id LIMIT 10""",
        _COHORT_STATS,
    ),
    "r5_cohort_top_avg_brief": _sql(
        "SELECT movie_id, avg_rating FROM cstats ORDER BY avg_rating DESC, movie_id LIMIT 10",
        _COHORT_STATS,
    ),
    "r5_cohort_top_named": _sql(
        f"""
SELECT s.movie_id, {_NAME} AS name, s.avg_rating, s.total, s.n, m.genres
FROM cstats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.movie_id LIMIT 10""",
        _COHORT_STATS,
    ),
    "r5_cohort_top_named_brief": _sql(
        f"""
SELECT s.movie_id, {_NAME} AS name, s.avg_rating
FROM cstats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.movie_id LIMIT 10""",
        _COHORT_STATS,
    ),
    "r5_cohort_multikey": _sql(
        """
SELECT s.movie_id, m.title, m.genres, s.avg_rating, s.total, s.n
FROM cstats s JOIN movies m ON s.movie_id = m.movie_id
ORDER BY s.avg_rating DESC, s.n DESC, m.title, s.movie_id LIMIT 10""",
        _COHORT_STATS,
    ),
    "r5_cohort_semi_count": _sql(
        "SELECT count(*) AS n FROM ratings WHERE user_id IN (SELECT user_id FROM users WHERE age = 1)"
    ),
    "r5_cohort_semi_top100": _sql(
        """
SELECT movie_id, sum(rating) AS total, count(*) AS n, sum(rating) / count(*) AS avg_rating
FROM ratings WHERE user_id IN (SELECT user_id FROM users WHERE age = 1)
GROUP BY movie_id
ORDER BY avg_rating DESC, n DESC, CAST(movie_id AS VARCHAR) LIMIT 100"""
    ),
    "r6_genre_counts": _sql("SELECT genre, count(*) AS n FROM pieces GROUP BY genre", _PIECES),
    "r7_year_counts_two_word": _year_counts(_TWO_WORD),
    "r7_year_counts": _year_counts(_PLAIN),
    "r7_title_parts": _sql(
        f"""
SELECT movie_id, regexp_extract(title, {_TWO_WORD}, 1) AS name_two_word,
       regexp_extract(title, {_PLAIN}, 1) AS name_plain
FROM movies"""
    ),
    "r8_year_genre_lookup": _sql(
        f"""
SELECT y.year, count(DISTINCT p.genre) AS n_genres, count(*) FILTER (p.genre = 'MEDIUM') AS n
FROM (SELECT movie_id, {_year(_TWO_WORD)} AS year FROM movies) y
JOIN pieces p ON y.movie_id = p.movie_id GROUP BY y.year""",
        _PIECES,
    ),
    "r8_year_genre_counts_two_word": _year_genre_counts(_TWO_WORD),
    "r8_year_genre_counts": _year_genre_counts(_PLAIN),
    "r9_occupation_genre_counts": _sql(
        "SELECT o.occupation_name, p.genre, count(*) AS n" + _OCC_GENRE, _PIECES
    ),
    "r10_occupation_genre_sink": _sql(
        "SELECT o.occupation_name AS occ, p.genre AS mtype, count(*) AS nums" + _OCC_GENRE,
        _PIECES,
    ),
    "x_all_age_top10": _sql(
        """
SELECT age,
       CASE age WHEN 1 THEN 'Under 18' WHEN 18 THEN '18-24' WHEN 25 THEN '25-34'
                WHEN 35 THEN '35-44' WHEN 45 THEN '45-49' WHEN 50 THEN '50-55'
                WHEN 56 THEN '56+' END AS age_band,
       "rank", movie_id, avg_rating, total, n FROM (
  SELECT u.age, r.movie_id, sum(r.rating) AS total, count(*) AS n,
         sum(r.rating) / count(*) AS avg_rating,
         row_number() OVER (PARTITION BY u.age
                            ORDER BY sum(r.rating) / count(*) DESC, r.movie_id) AS "rank"
  FROM ratings r JOIN users u ON r.user_id = u.user_id
  GROUP BY u.age, r.movie_id
) t WHERE "rank" <= 10"""
    ),
    "x_all_gender_top10": _sql(
        """
SELECT gender, "rank", movie_id, avg_rating, total, n FROM (
  SELECT u.gender, r.movie_id, sum(r.rating) AS total, count(*) AS n,
         sum(r.rating) / count(*) AS avg_rating,
         row_number() OVER (PARTITION BY u.gender
                            ORDER BY sum(r.rating) / count(*) DESC, r.movie_id) AS "rank"
  FROM ratings r JOIN users u ON r.user_id = u.user_id
  GROUP BY u.gender, r.movie_id
) t WHERE "rank" <= 10"""
    ),
}


# --- mechanisms made for a cluster: the question in plain SQL ------------------

_PLAIN_YEARS = f"years AS (SELECT movie_id, {_year(_PLAIN)} AS year FROM movies)"
_LEVELS = """sums AS (
  SELECT 0 AS level, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS INTEGER) AS age, movie_id, sum(rating) AS total, count(*) AS n
  FROM ratings GROUP BY movie_id
  UNION ALL
  SELECT 1, gender, NULL, movie_id, sum(rating), count(*) FROM ratings JOIN users USING (user_id) GROUP BY gender, movie_id
  UNION ALL
  SELECT 2, NULL, age, movie_id, sum(rating), count(*) FROM ratings JOIN users USING (user_id) GROUP BY age, movie_id
)"""


def _top_lists(name: str, levels: str, order: str) -> str:
    return f"""
SELECT '{name}' AS list, "of", row_number() OVER (PARTITION BY level, "of" ORDER BY {order}) AS rank, movie_id, total, n
FROM (SELECT *, CASE level WHEN 0 THEN 'all' WHEN 1 THEN gender ELSE CAST(age AS VARCHAR) END AS "of" FROM sums)
WHERE level IN ({levels})"""


_COHORTS = """cohorts AS (
  SELECT user_id, unnest(['gender ' || gender, 'age ' || CAST(age AS VARCHAR), 'occupation ' || CAST(occupation_id AS VARCHAR)]) AS cohort
  FROM users
),
sizes AS (SELECT cohort, count(DISTINCT user_id) AS n FROM cohorts GROUP BY cohort),
met AS (
  SELECT x.cohort AS a, y.cohort AS b, count(DISTINCT user_id) AS n_both
  FROM cohorts x JOIN cohorts y USING (user_id) WHERE x.cohort < y.cohort GROUP BY ALL
)"""

# The planted faults: one kind for each remainder by 11 of the movie's id.
_FAULT = """CASE movie_id % 11 WHEN 1 THEN 'blank line' WHEN 2 THEN 'no movie_id' WHEN 3 THEN 'no rating'
  WHEN 4 THEN 'user_id is not bigint' WHEN 5 THEN 'movie_id is not bigint' WHEN 6 THEN 'rating is not double' ELSE 'good' END"""

ORACLE_SQL |= {
    "r3_movie_positions": _sql(
        "SELECT row_number() OVER (ORDER BY avg_rating DESC, movie_id) AS position, movie_id, avg_rating, n FROM stats", _STATS
    ),
    "r8_year_genre_positions": _sql(
        """
SELECT row_number() OVER (ORDER BY year, genre) AS position, year, genre, n
FROM (SELECT year, genre, count(*) AS n FROM years JOIN pieces USING (movie_id) GROUP BY year, genre)""",
        _PLAIN_YEARS,
        _PIECES,
    ),
    "r8_year_movie_pages": _sql(
        """
SELECT year, page, count(*) AS n, string_agg(CAST(movie_id AS VARCHAR), ',' ORDER BY movie_id) AS movie_ids
FROM (SELECT year, movie_id, (row_number() OVER (PARTITION BY year ORDER BY movie_id) - 1) // 50 AS page FROM years)
GROUP BY year, page""",
        _PLAIN_YEARS,
    ),
    "r8_year_genre_counts_from_pages": _sql(
        "SELECT year, genre, count(*) AS n FROM years JOIN pieces USING (movie_id) GROUP BY year, genre", _PLAIN_YEARS, _PIECES
    ),
    "r4_top_total_female_threshold": ORACLE_SQL["r4_top_total_female"],
    "r4_top_total_male_threshold": ORACLE_SQL["r4_top_total_male"],
    "x_rating_levels": _sql("SELECT level, gender, age, movie_id, total, n, total / n AS avg_rating FROM sums", _LEVELS),
    "x_report_lists": _sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            (
                _top_lists("best mean", "0, 1, 2", "total / n DESC, movie_id"),
                _top_lists("most watched", "0", "n DESC, movie_id"),
                _top_lists("largest sum", "1", "total DESC, movie_id"),
            )
        )
        + ") WHERE rank <= 10",
        _LEVELS,
    ),
    "r5_cohort_bitmap_count": ORACLE_SQL["r5_cohort_semi_count"],
    "x_cohort_overlaps": _sql(
        """
SELECT a, b, x.n AS n_a, y.n AS n_b, n_both, x.n + y.n - n_both AS n_either, x.n - n_both AS n_only_a
FROM met JOIN sizes x ON x.cohort = a JOIN sizes y ON y.cohort = b""",
        _COHORTS,
    ),
    "r9_occupation_genre_counts_split": ORACLE_SQL["r9_occupation_genre_counts"],
    "r3_exact_thirds": _sql(
        """
SELECT movie_id, fsum(rating / 3) AS total, count(*) AS n, fsum(rating / 3) / count(*) AS avg_rating
FROM ratings GROUP BY movie_id"""
    ),
    "r3_stats_from_state": _sql("SELECT movie_id, total, n, avg_rating FROM stats", _STATS),
    "r3_stats_after_withdrawal": _sql(
        """
SELECT movie_id, sum(rating) AS total, count(*) AS n, sum(rating) / count(*) AS avg_rating
FROM ratings WHERE year(rated_at) <> 1996 GROUP BY movie_id"""
    ),
    "r1_record_faults": _sql(f"SELECT {_FAULT} AS reason, count(*) AS n FROM ratings GROUP BY ALL"),
    "r1_good_record_stats": _sql(
        f"""
SELECT movie_id, sum(rating) AS total, count(*) AS n, sum(rating) / count(*) AS avg_rating
FROM ratings WHERE {_FAULT} = 'good' GROUP BY movie_id"""
    ),
    "r10_sink_written_twice": ORACLE_SQL["r10_occupation_genre_sink"],
}
