"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written the straightforward way — string_agg, plain title join with its
fan-out, window rank — so it checks the Spark plans rather than mirroring
them. Pre-registered views: orders, customer, nation, lineitem, part.
"""

from __future__ import annotations

# Fixed values, stated here on their own so that a wrong value in the package
# shows: pandas' null words, number syntax, white space that Python strips,
# the tag dictionary and the tier labels with the cut points for this data.
NULL_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
NUMBER = r"^[ \t-\r]*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t-\r]*$"
OUTER_SPACE = r"^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$"
TAG_FIXES = (("Horor", "Horror"), ("Mistery", "Mystery"), ("Misterija", "Mystery"), ("Krimi", "Crime"),
             ("Komedija", "Comedy"), ("Akcija", "Action"), ("Romantic Drama", "Drama"), ("Comedy-Drama", "Drama"),
             ("Crime Drama", "Crime"), ("Sports Drama", "Drama"), ("War Drama", "Drama"),
             ("Historical Drama", "Drama"), ("Thriller", "Thriller"), ("Avant-Garde", "Documentary"),
             ("Econmy", "ECONOMY"))
BUDGET_TIERS = ((100_000, "Low Budget"), (200_000, "Mid Budget"), (400_000, "High Budget"), (None, "Blockbuster"))
ROI_TIERS = ((0, "Loss"), (100, "Low Return"), (500, "Good Return"), (None, "Exceptional Return"))
LINE_TAGS = ("Horor", "Mistery", "Misterija", "Krimi", "Komedija", "Akcija", "Romantic Drama", "Comedy-Drama",
             "Crime Drama", "Sports Drama", "War Drama", "Historical Drama", "Thriller", "Avant-Garde",
             "", "\u00a0Drama\t", "horor", "g" * 101)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TOKENS = ", ".join(_q(t) for t in NULL_WORDS)


def _tok(c: str) -> str:
    return f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, {_q(OUTER_SPACE)}, '', 'g')"


def _num(c: str) -> str:
    d = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"CASE WHEN regexp_matches({c}, {_q(NUMBER)}) AND NOT isinf({d}) THEN {d} END"


def _case(c: str, tiers) -> str:
    arms = " ".join(f"WHEN {c} < {cut} THEN {_q(lab)}" for cut, lab in tiers[:-1])
    return f"CASE {arms} ELSE {_q(tiers[-1][1])} END"


def _fix(x: str) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in TAG_FIXES)
    return f"CASE {x} {arms} ELSE {x} END"


def _np_round(x: str, d: int) -> str:
    """numpy round: scale, round half-even on the binary value, unscale."""
    f = f"{10 ** d}.0"
    return f"(round_even(({x}) * {f}, 0) / {f})"


def _half_up(s: str, n: str) -> str:
    """round(s / n) with halves away from zero, in integers."""
    return (f"(CASE WHEN {n} > 0 THEN (CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({s}) + {n}) // (2 * {n})) END)")


def _line_tags() -> str:
    return " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(LINE_TAGS))


CTE = f"""
lines AS (
  SELECT l.l_orderkey,
         count(*) AS n_lines,
         sum(CAST(l.l_extendedprice AS DECIMAL(12,2))
             * (CAST(1 AS DECIMAL(3,2)) - CAST(l.l_discount AS DECIMAL(3,2)))) AS net_amount,
         string_agg(CASE (l.l_orderkey + l.l_linenumber) % 40 {_line_tags()} ELSE CASE WHEN l.l_linenumber % 3 = 0 THEN 'Econmy'
                         WHEN l.l_linenumber % 3 = 1 THEN ' ' || p.p_type
                         ELSE p.p_type END END, ',' ORDER BY l.l_linenumber, p.p_partkey) AS genre
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
),
raw AS (
  SELECT o.o_orderkey,
         CASE WHEN o.o_orderkey % 101 = 0 THEN 'None'
              WHEN o.o_orderkey % 103 = 0 THEN chr(160) || chr(9) || c.c_name || ' ' || year(o.o_orderdate)::VARCHAR || chr(9) || chr(160)
              WHEN o.o_orderkey % 107 = 0 THEN c.c_name || repeat('x', 300)
              ELSE ' ' || c.c_name || ' ' || year(o.o_orderdate)::VARCHAR || ' ' END AS title,
         CAST(year(o.o_orderdate) AS VARCHAR) AS release_year,
         CASE WHEN o.o_orderkey % 109 = 0 THEN repeat('d', 201) ELSE c.c_name END AS director,
         CASE WHEN o.o_orderkey % 113 = 0 THEN repeat('l', 101) WHEN o.o_orderkey % 127 = 0 THEN 'n/a'
              ELSE c.c_mktsegment END AS language,
         CASE WHEN o.o_orderkey IN (1, 2, 3) THEN 'Atlantis' WHEN o.o_orderkey = 4 THEN 'Tie A' WHEN o.o_orderkey = 5 THEN 'Tie B'
              WHEN o.o_orderkey % 131 = 0 THEN 'NA' WHEN o.o_orderkey % 137 = 0 THEN repeat('c', 101) ELSE n.n_name END AS country,
         CASE WHEN o.o_orderkey % 11 = 0 THEN 'N/A' WHEN o.o_orderkey % 139 = 0 THEN '#N/A' WHEN o.o_orderkey % 149 = 0 THEN '95.5'
              WHEN o.o_orderkey % 151 = 0 THEN 'abc' ELSE CAST(li.n_lines AS VARCHAR) END AS duration,
         CASE WHEN o.o_orderkey % 13 = 0 THEN 'unknown' WHEN o.o_orderkey % 17 = 0 THEN '0' WHEN o.o_orderkey % 157 = 0 THEN '0.01'
              WHEN o.o_orderkey % 163 = 0 THEN '1e5' WHEN o.o_orderkey % 167 = 0 THEN '$5'
              ELSE CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS budget,
         CASE WHEN o.o_orderkey IN (1, 2, 3) THEN '10' WHEN o.o_orderkey IN (4, 5) THEN '1000'
              WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0 THEN 'unknown'
              ELSE CAST(CAST(CAST(li.net_amount AS DECIMAL(18,4)) * (n.n_nationkey + 1) AS DECIMAL(22,4)) AS VARCHAR) END AS box_office,
         CASE WHEN o.o_orderkey % 173 = 0 THEN 'NaN' ELSE li.genre END AS genre
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN lines li ON o.o_orderkey = li.l_orderkey
),
tok AS (
  SELECT o_orderkey, {_tok('title')} AS title, {_tok('release_year')} AS release_year,
         {_tok('director')} AS director, {_tok('language')} AS language, {_tok('country')} AS country,
         {_tok('duration')} AS duration, {_tok('budget')} AS budget, {_tok('box_office')} AS box_office,
         {_tok('genre')} AS genre
  FROM raw
),
num AS (
  SELECT o_orderkey, title, director, language, country,
         {_num('release_year')} AS release_year_d, {_num('duration')} AS duration_d,
         {_num('budget')} AS budget_d, {_num("nullif(box_office, 'unknown')")} AS box_office_d
  FROM tok
),
movies AS (
  SELECT o_orderkey,
         {_strip('title')} AS title,
         TRY_CAST(round(release_year_d) AS INTEGER) AS release_year,
         {_strip('director')} AS director,
         {_strip('language')} AS language,
         {_strip('country')} AS country,
         TRY_CAST(round(duration_d) AS INTEGER) AS duration,
         TRY_CAST(round(budget_d) AS BIGINT) AS budget,
         TRY_CAST(round(box_office_d) AS BIGINT) AS box_office,
         TRY_CAST({_np_round('CASE WHEN budget_d <> 0 THEN (box_office_d - budget_d) / budget_d * 100.0 END', 2)}
                  AS DECIMAL(10,2)) AS roi
  FROM num
),
tag_lists AS (
  SELECT o_orderkey, {_strip('title')} AS title,
         list_transform(string_split(genre, ','), lambda x: {_fix(_strip('x'))}) AS fixed
  FROM tok
),
movie_genres AS (
  SELECT o_orderkey, title,
         unnest(list_filter(fixed, lambda x, i: list_position(fixed, x) = i)) AS genre
  FROM tag_lists
),
stg_movies AS (
  SELECT *, {_case('budget', BUDGET_TIERS)} AS budget_category,
            {_case('roi', ROI_TIERS)} AS roi_category
  FROM movies WHERE box_office IS NOT NULL
),
genre_joined AS (
  SELECT g.genre,
         count(DISTINCT m.title) AS movie_count,
         sum(CAST(m.budget AS HUGEINT)) AS s_budget, count(m.budget) AS n_budget,
         sum(CAST(m.box_office AS HUGEINT)) AS s_box, count(m.box_office) AS n_box,
         sum(CAST(m.roi * 100 AS HUGEINT)) AS s_roi, count(m.roi) AS n_roi
  FROM movie_genres g LEFT JOIN stg_movies m ON g.title = m.title
  WHERE m.box_office IS NOT NULL
  GROUP BY g.genre
),
mart_genre AS (
  SELECT genre, movie_count,
         CAST({_half_up('s_budget', 'n_budget')} AS BIGINT) AS avg_budget,
         CAST({_half_up('s_box', 'n_box')} AS BIGINT) AS avg_box_office,
         CAST(CAST({_half_up('s_roi', 'n_roi')} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS avg_roi,
         CAST(s_box AS BIGINT) AS total_box_office,
         CAST(rank() OVER (ORDER BY s_box DESC) AS INTEGER) AS revenue_rank
  FROM genre_joined
),
country_grouped AS (
  SELECT country, count(title) AS movie_count,
         sum(CAST(budget AS HUGEINT)) AS s_budget, count(budget) AS n_budget,
         sum(CAST(box_office AS HUGEINT)) AS s_box, count(box_office) AS n_box,
         sum(CAST(roi * 100 AS HUGEINT)) AS s_roi, count(roi) AS n_roi
  FROM stg_movies WHERE box_office IS NOT NULL
  GROUP BY country
),
mart_country AS (
  SELECT country, movie_count,
         CAST({_half_up('s_budget', 'n_budget')} AS BIGINT) AS avg_budget,
         CAST({_half_up('s_box', 'n_box')} AS BIGINT) AS avg_box_office,
         CAST(CAST({_half_up('s_roi', 'n_roi')} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS avg_roi,
         CAST(s_box AS BIGINT) AS total_box_office,
         CAST(rank() OVER (ORDER BY s_box DESC) AS INTEGER) AS revenue_rank
  FROM country_grouped
),
genre_strings AS (
  SELECT title, string_agg(genre, ', ' ORDER BY genre) AS genres
  FROM movie_genres GROUP BY title
),
mart_top AS (
  SELECT m.o_orderkey, m.title, m.release_year, m.director, m.country, m.budget, m.box_office, m.roi,
         m.budget_category, m.roi_category, g.genres
  FROM stg_movies m LEFT JOIN genre_strings g ON m.title = g.title
)
"""


def _with(select: str) -> str:
    return f"WITH {CTE.strip()}\n{select.strip()}"


_MOVIE_COLS = "o_orderkey, title, release_year, director, language, country, duration, budget, box_office, roi"

_REASONS_T = [("title_null", "title IS NULL"), ("title_too_long", "length(title) > 300"),
              ("director_too_long", "length(director) > 200"), ("language_too_long", "length(language) > 100"),
              ("country_too_long", "length(country) > 100"),
              ("roi_out_of_range", "roi IS NULL AND roi_unbounded IS NOT NULL")]
_REASONS_G = [("title_null", "title IS NULL"), ("genre_null_or_empty", "genre IS NULL OR genre = ''"),
              ("title_too_long", "length(title) > 300"), ("genre_too_long", "length(genre) > 100")]


def _reasons() -> str:
    parts = []
    for reason, cond in _REASONS_T:
        parts.append(f"SELECT 'movies' AS table_name, '{reason}' AS reason, "
                     f"count(*) FILTER (WHERE coalesce({cond}, false)) AS rejected_rows FROM movies_audit")
    for reason, cond in _REASONS_G:
        parts.append(f"SELECT 'movie_genres' AS table_name, '{reason}' AS reason, "
                     f"count(*) FILTER (WHERE coalesce({cond}, false)) AS rejected_rows FROM movie_genres")
    audit = ("movies_audit AS (SELECT m.*, CASE WHEN n.budget_d <> 0 THEN "
             f"{_np_round('(n.box_office_d - n.budget_d) / n.budget_d * 100.0', 2)} END AS roi_unbounded "
             "FROM movies m JOIN num n ON m.o_orderkey = n.o_orderkey)")
    return f"WITH {CTE.strip()},\n{audit}\n" + "\nUNION ALL\n".join(parts)


ORACLE_SQL = {
    "raw_catalog": _with("SELECT * FROM raw"),
    "clean_titles": _with(f"SELECT {_MOVIE_COLS} FROM movies"),
    "normalized_tags": _with("SELECT o_orderkey, title, genre FROM movie_genres"),
    "staged_titles": _with(f"SELECT {_MOVIE_COLS}, budget_category, roi_category FROM stg_movies"),
    "genre_mart": _with("SELECT * FROM mart_genre"),
    "country_mart": _with("SELECT * FROM mart_country"),
    "top_titles_mart": _with("SELECT * FROM mart_top"),
    "top_titles_compact": _with("""
        SELECT m.* EXCLUDE (genres), t.genre_counts FROM mart_top m LEFT JOIN (
          SELECT title, string_agg(genre || ':' || n, ', ' ORDER BY genre) AS genre_counts
          FROM (SELECT title, genre, count(*) AS n FROM movie_genres WHERE genre IS NOT NULL GROUP BY title, genre)
          GROUP BY title) t ON m.title = t.title"""),
    "ordered_tag_string": _with("SELECT title, genres FROM genre_strings"),
    "tag_counts_top10": _with("""
        SELECT genre, count(*) AS film_count FROM movie_genres
        GROUP BY genre ORDER BY film_count DESC, genre ASC NULLS LAST LIMIT 10"""),
    "roi_top5_nulls_first": _with("""
        SELECT o_orderkey, title, release_year, budget, box_office, roi FROM movies
        ORDER BY roi DESC NULLS FIRST, o_orderkey ASC LIMIT 5"""),
    "roi_top5_nulls_last": _with("""
        SELECT o_orderkey, title, release_year, budget, box_office, roi FROM movies
        ORDER BY roi DESC NULLS LAST, o_orderkey ASC LIMIT 5"""),
    "genre_top5": _with("""
        SELECT genre, movie_count, avg_roi, total_box_office, revenue_rank FROM mart_genre
        ORDER BY revenue_rank ASC, genre ASC NULLS LAST LIMIT 5"""),
    "country_top5": _with("""
        SELECT country, movie_count, avg_roi, total_box_office, revenue_rank FROM mart_country
        ORDER BY revenue_rank ASC, country ASC NULLS LAST LIMIT 5"""),
    "row_counts": _with("""
        SELECT 'movies' AS table_name, count(*) AS row_count FROM movies
        UNION ALL SELECT 'movie_genres' AS table_name, count(*) AS row_count FROM movie_genres"""),
    "null_audit": _with("""
        SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE title IS NULL) AS null_title,
               count(*) FILTER (WHERE release_year IS NULL) AS null_release_year,
               count(*) FILTER (WHERE director IS NULL) AS null_director,
               count(*) FILTER (WHERE language IS NULL) AS null_language,
               count(*) FILTER (WHERE country IS NULL) AS null_country,
               count(*) FILTER (WHERE duration IS NULL) AS null_duration,
               count(*) FILTER (WHERE budget IS NULL) AS null_budget,
               count(*) FILTER (WHERE box_office IS NULL) AS null_box_office,
               count(*) FILTER (WHERE roi IS NULL) AS null_roi
        FROM movies"""),
    "transform_summary": _with("""
        SELECT 'movies_rows' AS metric, count(*) AS value FROM movies
        UNION ALL SELECT 'null_box_office', count(*) FILTER (WHERE box_office IS NULL) FROM movies
        UNION ALL SELECT 'null_budget', count(*) FILTER (WHERE budget IS NULL) FROM movies
        UNION ALL SELECT 'tag_rows', count(*) FROM movie_genres
        UNION ALL SELECT 'unique_tags', count(DISTINCT genre) FROM movie_genres"""),
    "distinct_tags": _with("SELECT DISTINCT genre FROM movie_genres ORDER BY genre"),
    "duplicate_titles": _with("""
        SELECT title, count(*) AS copies FROM movies WHERE title IS NOT NULL
        GROUP BY title HAVING count(*) > 1"""),
    "reject_reasons": _reasons(),
    "report_genre_revenue": _with(f"""
        SELECT genre, revenue_rank, {_np_round('total_box_office / 1e9', 2)} AS total_box_office_b, avg_roi
        FROM mart_genre ORDER BY revenue_rank ASC, genre ASC NULLS LAST LIMIT 10"""),
    "report_budget_vs_revenue": _with("""
        SELECT o_orderkey, title, director, release_year, country, budget, box_office, roi_category,
               abs(roi) AS roi_abs
        FROM mart_top WHERE box_office IS NOT NULL"""),
    "report_top_titles": _with(f"""
        SELECT o_orderkey, title, box_office, {_np_round('box_office / 1e9', 2)} AS box_office_b, budget_category
        FROM mart_top WHERE box_office IS NOT NULL
        ORDER BY box_office DESC NULLS LAST, o_orderkey ASC LIMIT 10"""),
    "report_countries": _with(f"""
        SELECT country, revenue_rank, movie_count, CAST(avg_roi AS DOUBLE) AS avg_roi,
               {_np_round('avg_box_office / 1e6', 1)} AS avg_box_office_m,
               {_np_round('CAST(avg_roi AS DOUBLE)', 1)} AS avg_roi_label
        FROM mart_country WHERE movie_count > 3
        ORDER BY revenue_rank ASC, country ASC NULLS LAST LIMIT 10"""),
    "report_roi_by_genre": _with("""
        SELECT genre, CAST(avg_roi AS DOUBLE) AS avg_roi FROM mart_genre ORDER BY avg_roi ASC"""),
    "global_rank_titles": _with("""
        SELECT o_orderkey, title, box_office,
               CAST(rank() OVER (ORDER BY box_office DESC NULLS LAST) AS BIGINT) AS box_office_rank
        FROM stg_movies"""),
}

# sources and sinks: what was written is read back
ORACLE_SQL["csv_round_trip"] = _with("SELECT * FROM tok")
ORACLE_SQL["refresh_movies"] = ORACLE_SQL["clean_titles"]
ORACLE_SQL["refresh_movie_genres"] = ORACLE_SQL["append_movie_genres"] = ORACLE_SQL["normalized_tags"]
ORACLE_SQL["view_stg_movies"] = ORACLE_SQL["staged_titles"]
ORACLE_SQL["mart_reads_sorted"] = _with("""
    SELECT title, release_year, director, country, budget, box_office, roi, budget_category, roi_category, genres
    FROM mart_top WHERE box_office IS NOT NULL ORDER BY box_office DESC, title, release_year""")

# scale variants: same answers as the plain operators
ORACLE_SQL["genre_mart_global_rank"] = ORACLE_SQL["genre_mart"]
ORACLE_SQL["top_titles_mart_salted"] = ORACLE_SQL["top_titles_mart"]
ORACLE_SQL["normalized_tags_dictionary_table"] = ORACLE_SQL["normalized_tags"]

# stored tables: the same answers from what was written
ORACLE_SQL["country_mart_global_rank"] = ORACLE_SQL["country_mart_read"] = ORACLE_SQL["country_mart_incremental"] = ORACLE_SQL["country_mart"]
ORACLE_SQL["genre_mart_stored"] = ORACLE_SQL["genre_mart_read"] = ORACLE_SQL["genre_mart_incremental"] = ORACLE_SQL["genre_mart"]
ORACLE_SQL["top_titles_mart_stored"] = ORACLE_SQL["top_titles_mart_incremental"] = ORACLE_SQL["top_titles_mart"]
ORACLE_SQL["hand_off_titles"] = ORACLE_SQL["refresh_changed"] = ORACLE_SQL["clean_titles"]
ORACLE_SQL["row_counts_stored"] = ORACLE_SQL["row_counts"]
ORACLE_SQL["staged_tags"] = _with("SELECT title, genre FROM movie_genres")
ORACLE_SQL["top_titles_top10_stored"] = _with("""
    SELECT o_orderkey, title, release_year, director, country, budget, box_office, roi, budget_category, roi_category, genres
    FROM mart_top ORDER BY box_office DESC, title, release_year, o_orderkey LIMIT 10""")

_NO_TITLE = "title IS NULL OR title NOT IN (SELECT title FROM stg_movies WHERE title IS NOT NULL)"
_NO_TAG = "title IS NULL OR title NOT IN (SELECT title FROM movie_genres WHERE title IS NOT NULL)"
ORACLE_SQL["unlinked_titles"] = _with(f"""
    SELECT 'tags_without_title' AS side, title, count(*) AS rows FROM movie_genres WHERE {_NO_TITLE} GROUP BY title
    UNION ALL SELECT 'titles_without_tag', title, count(*) FROM stg_movies WHERE {_NO_TAG} GROUP BY title""")
ORACLE_SQL["link_audit"] = _with(f"""
    SELECT 'tags_without_title' AS side, count(DISTINCT title) AS titles, count(*) AS rows FROM movie_genres WHERE {_NO_TITLE}
    UNION ALL SELECT 'titles_without_tag', count(DISTINCT title), count(*) FROM stg_movies WHERE {_NO_TAG}""")
ORACLE_SQL["unlinked_tag_rows"] = _with(f"SELECT o_orderkey, title, genre, 'title_not_found' AS reason FROM movie_genres WHERE {_NO_TITLE}")
ORACLE_SQL["title_sketches"] = _with("""
    SELECT grouping, value, count(*) AS n_rows, count(DISTINCT title) AS titles, true AS within_bound FROM (
      SELECT unnest([{'grouping': 'country', 'value': m.country}, {'grouping': 'release_year', 'value': m.release_year::VARCHAR},
                     {'grouping': 'genre', 'value': g.genre}, {'grouping': 'all', 'value': NULL}], recursive := true), g.title
      FROM movie_genres g JOIN movies m ON g.o_orderkey = m.o_orderkey) GROUP BY grouping, value""")


def _types() -> str:
    """Each column's values one by one, without class counts."""
    parts = []
    for c in ("title", "release_year", "director", "language", "country", "duration", "budget", "box_office", "genre"):
        number, whole = _num("v"), "regexp_matches(v, '^[ \\t-\\r]*[+-]?[0-9]+[ \\t-\\r]*$')"
        parts.append(f"""
    SELECT '{c}' AS "column", CASE WHEN n = 0 THEN 'void' WHEN n_number = n THEN number_type WHEN n_date = n THEN 'date' WHEN n_truth = n THEN 'boolean'
                                   ELSE 'string' END AS type, n_null, CASE WHEN 2 * n_number > n THEN n - n_number ELSE 0 END AS n_bad,
           CASE WHEN 2 * n_number > n THEN number_type WHEN n = 0 THEN 'void' WHEN n_date = n THEN 'date' WHEN n_truth = n THEN 'boolean'
                ELSE 'string' END AS clean_type
    FROM (SELECT count(v) AS n, count(*) - count(v) AS n_null, count({number}) AS n_number,
                 CASE WHEN count({number}) FILTER (WHERE NOT ({whole}) OR TRY_CAST(trim(v) AS BIGINT) IS NULL) > 0 THEN 'double'
                      WHEN count({number}) FILTER (WHERE TRY_CAST(trim(v) AS INTEGER) IS NULL) > 0 THEN 'bigint' ELSE 'int' END AS number_type,
                 count(*) FILTER (WHERE regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND TRY_CAST(v AS DATE) IS NOT NULL) AS n_date,
                 count(*) FILTER (WHERE v IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) AS n_truth
          FROM (SELECT {c} AS v FROM tok))""")
    return " UNION ALL ".join(parts)


ORACLE_SQL["inferred_types"] = _with(_types())
ORACLE_SQL["change_diff"] = _with(f"""
    , older AS (SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN coalesce(budget, 0) + 1 ELSE budget END AS budget) FROM movies WHERE o_orderkey % 7 <> 0),
    old AS (SELECT * FROM older UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM movies WHERE o_orderkey % 11 = 0
            UNION ALL SELECT * FROM older WHERE o_orderkey % 13 = 0),
    gone AS (SELECT o_orderkey, count(*) AS rows_gone FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM movies) GROUP BY 1),
    added AS (SELECT o_orderkey, count(*) AS rows_added FROM (SELECT * FROM movies EXCEPT ALL SELECT * FROM old) GROUP BY 1)
    SELECT o_orderkey, CASE WHEN rows_gone IS NULL THEN 'added' WHEN rows_added IS NULL THEN 'gone' ELSE 'changed' END AS status,
           coalesce(rows_gone, 0) AS rows_gone, coalesce(rows_added, 0) AS rows_added
    FROM gone FULL JOIN added USING (o_orderkey)""")
