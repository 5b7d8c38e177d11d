"""

Films and ratings are derived from ``part`` and ``lineitem`` (``starledger.sources.stand_ins``); every query runs over
all of their rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger import shared_folder
from starledger.operators import (
    distinct_values,
    drop_incomplete,
    drop_matching,
    drop_value,
    duplicate_report,
    keep_first,
    matching_report,
    null_drop_report,
    null_ratios,
    counts_of_sketches,
    merge_sketches,
    only_matching,
    relative_error,
    remove_duplicates,
    store_clean,
    unique_value_counts,
    unique_values,
    value_report,
    value_sketches,
)
from starledger.plans import exploration, gold, silver, insights, movies_silver, ratings_silver, store_gold
from starledger.sources import (
    GOLD_CLEAN_SCHEMA,
    GOLD_RAW_SCHEMA,
    MOVIES_FILE,
    RATINGS_FILE,
    corrupt_report,
    read_by_film,
    read_gold,
    read_movies,
    read_ratings,
    register_views,
    stand_ins,
    store_by_film,
    write_csv,
)

try:  # the operators for training data; everything else works without them
    from starledger.llm import queries as llm
except ImportError as absent:
    if absent.name not in ("starledger.llm", "corpus_pipeline"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMALLEST_TABLES = "/root/testdata/sf0.001"

# Literals that occur in the derived tables.
TITLE_PATTERN = "small ring%"
TITLE = "blue anvil (1954)"
GENRE, OF_GENRE = "ECONOMY", "PROMO"
YEAR, LATE_YEAR = 1975, 1990
QUANTILES = [0.1, 0.25, 0.5, 0.75, 0.9]
# Options under which nothing is broadcast and every film is split.
ALWAYS_SPLIT = {"broadcast_limit": 0, "rows_per_split": 4}
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def entry(spark: SparkSession) -> DataFrame:
    """Genres by their mean rating, adjusted for how many ratings they have."""
    return _genre_bayesian_avg(spark, SMALLEST_TABLES)


def _plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    return df.withColumn("rating_timestamp", F.col("rating_timestamp").cast("timestamp_ntz"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return stand_ins.table(spark, folder, "lineitem")


def _movies_silver(spark: SparkSession, folder: str) -> DataFrame:
    return movies_silver(stand_ins.movies(spark, folder))


def _ratings_silver(spark: SparkSession, folder: str) -> DataFrame:
    return ratings_silver(stand_ins.ratings(spark, folder))


def _leaky_silver(spark: SparkSession, folder: str) -> DataFrame:
    return movies_silver(stand_ins.leaky_movies(spark, folder))


def _gold(spark: SparkSession, folder: str, drop_nulls: bool = True) -> DataFrame:
    return gold(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder), drop_nulls)


def _film_totals(spark: SparkSession, folder: str, **options: bool) -> DataFrame:
    return insights.film_totals(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder), **options)


def _genre_totals(spark: SparkSession, folder: str, drop_nulls: bool = True) -> DataFrame:
    return insights.genre_totals_of_films(_film_totals(spark, folder, drop_nulls=drop_nulls))


def _year_totals(spark: SparkSession, folder: str, drop_nulls: bool = True, genre_weighted: bool = True) -> DataFrame:
    return insights.year_totals_of_films(_film_totals(spark, folder, drop_nulls=drop_nulls), genre_weighted)


def _genre_bayesian_avg(spark: SparkSession, folder: str) -> DataFrame:
    return insights.genre_bayesian_avg(_genre_totals(spark, folder))


def _csv_movies(spark: SparkSession, folder: str, source: Query) -> DataFrame:
    """Write the films as CSV to the shared folder, then scan that."""
    base = shared_folder(spark, "csv")
    write_csv(source(spark, folder), f"{base}/{MOVIES_FILE}")
    return read_movies(spark, base)


def _csv_ratings(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "csv")
    write_csv(stand_ins.ratings(spark, folder), f"{base}/{RATINGS_FILE}")
    return read_ratings(spark, base)


def _corrupt_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings of which some have an id too large for the schema, read with the column for such records."""
    base = shared_folder(spark, "csv")
    shifted = _lines(spark, folder).select(
        (F.col("l_orderkey") + 2147480000).alias("userId"), F.col("l_partkey").alias("movieId"), F.lit(1.5).alias("rating"), F.lit(7).alias("timestamp")
    )
    write_csv(shifted, f"{base}/{RATINGS_FILE}")
    return read_ratings(spark, base, corrupt_column="bad_record")


def _split_gold(spark: SparkSession, folder: str, drop_nulls: bool = True) -> DataFrame:
    """The plan for more films than can be broadcast, with every film's ratings in several splits."""
    return gold(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder), drop_nulls, **ALWAYS_SPLIT)


def _gold_overwritten(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table replaced by a smaller one, without the films of early years."""
    path = shared_folder(spark, "gold")
    films, rated = stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder)
    store_gold(films, rated, path)
    store_gold(films.filter(silver.release_year(F.col("title")) >= LATE_YEAR), rated, path)
    return read_gold(spark, path)


def _default_escape(spark: SparkSession, folder: str) -> DataFrame:
    """Titles with quote marks and a comma, read without the option that a file with doubled quotes needs."""
    base = shared_folder(spark, "csv")
    write_csv(stand_ins.quoted_movies(spark, folder), f"{base}/{MOVIES_FILE}")
    return read_movies(spark, base, doubled_quotes=False)


def _insights_of_stored_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Genres and years from one stored pass over the ratings."""
    path = shared_folder(spark, "film-totals")
    insights.store_film_totals(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder), path)
    return _genres_and_years(insights.read_film_totals(spark, path))


def _genres_and_years(films: DataFrame) -> DataFrame:
    genres = insights.genre_avg_rating(insights.genre_totals_of_films(films))
    years = insights.avg_rating_by_year(insights.year_totals_of_films(films))
    return genres.select(F.lit("genre").alias("kind"), F.col("genre").alias("name"), "avg_rating").unionByName(
        years.select(F.lit("year").alias("kind"), F.col("year").cast("string").alias("name"), "avg_rating")
    )


def _insights_of_merged_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The same from totals that were stored batch by batch, one of the batches twice."""
    path = shared_folder(spark, "merged-totals")
    lines = _lines(spark, folder)
    flags = sorted(r[0] for r in lines.select("l_returnflag").distinct().collect())  # three letters
    for flag in [*flags, flags[0]]:
        batch = lines.filter(F.col("l_returnflag") == flag)
        insights.add_rating_totals(stand_ins.ratings_from_lineitem(batch), path, flag)
    return _genres_and_years(insights.merged_film_totals(stand_ins.movies(spark, folder), path))


def _insights_of_bucketed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The same from films and ratings that are stored by film."""
    films, rated = (f"{name}_{uuid.uuid4().hex}" for name in ("films", "ratings"))
    store_by_film(stand_ins.movies(spark, folder), films)
    store_by_film(stand_ins.ratings(spark, folder), rated)
    return _genres_and_years(insights.film_totals(read_by_film(spark, films), read_by_film(spark, rated)))


def _approx_against_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values, counted exactly, and whether the estimate lies within its error; sketches are stored per batch."""
    path = shared_folder(spark, "sketches")
    ratings = _ratings_silver(spark, folder)
    for batch in (ratings.filter(F.col("rating") > 2.5), ratings.filter(~F.coalesce(F.col("rating") > 2.5, F.lit(False)))):
        value_sketches(batch, ["rating_timestamp"]).write.mode("append").parquet(path)
    found = counts_of_sketches(merge_sketches(spark.read.parquet(path))).withColumnRenamed("unique_values", "estimate")
    exact = unique_value_counts(ratings, ["rating_timestamp"])
    off = F.abs(F.col("estimate") - F.col("unique_values"))
    return exact.join(found, "column_name").select(
        "column_name", "unique_values", (off <= F.ceil(F.col("unique_values") * relative_error())).alias("within_error")
    )


def _quantiles_within_error(spark: SparkSession, folder: str) -> DataFrame:
    """Per genre and share the gold rows of the genre, and whether the quantile's rank lies within the error."""
    sketches = insights.rating_sketches(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder))
    found = insights.rating_quantiles(sketches, QUANTILES).withColumnRenamed("rating", "quantile")
    counted = insights.rating_histogram_of_films(_film_totals(spark, folder, by_rating=True))
    rows = counted.join(found, "genre").groupBy("genre", "share").agg(
        F.sum("num_rows").alias("num_rows"),
        F.sum(F.when(F.col("rating") < F.col("quantile"), F.col("num_rows")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("rating") <= F.col("quantile"), F.col("num_rows")).otherwise(0)).alias("up_to"),
    )
    low, high = F.col("below") / F.col("num_rows"), F.col("up_to") / F.col("num_rows")
    error = insights.quantile_error()
    within = (low <= F.col("share") + error) & (high >= F.col("share") - error)
    return rows.select("genre", "share", "num_rows", within.alias("within_error"))


def _clean_report_movies(spark: SparkSession, folder: str) -> DataFrame:
    rows = _leaky_silver(spark, folder)
    return store_clean(rows, shared_folder(spark, "clean"), "movies", ["movieId", "genre"], ["title", "year"], leaked="genre")


def _clean_report_ratings(spark: SparkSession, folder: str) -> DataFrame:
    rows, order = _ratings_silver(spark, folder), ["timestamp", "rating"]
    return store_clean(rows, shared_folder(spark, "clean"), "ratings", ["userId", "movieId"], order)


def _gold_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table replaced by a smaller one, the old one being there until the new one is complete."""
    path = shared_folder(spark, "gold")
    films, rated = stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder)
    store_gold(films, rated, path, safely=True)
    store_gold(films.filter(silver.release_year(F.col("title")) >= LATE_YEAR), rated, path, safely=True)
    return read_gold(spark, path)


def _stored_gold(spark: SparkSession, folder: str, drop_nulls: bool = True, **options: int) -> DataFrame:
    path = shared_folder(spark, "gold")
    store_gold(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder), path, drop_nulls, **options)
    return read_gold(spark, path, GOLD_CLEAN_SCHEMA if drop_nulls else GOLD_RAW_SCHEMA)


def _over_views(query: Callable[[SparkSession], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        register_views(stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder))
        return query(spark)

    return run


def queries() -> dict[str, Query]:
    """Every query by name, as a function of the session and the folder with the tables."""
    return _own_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    """For each query the SQL that gives the same rows over the same tables, where SQL can express it."""
    return _own_sql() | (llm.oracle_sql() if llm else {})


def _own_queries() -> dict[str, Query]:
    return {
        # scans and sinks
        "csv_scan_movies": lambda s, d: _csv_movies(s, d, stand_ins.movies),
        "csv_scan_quoted_movies": lambda s, d: _csv_movies(s, d, stand_ins.quoted_movies),
        "csv_scan_ratings": _csv_ratings,
        "csv_scan_default_escape": _default_escape,
        "csv_scan_leak_quarantine": lambda s, d: only_matching(movies_silver(_default_escape(s, d)), "genre"),
        "csv_scan_corrupt_report": lambda s, d: corrupt_report(_corrupt_ratings(s, d), "bad_record"),
        "gold_roundtrip": _stored_gold,
        "gold_split_roundtrip": lambda s, d: _stored_gold(s, d, **ALWAYS_SPLIT),
        "gold_year_slice": lambda s, d: _stored_gold(s, d).filter(F.col("year") == YEAR),
        "gold_overwritten": _gold_overwritten,
        "gold_replaced_safely": _gold_replaced,
        "gold_raw_roundtrip": lambda s, d: _plain_time(_stored_gold(s, d, drop_nulls=False)),
        # SQL exploration
        "sql_first_movies": _over_views(exploration.first_movies),
        "sql_title_prefix": _over_views(lambda s: exploration.movies_like(s, TITLE_PATTERN)),
        "sql_high_ratings": _over_views(lambda s: exploration.ratings_above(s, 4.5)),
        "sql_high_ratings_top10": _over_views(lambda s: exploration.ratings_above(s, 4.5, 10)),
        "sql_total_ratings": _over_views(exploration.total_ratings),
        "total_ratings": lambda s, d: stand_ins.ratings(s, d).agg(F.count("*").alias("total_ratings")),
        "sql_top_rated_movies": _over_views(exploration.most_rated),
        "sql_title_ratings": _over_views(lambda s: exploration.ratings_of_title(s, TITLE)),
        "sql_title_ratings_shuffled": _over_views(lambda s: exploration.ratings_of_title(s, TITLE, **ALWAYS_SPLIT)),
        # silver tables
        "movies_silver": _movies_silver,
        "ratings_silver": lambda s, d: _plain_time(_ratings_silver(s, d)),
        # duplicates
        "duplicate_report": lambda s, d: duplicate_report(_lines(s, d), LINE_KEYS, "lineitem"),
        "dedup_keys": lambda s, d: remove_duplicates(_lines(s, d), LINE_KEYS).select(LINE_KEYS),
        "dedup_payload": lambda s, d: remove_duplicates(
            _lines(s, d).select(*LINE_KEYS, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payload")), LINE_KEYS
        ),
        "dedup_first": lambda s, d: keep_first(
            _lines(s, d).select(*LINE_KEYS, *LINE_ORDER), LINE_KEYS, LINE_ORDER
        ).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")),
        # distinct values
        "distinct_genre_lists": lambda s, d: distinct_values(stand_ins.movies(s, d), "genres"),
        "unique_values_profile": lambda s, d: unique_values(_movies_silver(s, d), 100, ["movieId", "title"]),
        "unique_value_counts": lambda s, d: unique_value_counts(_movies_silver(s, d)),
        "unique_values_profile_ratings": lambda s, d: unique_values(
            _ratings_silver(s, d), ignore=["userId", "movieId", "timestamp", "rating_timestamp"]
        ),
        "unique_values_profile_all": lambda s, d: unique_values(_movies_silver(s, d), None),
        "unique_value_counts_approx": _approx_against_exact,
        "unique_value_counts_ratings": lambda s, d: unique_value_counts(_ratings_silver(s, d), ["rating_timestamp"]),
        # misfiled genres
        "genre_leak_quarantine": lambda s, d: only_matching(_leaky_silver(s, d), "genre"),
        "genre_leak_clean": lambda s, d: drop_matching(_leaky_silver(s, d), "genre"),
        "genre_leak_report": lambda s, d: matching_report(_leaky_silver(s, d), "genre"),
        "drop_value": lambda s, d: drop_value(_leaky_silver(s, d), "genre", stand_ins.LEAKED_GENRE),
        "drop_value_report": lambda s, d: value_report(_leaky_silver(s, d), "genre", stand_ins.LEAKED_GENRE),
        # missing values
        "null_ratio_movies": lambda s, d: null_ratios(_movies_silver(s, d)),
        "null_ratio_ratings": lambda s, d: null_ratios(_ratings_silver(s, d)),
        "movies_clean": lambda s, d: drop_incomplete(_movies_silver(s, d)),
        "ratings_clean": lambda s, d: _plain_time(drop_incomplete(_ratings_silver(s, d))),
        "null_drop_report": lambda s, d: null_drop_report(_movies_silver(s, d), "movies"),
        "null_drop_report_ratings": lambda s, d: null_drop_report(_ratings_silver(s, d), "ratings"),
        # reports counted while a table is written
        "clean_report_movies": _clean_report_movies,
        "clean_report_ratings": _clean_report_ratings,
        # gold
        "gold_clean": _gold,
        "gold_clean_split": _split_gold,
        "gold_raw_split": lambda s, d: _plain_time(_split_gold(s, d, drop_nulls=False)),
        "gold_preview": lambda s, d: exploration.first_rows(_gold(s, d), 5, *GOLD_CLEAN_SCHEMA.fieldNames()),
        "gold_raw": lambda s, d: _plain_time(_gold(s, d, drop_nulls=False)),
        # insights
        "genre_popularity": lambda s, d: insights.genre_popularity(_genre_totals(s, d)),
        "genre_popularity_raw": lambda s, d: insights.genre_popularity(_genre_totals(s, d, drop_nulls=False)),
        "genre_popularity_of_gold": lambda s, d: insights.genre_popularity(insights.genre_totals(_gold(s, d))),
        "genre_share_pct": lambda s, d: insights.genre_share_pct(_genre_totals(s, d), GENRE, OF_GENRE),
        "genre_avg_rating": lambda s, d: insights.genre_avg_rating(_genre_totals(s, d)),
        "genre_bayesian_avg": _genre_bayesian_avg,
        "ratings_long": lambda s, d: insights.ratings_long(_gold(s, d)),
        "rating_histogram": lambda s, d: insights.rating_histogram_of_films(_film_totals(s, d, by_rating=True)),
        "insights_of_stored_totals": _insights_of_stored_totals,
        "insights_of_merged_totals": _insights_of_merged_totals,
        "insights_of_bucketed_tables": _insights_of_bucketed_tables,
        "rating_quantiles": _quantiles_within_error,
        "avg_rating_by_year": lambda s, d: insights.avg_rating_by_year(_year_totals(s, d)),
        "avg_rating_by_year_raw": lambda s, d: insights.avg_rating_by_year(_year_totals(s, d, drop_nulls=False)),
        "avg_rating_by_year_of_gold": lambda s, d: insights.avg_rating_by_year(insights.year_totals(_gold(s, d))),
        "avg_rating_by_year_unweighted": lambda s, d: insights.avg_rating_by_year(
            _year_totals(s, d, genre_weighted=False)
        ),
    }


# --- the same in SQL ---

_YEAR_TEXT = "cast(1950 + p_partkey % 60 as varchar)"
_TITLE = f"case when p_partkey % 37 = 0 then p_name else concat(p_name, ' (', {_YEAR_TEXT}, ')') end"
_GENRES = """case when p_partkey % 41 = 0 then '(no genres listed)'
         when p_size % 3 = 0 then p_type
         when p_size % 3 = 1 then concat(p_type, '|', substring(p_name, 1, 3))
         else concat(p_type, '|', replace(p_name, ' ', '|')) end"""

_LEAKY_GENRES = f"""case when p_partkey % 53 = 0 then ' Friend"" (2014)"'
         when p_partkey % 29 = 0 then concat(' ', p_name, '"" (', {_YEAR_TEXT}, ')"')
         else {_GENRES} end"""


def _movies_cte(genres: str = _GENRES) -> str:
    return f"""WITH movies AS (
    SELECT cast(p_partkey as int) AS "movieId", {_TITLE} AS title, {genres} AS genres FROM part
), ms AS (
    SELECT "movieId", title, try_cast(regexp_extract(title, '\\((\\d{{4}})\\)', 1) as int) AS year,
           nullif(unnest(string_split(genres, '|')), '(no genres listed)') AS genre
    FROM movies
), mc AS (
    SELECT * FROM ms
    WHERE "movieId" IS NOT NULL AND title IS NOT NULL AND year IS NOT NULL AND genre IS NOT NULL
)"""


_MOVIES = _movies_cte()
_LEAKY = _movies_cte(_LEAKY_GENRES)
_TABLES = f"""{_MOVIES}, ratings AS (
    SELECT cast(l_orderkey as int) AS "userId", cast(l_partkey as int) AS "movieId",
           cast(round(l_discount * 100) / 2 as float) AS rating, cast(epoch(l_shipdate) as int) AS "timestamp"
    FROM lineitem
), rs AS (
    SELECT "userId", "movieId", CASE WHEN rating <= 0 THEN NULL ELSE rating END AS rating,
           cast("timestamp" as bigint) AS "timestamp",
           make_timestamp("timestamp"::bigint * 1000000) AS rating_timestamp
    FROM ratings
), rc AS (
    SELECT * FROM rs
    WHERE "userId" IS NOT NULL AND "movieId" IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL
), gold_raw AS (
    SELECT rs."movieId", rs."userId", rs.rating, rs.rating_timestamp, ms.title, ms.year, ms.genre
    FROM rs JOIN ms ON rs."movieId" = ms."movieId"
), gold AS (
    SELECT rc."movieId", rc."userId", rc.rating, rc."timestamp", mc.title, mc.year, mc.genre
    FROM rc JOIN mc ON rc."movieId" = mc."movieId"
)"""


def _first_values(tables: str, source: str, columns: list[str], limit: int | None) -> str:
    """Distinct values per column as text, the first ``limit`` in text order with NULL first."""
    rank = "row_number() OVER (PARTITION BY column_name ORDER BY value NULLS FIRST)"
    pairs = " UNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS column_name, cast("{c}" as varchar) AS value FROM {source}""" for c in columns
    )
    bound = "" if limit is None else f" QUALIFY {rank} <= {limit}"
    return f"{tables} SELECT column_name, value FROM ({pairs}){bound}"


def _value_counts(tables: str, source: str, columns: list[str]) -> str:
    return (
        f"{tables} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS unique_values FROM (SELECT DISTINCT "{c}" FROM {source})"""
            for c in columns
        )
    )


def _null_shares(tables: str, source: str, columns: list[str]) -> str:
    shares = ", ".join(f"""count(*) FILTER ("{c}" IS NULL) / count(*) AS "{c}" """ for c in columns)
    return f"{tables} SELECT {shares} FROM {source}"


def _null_drop(tables: str, source: str, kept: str, name: str) -> str:
    return f"""{tables} SELECT '{name}' AS table_name, a.n AS rows_before, a.n - b.n AS rows_dropped, b.n AS rows_after
        FROM (SELECT count(*) AS n FROM {source}) a, (SELECT count(*) AS n FROM {kept}) b"""


def _removal_report(hit: str) -> str:
    return f"""{_LEAKY} SELECT count(*) AS total_rows, count(*) FILTER ({hit}) AS removed_rows,
        count(*) FILTER (NOT ({hit})) AS kept_rows, count(*) FILTER (genre IS NULL) AS null_rows FROM ms"""


def _clean_report(tables: str, source: str, name: str, columns: list[str], leaked: str, keys: str) -> str:
    present = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
    shares = " UNION ALL ".join(
        f"""SELECT 'null_share', '{c}', count(*) FILTER ("{c}" IS NULL) / count(*) FROM {source}""" for c in columns
    )
    return f"""{tables}, sound AS (SELECT * FROM {source} WHERE NOT coalesce({leaked}, false)),
        complete AS (SELECT * FROM sound WHERE {present}), c AS (
            SELECT (SELECT count(*) FROM {source}) AS a, (SELECT count(*) FROM sound) AS s,
                   (SELECT count(*) FROM complete) AS f, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM complete)) AS k),
        m(measure, column_name, value) AS (
            SELECT 'rows_read', cast(NULL as varchar), cast(a as double) FROM c
            UNION ALL SELECT 'leaked_rows', NULL, a - s FROM c UNION ALL SELECT 'incomplete_rows', NULL, s - f FROM c
            UNION ALL SELECT 'duplicate_rows', NULL, f - k FROM c UNION ALL SELECT 'rows_written', NULL, k FROM c
            UNION ALL {shares})
        SELECT '{name}' AS table_name, measure, column_name, value FROM m"""


_GENRES_AND_YEARS = """SELECT 'genre' AS kind, genre AS name, avg(rating) AS avg_rating
            FROM gold GROUP BY genre UNION ALL SELECT 'year', cast(year as varchar), avg(rating)
            FROM gold WHERE year IS NOT NULL GROUP BY year"""

# What is left of a title with quote marks and a comma when it breaks apart, and what becomes of the genres.
_BROKEN_TITLES = f"""SELECT cast(p_partkey as int) AS "movieId", concat('\"\"\"', split_part(p_name, ' ', 1), '\"\"') AS title,
    concat(' ', split_part(p_name, ' ', 2), ' (', {_YEAR_TEXT}, ')\"') AS genres FROM part"""
_LEAKED = "regexp_matches(genre, '.*\\(\\d{4}\\).*\"')"
_SAME_VALUE = "genre = ' Friend\"\" (2014)\"'"
_SILVER_MOVIE_COLUMNS = ["movieId", "title", "year", "genre"]
_SILVER_RATING_COLUMNS = ["userId", "movieId", "rating", "timestamp", "rating_timestamp"]
_GOLD_COLUMNS = ['"movieId"', '"userId"', "rating", '"timestamp"', "title", "year", "genre"]
_POPULARITY = "SELECT genre, count(rating) AS num_ratings FROM {gold} GROUP BY genre ORDER BY num_ratings DESC, genre"
_BY_YEAR = "SELECT year, avg(rating) AS avg_rating FROM {gold} WHERE year IS NOT NULL GROUP BY year ORDER BY year"
_HIGH = """SELECT "userId", "movieId", rating FROM ratings WHERE rating > 4.5
    ORDER BY rating DESC, "userId", "movieId" """


def _own_sql() -> dict[str, str]:
    return {
        "csv_scan_movies": f"{_MOVIES} SELECT * FROM movies",
        "csv_scan_quoted_movies": f"""SELECT cast(p_partkey as int) AS "movieId",
            concat('"', replace(p_name, ' ', '", '), ' (', {_YEAR_TEXT}, ')') AS title, {_GENRES} AS genres FROM part""",
        "csv_scan_ratings": f"{_TABLES} SELECT * FROM ratings",
        "csv_scan_default_escape": _BROKEN_TITLES,
        "csv_scan_leak_quarantine": f"""WITH broken AS ({_BROKEN_TITLES})
            SELECT "movieId", title, cast(NULL as int) AS year, genres AS genre FROM broken
            WHERE regexp_matches(genres, '.*\\(\\d{{4}}\\).*"')""",
        "csv_scan_corrupt_report": """SELECT count(*) AS total_records,
            count(*) FILTER (l_orderkey + 2147480000 > 2147483647) AS corrupt_records FROM lineitem""",
        "gold_split_roundtrip": f"{_TABLES} SELECT * FROM gold",
        "gold_year_slice": f"{_TABLES} SELECT * FROM gold WHERE year = {YEAR}",
        "gold_overwritten": f"{_TABLES} SELECT * FROM gold WHERE year >= {LATE_YEAR}",
        "gold_replaced_safely": f"{_TABLES} SELECT * FROM gold WHERE year >= {LATE_YEAR}",
        "gold_roundtrip": f"{_TABLES} SELECT * FROM gold",
        "gold_raw_roundtrip": f"{_TABLES} SELECT * FROM gold_raw",
        "sql_first_movies": f'{_MOVIES} SELECT title, genres FROM movies ORDER BY "movieId", title, genres LIMIT 10',
        "sql_title_prefix": f"{_MOVIES} SELECT * FROM movies WHERE title LIKE '{TITLE_PATTERN}'",
        "sql_high_ratings": f"{_TABLES} {_HIGH}",
        "sql_high_ratings_top10": f"{_TABLES} {_HIGH} LIMIT 10",
        "sql_total_ratings": f"{_TABLES} SELECT count(*) AS total_ratings FROM ratings",
        "total_ratings": "SELECT count(*) AS total_ratings FROM lineitem",
        "sql_top_rated_movies": f"""{_TABLES} SELECT "movieId", count(*) AS num_ratings FROM ratings
            GROUP BY "movieId" ORDER BY num_ratings DESC, "movieId" LIMIT 5""",
        "sql_title_ratings": f"""{_TABLES} SELECT m.title, r."userId", r.rating
            FROM movies m JOIN ratings r ON m."movieId" = r."movieId" WHERE m.title = '{TITLE}'""",
        "sql_title_ratings_shuffled": f"""{_TABLES} SELECT m.title, r."userId", r.rating
            FROM movies m JOIN ratings r ON m."movieId" = r."movieId" WHERE m.title = '{TITLE}'""",
        "movies_silver": f"{_MOVIES} SELECT * FROM ms",
        "ratings_silver": f"{_TABLES} SELECT * FROM rs",
        "duplicate_report": """SELECT 'lineitem' AS table_name, a.n AS total_rows, b.n AS unique_rows,
            a.n - b.n AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem) a,
            (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) b""",
        "dedup_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
        "dedup_payload": """SELECT DISTINCT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS payload
            FROM lineitem""",
        "dedup_first": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice
            FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
        "distinct_genre_lists": f"{_MOVIES} SELECT DISTINCT genres FROM movies",
        "unique_values_profile": _first_values(_MOVIES, "ms", ["year", "genre"], 100),
        "unique_value_counts": _value_counts(_MOVIES, "ms", _SILVER_MOVIE_COLUMNS),
        "unique_values_profile_ratings": _first_values(_TABLES, "rs", ["rating"], 20),
        "unique_values_profile_all": _first_values(_MOVIES, "ms", _SILVER_MOVIE_COLUMNS, None),
        "unique_value_counts_ratings": _value_counts(_TABLES, "rs", _SILVER_RATING_COLUMNS[:-1]),
        "unique_value_counts_approx": f"""SELECT column_name, unique_values, true AS within_error
            FROM ({_value_counts(_TABLES, "rs", _SILVER_RATING_COLUMNS[:-1])})""",
        "clean_report_movies": _clean_report(_LEAKY, "ms", "movies", _SILVER_MOVIE_COLUMNS, _LEAKED, '"movieId", genre'),
        "clean_report_ratings": _clean_report(
            _TABLES, "rs", "ratings", _SILVER_RATING_COLUMNS, "false", '"userId", "movieId"'
        ),
        "genre_leak_quarantine": f"{_LEAKY} SELECT * FROM ms WHERE {_LEAKED}",
        "genre_leak_clean": f"{_LEAKY} SELECT * FROM ms WHERE NOT {_LEAKED}",
        "genre_leak_report": _removal_report(_LEAKED),
        "drop_value": f"{_LEAKY} SELECT * FROM ms WHERE NOT {_SAME_VALUE}",
        "drop_value_report": _removal_report(_SAME_VALUE),
        "null_ratio_movies": _null_shares(_MOVIES, "ms", _SILVER_MOVIE_COLUMNS),
        "null_ratio_ratings": _null_shares(_TABLES, "rs", _SILVER_RATING_COLUMNS),
        "movies_clean": f"{_MOVIES} SELECT * FROM mc",
        "ratings_clean": f"{_TABLES} SELECT * FROM rc",
        "null_drop_report": _null_drop(_MOVIES, "ms", "mc", "movies"),
        "null_drop_report_ratings": _null_drop(_TABLES, "rs", "rc", "ratings"),
        "gold_clean": f"{_TABLES} SELECT * FROM gold",
        "gold_clean_split": f"{_TABLES} SELECT * FROM gold",
        "gold_raw_split": f"{_TABLES} SELECT * FROM gold_raw",
        "gold_preview": f'{_TABLES} SELECT * FROM gold ORDER BY {", ".join(_GOLD_COLUMNS)} LIMIT 5',
        "gold_raw": f"{_TABLES} SELECT * FROM gold_raw",
        "genre_popularity": f"{_TABLES} {_POPULARITY.format(gold='gold')}",
        "genre_popularity_raw": f"{_TABLES} {_POPULARITY.format(gold='gold_raw')}",
        "genre_popularity_of_gold": f"{_TABLES} {_POPULARITY.format(gold='gold')}",
        "genre_share_pct": f"""{_TABLES} SELECT count(*) FILTER (genre = '{GENRE}')
            / nullif(count(*) FILTER (genre = '{OF_GENRE}'), 0) * 100 AS share_pct FROM gold""",
        "genre_avg_rating": f"""{_TABLES} SELECT genre, avg(rating) AS avg_rating FROM gold
            GROUP BY genre ORDER BY avg_rating DESC, genre""",
        "genre_bayesian_avg": f"""{_TABLES}, g AS (
                SELECT genre, count(rating) AS v, avg(rating) AS "R" FROM gold GROUP BY genre
            ), c AS (SELECT avg(rating) AS "C" FROM gold)
            SELECT genre, v, "R", "C", (v / (v + 1000)) * "R" + (1000 / (v + 1000)) * "C" AS adjusted_rating
            FROM g, c ORDER BY adjusted_rating DESC, genre""",
        "insights_of_stored_totals": f"{_TABLES} {_GENRES_AND_YEARS}",
        "insights_of_merged_totals": f"{_TABLES} {_GENRES_AND_YEARS}",
        "insights_of_bucketed_tables": f"{_TABLES} {_GENRES_AND_YEARS}",
        "rating_quantiles": f"""{_TABLES} SELECT genre, share, count(*) AS num_rows, true AS within_error
            FROM gold, (SELECT unnest({QUANTILES}::double[]) AS share) GROUP BY genre, share""",
        "ratings_long": f"{_TABLES} SELECT genre, rating FROM gold",
        "rating_histogram": f"{_TABLES} SELECT genre, rating, count(*) AS num_rows FROM gold GROUP BY genre, rating",
        "avg_rating_by_year": f"{_TABLES} {_BY_YEAR.format(gold='gold')}",
        "avg_rating_by_year_raw": f"{_TABLES} {_BY_YEAR.format(gold='gold_raw')}",
        "avg_rating_by_year_of_gold": f"{_TABLES} {_BY_YEAR.format(gold='gold')}",
        "avg_rating_by_year_unweighted": f"""{_TABLES} SELECT year, avg(rating) AS avg_rating
            FROM rc JOIN (SELECT DISTINCT "movieId", year FROM mc) m ON rc."movieId" = m."movieId"
            GROUP BY year ORDER BY year""",
    }
