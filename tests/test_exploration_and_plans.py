"""The SQL queries, and what the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from starledger import shared_folder
from starledger.operators import keep_first, unique_value_counts, unique_values
from starledger.plans import exploration, gold, insights, movies_silver, store_gold
from starledger.plans.silver import complete_ratings
from starledger.sources import (
    MOVIES_SCHEMA,
    RATINGS_SCHEMA,
    read_gold,
    read_movies,
    read_ratings,
    register_views,
    stand_ins,
    write_csv,
)

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df) -> str:
    """The formatted plan: the tree, an empty line, then one paragraph per node."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The derived tables as CSV and as Parquet, so that scans have something to push filters into."""
    base = str(tmp_path_factory.mktemp("tables"))
    write_csv(stand_ins.movies(spark, FOLDER), f"{base}/movies.csv")
    write_csv(stand_ins.ratings(spark, FOLDER), f"{base}/ratings.csv")
    read_movies(spark, base).write.parquet(f"{base}/movies.parquet")
    read_ratings(spark, base).write.parquet(f"{base}/ratings.parquet")
    return base


@pytest.fixture(scope="module")
def parquet(spark, tables):
    return spark.read.parquet(f"{tables}/movies.parquet"), spark.read.parquet(f"{tables}/ratings.parquet")


@pytest.fixture
def views(spark):
    movies = [(2, "B (1999)", "X"), (1, "A (1999)", "X|Y"), (3, "A (1999)", "Z"), (4, "A_(1", "Z")]
    ratings = [(1, 1, 5.0, 0), (2, 1, 4.5, 0), (3, 2, 5.0, 0), (1, 3, 4.75, 0), (9, 9, 1.0, 0), (1, 2, None, 0)]
    register_views(spark.createDataFrame(movies, MOVIES_SCHEMA), spark.createDataFrame(ratings, RATINGS_SCHEMA))


def test_sql_queries(spark, views):
    assert rows(exploration.first_movies(spark, 2)) == [("A (1999)", "X|Y"), ("B (1999)", "X")]
    assert sorted(r.movieId for r in exploration.movies_like(spark, "A %").collect()) == [1, 3]
    assert exploration.movies_like(spark, "A%").columns == ["movieId", "title", "genres"]
    assert rows(exploration.ratings_above(spark, 4.5)) == [(1, 1, 5.0), (3, 2, 5.0), (1, 3, 4.75)]
    assert rows(exploration.ratings_above(spark, 4.5, 1)) == [(1, 1, 5.0)]
    assert rows(exploration.total_ratings(spark)) == [(6,)]
    assert rows(exploration.most_rated(spark, 2)) == [(1, 2), (2, 2)]
    expected = [("A (1999)", 1, 4.75), ("A (1999)", 1, 5.0), ("A (1999)", 2, 4.5)]
    for limit in (1 << 20, -1):
        assert sorted(rows(exploration.ratings_of_title(spark, "A (1999)", limit))) == expected


def test_sql_values_are_bound(spark, views):
    assert rows(exploration.ratings_of_title(spark, "x' OR '1' = '1")) == []


def test_own_sql_over_the_views(spark, views):
    assert spark.sql("SELECT count(*) FROM movies_view m JOIN ratings_view r USING (movieId)").first()[0] == 5


def test_scans_get_filters_and_only_needed_columns(spark, tables, parquet):
    register_views(read_movies(spark, tables), read_ratings(spark, tables))
    like = plan(exploration.movies_like(spark, "small ring%"))
    assert "StringStartsWith(title,small ring)" in like
    high = plan(exploration.ratings_above(spark, 4.5, 10))
    assert "GreaterThan(rating,4.5)" in high and "TakeOrderedAndProject" in high
    assert "ReadSchema: struct<userId:int,movieId:int,rating:float>" in high
    assert "ReadSchema: struct<movieId:int>" in plan(exploration.most_rated(spark))
    assert "TakeOrderedAndProject" in plan(exploration.most_rated(spark))
    clean = plan(complete_ratings(parquet[1]).select("movieId", "rating"))
    assert "GreaterThan(rating,0.0)" in clean and "IsNotNull(timestamp)" in clean
    raw = plan(insights.genre_totals_of_films(insights.film_totals(*parquet, drop_nulls=False)))
    assert "ReadSchema: struct<movieId:int,rating:float>" in raw


def test_title_join_does_not_shuffle_ratings(spark, parquet):
    register_views(*parquet)
    text = plan(exploration.ratings_of_title(spark, "blue anvil (1954)"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_gold_shuffles_films_only(spark, parquet):
    text = plan(gold(*parquet))
    assert "BroadcastHashJoin" in text
    assert text.count("hashpartitioning") == 1, "one shuffle, of the films by id"


def test_gold_of_many_films_shuffles_ratings_without_titles(spark, parquet):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold(*parquet, broadcast_limit=0, rows_per_split=100, gather_years=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [p for p in text.split("\n\n") if "Arguments: hashpartitioning(" in p]
    to_place = [p for p in shuffles if "hashpartitioning(__place" in p]
    assert sorted("genre_list" in p for p in to_place) == [False, True], "ratings and films, once each"
    with_ratings = [p for p in shuffles if "rating#" in p]
    assert len(with_ratings) == 2 and not any("title#" in p or "genre_list#" in p for p in with_ratings)


def test_film_totals_join_without_another_shuffle(spark, parquet):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(insights.genre_totals_of_films(insights.film_totals(*parquet)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("hashpartitioning(movieId") == 2, "ratings and films once each"
    assert text.count("hashpartitioning(") == 3, "and the totals by genre"
    assert "partial_sum(rating" in text.replace("cast(", "").replace(" as double)", "")


def test_first_of_key_is_limited_before_the_shuffle(spark, parquet):
    text = plan(keep_first(parquet[1], ["movieId"], ["userId", "timestamp"]))
    assert re.search(r"WindowGroupLimit.*\n(.*\n)*?.*Exchange(.*\n)*?.*Scan", text.split("\n\n")[0])
    assert text.split("\n\n")[0].count("WindowGroupLimit") == 2


@pytest.mark.parametrize("limit", [20, None])
def test_profile_scans_once_whatever_the_format(spark, parquet, tmp_path, limit):
    write_csv(stand_ins.ratings(spark, FOLDER), f"{tmp_path}/ratings.csv")
    for ratings in (parquet[1], read_ratings(spark, str(tmp_path))):
        for df in (unique_values(ratings, limit), unique_value_counts(ratings)):
            text = plan(df)
            assert len(re.findall(r"ReadSchema: struct<(.*)>", text)) == 1
            assert "Expand" in text
    if limit:
        assert plan(unique_values(parquet[1], limit)).split("\n\n")[0].count("WindowGroupLimit") == 2


def test_profile_per_column_reads_one_column_per_branch(spark, parquet):
    text = plan(unique_values(parquet[1], 20, per_column=True))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert sorted(schemas) == ["movieId:int", "rating:float", "timestamp:int", "userId:int"]
    assert text.split("\n\n")[0].count("TakeOrderedAndProject") == 4
    for limit in (3, None):
        one, each = (unique_values(parquet[1], limit, per_column=p).collect() for p in (False, True))
        assert sorted(map(tuple, one), key=str) == sorted(map(tuple, each), key=str)


def test_stored_totals_serve_every_insight_from_one_scan_of_ratings(spark, parquet, tmp_path):
    path = str(tmp_path / "totals")
    insights.store_film_totals(*parquet, path)
    films = insights.read_film_totals(spark, path)
    for df in (insights.genre_totals_of_films(films), insights.year_totals_of_films(films)):
        text = plan(df)
        assert "userId" not in text and text.count("Location:") == 1


def test_year_filter_reads_only_its_folder(spark, parquet, tmp_path):
    path = str(tmp_path / "gold")
    store_gold(*parquet, path)
    slice_of_year = read_gold(spark, path).filter(F.col("year") == 1995)
    assert "PartitionFilters: [isnotnull(year" in plan(slice_of_year)
    assert slice_of_year.count() == gold(*parquet).filter(F.col("year") == 1995).count() > 0


def test_no_python_and_no_cross_join_in_any_query(spark):
    for name, query in spark_entry._own_queries().items():
        text = plan(query(spark, FOLDER))
        for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "LocalTableScan"):
            assert unwanted not in text, name


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["genre", "v", "R", "C", "adjusted_rating"]
    assert df.count() > 0


def test_shared_folder_is_new_and_below_the_named_one(spark):
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two
    assert spark.conf.get("spark.checkpoint.dir") in one
