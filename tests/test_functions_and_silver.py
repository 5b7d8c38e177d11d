"""Column functions and silver tables, on the cases that are easy to get wrong."""

import math

import pytest
from pyspark.sql import functions as F

import brute
from starledger.functions import epoch_to_timestamp, genre_list, is_present, percent, ratio, release_year, valid_rating
from starledger.operators import LEAKED_TITLE, drop_incomplete, drop_matching, only_matching
from starledger.plans import films, movies_silver, ratings_silver
from starledger.sources import MOVIES_SCHEMA, RATINGS_SCHEMA, read_csv, read_movies, read_ratings, write_csv

EDGE_CSV = '''movieId,title,genres
1,Toy Story (1995),Adventure|Animation|Children
2,"American President, The (1995)",Comedy|Drama
3,"Say ""Hello, Friend"" (2014)",Horror
4,No Genre (2001),(no genres listed)
5,No Year,Drama
6,"(1984) Two Years (2001)",Drama
7,EmptyGenre (2000),
8,"Range (2006–2007)",Drama
x,Bad Id (1999),Drama
9,ShortRow (1999)
10,Extra (1999),Drama,zzz
11,"""11'09""01 - September 11"" (2002)",Drama
'''


@pytest.fixture(scope="module")
def edge_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("edge")
    (folder / "movies.csv").write_text(EDGE_CSV, encoding="utf-8")
    (folder / "ratings.csv").write_text(
        "userId,movieId,rating,timestamp\n1,1,4.5,1636263000\n1,2,0.0,1636266600\n2,1,,5\n2,2,NaN,6\n3,1,-1.0,\n"
    )
    return str(folder)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_csv_reads_doubled_quotes(spark, edge_folder):
    titles = {r.movieId: r.title for r in read_movies(spark, edge_folder + "/").collect()}
    assert titles[2] == "American President, The (1995)"
    assert titles[3] == 'Say "Hello, Friend" (2014)'
    assert titles[11] == "\"11'09\"01 - September 11\" (2002)"
    assert titles[None] == "Bad Id (1999)"
    assert read_movies(spark, edge_folder).schema == MOVIES_SCHEMA


def test_default_escape_leaks_a_title_and_the_filter_finds_it(spark, edge_folder):
    bad = read_movies(spark, edge_folder, doubled_quotes=False)
    row = bad.filter("movieId = 3").first()
    assert (row.title, row.genres) == ('"Say ""Hello', ' Friend"" (2014)"')
    leaked = only_matching(movies_silver(bad), "genre")
    assert [r.movieId for r in leaked.collect()] == [3]
    good = read_movies(spark, edge_folder)
    assert only_matching(movies_silver(good), "genre").count() == 0


def test_csv_ratings(spark, edge_folder):
    df = read_ratings(spark, edge_folder)
    assert df.schema == RATINGS_SCHEMA
    assert brute.comparable(rows(df)) == brute.comparable(
        [(1, 1, 4.5, 1636263000), (1, 2, 0.0, 1636266600), (2, 1, None, 5), (2, 2, math.nan, 6), (3, 1, -1.0, None)]
    )


def test_csv_round_trip(spark, edge_folder, tmp_path):
    movies = read_movies(spark, edge_folder)
    write_csv(movies, str(tmp_path / "copy"))
    again = read_csv(spark, str(tmp_path / "copy"), MOVIES_SCHEMA)
    assert brute.comparable(rows(again)) == brute.comparable(rows(movies))


def test_movies_silver_of_edge_file(spark, edge_folder):
    found = {}
    for movie_id, _, year, genre in rows(movies_silver(read_movies(spark, edge_folder))):
        found.setdefault(movie_id, []).append((year, genre))
    assert {k: sorted(v, key=repr) for k, v in found.items()} == {
        1: [(1995, "Adventure"), (1995, "Animation"), (1995, "Children")],
        2: [(1995, "Comedy"), (1995, "Drama")],
        3: [(2014, "Horror")],
        4: [(2001, None)],
        5: [(None, "Drama")],
        6: [(1984, "Drama")],
        8: [(None, "Drama")],
        None: [(1999, "Drama")],
        10: [(1999, "Drama")],
        11: [(2002, "Drama")],
    }


def test_release_year_is_the_first(spark):
    df = spark.createDataFrame([("(1984) Two (2001)",), ("none",), ("(199)",), ("(20011)",), (None,)], "t string")
    assert [r.y for r in df.select(release_year(F.col("t")).alias("y")).collect()] == [1984, None, None, None, None]


def test_genre_list_keeps_empty_parts(spark):
    df = spark.createDataFrame([("A|B",), ("A|",), ("",), (None,)], "g string")
    assert [r.l for r in df.select(genre_list(F.col("g")).alias("l")).collect()] == [["A", "B"], ["A", ""], [""], None]


def test_valid_rating_and_presence(spark):
    df = spark.createDataFrame([(4.5,), (0.0,), (-1.0,), (None,), (math.nan,)], "r float")
    kept = [r.r for r in df.select(valid_rating(F.col("r")).alias("r")).collect()]
    assert kept[:4] == [4.5, None, None, None] and math.isnan(kept[4])
    present = df.select(is_present(F.col("r"), df.schema["r"].dataType).alias("p"))
    assert [r.p for r in present.collect()] == [True, True, True, False, False]


def test_epochs_an_hour_apart_stay_apart_when_clocks_go_back(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1636263000,), (1636266600,)], "e int")
        back = df.select(F.unix_seconds(epoch_to_timestamp(F.col("e"))).alias("e"))
        assert [r.e for r in back.collect()] == [1636263000, 1636266600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ratio_and_percent_of_nothing_are_null(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)).alias("a"), percent(F.lit(1), F.lit(8)).alias("b"), ratio(F.lit(None), F.lit(0)).alias("c")
    ).first()
    assert (row.a, row.b, row.c) == (None, 12.5, None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_silver_against_brute_force(spark, seed):
    movies, ratings = brute.make_movies(seed), brute.make_ratings(seed)
    movies_df = spark.createDataFrame(movies, MOVIES_SCHEMA).repartition(5)
    ratings_df = spark.createDataFrame(ratings, RATINGS_SCHEMA)
    assert brute.comparable(rows(movies_silver(movies_df))) == brute.comparable(brute.movies_silver(movies))
    silver = ratings_silver(ratings_df)
    assert silver.columns == ["userId", "movieId", "rating", "timestamp", "rating_timestamp"]
    assert brute.comparable(rows(silver.drop("rating_timestamp"))) == brute.comparable(brute.ratings_silver(ratings))
    assert silver.filter("(timestamp IS NULL) <> (rating_timestamp IS NULL)").count() == 0
    assert brute.comparable(rows(drop_incomplete(movies_silver(movies_df)))) == brute.comparable(
        filter(brute.is_complete, brute.movies_silver(movies))
    )


def test_one_survivor_per_film_whatever_the_order(spark):
    movies = brute.make_movies(7, 200)
    results = set()
    for parts in (1, 3, 8):
        df = films(spark.createDataFrame(movies[::-1] if parts == 3 else movies, MOVIES_SCHEMA).repartition(parts))
        results.add(tuple(brute.comparable([(r.movieId, r.title) for r in df.collect()])))
    assert len(results) == 1


def test_row_wise_silver_runs_on_a_stream(spark, edge_folder, tmp_path):
    stream = spark.readStream.schema(RATINGS_SCHEMA).option("header", True).csv(f"{edge_folder}/ratings*.csv")
    query = (
        ratings_silver(stream)
        .writeStream.format("memory")
        .queryName("stream_out")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    batch = ratings_silver(read_ratings(spark, edge_folder))
    assert brute.comparable(rows(spark.table("stream_out"))) == brute.comparable(rows(batch))


def test_pattern_finds_what_the_longer_one_finds(spark):
    texts = ['(2014)"', 'x (2014) y" z', '"(2014)', "(2014)", '(20145)"', 'a\n(2014)\n"', 'a\n(2014)"', None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "g string")
    long_pattern = ".*" + LEAKED_TITLE
    assert rows(only_matching(df, "g")) == rows(df.filter(F.col("g").rlike(long_pattern)))
    assert rows(drop_matching(df, "g")) == rows(df.filter(~F.col("g").rlike(long_pattern)))
