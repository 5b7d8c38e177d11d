"""Sketches, reports counted during a write, tables stored by film, safe replacement, totals by batch, filtered joins."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starledger import shared_folder
from starledger.operators import (
    counts_of_sketches,
    may_match,
    merge_sketches,
    relative_error,
    store_clean,
    unique_value_counts,
    unique_value_counts_approx,
    value_sketches,
)
from starledger.operators.observed import watched
from starledger.plans import exploration, insights, ratings_silver
from starledger.sources import read_by_film, read_gold, register_views, replace_gold, stand_ins, store_by_film

FOLDER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketches_of_batches_merge_to_those_of_all(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, i, i % 7]), f"t{i % 5000}", rng.choice([0.0, -0.0, float("nan"), i / 2]), [i % 3]) for i in range(20_000)]
    df = spark.createDataFrame(rows, "a bigint, b string, c double, `d.e` array<int>").repartition(6)
    exact = {r[0]: r[1] for r in unique_value_counts(df).collect()}
    whole = {r[0]: r[1] for r in unique_value_counts_approx(df).collect()}
    batches = [value_sketches(df.filter(F.col("b") < "t3")), value_sketches(df.filter(F.col("b") >= "t3"))]
    twice = batches[0].unionAll(batches[1]).unionAll(batches[0])
    merged = {r[0]: r[1] for r in counts_of_sketches(merge_sketches(twice)).collect()}
    assert exact.keys() == whole.keys() == merged.keys() == {"a", "b", "c", "d.e"}
    for column, n in exact.items():
        assert abs(whole[column] - n) <= max(1, n * relative_error())
        assert abs(merged[column] - n) <= max(1, n * relative_error())


def test_sketches_of_nothing_and_plan(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert {tuple(r) for r in unique_value_counts_approx(empty).collect()} == {("a", 0), ("b", 0)}
    with pytest.raises(ValueError):
        value_sketches(empty, ["a", "b"])
    of_table = plan(value_sketches(stand_ins.ratings(spark, FOLDER)))
    assert of_table.count("FileScan") == 1 and "Expand" not in of_table and "Sort" not in of_table


def test_a_clean_table_is_written_and_reported_in_one_pass(spark, tmp_path):
    rows = [(1, 1, "x"), (1, 1, "w"), (2, None, "x"), (3, 1, ' b"" (1999)"'), (4, 4, None), (5, 5, "y"), (5, 6, "y")]
    df = spark.createDataFrame(rows, "k int, v int, t string")
    report = store_clean(df, str(tmp_path / "t"), "mine", ["k"], ["v", "t"], leaked="t")
    found = {(r["measure"], r["column_name"]): r["value"] for r in report.collect()}
    assert found == {
        ("rows_read", None): 7, ("leaked_rows", None): 1, ("incomplete_rows", None): 2, ("duplicate_rows", None): 2,
        ("rows_written", None): 2, ("null_share", "k"): 0, ("null_share", "v"): 1 / 7, ("null_share", "t"): 1 / 7,
    }
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {(1, 1, "w"), (5, 5, "y")}
    of_table = watched(ratings_silver(stand_ins.ratings(spark, FOLDER)), ["userId", "movieId"], ["timestamp"])
    assert plan(of_table.rows).count("FileScan") == 1
    empty = store_clean(df.limit(0), str(tmp_path / "e"), "none", ["k"], ["v"]).collect()
    assert {r["value"] for r in empty if r["measure"] == "null_share"} == {None}


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_rows_that_may_match(spark, bits):
    large = spark.createDataFrame([(i % 3000 if i % 11 else None, i) for i in range(30_000)], "k bigint, v int").repartition(5)
    small = spark.createDataFrame([(k,) for k in [*range(100, 130), 130, 130, 99_999, None]], "k bigint")
    kept = may_match(large, small, "k", bits)
    assert kept.columns == large.columns
    wanted = large.filter(F.col("k").between(100, 130))
    assert kept.join(small.distinct(), "k").count() == wanted.count() == kept.filter(F.col("k").between(100, 130)).count()
    if bits > 1000:
        assert kept.count() == wanted.count()


def test_ratings_of_other_films_are_filtered_before_the_shuffle(spark):
    register_views(stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER))
    title = spark.table("movies_view").filter(F.col("movieId") == 7).first()["title"]
    shuffled = exploration.ratings_of_title(spark, title, broadcast_limit=0, rows_per_split=4)
    assert "bitmap" in plan(shuffled)
    films = spark.table("movies_view").filter(F.col("title") == title)
    rated = spark.table("ratings_view")
    matches = rated.join(films.select("movieId"), "movieId").count()
    assert matches <= may_match(rated, films, "movieId").count() <= matches + 5


def test_tables_stored_by_film_need_no_shuffle(spark):
    movies, ratings = stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER)
    for name, df in (("films_stored", movies), ("ratings_stored", ratings)):
        store_by_film(df, name, buckets=4)
    films = insights.film_totals(read_by_film(spark, "films_stored"), read_by_film(spark, "ratings_stored"))
    assert "hashpartitioning" not in plan(films)  # small films may be broadcast
    plain = insights.film_totals(movies, ratings)
    assert sorted(map(str, films.collect())) == sorted(map(str, plain.select(films.columns).collect()))
    store_by_film(movies.limit(10), "films_stored", buckets=4)
    assert read_by_film(spark, "films_stored").count() == 10
    spark.sql("DROP TABLE films_stored"), spark.sql("DROP TABLE ratings_stored")


def gold_rows(spark, n, year):
    return spark.createDataFrame(
        [(i, i, 1.0, 5, "t", year, "g") for i in range(n)],
        "movieId int, userId int, rating float, timestamp long, title string, year int, genre string",
    )


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "gold")
    replace_gold(gold_rows(spark, 5, 1990), path)
    replace_gold(gold_rows(spark, 7, 1991), path)
    assert read_gold(spark, path).groupBy("year").count().collect() == [(1991, 7)]
    broken = gold_rows(spark, 2000, 1992).repartition(4).withColumn(
        "rating", F.when(F.col("movieId") == 1999, F.raise_error(F.lit("half way"))).otherwise(F.col("rating")).cast("float")
    )
    with pytest.raises(Exception, match="half way"):
        replace_gold(broken, path)
    assert read_gold(spark, path).count() == 7
    replace_gold(read_gold(spark, path).filter("movieId < 3"), path)  # read from the table it replaces
    assert read_gold(spark, path).count() == 3
    tables = [p for p in (tmp_path / "gold").iterdir() if p.name.startswith("table-")]
    assert len(tables) == 1


def test_a_batch_given_again_counts_once(spark, tmp_path):
    movies, ratings = stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER)
    path = str(tmp_path / "totals")
    for batch in ("a", "b", "a"):
        part = ratings.filter((F.col("userId") < 20_000) if batch == "a" else (F.col("userId") >= 20_000))
        insights.add_rating_totals(part, path, batch)
    merged, whole = insights.merged_film_totals(movies, path), insights.film_totals(movies, ratings)
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.select(merged.columns).collect()))
    with pytest.raises(ValueError):
        insights.add_rating_totals(ratings, path, "../c")


def test_quantiles_of_a_fine_scale(spark):
    movies = spark.createDataFrame([(1, "a (1999)", "x|y"), (2, "b (1999)", "y")], "movieId int, title string, genres string")
    ratings = spark.range(60_000).select(
        F.lit(1).alias("userId"), (F.col("id") % 2 + 1).cast("int").alias("movieId"),
        (F.col("id") + 1).cast("float").alias("rating"), F.lit(1).alias("timestamp"),
    )
    found = insights.rating_quantiles(insights.rating_sketches(movies, ratings), [0.1, 0.5, 0.99]).collect()
    assert len(found) == 6
    assert all(abs(r["rating"] / 60_000 - r["share"]) <= insights.quantile_error() for r in found)


def test_ids_beyond_the_schema_fail_instead_of_meeting(spark):
    part = spark.createDataFrame([(2**31, "n", 3, "t")], "p_partkey bigint, p_name string, p_size int, p_type string")
    with pytest.raises(Exception, match="no 32-bit id"):
        stand_ins.movies_from_part(part).collect()


def test_a_cluster_without_a_shared_folder_is_refused():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session, "x")
