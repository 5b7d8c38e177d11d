"""The gold table on every join path, its store, and the insights, against brute force."""

import math
import statistics
import sys

import pytest
from pyspark.sql import functions as F

import brute
from starledger.operators.joins import measured_bytes, split_join
from starledger.plans import gold, insights, store_gold
from starledger.plans.silver import complete_ratings
from starledger.sources import (
    GOLD_CLEAN_SCHEMA,
    GOLD_RAW_SCHEMA,
    MOVIES_SCHEMA,
    RATINGS_SCHEMA,
    read_gold,
    write_gold,
)

PATHS = {
    "broadcast": {},
    "gathered": {"gather_years": True},
    "shuffled": {"broadcast_limit": -1},
    "split": {"broadcast_limit": -1, "rows_per_split": 7},
    "split and gathered": {"broadcast_limit": -1, "rows_per_split": 7, "gather_years": True},
}


def rows(df):
    return [tuple(r) for r in df.collect()]


def frames(spark, movies, ratings):
    return (
        spark.createDataFrame(movies, MOVIES_SCHEMA).repartition(3),
        spark.createDataFrame(ratings, RATINGS_SCHEMA).repartition(4),
    )


def with_epoch(df):
    """Gold rows with the time as epoch in fourth place, so that both variants compare alike."""
    if "rating_timestamp" in df.columns:
        df = df.withColumn("rating_timestamp", F.unix_seconds("rating_timestamp"))
    return df


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("drop_nulls", [True, False])
@pytest.mark.parametrize("seed", [11, 12])
def test_gold(spark, path, drop_nulls, seed):
    movies, ratings = brute.make_movies(seed), brute.make_ratings(seed)
    df = gold(*frames(spark, movies, ratings), drop_nulls=drop_nulls, **PATHS[path])
    assert df.columns == (GOLD_CLEAN_SCHEMA if drop_nulls else GOLD_RAW_SCHEMA).fieldNames()
    expected = brute.gold(movies, ratings, drop_nulls)
    assert expected
    assert brute.comparable(rows(with_epoch(df))) == brute.comparable(expected)


def test_gold_of_nothing(spark):
    for path in PATHS.values():
        movies, ratings = frames(spark, [(1, "A (1999)", "X")], [])
        assert gold(movies, ratings, **path).count() == 0


def test_split_join_spreads_a_hot_key_of_equal_rows(spark):
    """Two thirds of the rows are copies of one row; no join task may get them all."""
    copies, others, bound = 4000, 2000, 100
    large = spark.range(0, copies, 1, 80).select(F.lit(7).alias("k"), F.lit("same").alias("x")).union(
        spark.range(0, others, 1, 80).select((F.col("id") + 100).cast("int").alias("k"), F.lit("other").alias("x"))
    )
    small = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.lit("dim").alias("y"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = split_join(large, small, "k", rows_per_split=bound)
        assert joined.columns == ["k", "x", "y"]
        per_task = joined.filter("k = 7").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in per_task) == copies
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < copies / 3
    assert joined.count() == copies + others


def test_a_row_keeps_its_split_when_its_task_sees_rows_in_another_order(spark):
    """The same rows per partition in two orders: each split must end up with the same rows."""

    def splits(ascending):
        rows_in = spark.range(0, 3000, 1, 6).select(
            F.lit(1).alias("k"), (F.col("id") % 700).alias("x"), F.col("id").alias("__order")
        )
        ordered = rows_in.sortWithinPartitions("__order", ascending=ascending).drop("__order")
        joined = split_join(ordered, spark.createDataFrame([(1, "dim")], "k int, y string"), "k", rows_per_split=100)
        return joined.groupBy(F.spark_partition_id().alias("task"), "x").count().collect()

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        assert sorted(splits(True)) == sorted(splits(False))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("rows_per_split", [1, 2, 1000])
def test_split_join_drops_null_keys_and_keeps_every_match(spark, rows_per_split):
    large = spark.createDataFrame([(None, 1), (1, 2), (1, 2), (2, 3)], "k int, x int")
    small = spark.createDataFrame([(None, "n"), (1, "a"), (1, "b")], "k int, y string")
    expected = [(1, 2, "a"), (1, 2, "a"), (1, 2, "b"), (1, 2, "b")]
    assert sorted(rows(split_join(large, small, "k", rows_per_split))) == expected


def test_measured_bytes_is_not_below_the_text(spark):
    df = spark.createDataFrame([(1, "x" * 1000, ["ab", None]), (2, None, None)], "a int, b string, c array<string>")
    assert measured_bytes(df) > 1000
    assert measured_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("drop_nulls", [True, False])
def test_store_and_read_back(spark, tmp_path, drop_nulls):
    movies, ratings = brute.make_movies(21), brute.make_ratings(21)
    schema = GOLD_CLEAN_SCHEMA if drop_nulls else GOLD_RAW_SCHEMA
    movies_df, ratings_df = frames(spark, movies, ratings)
    expected = brute.comparable(brute.gold(movies, ratings, drop_nulls))
    for name in ("stored", "written", "stored"):  # the last one overwrites
        path = str(tmp_path / name)
        if name == "stored":
            store_gold(movies_df, ratings_df, path, drop_nulls)
        else:
            write_gold(gold(movies_df, ratings_df, drop_nulls), path)
        again = read_gold(spark, path, schema)
        assert again.schema == schema
        assert brute.comparable(rows(with_epoch(again))) == expected


@pytest.mark.parametrize("drop_nulls", [True, False])
@pytest.mark.parametrize("rows_per_split", [1, 3, 1_000_000])
def test_store_with_films_too_many_to_broadcast(spark, tmp_path, drop_nulls, rows_per_split):
    movies, ratings = brute.make_movies(23), brute.make_ratings(23)
    ratings = [*ratings, *ratings[:1] * 40]  # equal rows of one film
    path = str(tmp_path / "gold")
    store_gold(*frames(spark, movies, ratings), path, drop_nulls, broadcast_limit=-1, rows_per_split=rows_per_split)
    found = rows(with_epoch(read_gold(spark, path, GOLD_CLEAN_SCHEMA if drop_nulls else GOLD_RAW_SCHEMA)))
    assert brute.comparable(found) == brute.comparable(brute.gold(movies, ratings, drop_nulls))


def test_the_format_is_a_parameter(spark, tmp_path):
    movies, ratings = brute.make_movies(22), brute.make_ratings(22)
    path = str(tmp_path / "gold")
    store_gold(*frames(spark, movies, ratings), path, file_format="orc")
    again = read_gold(spark, path, file_format="orc")
    assert brute.comparable(rows(again)) == brute.comparable(brute.gold(movies, ratings, True))


@pytest.mark.parametrize("gathered", ["before unfolding", "after unfolding", "after a split join"])
def test_a_year_with_most_rows_is_written_by_several_tasks(spark, tmp_path, gathered):
    """Nine in ten of the ratings fall on one year, a third on one film."""
    n = 300_000
    film = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.col("id") % 60 * 100 + 1).otherwise(
        F.col("id") % 50 * 100
    )
    ratings = spark.range(n).select(
        F.hash("id").alias("userId"),
        film.cast("int").alias("movieId"),
        F.lit(4.0).cast("float").alias("rating"),
        F.abs(F.hash(F.col("id") + 1)).alias("timestamp"),
    )
    year = F.when(F.col("id") % 100 == 0, 1995).otherwise(F.col("id") / 100 % 60 + 1900).cast("int")
    movies = spark.range(6000).select(
        F.col("id").cast("int").alias("movieId"),
        F.concat(F.md5(F.col("id").cast("string")), F.lit(" ("), year.cast("string"), F.lit(")")).alias("title"),
        F.lit("A|B").alias("genres"),
    )
    path = str(tmp_path / "gold")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512k")
    try:
        if gathered == "before unfolding":
            store_gold(movies, ratings, path)
        elif gathered == "after unfolding":
            write_gold(gold(movies, ratings), path)
        else:
            split = gold(movies, ratings, broadcast_limit=-1, rows_per_split=10_000, gather_years=True)
            write_gold(split, path, gathered=True)
    finally:
        spark.conf.set(key, before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "gold").glob("year=*")}
    assert files["year=1995"] >= 3
    # A year that shares the large year's shuffle partition is dealt out with it; the others stay together.
    assert statistics.median(files.values()) <= 2
    assert read_gold(spark, path).count() == 2 * n


@pytest.mark.parametrize("drop_nulls", [True, False])
@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_large_writes_are_dealt_by_number_of_rows(spark, monkeypatch, tmp_path, drop_nulls, limit):
    """AQE would put these few bytes into one task; a year's place still lies in one, so that files stay few."""
    module = sys.modules["starledger.plans.gold"]
    monkeypatch.setattr(module, "ROWS_PER_PLACE", 500, raising=False)
    monkeypatch.setattr(module, "ROWS_TO_PLACE", 1000, raising=False)
    n, years = 20_000, 10
    film = F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("id") % 200).cast("int")
    ratings = spark.range(n).select(
        F.col("id").cast("int").alias("userId"), film.alias("movieId"), F.lit(4.0).cast("float").alias("rating"), F.lit(7).alias("timestamp")
    )
    title = F.when(F.col("id") % years == 9, F.lit("no year")).otherwise(
        F.concat(F.lit("t ("), (F.col("id") % years + 1990).cast("string"), F.lit(")"))
    )
    movies = spark.range(200).select(F.col("id").cast("int").alias("movieId"), title.alias("title"), F.lit("A|B").alias("genres"))
    written = gold(movies, ratings, drop_nulls, broadcast_limit=limit, gather_years=True)
    text = written._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in text.split("Union")[0]) == bool(limit)
    by_task = written.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(by_task) > 20 and max(r["count"] for r in by_task) < 2 * n / 6
    path = str(tmp_path / "gold")
    write_gold(written, path, gathered=True)
    files = list((tmp_path / "gold").glob("year=*/*.parquet"))
    places = n / 500 + years
    assert len(files) <= places
    found = read_gold(spark, path)
    plain = gold(movies, ratings, drop_nulls)
    assert found.count() == plain.count() == found.distinct().count()
    assert found.exceptAll(plain.select(found.columns)).count() == 0


@pytest.mark.parametrize("drop_nulls", [True, False])
@pytest.mark.parametrize("seed", [31, 32])
def test_totals_both_ways(spark, drop_nulls, seed):
    movies, ratings = brute.make_movies(seed), brute.make_ratings(seed)
    movies_df, ratings_df = frames(spark, movies, ratings)
    gold_rows = brute.gold(movies, ratings, drop_nulls)
    gold_df = gold(movies_df, ratings_df, drop_nulls)
    films = insights.film_totals(movies_df, ratings_df, drop_nulls)
    by_genre, by_year = brute.totals(gold_rows, 6), brute.totals([r for r in gold_rows if r[5] is not None], 5)

    def check(df, expected):
        assert brute.comparable(rows(df)) == brute.comparable((k, *v) for k, v in expected.items())

    check(insights.genre_totals(gold_df), by_genre)
    check(insights.genre_totals_of_films(films), by_genre)
    check(insights.year_totals(gold_df), by_year)
    check(insights.year_totals_of_films(films), by_year)

    histogram = brute.comparable((k[0], k[1], n) for k, n in _counts((r[6], r[2]) for r in gold_rows).items())
    assert brute.comparable(rows(insights.rating_histogram(gold_df))) == histogram
    films_by_rating = insights.film_totals(movies_df, ratings_df, drop_nulls, by_rating=True)
    assert brute.comparable(rows(insights.rating_histogram_of_films(films_by_rating))) == histogram
    assert brute.comparable(rows(insights.ratings_long(gold_df))) == brute.comparable((r[6], r[2]) for r in gold_rows)


def _counts(items):
    counts = {}
    for genre, rating in items:
        key = (genre, "NaN" if rating is not None and math.isnan(rating) else rating)
        counts[key] = counts.get(key, 0) + 1
    return counts


@pytest.fixture(scope="module")
def sample(spark):
    movies, ratings = brute.make_movies(41, 80), brute.make_ratings(41, 600)
    movies_df, ratings_df = frames(spark, movies, ratings)
    totals = insights.genre_totals_of_films(insights.film_totals(movies_df, ratings_df))
    return movies, ratings, movies_df, ratings_df, totals, brute.gold(movies, ratings, True)


def test_genre_reports(sample):
    *_, totals, gold_rows = sample
    expected = brute.totals(gold_rows, 6)
    popular = rows(insights.genre_popularity(totals))
    assert popular == sorted(((g, t[1]) for g, t in expected.items()), key=lambda x: (-x[1], x[0]))
    means = rows(insights.genre_avg_rating(totals))
    assert dict(means) == pytest.approx({g: t[2] / t[1] for g, t in expected.items()})
    assert [m for _, m in means] == sorted((m for _, m in means), reverse=True)


@pytest.mark.parametrize("reliable", [0, 5, 1000])
def test_bayesian_mean(sample, reliable):
    *_, totals, gold_rows = sample
    expected = brute.totals(gold_rows, 6)
    overall = sum(r[2] for r in gold_rows) / len(gold_rows)
    found = insights.genre_bayesian_avg(totals, reliable).collect()
    assert {r.genre for r in found} == set(expected)
    for r in found:
        own = expected[r.genre][2] / expected[r.genre][1]
        assert (r.v, r.R, r.C) == (expected[r.genre][1], pytest.approx(own), pytest.approx(overall))
        assert r.adjusted_rating == pytest.approx((r.v * own + reliable * overall) / (r.v + reliable))
        assert min(own, overall) - 1e-9 <= r.adjusted_rating <= max(own, overall) + 1e-9
    scores = [r.adjusted_rating for r in found]
    assert scores == sorted(scores, reverse=True)


def test_share(sample):
    *_, totals, gold_rows = sample
    counts = {g: t[0] for g, t in brute.totals(gold_rows, 6).items()}
    assert insights.genre_share_pct(totals, "D", "A").first()[0] == pytest.approx(counts["D"] / counts["A"] * 100)
    assert insights.genre_share_pct(totals, "unknown", "A").first()[0] == 0
    assert insights.genre_share_pct(totals, "A", "unknown").first()[0] is None


def test_year_means_weigh_by_genre_unless_told_not_to(sample):
    movies, ratings, movies_df, ratings_df, _, gold_rows = sample
    films = insights.film_totals(movies_df, ratings_df)
    weighted = insights.avg_rating_by_year(insights.year_totals_of_films(films))
    expected = {y: t[2] / t[1] for y, t in brute.totals(gold_rows, 5).items()}
    assert dict(rows(weighted)) == pytest.approx(expected)
    assert [y for y, _ in rows(weighted)] == sorted(expected)

    year_of = {r[0]: r[5] for r in gold_rows}
    once = {}
    for _, movie_id, rating, _ in filter(brute.is_complete, brute.ratings_silver(ratings)):
        if movie_id in year_of:
            once.setdefault(year_of[movie_id], []).append(rating)
    plain = insights.avg_rating_by_year(insights.year_totals_of_films(films, genre_weighted=False))
    assert dict(rows(plain)) == pytest.approx({y: sum(r) / len(r) for y, r in once.items()})


def test_early_filter_of_ratings_is_the_late_one(spark):
    ratings = brute.make_ratings(51, 500)
    df = complete_ratings(spark.createDataFrame(ratings, RATINGS_SCHEMA)).drop("rating_timestamp")
    assert brute.comparable(rows(df)) == brute.comparable(filter(brute.is_complete, brute.ratings_silver(ratings)))
