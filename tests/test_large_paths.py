"""Branches that large data take, and tables that must survive a second write or an odd value."""

import sys
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starledger.operators import measured_bytes, split_join
from starledger.plans import gold, insights, store_gold
from starledger.sources import corrupt_report, read_csv, read_gold, read_ratings, stand_ins, write_csv

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_every_hot_key_is_split_however_many_there_are(spark, limit):
    # 300 keys of 80 rows and one of 20,000; a split takes 50 rows.
    rows = spark.range(44_000).select(
        F.when(F.col("id") < 20_000, F.lit(-1)).otherwise(F.col("id") % 300).alias("k"), F.col("id").alias("x")
    )
    films = spark.range(-1, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(name, value)
    try:
        joined = split_join(rows, films, "k", rows_per_split=50, broadcast_limit=limit).withColumn("task", F.spark_partition_id())
        found = joined.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 44_000 and all(r["y"] == 2 * r["k"] for r in found)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(Counter(r["task"] for r in found if r["k"] == -1).values()) < 2 * 20_000 / tasks


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_films_repeated_per_split_stay_off_the_driver(spark, tmp_path, limit):
    # The file of the smaller side is far below the size from which Spark stops to broadcast.
    rows = spark.range(4000).select((F.col("id") % 200).alias("k"), F.col("id").alias("x"))
    spark.range(200).select(F.col("id").alias("k"), F.lit("a title").alias("y")).write.parquet(str(tmp_path / "films"))
    joined = split_join(rows, spark.read.parquet(str(tmp_path / "films")), "k", rows_per_split=5, broadcast_limit=limit)
    assert joined.count() == 4000
    text = joined._jdf.queryExecution().sparkPlan().toString()
    # Only the measured list of hot keys may be broadcast, to either side.
    assert text.count("BroadcastHashJoin") == (2 if limit else 0) and "SortMergeJoin" in text


def test_a_long_list_of_hot_keys_stays_off_the_driver(spark):
    # 200,000 hot keys, measured at 9.6 MB.
    rows = spark.range(400_000).select((F.col("id") % 200_000).alias("k"), F.col("id").alias("x"))
    joined = split_join(rows, spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")), "k", rows_per_split=1)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.agg(F.count("*"), F.count_if(F.col("y") == 2 * F.col("k"))).first() == (400_000, 400_000)


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_equal_rows_of_a_hot_key_are_split_whether_or_not_the_list_is_broadcast(spark, limit):
    # Copies of one row that is no constant to the optimizer.
    rows = spark.range(0, 4000, 1, 80).select(F.when(F.col("id") < 5000, 7).alias("k"), F.when(F.col("id") < 5000, "same").alias("x"))
    dims = spark.range(30).select(F.col("id").cast("int").alias("k"), F.lit("dim").alias("y"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = split_join(rows, dims, "k", rows_per_split=100, broadcast_limit=limit)
        tasks = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks.total() == 4000 and max(tasks.values()) < 4000 / 3


def test_fine_ratings_of_a_hot_film_are_split(spark):
    rated = spark.range(30_000).select(
        F.col("id").cast("int").alias("userId"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("movieId"),
        (F.col("id") / 7 + 1).cast("float").alias("rating"),
        F.lit(5).alias("timestamp"),
    )
    films = spark.range(50).select(F.col("id").cast("int").alias("movieId"), F.lit("t (1990)").alias("title"), F.lit("A|B").alias("genres"))
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(name, value)
    try:
        totals = insights.film_totals(films, rated, by_rating=True, rows_per_split=500).withColumn("task", F.spark_partition_id())
        found = totals.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [r for r in found if r["movieId"] == 1]
    assert len(hot) > 14_000 and max(Counter(r["task"] for r in hot).values()) < len(hot) / 3


def test_a_raw_table_is_read_as_it_is(spark, tmp_path):
    films, rated = stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER)
    path = str(tmp_path / "raw")
    store_gold(films, rated, path, drop_nulls=False)
    again = read_gold(spark, path)
    assert "rating_timestamp" in again.columns and again.filter("rating_timestamp is null").count() == 0
    from starledger.sources import GOLD_CLEAN_SCHEMA

    with pytest.raises(ValueError, match="timestamp"):
        read_gold(spark, path, GOLD_CLEAN_SCHEMA)


def test_a_second_write_replaces_all_years(spark, tmp_path):
    films, rated = stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER)
    path = str(tmp_path / "gold")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store_gold(films, rated, path)
        store_gold(films.filter(F.col("movieId") == 1), rated, path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["movieId"] for r in read_gold(spark, path).select("movieId").distinct().collect()] == [1]


TEXT = st.text(st.sampled_from('ab"\\, \t|\'é#'), max_size=8)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT)), max_size=12))
def test_csv_round_trip(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("csv") / "t.csv")
    df = spark.createDataFrame([(1, *r) for r in rows], "a int, k int, x string, y string")
    write_csv(df, path)
    assert Counter(read_csv(spark, path, df.schema).collect()) == Counter(df.collect())


def test_csv_refuses_line_breaks_and_shows_corrupt_records(spark, tmp_path):
    df = spark.createDataFrame([("one\ntwo",)], "x string")
    with pytest.raises(Exception, match="line break"):
        write_csv(df, str(tmp_path / "bad"))
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,4\n9999999999,2,3.5,4\n1,2\n")
    read = read_ratings(spark, str(tmp_path), corrupt_column="bad")
    assert corrupt_report(read, "bad").first().asDict() == {"total_records": 3, "corrupt_records": 2}


def test_measured_bytes_look_into_every_type(spark):
    long = "x" * 100_000
    df = spark.createDataFrame([({"k": long}, (long, [long]))], "m map<string,string>, s struct<a:string,b:array<string>>")
    assert measured_bytes(df) >= 300_000
    with pytest.raises(TypeError):
        measured_bytes(spark.sql("select parse_json('{}') as v"))


@pytest.mark.parametrize("drop_nulls", [True, False])
def test_split_gold_broadcasts_the_hot_films_alone(spark, drop_nulls):
    films, rated = stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER)
    split = gold(films, rated, drop_nulls, broadcast_limit=0, rows_per_split=4)
    text = split._jdf.queryExecution().sparkPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" in text
    assert split.count() == gold(films, rated, drop_nulls).count() > 0


@pytest.mark.parametrize("safely", [True, False])
@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_a_large_table_is_written_by_many_tasks_replaced_and_sliced(spark, monkeypatch, tmp_path, safely, limit):
    module = sys.modules["starledger.plans.gold"]
    monkeypatch.setattr(module, "ROWS_PER_PLACE", 500, raising=False)
    monkeypatch.setattr(module, "ROWS_TO_PLACE", 1000, raising=False)
    films, rated = stand_ins.movies(spark, FOLDER), stand_ins.ratings(spark, FOLDER)
    path = str(tmp_path / "gold")
    store_gold(films.filter("movieId < 9"), rated, path, safely=safely, broadcast_limit=limit)
    store_gold(films, rated, path, safely=safely, broadcast_limit=limit)
    tasks = {p.name[:10] for p in (tmp_path / "gold").glob("**/year=*/*.parquet")}
    assert len(tasks) > 5
    found, expected = (df.filter("year = 1975").toPandas() for df in (read_gold(spark, path), gold(films, rated)))
    assert Counter(found.itertuples(index=False, name=None)) == Counter(expected[found.columns].itertuples(index=False, name=None))
    assert len(found) and read_gold(spark, path).count() == gold(films, rated).count()
