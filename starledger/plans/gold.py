"""The gold table: every rating with its film, one row per rating and genre."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starledger.functions import genre_list
from starledger.operators.joins import BROADCAST_LIMIT, ROWS_PER_SPLIT, measured_bytes, split_join
from starledger.plans import silver
from starledger.plans.silver import unfold_genres
from starledger.session import shared_folder
from starledger.sources.gold_table import gather, replace_gold, write_gold
from starledger.sources.schemas import GOLD_CLEAN_SCHEMA, GOLD_RAW_SCHEMA

_N, _OF_YEAR, _PLACES, _FILM_PLACES = "__n", "__of_year", "__places", "__film_places"
_TURN, _CELL, _PLACE = "__turn", "__cell", "__place"
_FILM, _RATED = "__film", "__rated"

# Ratings of one place in a gathered write, and from how many on the write is dealt over places. With titles and genres
# unfolded and sorted by year a rating takes some 420 bytes of a task's memory.
ROWS_PER_PLACE = 250_000
ROWS_TO_PLACE = 1_000_000
# Tasks per place: so many that few of them get several large places.
TASKS_PER_PLACE = 4


def gold(
    movies: DataFrame,
    ratings: DataFrame,
    drop_nulls: bool = True,
    broadcast_limit: int = BROADCAST_LIMIT,
    rows_per_split: int = ROWS_PER_SPLIT,
    gather_years: bool = False,
) -> DataFrame:
    """Join the tables as read into gold rows.

    ``drop_nulls`` joins only complete silver rows and carries the epoch ``timestamp``; without it every silver row
    takes part and ``rating_timestamp`` is carried. Ratings meet one row per film, and genres unfold after the join, so
    neither a shuffle nor a broadcast holds a film more than once.

    ``gather_years`` brings the rows of a year together for a partitioned write, before genres multiply them.
    """
    if drop_nulls:
        film_rows, rating_rows, columns = (
            silver.complete_films(movies),
            silver.complete_ratings(ratings).drop("rating_timestamp"),
            GOLD_CLEAN_SCHEMA.fieldNames(),
        )
    else:
        film_rows, rating_rows, columns = (
            silver.films(movies),
            silver.ratings_silver(ratings).drop("timestamp"),
            GOLD_RAW_SCHEMA.fieldNames(),
        )
    fits = measured_bytes(_film_sizes(movies)) <= broadcast_limit
    if not fits:
        film_rows = film_rows.hint("merge")  # Spark may take a well compressed file of them for a small table
    if gather_years and fits:
        joined = _gathered_by_year(rating_rows, film_rows)
    elif fits:
        joined = rating_rows.join(F.broadcast(film_rows), "movieId", "inner")
    elif gather_years:
        joined = _gathered_by_place(rating_rows, film_rows, rows_per_split)
    else:
        joined = split_join(rating_rows, film_rows, "movieId", rows_per_split)
    return unfold_genres(joined).select(columns)


def _gathered_by_year(rating_rows: DataFrame, film_rows: DataFrame) -> DataFrame:
    """Ratings with their films, shuffled by year while they hold nothing of the film but the year.

    Titles and genres are looked up a second time after the shuffle, which costs a small broadcast and saves sending
    them along with every rating. AQE sizes tasks by what is shuffled, so that many narrow ratings would make a large task
    once titles and genres are there; from ``ROWS_TO_PLACE`` ratings on they are dealt over places, by number.
    """
    years = F.broadcast(film_rows.select("movieId", "year"))
    others = F.broadcast(film_rows.drop("year"))
    found = rating_rows.join(years, "movieId", "inner")
    total = rating_rows.count()
    if total <= ROWS_TO_PLACE:
        return gather(found).join(others, "movieId", "inner")
    places = F.broadcast(_places(found.groupBy("year").agg(F.count("*").alias(_N)), ROWS_PER_PLACE))
    by_content = F.pmod(F.xxhash64(*rating_rows.columns), F.col(_PLACES))
    cell = F.pmod(by_content + F.spark_partition_id(), F.col(_PLACES)).cast("int")
    dealt = found.join(places, F.col("year").eqNullSafe(F.col(_OF_YEAR))).withColumn(_PLACE, F.xxhash64("year", cell))
    sent = dealt.drop(_OF_YEAR, _PLACES).repartition(_tasks(rating_rows.sparkSession, total), _PLACE)
    return sent.drop(_PLACE).join(others, "movieId", "inner")


def _places(counted: DataFrame, rows_per_place: int) -> DataFrame:
    """Years and how many places each has. A row per year, of which four digits allow 10,000."""
    places = F.ceil(F.sum(_N) / rows_per_place).cast("int")
    return counted.groupBy(F.col("year").alias(_OF_YEAR)).agg(places.alias(_PLACES))


def _tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for the shuffle by place, growing with the rows; as the number is given, AQE doesn't join them to larger ones."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_PLACE * -(-rows // ROWS_PER_PLACE))


def _gathered_by_place(rating_rows: DataFrame, film_rows: DataFrame, rows_per_split: int) -> DataFrame:
    """The same for films too many to broadcast: ratings are shuffled twice, neither time with titles or genres.

    A year has one place per ``ROWS_PER_PLACE`` of its ratings (or ``rows_per_split``, if that is less), and a place is
    shuffled to one task. Films are dealt over the places of their year by id; one with more than a quarter of a place's
    ratings takes several. In the first shuffle, by
    film, a rating learns its place; the second brings it there, where its film is sent too, once to each of its
    places, and stands first of the rows with its id.
    So files stay few, and neither a large year nor a hot film makes a large task, with or without AQE.
    """
    spark, folder = rating_rows.sparkSession, shared_folder(rating_rows.sparkSession, "film-counts")
    counted = rating_rows.groupBy("movieId").agg(F.count("*").alias(_N)).join(film_rows.select("movieId", "year"), "movieId")
    counted.write.parquet(folder)
    counted = spark.read.schema(counted.schema).parquet(folder)

    total = counted.agg(F.sum(_N)).first()[0] or 0
    tasks, rows_per_place = _tasks(spark, total), min(rows_per_split, ROWS_PER_PLACE)
    rows_of_film = min(rows_per_split, ROWS_PER_PLACE // 4)
    years = F.broadcast(_places(counted, rows_per_place))
    film_places = F.least(F.ceil(F.col(_N) / rows_of_film).cast("int"), F.col(_PLACES))
    placed = counted.join(years, F.col("year").eqNullSafe(F.col(_OF_YEAR))).select(
        "movieId", "year", _PLACES, film_places.alias(_FILM_PLACES)
    )

    def at_place(df: DataFrame) -> DataFrame:
        cell = F.pmod(F.pmod(F.xxhash64("movieId"), F.col(_PLACES)) + F.col(_TURN), F.col(_PLACES)).cast("int")
        at = df.withColumn(_CELL, cell).withColumn(_PLACE, F.xxhash64("year", _CELL))
        return at.drop(_TURN, _PLACES, _FILM_PLACES).repartition(tasks, _PLACE)

    by_film = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_TO_PLACE))
    known = counted.select("movieId", _N)
    found = split_join(rating_rows, placed.hint("merge"), "movieId", rows_per_split, counts=known, tasks=by_film)
    by_content = F.pmod(F.xxhash64(*rating_rows.columns), F.col(_FILM_PLACES))
    sent = at_place(found.withColumn(_TURN, F.pmod(by_content + F.spark_partition_id(), F.col(_FILM_PLACES))))
    films = film_rows.drop("year").join(placed, "movieId")
    there = at_place(films.withColumn(_TURN, F.explode(F.sequence(F.lit(0), F.col(_FILM_PLACES) - 1)))).drop("year")
    # A join would shuffle both sides anew, by all of its keys; a window takes them as they lie.
    content, in_film = rating_rows.columns + ["year"], Window.partitionBy(_PLACE, _CELL, "movieId")
    of_film = in_film.orderBy(F.col(_RATED).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = there.select(_PLACE, _CELL, "movieId", F.struct("title", "genre_list").alias(_FILM)).unionByName(
        sent.withColumn(_RATED, F.lit(True)), allowMissingColumns=True
    )
    film = F.first(_FILM, ignorenulls=True).over(of_film)
    rated = both.withColumn(_FILM, film).filter(F.col(_RATED) & F.col(_FILM).isNotNull())
    return rated.select(*content, f"{_FILM}.title", f"{_FILM}.genre_list")


def store_gold(
    movies: DataFrame,
    ratings: DataFrame,
    path: str,
    drop_nulls: bool = True,
    file_format: str = "parquet",
    safely: bool = False,
    **options: int,
) -> None:
    """Build the gold table and write it, one folder per year; options are those of ``gold``.

    ``safely`` keeps the table that is there until the new one is complete (Parquet only, see ``replace_gold``).
    """
    rows = gold(movies, ratings, drop_nulls, gather_years=True, **options)
    if safely:
        if file_format != "parquet":
            raise ValueError("only Parquet tables are replaced safely here")
        replace_gold(rows, path, gathered=True)
    else:
        write_gold(rows, path, file_format, gathered=True)


def _film_sizes(movies: DataFrame) -> DataFrame:
    """A frame at least as large as the films, measured without removing duplicates or filtering first."""
    return movies.select("movieId", "title", genre_list(F.col("genres")).alias("genre_list"))
