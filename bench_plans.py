"""Time the plans chosen here against the plainest plan for the same result, the two in turn.

Takes BENCH_SF_DIR, BENCH_CPUS and BENCH_REPEAT as bench.py does, and prints one JSON line: seconds (best of the runs)
per result and plan. Both plans of a pair are run in full; that they agree is for the tests to show.
"""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bench import timed  # noqa: E402
from starledger import build_session, shared_folder  # noqa: E402
from starledger.operators import duplicate_report, null_ratios, unique_value_counts  # noqa: E402
from starledger.operators.joins import split_join  # noqa: E402
from starledger.plans import gold, insights, movies_silver, ratings_silver, store_gold  # noqa: E402
from starledger.plans.silver import complete_films, complete_ratings, unfold_genres  # noqa: E402
from starledger.sources import stand_ins, write_gold  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = build_session(
        "bench-plans",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(4 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR", "spark-warehouse/_bench"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    movies, ratings = stand_ins.movies(spark, folder), stand_ins.ratings(spark, folder)
    lines = stand_ins.table(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    silver = ratings_silver(ratings).drop("rating_timestamp")

    def film_totals() -> DataFrame:
        return insights.film_totals(movies, ratings)

    def plain_gold() -> DataFrame:
        return silver.na.drop().join(movies_silver(movies).na.drop(), "movieId")

    def plain_bayesian() -> None:
        rows = plain_gold()
        overall = F.lit(rows.agg(F.avg("rating")).first()[0])
        stats = rows.groupBy("genre").agg(F.count("rating").alias("v"), F.avg("rating").alias("R"))
        run(stats.select("genre", ((F.col("v") * F.col("R") + 1000 * overall) / (F.col("v") + 1000)).alias("a")).orderBy("a"))

    def plain_nulls() -> None:
        rows = silver.count()
        run(silver.select([(F.count(F.when(F.isnull(c), 1)) / rows).alias(c) for c in silver.columns]))

    def plain_profile() -> None:
        for column in silver.columns:
            values = silver.select(column).distinct()
            values.take(20)
            values.count()

    def plain_duplicates() -> None:
        lines.count()
        lines.select(keys).distinct().count()

    def shuffled(join) -> None:
        """Both sides as for gold, with the broadcast turned off."""
        name = "spark.sql.autoBroadcastJoinThreshold"
        before = spark.conf.get(name)
        spark.conf.set(name, "-1")
        try:
            run(unfold_genres(join(complete_ratings(ratings).drop("rating_timestamp"), complete_films(movies))))
        finally:
            spark.conf.set(name, before)

    pairs = {
        "mean_by_year": {
            "chosen": lambda: run(insights.avg_rating_by_year(insights.year_totals_of_films(film_totals()))),
            "plain": lambda: run(plain_gold().groupBy("year").agg(F.avg("rating")).orderBy("year")),
        },
        "bayesian_mean": {
            "chosen": lambda: run(insights.genre_bayesian_avg(insights.genre_totals_of_films(film_totals()))),
            "plain": plain_bayesian,
        },
        "null_ratios": {"chosen": lambda: run(null_ratios(silver)), "plain": plain_nulls},
        "unique_values": {"chosen": lambda: run(unique_value_counts(silver)), "plain": plain_profile},
        "duplicates": {"chosen": lambda: run(duplicate_report(lines, keys, "lineitem")), "plain": plain_duplicates},
        "gold_write": {
            "chosen": lambda: store_gold(movies, ratings, shared_folder(spark, "gold")),
            "gathered_after_unfolding": lambda: write_gold(gold(movies, ratings), shared_folder(spark, "gold")),
            "plain": lambda: write_gold(plain_gold(), shared_folder(spark, "gold"), gathered=True),
        },
        "shuffled_gold_join": {
            "chosen": lambda: shuffled(lambda large, small: split_join(large, small, "movieId")),
            "plain": lambda: shuffled(lambda large, small: large.join(small, "movieId")),
        },
    }
    only = os.environ.get("BENCH_QUERIES")
    seconds: dict[str, dict[str, float]] = {}
    for name, plans in pairs.items():
        if only and name not in only.split(","):
            continue
        times: dict[str, list[float]] = {plan: [] for plan in plans}
        for _ in range(repeat):
            for plan, action in plans.items():
                times[plan].append(timed(action))
        seconds[name] = {plan: round(min(t), 3) for plan, t in times.items()}
    print(json.dumps({"metric": "plan_seconds", "unit": "sec", "plans": seconds, "rows": lines.count(), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
