"""Spark side of the roles the queries share (derived from the given tables only)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.operators import merge
from marquee.session import materialize
from marquee.sources import fixtures as fx

RATING_KEYS = ["user_id", "movie_id"]


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """raw.ratings after ingest: keyed on (user, movie), the last arrival (greatest id) wins."""
    return merge.dedupe_last(merge.drop_null_keys(fx.fx_ratings(spark, d), RATING_KEYS), RATING_KEYS, "id")


def ratings_table(spark: SparkSession, d: str) -> DataFrame:
    """The same rows, deduplicated once and written, for queries that read them several times."""
    return materialize(ratings(spark, d), "ratings")


def movies(spark: SparkSession, d: str) -> DataFrame:
    return fx.fx_movies(spark, d)


def movies_gaps(spark: SparkSession, d: str) -> DataFrame:
    return fx.fx_movies_gaps(spark, d)


def tags(spark: SparkSession, d: str) -> DataFrame:
    return merge.drop_null_keys(fx.fx_tags(spark, d), ["user_id", "movie_id", "tag", "timestamp"])


#: Bytes of a scan's split by default.
SPLIT = 128 << 20


def spread_of(spark: SparkSession, d: str, table: str) -> int | None:
    """How many tasks to deal a table's texts to where it is smaller than a split for every core; None for a larger one, which the
    scan deals by itself."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{d}/{table}.parquet").select("length")
    cores = spark.sparkContext.defaultParallelism
    return cores if sum(r["length"] for r in files.collect()) < SPLIT * cores else None  # a listing
