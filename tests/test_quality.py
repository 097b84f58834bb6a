"""Distinct counts from mergeable sketches."""
from pyspark.sql import functions as F

from marquee.operators import quality


def test_sketches_of_versions_merge_without_their_rows(spark):
    rk = spark.range(40_000).select((F.col("id") % 9000).cast("int").alias("user_id"), (F.col("id") * 7 % 150).cast("int").alias("movie_id"))
    rk = rk.unionByName(spark.createDataFrame([(None, None), (1, None)], rk.schema))
    parts = [quality.distinct_sketches(rk.where(F.coalesce(F.col("user_id") % 3, F.lit(0)) == n)) for n in range(3)]
    parts += [quality.distinct_sketches(rk.limit(0))]
    e = quality.distinct_estimates(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])).first()
    whole = quality.distinct_estimates(quality.distinct_sketches(rk)).first()
    assert e == whole  # the order and number of versions do not matter
    assert e.distinct_users_low <= 9000 <= e.distinct_users_high and e.distinct_users_high - e.distinct_users_low < 9000 * 0.14
    assert e.distinct_movies_low <= 150 <= e.distinct_movies_high
    none = quality.distinct_estimates(parts[3]).first()
    assert none.distinct_users == 0 and none.distinct_users_low <= 0 <= none.distinct_users_high
