"""Validation: fused per-table aggregates and an anti-join for orphans; results as (check, severity, value) rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.vocab import RATING_MAX, RATING_MIN


def check_row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(name).alias("table_name"), "value",
        F.when(F.col("value") == 0, F.lit("fail")).otherwise(F.lit("ok")).alias("severity"))


def ratings_profile(rk: DataFrame, lo: float = RATING_MIN, hi: float = RATING_MAX) -> DataFrame:
    """All rating checks in one pass: rows, null keys, out-of-range ratings, distinct users and movies."""
    return rk.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("user_id").isNull()).alias("null_user_id"),
        F.count_if(F.col("movie_id").isNull()).alias("null_movie_id"),
        F.count_if((F.col("rating") < lo) | (F.col("rating") > hi)).alias("out_of_range"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.count_distinct("movie_id").alias("distinct_movies"),
    )


def check_null_keys(rk: DataFrame) -> DataFrame:
    return rk.agg(F.count_if(F.col("user_id").isNull()).alias("null_user_id"),
                  F.count_if(F.col("movie_id").isNull()).alias("null_movie_id"))


def check_null_titles(mv: DataFrame) -> DataFrame:
    return mv.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("title").isNull()).alias("null_titles"))


def check_rating_range(rk: DataFrame, lo: float = RATING_MIN, hi: float = RATING_MAX) -> DataFrame:
    return rk.agg(F.count_if((F.col("rating") < lo) | (F.col("rating") > hi)).alias("out_of_range"))


def distinct_counts(rk: DataFrame) -> DataFrame:
    return rk.agg(F.count_distinct("user_id").alias("distinct_users"),
                  F.count_distinct("movie_id").alias("distinct_movies"))


#: Precision of the distinct sketches: 2**LG_K registers, and the errors of an estimate that its bounds allow.
LG_K, BOUND_ERRORS = 12, 4


def distinct_sketches(rk: DataFrame) -> DataFrame:
    """One row of mergeable sketches of the user and movie ids (nulls left out): made once for every version or batch, kept with it."""
    return rk.agg(F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("users"), F.hll_sketch_agg("movie_id", F.lit(LG_K)).alias("movies"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """distinct_users and distinct_movies of all versions together from their sketches (any number of rows), with the bounds that
    the precision gives: estimate -/+ BOUND_ERRORS * 1.04 / sqrt(2**LG_K) of it, and one. No ratings are read. A sketch of few ids is
    exact to within one."""
    merged = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("users", "movies")])
    share = BOUND_ERRORS * 1.04 / 2 ** (LG_K / 2)
    cols = []
    for c, name in (("users", "distinct_users"), ("movies", "distinct_movies")):
        n = F.coalesce(F.col(c), F.lit(0))
        cols += [n.alias(name), (F.floor(n * (1 - share)) - 1).cast("long").alias(f"{name}_low"), (F.ceil(n * (1 + share)) + 1).cast("long").alias(f"{name}_high")]
    return merged.select(*cols)


def orphan_ratings(rk: DataFrame, mv: DataFrame) -> DataFrame:
    """Ratings whose movie is not in movies (a null movie id counts too)."""
    return rk.join(mv.select("movie_id"), "movie_id", "left_anti")


def _check(check, sev, value, cond=None):
    c = F.struct(F.lit(check).alias("check"), sev.alias("severity"), value.cast("bigint").alias("value"))
    return c if cond is None else F.when(cond, c)


def _fail_if(c):
    return F.when(c > 0, F.lit("fail")).otherwise(F.lit("ok"))


def _warn_if(c):
    return F.when(c > 0, F.lit("warn")).otherwise(F.lit("ok"))


def _rows(agg: DataFrame, checks) -> DataFrame:
    return (agg.select(F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("c"))
            .select("c.*"))


def validate_all(rk: DataFrame, mv: DataFrame, strict: bool = False) -> DataFrame:
    """(check, severity, value) rows. A table with zero rows fails and skips its other checks.

    One fused aggregate per table plus one anti-join count; the three one-row results are unioned.
    """
    ok_r = F.col("row_count") > 0
    ratings = _rows(ratings_profile(rk), [
        _check("ratings_row_count", F.when(ok_r, F.lit("ok")).otherwise(F.lit("fail")), F.col("row_count")),
        _check("ratings_null_user_id", _fail_if(F.col("null_user_id")), F.col("null_user_id"), ok_r),
        _check("ratings_null_movie_id", _fail_if(F.col("null_movie_id")), F.col("null_movie_id"), ok_r),
        _check("ratings_out_of_range", _warn_if(F.col("out_of_range")), F.col("out_of_range"), ok_r),
        _check("ratings_distinct_users", F.lit("info"), F.col("distinct_users"), ok_r),
        _check("ratings_distinct_movies", F.lit("info"), F.col("distinct_movies"), ok_r),
    ])
    movies = _rows(check_null_titles(mv), [
        _check("movies_row_count", F.when(ok_r, F.lit("ok")).otherwise(F.lit("fail")), F.col("row_count")),
        _check("movies_null_titles", _fail_if(F.col("null_titles")), F.col("null_titles"), ok_r),
    ])
    orphans = _rows(orphan_ratings(rk, mv).agg(F.count(F.lit(1)).alias("n")), [
        _check("orphan_ratings", _warn_if(F.col("n")), F.col("n"))])
    out = ratings.unionByName(movies).unionByName(orphans)
    if strict:
        failed = out.filter(F.col("severity") == "fail").count()
        if failed:
            raise ValueError(f"validation failed: {failed} failing check(s)")
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
