"""Training-sample assembly: per-split decay weights, best demonstration, feature joins with defaults."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.vocab import DEFAULT_YEAR, GENRE_VOCAB

N_GENRES = len(GENRE_VOCAB)


def _zeros(n: int = N_GENRES):
    return F.array_repeat(F.lit(0.0), n)


def sample_decay_weights(rk_split: DataFrame, lam: float = 0.1, ts: str = "timestamp",
                         by: str = "split") -> DataFrame:
    """weight = exp(-lam * (1 - (t - t_min) / range)) with bounds inside each split, range >= 1.

    Bounds are one row per split (a bounded side), joined back on the split key.
    """
    b = rk_split.groupBy(by).agg(F.min(ts).alias("_tmin"), F.max(ts).alias("_tmax"))
    b = b.select(by, "_tmin", F.greatest(F.col("_tmax") - F.col("_tmin"), F.lit(1)).cast("double").alias("_rng"))
    out = rk_split.join(F.broadcast(b), by)
    w = F.exp(F.lit(-lam) * (F.lit(1.0) - (F.col(ts) - F.col("_tmin")) / F.col("_rng")))
    return out.withColumn("weight", w).drop("_tmin", "_rng")


def best_demonstration(rk: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per user the highest rating, then the newest timestamp, then the lowest id.

    A grouped max over a struct: partial aggregation collapses a heavy user before the shuffle.
    """
    keys = (by or []) + ["user_id"]
    best = F.max(F.struct("rating", "timestamp", (-F.col("id")).alias("neg_id"), "movie_id")).alias("b")
    return rk.groupBy(*keys).agg(best).select(
        *keys, F.col("b.movie_id").alias("demo_movie_id"), F.col("b.rating").alias("demo_rating"),
        (-F.col("b.neg_id")).alias("demo_id"))


def training_samples(rk_weighted: DataFrame, uf: DataFrame, itf: DataFrame, demo: DataFrame) -> DataFrame:
    """Rows with user, item and demonstration features; missing features get the defaults."""
    u = uf.select("user_id", "genre_affinity", "rating_count", "avg_rating")
    i = itf.select("movie_id", "genre_multihot", "release_year")
    d = demo.join(itf.select(F.col("movie_id").alias("demo_movie_id"),
                             F.col("genre_multihot").alias("demo_genre_multihot")), "demo_movie_id", "left")
    demo_keys = [c for c in demo.columns if c in ("split",)] + ["user_id"]
    s = (rk_weighted.join(u, "user_id", "left").join(i, "movie_id", "left")
         .join(d, demo_keys, "left"))
    aff = F.col("genre_affinity")
    return s.select(
        *[c for c in rk_weighted.columns],
        F.when(aff.isNotNull() & (F.size(aff) > 0), aff).otherwise(_zeros()).alias("genre_affinity"),
        F.coalesce("rating_count", F.lit(0)).cast("bigint").alias("rating_count"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("genre_multihot", _zeros()).alias("genre_multihot"),
        F.coalesce(F.nullif(F.col("release_year"), F.lit(0)), F.lit(DEFAULT_YEAR)).alias("release_year"),
        "demo_movie_id", "demo_rating",
        F.coalesce("demo_genre_multihot", _zeros()).alias("demo_genre_multihot"),
    )


def demo_context(samples: DataFrame, a: float = 0.7, b: float = 0.3) -> DataFrame:
    """affinity * 0.7 + demonstration multi-hot * 0.3, elementwise."""
    return samples.withColumn("demo_context", F.zip_with(
        "genre_affinity", "demo_genre_multihot", lambda x, y: x * F.lit(a) + y * F.lit(b)))


def id_space(uf: DataFrame, itf: DataFrame) -> DataFrame:
    """n_users = max(user_id) + 1, n_items = max(movie_id) + 1, n_genres = vector length (one aggregate)."""
    both = (uf.select(F.col("user_id").cast("bigint").alias("_u"), F.lit(None).cast("bigint").alias("_i"),
                      F.lit(None).cast("int").alias("_g"))
            .unionByName(itf.select(F.lit(None).cast("bigint").alias("_u"), F.col("movie_id").cast("bigint").alias("_i"),
                                    F.size("genre_multihot").alias("_g"))))
    return both.agg((F.max("_u") + 1).alias("n_users"), (F.max("_i") + 1).alias("n_items"),
                    F.max("_g").alias("n_genres"))


def pad_sequences(df: DataFrame, batch_col: str, seq_col: str, out: str = "padded", mask: str = "mask") -> DataFrame:
    """Right-pad every sequence of a batch with 0 to the batch's longest; mask = value != 0."""
    longest = df.groupBy(batch_col).agg(F.max(F.size(seq_col)).alias("_len"))
    j = df.join(longest, batch_col)
    padded = F.concat(F.col(seq_col), F.array_repeat(F.lit(0.0), (F.col("_len") - F.size(seq_col)).cast("int")))
    return (j.withColumn(out, padded).withColumn(mask, F.transform(out, lambda x: x != 0)).drop("_len"))
