"""Views over the given Parquet tables that play the roles of the recommender's tables.

Every view is derived from a given table with Spark, so its size grows with the data:
  ratings   <- events       movies  <- part      tags <- documents
  links     <- part         vectors <- embeddings     metrics <- events
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.vocab import genre_vocab_col

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts_col: str) -> F.Column:
    """Whole seconds since the epoch for a TIMESTAMP_NTZ column, independent of the session zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts_col})")


def fx_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("movie_id"),
        (F.lit(0.5) * (1 + F.floor("value").cast("bigint") % 10)).alias("rating"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("ts").alias("inserted_at"),
    )


def fx_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    vocab = genre_vocab_col()
    g1 = F.get(vocab, (F.col("p_partkey") % 19).cast("int"))
    g2 = F.get(vocab, (F.col("p_size") % 19).cast("int"))
    genres = (F.when(F.col("p_partkey") % 20 == 19, F.lit("(no genres listed)"))
              .when(F.col("p_partkey") % 19 == F.col("p_size") % 19, g1)
              .otherwise(F.concat(g1, F.lit("|"), g2)))
    return p.select(
        F.col("p_partkey").cast("int").alias("movie_id"),
        F.concat("p_name", F.lit(" ("), (1950 + F.col("p_size")).cast("string"), F.lit(")")).alias("title"),
        genres.alias("genres"),
    )


def fx_movies_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue that lacks a tenth of the movies: for the queries that look for ratings and tags without a movie."""
    return fx_movies(spark, sf_dir).filter(F.col("movie_id") % 10 != 7)


def fx_dirty_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ratings, some with a null key or a rating out of range (by the event's type)."""
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type")
    r = fx_ratings(spark, sf_dir).join(ev, "id")
    return r.select("id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
                    F.when(F.col("event_type") != "signup", F.col("movie_id")).alias("movie_id"),
                    F.when(F.col("event_type") == "purchase", F.col("rating") + 3.0).otherwise(F.col("rating")).alias("rating"),
                    "timestamp", "inserted_at")


def fx_dirty_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All movies; those without genres also lack a title."""
    return fx_movies(spark, sf_dir).withColumn("title", F.when(F.col("genres") != "(no genres listed)", F.col("title")))


def fx_dirty_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links; a missing tmdb id is the text 'nan', as a careless export writes it."""
    return fx_links(spark, sf_dir).withColumn("tmdb_id", F.coalesce("tmdb_id", F.lit("nan")))


def fx_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        (F.col("doc_id") % 150).cast("int").alias("user_id"),
        F.col("doc_id").cast("int").alias("movie_id"),
        F.col("text").alias("tag"),
        F.col("doc_id").alias("timestamp"),
    )


def fx_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("movie_id"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("imdb_id"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise((F.col("p_partkey") * 7).cast("string")).alias("tmdb_id"),
    )


def fx_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id", "label",
        F.transform("embedding", lambda x: x.cast("double") * (F.lit(1.0) + F.col("vec_id") % 5)).alias("v"),
    )


def fx_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user vector, item vector) training pairs: even id = user side, the next odd id = item side."""
    v = fx_vec(spark, sf_dir)
    u = v.filter(F.col("vec_id") % 2 == 0).select(
        F.col("vec_id").alias("u_id"), F.col("v").alias("uv"))
    i = v.filter(F.col("vec_id") % 2 == 1).select(
        (F.col("vec_id") - 1).alias("u_id"), F.col("vec_id").alias("i_id"), F.col("v").alias("iv"))
    j = u.join(i, "u_id")
    k = F.floor(F.col("u_id") / 2).cast("bigint")
    return j.select(
        k.alias("k"), F.floor(k / 16).cast("bigint").alias("batch_id"), "uv", "iv",
        (F.lit(0.5) + (F.col("i_id") % 7) / F.lit(14.0)).alias("weight"),
        (F.lit(0.5) * (1 + k % 10)).alias("rating"),
    )


def fx_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("metric"),
        F.col("event_id").alias("step"), "value", (F.col("user_id") % 2).alias("arch"))


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User embedding table: even vector ids, user_id = vec_id / 2."""
    v = fx_vec(spark, sf_dir)
    return v.filter(F.col("vec_id") % 2 == 0).select(
        F.floor(F.col("vec_id") / 2).cast("int").alias("user_id"), F.col("v").alias("u"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item embedding table: odd vector ids, movie_id = vec_id / 2, genre = vocabulary[label]."""
    v = fx_vec(spark, sf_dir)
    return v.filter(F.col("vec_id") % 2 == 1).select(
        F.floor(F.col("vec_id") / 2).cast("int").alias("movie_id"),
        F.get(genre_vocab_col(), F.col("label")).alias("genre"),
        F.col("v").alias("i"))


def fx_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per events user: started at its first event; experiment = type of that first event;
    architecture from the user's parity; distillation and sweep tags from its event count."""
    ev = table(spark, sf_dir, "events")
    g = ev.groupBy("user_id").agg(
        F.min("ts").alias("start_time"),
        F.min(F.struct("ts", "event_id", "event_type")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    return g.select(
        F.col("user_id").alias("run_id"), "start_time", F.col("first.event_type").alias("experiment"),
        F.when(F.col("user_id") % 2 == 0, F.lit("TwoTower")).otherwise(F.lit("InfoNCEEncoder")).alias("architecture"),
        F.when(F.col("n") % 3 == 0, F.lit("self")).when(F.col("n") % 3 == 1, F.lit("cross"))
        .otherwise(F.lit("none")).alias("distillation_type"),
        F.when(F.col("n") % 2 == 0, F.lit("sweep_trial")).otherwise(F.lit("")).alias("sweep"))


# ---------------------------------------------------------------- stand-ins for trained weights, by a rule that SQL can rebuild

def rule_matrix(rows: int, cols: int, a: int, b: int) -> np.ndarray:
    """((r * a + c * b) mod 97 - 48) / 97 / sqrt(cols)."""
    r = np.arange(rows)[:, None]
    c = np.arange(cols)[None, :]
    return (((r * a + c * b) % 97) - 48) / 97.0 / math.sqrt(cols)


def learned_head_weights(dim: int, hidden: int = 64) -> dict[str, np.ndarray]:
    return {"w1": rule_matrix(hidden, 2 * dim, 31, 17), "b1": (np.arange(hidden) % 7 - 3) / 70.0,
            "w2": rule_matrix(1, hidden, 13, 29), "b2": np.array([0.01])}


def _mlp_weights(input_dim: int, hidden: list[int], output_dim: int, salt: int = 0) -> list[dict]:
    layers, d = [], input_dim
    for n, h in enumerate(hidden + [output_dim]):
        layers.append({"w": rule_matrix(h, d, 31 + n + salt, 17 + 2 * n), "b": (np.arange(h) % 5 - 2) / 50.0})
        d = h
    return layers


def tower_weights(embed_dim: int = 64, hidden=(256, 128), output_dim: int = 128, history_dim: int = 32) -> dict:
    n_genres = 20
    return {"user_mlp": _mlp_weights(embed_dim + n_genres + history_dim + 2, list(hidden), output_dim, salt=0),
            "item_mlp": _mlp_weights(embed_dim + n_genres + 1, list(hidden), output_dim, salt=7),
            "history": {"w": rule_matrix(history_dim, n_genres, 11, 5), "b": np.zeros(history_dim)},
            "embed_dim": embed_dim, "output_dim": output_dim}
