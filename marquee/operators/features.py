"""User and item features: time-decayed history, genre affinity, rating stats, multi-hot, tag TF-IDF, year.

All work is grouped aggregation over exploded rows (partial aggregation before each shuffle);
the only scalars pulled to the driver are the global time bounds (one row).
"""
from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import extract_year, tokens
from marquee.functions.vocab import GENRE_VOCAB, genre_vocab_col
from marquee.session import materialize


# ---------------------------------------------------------------- time decay

def time_bounds(rk: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Global (t_min, t_max, t_range) with t_range >= 1."""
    return rk.agg(F.min(ts).alias("t_min"), F.max(ts).alias("t_max")).select(
        "t_min", "t_max", F.greatest(F.col("t_max") - F.col("t_min"), F.lit(1)).alias("t_range"))


def _bounds(rk: DataFrame, ts: str = "timestamp") -> tuple[int, int]:
    row = time_bounds(rk, ts).first()
    if row is None or row["t_max"] is None:
        return 0, 1
    return int(row["t_max"]), int(row["t_range"])


def time_decay_weight(rk: DataFrame, lam: float = 0.1, ts: str = "timestamp",
                      bounds: tuple[int, int] | None = None, out: str = "weight") -> DataFrame:
    """weight = exp(-lam * (1 - (t - (t_max - t_range)) / t_range)); recent rows weigh about 1."""
    t_max, t_range = bounds or _bounds(rk, ts)
    norm = (F.col(ts) - F.lit(t_max - t_range)) / F.lit(float(t_range))
    return rk.withColumn(out, F.exp(F.lit(-lam) * (F.lit(1.0) - norm)))


# ---------------------------------------------------------------- genres

def explode_genres(mv: DataFrame) -> DataFrame:
    """(movie_id, genre) for every '|'-separated genre, duplicates and unknown names kept."""
    return mv.select("movie_id", F.explode(F.split(F.col("genres"), r"[|]")).alias("genre"))


def genre_membership_from_movies(mv: DataFrame) -> DataFrame:
    """(movie_id, genre) for vocabulary genres present on the movie (the multi-hot > 0 slots)."""
    return (explode_genres(mv).filter(F.col("genre").isin(GENRE_VOCAB)).distinct())


def decayed_history(rk: DataFrame, lam: float = 0.1, bounds=None) -> DataFrame:
    """Long form (user_id, movie_id, value = weight * rating)."""
    w = time_decay_weight(rk, lam, bounds=bounds)
    return w.select("user_id", "movie_id", (F.col("weight") * F.col("rating")).alias("value"))


def genre_affinity(rk: DataFrame, mv: DataFrame, lam: float = 0.1, bounds=None) -> DataFrame:
    """(user_id, genre, affinity): decayed weight on the genre / decayed weight of all the user's ratings."""
    w = time_decay_weight(rk, lam, bounds=bounds).select("user_id", "movie_id", "weight")
    total = w.groupBy("user_id").agg(F.sum("weight").alias("total_weight"))
    per_genre = (w.join(explode_genres(mv), "movie_id", "inner")
                 .groupBy("user_id", "genre").agg(F.sum("weight").alias("genre_weight")))
    return (per_genre.join(total, "user_id")
            .select("user_id", "genre", (F.col("genre_weight") / F.col("total_weight")).alias("affinity")))


def genre_affinity_vector(affinity: DataFrame) -> DataFrame:
    """(user_id, genre_affinity array[20]) in vocabulary order, 0.0 where absent.

    Only vocabulary genres are gathered, so each user's list holds at most 20 entries."""
    inv = affinity.filter(F.col("genre").isin(GENRE_VOCAB))
    m = inv.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("genre", "affinity"))).alias("m"))
    return m.select("user_id", F.transform(genre_vocab_col(),
                                           lambda g: F.coalesce(F.try_element_at(F.col("m"), g), F.lit(0.0)))
                    .alias("genre_affinity"))


def rating_stats(rk: DataFrame) -> DataFrame:
    return rk.groupBy("user_id").agg(F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("avg_rating"))


def user_features(rk: DataFrame, mv: DataFrame, lam: float = 0.1) -> DataFrame:
    """One row per rating user: 20-slot genre_affinity, rating_count, avg_rating, and a summary of the
    decayed history (history_items, history_sum).

    The history itself (movie -> weight * rating) stays a long table, ``decayed_history``: a per-user
    map would put a heavy user's whole history into one row."""
    w = time_decay_weight(rk, lam, bounds=_bounds(rk))
    per_user = w.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("avg_rating"), F.sum("weight").alias("total_weight"),
        F.count(F.lit(1)).alias("history_items"), F.sum(F.col("weight") * F.col("rating")).alias("history_sum"))
    # the vocabulary genres of a user, summed before the shuffle; at most 20 entries each
    genres = explode_genres(mv).filter(F.col("genre").isin(GENRE_VOCAB))
    per_genre = w.select("user_id", "movie_id", "weight").join(genres, "movie_id").groupBy("user_id", "genre").agg(F.sum("weight").alias("gw"))
    sums = per_genre.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("genre", "gw"))).alias("m"))
    affinity = F.transform(genre_vocab_col(), lambda g: F.coalesce(F.try_element_at("m", g) / F.col("total_weight"), F.lit(0.0)))
    return (per_user.join(sums, "user_id", "left")
            .select("user_id", affinity.alias("genre_affinity"), "rating_count", "avg_rating", "history_items", "history_sum"))


# ---------------------------------------------------------------- items

def genre_multihot(mv: DataFrame) -> DataFrame:
    return mv.select("movie_id", _multihot().alias("genre_multihot"))


def tag_terms(tags: DataFrame, mv: DataFrame, spread: int | None = None) -> DataFrame:
    """(movie_id, terms) of every tag of a known movie; spread: deal the texts to so many tasks first, for sources with fewer splits
    than there are cores."""
    known = tags.join(mv.select("movie_id").distinct(), "movie_id", "left_semi").select("movie_id", "tag")
    known = known.repartition(spread) if spread else known
    return known.select("movie_id", tokens("tag").alias("terms")).where(F.size("terms") > 0)


def tag_tokens(tags: DataFrame, mv: DataFrame) -> DataFrame:
    """(movie_id, term) per token occurrence; tags of unknown movies are ignored."""
    return tag_terms(tags, mv).select("movie_id", F.explode("terms").alias("term"))


#: Terms that a task's summary holds at least, in pass 1.
SUMMARY_TERMS = 50_000


def _summary(capacity: int):
    """A task's Misra-Gries summary of the terms of its rows: (term, n, 0) with n at most the count, and one row (null, 0, error): no
    term's count exceeds its n (0 if it is not there) by more than the error."""
    def run(batches):
        counts: dict[str, int] = {}
        error = 0

        def prune() -> int:
            cut = sorted(counts.values(), reverse=True)[capacity]
            for t in [t for t, n in counts.items() if n <= cut]:
                del counts[t]
            for t in counts:
                counts[t] -= cut
            return cut

        for b in batches:
            found = pc.value_counts(b.column(0).flatten())
            for t, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[t] = counts.get(t, 0) + n
            if len(counts) > 2 * capacity:
                error += prune()
        if len(counts) > capacity:
            error += prune()
        rows = [*((t, n, 0) for t, n in counts.items()), (None, 0, error)]
        for s in range(0, len(rows), 10_000):
            part = list(zip(*rows[s:s + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.string()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64())], ["term", "n", "error"])

    return run


def frequent_terms(rows: DataFrame, k: int, capacity: int | None = None) -> list[str]:
    """The k most frequent terms of rows (terms array<string>), ties by term, exactly.

    Tasks send bounded summaries instead of all their terms. With T the kth largest merged count and E the sum of the tasks' errors, a
    term outside the candidates (count + E >= T) has a true count below T, so only the candidates are counted anew; without
    errors the counts are exact already, and only where E reaches T (nothing is frequent) are all terms counted."""
    capacity = max(capacity or SUMMARY_TERMS, k)
    summary = materialize(rows.select("terms").mapInArrow(_summary(capacity), "term string, n long, error long"), "term-summaries")
    merged = summary.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("n"))
    error = summary.agg(F.sum("error")).first()[0] or 0
    top = merged.orderBy(F.desc("n"), "term").limit(k).collect()  # k rows
    if not error:
        return [r["term"] for r in top]
    least = top[-1]["n"] if len(top) == k else 0
    terms = rows.select(F.explode("terms").alias("term"))
    if error < least:
        terms = terms.join(merged.where(F.col("n") + error >= least).select("term"), "term", "left_semi")
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return [r["term"] for r in counts.orderBy(F.desc("n"), "term").limit(k).collect()]


def tag_tfidf(tags: DataFrame, mv: DataFrame, max_features: int = 100, capacity: int | None = None, spread: int | None = None) -> DataFrame:
    """Long form (movie_id, term, tfidf): smoothed idf over all movies, L2-normalised over kept terms, > 0 only.

    Texts are tokenised once and the tokens written. Pass 1 finds the max_features most frequent terms from bounded summaries
    (frequent_terms). Pass 2 drops all other tokens inside their array, before anything is exploded, so counts, document
    frequencies and norms come from at most max_features rows per movie; its aggregation is shared by the idf and the weights."""
    rows = materialize(tag_terms(tags, mv, spread), "tag-terms")
    vocab = frequent_terms(rows, max_features, capacity)  # the vocabulary
    kept = rows.select("movie_id", F.filter("terms", lambda t: t.isin(vocab)).alias("terms")).where(F.size("terms") > 0)
    tf = kept.select("movie_id", F.explode("terms").alias("term")).groupBy("movie_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    n_docs = mv.agg(F.countDistinct("movie_id").alias("n_docs")).first()[0]
    idf = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
           .select("term", (F.log((1.0 + F.lit(n_docs)) / (1.0 + F.col("df"))) + 1.0).alias("idf")))
    raw = tf.join(F.broadcast(idf), "term").select("movie_id", "term", (F.col("tf") * F.col("idf")).alias("x"))  # max_features rows
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("movie_id")))
    return raw.select("movie_id", "term", (F.col("x") / norm).alias("tfidf")).filter(F.col("tfidf") > 0)


def _multihot():
    parts = F.split(F.col("genres"), r"[|]")
    return F.transform(genre_vocab_col(), lambda g: F.when(F.array_contains(parts, g), F.lit(1.0)).otherwise(F.lit(0.0)))


def item_base_features(mv: DataFrame) -> DataFrame:
    """(movie_id, genre_multihot[20], release_year): the item features that need no tags."""
    return mv.select("movie_id", _multihot().alias("genre_multihot"), extract_year("title").alias("release_year"))


def item_features(mv: DataFrame, tags: DataFrame, max_features: int = 100, spread: int | None = None) -> DataFrame:
    """One row per movie: genre_multihot[20], tag_tfidf map (empty when no terms), release_year.

    A movie's map holds at most max_features terms (the vocabulary size), so the gather is bounded."""
    tfidf = (tag_tfidf(tags, mv, max_features, spread=spread).groupBy("movie_id")
             .agg(F.map_from_entries(F.collect_list(F.struct("term", "tfidf"))).alias("tag_tfidf")))
    base = item_base_features(mv)
    empty = F.create_map().cast("map<string,double>")
    return (base.join(tfidf, "movie_id", "left")
            .select("movie_id", "genre_multihot", F.coalesce("tag_tfidf", empty).alias("tag_tfidf"), "release_year"))


def feature_counts(uf: DataFrame, itf: DataFrame) -> DataFrame:
    u = uf.agg(F.count(F.lit(1)).alias("n")).select(F.lit("users").alias("kind"), "n")
    i = itf.agg(F.count(F.lit(1)).alias("n")).select(F.lit("items").alias("kind"), "n")
    return u.unionByName(i)


def load_features(spark, path: str, columns: list[str]) -> DataFrame:
    """Projected scan of a written feature table (column pruning reaches the Parquet reader)."""
    return spark.read.parquet(path).select(*columns)
