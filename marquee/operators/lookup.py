"""Batch lookups against the serving tables: a request table joined to precomputed rows.

Serving rows: (user_id, genre, model_name, scoring_method, movie_ids[], scores[]) and cold-start rows
without user_id. A request without genre takes the row of the lowest vocabulary genre.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.vocab import GENRE_VOCAB, genre_vocab_col

# FIXED VALUES: the two models compared by the A/B assignment
MODEL_A = "TwoTower_TimedecayMSELoss"
MODEL_B = "InfoNCEEncoder_TimedecayInfoNCELoss"
DEFAULT_TOP_N = 10
MAX_TOP_N = 100


def _vocab_pos(genre_col):
    p = F.array_position(genre_vocab_col(), genre_col)
    return F.when(p == 0, F.lit(len(GENRE_VOCAB) + 1)).otherwise(p)


def _with_first_genre(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Rows beside the lowest vocabulary genre of their key: a window over the shuffle that the lookup's join needs anyway, so
    the rows, which may be a whole precomputation, are computed once."""
    place = F.min(F.struct(_vocab_pos(F.col("genre")).alias("vp"), F.col("genre").alias("g"))).over(Window.partitionBy(*keys))  # a row a genre
    return rows.withColumn(out, place["g"])


def _pick_rows(req: DataFrame, rows: DataFrame, keys: list[str], req_id: str) -> DataFrame:
    """Join requests to rows on keys; keep the request's genre, or the lowest vocabulary genre if none. Which side is
    small enough to be sent around is the optimizer's business at run time."""
    lists = _with_first_genre(rows.select(*keys, "genre", "movie_ids", "scores"), keys, "first_genre").withColumnRenamed("genre", "row_genre")
    j = req.join(lists, on=keys, how="inner").where(F.coalesce("genre", "first_genre") == F.col("row_genre"))
    return j.select(req_id, *keys, "top_n", F.col("row_genre").alias("genre"), F.slice("movie_ids", 1, F.col("top_n")).alias("movie_ids"),
                    F.slice("scores", 1, F.col("top_n")).alias("scores"))


def with_request_defaults(req: DataFrame) -> DataFrame:
    """Every request with genre, top_n, scoring_method and model_name; a null or absent one takes the default."""
    defaults = {"genre": F.lit(None).cast("string"), "top_n": F.lit(DEFAULT_TOP_N), "scoring_method": F.lit("cosine"),
                "model_name": F.lit(MODEL_A)}
    out = req
    for c, default in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), default) if c in req.columns else default)
    return out.withColumn("top_n", F.col("top_n").cast("int"))


def bad_requests(req: DataFrame, req_id: str = "request_id") -> DataFrame:
    """(request, error) of the requests that no lookup serves: top_n outside 1..MAX_TOP_N or an unknown genre."""
    q = with_request_defaults(req)
    known = F.col("genre").isNull() | F.array_contains(genre_vocab_col(), F.col("genre"))
    error = (F.when(~F.col("top_n").between(1, MAX_TOP_N), F.concat(F.lit("top_n "), F.col("top_n"), F.lit(f" is outside 1..{MAX_TOP_N}")))
             .when(~known, F.concat(F.lit("unknown genre "), F.col("genre"))))
    return q.select(req_id, error.alias("error")).where("error is not null")


def _served(req: DataFrame) -> DataFrame:
    return with_request_defaults(req).where(F.col("top_n").between(1, MAX_TOP_N))


def lookup_user(serving: DataFrame, requests: DataFrame, req_id: str = "request_id") -> DataFrame:
    """Personalised rows for (user, model, method[, genre]); first top_n of both arrays. Requests outside the
    bounds have no row here and one in ``bad_requests``."""
    return _pick_rows(_served(requests), serving, ["user_id", "model_name", "scoring_method"], req_id)


def lookup_cold_start(cold: DataFrame, requests: DataFrame, req_id: str = "request_id") -> DataFrame:
    """Cold-start rows per request (genre x method x model)."""
    return _pick_rows(_served(requests), cold, ["model_name", "scoring_method"], req_id)


def batch_recommend(serving: DataFrame, cold: DataFrame, requests: DataFrame, req_id: str = "request_id") -> DataFrame:
    """Exactly one row per request: the personalised list (source 'personal'), else the cold-start list for the same
    model, method and genre ('cold_start'), else nothing found ('none', null lists), or 'invalid' if out of bounds."""
    q = with_request_defaults(requests)
    valid = F.col("top_n").between(1, MAX_TOP_N)
    for prefix, rows, keys in (("p", serving, ["user_id", "model_name", "scoring_method"]), ("c", cold, ["model_name", "scoring_method"])):
        lists = _with_first_genre(rows.select(*keys, "genre", "movie_ids", "scores"), keys, "first").select(
            *[F.col(k).alias(f"{prefix}_{k}") for k in keys], F.col("first").alias(f"{prefix}_first"), F.struct("genre", "movie_ids", "scores").alias(prefix))
        own = [F.col(k) == F.col(f"{prefix}_{k}") for k in keys] + [F.coalesce("genre", f"{prefix}_first") == F.col(f"{prefix}.genre")]
        q = q.join(lists, reduce(lambda a, b: a & b, own), "left")
    found = F.when(valid, F.coalesce("p", "c"))
    source = (F.when(~valid, "invalid").when(F.col("p").isNotNull(), "personal").when(F.col("c").isNotNull(), "cold_start")
              .otherwise("none"))
    return q.select(req_id, "user_id", "model_name", "scoring_method", "top_n", F.coalesce(found["genre"], F.col("genre")).alias("genre"),
                    F.slice(found["movie_ids"], 1, F.greatest("top_n", F.lit(1))).alias("movie_ids"),
                    F.slice(found["scores"], 1, F.greatest("top_n", F.lit(1))).alias("scores"), source.alias("source"))


def multi_model_recommend(serving: DataFrame, requests: DataFrame, models: list[str],
                          req_id: str = "request_id") -> DataFrame:
    """One result per requested model that has a row; models without rows are skipped."""
    base = requests.drop("model_name") if "model_name" in requests.columns else requests
    fanned = base.withColumn("model_name", F.explode(F.array(*[F.lit(m) for m in models])))
    return lookup_user(serving, fanned, req_id)


def explode_recs(recs: DataFrame, keys: list[str]) -> DataFrame:
    z = recs.select(*keys, F.posexplode(F.arrays_zip("movie_ids", "scores")).alias("pos", "z"))
    return z.select(*keys, "pos", F.col("z.movie_ids").alias("movie_id"), F.col("z.scores").alias("score"))


def top_genres(uf: DataFrame, k: int = 2) -> DataFrame:
    """(user_id, genre, rank): the k highest positive affinities, ties in vocabulary order. The array is sorted in its
    row; only k entries of it are exploded."""
    vocab = genre_vocab_col()
    entry = F.transform("genre_affinity", lambda v, i: F.struct((-v).alias("nv"), i.alias("pos")))
    best = F.slice(F.array_sort(F.filter(entry, lambda e: e["nv"] < 0)), 1, k)
    e = uf.select("user_id", F.posexplode(best).alias("n", "e"))
    return e.select("user_id", F.get(vocab, F.col("e.pos")).alias("genre"), (F.col("n") + 1).alias("rank"))


def explain(recs_long: DataFrame, uf: DataFrame, itf: DataFrame, cold_genre: str | None = None,
            cold_genre_col: str | None = None) -> DataFrame:
    """Per recommended item: reason ('affinity' | 'cold_start' | 'embedding'), overlap list, 3-decimal score.

    The cold-start genre is either one value for all rows or, for a batch of cold-start requests, a
    column of recs_long (each request's own genre; null = none)."""
    vocab = genre_vocab_col()
    tops = top_genres(uf).groupBy("user_id").agg(F.collect_list("genre").alias("top"))
    item_g = itf.select("movie_id", F.filter(F.transform(
        F.arrays_zip(vocab.alias("g"), F.col("genre_multihot").alias("x")),
        lambda s: F.when(s["x"] > 0, s["g"])), lambda g: g.isNotNull()).alias("item_genres"))
    j = recs_long.join(tops, "user_id", "left").join(item_g, "movie_id", "left")
    cold = F.col(cold_genre_col) if cold_genre_col else F.lit(cold_genre).cast("string")
    overlap = F.array_sort(F.array_intersect(F.coalesce("top", F.array().cast("array<string>")),
                                             F.coalesce("item_genres", F.array().cast("array<string>"))))
    reason = (F.when(F.size(overlap) > 0, F.lit("affinity"))
              .when(cold.isNotNull(), F.lit("cold_start")).otherwise(F.lit("embedding")))
    return j.select(*recs_long.columns, reason.alias("reason"), F.array_join(overlap, ", ").alias("overlap"),
                    F.round("score", 3).alias("score3"))


def enrich_recs(recs_long: DataFrame, mv: DataFrame, itf: DataFrame) -> DataFrame:
    """Exploded recommendations with title and release year (left joins: unknown items keep nulls)."""
    return (recs_long.join(mv.select("movie_id", "title"), "movie_id", "left")
            .join(itf.select("movie_id", F.col("release_year").alias("year")), "movie_id", "left"))


def ab_assign(users: DataFrame) -> DataFrame:
    return users.select("user_id", F.when(F.col("user_id") % 2 == 0, F.lit(MODEL_A)).otherwise(F.lit(MODEL_B))
                        .alias("assigned_model"))


def ab_compare(serving: DataFrame, users: DataFrame, req_id: str = "user_id") -> DataFrame:
    """Both models' cosine lists for each user, plus the user's assignment."""
    req = users.select("user_id").withColumn("request_id", F.col("user_id"))
    both = multi_model_recommend(serving, req.withColumn("scoring_method", F.lit("cosine")), [MODEL_A, MODEL_B])
    return both.join(ab_assign(users.select("user_id")), "user_id")


def search_titles(mv: DataFrame, itf: DataFrame, q: str, limit: int = 10) -> DataFrame:
    """Case-insensitive contains ('%' and '_' in q act as wildcards), ordered by movie_id; a limit outside 1..50 raises."""
    if not 1 <= int(limit) <= 50:
        raise ValueError(f"limit {limit} is outside 1..50")
    hits = mv.filter(F.col("title").ilike(f"%{q}%")).select("movie_id", "title")
    return (hits.join(itf.select("movie_id", F.col("release_year").alias("year")), "movie_id", "left")
            .orderBy("movie_id").limit(limit))
