"""Feature queries (user and item features and their parts)."""
from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.text import extract_year
from marquee.operators import features as fe
from marquee.plans import data
from marquee.plans.catalog import R, query
from marquee.plans.oracle_views import VOCAB, with_views as W

_TFIDF_CTES = [
    ("docs", "select movie_id, tag from fx_tags where movie_id in (select movie_id from fx_movies) and tag is not null"),
    ("tok", "select movie_id, unnest(regexp_extract_all(lower(tag), '[\\p{L}\\p{N}_]{2,}')) as term from docs"),
    ("tf", "select movie_id, term, count(*) as tf from tok group by movie_id, term"),
    ("vocab", "select term, sum(tf) as cf, count(*) as df from tf group by term order by cf desc, term asc limit 100"),
    ("nd", "select count(distinct movie_id) as n from fx_movies"),
    ("rawx", "select tf.movie_id, tf.term, tf.tf * (ln((1.0e0 + nd.n) / (1.0e0 + v.df)) + 1.0e0) as x "
             "from tf join vocab v on tf.term = v.term cross join nd"),
    ("norms", "select movie_id, sqrt(sum(x * x)) as n from rawx group by movie_id"),
    ("tfidf", "select r.movie_id, r.term, r.x / n.n as tfidf from rawx r join norms n on r.movie_id = n.movie_id "
              "where r.x / n.n > 0"),
]


@query("extract_year", W("fx_movies") + """
select movie_id, cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') as int) as release_year
from fx_movies""")
def q_extract_year(spark, d):
    return data.movies(spark, d).select("movie_id", extract_year("title").alias("release_year"))


@query("time_bounds", W("bounds") + "select t_min, t_max, t_range from bounds")
def q_time_bounds(spark, d):
    return fe.time_bounds(data.ratings(spark, d))


@query("time_decay_weight", W("wrk") + "select id, round(weight, 6) as weight from wrk")
def q_time_decay_weight(spark, d):
    return fe.time_decay_weight(data.ratings(spark, d)).select("id", R("weight").alias("weight"))


@query("explode_genres", W("mg") + "select movie_id, genre from mg")
def q_explode_genres(spark, d):
    return fe.explode_genres(data.movies(spark, d))


@query("decayed_history", W("wrk") + "select user_id, movie_id, round(weight * rating, 6) as value from wrk")
def q_decayed_history(spark, d):
    return fe.decayed_history(data.ratings(spark, d)).select("user_id", "movie_id", R("value").alias("value"))


_AFF = [("tw", "select user_id, sum(weight) as total_weight from wrk group by user_id"),
        ("gw", "select w.user_id, g.genre, sum(w.weight) as genre_weight from wrk w join mg g "
               "on w.movie_id = g.movie_id group by w.user_id, g.genre"),
        ("aff", "select gw.user_id, gw.genre, gw.genre_weight / tw.total_weight as affinity "
                "from gw join tw on gw.user_id = tw.user_id")]


@query("genre_affinity", W("wrk", "mg", extra=_AFF) + "select user_id, genre, round(affinity, 6) as affinity from aff")
def q_genre_affinity(spark, d):
    a = fe.genre_affinity(data.ratings(spark, d), data.movies(spark, d))
    return a.select("user_id", "genre", R("affinity").alias("affinity"))


@query("genre_affinity_vector", W("wrk", "mg", extra=_AFF + [
    ("users", "select distinct user_id from aff"),
    ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre")]) + """
select u.user_id, s.pos, round(coalesce(a.affinity, 0.0e0), 6) as value
from users u cross join slots s left join aff a on a.user_id = u.user_id and a.genre = s.genre""")
def q_genre_affinity_vector(spark, d):
    v = fe.genre_affinity_vector(fe.genre_affinity(data.ratings(spark, d), data.movies(spark, d)))
    return v.select("user_id", F.posexplode("genre_affinity").alias("pos", "value")).select(
        "user_id", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


@query("rating_stats", W("rk") + """
select user_id, count(*) as rating_count, round(avg(rating), 6) as avg_rating from rk group by user_id""")
def q_rating_stats(spark, d):
    return fe.rating_stats(data.ratings(spark, d)).select("user_id", "rating_count", R("avg_rating").alias("avg_rating"))


@query("user_features", W("wrk", "mg", extra=_AFF + [
    ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre"),
    ("per_user", "select user_id, count(*) as rating_count, avg(rating) as avg_rating, count(*) as history_items, "
                 "sum(weight * rating) as history_sum from wrk group by user_id")]) + """
select u.user_id, rating_count, round(avg_rating, 6) as avg_rating, history_items, round(history_sum, 6) as history_sum, s.pos,
       round(coalesce(aff.affinity, 0.0e0), 6) as affinity
from per_user u cross join slots s left join aff on aff.user_id = u.user_id and aff.genre = s.genre""")
def q_user_features(spark, d):
    """Every slot of the affinity vector, in long form."""
    uf = fe.user_features(data.ratings_table(spark, d), data.movies(spark, d))
    return uf.select("user_id", "rating_count", R("avg_rating").alias("avg_rating"), "history_items", R("history_sum").alias("history_sum"),
                     F.posexplode("genre_affinity").alias("pos", "affinity")).withColumn("pos", F.col("pos").cast("bigint")).withColumn(
        "affinity", R("affinity"))


@query("features_with_history", W("wrk", "mg", extra=_AFF) + """
select w.user_id, w.movie_id, round(w.weight * w.rating, 6) as value, n.n as rating_count
from wrk w join (select user_id, count(*) as n from wrk group by user_id) n on n.user_id = w.user_id""")
def q_features_with_history(spark, d):
    """The decayed history (long table) next to the user's feature row."""
    rk = data.ratings_table(spark, d)
    uf = fe.user_features(rk, data.movies(spark, d)).select("user_id", "rating_count")
    return fe.decayed_history(rk).join(uf, "user_id").select("user_id", "movie_id", R("value").alias("value"), "rating_count")


@query("genre_multihot", W("fx_movies", extra=[
    ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre")]) + """
select m.movie_id, s.pos,
       case when list_contains(string_split(m.genres, '|'), s.genre) then 1.0e0 else 0.0e0 end as value
from fx_movies m cross join slots s""")
def q_genre_multihot(spark, d):
    mh = fe.genre_multihot(data.movies(spark, d))
    return mh.select("movie_id", F.posexplode("genre_multihot").alias("pos", "value")).select(
        "movie_id", F.col("pos").cast("bigint").alias("pos"), "value")


@query("tag_documents", W("fx_movies", "fx_tags", extra=_TFIDF_CTES[:2] + [
    ("nt", "select movie_id, count(*) as n_tags from docs group by movie_id"),
    ("nk", "select movie_id, count(*) as n_tokens from tok group by movie_id")]) + """
select m.movie_id, coalesce(nt.n_tags, 0) as n_tags, coalesce(nk.n_tokens, 0) as n_tokens
from fx_movies m left join nt on m.movie_id = nt.movie_id left join nk on m.movie_id = nk.movie_id""")
def q_tag_documents(spark, d):
    mv, tg = data.movies(spark, d), data.tags(spark, d)
    nt = tg.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_tags"))
    nk = fe.tag_tokens(tg, mv).groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_tokens"))
    return (mv.select("movie_id").join(nt, "movie_id", "left").join(nk, "movie_id", "left")
            .select("movie_id", F.coalesce("n_tags", F.lit(0)).alias("n_tags"),
                    F.coalesce("n_tokens", F.lit(0)).alias("n_tokens")))


@query("tag_tfidf", W("fx_movies", "fx_tags", extra=_TFIDF_CTES) +
       "select movie_id, term, round(tfidf, 6) as tfidf from tfidf")
def q_tag_tfidf(spark, d):
    t = fe.tag_tfidf(data.tags(spark, d), data.movies(spark, d), spread=data.spread_of(spark, d, "documents"))
    return t.select("movie_id", "term", R("tfidf").alias("tfidf"))


@query("item_features", W("fx_movies", "fx_tags", extra=_TFIDF_CTES + [
    ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre"),
    ("years", "select movie_id, cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') as int) as release_year, genres from fx_movies")]) + """
select y.movie_id, y.release_year, cast(s.pos as varchar) as name,
       case when list_contains(string_split(y.genres, '|'), s.genre) then 1.0e0 else 0.0e0 end as value from years y cross join slots s
union all select y.movie_id, y.release_year, 'term:' || t.term, round(t.tfidf, 6) from years y join tfidf t on t.movie_id = y.movie_id""")
def q_item_features(spark, d):
    """Every value of the vectors, in long form: genre slots by their place, terms by name."""
    itf = fe.item_features(data.movies(spark, d), data.tags(spark, d), spread=data.spread_of(spark, d, "documents"))
    slots = F.transform("genre_multihot", lambda x, i: F.struct(i.cast("string").alias("name"), x.alias("value")))
    terms = F.transform(F.map_entries("tag_tfidf"), lambda e: F.struct(F.concat(F.lit("term:"), e["key"]).alias("name"), e["value"].alias("value")))
    return itf.select("movie_id", "release_year", F.explode(F.concat(slots, terms)).alias("v")).select(
        "movie_id", "release_year", F.col("v.name").alias("name"), R("v.value").alias("value"))


@query("feature_counts", W("rk", "fx_movies") + """
select 'users' as kind, count(distinct user_id) as n from rk
union all select 'items' as kind, count(*) as n from fx_movies""")
def q_feature_counts(spark, d):
    rk, mv = data.ratings(spark, d), data.movies(spark, d)
    return fe.feature_counts(rk.select("user_id").distinct(), mv)  # one feature row per rating user and per movie


@query("write_features", W("wrk", "fx_ratings") + """
select user_id, count(*) as rating_count, round(avg(rating), 6) as avg_rating from rk group by user_id""")
def q_write_features(spark, d):
    """Features of a first load, then upserted with a full recompute: changed users replaced, others kept."""
    from marquee.operators import merge
    from marquee.plans.q_ingest import _first_load
    mv = data.movies(spark, d)
    prev = fe.user_features(_first_load(spark, d), mv).withColumn("version", F.lit(1))
    cur = fe.user_features(data.ratings(spark, d), mv).withColumn("version", F.lit(2))
    out = merge.merge_upsert(prev, cur, ["user_id"], "version")
    return out.select("user_id", "rating_count", R("avg_rating").alias("avg_rating"))


@query("load_item_features", W("fx_movies") + """
select movie_id, cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') as int) as release_year from fx_movies""")
def q_load_item_features(spark, d):
    """Write item features to Parquet and load them back projected (only the needed columns are read)."""
    from marquee.session import scratch_path
    path = scratch_path(spark, "item-features")
    fe.item_features(data.movies(spark, d), data.tags(spark, d)).write.parquet(path)
    return fe.load_features(spark, path, ["movie_id", "release_year"])


@query("load_user_features", W("rk") + """
select user_id, count(*) as rating_count from rk group by user_id""")
def q_load_user_features(spark, d):
    """Write user features to Parquet and load them back projected."""
    from marquee.session import scratch_path
    path = scratch_path(spark, "user-features")
    fe.user_features(data.ratings(spark, d), data.movies(spark, d)).write.parquet(path)
    return fe.load_features(spark, path, ["user_id", "rating_count"])
