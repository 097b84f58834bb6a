"""Split and training-sample queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import features as fe
from marquee.operators import samples as sm
from marquee.operators import split as sp
from marquee.plans import data
from marquee.session import materialize
from marquee.plans.catalog import R, query
from marquee.plans.oracle_views import VOCAB, with_views as W
from marquee.sources import fixtures as fx

_SPLIT = [
    ("gi", "select id, row_number() over (order by timestamp, id) - 1 as idx, count(*) over () as n from rk"),
    ("sp", "select id as rating_id, case when idx < cast(floor(n * 0.8e0) as bigint) then 'train' "
           "when idx < cast(floor(n * 0.8e0) as bigint) + cast(floor(n * 0.1e0) as bigint) then 'val' "
           "else 'test' end as split from gi"),
    ("lsp", "select rk.*, sp.split from rk join sp on rk.id = sp.rating_id"),
    ("sb", "select split, min(timestamp) as tmin, greatest(max(timestamp) - min(timestamp), 1) as rng "
           "from lsp group by split"),
    ("wsp", "select l.*, exp(-0.1e0 * (1.0e0 - (l.timestamp - sb.tmin) / cast(sb.rng as double))) as weight "
            "from lsp l join sb on l.split = sb.split"),
    ("demo", "select split, user_id, movie_id as demo_movie_id, rating as demo_rating, id as demo_id from ("
             "select *, row_number() over (partition by split, user_id order by rating desc, timestamp desc, id asc) "
             "as rn_ from lsp) where rn_ = 1"),
]


def _split(spark, d):
    return sp.temporal_split(data.ratings_table(spark, d))  # read a few times by the selection


def _lsp(spark, d):
    return sp.load_splits(data.ratings(spark, d), _split(spark, d))


@query("with_global_index", W("rk", extra=_SPLIT[:1]) + "select id, idx from gi")
def q_with_global_index(spark, d):
    return sp.with_global_index(data.ratings(spark, d).select("id", "timestamp"), ["timestamp", "id"]).select("id", "idx")


@query("temporal_split", W("rk", extra=_SPLIT[:2]) + "select rating_id, split from sp")
def q_temporal_split(spark, d):
    return _split(spark, d)


@query("split_counts", W("rk", extra=_SPLIT[:2]) + "select split, count(*) as n from sp group by split")
def q_split_counts(spark, d):
    return sp.split_counts(_split(spark, d))


@query("load_splits", W("rk", extra=_SPLIT[:3]) + "select id, user_id, movie_id, rating, timestamp, split from lsp")
def q_load_splits(spark, d):
    return _lsp(spark, d).select("id", "user_id", "movie_id", "rating", "timestamp", "split")


@query("split_filter", W("rk", extra=_SPLIT[:3]) + "select id, user_id, movie_id from lsp where split = 'val'")
def q_split_filter(spark, d):
    return sp.split_filter(_lsp(spark, d), "val").select("id", "user_id", "movie_id")


@query("sample_decay_weights", W("rk", extra=_SPLIT[:5]) + "select id, split, round(weight, 6) as weight from wsp")
def q_sample_decay_weights(spark, d):
    return sm.sample_decay_weights(_lsp(spark, d)).select("id", "split", R("weight").alias("weight"))


@query("best_demonstration", W("rk", extra=_SPLIT) + "select split, user_id, demo_movie_id, demo_rating, demo_id from demo")
def q_best_demonstration(spark, d):
    return sm.best_demonstration(_lsp(spark, d), by=["split"])


_SAMPLES = _SPLIT + [
    ("tw", "select user_id, sum(weight) as total_weight from wrk group by user_id"),
    ("gw", "select w.user_id, g.genre, sum(w.weight) as gw from wrk w join mg g on w.movie_id = g.movie_id group by w.user_id, g.genre"),
    ("uf", "select user_id, count(*) as rating_count, avg(rating) as avg_rating from wrk group by user_id"),
    ("itf", "select movie_id, cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') as int) as release_year, "
            "string_split(genres, '|') as gl from fx_movies"),
    ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre"),
    ("smp", "select w.id, w.split, w.user_id, w.movie_id, w.rating, w.weight, "
            "coalesce(u.rating_count, 0) as rating_count, coalesce(u.avg_rating, 0.0e0) as avg_rating, "
            "coalesce(nullif(i.release_year, 0), 1995) as release_year, dm.demo_movie_id, dm.demo_rating, s.pos, "
            "coalesce(gw.gw / tw.total_weight, 0.0e0) as affinity, "
            "case when list_contains(coalesce(i.gl, []), s.genre) then 1.0e0 else 0.0e0 end as multihot, "
            "case when list_contains(coalesce(di.gl, []), s.genre) then 1.0e0 else 0.0e0 end as demo_multihot "
            "from wsp w cross join slots s left join uf u on w.user_id = u.user_id left join itf i on w.movie_id = i.movie_id "
            "left join demo dm on w.split = dm.split and w.user_id = dm.user_id "
            "left join itf di on dm.demo_movie_id = di.movie_id left join tw on tw.user_id = w.user_id "
            "left join gw on gw.user_id = w.user_id and gw.genre = s.genre"),
]


def _samples(spark, d):
    rk, mv = data.ratings_table(spark, d), data.movies(spark, d)
    lsp = materialize(sp.load_splits(rk, sp.temporal_split(rk)), "split-ratings")
    weighted = sm.sample_decay_weights(lsp)
    uf = fe.user_features(rk, mv)
    itf = fe.item_base_features(mv)  # samples use multi-hot and year only
    demo = sm.best_demonstration(lsp, by=["split"])
    return sm.training_samples(weighted.select("id", "split", "user_id", "movie_id", "rating", "weight"),
                               uf, itf, demo)


@query("training_samples", W("rk", "wrk", "mg", "mem", "fx_movies", extra=_SAMPLES) + """
select id, split, user_id, movie_id, rating, round(weight, 6) as weight, rating_count, round(avg_rating, 6) as avg_rating, release_year,
       demo_movie_id, demo_rating, pos, round(affinity, 6) as affinity, multihot, demo_multihot
from smp""")
def q_training_samples(spark, d):
    """Every slot of the three vectors of a sample, in long form."""
    s = _samples(spark, d)
    slots = F.arrays_zip("genre_affinity", "genre_multihot", "demo_genre_multihot")
    return s.select("id", "split", "user_id", "movie_id", "rating", R("weight").alias("weight"), "rating_count", R("avg_rating").alias("avg_rating"),
                    "release_year", "demo_movie_id", "demo_rating", F.posexplode(slots).alias("pos", "z")).select(
        "id", "split", "user_id", "movie_id", "rating", "weight", "rating_count", "avg_rating", "release_year", "demo_movie_id", "demo_rating",
        F.col("pos").cast("bigint").alias("pos"), R("z.genre_affinity").alias("affinity"), F.col("z.genre_multihot").alias("multihot"),
        F.coalesce("z.demo_genre_multihot", F.lit(0.0)).alias("demo_multihot"))


@query("demo_context", W("rk", "wrk", "mg", "mem", "fx_movies", extra=_SPLIT + [
    ("tw", "select user_id, sum(weight) as total_weight from wrk group by user_id"),
    ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre"),
    ("gw", "select w.user_id, g.genre, sum(w.weight) as genre_weight from wrk w join mg g on w.movie_id = g.movie_id "
           "group by w.user_id, g.genre")]) + """
select l.id, s.pos,
       round(coalesce(gw.genre_weight / tw.total_weight, 0.0e0) * 0.7e0
             + (case when mem.movie_id is null then 0.0e0 else 1.0e0 end) * 0.3e0, 6) as value
from lsp l join demo dm on l.split = dm.split and l.user_id = dm.user_id
cross join slots s
left join tw on l.user_id = tw.user_id
left join gw on l.user_id = gw.user_id and gw.genre = s.genre
left join mem on mem.movie_id = dm.demo_movie_id and mem.genre = s.genre""")
def q_demo_context(spark, d):
    c = sm.demo_context(_samples(spark, d))
    return c.select("id", F.posexplode("demo_context").alias("pos", "value")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


@query("id_space", W("rk", "fx_movies") + """
select (select max(user_id) + 1 from rk) as n_users, (select max(movie_id) + 1 from fx_movies) as n_items,
       20 as n_genres""")
def q_id_space(spark, d):
    rk, mv = data.ratings(spark, d), data.movies(spark, d)
    return sm.id_space(fe.user_features(rk, mv), fe.genre_multihot(mv)).select(
        "n_users", "n_items", F.col("n_genres").cast("int").alias("n_genres"))


@query("pad_sequences", W("fx_pairs", extra=[
    ("sq", "select k, batch_id, list_filter(uv, lambda x: x > 0) as s from fx_pairs"),
    ("ml", "select batch_id, max(len(s)) as l from sq group by batch_id"),
    ("padded", "select sq.k, list_concat(sq.s, list_transform(range(ml.l - len(sq.s)), lambda x: 0.0e0)) as p "
               "from sq join ml on sq.batch_id = ml.batch_id")]) + """
select k, pos, round(value, 6) as value, value <> 0 as mask from (
  select k, unnest(range(len(p))) as pos, unnest(p) as value from padded)""")
def q_pad_sequences(spark, d):
    pairs = fx.fx_pairs(spark, d).select("k", "batch_id", F.filter("uv", lambda x: x > 0).alias("s"))
    p = sm.pad_sequences(pairs, "batch_id", "s")
    return p.select("k", F.posexplode(F.arrays_zip("padded", "mask")).alias("pos", "z")).select(
        "k", F.col("pos").cast("bigint").alias("pos"), R("z.padded").alias("value"), F.col("z.mask").alias("mask"))


@query("write_split", W("rk", extra=_SPLIT[:2]) + "select rating_id, split from sp")
def q_write_split(spark, d):
    """Write the split partitioned by label and read it back whole (split_filter reads one label)."""
    from marquee.session import scratch_path
    path = scratch_path(spark, "split")
    sp.write_split(_split(spark, d), path)
    return spark.read.parquet(path).select("rating_id", "split")
