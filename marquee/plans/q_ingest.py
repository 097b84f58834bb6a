"""Ingest queries: keyed merges, stamps, watermarks, ingest report, validation and counts.

The merge scenario uses two deliveries of the rating stream, split by insert time (not a sample):
the state after a first load (rows inserted before 16 Jan, last wins) and an incoming file with
every row inserted from 11 Jan on, so five days overlap and keys really conflict.
"""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from marquee.operators import merge, quality
from marquee.plans import data
from marquee.plans.catalog import query
from marquee.plans.oracle_views import with_views as W
from marquee.sources import fixtures as fx

# FIXED VALUES of the merge scenario
FIRST_LOAD_BEFORE = "2024-01-16 00:00:00"
SECOND_FILE_FROM = "2024-01-11 00:00:00"
BATCH_TS = datetime(2024, 2, 1)
KEYS = ["user_id", "movie_id"]


def _first_load(spark, d):
    r = fx.fx_ratings(spark, d).filter(F.col("inserted_at") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    return merge.dedupe_last(merge.drop_null_keys(r, KEYS), KEYS, "id")


def _second_file(spark, d):
    r = fx.fx_ratings(spark, d).filter(F.col("inserted_at") >= F.lit(SECOND_FILE_FROM).cast("timestamp_ntz"))
    return merge.stamp_inserted_at(r, BATCH_TS)


def _dedupe_sql(src: str, desc: bool) -> str:
    return (f"select id, user_id, movie_id, rating, timestamp, inserted_at from (select *, row_number() over "
            f"(partition by user_id, movie_id order by id {'desc' if desc else 'asc'}) as rn_ from {src} "
            f"where user_id is not null and movie_id is not null) where rn_ = 1")


_MERGE = [
    ("tgt0", f"select * from fx_ratings where inserted_at < TIMESTAMP '{FIRST_LOAD_BEFORE}'"),
    ("tgt", _dedupe_sql("tgt0", True)),
    ("src0", f"select id, user_id, movie_id, rating, timestamp, TIMESTAMP '{BATCH_TS:%Y-%m-%d %H:%M:%S}' as inserted_at "
             f"from fx_ratings where inserted_at >= TIMESTAMP '{SECOND_FILE_FROM}'"),
    ("src_last", _dedupe_sql("src0", True)),
    ("src_first", _dedupe_sql("src0", False)),
    # an existing key keeps its row id
    ("upserted", "select coalesce(t.id, s.id) as id, user_id, movie_id, "
                 "case when s.id is null then t.rating else s.rating end as rating, "
                 "case when s.id is null then t.timestamp else s.timestamp end as timestamp, "
                 "case when s.id is null then t.inserted_at else s.inserted_at end as inserted_at "
                 "from tgt t full join src_last s using (user_id, movie_id)"),
    ("all_first", "select id, user_id, movie_id, rating, timestamp, inserted_at from (select *, row_number() over "
                  "(partition by user_id, movie_id order by id) as rn_ from fx_ratings) where rn_ = 1"),
]
_COLS = "id, user_id, movie_id, rating, timestamp, inserted_at"


@query("merge_upsert", W("fx_ratings", extra=_MERGE) + f"select {_COLS} from upserted")
def q_merge_upsert(spark, d):
    return merge.merge_upsert(_first_load(spark, d), _second_file(spark, d), KEYS, "id")


@query("upsert_keeps_id", W("fx_ratings", extra=_MERGE) + """
select t.id, t.user_id, t.movie_id, s.rating from tgt t join src_last s using (user_id, movie_id)""")
def q_upsert_keeps_id(spark, d):
    """Rows of the first load that the second file replaces: new values under the old row ids."""
    first = _first_load(spark, d)
    up = merge.merge_upsert(first, _second_file(spark, d), KEYS, "id")
    return up.where(F.col("inserted_at") == merge.ntz_literal(BATCH_TS)).join(first.select("id"), "id").select("id", *KEYS, "rating")


@query("splits_after_upsert", W("fx_ratings", extra=_MERGE + [
    ("nth", "select id, row_number() over (order by timestamp, id) - 1 as k, count(*) over () as n from tgt"),
    ("sp", "select id as rating_id, case when k < cast(floor(n * 0.8e0) as bigint) then 'train' when k < cast(floor(n * 0.8e0) as bigint) "
           "+ cast(floor(n * 0.1e0) as bigint) then 'val' else 'test' end as split from nth")]) + """
select u.id, u.rating, sp.split from upserted u join sp on sp.rating_id = u.id""")
def q_splits_after_upsert(spark, d):
    """A split made before an upsert still finds all its ratings after it."""
    from marquee.operators import split
    first = _first_load(spark, d)
    sp = split.temporal_split(first)
    return split.load_splits(merge.merge_upsert(first, _second_file(spark, d), KEYS, "id"), sp).select("id", "rating", "split")


@query("watermarks_partial_run", W("fx_ratings", extra=_MERGE) + f"""
select 'ratings' as table_name, max(inserted_at) as last_inserted_at from upserted
union all select 'movies', TIMESTAMP '{BATCH_TS:%Y-%m-%d %H:%M:%S}'""")
def q_watermarks_partial_run(spark, d):
    """A run that loads ratings alone moves their mark and leaves that of the movies."""
    first = _first_load(spark, d)
    marks = merge.max_inserted_watermark({"ratings": first, "movies": merge.stamp_inserted_at(fx.fx_movies(spark, d), BATCH_TS)})
    up = merge.merge_upsert(first, _second_file(spark, d), KEYS, "id")
    return merge.merge_watermarks(marks, merge.max_inserted_watermark({"ratings": up}))


@query("merge_skip", W("fx_ratings", extra=_MERGE) + f"""
select {_COLS} from tgt union all
select {_COLS} from src_first s where not exists (select 1 from tgt where s.user_id = tgt.user_id and s.movie_id = tgt.movie_id)""")
def q_merge_skip(spark, d):
    return merge.merge_skip(_first_load(spark, d), _second_file(spark, d), KEYS, "id")


@query("merge_replace", W("fx_ratings", extra=_MERGE) + f"select {_COLS} from all_first")
def q_merge_replace(spark, d):
    """A full file replaces the table; of conflicting rows the first stays."""
    return merge.merge_replace(fx.fx_ratings(spark, d), KEYS, "id")


@query("stamp_inserted_at", W("fx_ratings") + f"""
select id, user_id, movie_id, TIMESTAMP '{BATCH_TS:%Y-%m-%d %H:%M:%S}' as inserted_at from fx_ratings""")
def q_stamp_inserted_at(spark, d):
    return merge.stamp_inserted_at(fx.fx_ratings(spark, d), BATCH_TS).select("id", "user_id", "movie_id", "inserted_at")


@query("drop_null_keys", W("fx_dirty_ratings") + """
select id, user_id, movie_id, rating from fx_dirty_ratings where user_id is not null and movie_id is not null""")
def q_drop_null_keys(spark, d):
    return merge.drop_null_keys(fx.fx_dirty_ratings(spark, d), KEYS).select("id", "user_id", "movie_id", "rating")


@query("null_sentinel", W("fx_dirty_links") + """
select movie_id, nullif(imdb_id, 'nan') as imdb_id, nullif(tmdb_id, 'nan') as tmdb_id from fx_dirty_links""")
def q_null_sentinel(spark, d):
    return merge.null_sentinel(fx.fx_dirty_links(spark, d), ["imdb_id", "tmdb_id"])


@query("max_inserted_watermark", W("fx_ratings", extra=_MERGE) + """
select 'ratings' as table_name, max(inserted_at) as last_inserted_at from upserted
union all select 'ratings_first_load' as table_name, max(inserted_at) as last_inserted_at from tgt""")
def q_max_inserted_watermark(spark, d):
    up = merge.merge_upsert(_first_load(spark, d), _second_file(spark, d), KEYS, "id")
    return merge.max_inserted_watermark({"ratings": up, "ratings_first_load": _first_load(spark, d)})


@query("ingest_report", W("fx_ratings", "fx_movies", "fx_tags", "fx_links", extra=[("counts", """
  select 'ratings' as table_name, count(*) as rows_offered from fx_ratings
  union all select 'movies', count(*) from fx_movies
  union all select 'tags', count(*) from fx_tags where tag is not null
  union all select 'links', count(*) from fx_links""")]) + """
select table_name, rows_offered,
       (select count(*) from counts where table_name in ('ratings', 'movies')) = 2 as ok
from counts
union all select 'total', cast(sum(rows_offered) as bigint),
       (select count(*) from counts where table_name in ('ratings', 'movies')) = 2 from counts""")
def q_ingest_report(spark, d):
    from marquee.sources.files import ingest_report
    offered = {"ratings": fx.fx_ratings(spark, d), "movies": fx.fx_movies(spark, d),
               "tags": merge.drop_null_keys(fx.fx_tags(spark, d), ["tag"]), "links": fx.fx_links(spark, d)}
    return ingest_report(offered)


# ---------------------------------------------------------------- validation

@query("check_row_count", W("rk", "fx_movies") + """
select 'ratings' as table_name, count(*) as value, case when count(*) = 0 then 'fail' else 'ok' end as severity from rk
union all select 'movies', count(*), case when count(*) = 0 then 'fail' else 'ok' end from fx_movies""")
def q_check_row_count(spark, d):
    return quality.check_row_count(data.ratings(spark, d), "ratings").unionByName(
        quality.check_row_count(data.movies(spark, d), "movies"))


@query("check_null_keys", W("fx_dirty_ratings") + """
select count(*) filter (where user_id is null) as null_user_id, count(*) filter (where movie_id is null) as null_movie_id
from fx_dirty_ratings""")
def q_check_null_keys(spark, d):
    return quality.check_null_keys(fx.fx_dirty_ratings(spark, d))


@query("check_null_titles", W("fx_dirty_movies") + """
select count(*) as row_count, count(*) filter (where title is null) as null_titles from fx_dirty_movies""")
def q_check_null_titles(spark, d):
    return quality.check_null_titles(fx.fx_dirty_movies(spark, d))


@query("check_rating_range", W("fx_dirty_ratings") + """
select count(*) filter (where rating < 0.5e0 or rating > 5.0e0) as out_of_range from fx_dirty_ratings""")
def q_check_rating_range(spark, d):
    return quality.check_rating_range(fx.fx_dirty_ratings(spark, d))


@query("distinct_counts", W("rk") + """
select count(distinct user_id) as distinct_users, count(distinct movie_id) as distinct_movies from rk""")
def q_distinct_counts(spark, d):
    return quality.distinct_counts(data.ratings(spark, d))


@query("distinct_by_sketches", W("fx_ratings") + """
select count(distinct user_id) as exact_users, count(distinct movie_id) as exact_movies, 0 as users_outside, 0 as movies_outside,
       count(*) as n_rows from fx_ratings""")
def q_distinct_by_sketches(spark, d):
    """Sketches of ten deliveries merged without their rows; how many of the two exact counts lie outside the merged bounds."""
    rk = fx.fx_ratings(spark, d)
    per = rk.groupBy((F.col("id") % 10).alias("delivery")).agg(F.hll_sketch_agg("user_id", F.lit(quality.LG_K)).alias("users"),
                                                              F.hll_sketch_agg("movie_id", F.lit(quality.LG_K)).alias("movies"))
    e = quality.distinct_estimates(per).first()  # one row
    exact = quality.distinct_counts(rk).first()  # one row
    out = [int(not e[f"distinct_{c}_low"] <= exact[f"distinct_{c}"] <= e[f"distinct_{c}_high"]) for c in ("users", "movies")]
    return rk.agg(F.count(F.lit(1)).alias("n_rows")).select(*[F.lit(exact[f"distinct_{c}"]).alias(f"exact_{c}") for c in ("users", "movies")],
                                                           F.lit(out[0]).alias("users_outside"), F.lit(out[1]).alias("movies_outside"), "n_rows")


@query("orphan_ratings", W("rk", "fx_movies_gaps") + """
select r.id, r.user_id, r.movie_id from rk r left join fx_movies_gaps m on r.movie_id = m.movie_id where m.movie_id is null""")
def q_orphan_ratings(spark, d):
    return quality.orphan_ratings(data.ratings(spark, d), data.movies_gaps(spark, d)).select("id", "user_id", "movie_id")


def _validate_sql(ratings: str, movies: str) -> list[tuple[str, str]]:
    return [
        ("r", f"""select count(*) as n, count(*) filter (where user_id is null) as nu,
                  count(*) filter (where movie_id is null) as nm,
                  count(*) filter (where rating < 0.5e0 or rating > 5.0e0) as oor,
                  count(distinct user_id) as du, count(distinct movie_id) as dm from {ratings}"""),
        ("m", f"select count(*) as n, count(*) filter (where title is null) as nt from {movies}"),
        ("o", f"select count(*) as n from {ratings} q where not exists "
              f"(select 1 from {movies} f where f.movie_id = q.movie_id)")]


_VALIDATE = """
select 'ratings_row_count' as "check", case when n > 0 then 'ok' else 'fail' end as severity, n as value from r
union all select 'ratings_null_user_id', case when nu > 0 then 'fail' else 'ok' end, nu from r where n > 0
union all select 'ratings_null_movie_id', case when nm > 0 then 'fail' else 'ok' end, nm from r where n > 0
union all select 'ratings_out_of_range', case when oor > 0 then 'warn' else 'ok' end, oor from r where n > 0
union all select 'ratings_distinct_users', 'info', du from r where n > 0
union all select 'ratings_distinct_movies', 'info', dm from r where n > 0
union all select 'movies_row_count', case when n > 0 then 'ok' else 'fail' end, n from m
union all select 'movies_null_titles', case when nt > 0 then 'fail' else 'ok' end, nt from m where n > 0
union all select 'orphan_ratings', case when n > 0 then 'warn' else 'ok' end, n from o"""


@query("validate_all", W("rk", "fx_movies_gaps", extra=_validate_sql("rk", "fx_movies_gaps")) + _VALIDATE)
def q_validate_all(spark, d):
    return quality.validate_all(data.ratings(spark, d), data.movies_gaps(spark, d))


@query("validate_failing", W("fx_dirty_ratings", "fx_dirty_movies", extra=_validate_sql("fx_dirty_ratings", "fx_dirty_movies")) + _VALIDATE)
def q_validate_failing(spark, d):
    """The same checks over rows with null keys, ratings out of range and missing titles: the fail and warn branches."""
    return quality.validate_all(fx.fx_dirty_ratings(spark, d), fx.fx_dirty_movies(spark, d))


@query("table_counts", W("rk", "fx_movies", "fx_tags", "fx_links") + """
select 'ratings' as table_name, count(*) as row_count from rk
union all select 'movies', count(*) from fx_movies
union all select 'tags', count(*) from fx_tags
union all select 'links', count(*) from fx_links""")
def q_table_counts(spark, d):
    return quality.table_counts({"ratings": data.ratings(spark, d), "movies": data.movies(spark, d),
                                 "tags": fx.fx_tags(spark, d), "links": fx.fx_links(spark, d)})
