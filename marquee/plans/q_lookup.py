"""Lookup queries against serving tables that Spark precomputes from the vector fixtures.

Model A serves users who have features (rated something) from the even/odd vector split with
three methods; model B swaps the roles of the two halves and serves cosine only.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import features as fe
from marquee.operators import lookup as lk
from marquee.operators import retrieve as rt
from marquee.plans import data
from marquee.plans.catalog import R, query
from marquee.plans.oracle_views import VOCAB, with_views as W
from marquee.plans.q_retrieval import sql_score
from marquee.session import materialize, scratch_path
from marquee.sources import fixtures as fx

A, B = lk.MODEL_A, lk.MODEL_B
METHODS = ("cosine", "dot", "l2")


_SC = " union all ".join(
    [f"select '{A}' as model_name, u.user_id, mem.genre, '{m}' as scoring_method, i.movie_id, {sql_score(m, 'u.u', 'i.i')} "
     f"as score from ua u cross join ivec i join mem on mem.movie_id = i.movie_id" for m in METHODS] +
    [f"select '{B}', u.user_id, mem.genre, 'cosine', i.movie_id, {sql_score('cosine', 'u.u', 'i.i')} "
     f"from ub u cross join ib i join mem on mem.movie_id = i.movie_id"])

_SERVING = [
    ("ufu", "select distinct user_id from rk"),
    ("ua", "select u.user_id, u.u from uvec u join ufu on u.user_id = ufu.user_id"),
    ("ub", "select cast(vec_id // 2 as int) as user_id, v as u from fx_vec "
           "where vec_id % 2 = 1 and cast(vec_id // 2 as int) in (select user_id from ufu)"),
    ("ib", "select cast(vec_id // 2 as int) as movie_id, v as i from fx_vec where vec_id % 2 = 0"),
    ("sc", _SC),
    ("srv", "select * from (select *, row_number() over (partition by model_name, user_id, genre, scoring_method "
            "order by case when scoring_method = 'l2' then score else -score end, movie_id) as rank from sc) "
            "where rank <= 20"),
    ("cold0", f"select '{A}' as model_name, mem.genre, i.movie_id, sqrt(list_dot_product(i.i, i.i)) as score "
              f"from ivec i join mem on mem.movie_id = i.movie_id union all "
              f"select '{B}', mem.genre, i.movie_id, sqrt(list_dot_product(i.i, i.i)) "
              f"from ib i join mem on mem.movie_id = i.movie_id"),
    ("coldl", f"select '{A}' as model_name, unnest(['cosine', 'dot', 'l2']) as scoring_method "
              f"union all select '{B}', 'cosine'"),
    ("cold", "select c.*, l.scoring_method from (select * from (select *, row_number() over (partition by "
             "model_name, genre order by score desc, movie_id) as rank from cold0) where rank <= 20) c "
             "join coldl l on c.model_name = l.model_name"),
]

_TOPG = [
    ("tw", "select user_id, sum(weight) as total_weight from wrk group by user_id"),
    ("gw", "select w.user_id, g.genre, sum(w.weight) as genre_weight from wrk w join mg g "
           "on w.movie_id = g.movie_id group by w.user_id, g.genre"),
    ("affv", f"select t.user_id, s.pos, s.genre, coalesce(gw.genre_weight / t.total_weight, 0.0e0) as v "
             f"from tw t cross join (select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre) s "
             f"left join gw on gw.user_id = t.user_id and gw.genre = s.genre"),
    ("topg", "select user_id, genre, rank from (select *, row_number() over (partition by user_id order by v desc, "
             "pos) as rank from affv) where rank <= 2 and v > 0"),
]

_VIEWS = ("rk", "wrk", "mg", "mem", "fx_vec", "uvec", "ivec", "fx_movies")


def W_(extra):
    return W(*_VIEWS, extra=_SERVING + _TOPG + extra)


def _pick_sql(req: str, rows: str, keys: list[str]) -> str:
    """Chosen serving rows per request: its genre, or the lowest vocabulary genre when it has none."""
    on = " and ".join(f"q.{k} = r.{k}" for k in keys)
    return (f"select q.request_id, r.genre, r.rank - 1 as pos, r.movie_id, r.score from {req} q join {rows} r on {on} "
            f"and (q.genre is null or q.genre = r.genre) where r.rank <= q.top_n and "
            f"list_position({VOCAB}, r.genre) = (select min(list_position({VOCAB}, r2.genre)) from {rows} r2 "
            f"where {on.replace('r.', 'r2.')} and (q.genre is null or q.genre = r2.genre))")


# ---------------------------------------------------------------- Spark side

def _membership(spark, d):
    return fe.genre_membership_from_movies(data.movies(spark, d))


def _serving(spark, d):
    users_with_features = materialize(data.ratings(spark, d).select("user_id").distinct(), "rating-users")  # both models and their counts read it
    v = fx.fx_vec(spark, d)
    ua = fx.user_vectors(spark, d).join(users_with_features, "user_id")
    ia = fx.item_vectors(spark, d).select("movie_id", "i")
    ub = (v.filter(F.col("vec_id") % 2 == 1)
          .select(F.floor(F.col("vec_id") / 2).cast("int").alias("user_id"), F.col("v").alias("u"))
          .join(users_with_features, "user_id"))
    ib = v.filter(F.col("vec_id") % 2 == 0).select(F.floor(F.col("vec_id") / 2).cast("int").alias("movie_id"),
                                                   F.col("v").alias("i"))
    mem = _membership(spark, d)
    ta, ca = rt.precompute_serving(ua, ia, mem, A, METHODS, 20)
    tb, cb = rt.precompute_serving(ub, ib, mem, B, ("cosine",), 20)
    return ta.unionByName(tb), ca.unionByName(cb)


def _uf(spark, d):
    return fe.user_features(data.ratings(spark, d), data.movies(spark, d))


def _user_requests(spark, d):
    """Per rating user: one request for the top-affinity genre (cosine, 10) and one without genre (l2, 5)."""
    top = lk.top_genres(_uf(spark, d)).filter(F.col("rank") == 1)
    g = top.select(F.concat(F.lit("g:"), F.col("user_id").cast("string")).alias("request_id"), "user_id", "genre",
                   F.lit("cosine").alias("scoring_method"), F.lit(10).alias("top_n"))
    n = data.ratings(spark, d).select("user_id").distinct().select(
        F.concat(F.lit("n:"), F.col("user_id").cast("string")).alias("request_id"), "user_id",
        F.lit(None).cast("string").alias("genre"), F.lit("l2").alias("scoring_method"), F.lit(5).alias("top_n"))
    return g.unionByName(n).withColumn("model_name", F.lit(A))


_USER_REQ = ("req", f"select 'g:' || cast(user_id as varchar) as request_id, user_id, genre, 'cosine' as scoring_method, "
                    f"10 as top_n, '{A}' as model_name from topg where rank = 1 union all "
                    f"select 'n:' || cast(user_id as varchar), user_id, null, 'l2', 5, '{A}' from ufu")


def _long(recs, keys):
    e = lk.explode_recs(recs, keys)
    return e.select(*keys, F.col("pos").cast("bigint").alias("pos"), "movie_id", R("score").alias("score"))


@query("lookup_user", W_([_USER_REQ]) + """
select request_id, genre, pos, movie_id, round(score, 6) as score from (""" +
       _pick_sql("req", "srv", ["user_id", "model_name", "scoring_method"]) + ")")
def q_lookup_user(spark, d):
    top, _ = _serving(spark, d)
    recs = lk.lookup_user(top, _user_requests(spark, d))
    return _long(recs, ["request_id", "genre"])


@query("lookup_cold_start", W_([("req", f"select genre as request_id, genre, 'dot' as scoring_method, 10 as top_n, "
                                       f"'{A}' as model_name from (select distinct genre from mg) union all "
                                       f"select '*', null, 'dot', 10, '{A}'")]) + """
select request_id, genre, pos, movie_id, round(score, 6) as score from (""" +
       _pick_sql("req", "cold", ["model_name", "scoring_method"]) + ")")
def q_lookup_cold_start(spark, d):
    _, cold = _serving(spark, d)
    genres = fe.explode_genres(data.movies(spark, d)).select("genre").distinct()
    req = genres.select(F.col("genre").alias("request_id"), "genre").unionByName(
        spark.range(1).select(F.lit("*").alias("request_id"), F.lit(None).cast("string").alias("genre")))
    req = req.withColumn("scoring_method", F.lit("dot")).withColumn("model_name", F.lit(A))
    return _long(lk.lookup_cold_start(cold, req), ["request_id", "genre"])


@query("batch_recommend", W_([
    ("req", f"select user_id as request_id, user_id, null as genre, 'cosine' as scoring_method, 10 as top_n, "
            f"'{A}' as model_name from uvec"),
    ("pers", _pick_sql("req", "srv", ["user_id", "model_name", "scoring_method"])),
    ("miss", "select * from req where request_id not in (select request_id from pers)"),
    ("fb", _pick_sql("miss", "cold", ["model_name", "scoring_method"]))]) + """
select p.request_id, p.request_id as user_id, 'personal' as source, genre, pos, movie_id, round(score, 6) as score
from pers p union all
select f.request_id, f.request_id, 'cold_start', genre, pos, movie_id, round(score, 6) from fb f""")
def q_batch_recommend(spark, d):
    top, cold = _serving(spark, d)
    req = fx.user_vectors(spark, d).select(F.col("user_id").alias("request_id"), "user_id")
    recs = lk.batch_recommend(top, cold, req)
    return _long(recs, ["request_id", "user_id", "source", "genre"])


_EDGE_REQ = ("req0", f"select user_id as request_id, user_id, case when user_id % 5 = 2 then 'No Such Genre' end as genre, 'cosine' as scoring_method, "
             f"case when user_id % 5 = 0 then 10 when user_id % 5 = 1 then 500 else 5 end as top_n, '{A}' as model_name from uvec")


@query("lookup_edge_requests", W_([
    _EDGE_REQ, ("req", "select * from req0 where top_n between 1 and 100"),
    ("pers", _pick_sql("req", "srv", ["user_id", "model_name", "scoring_method"])),
    ("miss", "select * from req where request_id not in (select request_id from pers)"),
    ("fb", _pick_sql("miss", "cold", ["model_name", "scoring_method"])),
    ("found", "select request_id, 'personal' as source, genre, count(*) as n from pers group by request_id, genre union all "
              "select request_id, 'cold_start', genre, count(*) from fb group by request_id, genre")]) + """
select q.request_id, case when q.top_n not between 1 and 100 then 'invalid' else coalesce(f.source, 'none') end as source,
       coalesce(f.genre, q.genre) as genre, coalesce(f.n, 0) as n_items,
       case when q.top_n not between 1 and 100 then 'top_n ' || q.top_n || ' is outside 1..100'
            when q.genre is not null then 'unknown genre ' || q.genre end as error
from req0 q left join found f on f.request_id = q.request_id""")
def q_lookup_edge_requests(spark, d):
    """Requests with a null top_n and method, a top_n out of bounds, an unknown genre: one answer each, and the errors."""
    top, cold = _serving(spark, d)
    five = F.col("user_id") % 5
    req = fx.user_vectors(spark, d).select(
        F.col("user_id").alias("request_id"), "user_id", F.when(five == 2, F.lit("No Such Genre")).alias("genre"),
        F.when(five == 0, F.lit(None)).when(five == 1, 500).otherwise(5).cast("int").alias("top_n"),
        F.when(five != 0, F.lit("cosine")).alias("scoring_method"))
    out = lk.batch_recommend(top, cold, req).join(lk.bad_requests(req), "request_id", "left")
    return out.select("request_id", "source", "genre", F.coalesce(F.size("movie_ids"), F.lit(0)).cast("bigint").alias("n_items"), "error")


@query("multi_model_recommend", W_([
    ("req0", "select user_id as request_id, user_id, null as genre, 'cosine' as scoring_method, 10 as top_n from ufu"),
    ("req", f"select r.*, m.model_name from req0 r cross join (select unnest(['{A}', '{B}']) as model_name) m")]) + """
select request_id, model_name, genre, pos, movie_id, round(score, 6) as score from (
  select q.request_id, q.model_name, r.genre, r.rank - 1 as pos, r.movie_id, r.score from req q join srv r
  on q.user_id = r.user_id and q.model_name = r.model_name and q.scoring_method = r.scoring_method
  where r.rank <= q.top_n and list_position(""" + VOCAB + """, r.genre) = (select min(list_position(""" + VOCAB +
       """, r2.genre)) from srv r2 where r2.user_id = q.user_id and r2.model_name = q.model_name
  and r2.scoring_method = q.scoring_method))""")
def q_multi_model_recommend(spark, d):
    top, _ = _serving(spark, d)
    req = data.ratings(spark, d).select("user_id").distinct().select(
        F.col("user_id").alias("request_id"), "user_id", F.lit("cosine").alias("scoring_method"))
    recs = lk.multi_model_recommend(top, req, [A, B])
    return _long(recs, ["request_id", "model_name", "genre"])


@query("top_genres", W("rk", "wrk", "mg", extra=_TOPG) + "select user_id, genre, rank from topg")
def q_top_genres(spark, d):
    return lk.top_genres(_uf(spark, d)).select("user_id", "genre", F.col("rank").cast("bigint").alias("rank"))


_EXPLAIN = [
    ("req", f"select user_id as request_id, user_id, null as genre, 'cosine' as scoring_method, 10 as top_n, "
            f"'{A}' as model_name from ufu"),
    ("recs", _pick_sql("req", "srv", ["user_id", "model_name", "scoring_method"])),
    ("tl", "select user_id, list(genre) as top from topg group by user_id"),
    ("ig", "select movie_id, list(genre) as g from mem group by movie_id"),
]


@query("explain", W_(_EXPLAIN) + """
select r.request_id as user_id, r.pos, r.movie_id,
       case when len(list_intersect(coalesce(tl.top, []), coalesce(ig.g, []))) > 0 then 'affinity' else 'embedding' end
         as reason,
       array_to_string(list_sort(list_intersect(coalesce(tl.top, []), coalesce(ig.g, []))), ', ') as overlap,
       round(r.score, 3) + 0.0e0 as score3
from recs r left join tl on tl.user_id = r.request_id left join ig on ig.movie_id = r.movie_id""")
def q_explain(spark, d):
    top, _ = _serving(spark, d)
    req = data.ratings(spark, d).select("user_id").distinct().select(F.col("user_id").alias("request_id"), "user_id")
    recs = lk.explode_recs(lk.lookup_user(top, req), ["user_id"])
    itf = fe.genre_multihot(data.movies(spark, d))
    e = lk.explain(recs, _uf(spark, d), itf)
    return e.select("user_id", F.col("pos").cast("bigint").alias("pos"), "movie_id", "reason", "overlap", "score3")


@query("enrich_recs", W_(_EXPLAIN) + """
select r.request_id as user_id, r.pos, r.movie_id, m.title,
       cast(nullif(regexp_extract(m.title, '\\((\\d{4})\\)', 1), '') as int) as year
from recs r left join fx_movies m on m.movie_id = r.movie_id""")
def q_enrich_recs(spark, d):
    top, _ = _serving(spark, d)
    req = data.ratings(spark, d).select("user_id").distinct().select(F.col("user_id").alias("request_id"), "user_id")
    recs = lk.explode_recs(lk.lookup_user(top, req), ["user_id"])
    mv = data.movies(spark, d)
    itf = mv.select("movie_id", fe.extract_year("title").alias("release_year"))
    e = lk.enrich_recs(recs, mv, itf)
    return e.select("user_id", F.col("pos").cast("bigint").alias("pos"), "movie_id", "title", "year")


@query("ab_assign", W("rk") + f"""
select distinct user_id, case when user_id % 2 = 0 then '{A}' else '{B}' end as assigned_model from rk""")
def q_ab_assign(spark, d):
    return lk.ab_assign(data.ratings(spark, d).select("user_id").distinct())


@query("ab_compare", W_([]) + f"""
select q.user_id, case when q.user_id % 2 = 0 then '{A}' else '{B}' end as assigned_model, r.model_name, r.genre,
       r.rank - 1 as pos, r.movie_id, round(r.score, 6) as score
from ufu q join srv r on q.user_id = r.user_id and r.scoring_method = 'cosine'
where r.rank <= 10 and list_position({VOCAB}, r.genre) = (select min(list_position({VOCAB}, r2.genre)) from srv r2
  where r2.user_id = q.user_id and r2.model_name = r.model_name and r2.scoring_method = 'cosine')""")
def q_ab_compare(spark, d):
    top, _ = _serving(spark, d)
    users = data.ratings(spark, d).select("user_id").distinct()
    c = lk.ab_compare(top, users)
    return _long(c, ["user_id", "assigned_model", "model_name", "genre"])


# FIXED VALUES of the title search request
SEARCH_Q, SEARCH_LIMIT = "BOLT (19", 10


@query("search_titles", W("fx_movies") + f"""
select movie_id, title, cast(nullif(regexp_extract(title, '\\((\\d{{4}})\\)', 1), '') as int) as year
from fx_movies where title ilike '%{SEARCH_Q}%' order by movie_id limit {SEARCH_LIMIT}""")
def q_search_titles(spark, d):
    mv = data.movies(spark, d)
    itf = mv.select("movie_id", fe.extract_year("title").alias("release_year"))
    return lk.search_titles(mv, itf, SEARCH_Q, SEARCH_LIMIT)


_TITLE_REQ = """
select movie_id as request_id, case movie_id % 6 when 0 then substr(title, 1, 6) when 1 then upper(substr(title, 3, 4)) when 2 then substr(title, 1, 2)
       when 3 then substr(title, 2, 3) || '%' || substr(title, 8, 2) when 4 then substr(title, 1, 1) else '_' || substr(title, 2, 4) end as q,
       cast(1 + movie_id % 50 as int) as top from fx_movies where movie_id % 10 = 3"""


@query("search_titles_index", W("fx_movies", extra=[("treq", _TITLE_REQ)]) + """
select request_id, rank, movie_id, title from (
  select r.request_id, m.movie_id, m.title, r.top, row_number() over (partition by r.request_id order by m.movie_id) as rank
  from treq r join fx_movies m on m.title ilike '%' || r.q || '%') where rank <= top""")
def q_search_titles_index(spark, d):
    """A table of requests, with whole, short and wildcard patterns made from titles, against the trigram index of all titles."""
    from marquee.operators import titles as ti
    mv, path = data.movies(spark, d), scratch_path(spark, "titles")
    ti.build_title_index(mv, path)
    t, n = F.col("title"), F.col("movie_id") % 6
    q = (F.when(n == 0, F.substring(t, 1, 6)).when(n == 1, F.upper(F.substring(t, 3, 4))).when(n == 2, F.substring(t, 1, 2))
         .when(n == 3, F.concat(F.substring(t, 2, 3), F.lit("%"), F.substring(t, 8, 2))).when(n == 4, F.substring(t, 1, 1))
         .otherwise(F.concat(F.lit("_"), F.substring(t, 2, 4))))
    req = mv.where("movie_id % 10 = 3").select(F.col("movie_id").alias("request_id"), q.alias("q"), (1 + F.col("movie_id") % 50).cast("int").alias("limit"))
    out = ti.search_titles(spark, path, req)
    return out.select("request_id", F.col("rank").cast("bigint").alias("rank"), "movie_id", "title")


@query("explain_cold_start", W_([
    ("req", f"select genre as request_id, genre, 'dot' as scoring_method, 10 as top_n, '{A}' as model_name "
            f"from (select distinct genre from mg)"),
    ("recs", _pick_sql("req", "cold", ["model_name", "scoring_method"]))]) + """
select r.request_id, r.pos, r.movie_id,
       case when r.request_id is not null then 'cold_start' else 'embedding' end as reason, '' as overlap,
       round(r.score, 3) + 0.0e0 as score3
from recs r""")
def q_explain_cold_start(spark, d):
    """Cold-start lists for genre requests (no user): every item is explained by the requested genre."""
    _, cold = _serving(spark, d)
    genres = fe.explode_genres(data.movies(spark, d)).select("genre").distinct()
    req = (genres.select(F.col("genre").alias("request_id"), "genre")
           .withColumn("scoring_method", F.lit("dot")).withColumn("model_name", F.lit(A)))
    recs = lk.explode_recs(lk.lookup_cold_start(cold, req), ["request_id"]).withColumn(
        "user_id", F.lit(None).cast("int"))
    e = lk.explain(recs, _uf(spark, d), fe.genre_multihot(data.movies(spark, d)), cold_genre_col="request_id")
    return e.select("request_id", F.col("pos").cast("bigint").alias("pos"), "movie_id", "reason", "overlap", "score3")
