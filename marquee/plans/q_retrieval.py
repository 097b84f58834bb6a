"""Scoring and retrieval queries over the user/item vector tables (even / odd embedding ids)."""
from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import features as fe
from marquee.operators import retrieve as rt
from marquee.plans import data
from marquee.plans.catalog import R, query
from marquee.plans.oracle_views import with_views as W
from marquee.session import scratch_path
from marquee.sources import fixtures as fx

METHODS = ("cosine", "dot", "l2")

_DOT = "list_dot_product({a}, {b})"
_NRM = "greatest(sqrt(list_dot_product({a}, {a})), 1e-8)"


def sql_score(method: str, a: str, b: str) -> str:
    if method == "dot":
        return _DOT.format(a=a, b=b)
    if method == "cosine":
        return f"{_DOT.format(a=a, b=b)} / ({_NRM.format(a=a)} * {_NRM.format(a=b)})"
    return f"(list_dot_product({a}, {a}) + list_dot_product({b}, {b}) - 2.0e0 * list_dot_product({a}, {b}))"


def _sql_pair_sq(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda j: ({a}[j] - {b}[j]) * ({a}[j] - {b}[j])))"


def _scored_sql(pool_join: str, pool_col: str) -> str:
    parts = []
    for m in METHODS:
        parts.append(f"select u.user_id, {pool_col} as genre, '{m}' as scoring_method, i.movie_id, "
                     f"{sql_score(m, 'u.u', 'i.i')} as score from uvec u cross join ivec i {pool_join}")
    return " union all ".join(parts)


def _ranked_sql(k: int) -> str:
    return (f"select * from (select *, row_number() over (partition by user_id, genre, scoring_method order by "
            f"case when scoring_method = 'l2' then score else -score end, movie_id) as rank from scored) "
            f"where rank <= {k}")


def _users(spark, d):
    return fx.user_vectors(spark, d)


def _items(spark, d):
    return fx.item_vectors(spark, d).select("movie_id", "i")


def _membership(spark, d):
    return fe.genre_membership_from_movies(data.movies(spark, d))


@query("l2_normalize", W("uvec") + """
select user_id, pos, round(value / greatest(sqrt(list_dot_product(u, u)), 1e-8), 6) as value
from (select user_id, u, unnest(range(len(u))) as pos, unnest(u) as value from uvec)""")
def q_l2_normalize(spark, d):
    n = rt.l2_normalize(_users(spark, d), "u", "n")
    return n.select("user_id", F.posexplode("n").alias("pos", "value")).select(
        "user_id", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


def _pair_query(method):
    sql_expr = _sql_pair_sq("uv", "iv") if method == "l2" else sql_score(method, "uv", "iv")

    @query(f"score_{method}", W("fx_pairs") + f"select k, round({sql_expr}, 6) as score from fx_pairs")
    def q(spark, d):
        scored = rt.score_pairs(fx.fx_pairs(spark, d), (method,))
        return scored.select("k", R(f"score_{method}").alias("score"))
    return q


for _m in METHODS:
    _pair_query(_m)


def _learned_sql(dim: int = 64, hidden: int = 64) -> str:
    """The learned head in SQL, weights rebuilt from the same fixed rule as learned_head_weights."""
    w1 = f"((((h.h * 31 + x.j * 17) % 97) - 48) / 97.0e0 / sqrt({2 * dim}))"
    b1 = "((h.h % 7) - 3) / 70.0e0"
    w2 = f"((((hd.h * 29) % 97) - 48) / 97.0e0 / sqrt({hidden}))"
    return W("fx_pairs", extra=[
        ("x", "select k, unnest(range(len(uv) + len(iv))) as j, unnest(list_concat(uv, iv)) as xv from fx_pairs"),
        ("hd", f"select x.k, h.h, greatest(sum(x.xv * {w1}) + {b1}, 0.0e0) as a from x "
               f"cross join (select unnest(range({hidden})) as h) h group by x.k, h.h"),
    ]) + f"select k, round(sum(hd.a * {w2}) + 0.01e0, 6) as score from hd group by k"


@query("score_learned", _learned_sql())
def q_score_learned(spark, d):
    """Learned head on explicit pairs (Arrow batches through numpy, fixed-rule weights)."""
    pairs = fx.fx_pairs(spark, d).select("k", "uv", "iv")
    dim = pairs.select(F.max(F.size("uv"))).first()[0]
    s = rt.score_learned_pairs(pairs, fx.learned_head_weights(dim), key="k")
    return s.select("k", R("score").alias("score"))


def _learned_topk_sql(dim: int = 64, hidden: int = 64, k: int = 20) -> str:
    """Learned-head top-k per user and genre: concat(u, i) W1 = u W1u + i W1i, so each side is projected
    once and the pair step only adds two hidden vectors."""
    w1 = "((((h.h * 31 + ({c}) * 17) % 97) - 48) / 97.0e0 / sqrt({n}))"
    return W("uvec", "ivec", "mem", extra=[
        ("ux", "select user_id, unnest(range(len(u))) as j, unnest(u) as v from uvec"),
        ("ix", "select movie_id, unnest(range(len(i))) as j, unnest(i) as v from ivec"),
        ("uh", f"select ux.user_id, h.h, sum(ux.v * {w1.format(c='ux.j', n=2 * dim)}) as a from ux "
               f"cross join (select unnest(range({hidden})) as h) h group by ux.user_id, h.h"),
        ("ih", f"select ix.movie_id, h.h, sum(ix.v * {w1.format(c=f'{dim} + ix.j', n=2 * dim)}) + ((h.h % 7) - 3) / 70.0e0 "
               f"as a from ix cross join (select unnest(range({hidden})) as h) h group by ix.movie_id, h.h"),
        ("ls", f"select u.user_id, i.movie_id, sum(greatest(u.a + i.a, 0.0e0) * ((((u.h * 29) % 97) - 48) / 97.0e0 "
               f"/ sqrt({hidden}))) + 0.01e0 as score from uh u join ih i on u.h = i.h group by u.user_id, i.movie_id"),
        ("scored", "select ls.user_id, mem.genre, 'learned' as scoring_method, ls.movie_id, ls.score from ls "
                   "join mem on mem.movie_id = ls.movie_id"),
    ]) + f"""
select user_id, genre, scoring_method, rank, movie_id, round(score, 6) as score from ({_ranked_sql(k)})"""


@query("topk_user_genre_learned", _learned_topk_sql())
def q_topk_user_genre_learned(spark, d):
    """Top-k per user and genre under the learned head (numpy block kernel; tests compare with numpy)."""
    users, items = _users(spark, d), _items(spark, d)
    dim = items.select(F.max(F.size("i"))).first()[0]
    t = rt.topk_user_genre(users, items, _membership(spark, d), ("learned",), k=20,
                           head=fx.learned_head_weights(dim))
    return t.select("user_id", "genre", "scoring_method", F.col("rank").cast("bigint").alias("rank"), "movie_id",
                    R("score").alias("score"))


@query("genre_membership", W("mem") + "select movie_id, genre from mem")
def q_genre_membership(spark, d):
    return rt.genre_membership(fe.genre_multihot(data.movies(spark, d)))


@query("topk_global", W("uvec", "ivec", extra=[("scored", _scored_sql("", "'*'"))]) + f"""
select user_id, scoring_method, rank, movie_id, round(score, 6) as score from ({_ranked_sql(10)})""")
def q_topk_global(spark, d):
    t = rt.topk_global(_users(spark, d), _items(spark, d), METHODS, k=10)
    return t.select("user_id", "scoring_method", F.col("rank").cast("bigint").alias("rank"), "movie_id",
                    R("score").alias("score"))


_TOPK_UG = W("uvec", "ivec", "mem", extra=[("scored", _scored_sql("join mem on mem.movie_id = i.movie_id", "mem.genre"))]) + f"""
select user_id, genre, scoring_method, rank, movie_id, round(score, 6) as score from ({_ranked_sql(20)})"""


def _topk_ug(spark, d, **kw):
    t = rt.topk_user_genre(_users(spark, d), _items(spark, d), _membership(spark, d), METHODS, k=20, **kw)
    return t.select("user_id", "genre", "scoring_method", F.col("rank").cast("bigint").alias("rank"), "movie_id",
                    R("score").alias("score"))


@query("topk_user_genre", _TOPK_UG)
def q_topk_user_genre(spark, d):
    return _topk_ug(spark, d)


@query("topk_user_genre_blocked", _TOPK_UG)
def q_topk_user_genre_blocked(spark, d):
    """Same result from small blocks, so that several item blocks really merge."""
    return _topk_ug(spark, d, user_block=64, item_block=64)


_COLD = W("ivec", "mem", extra=[
    ("cs", "select mem.genre, i.movie_id, sqrt(list_dot_product(i.i, i.i)) as score from ivec i "
           "join mem on mem.movie_id = i.movie_id"),
    ("csr", "select * from (select *, row_number() over (partition by genre order by score desc, movie_id) as rank "
            "from cs) where rank <= 20"),
    ("labels", "select unnest(['cosine', 'dot', 'l2']) as scoring_method")])


@query("cold_start_genre", _COLD + """
select genre, scoring_method, rank, movie_id, round(score, 6) as score from csr cross join labels""")
def q_cold_start_genre(spark, d):
    c = rt.cold_start_genre(_items(spark, d), _membership(spark, d), METHODS, k=20)
    return c.select("genre", "scoring_method", F.col("rank").cast("bigint").alias("rank"), "movie_id",
                    R("score").alias("score"))


@query("precompute_serving", _TOPK_UG.replace(
    "select user_id, genre, scoring_method, rank, movie_id, round(score, 6) as score from (",
    "select user_id, genre, scoring_method, 'fixture_model' as model_name, rank - 1 as pos, movie_id, "
    "round(score, 6) as score from ("))
def q_precompute_serving(spark, d):
    top, _ = rt.precompute_serving(_users(spark, d), _items(spark, d), _membership(spark, d), "fixture_model",
                                   METHODS, 20)
    z = top.select("user_id", "genre", "scoring_method", "model_name",
                   F.posexplode(F.arrays_zip("movie_ids", "scores")).alias("pos", "z"))
    return z.select("user_id", "genre", "scoring_method", "model_name", F.col("pos").cast("bigint").alias("pos"),
                    F.col("z.movie_ids").alias("movie_id"), R("z.scores").alias("score"))


@query("precompute_counts", W("uvec", "ivec", "mem", extra=[
    ("ug", "select count(*) as n from (select distinct u.user_id, mem.genre from uvec u cross join "
           "(select distinct mem.genre from mem join ivec i on i.movie_id = mem.movie_id) mem)"),
    ("cg", "select count(distinct mem.genre) as n from mem join ivec i on i.movie_id = mem.movie_id")]) + """
select 'fixture_model' as model_name, 'top_n_user_genre' as table_name, 3 * n as n from ug
union all select 'fixture_model', 'cold_start_genre', 3 * n from cg""")
def q_precompute_counts(spark, d):
    top, cold = rt.precompute_serving(_users(spark, d), _items(spark, d), _membership(spark, d), "fixture_model",
                                      METHODS, 20)
    return rt.precompute_counts(top, cold).select("model_name", "table_name", "n")


@query("item_index_roundtrip", W("ivec") + """
select movie_id, pos, round(value / greatest(sqrt(list_dot_product(i, i)), 1e-8), 6) as value
from (select movie_id, i, unnest(range(len(i))) as pos, unnest(i) as value from ivec)""")
def q_item_index_roundtrip(spark, d):
    """save_item_index then load_item_index for the cosine method: the stored vectors are normalised."""
    path = scratch_path(spark, "item-index")
    rt.save_item_index(_items(spark, d), "fixture_model", METHODS, path)
    idx = rt.load_item_index(spark, path, "fixture_model", "cosine")
    return idx.select("movie_id", F.posexplode("i").alias("pos", "value")).select(
        "movie_id", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


_INDEX_SCORES = " union all ".join(f"select u.user_id, i.movie_id, '{m}' as scoring_method, " + sql_score(m, "u.u", "i.i") + f" as score from uvec u, ivec i" for m in METHODS)


@query("item_index_search", W("uvec", "ivec") + f"""
select user_id, scoring_method, rank, movie_id, round(score, 6) as score from (
  select *, row_number() over (partition by user_id, scoring_method order by case when scoring_method = 'l2' then round(score, 9) else -round(score, 9) end, movie_id) as rank
  from ({_INDEX_SCORES})) where rank <= 10""")
def q_item_index_search(spark, d):
    """Every user against the saved index of every method, in the order of the cells' bounds."""
    path, out = scratch_path(spark, "item-index"), None
    rt.save_item_index(_items(spark, d), "fixture_model", METHODS, path, cell_rows=32)
    for m in METHODS:
        found = rt.open_item_index(spark, path, "fixture_model", m).search(fx.user_vectors(spark, d), 10)
        one = found.select("user_id", F.lit(m).alias("scoring_method"), F.col("rank").cast("bigint").alias("rank"), "movie_id", R("score").alias("score"))
        out = one if out is None else out.unionByName(one)
    return out


@query("write_model_rows", _COLD + """
select 'model_a' as model_name, count(*) as n from csr cross join labels where rank <= 5
union all select 'model_b', count(*) from csr cross join labels""")
def q_write_model_rows(spark, d):
    """Write two models' cold-start rows, then rewrite one model only: the other model's rows stay."""
    from marquee.operators.buckets import read_model_rows, write_model_rows
    path = scratch_path(spark, "serving")
    items, mem = _items(spark, d), _membership(spark, d)
    full = rt.cold_start_genre(items, mem, METHODS, 20)
    write_model_rows(full.withColumn("model_name", F.lit("model_a")), path)
    write_model_rows(full.withColumn("model_name", F.lit("model_b")), path)
    write_model_rows(rt.cold_start_genre(items, mem, METHODS, 5).withColumn("model_name", F.lit("model_a")), path)
    return read_model_rows(spark, path).groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))
