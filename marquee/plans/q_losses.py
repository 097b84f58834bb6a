"""Loss, evaluation and model-side queries over the vector fixtures."""
from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import vectors as V
from marquee.operators import losses as ls
from marquee.plans import data
from marquee.plans.catalog import R, query
from marquee.plans.q_split import _SPLIT
from marquee.session import materialize, scratch_path
from marquee.plans.oracle_views import VOCAB, with_views as W
from marquee.plans.q_retrieval import sql_score
from marquee.sources import fixtures as fx


def _masked_sql(s, t, mask):
    return (f"list_sum(list_transform(range(1, len({s}) + 1), lambda j: case when j <= {mask} then 0.0e0 "
            f"else ({s}[j] - {t}[j]) * ({s}[j] - {t}[j]) end))")


_MSE_ROWS = ("mse", "select k, batch_id, weight * power((" + sql_score("cosine", "uv", "iv") +
             " + 1.0e0) / 2.0e0 - rating / 5.0e0, 2) as loss from fx_pairs")


@query("weighted_mse", W("fx_pairs", extra=[_MSE_ROWS]) +
       "select batch_id, round(avg(loss), 6) as loss from mse group by batch_id")
def q_weighted_mse(spark, d):
    return ls.weighted_mse(fx.fx_pairs(spark, d)).select("batch_id", R("loss").alias("loss"))


_INFONCE = [
    ("sim", "select a.batch_id, a.k as i, b.k as j, (" + sql_score("cosine", "a.uv", "b.iv") +
            ") / 0.07e0 * (case when a.k = b.k then a.weight else 1.0e0 end) as x "
            "from fx_pairs a join fx_pairs b on a.batch_id = b.batch_id"),
    ("rl", "select batch_id, i, max(m) + ln(sum(exp(x - m))) as lse from "
           "(select *, max(x) over (partition by batch_id, i) as m from sim) group by batch_id, i"),
    ("cl", "select batch_id, j, max(m) + ln(sum(exp(x - m))) as lse from "
           "(select *, max(x) over (partition by batch_id, j) as m from sim) group by batch_id, j"),
    ("dg", "select batch_id, i, x from sim where i = j"),
    ("lu", "select rl.batch_id, avg(rl.lse - dg.x) as l from rl join dg on rl.batch_id = dg.batch_id and rl.i = dg.i "
           "group by rl.batch_id"),
    ("li", "select cl.batch_id, avg(cl.lse - dg.x) as l from cl join dg on cl.batch_id = dg.batch_id and cl.j = dg.i "
           "group by cl.batch_id"),
]


@query("infonce_loss", W("fx_pairs", extra=_INFONCE) + """
select lu.batch_id, round((lu.l + li.l) / 2.0e0, 6) as loss from lu join li on lu.batch_id = li.batch_id""")
def q_infonce_loss(spark, d):
    return ls.infonce_loss(fx.fx_pairs(spark, d)).select("batch_id", R("loss").alias("loss"))


#: One batch of all pairs, and the last pairs once more in batches of their own.
_INFONCE_LARGE = [("lp", "select -1 as batch_id, k, uv, iv, weight from fx_pairs union all select k // 16, k, uv, iv, weight from fx_pairs where k % 32 < 16")] + [
    (name, body.replace("fx_pairs", "lp")) for name, body in _INFONCE]


@query("infonce_loss_large_batch", W("fx_pairs", extra=_INFONCE_LARGE) + """
select lu.batch_id, round((lu.l + li.l) / 2.0e0, 6) as loss from lu join li on lu.batch_id = li.batch_id""")
def q_infonce_loss_large_batch(spark, d):
    """A batch of all pairs, many times a tile, next to small ones."""
    p = fx.fx_pairs(spark, d).select("k", "uv", "iv", "weight")
    small = p.where(F.col("k") % 32 < 16).withColumn("batch_id", F.floor(F.col("k") / 16))
    rows = p.withColumn("batch_id", F.lit(-1).cast("long")).unionByName(small)
    return ls.infonce_loss(rows, tile=32).select("batch_id", R("loss").alias("loss"))


@query("embedding_kl", W("fx_pairs") + f"""
select batch_id, round(0.5e0 * sum({_masked_sql('uv', 'iv', 8)}) / (count(*) * max(len(uv))), 6) as kl
from fx_pairs group by batch_id""")
def q_embedding_kl(spark, d):
    return ls.embedding_kl(fx.fx_pairs(spark, d), "uv", "iv", mask_dims=8).select("batch_id", R("kl").alias("kl"))


@query("cross_kl", W("fx_pairs", extra=[
    ("ct", "select batch_id, list_concat(uv, iv) as s, list_concat(iv, uv[1:32]) as t from fx_pairs"),
    ("cc", "select batch_id, s[1:least(len(s), len(t))] as s, t[1:least(len(s), len(t))] as t from ct")]) + f"""
select batch_id, round(0.5e0 * sum({_masked_sql('s', 't', 0)}) / (count(*) * max(len(s))), 6) as kl
from cc group by batch_id""")
def q_cross_kl(spark, d):
    p = fx.fx_pairs(spark, d).withColumn("tu", F.col("iv")).withColumn("ti", F.slice("uv", 1, 32))
    return ls.cross_kl(p, "uv", "iv", "tu", "ti").select("batch_id", R("kl").alias("kl"))


@query("model_pairs", W("fx_metrics", extra=[("mm", "select distinct metric from fx_metrics")]) + """
select t.metric as teacher, s.metric as student from mm t join mm s on t.metric <> s.metric""")
def q_model_pairs(spark, d):
    return ls.model_pairs(fx.fx_metrics(spark, d), col="metric")


@query("batch_mean_loss", W("fx_pairs", extra=[_MSE_ROWS]) + """
select round(avg(m), 6) as loss from (select k // 20 as b, avg(loss) as m from mse group by k // 20)""")
def q_batch_mean_loss(spark, d):
    rows = ls.weighted_mse_rows(fx.fx_pairs(spark, d))
    return ls.batch_mean_loss(rows, "k", 20).select(R("loss").alias("loss"))


@query("embedding_norm_stats", W("uvec", "ivec") + """
select (select round(avg(sqrt(list_dot_product(u, u))), 6) from uvec) as mean_user_norm,
       (select round(avg(sqrt(list_dot_product(i, i))), 6) from ivec) as mean_item_norm""")
def q_embedding_norm_stats(spark, d):
    s = ls.embedding_norm_stats(fx.user_vectors(spark, d), fx.item_vectors(spark, d))
    return s.select(R("mean_user_norm").alias("mean_user_norm"), R("mean_item_norm").alias("mean_item_norm"))


@query("best_epoch", W("fx_metrics") + """
select run_id, step as best_epoch, value as best_value from (
  select *, row_number() over (partition by run_id order by value, step) as rn_ from fx_metrics where metric = 'view')
where rn_ = 1""")
def q_best_epoch(spark, d):
    m = fx.fx_metrics(spark, d).filter(F.col("metric") == "view")
    return ls.best_epoch(m)


@query("ema_blend", W("fx_pairs") + """
select k, pos, round(0.5e0 * c + 0.5e0 * p, 6) as value from (
  select k, unnest(range(len(iv))) as pos, unnest(iv) as c, unnest(uv) as p from fx_pairs)""")
def q_ema_blend(spark, d):
    p = fx.fx_pairs(spark, d)
    b = ls.ema_blend(p.select("k", F.col("uv").alias("v")), p.select("k", F.col("iv").alias("v")), "k", "v", 0.5)
    return b.select("k", F.posexplode("v").alias("pos", "value")).select(
        "k", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


@query("lookup_user_vectors", W("rk", "uvec") + """
select u.user_id, len(u.u) as dim, round(sqrt(list_dot_product(u.u, u.u)), 6) as norm
from (select distinct user_id from rk) r join uvec u on r.user_id = u.user_id""")
def q_lookup_user_vectors(spark, d):
    req = data.ratings(spark, d).select("user_id").distinct()
    v = req.join(fx.user_vectors(spark, d), "user_id")
    return v.select("user_id", F.size("u").cast("bigint").alias("dim"), R(V.norm("u")).alias("norm"))


@query("best_trial", W("fx_metrics", extra=[
    ("last", "select run_id, arg_max(value, step) as v from fx_metrics where metric = 'view' group by run_id"),
    ("trials", "select r.run_id, coalesce(l.v, 9999.0e0) as v from (select distinct run_id from fx_metrics) r "
               "left join last l on r.run_id = l.run_id")]) + """
select run_id, v as value from trials order by v, run_id limit 1""")
def q_best_trial(spark, d):
    from marquee.operators.factors import best_trial
    m = fx.fx_metrics(spark, d)
    last = m.filter(F.col("metric") == "view").groupBy("run_id").agg(F.max_by("value", "step").alias("v"))
    trials = m.select("run_id").distinct().join(last, "run_id", "left").select(
        "run_id", F.coalesce("v", F.lit(9999.0)).alias("value"))
    return best_trial(trials, "run_id", "value")


@query("pending_combos", W("fx_metrics") + """
select distinct arch, metric from fx_metrics
except select distinct arch, metric from fx_metrics where metric in ('view', 'click')""")
def q_pending_combos(spark, d):
    from marquee.operators.factors import pending_combos
    m = fx.fx_metrics(spark, d)
    combos = m.select("arch", "metric").distinct()
    cached = m.filter(F.col("metric").isin("view", "click")).select("arch", "metric").distinct()
    return pending_combos(combos, cached, ["arch", "metric"])


# ---------------------------------------------------------------- encoders and factor models (rows-only)

def _towers(spark, d):
    from marquee.operators import encode as en
    from marquee.operators import features as fe
    rk, mv = data.ratings(spark, d), data.movies(spark, d)
    path = scratch_path(spark, "tower-weights")
    en.save_weights(spark, fx.tower_weights(embed_dim=64), path)
    w = en.load_weights(spark, path)
    return rk, mv, w, en, fe


def _layer_sql(name: str, src: str, rows: int, cols: int, a: int, b: int, norm: bool) -> list[tuple[str, str]]:
    """One dense layer (rule weights, bias (r % 5 - 2) / 50) [+ LayerNorm + ReLU] over long rows (user_id, pos, v)."""
    w = f"((((h.h * {a} + x.pos * {b}) % 97) - 48) / 97.0e0 / sqrt({cols}))"
    z = (f"select x.user_id, h.h, sum(x.v * {w}) + ((h.h % 5) - 2) / 50.0e0 as z from {src} x "
         f"cross join (select unnest(range({rows})) as h) h group by x.user_id, h.h")
    if not norm:
        return [(name, z)]
    return [(f"{name}_z", z),
            (name, f"select user_id, h as pos, greatest((z - avg(z) over w) / sqrt(var_pop(z) over w + 1e-5), 0.0e0) "
                   f"as v from {name}_z window w as (partition by user_id)")]


def _encode_items_sql() -> str:
    x_in = [
        ("slots", f"select unnest(range(0, 20)) as pos, unnest({VOCAB}) as genre"),
        ("items", "select movie_id, coalesce(nullif(cast(nullif(regexp_extract(title, '\\((\\d{4})\\)', 1), '') "
                  "as int), 0), 1995) as year, string_split(genres, '|') as gl from fx_movies"),
        ("emb", "select i.movie_id as user_id, unnest(range(len(i.i))) as pos, unnest(i.i) as v from ivec i "
                "where i.movie_id in (select movie_id from items)"),
        ("x0", "select user_id, pos, v from emb union all "
               "select it.movie_id, 64 + s.pos, case when list_contains(it.gl, s.genre) then 1.0e0 else 0.0e0 end "
               "from items it cross join slots s union all select movie_id, 84, cast(year as double) from items"),
    ]
    layers = (_layer_sql("a1", "x0", 256, 85, 38, 17, True) + _layer_sql("a2", "a1", 128, 256, 39, 19, True)
              + _layer_sql("a3", "a2", 128, 128, 40, 21, False))
    return (W("fx_movies", "ivec", extra=x_in + layers) +
            "select user_id as movie_id, h as pos, round(z, 6) as value from a3")


@query("encode_items", _encode_items_sql())
def q_encode_items(spark, d):
    """Item tower over item features; id embeddings = the item vector table joined on movie_id."""
    rk, mv, w, en, fe = _towers(spark, d)
    itf = fe.item_base_features(mv)  # the item tower reads multi-hot and year only
    emb = fx.item_vectors(spark, d).select("movie_id", F.col("i").alias("emb"))
    v = en.encode_items(itf, emb, w)
    return v.select("movie_id", F.posexplode("vec").alias("pos", "value")).select("movie_id", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


def _encode_users_sql() -> str:
    from marquee.plans.q_lookup import _TOPG
    x_in = [
        ("st", "select user_id, count(*) as cnt, avg(rating) as av from rk group by user_id"),
        ("emb", "select u.user_id, unnest(range(len(u.u))) as pos, unnest(u.u) as v from uvec u "
                "where u.user_id in (select user_id from st)"),
        ("hid", "select a.user_id, h.h as pos, greatest(sum(a.v * ((((h.h * 11 + a.pos * 5) % 97) - 48) / 97.0e0 "
                "/ sqrt(20))), 0.0e0) as v from affv a cross join (select unnest(range(32)) as h) h "
                "group by a.user_id, h.h"),
        ("x0", "select user_id, pos, v from emb union all select user_id, 64 + pos, v from affv "
               "union all select user_id, 84 + pos, v from hid union all select user_id, 116, cnt from st "
               "union all select user_id, 117, av from st"),
    ]
    layers = (_layer_sql("a1", "x0", 256, 118, 31, 17, True) + _layer_sql("a2", "a1", 128, 256, 32, 19, True)
              + _layer_sql("a3", "a2", 128, 128, 33, 21, False))
    return (W("rk", "wrk", "mg", "uvec", extra=_TOPG[:3] + x_in + layers) +
            "select user_id, h as pos, round(z, 6) as value from a3")


@query("encode_users", _encode_users_sql())
def q_encode_users(spark, d):
    """User tower over user features; id embeddings = the user vector table joined on user_id."""
    rk, mv, w, en, fe = _towers(spark, d)
    uf = fe.user_features(rk, mv)
    emb = fx.user_vectors(spark, d).select("user_id", F.col("u").alias("emb"))
    v = en.encode_users(uf, emb, w)
    return v.select("user_id", F.posexplode("vec").alias("pos", "value")).select("user_id", F.col("pos").cast("bigint").alias("pos"), R("value").alias("value"))


def _train_val(spark, d):
    from marquee.operators import samples as sm
    from marquee.operators import split as sp
    rk = data.ratings(spark, d)
    w = sm.sample_decay_weights(sp.load_splits(rk, sp.temporal_split(rk)))
    return w.filter(F.col("split") == "train"), w.filter(F.col("split") == "val")


def _fit_sql(name: str, iters: int, reg: float, background: float, seed: int = 42) -> str:
    """CTEs of a fit of rank 2 on ff_rows(user_id, movie_id, w, y): half-steps with 2 x 2 normal equations solved by Cramer's rule.
    The vectors end in {name}_u and {name}_i (id, a, b)."""
    from marquee.operators.factors import START as S
    start = ", ".join(f"((({{own}}) + {j} * {S['B']}) % {S['M']}) / {S['M']}.0e0 - 0.5e0 as {c}" for j, c in ((1, "a"), (2, "b")))
    own = f"(((movie_id % {S['M']}) + {S['M']}) % {S['M']} * {S['A']} + {seed % S['M'] * S['C']}) % {S['M']}"
    out = [f"{name}_i0 as materialized (select distinct movie_id as id, {start.replace('{own}', own)} from ff_rows)"]

    def step(new: str, old: str, side: str, other: str) -> None:
        out.append(f"{new}_g as materialized (select sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb from {old})")
        out.append(f"""{new} as materialized (
  select id, (m22 * r1 - m12 * r2) / (m11 * m22 - m12 * m12) as a, (m11 * r2 - m12 * r1) / (m11 * m22 - m12 * m12) as b from (
    select r.{side} as id, any_value({background}e0 * g.aa) + {reg}e0 + sum(r.w * o.a * o.a) as m11,
           any_value({background}e0 * g.ab) + sum(r.w * o.a * o.b) as m12, any_value({background}e0 * g.bb) + {reg}e0 + sum(r.w * o.b * o.b) as m22,
           sum(r.w * r.y * o.a) as r1, sum(r.w * r.y * o.b) as r2
    from ff_rows r join {old} o on r.{other} = o.id, {new}_g g group by r.{side}))""")

    for n in range(1, iters + 1):
        last = n == iters
        step(f"{name}_u" if last else f"{name}_u{n}", f"{name}_i{n - 1}", "user_id", "movie_id")
        step(f"{name}_i" if last else f"{name}_i{n}", f"{name}_u" if last else f"{name}_u{n}", "movie_id", "user_id")
    return ",\n".join(out)


_FF_ROWS = """, ff_rows as materialized (select user_id, movie_id, weight as w, rating / 5.0e0 as y from wsp where split = 'train')"""


@query("fit_factors", W("rk", extra=_SPLIT[:5]) + _FF_ROWS + ",\n" + _fit_sql("f", 2, 0.1, 0.1) + """,
f_obj as (
  select (select sum(r.w * power(r.y - u.a * i.a - u.b * i.b, 2)) from ff_rows r join f_u u on r.user_id = u.id join f_i i on r.movie_id = i.id) as fit,
         (select 0.1e0 * sum(p.x) from (select (u.aa * i.aa + 2 * u.ab * i.ab + u.bb * i.bb) as x
            from (select sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb from f_u) u,
                 (select sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb from f_i) i) p) as pairs,
         0.1e0 * ((select sum(a * a + b * b) from f_u) + (select sum(a * a + b * b) from f_i)) as size)
select 'user' as side, id, round(a, 6) as a, round(b, 6) as b from f_u
union all select 'item', id, round(a, 6), round(b, 6) from f_i
union all select 'fit and pairs', 0, round(fit, 6), round(pairs, 6) from f_obj
union all select 'size and objective', 0, round(size, 6), round(fit + pairs + size, 6) from f_obj""")
def q_fit_factors(spark, d):
    """Weighted factors of the train split, every value of both sides, and the terms of the objective that they minimise."""
    from marquee.operators.factors import fit_factors, objective
    train = materialize(_train_val(spark, d)[0], "train-split")
    _, users, items = fit_factors(train, rank=2, max_iter=2)
    o = objective(train, users, items)
    cells = [users.select(F.lit("user").alias("side"), F.col("user_id").cast("long").alias("id"), F.col("u")[0].alias("a"), F.col("u")[1].alias("b")),
             items.select(F.lit("item"), F.col("movie_id").cast("long"), F.col("i")[0], F.col("i")[1]),
             o.select(F.lit("fit and pairs"), F.lit(0).cast("long"), "fit", "background"),
             o.select(F.lit("size and objective"), F.lit(0).cast("long"), "size", "objective")]
    out = cells[0]
    for c in cells[1:]:
        out = out.union(c)
    return out.select("side", "id", R("a").alias("a"), R("b").alias("b"))


def _val_loss_sql(name: str) -> str:
    return f"""(select round(avg(v.weight * power(coalesce(u.a * i.a + u.b * i.b, 0) - v.rating / 5.0e0, 2)), 6)
   from wsp v left join {name}_u u on v.user_id = u.id left join {name}_i i on v.movie_id = i.id where v.split = 'val')"""


@query("sweep_factors", W("rk", extra=_SPLIT[:5]) + _FF_ROWS + ",\n" + _fit_sql("p", 1, 0.1, 0.1) + ",\n" + _fit_sql("q", 2, 0.5, 0.01) + f""",
va as (select * from wsp where split = 'val'),
unseen as (select count(*) as n from va where user_id not in (select user_id from ff_rows) or movie_id not in (select movie_id from ff_rows))
select t.trial, t.params, t.loss as val_loss, (select count(*) from va) as n_val, (select n from unseen) as n_unseen, cast(null as varchar) as error
from (values (0, '[(''background'', 0.1), (''max_iter'', 1), (''rank'', 2), (''reg'', 0.1)]', {_val_loss_sql('p')}),
             (1, '[(''background'', 0.01), (''max_iter'', 2), (''rank'', 2), (''reg'', 0.5)]', {_val_loss_sql('q')})) as t(trial, params, loss)
union all select 2, '[(''max_iter'', 3), (''rank'', -1)]', 9999.0, null, null, 'ValueError'""")
def q_sweep_factors(spark, d):
    """Two settings scored on every row of the temporal validation split (with the rows whose user or movie the train split
    lacks), and a third that cannot be fitted: its error is kept."""
    from marquee.operators.factors import sweep_factors
    train, val = _train_val(spark, d)
    trials = sweep_factors(train, val, [{"rank": 2, "max_iter": 1, "reg": 0.1, "background": 0.1}, {"rank": 2, "max_iter": 2, "reg": 0.5, "background": 0.01},
                                        {"rank": -1, "max_iter": 3}])
    return trials.select("trial", "params", R("val_loss").alias("val_loss"), "n_val", "n_unseen",
                         F.regexp_extract("error", "^([A-Za-z]+)", 1).alias("error"))
