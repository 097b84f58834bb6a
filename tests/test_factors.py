import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import factors


@pytest.fixture()
def interactions(spark):
    rows = [(u, m, float(1 + (u * m) % 5), 0.5 + ((u + m) % 5) / 10.0) for u in range(20) for m in range(15) if (u + m) % 3]
    return spark.createDataFrame(rows, "user_id int, movie_id int, rating double, weight double")


def test_fit_is_seed_stable_and_shaped(interactions):
    _, u1, i1 = factors.fit_factors(interactions, rank=4, max_iter=3)
    _, u2, _ = factors.fit_factors(interactions, rank=4, max_iter=3)
    a = {r.user_id: r.u for r in u1.collect()}
    b = {r.user_id: r.u for r in u2.collect()}
    assert set(a) == set(range(20)) and all(len(v) == 4 for v in a.values())
    assert all(max(abs(x - y) for x, y in zip(a[k], b[k])) < 1e-6 for k in a)
    assert i1.count() == 15


def test_sweep_and_best_trial(interactions):
    train = interactions.filter(F.col("movie_id") < 12)
    val = interactions.filter(F.col("movie_id") >= 12)
    trials = factors.sweep_factors(train, val, [{"rank": 2, "max_iter": 2}, {"rank": 4, "max_iter": 2}])
    rows = trials.collect()
    assert len(rows) == 2 and all(r.val_loss >= 0 for r in rows)
    best = factors.best_trial(trials).first()
    assert best.val_loss == min(r.val_loss for r in rows)


def test_failed_trials_carry_the_sentinel(spark):
    t = spark.createDataFrame([(0, None), (1, 2.0)], "trial int, val_loss double")
    assert factors.best_trial(t).first().trial == 1


def test_pending_combos(spark):
    combos = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "arch string, loss string")
    cached = spark.createDataFrame([("a", "x")], "arch string, loss string")
    got = sorted(tuple(r) for r in factors.pending_combos(combos, cached, ["arch", "loss"]).collect())
    assert got == [("a", "y"), ("b", "x")]


def test_fit_margin_and_unseen_rows(spark, interactions):
    train = interactions.filter(F.col("movie_id") < 12)
    model, users, items = factors.fit_factors(train, rank=4, max_iter=3)
    assert factors.fit_margin(train, users, items) > 0.05
    flat = users.withColumn("u", F.expr("transform(u, x -> 0.5D)"))
    assert abs(factors.fit_margin(train, flat, items.withColumn("i", F.expr("transform(i, x -> 0.5D)")))) < 1e-9
    r = factors.validation_loss(model, interactions).first()
    assert (r.n_val, r.n_unseen) == (interactions.count(), interactions.filter("movie_id >= 12").count()) and r.val_loss > 0


def test_sweep_keeps_errors(interactions):
    rows = factors.sweep_factors(interactions, interactions, [{"rank": 2, "max_iter": 1}, {"rank": -3}]).collect()
    assert rows[0].error is None and rows[1].val_loss == factors.FAILED_LOSS and "rank" in rows[1].error


def by_hand(rows, rank, reg, background, iters, seed):
    """Alternating least squares with dense matrices."""
    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    S = factors.START
    I = np.array([[((i % S["M"] * S["A"] + seed % S["M"] * S["C"]) % S["M"] + j * S["B"]) % S["M"] / S["M"] - 0.5 for j in range(1, rank + 1)] for i in items])

    def solve(other, pick, ids):
        base = background * other.T @ other + reg * np.eye(rank)
        out = []
        for x in ids:
            mine = [r for r in rows if r[pick] == x]
            f = np.array([other[(items if pick == 0 else users).index(r[1 - pick])] for r in mine])
            w, y = np.array([r[3] for r in mine]), np.array([r[2] / 5 for r in mine])
            out.append(np.linalg.solve(base + (f * w[:, None]).T @ f, f.T @ (w * y)))
        return np.array(out)

    for _ in range(iters):
        U = solve(I, 0, users)
        I = solve(U, 1, items)
    return dict(zip(users, U)), dict(zip(items, I))


@pytest.mark.parametrize("hot_rows", [10**9, 7])
def test_fit_is_weighted_least_squares(interactions, hot_rows):
    """Every value, also where most users and items are split over several tasks."""
    rows = [tuple(r) for r in interactions.collect()]
    data = interactions.unionByName(interactions.where("user_id = 3"))  # repeated pairs count twice
    rows += [r for r in rows if r[0] == 3]
    _, users, items = factors.fit_factors(data, rank=3, reg=0.2, max_iter=2, background=0.05, seed=7, hot_rows=hot_rows)
    want_u, want_i = by_hand(rows, 3, 0.2, 0.05, 2, 7)
    got = {r.user_id: r.u for r in users.collect()}
    assert set(got) == set(want_u) and all(got[k] == pytest.approx(want_u[k]) for k in got)
    got = {r.movie_id: r.i for r in items.collect()}
    assert set(got) == set(want_i) and all(got[k] == pytest.approx(want_i[k]) for k in got)


def test_objective_and_its_descent(interactions):
    rows = [tuple(r) for r in interactions.collect()]
    last = None
    for n in (1, 2, 5):
        _, users, items = factors.fit_factors(interactions, rank=2, max_iter=n)
        U, I = {r.user_id: np.array(r.u) for r in users.collect()}, {r.movie_id: np.array(r.i) for r in items.collect()}
        fit = sum(w * (r / 5 - U[u] @ I[i]) ** 2 for u, i, r, w in rows)
        pairs = 0.1 * sum((a @ b) ** 2 for a in U.values() for b in I.values())
        size = 0.1 * sum(v @ v for v in [*U.values(), *I.values()])
        o = factors.objective(interactions, users, items).first()
        assert (o.fit, o.background, o.size, o.objective) == tuple(pytest.approx(x) for x in (fit, pairs, size, fit + pairs + size))
        assert last is None or o.objective <= last + 1e-9
        last = o.objective


def test_weights_matter_and_nulls_take_no_part(spark):
    rows = [(1, 1, 5.0, 1.0), (1, 2, 1.0, 1.0), (2, 1, 1.0, 1.0), (2, 2, 5.0, 1.0), (3, 1, None, 1.0), (None, 1, 1.0, 1.0), (4, 1, 2.0, None)]
    df = spark.createDataFrame(rows, "user_id int, movie_id int, rating double, weight double")
    _, users, _ = factors.fit_factors(df, rank=2, max_iter=2)
    assert {r.user_id for r in users.collect()} == {1, 2}
    model, *_ = factors.fit_factors(df.withColumn("weight", F.when(F.col("movie_id") == 1, 50.0).otherwise(0.01)), rank=1, max_iter=8, background=0.0)
    pred = {(r.user_id, r.movie_id): r.prediction for r in model.transform(df.where("rating is not null")).collect() if r.prediction is not None}
    assert pred[1, 1] == pytest.approx(1.0, abs=0.05) and pred[2, 1] == pytest.approx(0.2, abs=0.05) and abs(pred[2, 2] - 1.0) > 0.2
    with pytest.raises(ValueError):
        factors.fit_factors(df, rank=0)
