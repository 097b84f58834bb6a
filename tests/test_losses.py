import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marquee.operators import losses as ls


def test_kl_known_values(spark):
    rows = [(0, k, [1.0] * 16, [0.0] * 16) for k in range(4)]
    df = spark.createDataFrame(rows, "batch_id int, k int, s array<double>, t array<double>")
    assert ls.embedding_kl(df, "s", "t", 0).first()["kl"] == pytest.approx(0.5)
    assert ls.embedding_kl(df, "s", "t", 8).first()["kl"] == pytest.approx(0.25)
    same = df.withColumn("t", F.col("s"))
    assert ls.embedding_kl(same, "s", "t").first()["kl"] == 0.0


def test_ema(spark):
    prev = spark.createDataFrame([(1, [0.0, 0.0])], "k int, v array<double>")
    cur = spark.createDataFrame([(1, [2.0, 2.0])], "k int, v array<double>")
    assert ls.ema_blend(prev, cur, "k", "v", 0.5).first()["v"] == [1.0, 1.0]


def test_infonce_matches_numpy(spark):
    rng = np.random.default_rng(3)
    U, I, w = rng.normal(size=(6, 5)), rng.normal(size=(6, 5)), rng.uniform(0.5, 1, 6)
    df = spark.createDataFrame([(0, k, [float(x) for x in U[k]], [float(x) for x in I[k]], float(w[k]))
                                for k in range(6)], "batch_id int, k int, uv array<double>, iv array<double>, weight double")
    Un = U / np.linalg.norm(U, axis=1, keepdims=True)
    In = I / np.linalg.norm(I, axis=1, keepdims=True)
    S = Un @ In.T / 0.07
    S[np.arange(6), np.arange(6)] *= w

    def ce(M):
        return np.mean(np.log(np.exp(M).sum(axis=1)) - np.diag(M))

    assert ls.infonce_loss(df).first()["loss"] == pytest.approx((ce(S) + ce(S.T)) / 2)


@pytest.mark.parametrize("tile", [1, 7, 64, 2048])
def test_tiled_infonce_equals_whole_batches(spark, tile):
    """Batches of 1 to 150 rows, equal rows and zero vectors among them, whatever the tile."""
    rng = np.random.default_rng(5)
    rows = []
    for b, n in enumerate([1, 2, 60, 150]):
        made = [(b, k, rng.normal(size=4).tolist(), rng.normal(size=4).tolist(), float(rng.uniform(0.2, 1))) for k in range(n)]
        rows += made
    rows += [(2, 900, [0.0] * 4, [1.0] * 4, 0.5)] + [rows[40]] * 20
    rows = [(None if b == 3 else b, *r) for b, *r in rows]
    df = spark.createDataFrame(rows, "batch_id long, k int, uv array<double>, iv array<double>, weight double")

    def by_hand(part):
        U, I = (np.array([r[c] for r in part]) for c in (2, 3))
        U, I = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) for m in (U, I))
        S = U @ I.T / 0.07
        at = np.arange(len(part))
        S[at, at] *= [r[4] for r in part]
        return np.mean([np.logaddexp.reduce(M, axis=1) - S[at, at] for M in (S, S.T)])

    got = {r.batch_id: r.loss for r in ls.infonce_loss(df, tile=tile).collect()}
    assert set(got) == {None, 0, 1, 2}
    for b, loss in got.items():
        assert loss == pytest.approx(by_hand([r for r in rows if r[0] == b]))
    assert ls.infonce_loss(df.limit(0)).count() == 0


def test_weighted_mse(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], [1.0, 0.0], 0.5, 5.0), (0, [1.0, 0.0], [-1.0, 0.0], 1.0, 5.0)],
                               "batch_id int, uv array<double>, iv array<double>, weight double, rating double")
    assert ls.weighted_mse(df).first()["loss"] == pytest.approx((0.0 + 1.0) / 2)


def test_batch_mean_of_means(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "k int, loss double")
    # batches of 2: [0,1] [2,3] [4] -> means 0.5, 2.5, 4 -> 7/3
    assert ls.batch_mean_loss(df, "k", 2).first()["loss"] == pytest.approx(7 / 3)


def test_model_pairs(spark):
    m = spark.createDataFrame([("a",), ("b",), ("c",)], "model_name string")
    assert ls.model_pairs(m).count() == 6
    assert ls.model_pairs(m.limit(1)).count() == 0


def test_best_epoch_first_lowest(spark):
    df = spark.createDataFrame([(1, 0, 3.0), (1, 1, 1.0), (1, 2, 1.0)], "run_id int, step int, value double")
    assert ls.best_epoch(df).first()["best_epoch"] == 1


def test_encoder_forward_matches_numpy(spark):
    from marquee.operators import encode as en
    from marquee.sources.fixtures import tower_weights as fx_tower_weights
    w = fx_tower_weights(embed_dim=4, hidden=(8,), output_dim=3)
    itf = spark.createDataFrame([(1, [1.0] + [0.0] * 19, 2001), (2, [0.0] * 20, 0)],
                                "movie_id int, genre_multihot array<double>, release_year int")
    emb = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4])], "movie_id int, emb array<double>")
    got = {r["movie_id"]: r["vec"] for r in en.encode_items(itf, emb, w).collect()}
    x2 = np.concatenate([np.zeros(4), np.zeros(20), [1995.0]])[None, :]
    assert np.allclose(got[2], en.mlp_forward(x2, w["item_mlp"])[0])
    assert len(got[1]) == 3


def test_best_epoch_ignores_epochs_without_a_number(spark):
    m = spark.createDataFrame([(1, 1, None), (1, 2, float("nan")), (1, 3, 0.5), (1, 4, 0.4), (2, 1, None)], "run_id int, step int, value double")
    assert [tuple(r) for r in ls.best_epoch(m).collect()] == [(1, 4, 0.4)]


def test_batches_are_dealt_and_checked(spark):
    import pytest
    rows = [(k, [1.0, float(k)], [float(k), 1.0], 1.0) for k in range(10)]
    pairs = spark.createDataFrame(rows, "k long, uv array<double>, iv array<double>, weight double")
    dealt = ls.with_batches(pairs, 4)
    assert {r["batch_id"]: r["count"] for r in dealt.groupBy("batch_id").count().collect()} == {0: 4, 1: 4, 2: 2}
    assert ls.infonce_loss(dealt).count() == 3
    # batches above a tile are cut, not refused
    tiled = {r.batch_id: r.loss for r in ls.infonce_loss(dealt, tile=3).collect()}
    assert tiled == {r.batch_id: pytest.approx(r.loss) for r in ls.infonce_loss(dealt).collect()}


@pytest.mark.parametrize("scale", [1.0, 2000.0])
def test_cell_states_in_strips(scale):
    """Rows' and columns' log-sums of a matrix in strips, with equal rows folded, are those of the unfolded matrix."""
    rng = np.random.default_rng(8)
    S, n = rng.normal(size=(11, 11)) * scale, rng.integers(1, 4, 11).astype(float)
    own = np.diagonal(S) * 0.3
    for mine in (own, None):
        rows, columns = ls._cell_states(lambda r: S[r].copy(), 11, 11, n, n, mine, strip_rows=3)
        for M, (top, total) in ((S, rows), (S.T, columns)):
            for i in range(11):
                x = np.repeat(M[i], n.astype(int))
                if mine is not None:
                    x[int(n[:i].sum())] = own[i]
                assert top[i] + np.log(total[i]) == pytest.approx(np.logaddexp.reduce(x))


@pytest.mark.parametrize("share", [8, 64])
def test_shares_of_a_large_batch(spark, monkeypatch, share):
    rng = np.random.default_rng(9)
    rows = [(0, k, rng.normal(size=4).tolist(), rng.normal(size=4).tolist(), float(rng.uniform(0.5, 1))) for k in range(60)]
    df = spark.createDataFrame(rows, "batch_id long, k long, uv array<double>, iv array<double>, weight double")
    want = ls.infonce_loss(df).first()["loss"]
    monkeypatch.setattr(ls, "SHARE_ROWS", share)
    assert ls.infonce_loss(df, tile=2).first()["loss"] == pytest.approx(want)


def test_forward_passes_are_bounded():
    from marquee.operators import encode as en
    pieces = list(en._pieces(pd.DataFrame({"movie_id": range(n)}) for n in (0, 2500, 3)))
    assert [len(p) for p in pieces] == [1024, 1024, 452, 3] and pieces[2]["movie_id"].tolist() == list(range(2048, 2500))
