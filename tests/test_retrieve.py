import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import retrieve as rt
from marquee.sources.fixtures import learned_head_weights


def _brute(U, uid, I, iid, pools, method, k):
    out = {}
    for a, u in zip(uid, U):
        for pool, members in pools.items():
            cand = []
            for b, i in zip(iid, I):
                if b not in members:
                    continue
                if method == "dot":
                    s = float(u @ i)
                elif method == "cosine":
                    s = float(u @ i / max(np.linalg.norm(u), 1e-8) / max(np.linalg.norm(i), 1e-8))
                else:
                    s = float(((u - i) ** 2).sum())
                cand.append((s if method == "l2" else -s, b, s))
            cand.sort()
            out[(a, pool)] = [b for _, b, _ in cand[:k]]
    return out


@pytest.fixture()
def vecs(spark):
    rng = np.random.default_rng(7)
    U, I = rng.normal(size=(40, 8)), rng.normal(size=(60, 8))
    uid, iid = list(range(40)), list(range(100, 160))
    pools = {"A": set(iid[:25]), "B": set(iid[20:]), "C": set(iid[::7])}
    users = spark.createDataFrame([(int(a), [float(x) for x in u]) for a, u in zip(uid, U)], "user_id int, u array<double>")
    items = spark.createDataFrame([(int(b), [float(x) for x in i]) for b, i in zip(iid, I)], "movie_id int, i array<double>")
    mem = spark.createDataFrame([(int(b), g) for g, s in pools.items() for b in s], "movie_id int, genre string")
    return U, uid, I, iid, pools, users, items, mem


@pytest.mark.parametrize("kw", [{}, {"user_block": 7, "item_block": 11}])
def test_topk_matches_brute_force(vecs, kw):
    U, uid, I, iid, pools, users, items, mem = vecs
    got = rt.topk_user_genre(users, items, mem, ("cosine", "dot", "l2"), k=5, **kw).collect()
    for m in ("cosine", "dot", "l2"):
        want = _brute(U, uid, I, iid, pools, m, 5)
        have = {}
        for r in sorted((r for r in got if r["scoring_method"] == m), key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], r["genre"]), []).append(r["movie_id"])
        assert have == want, m


def test_blocks_ship_nothing(vecs):
    """Small blocks cut the work inside a cell: the shares that are shipped, and so the tasks, stay the same; several shares merge."""
    U, uid, I, iid, pools, users, items, mem = vecs
    plan = lambda **kw: rt.topk_lists(users, items, mem, ("dot",), 5, **kw)._jdf.queryExecution().analyzed().toString()
    assert plan(user_block=2, item_block=2).count("Aggregate") == plan().count("Aggregate") < plan(share_items=20).count("Aggregate")
    got = rt.topk_user_genre(users, items, mem, ("cosine", "dot", "l2"), k=5, share_items=20).collect()
    for m in ("cosine", "dot", "l2"):
        have = {}
        for r in sorted((r for r in got if r["scoring_method"] == m), key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], r["genre"]), []).append(r["movie_id"])
        assert have == _brute(U, uid, I, iid, pools, m, 5), m


@pytest.mark.parametrize("most", [1, 7, 300, 4096])
def test_best_in_blocks_is_the_best_of_all(most):
    rng = np.random.default_rng(3)
    key = rng.integers(0, 40, (9, 900)).astype(np.float64)  # many ties
    pos = np.sort(rng.permutation(900)[:700])
    for k in (1, 5, 800):
        top, at = rt._best_of(key, pos, k, most)
        want = np.argsort(key[:, pos], axis=1, kind="stable")[:, :k]
        assert np.array_equal(at, want) and np.array_equal(top, np.take_along_axis(key[:, pos], want, 1))


def test_rows_of_one_user_merge_over_blocks(spark, vecs):
    """A user id that comes twice has one list where items are cut in blocks, whether or not the blocks are shipped."""
    *_, users, items, mem = vecs
    twice = users.where("user_id < 5").unionByName(users.where("user_id < 3"))
    got = [sorted(map(tuple, rt.topk_user_genre(twice, items, mem, ("dot", "l2"), k=4, **kw).collect()))
           for kw in ({"item_block": 11}, {"item_block": 11, "share_items": 20})]
    assert [r[:5] for r in got[0]] == [r[:5] for r in got[1]] and {(r[0], r[3]) for r in got[0]} == {(u, n) for u in range(5) for n in range(1, 5)}


def test_small_blocks_are_looked_at_together(monkeypatch):
    """Blocks of items give lists of k that merge, lists leave by blocks of users, and neither costs a look of its own."""
    rng = np.random.default_rng(13)
    U, I = rng.integers(-3, 4, (50, 4)).astype(np.float64), rng.integers(-3, 4, (400, 4)).astype(np.float64)  # many ties
    pools = [("all", np.arange(400)), ("some", np.arange(1, 400, 7))]
    looks, merged, real, lists = [], [], rt._Best.look_at, rt._Best._lists
    monkeypatch.setattr(rt._Best, "look_at", lambda *a: (looks.append(1), real(*a))[1])
    monkeypatch.setattr(rt._Best, "_lists", lambda *a: (merged.append(1), lists(*a))[1])
    out = []
    for kw in ({}, {"user_block": 8, "item_block": 8}):
        have, looks[:] = {}, []
        for ids, pool, m, items, scores in rt._topk_chunks(np.arange(50), U, np.arange(400), I, pools, ["dot", "l2"], 5, None, **kw):
            assert len(ids) <= kw.get("user_block", 50)
            have.update({(u, pool, m): (i.tolist(), s.tolist()) for u, i, s in zip(ids.tolist(), items, scores)})
        out.append((have, len(looks)))
    assert out[0] == out[1] and out[0][1] == 4 and merged
    for name, at in pools:
        want = np.argsort(-(U @ I[at].T), axis=1, kind="stable")[:, :5]
        assert [out[1][0][u, name, "dot"][0] for u in range(50)] == at[want].tolist()


@pytest.mark.parametrize("block", [1, 6, 64])
def test_lists_of_blocks_merge(block):
    rng = np.random.default_rng(block)
    key = rng.integers(0, 30, (500, 7)).astype(np.float64)
    for k in (1, 3, 20):
        best, places = rt._Best(7, k, block), np.sort(rng.permutation(900)[:500])
        best.look_at(places[:400], key[:400])
        best.look_at(places[400:], key[400:])
        assert np.array_equal(best.at, places[np.argsort(key, axis=0, kind="stable")[:k].T])


def test_pool_smaller_than_k(vecs):
    U, uid, I, iid, pools, users, items, mem = vecs
    got = rt.topk_user_genre(users, items, mem, ("dot",), k=20).filter("genre = 'C'").groupBy("user_id").count()
    assert {r["count"] for r in got.collect()} == {len(pools["C"])}


def test_ties_break_on_movie_id(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0])], "user_id int, u array<double>")
    items = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])], "movie_id int, i array<double>")
    for kw in ({}, {"item_block": 1}):
        got = rt.topk_global(users, items, ("dot",), k=2, **kw).orderBy("rank").collect()
        assert [r["movie_id"] for r in got] == [3, 5]


@pytest.mark.parametrize("kw", [{}, {"user_block": 5, "item_block": 9}])
def test_learned_head_matches_numpy(vecs, spark, kw):
    U, uid, I, iid, pools, users, items, mem = vecs
    head = learned_head_weights(8)
    got = (rt.topk_global(users, items, ("learned",), k=3, head=head, **kw)
           .filter("user_id = 0").orderBy("rank").collect())
    x = np.concatenate([np.repeat(U[:1], len(I), 0), I], axis=1)
    s = np.maximum(x @ head["w1"].T + head["b1"], 0) @ head["w2"][0] + head["b2"][0]
    order = np.argsort(-s, kind="stable")[:3]
    assert [r["movie_id"] for r in got] == [iid[j] for j in order]
    assert got[0]["score"] == pytest.approx(s[order[0]])


def test_cold_start_by_norm(spark):
    items = spark.createDataFrame([(1, [3.0, 4.0]), (2, [1.0, 0.0]), (3, [0.0, 6.0])], "movie_id int, i array<double>")
    mem = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A"), (3, "B")], "movie_id int, genre string")
    got = rt.cold_start_genre(items, mem, ("cosine", "dot"), k=2).filter("scoring_method = 'dot'").collect()
    a = [r["movie_id"] for r in sorted((r for r in got if r["genre"] == "A"), key=lambda r: r["rank"])]
    assert a == [3, 1]


def test_cold_start_sends_no_side_through_the_driver(vecs):
    *_, items, mem = vecs
    plan = rt.cold_start_genre(items, mem, ("dot",), k=2)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_serving_rows_are_rank_ordered(vecs):
    U, uid, I, iid, pools, users, items, mem = vecs
    top, cold = rt.precompute_serving(users, items, mem, "m", ("dot",), k=4)
    r = top.filter("user_id = 3 and genre = 'A'").first()
    assert len(r["movie_ids"]) == 4 and r["scores"] == sorted(r["scores"], reverse=True)
    assert rt.precompute_counts(top, cold).filter("table_name = 'cold_start_genre'").first()["n"] == 3


def test_genre_membership_skips_empty(spark):
    itf = spark.createDataFrame([(1, [0.0] * 20), (2, [1.0] + [0.0] * 18 + [1.0])], "movie_id int, genre_multihot array<double>")
    got = sorted((r["movie_id"], r["genre"]) for r in rt.genre_membership(itf).collect())
    assert got == [(2, "(no genres listed)"), (2, "Action")]


def test_kernel_chunking_does_not_change_results():
    """The cell budget only changes how the work is cut: tiny budgets give the same rows."""
    rng = np.random.default_rng(11)
    U, I = rng.normal(size=(13, 6)), rng.normal(size=(29, 6))
    uid, iid = np.arange(13), np.arange(100, 129)
    pools = [("A", np.arange(0, 29)), ("B", np.arange(3, 29, 4))]
    head = learned_head_weights(6)
    methods = ("cosine", "dot", "l2", "learned")
    big = rt._topk_block(uid, U, iid, I, pools, methods, 5, head, budget=1 << 22)
    small = rt._topk_block(uid, U, iid, I, pools, methods, 5, head, budget=40)
    key = ["user_id", "genre", "scoring_method"]
    a = big.sort_values(key).reset_index(drop=True)
    b = small.sort_values(key).reset_index(drop=True)
    assert [x.tolist() for x in a["movie_ids"]] == [x.tolist() for x in b["movie_ids"]]
    assert all(np.allclose(x, y) for x, y in zip(a["scores"], b["scores"]))


def test_cell_output_is_bounded():
    for pools, methods, k in ((20, 4, 20), (1, 1, 5), (20, 3, 1000)):
        block = rt.default_user_block(pools, methods, k)
        assert 12 * pools * methods * k * block <= rt.OUT_BYTES and block <= 65_536
    rng = np.random.default_rng(2)
    U, I = rng.normal(size=(7, 4)), rng.normal(size=(11, 4))
    args = (np.arange(7), U, np.arange(11), I, [("a", np.arange(11)), ("b", np.array([3]))], ["dot", "l2"], 5, None)
    table, frame = rt._topk_table(*args), rt._topk_block(*args)
    assert table["movie_ids"].to_pylist() == [x.tolist() for x in frame["movie_ids"]]
    assert table["scores"].to_pylist() == [x.tolist() for x in frame["scores"]] and table["genre"].to_pylist() == frame["genre"].tolist()
    # an entry takes 12 bytes and a list some more, however they are chunked
    assert table.nbytes < 12 * 7 * 2 * 6 + 40 * table.num_rows


def test_best_columns_with_ties():
    key = np.array([[3.0, 1.0, 2.0, 1.0, 1.0], [5.0, 5.0, 5.0, 5.0, 5.0]])
    assert rt._best(key, 2).tolist() == [[1, 3], [0, 1]]
    assert rt._best(key, 9).tolist() == [[1, 3, 4, 2, 0], [0, 1, 2, 3, 4]]


def test_learned_without_a_head_raises(vecs):
    *_, users, items, mem = vecs
    with pytest.raises(ValueError, match="needs the weights"):
        rt.topk_user_genre(users, items, mem, ("learned",))


def test_search_of_a_loaded_index(vecs, spark, tmp_path):
    U, uid, I, iid, pools, users, items, mem = vecs
    rt.save_item_index(items, "m", ("cosine", "l2"), str(tmp_path / "ix"))
    for method in ("cosine", "l2"):
        got = rt.search_item_index(rt.load_item_index(spark, str(tmp_path / "ix"), "m", method), users, method, 4).collect()
        want = _brute(U, uid, I, iid, {"*": set(iid)}, method, 4)
        have = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], "*"), []).append(r["movie_id"])
        assert have == want


@pytest.mark.parametrize("method", ["cosine", "dot", "l2"])
def test_opened_index_is_exact_and_prunes(spark, tmp_path, method):
    """Well-parted items: the answer of all items, from a few files; ties and equal vectors among them."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 10, (30, 8))
    I = np.concatenate([c + rng.normal(0, 0.05, (40, 8)) for c in centres])
    I[5] = I[6] = I[900]
    iid = rng.permutation(len(I)) + 1
    U = np.stack([I[0] + 0.01, I[400], I[900], I[900] * 2])
    items = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(iid, I)] + [(5000, None), (5001, [])], "movie_id int, i array<double>")
    users = spark.createDataFrame([(n, u.tolist()) for n, u in enumerate(U)] + [(77, None)], "user_id int, u array<double>")
    rt.save_item_index(items, "m/1", (method,), str(tmp_path / "ix"), cell_rows=20)
    index = rt.open_item_index(spark, str(tmp_path / "ix"), "m/1", method)
    assert len(index.cell) > 25 and index.n.sum() == len(I)
    for k in (1, 7, 50):
        got = rt.search_item_index(index, users, method, k).collect()
        want = _brute(U, list(range(len(U))), I, iid, {"*": set(iid)}, method, k)
        have = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], "*"), []).append(r["movie_id"])
        assert have == want
        read = set(index.probed) | set(index.opened)
        assert len(read) < len(index.cell) / 2  # files of other cells are not opened
        assert {f.rsplit("cell=", 1)[1].split("/")[0] for f in index.rows(sorted(read)).inputFiles()} == {str(c) for c in read}
    rt.save_item_index(items.limit(3), "m/1", (method,), str(tmp_path / "ix"))  # a new version replaces the model's index
    assert rt.load_item_index(spark, str(tmp_path / "ix"), "m/1", method).count() == 3
    with pytest.raises(FileNotFoundError):
        rt.open_item_index(spark, str(tmp_path / "ix"), "other", method)


@pytest.mark.parametrize("method", ["cosine", "dot", "l2"])
def test_opened_index_without_structure(spark, tmp_path, method):
    """Random vectors leave nothing to prune; the answer stays exact, also for more than there is."""
    rng = np.random.default_rng(6)
    I, U = rng.normal(size=(60, 5)), rng.normal(size=(9, 5))
    U[0] = 0
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(I)], "movie_id int, i array<double>")
    users = spark.createDataFrame([(n, u.tolist()) for n, u in enumerate(U)], "user_id int, u array<double>")
    rt.save_item_index(items, "m", (method,), str(tmp_path / "ix"), cell_rows=4)
    for k in (4, 100):
        got = rt.open_item_index(spark, str(tmp_path / "ix"), "m", method).search(users, k).collect()
        want = _brute(U, list(range(9)), I, np.arange(60), {"*": set(range(60))}, method, k)
        have = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], "*"), []).append(r["movie_id"])
        assert have == want


def test_a_query_goes_to_a_group_of_cells_once(spark, tmp_path, monkeypatch):
    """Many small cells: a query's vector is sent once to a group of them, not once to each; groups and parts of large cells are exact."""
    from marquee.operators import item_index as ix
    rng = np.random.default_rng(12)
    I, U = rng.normal(size=(200, 6)), rng.normal(size=(20, 6))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(I)], "movie_id int, i array<double>")
    users = spark.createDataFrame([(n, u.tolist()) for n, u in enumerate(U)], "user_id int, u array<double>")
    rt.save_item_index(items, "m", ("dot",), str(tmp_path / "ix"), cell_rows=2)
    index = rt.open_item_index(spark, str(tmp_path / "ix"), "m", "dot")
    q = users.withColumn("query", F.col("user_id").cast("long")).withColumn("kth", F.lit(float("inf")))
    assert len(index.cell) > 50 and q.mapInPandas(index._wanted(200, True), index._WANTED).count() == len(U)
    for rows in (32_768, 30, 1):
        monkeypatch.setattr(ix, "GROUP_ROWS", rows)
        have = {}
        for r in sorted(index.search(users, 5).collect(), key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], "*"), []).append(r["movie_id"])
        assert have == _brute(U, range(20), I, range(200), {"*": set(range(200))}, "dot", 5)


def test_queries_do_not_carry_the_cells_they_need(spark, tmp_path):
    """Nothing to prune: a query needs all cells, and takes no more than its best ones with it to a group."""
    rng = np.random.default_rng(14)
    I, U = rng.normal(size=(200, 6)), rng.normal(size=(20, 6))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(I)], "movie_id int, i array<double>")
    users = spark.createDataFrame([(n, u.tolist()) for n, u in enumerate(U)], "user_id int, u array<double>")
    rt.save_item_index(items, "m", ("dot",), str(tmp_path / "ix"), cell_rows=2)
    index = rt.open_item_index(spark, str(tmp_path / "ix"), "m", "dot")
    q = users.withColumn("query", F.col("user_id").cast("long")).withColumn("kth", F.lit(float("inf"))).coalesce(1)
    for probe in (True, False):
        rows = q.mapInPandas(index._wanted(3, probe), index._WANTED).collect()
        assert len(rows) == len(U) and all(1 <= len(r["cells"]) <= 3 for r in rows)
        best, fresh = {c for r in rows for c in r["cells"]}, [c for r in rows for c in r["fresh"]]
        assert len(fresh) == len(set(fresh)) and set(fresh) == (best if probe else set(index.cell.tolist()))


def test_many_cells_share_folders(spark, tmp_path, monkeypatch):
    """The folders of an index are bounded, its cells are still told apart; an index with a folder per method and cell stays readable."""
    import os
    import shutil

    from marquee.operators import item_index as ix
    rng = np.random.default_rng(15)
    I, U = rng.normal(size=(200, 6)), rng.normal(size=(20, 6))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(I)], "movie_id int, i array<double>")
    users = spark.createDataFrame([(n, u.tolist()) for n, u in enumerate(U)], "user_id int, u array<double>")

    def answers(index, method):
        have = {}
        for r in sorted(index.search(users, 5).collect(), key=lambda r: r["rank"]):
            have.setdefault((r["user_id"], "*"), []).append(r["movie_id"])
        assert have == _brute(U, range(20), I, range(200), {"*": set(range(200))}, method, 5)

    with monkeypatch.context() as m:
        m.setattr(ix, "FOLDERS", 8)
        rt.save_item_index(items, "m", ("dot", "l2"), str(tmp_path / "ix"), cell_rows=2)
    index = rt.open_item_index(spark, str(tmp_path / "ix"), "m", "l2")
    assert len(index.cell) > 50 and sum(x.startswith("cell=") for x in os.listdir(index.folder)) <= 8
    some = index.cell[[0, 7, 20]].tolist()
    assert {r["cell"] for r in index.rows(some).collect()} == set(some) and index.rows(some).count() == index.n[[0, 7, 20]].sum()
    answers(index, "l2")
    rt.save_item_index(items, "old", ("dot",), str(tmp_path / "ix"), cell_rows=20)
    index = rt.open_item_index(spark, str(tmp_path / "ix"), "old", "dot")
    manifest = ix.latest_version(spark, ix.beside(ix._base(str(tmp_path / "ix"), "old"), "manifest"))
    spark.read.parquet(manifest).drop("folder", "held").coalesce(1).write.parquet(str(tmp_path / "m"))
    shutil.copytree(index.folder, index.folder.rsplit("/", 1)[0] + "/dot")
    spark.read.parquet(str(tmp_path / "m")).write.mode("overwrite").parquet(manifest)
    old = rt.open_item_index(spark, str(tmp_path / "ix"), "old", "dot")
    assert old.folder.endswith("/dot")
    answers(old, "dot")


@pytest.mark.parametrize("method", ["dot", "l2"])
@pytest.mark.parametrize("scale", [1.0, 1e13, 1e-14])
def test_products_of_32_bits_leave_no_best_item_out(method, scale, monkeypatch):
    """Ties, near ties, and numbers that 32 bits do not bear."""
    from marquee.operators import item_index as ix
    monkeypatch.setattr(ix, "TILE", 64)
    rng = np.random.default_rng(16)
    U, I = rng.normal(size=(40, 8)) * scale, rng.normal(size=(500, 8)) * scale
    I[100:120], I[300:320] = I[7], I[7] * (1 + 1e-9)
    cell, order = np.arange(500) // 10, rng.permutation(500)
    full = U @ I.T if method == "dot" else None
    key = -full if method == "dot" else np.stack([np.einsum("ij,ij->i", u - I, u - I) for u in U])
    want = np.lexsort((np.broadcast_to(order, key.shape), key), axis=1)[:, :7]
    for probe, edge in ((True, np.full(40, np.inf)), (False, np.take_along_axis(key, want[:, 6:], 1)[:, 0] * (1 + np.sign(key.min()) * 0.01) + 0.3 * scale ** 2)):
        hits = ix._Hits(U, edge, I, order, method, 7)
        ix._look(hits, np.ones((50, 40), bool), np.arange(0, 501, 10), cell, probe)
        got = {u: hits.at[hits.row == u].tolist() for u in range(40)}
        far = {u: np.abs(key[u, got[u]] - key[u, want[u]]).max() for u in range(40) if len(got[u]) == 7}
        assert len(far) == 40 and max(far.values()) <= 1e-12 * np.abs(key).max()


def test_weights_from_a_table(spark, tmp_path):
    from marquee.operators import encode as en
    from marquee.sources.fixtures import tower_weights
    w = tower_weights(embed_dim=4, hidden=(8,), output_dim=3)
    en.save_weights(spark, w, str(tmp_path / "w"))
    back = en.load_weights(spark, str(tmp_path / "w"))
    assert back["embed_dim"] == 4 and back["output_dim"] == 3 and np.array_equal(back["history"]["w"], w["history"]["w"])
    assert all(np.array_equal(a["w"], b["w"]) and np.array_equal(a["b"], b["b"]) for p in ("user_mlp", "item_mlp") for a, b in zip(w[p], back[p]))
    with pytest.raises(ValueError, match="expect 4"):
        en._embeddings([[1.0, 2.0]], 4)


@pytest.mark.parametrize("hidden,scale", [(64, 1.0), (200, 1.0), (5, 1e6), (64, 0.0)])
def test_learned_sums_leave_no_best_item_out(hidden, scale):
    """16-bit sums are off by a step per unit at most, so the lists are those of doubles: one group of units or several, outliers, all equal."""
    rng = np.random.default_rng(hidden)
    U, I = rng.normal(size=(30, 6)), rng.normal(size=(700, 6)) * scale
    U[3] *= 1000
    I[650] = I[20]  # a tie
    head = {"w1": rng.normal(size=(hidden, 12)), "b1": rng.normal(size=hidden), "w2": rng.normal(size=(1, hidden)), "b2": np.array([0.3])}
    h = rt._Head(U, head, 1 << 22)
    h.tile(I)
    want = rt.learned_scores(U, I, head)
    assert np.abs(h.step * h.sums.T + head["b2"][0] - want).max() <= h.step * hidden
    pos = np.arange(0, 700, 2)
    got = {p: (items, scores) for _, p, _, items, scores in rt._topk_chunks(
        np.arange(30), U, np.arange(700), I, [("all", np.arange(700)), ("even", pos)], ["learned"], 7, head, item_block=100)}
    for name, at in (("all", np.arange(700)), ("even", pos)):
        best = np.sort(-want[:, at], axis=1)[:, :7]
        assert np.allclose(got[name][1], -best) and np.allclose(np.take_along_axis(want, got[name][0], 1), -best)


def test_learned_with_numbers_that_are_not_finite():
    rng = np.random.default_rng(1)
    U, I, head = rng.normal(size=(4, 6)), rng.normal(size=(300, 6)), learned_head_weights(6)
    I[200] = np.nan
    (_, _, _, items, _), = rt._topk_chunks(np.arange(4), U, np.arange(300), I, [("*", np.arange(300))], ["learned"], 5, head)
    rest = np.delete(np.arange(300), 200)
    assert items.tolist() == rest[np.argsort(-rt.learned_scores(U, I[rest], head), axis=1, kind="stable")[:, :5]].tolist()


def test_shares_of_users_follow_cores_and_work():
    """Every share of users is a copy of the items: their number is not that of the shuffle partitions, and grows by the bounds of a cell only."""
    assert rt.cell_grid(1000, 1000, 9320, rt.SHARE_ITEMS, 12) == (1, 1)
    assert rt.cell_grid(5000, 5000, 9320, rt.SHARE_ITEMS, 12) == (12, 1)
    assert rt.cell_grid(50_000, 50_000, 9320, rt.SHARE_ITEMS, 12) == (32, 1)
    assert rt.cell_grid(300_000, 300_000, 9320, rt.SHARE_ITEMS, 12) == (33, 1)
    assert rt.cell_grid(300_000, 300_000, 9320, rt.SHARE_ITEMS, 100) == (200, 1)
    assert rt.cell_grid(3, 10 ** 9, 9320, rt.SHARE_ITEMS, 4) == (1, 3052)


def test_copies_of_items_do_not_follow_the_shuffle_partitions(vecs, spark):
    *_, users, items, mem = vecs
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert rt.topk_lists(users, items, mem, ("dot",), 5).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_users_stream_past_the_items_of_a_cell(monkeypatch):
    """Lists of a batch of users leave before the next is drawn; a user's rows merge over chunks and batches, cells follow each other."""
    import pyarrow as pa
    monkeypatch.setattr(rt, "LOOK_USERS", 3)
    rng = np.random.default_rng(8)
    U, I = rng.normal(size=(6, 4)), rng.normal(size=(9, 4))
    drawn = []

    def batch(cell, side, ids, vectors, pools):
        return pa.RecordBatch.from_pydict({"cell": pa.array([cell] * len(ids), pa.int32()), "side": pa.array([side] * len(ids), pa.int32()),
                                           "id": pa.array(ids, pa.int32()), "v": pa.array([list(v) for v in vectors], pa.list_(pa.float64())),
                                           "pools": pa.array(pools, pa.list_(pa.string()))})

    def source():
        for cell in (1, 2):
            yield batch(cell, 0, [5, 5, 7], I[[0, 0, 1]], [["a"], ["a"], ["a", "b"]])
            yield batch(cell, 0, range(10, 17), I[2:], [["b"]] * 7)
            for n, ids in enumerate(([0, 1, 2, 2], [2, 2, 2, 3], [4])):
                drawn.append((cell, n))
                yield batch(cell, 1, ids, U[ids], [None] * len(ids))

    seen, out = [], []
    for b in rt._cell_lists(source(), ["dot"], 3, None, 65_536, 4, True):
        seen.append(len(drawn))
        out += b.to_pylist()
    assert seen[0] == 1 and seen == sorted(seen) and len(set(seen)) > 2
    have = {}
    for r in out:
        have.setdefault((r["user_id"], r["genre"]), []).append(r["movie_ids"])
    ids = np.array([5, 7, *range(10, 17)])
    for u in range(5):
        for pool, at in (("a", [0, 1]), ("b", list(range(1, 9)))):
            best = sorted(at, key=lambda j: -(U[u] @ I[j]))
            want = [int(ids[j]) for j in best for _ in range(5 if u == 2 else 1)][:3]
            assert have[u, pool] == [want, want]
