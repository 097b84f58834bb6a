
from marquee.plans import stages
from marquee.plans.q_sources import _landing

SF = "/root/testdata/sf0.001"


def test_all_stages_end_to_end(spark, tmp_path):
    src = _landing(spark, SF)
    out = str(tmp_path / "wh")
    summary = stages.run(spark, src, out)
    ingest = {r["file"]: r for r in summary["ingest"]}
    assert ingest["ratings.csv"]["rows_offered"] == 1000
    assert ingest["stray_table.csv"]["action"] == "reject"
    wh = stages.Warehouse(spark, out)
    rk = wh.read("raw/ratings")
    assert rk.count() == rk.select("user_id", "movie_id").distinct().count()
    assert {r["split"] for r in summary["split"]} == {"train", "val", "test"}
    assert summary["featurize"]["user_features"] == rk.select("user_id").distinct().count()
    counts = {r["table_name"]: r["n"] for r in summary["precompute"]}
    assert counts["top_n_user_genre"] > 0 and counts["cold_start_genre"] > 0
    assert summary["evaluate"][0]["loss"] >= 0
    assert summary["sweep"][0]["params"] in {str(sorted(g.items())) for g in stages.GRID} and summary["cross_evaluate"] == []
    assert wh.read(f"models/{stages.MODEL_NAME}/users").selectExpr("max(size(u))").first()[0] == dict(eval(summary["sweep"][0]["params"]))["rank"]
    # nothing new since the load, so the daily run skips the ingest
    assert {r.stage: r.run for r in stages.run_gate(spark, wh).collect()}["ingest"] is False
    # a second sweep has nothing left to try; a second model makes a pair in each direction
    stages.run_sweep(spark, wh)
    assert wh.next_version("pipeline/sweep_trials") == 1
    stages.run_train(spark, wh, "other", rank=4, max_iter=2)
    kl = {(r.teacher, r.student): r.kl for r in stages.run_cross_evaluate(spark, wh).collect()}
    assert set(kl) == {("other", stages.MODEL_NAME), (stages.MODEL_NAME, "other")} and all(v > 0 for v in kl.values())
    from marquee.operators import retrieve as rt
    index = rt.load_item_index(spark, wh.path("serving/item_index"), stages.MODEL_NAME, "cosine")
    found = rt.search_item_index(index, wh.read(f"models/{stages.MODEL_NAME}/users"), "cosine", 3)
    assert found.count() == 3 * wh.read(f"models/{stages.MODEL_NAME}/users").count()


def test_reingest_upsert_is_idempotent(spark, tmp_path):
    src = _landing(spark, SF)
    out = str(tmp_path / "wh")
    stages.run(spark, src, out, ["ingest"])
    wh = stages.Warehouse(spark, out)
    n1 = wh.read("raw/ratings").count()
    stages.run(spark, src, out, ["ingest"])
    assert wh.read("raw/ratings").count() == n1
    assert wh.next_version("raw/ratings") == 2
    stages.run(spark, src, out, ["ingest"], mode="skip")
    assert wh.read("raw/ratings").count() == n1


def test_ingest_unpacks_archives_when_no_data_file(spark, tmp_path):
    import io
    import zipfile
    good = io.BytesIO()
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("ml/ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.0,1000\n1,10,5.0,2000\n2,20,3.0,1500\n")
        z.writestr("ml/movies.csv", "movieId,title,genres\n10,A (2000),Action\n20,B (2001),Drama\n")
    src = tmp_path / "download"
    src.mkdir()
    (src / "ml.zip").write_bytes(good.getvalue())
    out = str(tmp_path / "wh")
    summary = stages.run(spark, str(src), out, ["ingest"])
    assert {r["file"] for r in summary["ingest"] if r["action"] == "load"} == {"ratings.csv", "movies.csv"}
    rk = {(r.user_id, r.movie_id): r.rating for r in stages.Warehouse(spark, out).read("raw/ratings").collect()}
    assert rk == {(1, 10): 5.0, (2, 20): 3.0}  # the later row of a key wins


def test_bad_file_is_reported_and_the_rest_is_loaded(spark, tmp_path):
    import pytest
    src = tmp_path / "download"
    src.mkdir()
    (src / "ratings.csv").write_text("userId,rating\n1,4.0\n")
    (src / "movies.csv").write_text("movieId,title,genres\n10,A (2000),Action\nx,B (2001),Drama\n")
    out = str(tmp_path / "wh")
    with pytest.raises(stages.IngestFailed, match="ratings.csv: ValueError: missing columns") as e:
        stages.run(spark, str(src), out, ["ingest"])
    report = {r.file: r for r in e.value.report.collect()}
    assert report["ratings.csv"].action == "error" and not report["movies.csv"].ok
    assert (report["movies.csv"].rows_offered, report["movies.csv"].unparsable, report["movies.csv"].variant) == (1, 1, "ml-latest-small")
    assert stages.Warehouse(spark, out).read("raw/movies").count() == 1


def test_row_ids_survive_a_second_load(spark, tmp_path):
    src = tmp_path / "download"
    src.mkdir()
    (src / "movies.csv").write_text("movieId,title,genres\n10,A (2000),Action\n")
    (src / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,10,4.0,1000\n")
    out = str(tmp_path / "wh")
    wh = stages.Warehouse(spark, out)
    stages.run(spark, str(src), out, ["ingest"])
    first = {r.table_name: r.last_inserted_at for r in wh.read("pipeline/trigger_watermarks").collect()}
    (src / "movies.csv").unlink()
    (src / "ratings.csv").write_text("userId,movieId,rating,timestamp\n2,10,3.0,1500\n1,10,5.0,2000\n")
    stages.run(spark, str(src), out, ["ingest"])
    assert {(r.user_id, r.id, r.rating) for r in wh.read("raw/ratings").collect()} == {(1, 0, 5.0), (2, 1, 3.0)}
    marks = {r.table_name: r.last_inserted_at for r in wh.read("pipeline/trigger_watermarks").collect()}
    assert marks["movies"] == first["movies"] and marks["ratings"] > first["ratings"]
