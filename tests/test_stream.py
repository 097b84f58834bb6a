import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marquee.streaming import ingest as ing
from marquee.streaming.ingest import current_table, current_watermark, stream_ingest
from marquee.operators import watermark as wm


def _csv(path, rows, name="part-00000.csv", header="userId,movieId,rating,timestamp"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(map(str, r)) + "\n")


def test_two_deliveries_and_replay(spark, tmp_path):
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    _csv(f"{landing}/d=0", [(1, 10, 4.0, 100), (1, 20, 3.0, 101), (1, 10, 2.0, 102)])
    stream_ingest(spark, f"{landing}/*/", table, ckpt).awaitTermination()
    first = {(r.user_id, r.movie_id): (r.id, r.rating) for r in current_table(spark, table).collect()}
    assert first == {(1, 10): (2, 2.0), (1, 20): (1, 3.0)}
    _csv(f"{landing}/d=1", [(5.0, 1, 20, 200), (1.0, 2, 30, 201)], header="rating,userId,movieId,timestamp")
    stream_ingest(spark, f"{landing}/*/", table, ckpt).awaitTermination()
    t = current_table(spark, table)
    assert {(r.user_id, r.movie_id): (r.id, r.rating) for r in t.collect()} == {(1, 10): (2, 2.0), (1, 20): (1, 5.0), (2, 30): (4, 1.0)}
    assert t.select("inserted_at").distinct().count() == 2
    mark = current_watermark(spark, table).first()
    assert mark["table_name"] == "ratings" and mark["last_inserted_at"] == t.agg(F.max("inserted_at")).first()[0]
    # nothing new: no batch runs, the table stays as it is
    stream_ingest(spark, f"{landing}/*/", table, ckpt).awaitTermination()
    assert current_table(spark, table).count() == 3


@pytest.mark.parametrize("lost", ["manifest", "watermark and manifest"])
def test_batch_killed_between_its_writes(spark, tmp_path, monkeypatch, lost):
    """A batch that dies before its commit leaves the former state; its replay completes data, watermark and manifest."""
    table = str(tmp_path / "t")
    _csv(str(tmp_path / "a"), [(1, 10, 4.0, 100), (2, 20, 3.0, 101)])
    _csv(str(tmp_path / "b"), [(1, 10, 1.0, 200), (3, 30, 3.0, 201)])
    ing.merge_files(spark, [f"{tmp_path}/a"], "ratings", table, 0, stamp=datetime(2024, 1, 1))
    real = ing.merge.max_inserted_watermark
    with monkeypatch.context() as m:
        if lost == "manifest":
            m.setattr(ing, "vacuum", None)
            m.setattr(spark.__class__, "createDataFrame", lambda *a, **k: 1 / 0)
        else:
            m.setattr(ing.merge, "max_inserted_watermark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ing.merge_files(spark, [f"{tmp_path}/b"], "ratings", table, 1, stamp=datetime(2024, 1, 2))
    assert ing.merge.max_inserted_watermark is real
    assert {(r.user_id, r.rating) for r in current_table(spark, table).collect()} == {(1, 4.0), (2, 3.0)}
    assert current_watermark(spark, table).first().last_inserted_at == datetime(2024, 1, 1)
    for _ in range(2):  # the replay, and a replay of the committed batch
        ing.merge_files(spark, [f"{tmp_path}/b"], "ratings", table, 1, stamp=datetime(2024, 1, 2))
        assert {(r.user_id, r.rating) for r in current_table(spark, table).collect()} == {(1, 1.0), (2, 3.0), (3, 3.0)}
        assert current_watermark(spark, table).first().last_inserted_at == datetime(2024, 1, 2)


def test_only_touched_buckets_are_rewritten_and_old_ones_go(spark, tmp_path):
    table = str(tmp_path / "t")
    for n in range(6):
        _csv(str(tmp_path / f"d{n}"), [(u, 10, float(n), 100) for u in (range(200) if n == 0 else [n])])
        ing.merge_files(spark, [f"{tmp_path}/d{n}"], "ratings", table, n, keep_versions=2)
    buckets = {n: len(glob.glob(f"{table}/v={n:08d}/bucket=*")) for n in range(6)}
    assert buckets[5] == 1 and buckets[4] == 1 and buckets[0] < 64 and len(glob.glob(f"{table}_manifest/v=*")) == 2
    got = {r.user_id: r.rating for r in current_table(spark, table).collect()}
    assert got == {u: float(u) if 1 <= u <= 5 else 0.0 for u in range(200)}


@pytest.mark.parametrize("name,mode,want", [("movies", "upsert", {1: "B (2001)", 2: "C (2002)"}), ("movies", "skip", {1: "A (2000)", 2: "C (2002)"}),
                                            ("movies", "replace", {1: "B (2001)", 2: "C (2002)"})])
def test_other_tables_and_modes(spark, tmp_path, name, mode, want):
    table = str(tmp_path / "t")
    _csv(str(tmp_path / "a"), [(1, "A (2000)", "Drama")], header="movieId,title,genres")
    _csv(str(tmp_path / "b"), [(1, "B (2001)", "Drama"), (2, "C (2002)", "Action")], header="movieId,title,genres")
    for n, f in enumerate("ab"):
        ing.merge_files(spark, [f"{tmp_path}/{f}"], name, table, n, mode)
    assert {r.movie_id: r.title for r in current_table(spark, table).collect()} == want


def test_watermark_fires_on_first_changed_table(spark):
    from datetime import datetime
    ratings = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, inserted_at timestamp_ntz")
    movies = spark.createDataFrame([(i, datetime(2024, 1, 5)) for i in range(7)], "id int, inserted_at timestamp_ntz")
    marks = spark.createDataFrame([("ratings", datetime(2024, 1, 2)), ("movies", datetime(2024, 1, 3))],
                                  "table_name string, last_inserted_at timestamp_ntz")
    counts = [r["new_rows"] for r in wm.new_row_counts({"ratings": ratings, "movies": movies}, marks)
              .orderBy("ord").collect()]
    assert counts == [0, 7]
    f = wm.first_changed_table({"ratings": ratings, "movies": movies}, marks).first()
    assert f["has_new_data"] and f["table_name"] == "movies"
    none = wm.first_changed_table({"ratings": ratings}, marks).first()
    assert not none["has_new_data"] and none["table_name"] is None


def test_trigger_log_noop_for_unknown_and_null(spark):
    from datetime import datetime
    log = spark.createDataFrame([("t1", "queued", None)], "trigger_id string, status string, completed_at timestamp_ntz")
    upd = spark.createDataFrame([("t1", "running", datetime(2024, 1, 1)), (None, "success", datetime(2024, 1, 2)),
                                 ("zz", "failed", datetime(2024, 1, 3))], "trigger_id string, status string, at timestamp_ntz")
    r = wm.trigger_log_update(log, upd).collect()
    assert [(x.trigger_id, x.status, x.completed_at) for x in r] == [("t1", "running", None)]
    upd2 = spark.createDataFrame([("t1", "success", datetime(2024, 1, 4))], upd.schema)
    assert wm.trigger_log_update(log, upd2).first().completed_at == datetime(2024, 1, 4)
