"""Growing buckets, manifests, file statistics, model folders and trigger rows."""
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import buckets as bk
from marquee.operators import watermark as wm
from marquee.sources import files as fl

KEYS = ["user_id", "movie_id"]
DAY = datetime(2024, 1, 1)


def _csv(path, rows):
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as f:
        f.write("userId,movieId,rating,timestamp\n" + "".join(",".join(map(str, r)) + "\n" for r in rows))
    return path


def test_addresses_follow_the_directory(spark):
    h = spark.range(-3000, 3000).withColumn("h", F.xxhash64("id"))
    sizes = [1, 2, 3, 5, 8, 11, 16, 17, 33, 64]
    rows = h.select(*[bk.address(F.col("h"), n).alias(str(n)) for n in sizes]).collect()
    for i, n in enumerate(sizes):
        assert {r[str(n)] for r in rows} == set(range(n))
        for big in sizes[i:]:  # where a bucket of a larger directory comes from
            assert all(bk.source_of(r[str(big)], n) == r[str(n)] for r in rows)


def test_buckets_split_and_batches_open_what_they_touch(spark, tmp_path):
    table, state, sizes = str(tmp_path / "t"), {}, []
    for n in range(6):
        rows = [(u, m, float(n), 10 * n) for u in range(40) for m in range(4)] if n < 2 else [(7, 1, float(n), n), (100 + n, 1, 1.0, n)]
        rows = [(u + 40 * n if n == 1 else u, m, x, t) for u, m, x, t in rows]
        before = {r["path"]: r["bucket"] for r in (bk.manifest(spark, table).collect() if n else [])}
        done = bk.merge_rows(spark, fl.read_ratings_csv(spark, _csv(str(tmp_path / f"d{n}"), rows)), KEYS, table, n,
                             stamp=DAY + timedelta(days=n), table="ratings", buckets=2, bucket_rows=20)
        state.update({(u, m): x for u, m, x, _ in rows})
        sizes.append(done["directory"])
        after = {r["path"]: r["bucket"] for r in bk.manifest(spark, table).collect()}
        # every file of a bucket that the batch did not open is still the one in use
        assert {p for p, b in before.items() if b not in done["opened"]} <= set(after)
        assert set(done["written"]) == {b for p, b in after.items() if f"/v={n:08d}/" in p}
        if n >= 2:
            new = sizes[n] - sizes[n - 1]
            assert len(done["opened"]) <= 2 + new < len(before)
        assert {(r.user_id, r.movie_id): r.rating for r in bk.current_table(spark, table).collect()} == state
        assert bk.current_watermark(spark, table).first().last_inserted_at == DAY + timedelta(days=n)
    assert sizes[0] == 8 and sizes[1] == 16 and sizes[-1] > 16
    m = bk.manifest(spark, table).agg(F.sum("rows").alias("n"), F.max("max_id").alias("top"), F.min("bytes").alias("b")).first()
    t = bk.current_table(spark, table)
    assert (m.n, m.top) == (t.count(), t.agg(F.max("id")).first()[0]) and m.b > 0
    assert t.select("id").distinct().count() == t.count()


def test_rows_since_reads_late_files_only(spark, tmp_path):
    table = str(tmp_path / "t")
    for n, rows in enumerate([[(u, 1, 1.0, 0) for u in range(200)], [(5, 1, 2.0, 0), (500, 1, 3.0, 0)]]):
        bk.merge_rows(spark, fl.read_ratings_csv(spark, _csv(str(tmp_path / f"d{n}"), rows)), KEYS, table, n, stamp=DAY + timedelta(days=n), buckets=16)
    late = bk.rows_since(spark, table, DAY)
    assert {(r.user_id, r.rating) for r in late.collect()} == {(5, 2.0), (500, 3.0)}
    assert len(late.inputFiles()) <= 2 < len(bk.current_table(spark, table).inputFiles())
    assert bk.rows_since(spark, table, DAY + timedelta(days=3)).count() == 0
    assert bk.rows_since(spark, table, None).count() == 201


def test_many_small_files_are_listed_by_few_tasks(spark, tmp_path):
    table, sc = str(tmp_path / "t"), spark.sparkContext
    bk.merge_rows(spark, fl.read_ratings_csv(spark, _csv(str(tmp_path / "d"), [(u, 1, 1.0, 0) for u in range(600)])), KEYS, table, 0, stamp=DAY,
                  buckets=150, bucket_rows=10 ** 6)
    before = spark.conf.get(bk.LISTERS)
    sc.setJobGroup("listing", "listing")
    try:
        rows = bk.current_table(spark, table)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert max(tasks) <= 8 < bk.manifest(spark, table).count() and rows.count() == 600
    assert spark.conf.get(bk.LISTERS) == before


def test_statistics_of_several_files_a_bucket(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        table = str(tmp_path / "t")
        bk.merge_rows(spark, fl.read_ratings_csv(spark, _csv(str(tmp_path / "d"), [(u, 1, 1.0, 0) for u in range(20)])), KEYS, table, 0, stamp=DAY, buckets=2)
        m = bk.manifest(spark, table).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sum(r.rows for r in m) == 20 and max(r.rows for r in m) == 3 and len({r.path for r in m}) == len(m) > 6
    for r in m:
        one = spark.read.parquet(r.path)
        assert (one.count(), one.agg(F.max("id")).first()[0], os.path.getsize(r.path)) == (r.rows, r.max_id, r.bytes)


def test_modes_and_empty_sources(spark, tmp_path):
    table = str(tmp_path / "t")
    a = fl.read_ratings_csv(spark, _csv(str(tmp_path / "a"), [(1, 1, 1.0, 0), (2, 2, 2.0, 0)]))
    none = fl.read_ratings_csv(spark, _csv(str(tmp_path / "none"), []))
    bk.merge_rows(spark, a, KEYS, table, 0)
    assert bk.merge_rows(spark, none, KEYS, table, 1)["written"] == []
    assert bk.current_table(spark, table).count() == 2
    assert bk.merge_rows(spark, none, KEYS, table, 1) == {}  # committed
    b = fl.read_ratings_csv(spark, _csv(str(tmp_path / "b"), [(1, 1, 9.0, 0), (3, 3, 3.0, 0)]))
    bk.merge_rows(spark, b, KEYS, table, 2, "skip")
    assert {(r.user_id, r.rating) for r in bk.current_table(spark, table).collect()} == {(1, 1.0), (2, 2.0), (3, 3.0)}
    bk.merge_rows(spark, b, KEYS, table, 3, "replace")
    assert {(r.user_id, r.rating) for r in bk.current_table(spark, table).collect()} == {(1, 9.0), (3, 3.0)}
    with pytest.raises(ValueError):
        bk.merge_rows(spark, b, KEYS, table, 4, "other")


def test_file_statistics_decide_without_a_scan(spark, tmp_path):
    frames = {"ratings": [(i, DAY) for i in range(10)], "movies": [(i, DAY + timedelta(days=i)) for i in range(10)]}
    files = spark.createDataFrame([], wm.FILES)
    for name, rows in frames.items():
        path = str(tmp_path / name)
        spark.createDataFrame(rows, "id int, inserted_at timestamp_ntz").repartitionByRange(5, "id").write.parquet(path)
        files = files.unionByName(wm.file_statistics(spark.read.parquet(path), name))
    files.write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    marks = spark.createDataFrame([("ratings", DAY), ("movies", DAY + timedelta(days=4))], "table_name string, last_inserted_at timestamp_ntz")
    assert {r.table_name: r.new_rows for r in wm.new_row_counts_by_files(spark, files, marks).collect()} == {"ratings": 0, "movies": 5}
    first = wm.first_changed_by_files(files, marks)
    assert tuple(first.first()) == (True, "movies")
    assert all("/files/" in f for f in first.inputFiles())  # the tables themselves are not opened
    assert {r.stage: r.run for r in wm.daily_gate_by_files(files, marks).collect()}["ingest"] is True
    done = marks.withColumn("last_inserted_at", F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz"))
    assert tuple(wm.first_changed_by_files(files, done).first()) == (False, None)
    # only the file in which the mark falls is read
    counts = wm.new_row_counts_by_files(spark, files, marks)
    assert sum("/ratings/" in f for f in counts.inputFiles()) == 0 and sum("/movies/" in f for f in counts.inputFiles()) == 1


def test_model_rows_are_versions(spark, tmp_path):
    path = str(tmp_path / "serving")
    rows = lambda m, n: spark.createDataFrame([(m, i) for i in range(n)], "model_name string, x int")
    bk.write_model_rows(rows("a/b c=1", 3).unionByName(rows("b", 2)), path)
    old = bk.read_model_rows(spark, path)
    bk.write_model_rows(rows("b", 5), path)
    assert old.groupBy("model_name").count().collect() and old.count() == 5  # a reader of the version before is not disturbed
    assert {r.model_name: r["count"] for r in bk.read_model_rows(spark, path).groupBy("model_name").count().collect()} == {"a/b c=1": 3, "b": 5}
    assert bk.read_model_rows(spark, path, ["b"]).count() == 5
    with pytest.raises(FileNotFoundError):
        bk.read_model_rows(spark, path, ["none"])
    for _ in range(4):
        bk.write_model_rows(rows("b", 1), path, keep_versions=2)
    assert bk.read_model_rows(spark, path).count() == 4 and len(bk.versions(spark, bk.beside(path, "manifest"))) == 2


def test_create_triggers(spark):
    log = spark.createDataFrame([("t1", "daily", "success", DAY, DAY, None, None, None)], wm.TRIGGER_LOG)
    req = spark.createDataFrame([("t1", ["mse"], None, "x", DAY), ("t2", ["all"], ["two_tower"], "later", DAY + timedelta(hours=1)),
                                 ("t2", ["infonce", "mse"], ["als"], "first", DAY), (None, None, None, "x", DAY)],
                                "trigger_id string, losses array<string>, architectures array<string>, requester string, at timestamp_ntz")
    got = {r.trigger_id: r for r in wm.create_triggers(log, req).collect()}
    assert set(got) == {"t1", "t2"} and got["t1"].status == "success"
    t2 = got["t2"]
    assert (t2.trigger_type, t2.status, t2.requester, t2.requested_losses, t2.requested_architectures) == ("on_demand", "pending", "first", ["infonce", "mse"], ["als"])
    only = wm.create_triggers(log.limit(0), req.where("requester = 'later'")).first()
    assert only.requested_losses is None and only.requested_architectures == ["two_tower"] and only.completed_at is None
