"""Quoted CSV in splits against Spark's whole-file reader."""
import csv
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.operators import merge
from marquee.sources import files as fl
from marquee.sources import quoted as qt


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(path, rows, header=("movieId", "title", "genres"), end="\n"):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


def titles(rng, n):
    parts = ["a", "Movie", '"', "\n", "\n\n", ",", "é😀", '""', "x" * 90, ' 5" disk', "|", "'"]
    return [(i, "t" + "".join(rng.choices(parts, k=rng.randint(1, 14))), "Drama") for i in range(n)]


def test_line_states_follow_the_quotes():
    """The state after every line of a file, from either start state, is that of one walk over all of it."""
    rng = random.Random(2)
    for _ in range(300):
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerows([("".join(rng.choices('ab",\n', k=rng.randint(0, 9))), "x", "1") for _ in range(5)])
        lines = text.getvalue().split("\n")[:-1]
        state, opened = False, 0
        for line in lines:
            state = qt.ends_inside(line, state)
            opened += line.count('"')
            assert state == bool(opened % 2)
    assert not qt.ends_inside('1,5" disk,x', False) and qt.ends_inside('1,"a""b', False) and not qt.ends_inside('b",2', True)


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_records_across_splits(spark, tmp_path, small_splits, seed, end):
    rows = titles(random.Random(seed), 120)
    if end == "\r\n":
        rows = [(i, t.replace("\n", "\r\n"), g) for i, t, g in rows]
    rows.append((500, "long " + "line\n" * 600 + "end", "Drama"))  # over several splits
    rows += [(600 + i, "after", "Drama") for i in range(30)]
    path = write(tmp_path / "movies.csv", rows, end=end)
    assert qt.lines_of(spark, path).select("start").distinct().count() > 5
    got = fl.read_movies_csv(spark, path)
    assert Counter(map(tuple, got.collect())) == Counter(rows)
    # the whole-file reader turns CR LF inside quotes into LF; here they stay
    whole = fl._by_name(spark, path, fl.MOVIES, multi_line=True)
    same = got.withColumn("title", F.regexp_replace("title", "\r\n", "\n")) if end == "\r\n" else got
    assert Counter(map(tuple, same.collect())) == Counter(map(tuple, whole.collect()))


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    path = write(tmp_path / "movies.csv", titles(random.Random(4), 200))
    tasks = fl.read_movies_csv(spark, path).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5
    assert fl._by_name(spark, path, fl.MOVIES, multi_line=True).select(F.spark_partition_id()).distinct().count() == 1


def test_several_files_and_arrival_order(spark, tmp_path, small_splits):
    rng, want = random.Random(5), []
    for n in range(4):
        rows = [(1000 * n + i, t, g) for i, t, g in titles(rng, 60)]
        write(tmp_path / f"part-{n}.csv", rows)
        want += rows
    located = fl.read_located(fl.read_movies_csv, spark, str(tmp_path))
    numbered = merge.arrival_ids(located, 7).orderBy("id").collect()
    assert [(r.movie_id, r.title) for r in numbered] == [(i, t) for i, t, _ in want]
    assert [r.id for r in numbered] == list(range(7, 7 + len(want)))
    write(tmp_path / "part-9.csv", [(1, "x", "y")], header=("movieId", "genres", "title"))
    with pytest.raises(Exception, match="columns"):
        fl.read_movies_csv(spark, str(tmp_path)).collect()


def test_splits_stay_where_only_some_files_are_torn(spark, tmp_path):
    """Split sizes follow from the bytes of a scan: the second pass must list the files of the first, torn or not."""
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        want = [(i, "line\n" * 40 + "end", "Drama") for i in range(200)]
        write(tmp_path / "part-0.csv", want)
        for n in (1, 2):
            plain = [(1000 * n + i, "plain " * 40, "Drama") for i in range(180)]
            write(tmp_path / f"part-{n}.csv", plain)
            want = want + plain
        inside, step = qt.start_states(qt.lines_of(spark, str(tmp_path)))
        assert {f.rsplit("/", 1)[1] for f, _ in inside} == {"part-0.csv"} and step
        assert Counter(map(tuple, fl.read_movies_csv(spark, str(tmp_path)).collect())) == Counter(want)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_odd_files(spark, tmp_path, small_splits):
    def read(text, **kw):
        (tmp_path / "m.csv").write_bytes(text.encode())
        return sorted(map(tuple, fl.read_movies_csv(spark, str(tmp_path / "m.csv"), **kw).collect()))

    head = "movieId,title,genres\n"
    assert read(head) == []
    assert read("﻿" + head + "\n1,A,B\n\n\n2,C,D") == [(1, "A", "B"), (2, "C", "D")]
    assert read(head + '1,5" disk,Drama\n2,"a ""b"" c",X\n') == [(1, '5" disk', "Drama"), (2, 'a "b" c', "X")]
    assert read(head + "x,bad id,Drama\n3,good,Drama\n") == [(3, "good", "Drama")]
    assert read(head + "x,bad id,Drama\n3,good,Drama\n", bad=True)[0][3] == "x,bad id,Drama"
    # a quote without an end: what came before stays, what comes after in other splits holds no records
    got = read(head + "".join(f"{i},fine,Drama\n" for i in range(50)) + '77,"open,Drama\n' + "".join(f"{i},lost,Drama\n" for i in range(100, 400)))
    assert [r for r in got if r[1] == "fine"] == [(i, "fine", "Drama") for i in range(50)] and not any(r[1] == "lost" for r in got)


def test_tags_with_line_breaks(spark, tmp_path, small_splits):
    rng = random.Random(6)
    rows = [(u, u % 7, "tag " + "".join(rng.choices(["a", "\n", '"', ","], k=20)), u) for u in range(150)] + [(1, 1, "NA", 5)]
    path = write(tmp_path / "tags.csv", rows, header=("userId", "movieId", "tag", "timestamp"))
    assert Counter(map(tuple, fl.read_tags_csv(spark, path).collect())) == Counter(rows[:-1])


def test_moved_splits_fail(spark, tmp_path):
    path = write(tmp_path / "movies.csv", titles(random.Random(7), 200))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = fl.read_movies_csv(spark, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "450")
        with pytest.raises(Exception, match="read it again"):
            df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
