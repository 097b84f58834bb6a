import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import samples as sm
from marquee.operators import split as sp


def test_global_index_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000).select(F.col("id"), ((F.col("id") * 7919) % 1000).alias("ts"))
    idx = sp.with_global_index(df, ["ts", "id"], num_partitions=7).collect()
    assert sorted(r["idx"] for r in idx) == list(range(5000))
    order = [r["id"] for r in sorted(idx, key=lambda r: r["idx"])]
    expected = [r["id"] for r in df.orderBy("ts", "id").collect()]
    assert order == expected


def test_split_8_1_1(spark):
    df = spark.createDataFrame([(i, 1000 + i) for i in range(10)], "id long, timestamp long")
    got = {r["rating_id"]: r["split"] for r in sp.temporal_split(df).collect()}
    assert [got[i] for i in range(10)] == ["train"] * 8 + ["val"] + ["test"]


def test_split_of_five(ratings5):
    counts = {r["split"]: r["n"] for r in sp.split_counts(sp.temporal_split(ratings5)).collect()}
    assert counts == {"train": 4, "test": 1}


def test_split_rejects_bad_fractions(ratings5):
    import pytest
    with pytest.raises(ValueError):
        sp.temporal_split(ratings5, 0.9, 0.2)


def test_best_demonstration(ratings5):
    got = {r["user_id"]: r["demo_movie_id"] for r in sm.best_demonstration(ratings5).collect()}
    assert got == {1: 10, 2: 10, 3: 20}


def test_sample_weights_in_range(ratings5):
    w = sm.sample_decay_weights(ratings5.withColumn("split", F.lit("train"))).collect()
    assert all(0.0 < r["weight"] <= 1.0 for r in w)
    assert max(w, key=lambda r: r["timestamp"])["weight"] == 1.0


def test_pad_sequences(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0]), (1, [0.0, 5.0])], "b int, s array<double>")
    out = {tuple(r["s"]): (r["padded"], r["mask"]) for r in sm.pad_sequences(df, "b", "s").collect()}
    assert out[(3.0,)] == ([3.0, 0.0], [True, False])
    assert out[(0.0, 5.0)] == ([0.0, 5.0], [False, True])  # a true zero is masked as well


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_order_statistics(spark, bins):
    rng = random.Random(bins)
    for top in ((3, 2**63 - 1) if bins == 2 else (1, 50, 2**40, 2**63 - 1)):
        rows = [(rng.randint(-top, top) if rng.random() < 0.9 else None, rng.choice([-(2**63), 2**63 - 1, 0, *range(40)])) for _ in range(60)]
        if bins == 2:
            rows = [(t, rng.randrange(5)) for t, _ in rows]
        df = spark.createDataFrame(rows, "t long, i long").repartition(3)
        keys = [sp._as_long(df, "t"), sp._as_long(df, "i")]
        want = sorted((-(2**63) if t is None else t, i) for t, i in rows)
        ranks = [0, 17, 17, 40, 59]
        assert sp.order_statistics(df, keys, ranks, bins) == [want[r] for r in ranks]
    with pytest.raises(ValueError):
        sp.order_statistics(df.limit(0), keys, [0])


def test_split_needs_no_shuffle(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 100).alias("timestamp"))
    df.write.parquet(str(tmp_path / "r"))
    split = sp.temporal_split(spark.read.parquet(str(tmp_path / "r")))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    order = [r.id for r in df.orderBy("timestamp", "id").collect()]
    got = {r.rating_id: r.split for r in split.collect()}
    assert [got[i] for i in order] == ["train"] * 800 + ["val"] * 100 + ["test"] * 100


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string", "double"])
def test_split_by_other_types(spark, kind):
    days = spark.range(20).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 7 % 20).cast("int")).alias("d"))
    col = F.datediff("d", F.lit("2000-01-01")).cast("double") if kind == "double" else F.col("d").cast(kind)
    got = {r.rating_id: r.split for r in sp.temporal_split(days.select("id", col.alias("timestamp"))).collect()}
    order = sorted(range(20), key=lambda i: i * 7 % 20)
    assert [got[i] for i in order] == ["train"] * 16 + ["val"] * 2 + ["test"] * 2
