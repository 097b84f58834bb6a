from datetime import datetime

from pyspark.sql import functions as F

from marquee.operators import metrics as mt


def test_history_positions_with_a_hot_run(spark):
    """A run holding a third of all points gets exact positions without one task holding the group."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).cast("int").alias("run_id"),
        F.lit("val_loss").alias("metric"), F.col("id").alias("step"), F.col("id").cast("double").alias("value"))
    got = mt.metric_history(df).collect()
    hot = sorted((r["pos"], r["step"]) for r in got if r["run_id"] == 0)
    assert len(hot) > 2000 and [p for p, _ in hot] == list(range(len(hot)))
    assert [s for _, s in hot] == sorted(s for _, s in hot)


def test_latest_metric_defaults_to_zero(spark):
    runs = spark.createDataFrame([(1,), (2,)], "run_id int")
    m = spark.createDataFrame([(1, "val_loss", 0, 0.5), (1, "val_loss", 3, 0.123456)],
                              "run_id int, metric string, step int, value double")
    got = {r["run_id"]: r["latest"] for r in mt.latest_metric(runs, m).collect()}
    assert got == {1: 0.1235, 2: 0.0}


def test_runs_filtered_newest_first(spark):
    runs = spark.createDataFrame([
        (1, datetime(2024, 1, 1), "e", "TwoTower", "none", ""),
        (2, datetime(2024, 1, 3), "e", "TwoTower", "self", "sweep_trial"),
        (3, datetime(2024, 1, 2), "f", "InfoNCEEncoder", "none", "sweep_trial")],
        "run_id int, start_time timestamp_ntz, experiment string, architecture string, distillation_type string, sweep string")
    assert [r.run_id for r in mt.runs_filtered(runs, experiment="e").collect()] == [2, 1]
    assert [r.run_id for r in mt.runs_filtered(runs, limit=1).collect()] == [2]
    assert [r.run_id for r in mt.sweep_trials(runs, "e").collect()] == [2]
