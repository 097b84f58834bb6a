"""Run-metric analytics: filters, newest-first reports, per-run histories and latest values."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.split import with_global_index

SWEEP_TAG = "sweep_trial"


def runs_filtered(runs: DataFrame, experiment: str | None = None, architecture: str | None = None,
                  distillation_type: str | None = None, limit: int = 50) -> DataFrame:
    """Filter by experiment and tags; newest first (ties by run_id); a limit outside 1..500 (a report size) raises."""
    if not 1 <= int(limit) <= 500:
        raise ValueError(f"limit {limit} is outside 1..500")
    out = runs
    if experiment:
        out = out.filter(F.col("experiment") == experiment)
    if architecture:
        out = out.filter(F.col("architecture") == architecture)
    if distillation_type:
        out = out.filter(F.col("distillation_type") == distillation_type)
    return out.orderBy(F.desc("start_time"), F.asc("run_id")).limit(limit)


def rank_within_groups(df: DataFrame, keys: list[str], order: list[str], out: str = "pos") -> DataFrame:
    """0-based position inside each key group in a unique order, without putting a group in one task:
    a global index over (keys, order), minus the group's first index (a partial-aggregated min)."""
    idx = with_global_index(df, keys + order, out="_gi")
    first = idx.groupBy(*keys).agg(F.min("_gi").alias("_g0"))
    return idx.join(first, keys).withColumn(out, F.col("_gi") - F.col("_g0")).drop("_gi", "_g0")


def metric_history(metrics: DataFrame, run: str = "run_id", metric: str = "metric", step: str = "step") -> DataFrame:
    """Per run and metric the (step, value) points in step order, as rows with their position."""
    return rank_within_groups(metrics, [run, metric], [step])


def latest_metric(runs: DataFrame, metrics: DataFrame, name: str = "val_loss", run: str = "run_id",
                  digits: int = 4) -> DataFrame:
    """Per run the value at the greatest step of the named metric, 0 when the run has none."""
    last = (metrics.filter(F.col("metric") == name).groupBy(run)
            .agg(F.max_by("value", "step").alias("_v")))
    return (runs.select(run).distinct().join(last, run, "left")
            .select(run, F.round(F.coalesce("_v", F.lit(0.0)), digits).alias("latest")))


def sweep_trials(runs: DataFrame, experiment: str, limit: int = 500) -> DataFrame:
    """Runs of an experiment tagged as sweep trials, newest first, at most 500."""
    return (runs.filter((F.col("experiment") == experiment) & (F.col("sweep") == SWEEP_TAG))
            .orderBy(F.desc("start_time"), F.asc("run_id")).limit(limit))


def run_summary(runs: DataFrame, counts: DataFrame, n_runs: int = 20) -> DataFrame:
    """The newest runs and the table counts in one long result: (kind, name, value)."""
    r = runs_filtered(runs, limit=n_runs).select(F.lit("run").alias("kind"), F.col("run_id").cast("string").alias("name"),
                                                 F.lit(None).cast("bigint").alias("value"))
    c = counts.select(F.lit("table").alias("kind"), F.col("table_name").alias("name"),
                      F.col("row_count").cast("bigint").alias("value"))
    return r.unionByName(c)
