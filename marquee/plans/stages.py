"""Batch stages chained through written tables: ingest -> validate -> featurize -> split -> sweep -> train ->
evaluate -> cross_evaluate -> precompute. Each stage reads the newest committed version of its inputs and writes a fresh
version folder, so a failed stage leaves the previous state readable and a rerun starts from it.

    python -m marquee.plans.stages --data-dir <download folder> --out <warehouse> [--stages a,b] [--mode upsert]
"""
from __future__ import annotations

import argparse
import ast
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import buckets, factors, features, merge, quality, retrieve, samples, split, watermark
from marquee.session import drop_session_scratch
from marquee.sources import discover as dv
from marquee.sources.files import CONFLICT_KEYS
from marquee.operators.buckets import latest_version, version_path

STAGES = ["ingest", "validate", "featurize", "split", "sweep", "train", "evaluate", "cross_evaluate", "precompute"]
#: Settings that the sweep tries when none are given.
GRID = [{"rank": 8, "max_iter": 5}, {"rank": 16, "max_iter": 5}]
MODEL_NAME = "als_factors"
#: Directory of a new raw table; it grows with the rows.
FIRST_BUCKETS = 4


class Warehouse:
    """Versioned Parquet tables under one root: <root>/<namespace>/<table>/v=<n>. Raw tables lie in growing hash buckets (operators.buckets)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def folders(self, namespace: str) -> list[str]:
        """Names of the folders in a namespace (configuration-sized: models)."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(namespace))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, table: str) -> DataFrame | None:
        if buckets.exists(self.spark, self.path(table)):
            return buckets.current_table(self.spark, self.path(table))
        p = latest_version(self.spark, self.path(table))
        return None if p is None else self.spark.read.parquet(p)

    def next_version(self, table: str) -> int:
        p = latest_version(self.spark, self.path(table))
        return 0 if p is None else int(p.rsplit("v=", 1)[1]) + 1

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        out = version_path(self.path(table), self.next_version(table))
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(out)
        return self.spark.read.parquet(out)


class IngestFailed(RuntimeError):
    """Some files could not be loaded; the others are. ``report`` holds one row per file."""

    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


def run_ingest(spark: SparkSession, source: str, wh: Warehouse, mode: str = "upsert", strict: bool = True) -> DataFrame:
    """Every loadable file merged into its raw table (upsert | skip | replace); watermarks advanced.

    A folder holding no known data file but zip archives is unpacked first (archives with unsafe member
    paths are refused whole) into the warehouse's staging area. A file that cannot be read is reported and the rest goes on;
    at the end the report is written, and with ``strict`` any error raises IngestFailed."""
    if not dv.has_known_files(dv.list_files(spark, source)):
        staged = f"{wh.path('staging/unzipped')}/v={wh.next_version('staging/unzipped'):08d}"
        dv.expand_archives(spark, source, staged).count()
        source = staged
    variant = dv.detect_variant(dv.list_files(spark, source)).first()["variant"]
    plan = dv.discover_inputs(spark, source).collect()  # one row per file or part folder (listing metadata)
    written, report = set(), []
    for r in sorted(plan, key=lambda r: r["dataset_path"]):
        if r["action"] != "load":
            report.append((r["name"], r["action"], r["table_name"], 0, 0, r["reason"]))
            continue
        try:
            table, df = dv.read_dataset(spark, r["name"], r["dataset_path"])
            path = wh.path(f"raw/{table}")
            done = buckets.merge_rows(spark, df, CONFLICT_KEYS[table], path, buckets.next_batch(spark, path), mode, table=table,
                                      buckets=FIRST_BUCKETS)
            written.add(table)
            bad = dv.unparsable(spark, r["name"], r["dataset_path"]).count()
            report.append((r["name"], "load", table, done["offered"], bad, f"{bad} records do not parse" if bad else None))
        except Exception as e:  # noqa: BLE001 - recorded per file; the stage fails at the end
            report.append((r["name"], "error", r["table_name"], 0, 0, f"{type(e).__name__}: {str(e).splitlines()[0][:500]}"))
    if written:
        marks = None
        for table in sorted(written):
            mark = buckets.current_watermark(spark, wh.path(f"raw/{table}"))
            marks = mark if marks is None else marks.unionByName(mark)
        wh.write("pipeline/trigger_watermarks", merge.merge_watermarks(wh.read("pipeline/trigger_watermarks"), marks))
    errors = [x for x in report if x[1] == "error"]
    ok = not errors and {"ratings", "movies"} <= {x[2] for x in report if x[1] == "load"}
    out = spark.createDataFrame([(*x, variant, ok) for x in report], "file string, action string, table_name string, rows_offered long, "
                                "unparsable long, reason string, variant string, ok boolean")
    out = wh.write("pipeline/ingest_report", out)
    if errors and strict:
        raise IngestFailed("; ".join(f"{x[0]}: {x[5]}" for x in errors), out)
    return out


def run_validate(spark: SparkSession, wh: Warehouse, strict: bool = False) -> DataFrame:
    return wh.write("pipeline/validation", quality.validate_all(wh.read("raw/ratings"), wh.read("raw/movies"), strict))


def run_featurize(spark: SparkSession, wh: Warehouse, lam: float = 0.1) -> dict[str, DataFrame]:
    rk, mv = wh.read("raw/ratings"), wh.read("raw/movies")
    tags = wh.read("raw/tags")
    if tags is None:
        tags = spark.createDataFrame([], "user_id int, movie_id int, tag string, timestamp long")
    uf = features.user_features(rk, mv, lam)
    prev = wh.read("features/user_features")
    if prev is not None:  # users that vanished from the ratings keep their last features
        uf = merge.merge_upsert(prev.withColumn("_v", F.lit(0)), uf.withColumn("_v", F.lit(1)), ["user_id"], "_v").drop("_v")
    return {"user_features": wh.write("features/user_features", uf),
            "decayed_history": wh.write("features/decayed_history", features.decayed_history(rk, lam)),
            "item_features": wh.write("features/item_features", features.item_features(mv, tags))}


def run_split(spark: SparkSession, wh: Warehouse, train: float = 0.8, val: float = 0.1) -> DataFrame:
    return wh.write("features/split_indices", split.temporal_split(wh.read("raw/ratings"), train, val), ["split"])


def _weighted_split(wh: Warehouse) -> DataFrame:
    return samples.sample_decay_weights(split.load_splits(wh.read("raw/ratings"), wh.read("features/split_indices")))


def run_sweep(spark: SparkSession, wh: Warehouse, grid: list[dict] | None = None) -> DataFrame:
    """Try the settings that no earlier sweep has tried; returns the best trial of all, with its settings."""
    done = wh.read("pipeline/sweep_trials")
    combos = spark.createDataFrame([(str(sorted(g.items())),) for g in grid or GRID], "params string")
    todo = combos if done is None else factors.pending_combos(combos, done.where("error is null"), ["params"])
    wanted = {r["params"] for r in todo.collect()}  # a configuration-sized list
    if wanted:
        w = _weighted_split(wh)
        new = factors.sweep_factors(w.filter(F.col("split") == "train"), w.filter(F.col("split") == "val"),
                                    [g for g in grid or GRID if str(sorted(g.items())) in wanted])
        base = 0 if done is None else done.agg(F.max("trial")).first()[0] + 1
        new = new.withColumn("trial", F.col("trial") + F.lit(base))
        done = wh.write("pipeline/sweep_trials", new if done is None else done.unionByName(new))
    return factors.best_trial(done).join(done.select("trial", "params"), "trial")


def best_settings(wh: Warehouse) -> dict:
    """Settings of the best trial so far; none without a sweep that scored anything."""
    done = wh.read("pipeline/sweep_trials")
    good = None if done is None else done.where((F.col("val_loss") < factors.FAILED_LOSS) & F.col("error").isNull())
    if good is None or good.isEmpty():
        return {}
    best = factors.best_trial(good).join(good.select("trial", "params"), "trial").first()["params"]
    return dict(ast.literal_eval(best))


def run_train(spark: SparkSession, wh: Warehouse, model_name: str = MODEL_NAME, **settings) -> dict[str, DataFrame]:
    """Fit on the train split, with the settings of the best trial unless some are given."""
    w = _weighted_split(wh)
    settings = settings or best_settings(wh) or {"rank": 16, "max_iter": 10}
    _, users, items = factors.fit_factors(w.filter(F.col("split") == "train"), **settings)
    return {"users": wh.write(f"models/{model_name}/users", users),
            "items": wh.write(f"models/{model_name}/items", items)}


def run_evaluate(spark: SparkSession, wh: Warehouse, batch_size: int = 256) -> DataFrame:
    """Weighted MSE of the factor vectors on the validation split, as a mean of batch means."""
    from marquee.operators import losses
    val = _weighted_split(wh).filter(F.col("split") == "val")
    u = wh.read(f"models/{MODEL_NAME}/users").withColumnRenamed("u", "uv")
    i = wh.read(f"models/{MODEL_NAME}/items").withColumnRenamed("i", "iv")
    pairs = val.join(u, "user_id").join(i, "movie_id")
    idx = split.with_global_index(pairs.select("id", "uv", "iv", "weight", "rating"), ["id"], out="k")
    loss = losses.batch_mean_loss(losses.weighted_mse_rows(idx), "k", batch_size)
    return wh.write("pipeline/evaluation", loss.withColumn("model_name", F.lit(MODEL_NAME)))


def run_cross_evaluate(spark: SparkSession, wh: Warehouse, batch_size: int = 256) -> DataFrame:
    """Divergence of every student's vectors from every teacher's on the validation pairs, as a mean of batch means.

    (teacher, student, kl); empty while there are fewer than two models. The models are folders of the warehouse."""
    from marquee.operators import losses
    names = wh.folders("models")
    pairs = losses.model_pairs(spark.createDataFrame([(n,) for n in names], "model_name string")).collect()
    out = spark.createDataFrame([], "teacher string, student string, kl double")
    val = _weighted_split(wh).filter(F.col("split") == "val").select("id", "user_id", "movie_id")
    val = losses.with_batches(val, batch_size, "id")
    for p in sorted(pairs, key=lambda p: (p["teacher"], p["student"])):
        rows = val
        for side, prefix in ((p["student"], "s"), (p["teacher"], "t")):
            rows = (rows.join(wh.read(f"models/{side}/users").withColumnRenamed("u", f"{prefix}u"), "user_id")
                    .join(wh.read(f"models/{side}/items").withColumnRenamed("i", f"{prefix}i"), "movie_id"))
        kl = losses.cross_kl(rows, "su", "si", "tu", "ti").agg(F.avg("kl").alias("kl"))
        out = out.unionByName(kl.select(F.lit(p["teacher"]).alias("teacher"), F.lit(p["student"]).alias("student"), "kl"))
    return wh.write("pipeline/cross_evaluation", out)


def run_precompute(spark: SparkSession, wh: Warehouse, top_n: int = 20, model_name: str = MODEL_NAME, head: dict | None = None) -> DataFrame:
    """Serving tables and the searchable item index of a model; the learned method only with a trained head."""
    users = wh.read(f"models/{model_name}/users").join(wh.read("features/user_features").select("user_id"), "user_id")
    items = wh.read(f"models/{model_name}/items")
    membership = retrieve.genre_membership(wh.read("features/item_features"))
    methods = ("cosine", "dot", "l2", *(("learned",) if head is not None else ()))
    top, cold = retrieve.precompute_serving(users, items, membership, model_name, methods, top_n, head=head)
    buckets.write_model_rows(top, wh.path("serving/top_n_user_genre"))  # a model's rows go as a whole, dropped methods too
    buckets.write_model_rows(cold, wh.path("serving/cold_start_genre"))
    retrieve.save_item_index(items, model_name, ("cosine", "dot", "l2"), wh.path("serving/item_index"))
    return retrieve.precompute_counts(*(buckets.read_model_rows(spark, wh.path(f"serving/{t}"), [model_name])
                                        for t in ("top_n_user_genre", "cold_start_genre")))


def raw_files(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Statistics of the files of every raw table, from their manifests."""
    files = spark.createDataFrame([], watermark.FILES)
    for t in CONFLICT_KEYS:
        m = buckets.manifest(spark, wh.path(f"raw/{t}"))
        if m is not None:
            files = files.unionByName(m.select(F.lit(t).alias("table_name"), "path", "rows", F.col("min_inserted_at").alias("lo"),
                                               F.col("max_inserted_at").alias("hi")))
    return files


def run_gate(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """(stage, run) of the daily run: ingest only where a raw table has rows after its watermark. Reads manifests only."""
    marks = wh.read("pipeline/trigger_watermarks")
    if marks is None:
        marks = spark.createDataFrame([], "table_name string, last_inserted_at timestamp_ntz")
    return watermark.daily_gate_by_files(raw_files(spark, wh), marks)


def run_trigger(spark: SparkSession, wh: Warehouse, requests: DataFrame) -> DataFrame:
    """Add a pending row per request (trigger_id, losses, architectures, requester, at) to the trigger log."""
    log = wh.read("pipeline/trigger_log")
    if log is None:
        log = spark.createDataFrame([], watermark.TRIGGER_LOG)
    return wh.write("pipeline/trigger_log", watermark.create_triggers(log, requests))


def run_trigger_log(spark: SparkSession, wh: Warehouse, updates: DataFrame) -> DataFrame:
    """Apply status updates (trigger_id, status, at) to the trigger log."""
    log = wh.read("pipeline/trigger_log")
    if log is None:
        raise FileNotFoundError("no trigger log")
    return wh.write("pipeline/trigger_log", watermark.trigger_log_update(log, updates))


def run(spark: SparkSession, data_dir: str, out: str, stages: list[str] | None = None, mode: str = "upsert") -> dict:
    wh = Warehouse(spark, out)
    summary = {}
    for stage in stages or STAGES:
        if stage == "ingest":
            res = run_ingest(spark, data_dir, wh, mode)
        elif stage == "validate":
            res = run_validate(spark, wh)
        elif stage == "featurize":
            res = {k: v.count() for k, v in run_featurize(spark, wh).items()}
        elif stage == "split":
            res = split.split_counts(run_split(spark, wh))
        elif stage == "sweep":
            res = run_sweep(spark, wh)
        elif stage == "train":
            res = {k: v.count() for k, v in run_train(spark, wh).items()}
        elif stage == "evaluate":
            res = run_evaluate(spark, wh)
        elif stage == "cross_evaluate":
            res = run_cross_evaluate(spark, wh)
        elif stage == "gate":
            res = run_gate(spark, wh)
        elif stage == "precompute":
            res = run_precompute(spark, wh)
        else:
            raise ValueError(f"unknown stage {stage!r}; known: {STAGES}")
        summary[stage] = res if isinstance(res, dict) else [r.asDict() for r in res.collect()]  # small reports
    return summary


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="python -m marquee.plans.stages")
    p.add_argument("--data-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--stages", default=",".join(STAGES))
    p.add_argument("--mode", default="upsert", choices=["upsert", "skip", "replace"])
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    try:
        print(json.dumps(run(spark, a.data_dir, a.out, a.stages.split(","), a.mode), default=str))
    finally:
        drop_session_scratch(spark)


if __name__ == "__main__":
    main()
