"""Keyed tables in growing hash buckets, committed by a manifest that carries statistics of every file.

A table is dealt to ``n`` buckets by a hash of its key. The directory is linear hashing: with m the largest power of two up to n, a
hash h lies in bucket ``h mod 2m``, or ``m`` less where that is n or more. So n grows by any number, an address is one expression,
and growing from n to n' moves rows out of as few buckets as it makes new ones. A merge grows the directory so far that a bucket
holds about ``bucket_rows`` rows, opens only the buckets that its rows fall in (and those that are split), and writes these anew
under the batch's version. Keys are unique after a merge and their hash is uniform, so no bucket becomes hot.

The manifest, one row per data file, names the directory's size and for every file its bucket, rows, bytes, largest id and the range of
its insert times. It is written last and commits the batch: a batch that fails before leaves the former state, and its replay
writes the same folders again. Row ids, watermarks and new rows come from the manifest, never from a scan of the table. It goes through the
driver: one row per file of ``bucket_rows`` rows.

    <table>/v=<batch>/bucket=<b>/...   <table>_manifest/v=<batch>   <table>_watermark/v=<batch>

Edge cases: rows with a null key are dropped; a source without rows commits a version that changes nothing (upsert, skip) or holds nothing
(replace); a committed batch is not merged again; a table without a manifest does not exist.
"""
from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import merge
from marquee.session import materialize

BUCKETS, BUCKET_ROWS = 64, 2_000_000
#: Paths that one task lists, and the setting that says how many tasks may list.
LIST_PATHS, LISTERS = 64, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
MANIFEST = ("directory int, bucket int, path string, rows long, bytes long, max_id long, min_inserted_at timestamp_ntz, "
            "max_inserted_at timestamp_ntz")
MANIFEST_ARROW = pa.schema([("directory", pa.int32()), ("bucket", pa.int32()), ("path", pa.string()), ("rows", pa.int64()), ("bytes", pa.int64()),
                            ("max_id", pa.int64()), ("min_inserted_at", pa.timestamp("us")), ("max_inserted_at", pa.timestamp("us"))])


# ---------------------------------------------------------------- versions

def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, folder: str) -> bool:
    fs, done = _path(spark, f"{folder.rstrip('/')}/_SUCCESS")
    return fs.exists(done)


def version_path(table_path: str, batch_id: int) -> str:
    return f"{table_path.rstrip('/')}/v={batch_id:08d}"


def versions(spark: SparkSession, table_path: str) -> list[int]:
    fs, root = _path(spark, table_path)
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def latest_version(spark: SparkSession, table_path: str, before: int | None = None) -> str | None:
    """The newest complete version folder (optionally older than a batch id)."""
    for v in reversed(versions(spark, table_path)):
        if (before is None or v < before) and committed(spark, version_path(table_path, v)):
            return version_path(table_path, v)
    return None


def beside(table_path: str, what: str) -> str:
    return f"{table_path.rstrip('/')}_{what}"


# ---------------------------------------------------------------- directory

def _level(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def address(h: Column, n: int) -> Column:
    """Bucket of a hash in a directory of n buckets."""
    m = _level(n)
    a = F.pmod(h, F.lit(2 * m))
    return F.when(a < n, a).otherwise(a - m).cast("int")


def source_of(bucket: int, n: int) -> int:
    """The bucket of a directory of n buckets that holds the rows of a bucket of a directory at least as large."""
    m = _level(n)
    a = bucket % (2 * m)
    return a if a < n else a - m


def grown(n: int, rows: int, bucket_rows: int) -> int:
    return max(n, -(-rows // bucket_rows))


# ---------------------------------------------------------------- manifest

def manifest(spark: SparkSession, table_path: str, before: int | None = None) -> DataFrame | None:
    """The files of the newest committed version (optionally older than a batch id) with their statistics; None without one."""
    path = latest_version(spark, beside(table_path, "manifest"), before)
    return None if path is None else spark.read.schema(MANIFEST).parquet(path)


def exists(spark: SparkSession, table_path: str) -> bool:
    return latest_version(spark, beside(table_path, "manifest")) is not None


@contextmanager
def _listing(spark: SparkSession, paths: int):
    """Within it, paths are listed by a task per LIST_PATHS of them, or one per core, instead of a task per path: a task costs more than
    the look at a small folder or file."""
    before = spark.conf.get(LISTERS)
    spark.conf.set(LISTERS, str(min(int(before), max(spark.sparkContext.defaultParallelism, -(-paths // LIST_PATHS)))))
    try:
        yield
    finally:
        spark.conf.set(LISTERS, before)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    with _listing(spark, len(paths)):
        return spark.read.parquet(*paths)


def current_table(spark: SparkSession, table_path: str) -> DataFrame:
    files = manifest(spark, table_path)
    paths = [r["path"] for r in files.select("path").collect()] if files is not None else []  # one per file
    if not paths:
        raise FileNotFoundError(f"no committed version under {table_path}")
    return _read(spark, paths)


def current_watermark(spark: SparkSession, table_path: str) -> DataFrame:
    """(table_name, last_inserted_at) of the newest committed batch."""
    commit = latest_version(spark, beside(table_path, "manifest"))
    if commit is None:
        raise FileNotFoundError(f"no watermark for {table_path}")
    return spark.read.parquet(version_path(beside(table_path, "watermark"), int(commit.rsplit("v=", 1)[1])))


def rows_since(spark: SparkSession, table_path: str, mark: datetime | None) -> DataFrame:
    """Rows inserted after the mark (all without one), from the files whose insert times reach beyond it only."""
    files = manifest(spark, table_path)
    if files is None:
        raise FileNotFoundError(f"no committed version under {table_path}")
    if mark is None:
        return current_table(spark, table_path)
    late = [r["path"] for r in files.where(F.col("max_inserted_at") > merge.ntz_literal(mark)).select("path").collect()]
    if not late:
        return current_table(spark, table_path).limit(0)
    return _read(spark, late).where(F.col("inserted_at") > merge.ntz_literal(mark))


# ---------------------------------------------------------------- merge

def _table(rows: list[tuple]) -> pa.Table:
    """Manifest rows for Spark, as a local relation instead of a job of Python rows."""
    columns = list(zip(*rows)) or [[] for _ in MANIFEST_ARROW]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, MANIFEST_ARROW)], MANIFEST_ARROW)


def _statistics(spark: SparkSession, folder: str, merged: DataFrame, directory: int) -> DataFrame:
    """One manifest row per file that a batch wrote from the merged rows. Names and bytes come from the listing, the rest from the rows, which lie in a
    few large files; only where a bucket has several files are these opened."""
    stats = [F.count(F.lit(1)).alias("rows"), F.max("id").alias("max_id"), F.min("inserted_at").alias("min_inserted_at"), F.max("inserted_at").alias("max_inserted_at")]
    with _listing(spark, directory):
        written = spark.read.schema(merged.schema).parquet(folder)
        listed = spark.read.format("binaryFile").load(folder)
    files = listed.select(F.regexp_extract("path", "bucket=([0-9]+)/[^/]+$", 1).cast("int").alias("bucket"), F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes"))
    if files.groupBy("bucket").count().where("count > 1").isEmpty():
        found = files.join(merged.groupBy("bucket").agg(*stats), "bucket")
    else:
        found = written.groupBy("bucket", F.col("_metadata.file_name").alias("file")).agg(*stats, F.max("_metadata.file_size").alias("bytes"))
    path = F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string"), F.lit("/"), F.col("file"))
    return found.select(F.lit(directory).alias("directory"), "bucket", path.alias("path"), "rows", "bytes", "max_id", "min_inserted_at",
                        "max_inserted_at")


def merge_rows(spark: SparkSession, source: DataFrame, keys: list[str], table_path: str, batch_id: int, mode: str = "upsert",
               stamp: datetime | None = None, table: str = "", buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS,
               keep_versions: int | None = 3) -> dict:
    """Merge the rows of a file scan into the table as batch ``batch_id`` (upsert | skip | replace); nothing if that batch is committed.

    Rows get ids in arrival order after the table's largest one, and the batch's time. ``buckets`` is the directory of a new table.
    Returns what was done: rows offered, the directory's size, and the numbers of the buckets opened and written."""
    commit = version_path(beside(table_path, "manifest"), batch_id)
    if committed(spark, commit):
        return {}
    if mode not in ("upsert", "skip", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    old = manifest(spark, table_path, before=batch_id)
    before = [] if old is None else old.collect()  # one row per file
    n = max((r["directory"] for r in before), default=buckets)
    first_id = max((r["max_id"] for r in before if r["max_id"] is not None), default=-1) + 1
    src = merge.arrival_ids(merge.drop_null_keys(source, keys), first_id)
    offered = src.count()  # written by then: from the files' footers
    if mode == "replace":
        before, n = [], buckets
    size = grown(n, sum(r["rows"] for r in before) + offered, bucket_rows)
    src = merge.stamp_inserted_at(src, stamp).withColumn("bucket", address(F.xxhash64(*keys), size))
    touched = {r["bucket"] for r in src.select("bucket").distinct().collect()}  # at most the directory
    opened = {source_of(b, n) for b in touched | set(range(n, size))}
    state = [r["path"] for r in before if r["bucket"] in opened]
    columns = src.columns
    target = (_read(spark, state).withColumn("bucket", address(F.xxhash64(*keys), size)).select(*columns) if state else src.limit(0))
    if not state and mode == "upsert":  # nothing to meet
        merged = merge.dedupe_last(src, keys, "id")
    elif mode == "upsert":
        merged = merge.merge_upsert(target, src, keys, "id")
    elif mode == "skip":
        merged = merge.merge_skip(target, src, keys, "id")
    else:
        merged = merge.merge_replace(src, keys, "id")
    out = version_path(table_path, batch_id)
    merged = materialize(merged, "merged")  # for the buckets and their statistics
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
    fresh = _statistics(spark, out, merged, size).collect()  # one row per file
    kept = [r for r in before if r["bucket"] not in opened]
    rows = [(size, *list(r)[1:]) for r in kept] + [tuple(r) for r in fresh]
    now = spark.createDataFrame(_table(rows)).coalesce(1)
    marks = merge.max_inserted_watermark({table: now.select(F.col("max_inserted_at").alias("inserted_at"))})
    marks.write.mode("overwrite").parquet(version_path(beside(table_path, "watermark"), batch_id))
    now.write.mode("overwrite").parquet(commit)
    if keep_versions is not None:
        vacuum(spark, table_path, keep_versions)
    return {"offered": offered, "directory": size, "opened": sorted({r["bucket"] for r in before} & opened),
            "written": sorted({r["bucket"] for r in fresh})}


def next_batch(spark: SparkSession, table_path: str) -> int:
    """The number after the newest committed batch."""
    path = latest_version(spark, beside(table_path, "manifest"))
    return 0 if path is None else int(path.rsplit("v=", 1)[1]) + 1


def vacuum(spark: SparkSession, table_path: str, keep_versions: int = 3) -> None:
    """Delete bucket folders that none of the last manifests refers to, and older manifests and watermarks."""
    manifests = beside(table_path, "manifest")
    kept = [v for v in versions(spark, manifests) if committed(spark, version_path(manifests, v))][-keep_versions:]
    if not kept:
        return
    used = {r["path"].rsplit("/", 1)[0] for v in kept for r in manifest(spark, table_path, before=v + 1).select("path").collect()}
    for v in versions(spark, table_path):
        if v >= kept[0]:
            continue
        fs, root = _path(spark, version_path(table_path, v))
        for p in [st.getPath() for st in fs.listStatus(root) if st.isDirectory()]:
            if f"{version_path(table_path, v)}/{p.getName()}" not in used:
                fs.delete(p, True)
    for side in ("manifest", "watermark"):
        for v in versions(spark, beside(table_path, side)):
            if v < kept[0]:
                fs, p = _path(spark, version_path(beside(table_path, side), v))
                fs.delete(p, True)


# ---------------------------------------------------------------- model partitions

PARTS = "model string, path string"


def _parts(spark: SparkSession, path: str, before: int | None = None) -> dict[str, str]:
    """Folder of every model's rows in the newest committed version; one row per model."""
    found = latest_version(spark, beside(path, "manifest"), before)
    return {} if found is None else {r["model"]: r["path"] for r in spark.read.schema(PARTS).parquet(found).collect()}


def write_model_rows(df: DataFrame, path: str, by: str = "model_name", keep_versions: int = 3) -> None:
    """Replace the rows of the models present in df as a new version; rows of other models stay where they are.

    The models' rows are written to a fresh folder each; a manifest (model -> folder) written last commits, so readers of
    the version before are not disturbed and a write that fails leaves it as it is."""
    spark = df.sparkSession
    version = next_batch(spark, path)
    out = version_path(path, version)
    df.withColumn("part", F.md5(F.col(by).cast("string"))).write.mode("overwrite").partitionBy("part").parquet(out)
    new = spark.read.schema(df.schema).parquet(out).select(F.col(by).cast("string").alias("m"), F.md5(F.col(by).cast("string")).alias("h"))
    folders = {r["m"]: f"{out}/part={r['h']}" for r in new.distinct().collect()}  # one row per model
    now = _parts(spark, path) | folders
    rows = spark.createDataFrame(sorted(now.items()), PARTS).coalesce(1)
    rows.write.mode("overwrite").parquet(version_path(beside(path, "manifest"), version))
    manifests = beside(path, "manifest")
    kept = [v for v in versions(spark, manifests) if committed(spark, version_path(manifests, v))][-keep_versions:]
    used = {p for v in kept for p in _parts(spark, path, before=v + 1).values()}
    for v in versions(spark, path):
        fs, root = _path(spark, version_path(path, v))
        for p in [st.getPath() for st in fs.listStatus(root) if st.isDirectory()] if v < kept[0] else []:
            if f"{version_path(path, v)}/{p.getName()}" not in used:
                fs.delete(p, True)
    for v in versions(spark, manifests):
        if v < kept[0]:
            fs, p = _path(spark, version_path(manifests, v))
            fs.delete(p, True)


def read_model_rows(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    """The rows of all models, or of those named; only their folders are read."""
    folders = [p for m, p in sorted(_parts(spark, path).items()) if models is None or m in models]
    if not folders:
        raise FileNotFoundError(f"no such models under {path}")
    return _read(spark, folders)
