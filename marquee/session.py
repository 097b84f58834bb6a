"""Session helpers: build a local session for tests/bench, and resolve the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Scratch tables of this process, for drop_session_scratch.
_SCRATCH: list[str] = []


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "marquee",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MARQUEE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may do without the setting: it gets a private folder. On a cluster a private folder
    would be another disk on every machine, so the call raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="marquee-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder, for written intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/marquee-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def materialize(df, name: str):
    """Cut lineage by writing a Parquet table in the shared checkpoint folder and reading it back.

    One computation (a plain checkpoint() recomputes its input when it writes), columnar files, and
    the re-read gets pushdown and pruning. The table survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def task_keys(spark: SparkSession, n: int) -> list[int]:
    """n integers, the i-th of which a repartition(n, key) sends to task i: for work whose share of every task is known."""
    from pyspark.sql import functions as F

    found: dict[int, int] = {}
    first = 0
    while len(found) < n:
        ids = spark.range(first, first + 8 * n + 64).select(F.col("id").cast("int").alias("k"))
        for r in ids.select("k", F.pmod(F.hash("k"), F.lit(n)).alias("p")).collect():  # some multiple of n
            found.setdefault(r["p"], r["k"])
        first += 8 * n + 64
    return [found[i] for i in range(n)]


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table whose readers are done; only paths under the checkpoint folder are accepted."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(base + "/marquee-"):
        raise ValueError(f"{path} is no scratch table")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_session_scratch(spark: SparkSession) -> int:
    """Delete all scratch tables that this process has written; for the end of a run, when nothing reads them any more."""
    n = 0
    while _SCRATCH:
        drop_scratch(spark, _SCRATCH.pop())
        n += 1
    return n
