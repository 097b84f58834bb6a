"""Insert-time high-water marks: what is new since the last run, which table fires first, the daily gate,
and trigger-log status updates."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: tables tried in this order by the watermark check
RAW_TABLES = ["ratings", "movies", "tags", "links", "genome_scores"]
DONE_STATES = ("success", "failed")


def watermark_of(wm: DataFrame, table_name: str):
    """The stored high-water mark of one table (None when missing or null): one bounded row."""
    row = wm.filter(F.col("table_name") == table_name).agg(F.max("last_inserted_at").alias("m")).first()
    return None if row is None else row["m"]


def new_rows_since(df: DataFrame, table_name: str, wm: DataFrame, col: str = "inserted_at") -> DataFrame:
    """Rows inserted after the table's watermark; every row when the watermark is null or missing.

    wm: (table_name, last_inserted_at). The mark is read as one value, so the comparison becomes a
    literal predicate that reaches the table scan."""
    mark = watermark_of(wm, table_name)
    if mark is None:
        return df
    return df.filter(F.col(col) > F.lit(mark.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"))


def new_row_counts(tables: dict[str, DataFrame], wm: DataFrame, order: list[str] | None = None) -> DataFrame:
    """(ord, table_name, new_rows) for the given tables in the fixed order."""
    order = order or [t for t in RAW_TABLES if t in tables] + [t for t in tables if t not in RAW_TABLES]
    parts = [new_rows_since(tables[t], t, wm).agg(F.count(F.lit(1)).alias("new_rows"))
             .select(F.lit(n).alias("ord"), F.lit(t).alias("table_name"), "new_rows")
             for n, t in enumerate(order) if t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_changed_table(tables: dict[str, DataFrame], wm: DataFrame) -> DataFrame:
    """One row: has_new_data and the first table (in the fixed order) with new rows, else null. Tables are asked in turn for a
    single new row, and the first that has one ends it; without file statistics a table is read as far as that row."""
    order = [t for t in RAW_TABLES if t in tables] + [t for t in tables if t not in RAW_TABLES]
    hit = next((t for t in order if not new_rows_since(tables[t], t, wm).isEmpty()), None)
    return wm.sparkSession.createDataFrame([(hit is not None, hit)], "has_new_data boolean, table_name string")


STAGES = ("ingest", "validate", "featurize", "split", "train", "evaluate", "precompute")


def _gate(first: DataFrame, stages=STAGES) -> DataFrame:
    flags = F.array(*[F.struct(F.lit(s).alias("stage"),
                               (F.col("has_new_data") if s == "ingest" else F.lit(True)).alias("run"))
                      for s in stages])
    return first.select(F.explode(flags).alias("s")).select("s.*")


def daily_gate(tables: dict[str, DataFrame], wm: DataFrame, stages=STAGES) -> DataFrame:
    """(stage, run): ingest runs only when something is new; the later stages always run."""
    return _gate(first_changed_table(tables, wm), stages)


# ---------------------------------------------------------------- from file statistics

#: Statistics of a table's files: one row per file.
FILES = "table_name string, path string, rows long, lo timestamp_ntz, hi timestamp_ntz"


def file_statistics(df: DataFrame, table_name: str, col: str = "inserted_at") -> DataFrame:
    """The zone map of a scan: rows and range of insert times of every file; made when a version is written and kept beside it."""
    stats = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("lo"), F.max(col).alias("hi"))
    return stats.select(F.lit(table_name).alias("table_name"), "path", "rows", "lo", "hi")


def _marked(files: DataFrame, wm: DataFrame) -> DataFrame:
    """files with the watermark of their table (null without one): at most one mark a table."""
    marks = wm.groupBy("table_name").agg(F.max("last_inserted_at").alias("mark"))
    return files.join(marks, "table_name", "left")


def first_changed_by_files(files: DataFrame, wm: DataFrame) -> DataFrame:
    """first_changed_table from file statistics alone: a table has new rows if a file's latest insert time is beyond the mark.
    No table is opened."""
    new = (F.col("mark").isNull() & (F.col("rows") > 0)) | (F.col("hi") > F.col("mark"))
    names = F.array(*[F.lit(t) for t in RAW_TABLES])
    place = F.array_position(names, F.col("table_name"))
    order = F.when(place > 0, place).otherwise(F.lit(len(RAW_TABLES) + 1))
    first = _marked(files, wm).where(new).agg(F.min(F.struct(order.alias("ord"), "table_name")).alias("f"))
    return first.select(F.col("f").isNotNull().alias("has_new_data"), F.col("f.table_name").alias("table_name"))


def new_row_counts_by_files(spark: SparkSession, files: DataFrame, wm: DataFrame, col: str = "inserted_at") -> DataFrame:
    """(table_name, new_rows) of every table with files: those wholly beyond the mark count by their statistics, those that the
    mark falls within are read (their insert times only), the others are left alone."""
    m = _marked(files, wm)
    whole = m.where(F.col("mark").isNull() | (F.col("lo") > F.col("mark"))).select("table_name", F.col("rows").alias("n"))
    none = m.select("table_name", F.lit(0).cast("long").alias("n"))
    split = m.where((F.col("lo") <= F.col("mark")) & (F.col("hi") > F.col("mark")))
    parts = whole.unionByName(none)
    torn: dict[tuple, list[str]] = {}
    for r in split.select("table_name", "mark", "path").collect():  # files in which a mark falls
        torn.setdefault((r["table_name"], r["mark"]), []).append(r["path"])
    for (name, mark), paths in sorted(torn.items()):
        late = spark.read.parquet(*paths).where(F.col(col) > F.lit(mark.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz"))
        parts = parts.unionByName(late.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
    return parts.groupBy("table_name").agg(F.sum("n").alias("new_rows"))


def daily_gate_by_files(files: DataFrame, wm: DataFrame, **kw) -> DataFrame:
    """daily_gate from file statistics alone."""
    return _gate(first_changed_by_files(files, wm), **kw)


def trigger_log_update(log: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply (trigger_id, status, at) updates: set status; completed_at only on success/failed;
    null or unknown trigger ids change nothing; several updates of one id: the latest wins."""
    u = (updates.filter(F.col("trigger_id").isNotNull()).groupBy("trigger_id")
         .agg(F.max(F.struct("at", "status")).alias("_u")))
    j = log.join(u, "trigger_id", "left")
    new_status = F.coalesce(F.col("_u.status"), F.col("status"))
    done = F.col("_u.status").isin(*DONE_STATES)
    return j.select(*[c for c in log.columns if c not in ("status", "completed_at")],
                    new_status.alias("status"),
                    F.when(done, F.col("_u.at")).otherwise(F.col("completed_at")).alias("completed_at"))


TRIGGER_LOG = ("trigger_id string, trigger_type string, status string, created_at timestamp_ntz, completed_at timestamp_ntz, "
               "requested_losses array<string>, requested_architectures array<string>, requester string")
# FIXED VALUES: type and first status of a requested run, and the word for every loss or architecture
ON_DEMAND, FIRST_STATUS, ALL = "on_demand", "pending", "all"


def create_triggers(log: DataFrame, requests: DataFrame) -> DataFrame:
    """The log with one pending row per request (trigger_id, losses array, architectures array, requester, at).

    A list is kept as requested; null, or the one word "all", asks for all and is kept as null. A trigger id that the log has stays as it
    is; of several requests of one id the earliest counts (ties: by the other columns); requests without an id are left out."""
    def listed(c: str):
        return F.when(F.col(c) != F.array(F.lit(ALL)), F.col(c)).alias(c)

    row = F.struct("at", "requester", listed("losses"), listed("architectures"))
    first = requests.where(F.col("trigger_id").isNotNull()).groupBy("trigger_id").agg(F.min(row).alias("r"))
    new = first.join(log.select("trigger_id"), "trigger_id", "left_anti")
    made = new.select("trigger_id", F.lit(ON_DEMAND).alias("trigger_type"), F.lit(FIRST_STATUS).alias("status"), F.col("r.at").alias("created_at"),
                      F.lit(None).cast(log.schema["completed_at"].dataType).alias("completed_at"),
                      F.col("r.losses").alias("requested_losses"), F.col("r.architectures").alias("requested_architectures"),
                      F.col("r.requester").alias("requester"))
    return log.unionByName(made, allowMissingColumns=True)
