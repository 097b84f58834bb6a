"""Keyed merges (upsert / skip / replace), key cleaning, insert stamps and watermarks.

Parquet has no MERGE; a merge is a keyed anti-join plus union, written by the caller to a fresh version
folder (operators.buckets, plans.stages.Warehouse).
Duplicates inside one source are resolved with a grouped max_by/min_by over a struct that starts with
the order column: a partial (map-side) aggregate, so a hot key collapses before the shuffle.
"""
from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.split import with_global_index


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def null_sentinel(df: DataFrame, cols: list[str], sentinel: str = "nan") -> DataFrame:
    """Text equal to the sentinel becomes null."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.nullif(F.col(c), F.lit(sentinel)))
    return out


def stamp_inserted_at(df: DataFrame, batch_ts: datetime | None = None, col: str = "inserted_at") -> DataFrame:
    """Every row of one batch gets one and the same insert time (a literal, not a per-row clock)."""
    ts = batch_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    return df.withColumn(col, ntz_literal(ts))


def ntz_literal(ts: datetime):
    """A TIMESTAMP_NTZ literal from its wall-clock text (independent of the session time zone)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _pick(df: DataFrame, keys: list[str], order_col: str, last: bool) -> DataFrame:
    """One whole row per key, chosen by the order column: rows without an order value lose to all others, and equal
    orders are settled by a hash of the row, so the choice is the same in every run. One partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    present = F.col(order_col).isNotNull()
    by = F.struct((present if last else ~present).alias("p"), F.col(order_col).alias("o"),
                  F.xxhash64(*[F.col(c) for c in rest]).alias("h"))
    pick = F.max_by if last else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("_r"))
    return chosen.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])


def dedupe_last(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest order column (last arrival wins)."""
    return _pick(df, keys, order_col, last=True)


def dedupe_first(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the smallest order column (first arrival wins)."""
    return _pick(df, keys, order_col, last=False)


def merge_upsert(target: DataFrame, src: DataFrame, keys: list[str], order_col: str,
                 keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Insert new keys, replace the columns of existing keys; inside src the last row wins.

    The columns named in ``keep`` (row ids) stay as they are in the target, so rows that refer to them stay valid."""
    s = dedupe_last(drop_null_keys(src, keys), keys, order_col)
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    j = t.join(s.select(*keys, F.struct(*cols).alias("_s")), on=keys, how="full_outer")

    def value(c: str):
        first, second = ("_t", "_s") if c in keep else ("_s", "_t")
        return F.when(F.col(first).isNotNull(), F.col(first)[c]).otherwise(F.col(second)[c]).alias(c)

    return j.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


def merge_skip(target: DataFrame, src: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Insert new keys only; existing rows and the first src row of a key are kept."""
    s = dedupe_first(drop_null_keys(src, keys), keys, order_col)
    new = s.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(new.select(*target.columns))


def merge_replace(src: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Drop everything, then insert src; conflicting src rows keep the first."""
    return dedupe_first(drop_null_keys(src, keys), keys, order_col)


def arrival_ids(df: DataFrame, base: int = 0, out: str = "id") -> DataFrame:
    """Rows of a file scan numbered from base in arrival order: file path, then place in the file. Scans deal files
    to tasks by size, so the order of tasks says nothing about the order of files. Rows that carry _file, _start and _row
    already (sources.files.read_located) keep those."""
    located = df if {"_file", "_start", "_row"} <= set(df.columns) else df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))
    numbered = with_global_index(located, ["_file", "_start", "_row"], out)
    return numbered.withColumn(out, F.col(out) + F.lit(base)).drop("_file", "_start", "_row")


def next_id(table: DataFrame | None) -> int:
    """The first free row id of a table (0 for a new, empty or id-less one)."""
    if table is None or "id" not in table.columns:
        return 0
    top = table.agg(F.max("id")).first()[0]
    return 0 if top is None else top + 1


def merge_watermarks(previous: DataFrame | None, current: DataFrame) -> DataFrame:
    """Watermarks of all tables: those of this run replace the earlier ones of the same tables only."""
    if previous is None:
        return current
    return previous.join(current.select("table_name"), "table_name", "left_anti").unionByName(current)


def max_inserted_watermark(tables: dict[str, DataFrame], col: str = "inserted_at") -> DataFrame:
    """One row per table: the greatest insert time (null for an empty table)."""
    parts = [df.agg(F.max(col).alias("last_inserted_at")).select(F.lit(name).alias("table_name"), "last_inserted_at")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

