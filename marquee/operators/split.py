"""Global position in a total order without a single-task window, exact selection of ranks, and the temporal split by selection.

with_global_index: range-partition on the order columns, sort inside partitions, record
(partition id, row position), write that table to the checkpoint folder so both are fixed, count rows per partition (one small
row per partition to the driver), then add the running offsets as a literal array. No un-partitioned
window and no second shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialize

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def with_global_index(df: DataFrame, order_cols: list[str], out: str = "idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position in the total order given by order_cols (which must be unique together)."""
    # Without an explicit count, AQE may merge neighbouring range partitions (order is kept: only
    # contiguous ranges are merged), so partition sizes follow the data instead of a fixed setting.
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    ranged = (ranged.sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "global-index")  # written once: ids can no longer move on a retry
    counts = {r["_pid"]: r["n"] for r in ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, running = [], 0
    for pid in range(max(counts) + 1 if counts else 0):
        offsets.append(running)
        running += counts.get(pid, 0)
    if not offsets:
        return ranged.drop("_pid", "_pos").withColumn(out, F.lit(None).cast("bigint"))
    offs = F.array(*[F.lit(o).cast("bigint") for o in offsets])
    local = F.col("_pos") - F.shiftleft(F.col("_pid").cast("bigint"), _POS_BITS)
    return ranged.withColumn(out, F.get(offs, F.col("_pid")) + local).drop("_pid", "_pos")


#: Counts of one round of a selection: at most so many bins for each rank.
BINS = 4096
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _as_long(df: DataFrame, col: str):
    """An order-preserving long of a column (nulls first), or None where its type has none."""
    kind = df.schema[col].dataType.simpleString()
    if kind in _INTEGERS:
        return F.coalesce(F.col(col).cast("long"), F.lit(_LEAST))
    if kind == "timestamp":
        return F.coalesce(F.unix_micros(col), F.lit(_LEAST))
    if kind == "timestamp_ntz":
        return F.coalesce(F.unix_micros(F.to_utc_timestamp(F.col(col).cast("timestamp"), F.current_timezone())), F.lit(_LEAST))
    if kind == "date":
        return F.coalesce(F.unix_date(col).cast("long"), F.lit(_LEAST))
    return None


_LEAST = -(1 << 63)


def order_statistics(df: DataFrame, keys: list, ranks: list[int], bins: int = BINS) -> list[tuple[int, ...]]:
    """The key tuples at 0-based ranks of the lexicographic order of long columns, exactly.

    Every round counts the rows of at most ``bins`` equal intervals for each rank and goes on inside the one that holds the
    rank: some three scans a key for 32-bit ranges, six for 64 bits. Nothing is sorted, and a round shuffles counts only."""
    spots = [{"prefix": (), "rank": r} for r in ranks]
    for key in keys:
        def here(spot):
            cond = F.lit(True)
            for k, v in zip(keys, spot["prefix"]):
                cond = cond & (k == F.lit(v))
            return cond

        ends = df.agg(*[f(F.when(here(s), key)).alias(f"{n}{i}") for i, s in enumerate(spots) for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for i, s in enumerate(spots):
            s["lo"], s["hi"] = ends[f"lo{i}"], ends[f"hi{i}"]
            if s["lo"] is None:
                raise ValueError("a rank lies beyond the rows")
        while any(s["lo"] < s["hi"] for s in spots):
            parts = []
            for s in spots:
                s["width"] = -(-(s["hi"] - s["lo"] + 1) // bins)
                # decimals where a difference of longs may overflow
                kind = "decimal(22,0)" if s["hi"] - s["lo"] >= 1 << 62 else "bigint"
                x, width = key.cast(kind) - F.lit(s["lo"]).cast(kind), F.lit(str(s["width"])).cast(kind)
                inside = here(s) & key.between(F.lit(s["lo"]), F.lit(s["hi"]))
                bin_ = F.round(((x - F.pmod(x, width)) / width).cast("double"))  # an exact multiple, so rounding restores it
                parts.append(F.when(inside, bin_.cast("int")))
            one = df.select(F.posexplode(F.array(*parts)).alias("spot", "bin")).where("bin is not null")
            found: dict[int, list] = {}
            for r in one.groupBy("spot", "bin").agg(F.count(F.lit(1)).alias("n")).collect():  # at most bins rows a rank
                found.setdefault(r["spot"], []).append((r["bin"], r["n"]))
            for i, s in enumerate(spots):
                for b, n in sorted(found[i]):
                    if s["rank"] < n:
                        break
                    s["rank"] -= n
                low = s["lo"] + b * s["width"]
                s["lo"], s["hi"] = low, min(s["hi"], low + s["width"] - 1)
        for s in spots:
            s["prefix"] += (s["lo"],)
    return [s["prefix"] for s in spots]


def temporal_split(rk: DataFrame, train: float = 0.8, val: float = 0.1,
                   ts: str = "timestamp", key: str = "id") -> DataFrame:
    """(rating_id, split): the first int(n*train) by (timestamp, id) train, next int(n*val) val, rest test.

    The two rows at which the split changes are found by selection (order_statistics, which scans the two columns a few times),
    so the labels are a comparison with two literals: ratings are neither sorted nor written nor shuffled. Rows that agree in
    both columns have no order and are labelled alike. Columns that are no integers, dates or times are ordered by a written index."""
    if not train + val < 1.0:
        raise ValueError("train + val fractions must be < 1.0")
    rows = rk.select(key, ts)
    n = rows.count()
    if n == 0:
        raise ValueError("ratings are empty")
    n_train, n_val = int(n * train), int(n * val)
    when, which = _as_long(rows, ts), _as_long(rows, key)
    if when is None or which is None:
        indexed = with_global_index(rows, [ts, key])
        label = (F.when(F.col("idx") < n_train, F.lit("train"))
                 .when(F.col("idx") < n_train + n_val, F.lit("val")).otherwise(F.lit("test")))
        return indexed.select(F.col(key).alias("rating_id"), label.alias("split"))
    cuts = order_statistics(rows, [when, which], [n_train, n_train + n_val])

    def before(cut):
        return (when < F.lit(cut[0])) | ((when == F.lit(cut[0])) & (which < F.lit(cut[1])))

    label = F.when(before(cuts[0]), F.lit("train")).when(before(cuts[1]), F.lit("val")).otherwise(F.lit("test"))
    return rows.select(F.col(key).alias("rating_id"), label.alias("split"))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def write_split(split: DataFrame, path: str) -> None:
    """Replace the split table; partitioned by split so one split reads alone."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def load_splits(rk: DataFrame, split: DataFrame) -> DataFrame:
    """Ratings with their split label (inner join on the rating id)."""
    return rk.join(split.withColumnRenamed("rating_id", "id"), "id", "inner")


def split_filter(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("split") == name)
