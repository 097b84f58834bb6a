"""Losses and evaluation over (user vector, item vector, weight, rating) rows.

Row-wise losses are column expressions. InfoNCE needs the in-batch similarity matrix. A batch of up to a tile's rows is one
matrix in one task; a larger one is cut in shares of ``SHARE_ROWS`` users and items (at least a tile), every (user share, item share) cell is
one co-grouped task that computes its matrix strip by strip, and a cell emits for each of its rows and columns a largest similarity and the
sum of exponentials below it. These states merge by a grouped aggregation, whatever their order, so a batch of any size has an exact
loss; no pair rows are emitted. The shares of n rows ship 2 n^2 / SHARE_ROWS vectors, whatever the tile.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import vectors as V
from marquee.operators.split import with_global_index
from marquee.session import materialize


#: Rows of a share of a large batch, rows of a strip of its matrix, and the widest range of exponents that one shift serves.
SHARE_ROWS, STRIP_ROWS, EXP_RANGE = 16_384, 128, 600.0


def weighted_mse_rows(pairs: DataFrame, rating_scale: float = 5.0) -> DataFrame:
    """Per row: w * (((cos + 1) / 2) - rating / scale)^2."""
    pred = (V.cosine("uv", "iv") + F.lit(1.0)) / F.lit(2.0)
    err = pred - F.col("rating") / F.lit(rating_scale)
    return pairs.withColumn("loss", F.col("weight") * err * err)


def weighted_mse(pairs: DataFrame, by: str = "batch_id") -> DataFrame:
    return weighted_mse_rows(pairs).groupBy(by).agg(F.avg("loss").alias("loss"))


def _unit(vectors: pd.Series) -> np.ndarray:
    M = np.stack([np.asarray(x, dtype=np.float64) for x in vectors])
    return M / np.maximum(np.linalg.norm(M, axis=1, keepdims=True), 1e-12)


def _infonce_batch(pdf: pd.DataFrame, tau: float) -> float:
    S = _unit(pdf["uv"]) @ _unit(pdf["iv"]).T / tau
    idx = np.arange(len(pdf))
    S[idx, idx] *= pdf["weight"].to_numpy(dtype=np.float64)

    def ce(M):
        m = M.max(axis=1, keepdims=True)
        lse = (m + np.log(np.exp(M - m).sum(axis=1, keepdims=True)))[:, 0]
        return float(np.mean(lse - M[idx, idx]))

    return (ce(S) + ce(S.T)) / 2.0


def with_batches(pairs: DataFrame, batch_size: int = 256, order: str = "k", by: str = "batch_id") -> DataFrame:
    """Batches of ``batch_size`` consecutive rows in a unique order, from a global index."""
    idx = with_global_index(pairs, [order], out="_n")
    return idx.withColumn(by, F.floor(F.col("_n") / batch_size)).drop("_n")


TILE = 2048


def infonce_loss(pairs: DataFrame, tau: float = 0.07, by: str = "batch_id", order: str = "k", tile: int = TILE) -> DataFrame:
    """Per batch: mean of the row-wise and column-wise cross-entropy of cos/tau, diagonal scaled by weight. Batches above
    ``tile`` rows are tiled; ``order`` tells the rows of a batch apart. Null batch ids are a batch; there are no batches in an empty table."""
    rows = pairs.select(by, order, "uv", "iv", "weight")
    sizes = materialize(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_rows")), "infonce-batches")
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    if largest <= tile:
        return _whole_batches(rows, tau, by, order)
    big = sizes.where(F.col("_rows") > tile).select(F.col(by).alias("_big"), F.ceil(F.col("_rows") / max(tile, SHARE_ROWS)).cast("int").alias("_tiles"))
    sized = rows.join(big, F.col(by).eqNullSafe(F.col("_big")), "left").drop("_big")
    small = _whole_batches(sized.where(F.col("_tiles").isNull()).drop("_tiles"), tau, by, order)
    return small.unionByName(_tiled_batches(sized.where(F.col("_tiles").isNotNull()), tau, by, order))


def _whole_batches(rows: DataFrame, tau: float, by: str, order: str) -> DataFrame:
    key_type = rows.schema[by].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pd.DataFrame({by: [pdf[by].iloc[0]], "loss": [_infonce_batch(pdf, tau)]})

    return rows.groupBy(by).applyInPandas(run, f"{by} {key_type}, loss double")


def _cell_states(strip, n: int, m: int, row_times: np.ndarray, times: np.ndarray, own: np.ndarray | None, strip_rows: int = STRIP_ROWS):
    """((top, sum) of each row, (top, sum) of each column) of an n x m matrix that ``strip`` gives by slices of rows, new arrays. Row i stands for
    row_times[i] equal ones, column j for times[j]; ``own`` takes the place of one copy on the diagonal. One strip is held at a time."""
    row_top, row_sum = np.full(n, -np.inf), np.zeros(n)
    col_top, col_sum = np.full(m, -np.inf), np.zeros(m)

    def merged(top, total, more_top, more):
        best = np.maximum(top, more_top)
        shift = np.where(np.isfinite(best), best, 0.0)
        return best, total * np.exp(top - shift) + more * np.exp(more_top - shift)

    for s in range(0, n, strip_rows):
        r = slice(s, min(n, s + strip_rows))
        x = strip(r)
        at = np.arange(r.start, r.stop)
        if own is not None and not (row_times[at] > 1).all():
            x[(at - s)[row_times[at] <= 1], at[row_times[at] <= 1]] = -np.inf
        if not np.isfinite(x).any():
            continue

        def sums(e, e_col):
            if own is not None:  # of n equal ones, n - 1 are left beside the own pair
                for one in (e,) if e is e_col else (e, e_col):
                    one[at - s, at] *= (times[at] - 1) / times[at]
            return e @ times, row_times[r] @ e_col

        high, low = x.max(), np.min(x, where=np.isfinite(x), initial=np.inf)
        if high - low < EXP_RANGE:  # one shift for the strip: each exponential is taken once for its row and its column
            e = np.exp(x - high)
            row_top[r], top = high, np.full(m, high)
            row_sum[r], total = sums(e, e)
        else:
            row_top[r], top = x.max(axis=1), x.max(axis=0)
            own_shift, shift = (np.where(np.isfinite(t), t, 0.0) for t in (row_top[r], top))
            row_sum[r], total = sums(np.exp(x - own_shift[:, None]), np.exp(x - shift))
        col_top, col_sum = merged(col_top, col_sum, top, total)
    if own is not None:
        row_top, row_sum = merged(row_top, row_sum, own, np.ones(n))
        col_top, col_sum = merged(col_top, col_sum, own, np.ones(m))
    return (row_top, row_sum), (col_top, col_sum)


def _tiled_batches(rows: DataFrame, tau: float, by: str, order: str) -> DataFrame:
    """rows with their batch's number of tiles (_tiles): the loss of each batch from merged (largest, sum) states. Equal rows
    are folded to one with a count first, so they are neither a hot tile nor a hot group."""
    rows = rows.groupBy(by, order, "uv", "iv", "weight", "_tiles").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_row", F.xxhash64(order, "uv", "iv", "weight")).withColumn("_batch", F.xxhash64(by))
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("_row"), F.col("_tiles")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    users = rows.select("_batch", F.col("_own").alias("_u"), others.alias("_i"), "_row", "_n", F.col("uv").alias("v"), "weight")
    items = rows.select(F.col("_batch").alias("b_batch"), others.alias("b_u"), F.col("_own").alias("b_i"), F.col("_row").alias("b_row"),
                        F.col("_n").alias("b_n"), F.col("iv").alias("b_v"))
    schema = "_batch long, _side int, _row long, _top double, _sum double, _value double, _n long"

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({c.split()[0]: pd.Series(dtype="float64") for c in schema.split(", ")})
        b = b.rename(columns=lambda c: c[1:] if c != "b_v" else "v")
        a, b = a.sort_values("_row"), b.sort_values("_row")
        A, B = _unit(a["v"]), _unit(b["v"])
        na, nb = a["_n"].to_numpy(np.float64), b["_n"].to_numpy(np.float64)
        own = None
        if a["_u"].iloc[0] == b["_i"].iloc[0]:  # the same rows on both sides
            own = np.einsum("ij,ij->i", A, B) / tau * a["weight"].to_numpy(np.float64)
        rows, columns = _cell_states(lambda r: A[r] @ B.T / tau, len(A), len(B), na, nb, own)
        out = []
        for side, (top, total), frame in ((0, rows, a), (1, columns, b)):
            out.append(pd.DataFrame({"_batch": a["_batch"].iloc[0], "_side": side, "_row": frame["_row"].to_numpy(), "_top": top, "_sum": total,
                                     "_value": np.full(len(top), np.nan) if own is None else own, "_n": frame["_n"].to_numpy()}))
        return pd.concat(out)

    cells = users.groupBy("_batch", "_u", "_i").cogroup(items.groupBy("b_batch", "b_u", "b_i"))
    states = cells.applyInPandas(run, schema)
    # one state for each share of the other side
    merged = states.groupBy("_batch", "_side", "_row").agg(
        F.max("_top").alias("_top"), F.collect_list(F.struct("_top", "_sum")).alias("_parts"),
        F.max(F.when(~F.isnan("_value"), F.col("_value"))).alias("_value"), F.max("_n").alias("_n"))
    total = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + p["_sum"] * F.exp(p["_top"] - F.col("_top")))
    entropy = F.col("_n") * (F.col("_top") + F.log(total) - F.col("_value"))
    loss = merged.groupBy("_batch").agg((F.sum(entropy) / F.sum("_n")).alias("loss"))
    return loss.join(rows.groupBy("_batch").agg(F.first(by).alias(by)), "_batch").select(by, "loss")


def _masked_sq(s: str, t: str, mask_dims: int):
    diffs = F.zip_with(s, t, lambda a, b: a - b)
    masked = F.transform(diffs, lambda x, j: F.when(j < mask_dims, F.lit(0.0)).otherwise(x * x))
    return F.aggregate(masked, F.lit(0.0), lambda acc, x: acc + x)


def embedding_kl(rows: DataFrame, student: str, teacher: str, mask_dims: int = 0, by: str = "batch_id") -> DataFrame:
    """0.5 * mean over all B*D cells of (s - t)^2; the first mask_dims differences are 0 but still counted."""
    per = rows.select(by, _masked_sq(student, teacher, mask_dims).alias("sq"), F.size(student).alias("d"))
    return per.groupBy(by).agg((F.lit(0.5) * F.sum("sq") / (F.count(F.lit(1)) * F.max("d"))).alias("kl"))


def cross_kl(rows: DataFrame, s_user: str, s_item: str, t_user: str, t_item: str, mask_dims: int = 0,
             by: str = "batch_id") -> DataFrame:
    """Concatenate (user, item) of each model, cut both to the shorter length, then embedding_kl."""
    s = F.concat(s_user, s_item)
    t = F.concat(t_user, t_item)
    n = F.least(F.size(s), F.size(t))
    cut = rows.select(by, F.slice(s, 1, n).alias("_s"), F.slice(t, 1, n).alias("_t"))
    return embedding_kl(cut, "_s", "_t", mask_dims, by)


def model_pairs(models: DataFrame, col: str = "model_name") -> DataFrame:
    """All ordered (teacher, student) with teacher != student; none for fewer than two models. The pairs are the answer;
    names are distinct before they meet."""
    names = models.select(col).where(F.col(col).isNotNull()).distinct()
    return (names.select(F.col(col).alias("teacher")).join(names.select(F.col(col).alias("student")),
                                                          F.col("teacher") != F.col("student")))


def batch_mean_loss(row_loss: DataFrame, index_col: str, batch_size: int, by: list[str] | None = None,
                    loss: str = "loss") -> DataFrame:
    """Mean of per-batch means (batch = index div batch_size; a short last batch weighs the same)."""
    keys = list(by or [])
    b = row_loss.withColumn("_b", F.floor(F.col(index_col) / batch_size))
    per = b.groupBy(*keys, "_b").agg(F.avg(loss).alias("_m"))
    return per.groupBy(*keys).agg(F.avg("_m").alias("loss"))


def embedding_norm_stats(users: DataFrame, items: DataFrame, u: str = "u", i: str = "i") -> DataFrame:
    """(mean_user_norm, mean_item_norm): one aggregate over the union of both sides (no join)."""
    both = (users.select(F.lit("u").alias("_s"), V.norm(u).alias("_n"))
            .unionByName(items.select(F.lit("i").alias("_s"), V.norm(i).alias("_n"))))
    return both.agg(F.avg(F.when(F.col("_s") == "u", F.col("_n"))).alias("mean_user_norm"),
                    F.avg(F.when(F.col("_s") == "i", F.col("_n"))).alias("mean_item_norm"))


def best_epoch(metrics: DataFrame, run: str = "run_id", epoch: str = "step", value: str = "value") -> DataFrame:
    """Per run the first epoch with the strictly lowest value; epochs without a number are no candidates, so a run
    that has no other is left out."""
    metrics = metrics.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    best = F.min(F.struct(value, epoch)).alias("b")
    return metrics.groupBy(run).agg(best).select(run, F.col(f"b.{epoch}").alias("best_epoch"),
                                                F.col(f"b.{value}").alias("best_value"))


def ema_blend(prev: DataFrame, cur: DataFrame, key: str, col: str, alpha: float) -> DataFrame:
    """alpha * cur + (1 - alpha) * prev, elementwise per key."""
    j = prev.select(key, F.col(col).alias("_p")).join(cur.select(key, F.col(col).alias("_c")), key)
    return j.select(key, F.zip_with("_c", "_p", lambda c, p: F.lit(alpha) * c + F.lit(1.0 - alpha) * p).alias(col))
