"""Model fitting re-aimed as Spark jobs: weighted factors of interactions, a sweep on the temporal split,
best-trial choice and skipping of settings already tried.

The factors stand in for the neural trainers: same role (user and item vectors from weighted ratings), different numbers. They
minimise, by alternating least squares,

    sum over rows of weight * (rating / 5 - u.v)^2  +  background * sum over all pairs of (u.v)^2  +  reg * (sum |u|^2 + sum |v|^2)

so every row counts by its own weight, and pairs without a row are drawn to 0. A half-step solves the normal equations of one side:
for a user, (background * V'V + reg * I + sum of weight * v v') u = sum of weight * rating / 5 * v. V'V is one small matrix. Rows
meet the other side's vectors in a join and are then dealt by user; a user with more rows than ``HOT_ROWS`` is dealt to several
tasks, each of which adds up its part, and only such users' sums meet again. Every half-step is written.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import vectors as V
from marquee.session import materialize

FAILED_LOSS = 9999.0
RATING_SCALE, HOT_ROWS = 5.0, 200_000
#: Fixed values of the starting vectors: component j of an id is ((id * A + (j + 1) * B + seed * C) mod M) / M - 1/2.
START = {"A": 7919, "B": 4421, "C": 31, "M": 1009}


@dataclass
class FactorModel:
    """Fitted vectors: users (user_id, u) and items (movie_id, i)."""

    users: DataFrame
    items: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        """rows plus prediction, null where the user or the item has no vector."""
        joined = rows.join(self.users, "user_id", "left").join(self.items, "movie_id", "left")
        return joined.withColumn("prediction", F.when(F.col("u").isNotNull() & F.col("i").isNotNull(), V.dot("u", "i"))).drop("u", "i")


def start_vector(id_: Column, rank: int, seed: int) -> Column:
    """The rule's starting vector of an id."""
    m = START["M"]
    own = F.pmod(F.pmod(id_.cast("long"), F.lit(m)) * START["A"] + F.lit(seed % m * START["C"]), F.lit(m))
    return F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda j: F.pmod(own + j * START["B"], F.lit(m)).cast("double") / m - F.lit(0.5))


def gram(vectors: DataFrame, col: str, rank: int) -> np.ndarray:
    """V'V of a table of vectors: partial sums of the tasks, rank * rank numbers to the driver."""
    def run(batches):
        total = np.zeros((rank, rank))
        for b in batches:
            if len(b):
                m = np.stack(b[col].to_numpy())
                total += m.T @ m
        yield pd.DataFrame({"at": np.arange(rank * rank), "x": total.ravel()})

    out = np.zeros(rank * rank)
    for r in vectors.select(col).mapInPandas(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r["x"]
    return out.reshape(rank, rank)


def _sums(rank: int, base: np.ndarray):
    """Rows (id, parts, f, w, y), sorted by id and part, to one row per part: its solved vector where it is the only one, else its sums."""
    def add(state, f, w, y):
        state[0] += (f * w[:, None]).T @ f
        state[1] += f.T @ (w * y)

    def made(key, state):
        if key[1] == 1:
            return key[0], np.linalg.solve(state[0] + base, state[1]), None
        return key[0], None, np.concatenate((state[0].ravel(), state[1]))

    def run(batches):
        key, state = None, None
        for b in batches:
            if not len(b):
                continue
            ids, parts, part = (b[c].to_numpy(np.int64) for c in ("id", "parts", "part"))
            f, w, y = np.stack(b["f"].to_numpy()), b["w"].to_numpy(np.float64), b["y"].to_numpy(np.float64)
            cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(part) != 0)) + 1
            out = []
            for s, e in zip([0, *cuts], [*cuts, len(ids)]):
                here = (int(ids[s]), int(parts[s]), int(part[s]))
                if here != key:
                    if key is not None:
                        out.append(made(key, state))
                    key, state = here, [np.zeros((rank, rank)), np.zeros(rank)]
                add(state, f[s:e], w[s:e], y[s:e])
            yield pd.DataFrame(out, columns=["id", "vec", "sums"])
        if key is not None:
            yield pd.DataFrame([made(key, state)], columns=["id", "vec", "sums"])

    return run


def _joined(rank: int, base: np.ndarray):
    """Adds up the parts of the ids that were dealt to several tasks, and solves them; rows sorted by id."""
    def run(batches):
        key, total = None, None
        for b in batches:
            out = []
            for id_, sums in zip(b["id"].tolist(), b["sums"]):
                if id_ != key:
                    if key is not None:
                        out.append((key, _solved(total, rank, base)))
                    key, total = id_, np.zeros(rank * rank + rank)
                total = total + np.asarray(sums)
            yield pd.DataFrame(out, columns=["id", "vec"])
        if key is not None:
            yield pd.DataFrame([(key, _solved(total, rank, base))], columns=["id", "vec"])

    return run


def _solved(total: np.ndarray, rank: int, base: np.ndarray) -> np.ndarray:
    return np.linalg.solve(total[:rank * rank].reshape(rank, rank) + base, total[rank * rank:])


def half_step(rows: DataFrame, other: DataFrame, rank: int, reg: float, background: float, hot: DataFrame | None = None,
              n: int | None = None) -> DataFrame:
    """(id, vec): the vectors of one side that minimise the objective while the other side's are held.

    rows: (id, other, w, y); other: (id, vec) of the other side; hot: (id, parts) of the ids to split."""
    n = n or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = background * gram(other, "vec", rank) + reg * np.eye(rank)
    met = rows.join(other.select(F.col("id").alias("other"), F.col("vec").alias("f")), "other")
    if hot is None:
        met = met.withColumn("parts", F.lit(1).cast("long")).withColumn("part", F.lit(0).cast("long"))
    else:
        met = met.join(hot, "id", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
        met = met.withColumn("part", F.pmod(F.xxhash64("other", "y", "w"), F.col("parts")))
    dealt = met.select("id", "parts", "part", "f", "w", "y").repartition(n, "id", "part").sortWithinPartitions("id", "part")
    made = dealt.mapInPandas(_sums(rank, base), "id long, vec array<double>, sums array<double>")
    if hot is None:
        return materialize(made.select("id", "vec"), "factors")
    made = materialize(made, "factor-parts")
    split = made.where(F.col("vec").isNull()).select("id", "sums").repartition(n, "id").sortWithinPartitions("id")
    return materialize(made.where(F.col("vec").isNotNull()).select("id", "vec").unionByName(
        split.mapInPandas(_joined(rank, base), "id long, vec array<double>")), "factors")


def _hot(rows: DataFrame, hot_rows: int) -> DataFrame | None:
    """(id, parts) of ids with more than hot_rows rows; None if there are none."""
    big = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    big = materialize(big.select("id", F.ceil(F.col("n") / hot_rows).cast("long").alias("parts")), "factor-hot")
    return None if big.isEmpty() else big


def fit_factors(train: DataFrame, rank: int = 16, reg: float = 0.1, max_iter: int = 10, background: float = 0.1,
                seed: int = 42, hot_rows: int = HOT_ROWS):
    """Fit (user_id, movie_id, weight, rating) rows; returns (model, user vectors (user_id, u), item vectors (movie_id, i)).

    Rows with a null in any of the four columns take no part; repeated pairs count as often as they stand there. The result depends on
    the rows and settings only, up to the order in which sums are added."""
    if rank < 1 or max_iter < 1 or reg <= 0 or background < 0:
        raise ValueError(f"rank and max_iter must be at least 1, reg above 0, background at least 0; got rank={rank}, max_iter={max_iter}, "
                         f"reg={reg}, background={background}")
    rows = train.select(F.col("user_id").cast("long").alias("user"), F.col("movie_id").cast("long").alias("item"),
                        F.col("weight").cast("double").alias("w"), (F.col("rating") / F.lit(RATING_SCALE)).cast("double").alias("y")).dropna()
    rows = materialize(rows, "factor-rows")
    by_user = rows.select(F.col("user").alias("id"), F.col("item").alias("other"), "w", "y")
    by_item = rows.select(F.col("item").alias("id"), F.col("user").alias("other"), "w", "y")
    hot_users, hot_items = _hot(by_user, hot_rows), _hot(by_item, hot_rows)
    items = materialize(by_item.select("id").distinct().withColumn("vec", start_vector(F.col("id"), rank, seed)), "factor-start")
    users = None
    for _ in range(max_iter):
        users = half_step(by_user, items, rank, reg, background, hot_users)
        items = half_step(by_item, users, rank, reg, background, hot_items)
    users = users.select(F.col("id").cast(train.schema["user_id"].dataType).alias("user_id"), F.col("vec").alias("u"))
    items = items.select(F.col("id").cast(train.schema["movie_id"].dataType).alias("movie_id"), F.col("vec").alias("i"))
    return FactorModel(users, items), users, items


def objective(train: DataFrame, users: DataFrame, items: DataFrame, reg: float = 0.1, background: float = 0.1) -> DataFrame:
    """One row: the three terms of the objective and their sum, of given vectors. The all-pairs term is the sum over the cells of
    U'U times V'V, so no pairs are made."""
    err = F.col("rating") / F.lit(RATING_SCALE) - V.dot("u", "i")
    fit = train.select("user_id", "movie_id", "weight", "rating").dropna().join(users, "user_id").join(items, "movie_id")
    fit = fit.agg(F.sum(F.col("weight") * err * err).alias("x")).first()["x"] or 0.0
    first = users.first()
    rank = len(first["u"]) if first is not None else 1
    gu, gi = gram(users, "u", rank), gram(items, "i", rank)
    pairs, size = background * float((gu * gi).sum()), reg * float(np.trace(gu) + np.trace(gi))
    row = (float(fit), pairs, size, float(fit) + pairs + size)
    return train.sparkSession.createDataFrame([row], "fit double, background double, size double, objective double")


def fit_margin(train: DataFrame, users: DataFrame, items: DataFrame) -> float:
    """How far the mean predicted preference of the rated pairs lies above that of all pairs, which is the dot product
    of the mean user and the mean item vector. A fit that learned nothing has a margin of about 0."""
    rated = (train.select("user_id", "movie_id").join(users, "user_id").join(items, "movie_id")
             .agg(F.avg(V.dot("u", "i")).alias("m")).first()["m"])

    def mean(df: DataFrame, col: str) -> list[float]:
        e = df.select(F.posexplode(col).alias("p", "x")).groupBy("p").agg(F.avg("x").alias("x"))
        return [r["x"] for r in e.orderBy("p").collect()]  # rank values

    return float(rated) - sum(a * b for a, b in zip(mean(users, "u"), mean(items, "i")))


def validation_loss(model: FactorModel, val: DataFrame, default: float = 0.0) -> DataFrame:
    """One row: val_loss, the weighted squared error of the predicted preference over every validation row, n_val, and
    n_unseen, the rows whose user or item the fit has not seen. Those are scored with ``default``."""
    pred = model.transform(val.select("user_id", "movie_id", "weight", "rating"))
    unseen = F.col("prediction").isNull() | F.isnan("prediction")
    err = F.when(unseen, F.lit(default)).otherwise(F.col("prediction")) - F.col("rating") / F.lit(RATING_SCALE)
    return pred.agg(F.avg(F.col("weight") * err * err).alias("val_loss"), F.count(F.lit(1)).alias("n_val"),
                    F.count_if(unseen).alias("n_unseen"))


def sweep_factors(train: DataFrame, val: DataFrame, grid: list[dict], seed: int = 42) -> DataFrame:
    """Fit once per setting on the written train split and score on the val split:
    (trial, params, val_loss, n_val, n_unseen, error). A failed trial carries the sentinel loss and its error.

    The grid is configuration-sized; each fit is a distributed job.
    """
    rows = []
    train, val = materialize(train, "sweep-train"), materialize(val, "sweep-val")
    for n, params in enumerate(grid):
        loss, n_val, n_unseen, error = FAILED_LOSS, None, None, None
        try:
            model, _, _ = fit_factors(train, seed=seed, **params)
            r = validation_loss(model, val).first()
            loss, n_val, n_unseen = (FAILED_LOSS if r["val_loss"] is None else float(r["val_loss"])), r["n_val"], r["n_unseen"]
        except Exception as e:  # noqa: BLE001 - a failed trial is recorded with its error, the sweep goes on
            error = f"{type(e).__name__}: {str(e).splitlines()[0][:500]}"
        rows.append((n, str(sorted(params.items())), loss, n_val, n_unseen, error))
    return train.sparkSession.createDataFrame(rows, "trial int, params string, val_loss double, n_val long, n_unseen long, error string")


def best_trial(trials: DataFrame, trial: str = "trial", loss: str = "val_loss") -> DataFrame:
    """The setting with the least loss (ties: the smaller trial key); failed/empty trials carry 9999."""
    best = F.min(F.struct(F.coalesce(F.col(loss), F.lit(FAILED_LOSS)).alias("l"), F.col(trial).alias("t")))
    return trials.agg(best.alias("b")).select(F.col("b.t").alias(trial), F.col("b.l").alias(loss))


def pending_combos(combos: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """Settings not tried yet."""
    return combos.join(cached.select(*keys).distinct(), keys, "left_anti")
