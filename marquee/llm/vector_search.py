"""Exact top-k by integer inner product: ball-tree branch and bound per shard, the kth score shared between shards.

Vectors become floor(256 x). Equal rows (id and vector) are folded to one with a count, and the rows are dealt by a hash of both to
shards of bounded size, so neither an id nor a vector that a third of the rows share is one task's work. Every shard's ball tree (two
far pivots, median split) is built once and written as one row. The upper bound of a node is q . centre + |q| radius; leaves are visited in
descending bound until the bound is below the query's kth score (a bound equal to it is passed over only if every id in the leaf is
larger).

Two passes share the kth score: the probe visits the most promising leaf of every shard, the best k over all shards give each
query a score that its answer cannot fall below, and the search starts every shard with that score. In a pass each shard is one task: its
tree comes first and the queries are streamed past it, so vectors are sent once a pass, however many queries there are, and a
task holds one tree and a batch of queries. Candidates of all shards are merged by a window whose per-task limit keeps k rows of a
query before the shuffle.

Every row of ``queries`` is a query of its own; its candidates are all rows of ``vectors`` but one that equals it (the query's own row).

Edge cases: a vector that is null or holds a null or non-finite component takes no part, nor does a null id; vectors of different
lengths never meet; equal scores go to the smaller id; rows that share an id are rows like others: each is a query and a candidate, also
of the others; repeated query rows give their result as often; fewer than k candidates give fewer rows; an empty table gives an empty
result; extra columns are ignored. Scores are exact below 2**53. There are no texts; a vector of any length is one row.
"""
from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.session import materialize, task_keys

LEAF, CHUNK, SHARD_ROWS, LEAST_SHARD, REPEAT = 256, 512, 32_768, 4_096, 4096
FOUND = "query long, vec_id long, score long, times long"


def quantised(vec: Column) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vec.isNotNull() & F.coalesce(finite, F.lit(False))


class BallTree:
    """Nodes over rows sorted by id inside each leaf. Children of a node are kids[node], leaves have -1."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, keys: np.ndarray | None = None, times: np.ndarray | None = None):
        """keys tell the rows apart (default: their ids); times: how many equal rows each stands for (default: one)."""
        self.centre, self.radius, self.least, self.kids, self.leaf = [], [], [], [], []
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order].astype(np.float64)
        self.keys = self.ids if keys is None else keys[order]
        self.times = np.ones(len(ids), np.int64) if times is None else times[order]
        self._grow(np.arange(len(ids)))
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.least = np.array(self.least)

    def _grow(self, at: np.ndarray) -> int:
        x, node = self.rows[at], len(self.kids)
        centre = x.mean(axis=0)
        far = np.sqrt(((x - centre) ** 2).sum(axis=1))
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.least.append(int(self.ids[at[0]]))
        self.kids.append((-1, -1))
        self.leaf.append(at)
        if len(at) > LEAF:
            a = x[int(far.argmax())]
            b = x[int(((x - a) ** 2).sum(axis=1).argmax())]
            half = np.argsort(x @ (b - a), kind="stable")[:len(at) // 2]
            left = np.zeros(len(at), bool)
            left[half] = True
            self.kids[node] = self._grow(at[left]), self._grow(at[~left])
            self.leaf[node] = None
        return node

    def bound(self, q: np.ndarray, norm: np.ndarray, node: int) -> np.ndarray:
        """Largest integer score possible in the node, for each query."""
        b = q @ self.centre[node] + norm * self.radius[node]
        return np.floor(b + 1e-9 * np.abs(b) + 1e-6 * (1 + norm))


def search(tree: BallTree, q_keys: np.ndarray, q: np.ndarray, k: int, kth: np.ndarray, kth_id: np.ndarray,
           probe: bool) -> tuple[np.ndarray, ...]:
    """(query row, id, score, times) candidates; of the row with the query's own key one is left out.
    kth, kth_id: score and id that a result must not rank behind."""
    n = len(q)
    norm = np.sqrt((q * q).sum(axis=1))
    best = np.full((n, k), -np.inf)
    best_id = np.full((n, k), np.iinfo(np.int64).max)
    best_times = np.zeros((n, k), np.int64)
    kth, kth_id = kth.copy(), kth_id.copy()
    leaves, bounds = [], []
    stack = [(0, np.arange(n))]
    while stack:  # whole subtrees fall to the shared score here
        node, active = stack.pop()
        bound = tree.bound(q[active], norm[active], node)
        go = (bound > kth[active]) | ((bound == kth[active]) & (tree.least[node] <= kth_id[active]))
        active, bound = active[go], bound[go]
        if not len(active):
            continue
        if tree.leaf[node] is None:
            stack += [(child, active) for child in tree.kids[node]]
        else:
            column = np.full(n, -np.inf)
            column[active] = bound
            leaves.append(node)
            bounds.append(column)
    if not leaves:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    bounds, leaves = np.stack(bounds, axis=1), np.array(leaves)
    order = np.argsort(-bounds, axis=1, kind="stable")
    for step in range(1 if probe else len(leaves)):
        pick = order[:, step]
        bound = bounds[np.arange(n), pick]
        if not (bound > -np.inf).any() or not (bound >= kth).any():
            break
        go = (bound > kth) | ((bound == kth) & (tree.least[leaves[pick]] <= kth_id))
        go &= bound > -np.inf
        for leaf in np.unique(pick[go]):
            rows = np.flatnonzero(go & (pick == leaf))
            at = tree.leaf[leaves[leaf]]
            score = q[rows] @ tree.rows[at].T
            own = q_keys[rows][:, None] == tree.keys[at][None, :]
            times = tree.times[at][None, :] - own
            score[times < 1] = -np.inf
            hit = (score >= kth[rows][:, None]) & (score > -np.inf)
            hit = hit.any(axis=1)
            rows, score, times = rows[hit], score[hit], times[hit]
            if not len(rows):
                continue
            s = np.concatenate((best[rows], score), axis=1)
            i = np.concatenate((best_id[rows], np.broadcast_to(tree.ids[at], score.shape)), axis=1)
            top = np.lexsort((i, -s), axis=1)[:, :k]
            t = np.concatenate((best_times[rows], times), axis=1)
            best[rows], best_id[rows], best_times[rows] = (np.take_along_axis(x, top, 1) for x in (s, i, t))
            last, last_id = best[rows, k - 1], best_id[rows, k - 1]
            better = (last > kth[rows]) | ((last == kth[rows]) & (last_id < kth_id[rows]))
            kth[rows[better]], kth_id[rows[better]] = last[better], last_id[better]
    row, col = np.nonzero(best > -np.inf)
    return row, best_id[row, col], best[row, col].astype(np.int64), best_times[row, col]


def _planted(group: pd.DataFrame) -> pd.DataFrame:
    """The written tree of one shard's vectors of one length."""
    tree = BallTree(group["id"].to_numpy(np.int64), np.stack(group["vec"].to_numpy()), group["key"].to_numpy(np.int64), group["times"].to_numpy(np.int64))
    small = np.abs(tree.rows).max(initial=0) < 2**31
    tree.rows = tree.rows.astype(np.int32 if small else np.int64)
    return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "dim": [int(group["dim"].iloc[0])], "tree": [pickle.dumps(tree, 5)]})


def _searched(k: int, probe: bool):
    """Rows sorted by (shard, dim, kind): a tree, then the queries that are streamed past it."""
    def run(batches):
        here, tree = None, None
        for b in batches:
            out = []
            where = list(zip(b["shard"].tolist(), b["dim"].tolist(), b["kind"].tolist()))
            cuts = [i for i in range(1, len(where)) if where[i] != where[i - 1]]
            for s, e in zip([0, *cuts], [*cuts, len(where)]):
                shard, dim, kind = where[s]
                if kind == 0:
                    here, tree = (shard, dim), pickle.loads(b["tree"].iloc[s])
                    tree.rows = tree.rows.astype(np.float64)
                elif here == (shard, dim):
                    for i in range(s, e, CHUNK):
                        part = b.iloc[i:min(e, i + CHUNK)]
                        queries = part["query"].to_numpy(np.int64)
                        row, found, score, times = search(tree, queries, np.stack(part["vec"].to_numpy()).astype(np.float64), k,
                                                          part["kth"].to_numpy(float), part["kth_id"].to_numpy(np.int64), probe)
                        out.append(pd.DataFrame({"query": queries[row], "vec_id": found, "score": score, "times": times}))
            if out:
                yield pd.concat(out)
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query; a candidate that stands for several equal rows counts as often."""
    w = W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k).cast("long")))))
    w = W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "copy")
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                shard_rows: int = SHARD_ROWS, shards: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of vectors for each row of queries, its own row excepted."""
    spark = vectors.sparkSession

    def folded(df: DataFrame, name: str) -> DataFrame:
        """Distinct rows with their number and a key."""
        ok = df.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull())
        ok = ok.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col)).alias("vec"))
        ok = ok.groupBy("id", "vec").agg(F.count(F.lit(1)).alias("times"))
        return materialize(ok.withColumn("dim", F.size("vec")).withColumn("key", F.xxhash64("id", "vec")), name)

    rows, asked = folded(vectors, "search-rows"), folded(queries, "search-queries")
    n = rows.count()
    shards = shards or max(1, -(-n // shard_rows), min(2 * spark.sparkContext.defaultParallelism, n // LEAST_SHARD))
    keys = F.array(*[F.lit(x) for x in task_keys(spark, shards)])
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    trees = dealt.groupBy("shard", "dim").applyInPandas(_planted, "shard int, dim int, tree binary")
    trees = materialize(trees, "search-trees")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    none = {"tree": F.lit(None).cast("binary"), "query": F.lit(0).cast("long"), "vec": F.lit(None).cast("array<long>"), "kth": F.lit(0.0),
            "kth_id": F.lit(0).cast("long")}

    def passed(primed: DataFrame, probe: bool) -> DataFrame:
        ask = primed.select(every.alias("shard"), "dim", F.lit(1).alias("kind"), none["tree"].alias("tree"), F.col("key").alias("query"), "vec", "kth", "kth_id")
        tree = trees.select("shard", "dim", F.lit(0).alias("kind"), "tree", *[none[c].alias(c) for c in ("query", "vec", "kth", "kth_id")])
        both = tree.unionByName(ask).withColumn("task", F.get(keys, F.col("shard"))).repartition(shards, "task")
        return both.sortWithinPartitions("shard", "dim", "kind").drop("task").mapInPandas(_searched(k, probe), FOUND)

    start = asked.withColumn("kth", F.lit(float("-inf"))).withColumn("kth_id", F.lit(2**63 - 1))
    probed = materialize(_top(passed(start, True), k), "search-probe")
    shared = probed.where(F.col("rank") == k).select(F.col("query").alias("key"), F.col("score").cast("double").alias("kth"), F.col("vec_id").alias("kth_id"))
    primed = asked.join(shared, "key", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    primed = primed.withColumn("kth_id", F.coalesce("kth_id", F.lit(2**63 - 1)))
    found = _top(passed(primed, False), k).join(asked.select(F.col("key").alias("query"), F.col("id").alias("query_id"), F.col("times").alias("asked")), "query")
    # a row that is asked several times has its result as often, in two steps of numbers
    found = found.withColumn("many", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("asked") - 1) / REPEAT))))
    left = F.least(F.lit(REPEAT).cast("long"), F.col("asked") - F.col("many") * REPEAT)
    found = found.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
