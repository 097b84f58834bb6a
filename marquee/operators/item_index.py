"""A persisted item index that prunes: exact top-k from the cells of an index in the order of their bounds.

Saving deals the items of a model to cells around centres (fitted on a deterministic sample of at most ``SAMPLE`` items a cell) and
writes a folder per cell, or per run of neighbouring cells where there are more than ``FOLDERS`` (the methods that store the same vectors share them), and, per scoring method, one table of the cells: centre, radius,
number of items. No item of a cell can score better than a bound from these three: q.c + |q| r for dot products (and for cosine, whose vectors are stored
normalised), and max(|q - c| - r, 0) squared for distances.

A search first looks into each query's best cells, until they hold k items, which gives every query a kth score that its answer
cannot fall below. Then it opens only cells whose bound still reaches some query's kth score, and each query meets those cells
alone. The answer is exact, ties going to the smaller id, whatever the clustering is like; that only decides how many files are read.

The table of cells is at most ``MAX_CELLS`` rows and goes through the driver and to the tasks. Cells lie in groups of up to ``GROUP_ROWS``
items (parts of a group, where one cell is larger); a query goes to a group once, with its kth score and the numbers of its best cells there, never with
all the cells it needs: those follow from the bounds again. A task keeps the items of its group, the queries stream past them, and there are as many
copies of a group as the cores ask for. Cells that few of a chunk of queries need meet those alone; the others meet the chunk in one product of
32-bit numbers, whose error is bounded; whatever it leaves in doubt is scored in doubles. A search opens a cell's files once. Saving a model
writes a new version; the cells' table commits it.

Edge cases: null or empty vectors are not indexed and null query vectors find nothing; several rows of one id are indexed as they are; fewer than k
items give fewer rows; an index without items gives none.
"""
from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions import vectors as V
from marquee.operators.buckets import beside, latest_version, next_batch, version_path
from marquee.session import materialize, task_keys

EPS = 1e-8
CELL_ROWS, MAX_CELLS, SAMPLE, PARTS = 4096, 8192, 8, 32
GROUP_ROWS, FILE_ROWS, YIELD_ROWS, FOLDERS = 131_072, 65_536, 4096, 512
#: Queries and items that are looked at together, pairs that are scored and held together, and the queries of a chunk, as a share, from which all meet a cell.
TOGETHER, TILE, PAIRS, MOST = 1024, 1024, 1 << 18, 0.25
#: Pairs of a task: at least so many before there are as many tasks as LEAST_TASKS or twice the cores, and at most so many; the pairs that a query is worth.
FEW_PAIRS, LEAST_TASKS, MANY_PAIRS, QUERY_PAIRS = 1 << 24, 32, 1 << 34, 2048
CELLS = "scoring_method string, cell int, n long, centre array<double>, radius double, folder string, held int"
FOUND = "query long, user_id int, movie_id int, score double"
FOUND_ARROW = pa.schema([("query", pa.int64()), ("user_id", pa.int32()), ("movie_id", pa.int32()), ("score", pa.float64())])


def _base(path: str, model_name: str) -> str:
    return f"{path.rstrip('/')}/{hashlib.md5(model_name.encode()).hexdigest()}"


def _nearest(centres: np.ndarray):
    """Adds to each row the number of its nearest centre and how far it is."""
    half = (centres * centres).sum(axis=1) / 2

    def run(batches):
        for b in batches:
            if len(b):
                m = np.stack(b["i"].to_numpy())
                cell = np.concatenate([(half - m[s:s + 1024] @ centres.T).argmin(axis=1) for s in range(0, len(m), 1024)])
                off = m - centres[cell]
                yield b.assign(cell=cell.astype(np.int32), far=np.sqrt(np.einsum("ij,ij->i", off, off)))
    return run


def _far_apart(sample: np.ndarray, want: int) -> np.ndarray:
    """Places of at most ``want`` points: the one farthest from all chosen so far, again and again."""
    far, chosen = np.full(len(sample), np.inf), []
    at, square = 0, (sample * sample).sum(axis=1)
    for _ in range(min(want, len(sample))):
        chosen.append(at)
        far = np.minimum(far, square + square[at] - 2 * (sample @ sample[at]))
        at = int(far.argmax())
        if far[at] <= 1e-12 * square[at]:
            break
    return np.array(chosen, np.int64)


def _own(sample: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([(half - sample[s:s + 1024] @ centres.T).argmin(axis=1) for s in range(0, len(sample), 1024)])


def _means(sample: np.ndarray, centres: np.ndarray, rounds: int) -> np.ndarray:
    for _ in range(rounds):
        own = _own(sample, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, sample[:, d], len(centres)) for d in range(sample.shape[1])], axis=1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def centres_of(sample: np.ndarray, want: int, rounds: int = 3, depth: int = 4) -> np.ndarray:
    """Centres of a sample in random order: its first points part it, every part is parted again by its share, the last ones by points far apart, and a
    few rounds of means follow each step. No point meets many centres, and centres of one part follow each other."""
    want = min(want, len(sample))
    if want <= PARTS or not depth:
        return _means(sample, sample[_far_apart(sample, want)].copy(), rounds)
    coarse = _means(sample, sample[:PARTS].copy(), rounds)
    own = _own(sample, coarse)
    parts = [sample[own == c] for c in range(len(coarse))]
    return np.concatenate([centres_of(p, max(1, want * len(p) // len(sample)), rounds, depth - 1) for p in parts if len(p)])[:MAX_CELLS]


def _cells(items: DataFrame, cell_rows: int) -> tuple[DataFrame, np.ndarray]:
    """items (movie_id, i) with the number of their cell and their distance from its centre, and the centres."""
    n = items.count()
    want = max(1, min(MAX_CELLS, n // cell_rows))
    # at most SAMPLE * MAX_CELLS rows: those with the least hashes; of many rows only some are sorted
    by, share = F.xxhash64("movie_id", "i"), 1.5 * SAMPLE * want / max(1, n)
    few = items.where(by < int(-2 ** 63 + share * 2 ** 64)) if share < 0.5 else items
    some = few.orderBy(by, "movie_id").limit(SAMPLE * want).select("i").toArrow()["i"]
    if not len(some) and n:
        some = items.orderBy(by, "movie_id").limit(SAMPLE * want).select("i").toArrow()["i"]
    centres = centres_of(_matrix(some.combine_chunks()), want) if len(some) else np.zeros((1, 1))
    schema = f"movie_id {items.schema['movie_id'].dataType.simpleString()}, i array<double>, cell int, far double"
    return items.mapInPandas(_nearest(centres), schema), centres


def save_item_index(items: DataFrame, model_name: str, methods, path: str, cell_rows: int = CELL_ROWS) -> None:
    """Index the items (movie_id, i) of a model for each scoring method, as a new version that replaces the model's former one."""
    spark = items.sparkSession
    base = _base(path, model_name)
    version = next_batch(spark, base)
    out = version_path(base, version)
    rows = items.where(F.size("i") > 0).select("movie_id", F.transform("i", lambda x: x.cast("double")).alias("i"))
    kinds = {}
    if set(methods) - {"cosine"}:
        kinds["vectors"] = rows, [m for m in methods if m != "cosine"]
    if "cosine" in methods:
        kinds["cosine"] = V.with_normalized(rows, "i", "n", EPS).select("movie_id", F.col("n").alias("i")), ["cosine"]
    cells = None
    for folder, (vectors, own_methods) in kinds.items():
        dealt, centres = _cells(materialize(vectors, "index-vectors"), cell_rows)  # normalised once
        own = materialize(dealt, "index-cells")
        run = -(-len(centres) // FOLDERS)
        own = own.withColumnsRenamed({"cell": "own"}).withColumn("cell", (F.floor(F.col("own") / run) * run).cast("int"))
        files = materialize(own.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / FILE_ROWS).alias("files")), "index-files")  # at most FOLDERS rows
        # a small file takes most of its time to open and commit, so their number, not their bytes, tells how many tasks write them
        tasks = min(4 * spark.sparkContext.defaultParallelism, files.agg(F.sum("files")).first()[0] or 1)
        dealt = own.join(F.broadcast(files), "cell").repartition(tasks, "cell", F.pmod(F.xxhash64("movie_id"), F.col("files")))
        dealt.select("movie_id", "i", "own", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{out}/{folder}")
        far = own.groupBy("own", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()  # at most MAX_CELLS rows
        rows_of = [(m, r["own"], r["n"], centres[r["own"]].tolist(), r["radius"], folder, r["cell"]) for m in own_methods for r in far]
        part = spark.createDataFrame(rows_of, CELLS)
        cells = part if cells is None else cells.unionByName(part)
    cells.coalesce(1).write.mode("overwrite").parquet(version_path(beside(base, "manifest"), version))


def _matrix(column) -> np.ndarray:
    """Matrix of an Arrow column of lists of one length."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


@dataclass
class ItemIndex:
    """An opened index of one model and method. ``opened`` and ``probed`` hold the cells that the last search read."""

    spark: SparkSession
    folder: str
    method: str
    cell: np.ndarray
    n: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    id_type: str = "int"
    held: np.ndarray | None = None  # the number in the name of each cell's folder
    probed: list[int] = field(default_factory=list)
    opened: list[int] = field(default_factory=list)

    def rows(self, cells: list[int] | None = None) -> DataFrame:
        """(movie_id, i, cell) of all cells or of some; only their folders are read."""
        wanted = np.ones(len(self.cell), bool) if cells is None else np.isin(self.cell, cells)
        if not wanted.any():
            return self.spark.createDataFrame([], f"movie_id {self.id_type}, i array<double>, cell int")
        held = self.cell if self.held is None else self.held
        folders = np.unique(held[wanted])
        read = self.spark.read.schema(f"movie_id {self.id_type}, i array<double>, own int, cell int").option("basePath", self.folder)
        rows = read.parquet(*[f"{self.folder}/cell={c}" for c in folders]).select("movie_id", "i", F.coalesce("own", "cell").alias("cell"))
        others = self.cell[np.isin(held, folders) & ~wanted]  # that lie in the same folders
        return rows.where(~F.col("cell").isin(others.tolist())) if len(others) else rows

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(query, cell): a key that no item of the cell falls below; the least key is the best score."""
        slack = 1e-9
        if self.method == "l2":
            far = np.sqrt(np.maximum((q * q).sum(1)[:, None] + (self.centre * self.centre).sum(1) - 2 * q @ self.centre.T, 0))
            near = np.maximum(far * (1 - slack) - self.radius * (1 + slack) - 1e-7, 0)
            return near * near
        best = q @ self.centre.T + np.sqrt((q * q).sum(1))[:, None] * self.radius
        return -(best + slack * np.abs(best) + 1e-9)

    def search(self, queries: DataFrame, k: int = 20) -> DataFrame:
        """(user_id, rank, movie_id, score): the k best items for every query (user_id, u), exactly."""
        q = queries.where(F.size("u") > 0).select("user_id", F.transform("u", lambda x: x.cast("double")).alias("u"))
        if self.method == "cosine":
            q = V.with_normalized(q, "u", "u", EPS)
        q = materialize(q.withColumn("query", F.xxhash64("user_id", "u")).dropDuplicates(["query"]), "index-queries")
        if not len(self.cell):
            return self.spark.createDataFrame([], "user_id int, rank int, movie_id int, score double")
        width = len(self.centre[0])
        if not q.where(F.size("u") != width).isEmpty():
            raise ValueError(f"queries must have {width} components, as the index has")
        first = materialize(q.withColumn("kth", F.lit(float("inf"))).mapInPandas(self._wanted(k, True), self._WANTED), "index-probe")
        self.probed = sorted(r["cell"] for r in first.select(F.explode("fresh").alias("cell")).distinct().collect())  # at most MAX_CELLS
        held = materialize(self.rows(self.probed), "index-held")
        probe = materialize(self._top(self._meet(first, held, k, True), k), "index-probed")
        kth = probe.where(F.col("rank") == k).select("query", F.col("key").alias("kth"))
        open_ = q.join(kth, "query", "left").withColumn("kth", F.coalesce("kth", F.lit(float("inf"))))
        more = materialize(open_.select("query", "user_id", "u", "kth").mapInPandas(self._wanted(k, False), self._WANTED), "index-wanted")
        self.opened = sorted(r["cell"] for r in more.select(F.explode("fresh").alias("cell")).distinct().collect())
        new = sorted(set(self.opened) - set(self.probed))
        rest = held.unionByName(self.rows(new)) if new else held
        found = probe.select("query", "user_id", "movie_id", "score")
        if self.opened:
            found = self._meet(more, rest, k, False).unionByName(found)
        return self._top(found, k).select("user_id", F.col("rank").cast("int").alias("rank"), "movie_id", "score")

    #: ``cells``: of the group, the query's best ones; ``fresh``: the wanted cells that no row before of the task wanted.
    _WANTED = "query long, user_id int, u array<double>, kth double, grp int, parts int, cells array<int>, fresh array<int>"

    def _groups(self) -> tuple[np.ndarray, np.ndarray]:
        """(group, parts of it) of every cell: cells in their order, up to GROUP_ROWS items together."""
        groups, held = [], 0
        for n in self.n.tolist():
            new = not groups or held + n > GROUP_ROWS
            held = n if new else held + n
            groups.append((groups[-1] if groups else -1) + new)
        group = np.array(groups, np.int32)
        parts = np.maximum(1, -(-np.bincount(group, self.n).astype(np.int64) // GROUP_ROWS)).astype(np.int32)
        return group, parts[group]

    def _shared(self):
        return self.spark.sparkContext.broadcast((self.cell, self.n, self.centre, self.radius, *self._groups()))  # at most MAX_CELLS rows

    def _wanted(self, k: int, probe: bool):
        """Queries with their best cells, which hold k items, a row per group of cells: the groups of those, or the groups of all others that reach the
        kth key."""
        shared = self._shared()
        method, folder = self.method, self.folder

        def run(batches):
            cell, n, centre, radius, group, parts = shared.value
            index = ItemIndex(None, folder, method, cell, n, centre, radius)
            unseen = np.ones(len(cell), bool)
            for b in batches:
                for s in range(0, len(b), 512):
                    part = b.iloc[s:s + 512]
                    keys = index.bounds(np.stack(part["u"].to_numpy()))
                    # a cell holds an item at least, so k cells hold k items
                    order = np.sort(np.argpartition(keys, min(k, keys.shape[1]) - 1, axis=1)[:, :k], axis=1)
                    order = np.take_along_axis(order, np.argsort(np.take_along_axis(keys, order, 1), axis=1, kind="stable"), 1)
                    held = np.cumsum(n[order], axis=1) - n[order]  # items in better cells
                    best = np.zeros(keys.shape, bool)
                    np.put_along_axis(best, order, held < k, axis=1)
                    pick = best if probe else ~best & (keys <= part["kth"].to_numpy()[:, None])
                    new = pick.any(axis=0) & unseen
                    unseen &= ~new
                    starts = np.searchsorted(group, np.arange(group[-1] + 1))  # a group's cells follow each other
                    row, grp = np.nonzero(np.logical_or.reduceat(pick, starts, axis=1))
                    if not len(row):
                        continue
                    own, at = np.nonzero(best)
                    of = own * (int(group[-1]) + 1) + group[at]  # sorted
                    first, last = (np.searchsorted(of, row * (int(group[-1]) + 1) + grp, side=x) for x in ("left", "right"))
                    cells, none = cell[at].astype(np.int32), np.zeros(0, np.int32)
                    for t in range(0, len(row), YIELD_ROWS):
                        to = slice(t, t + YIELD_ROWS)
                        own, fresh = part.iloc[row[to]], [none] * len(row[to])
                        if t == 0:
                            fresh[0] = cell[new].astype(np.int32)
                        yield pd.DataFrame({"query": own["query"].to_numpy(), "user_id": own["user_id"].to_numpy(), "u": own["u"].to_numpy(),
                                            "kth": own["kth"].to_numpy(), "grp": grp[to].astype(np.int32), "parts": parts[starts[grp[to]]],
                                            "cells": [cells[x:y] for x, y in zip(first[to], last[to])], "fresh": fresh})
        return run

    def _meet(self, wanted: DataFrame, items: DataFrame, k: int, probe: bool) -> DataFrame:
        """The k best items of every wanted (query, group of cells) in the query's best cells there, or in the others that reach its kth key."""
        group, parts = self._groups()
        asked = {r["grp"]: r["count"] for r in wanted.groupBy("grp").count().collect()}  # a row a group
        if not asked:
            return self.spark.createDataFrame([], FOUND)
        size = np.bincount(group, self.n).astype(np.int64)
        some = min(k, len(self.n)) * int(self.n.mean() + 1)  # items of the best cells
        pairs = {g: n * (QUERY_PAIRS + min(int(size[g]), some if probe else int(size[g]))) for g, n in asked.items()}
        target = min(MANY_PAIRS, max(FEW_PAIRS, sum(pairs.values()) / max(LEAST_TASKS, 2 * self.spark.sparkContext.defaultParallelism)))
        parts_of = np.ones(len(size), np.int64)
        parts_of[group] = parts
        plan, tasks = [], 0
        for g, n in sorted(asked.items()):
            blocks = max(1, min(n, math.ceil(pairs[g] / int(parts_of[g]) / target)))
            plan.append((g, blocks, tasks))
            tasks += blocks * int(parts_of[g])
        keys = F.array(*[F.lit(x) for x in task_keys(self.spark, tasks)])
        dealt = pd.DataFrame(plan, columns=["grp", "blocks", "start"]).astype(np.int32)
        of = pd.DataFrame({"cell": self.cell.astype(np.int32), "grp": group, "parts": parts}).merge(dealt, on="grp")
        to = F.broadcast(self.spark.createDataFrame(dealt, "grp int, blocks int, start int"))  # at most MAX_CELLS rows
        of_cell = F.broadcast(self.spark.createDataFrame(of, "cell int, grp int, parts int, blocks int, start int"))
        task = F.get(keys, F.col("start") + F.col("block") * F.col("parts") + F.col("part")).alias("task")
        left = wanted.join(to, "grp").withColumn("block", F.pmod(F.col("query"), F.col("blocks")).cast("int"))
        left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        right = items.join(of_cell, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        right = right.withColumn("part", F.pmod(F.xxhash64("movie_id", "i"), F.col("parts")).cast("int"))
        none = lambda t: F.lit(None).cast(t)
        near = F.coalesce(F.get("cells", F.lit(0)), F.lit(0))  # queries of one region follow each other
        rows = right.select(task, F.lit(0).alias("side"), F.col("cell").alias("near"), "grp", "movie_id", none("int").alias("user_id"), none("long").alias("query"),
                            none("double").alias("kth"), F.col("i").alias("v"), none("array<int>").alias("cells")).unionByName(
            left.select(task, F.lit(1).alias("side"), near.alias("near"), "grp", none(self.id_type).alias("movie_id"), "user_id", "query", "kth",
                        F.col("u").alias("v"), "cells"))
        # a task per group, block and part: its items first, so that the queries need not be kept
        return rows.repartition(tasks, "task").sortWithinPartitions("task", "side", "near").mapInArrow(_stream(self._shared(), self.method, self.folder, k, probe), FOUND)

    def _top(self, found: DataFrame, k: int) -> DataFrame:
        key = F.col("score") if self.method == "l2" else -F.col("score")
        w = Window.partitionBy("query").orderBy("key", "movie_id")
        return found.withColumn("key", key).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class _Hits:
    """The k best items so far of each of some queries, from candidates that are scored in doubles."""

    def __init__(self, U: np.ndarray, edge: np.ndarray, I: np.ndarray, order: np.ndarray, method: str, k: int):
        self.U, self.edge, self.I, self.order, self.method, self.k = U, edge.copy(), I, order, method, k
        self.row, self.at, self.key = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, row: np.ndarray, at: np.ndarray, most: int) -> bool:
        """Whether ``most`` candidates waited, which are merged then."""
        self.pending.append((row, at))
        self.waiting += len(row)
        full = self.waiting >= most
        if full:
            self.merge()
        return full

    def merge(self) -> None:
        if not self.waiting:
            return
        row, at = (np.concatenate(x) for x in zip(*self.pending))
        self.pending, self.waiting, key = [], 0, np.empty(len(row))
        for s in range(0, len(row), 16_384):
            u, i = self.U[row[s:s + 16_384]], self.I[at[s:s + 16_384]]
            if self.method == "l2":
                u = i = u - i
            key[s:s + 16_384] = np.einsum("ij,ij->i", u, i)
        if self.method != "l2":
            key = -key
        kept = ~(key > self.edge[row])
        row, at, key = (np.concatenate([x, y[kept]]) for x, y in ((self.row, row), (self.at, at), (self.key, key)))
        order = np.lexsort((self.order[at], key, row))
        row = row[order]
        n = np.bincount(row, minlength=len(self.U))
        rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        kept = rank < self.k
        self.row, self.at, self.key = row[kept], at[order][kept], key[order][kept]
        last = rank[kept] == self.k - 1
        self.edge[self.row[last]] = np.fmin(self.edge[self.row[last]], self.key[last])


def _look(hits: _Hits, wants: np.ndarray, starts: np.ndarray, cell: np.ndarray, probe: bool) -> None:
    """Candidates of the wanted (cell, query), from the cells' items: cell c has the items starts[c] to starts[c + 1]."""
    U, I, method, k = hits.U, hits.I, hits.method, hits.k
    norm_u, norm_i = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (U, I))
    half = norm_i * norm_i / 2 if method == "l2" else np.zeros(len(I))
    most = float(norm_i.max())
    sound = 1e-12 < most < 1e12 and bool((norm_u < 1e12).all())  # 32 bits bear it
    kind, unit = (np.float32, 2.0 ** -23) if sound else (np.float64, 2.0 ** -52)
    # a sum of d products is off by d + 1 half units of the norms' product at most
    slack = (U.shape[1] + 8) * unit * (norm_u * most + half.max()) + 1e-36 * (1 + most)

    def least() -> np.ndarray:
        """What u.i - |i|^2 / 2 or u.i must reach."""
        edge = (norm_u * norm_u - hits.edge) / 2 if method == "l2" else -hits.edge
        return edge - slack - 1e-12 * np.abs(np.where(np.isfinite(edge), edge, 0))

    asked = wants.sum(axis=1)
    many, limit = (asked >= max(1, MOST * len(U))) & (not probe), least()
    for c in np.nonzero((asked > 0) & ~many)[0]:
        rows = np.nonzero(wants[c])[0]
        for s in range(starts[c], starts[c + 1], TILE):
            e = min(s + TILE, starts[c + 1])
            score = U[rows] @ I[s:e].T - half[s:e]
            if e - s > 2 * k and limit[rows].min() == -np.inf:  # k items reach the kth score of these
                limit[rows] = np.fmax(limit[rows], np.partition(score, e - s - k, axis=1)[:, e - s - k] - 2 * slack[rows])
            row, at = np.nonzero(~(score < limit[rows, None]))
            if hits.add(rows[row], s + at, PAIRS):
                limit = np.fmax(limit, least())
    hits.merge()
    whole = np.nonzero(many[cell])[0]
    if not len(whole):
        return
    V_, together = np.ascontiguousarray(U.T.astype(kind)), min(PAIRS, 2 * k * len(U))

    def down(x):
        with np.errstate(over="ignore"):
            return np.nextafter(x.astype(kind), kind(-np.inf))

    limit = down(least())
    for t in range(0, len(whole), TILE):
        own = whole[t:t + TILE]
        score = I[own].astype(kind) @ V_
        if method == "l2":
            score -= half[own, None].astype(kind)
        hit = np.flatnonzero(~(score < limit))
        if len(hit) > together and len(own) > 2 * k:  # k items reach the kth score of these
            limit = np.fmax(limit, down(np.partition(score, len(own) - k, axis=0)[len(own) - k].astype(np.float64) - 2 * slack))
            hit = np.flatnonzero(~(score < limit))
        at, row = np.divmod(hit, len(U))
        at = own[at]
        asked = wants[cell[at], row]
        if hits.add(row[asked], at[asked], together):
            limit = np.fmax(limit, down(least()))
    hits.merge()


def _stream(shared, method: str, folder: str, k: int, probe: bool):
    """Found rows of the tasks of a partition, from batches sorted by task and side: a task's items, side 0, come before its queries."""
    def run(batches):
        cell, n, centre, radius, group, _ = shared.value
        task = held = items = None
        for batch in batches:
            tasks, sides = batch["task"].to_numpy(), batch["side"].to_numpy()
            cuts = np.nonzero((np.diff(tasks) != 0) | (np.diff(sides) != 0))[0] + 1
            for s, e in zip([0, *cuts], [*cuts, len(tasks)]):
                if s == e:
                    continue
                if tasks[s] != task:
                    task, held, items = tasks[s], [], None
                part = batch.slice(s, e - s)
                if sides[s] == 0:
                    held.append((part["movie_id"], _matrix(part["v"]).copy(), part["near"].to_numpy().copy()))
                    continue
                if items is None:
                    items = _held(held, cell[group == part["grp"][0].as_py()])
                    of = np.isin(cell, items[4])
                    own = ItemIndex(None, folder, method, cell[of], n[of], centre[of], radius[of])
                    held = None
                if not len(items[0]):
                    continue
                for t in range(0, len(part), TOGETHER):
                    yield from _found(part.slice(t, TOGETHER), own, items, k, probe)
    return run


def _held(held: list, cells: np.ndarray):
    """(ids, their order, matrix, place of the cell, cells, starts) of a task's items, sorted by cell."""
    if not held:
        return pa.array([], pa.int32()), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int64), cells[:0], np.zeros(1, np.int64)
    ids = pa.concat_arrays([h[0] for h in held])
    matrix = np.concatenate([h[1] for h in held])
    names, cell = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
    order = ids.fill_null(np.iinfo(ids.type.to_pandas_dtype()).min).to_numpy()
    return ids, order, matrix, cell, names, np.searchsorted(cell, np.arange(len(names) + 1))


def _found(part: pa.RecordBatch, own: ItemIndex, items, k: int, probe: bool):
    ids, order, matrix, cell, names, starts = items
    U, kth = _matrix(part["v"]), part["kth"].to_numpy()
    best = np.zeros((len(names), len(U)), bool)
    lists = part["cells"]
    line, want = np.repeat(np.arange(len(U)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
    place = np.minimum(np.searchsorted(names, want), len(names) - 1)
    here = names[place] == want
    best[place[here], line[here]] = True
    wants = best if probe else ~best & np.concatenate([own.bounds(U[s:s + 256]) <= kth[s:s + 256, None] for s in range(0, len(U), 256)]).T
    hits = _Hits(U, kth, matrix, order, own.method, k)
    _look(hits, wants, starts, cell, probe)
    if len(hits.row):
        to = pa.array(hits.row)
        yield pa.RecordBatch.from_arrays([part["query"].take(to), part["user_id"].take(to), ids.take(pa.array(hits.at)).cast(pa.int32()),
                                          pa.array(hits.key if own.method == "l2" else -hits.key)], schema=FOUND_ARROW)


def open_item_index(spark: SparkSession, path: str, model_name: str, method: str) -> ItemIndex:
    """The newest version of a model's index for a scoring method."""
    base = _base(path, model_name)
    commit = latest_version(spark, beside(base, "manifest"))
    if commit is None:
        raise FileNotFoundError(f"no index of {model_name!r} under {path}")
    rows = spark.read.schema(CELLS).parquet(commit).where(F.col("scoring_method") == method).orderBy("cell").collect()  # at most MAX_CELLS
    # indexes of before have a folder per method and cell
    folder = f"{version_path(base, int(commit.rsplit('v=', 1)[1]))}/{rows[0]['folder'] or method if rows else method}"
    held = np.array([r["cell"] if r["held"] is None else r["held"] for r in rows], np.int64)
    id_type = spark.read.parquet(f"{folder}/cell={held[0]}").schema["movie_id"].dataType.simpleString() if rows else "int"
    return ItemIndex(spark, folder, method, np.array([r["cell"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64),
                     np.array([r["centre"] for r in rows], np.float64), np.array([r["radius"] for r in rows], np.float64), id_type, held)


def load_item_index(spark: SparkSession, path: str, model_name: str, method: str) -> DataFrame:
    """All vectors of an index: (movie_id, i)."""
    return open_item_index(spark, path, model_name, method).rows().select("movie_id", "i")
