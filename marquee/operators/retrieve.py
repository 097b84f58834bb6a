"""Scoring and exact top-k retrieval per (user, genre pool).

Exact top-k needs every (user, item) score, but never as rows. One plan at every size: users and items are dealt to shares
by a hash of their id, each user goes once to every share of items and each item once to every share of
users, and one task scores a (share of users, share of items) cell with Arrow-batched numpy. A task gets the items of its cell first and keeps
them (``SHARE_ITEMS`` at most); the users stream past them in Arrow batches, and their lists leave chunk by chunk. A cell emits one row per
(user, pool, method) holding its best k in two arrays; where there are several shares of items the arrays of a
user are merged by one aggregation. There are as many shares of users as the cores and the work ask for, not one per shuffle partition: every one is
another copy of the items. With u users and i items of d doubles the cells ship 8 d u i (1 / users + 1 / items of a share) bytes.

Inside a cell a chunk of users meets the items tile by tile; of a tile only scores that beat a user's kth so far are looked at.
``LOOK_USERS`` and ``LOOK_ITEMS`` bound chunk and tile. ``item_block`` cuts a tile in blocks: each gives a user a list of at most k, and the lists
of a tile's blocks merge at once; lists leave by ``user_block`` users. Both ship nothing, and small blocks cost no product of their own. The learned head is summed in 16-bit integers first: their error is
bounded, and whatever it leaves in doubt is scored in doubles.

Pools are genres (items can belong to several; an item carries its pools in an array); ``topk_global`` uses a single pool.
Order: best score first (larger for cosine/dot/learned, smaller for squared l2), then movie_id.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import vectors as V
from marquee.functions.vocab import GENRE_VOCAB, TOP_N
from marquee.operators.item_index import ItemIndex, load_item_index, open_item_index, save_item_index  # noqa: F401
from marquee.session import task_keys

EPS = 1e-8
ALL_POOL = "*"

LIST_SCHEMA = "user_id int, genre string, scoring_method string, movie_ids array<int>, scores array<double>"
LIST_COLUMNS = [c.split()[0] for c in LIST_SCHEMA.split(", ")]
LIST_ARROW = pa.schema([("user_id", pa.int32()), ("genre", pa.string()), ("scoring_method", pa.string()), ("movie_ids", pa.list_(pa.int32())),
                        ("scores", pa.list_(pa.float64()))])
#: Bytes of the lists that a cell puts out, and the items of a cell: what a task keeps.
OUT_BYTES, SHARE_ITEMS = 128 << 20, 327_680
#: Pairs of a cell: at least so many before there are as many cells as LEAST_CELLS or twice the cores, and at most so many.
FEW_PAIRS, LEAST_CELLS, MANY_PAIRS = 1 << 21, 32, 1 << 32
#: Users and items that are looked at together, and the items of a pool that are ranked whole at first.
LOOK_USERS, LOOK_ITEMS, FIRST_ITEMS = 1024, 4096, 64
#: Hidden units of the learned head that are summed in 16 bits, and the items of one such sum.
UNITS, SUM_ITEMS = 64, 128


# ---------------------------------------------------------------- expression form (explicit pairs)

def score_pairs(pairs: DataFrame, methods=("cosine", "dot", "l2"), u: str = "uv", i: str = "iv") -> DataFrame:
    """Add one score column per method to rows that already hold both vectors."""
    out = pairs
    for m in methods:
        out = out.withColumn(f"score_{m}", V.score(m, u, i))
    return out


def l2_normalize(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return V.with_normalized(df, col, out or col, EPS)


def genre_membership(itf: DataFrame) -> DataFrame:
    """(movie_id, genre) for every multi-hot slot > 0; items without genres yield nothing."""
    vocab = F.array(*[F.lit(g) for g in GENRE_VOCAB])
    return (itf.select("movie_id", F.posexplode("genre_multihot").alias("pos", "x"))
            .filter(F.col("x") > 0).select("movie_id", F.get(vocab, F.col("pos")).alias("genre")))


# Memory bound of the numpy kernel: at most this many float64 cells per score matrix (32 MB), so a task's
# peak stays small whatever the Arrow batch size or the item count.
CELL_BUDGET = 1 << 22


def learned_scores(U: np.ndarray, I: np.ndarray, head: dict, budget: int = CELL_BUDGET) -> np.ndarray:
    """concat(u, i) -> Linear -> ReLU -> Linear for every (u, i): concat(u, i) W1 = u W1u + i W1i, so each
    side is projected once; the (users x items x hidden) step runs in chunks of at most ``budget`` cells."""
    d = U.shape[1]
    w1u, w1i = head["w1"][:, :d], head["w1"][:, d:]
    iu = I @ w1i.T + head["b1"]            # (ni, h)
    uu = U @ w1u.T                          # (nu, h)
    w2 = head["w2"][0]
    # w relu(u + i) = max(w u, -w i) + w i, min for a negative w: one look at a small tile per hidden unit
    a, b = np.ascontiguousarray((uu * w2).T), np.ascontiguousarray((-iu * w2).T)
    out = np.tile(iu @ w2 + head["b2"][0], (U.shape[0], 1))
    ci = max(1, min(I.shape[0], 2048, budget))
    cu = max(1, min(16_384, budget) // ci)
    for s in range(0, U.shape[0], cu):
        for t in range(0, I.shape[0], ci):
            cells = out[s:s + cu, t:t + ci]
            total, one = np.zeros(cells.shape), np.empty(cells.shape)
            for h, w in enumerate(w2):
                (np.maximum if w >= 0 else np.minimum)(a[h, s:s + cu, None], b[h, None, t:t + ci], out=one)
                total += one
            cells += total
    return out


def score_learned_pairs(pairs: DataFrame, head: dict, key: str = "k", u: str = "uv", i: str = "iv") -> DataFrame:
    """Learned-head score of rows that hold both vectors: (key, score), Arrow batches through numpy."""
    key_type = pairs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            if len(b) == 0:
                continue
            U = np.stack([np.asarray(x, dtype=np.float64) for x in b[u]])
            I_ = np.stack([np.asarray(x, dtype=np.float64) for x in b[i]])
            h = np.maximum(np.concatenate([U, I_], axis=1) @ head["w1"].T + head["b1"], 0.0)
            yield pd.DataFrame({key: b[key], "score": h @ head["w2"][0] + head["b2"][0]})

    return pairs.select(key, u, i).mapInPandas(run, f"{key} {key_type}, score double")


# ---------------------------------------------------------------- numpy block kernel

def _best(key: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k least keys of each row, in order, ties by column; linear in the row length but for sorting k."""
    if key.shape[1] > k:
        edge = np.partition(key, k - 1, axis=1)[:, k - 1:k]
        below, level = key < edge, key == edge
        take = below | (level & (np.cumsum(level, axis=1) <= k - below.sum(axis=1, keepdims=True)))
        cols = np.nonzero(take)[1].reshape(len(key), k)
    else:
        cols = np.broadcast_to(np.arange(key.shape[1]), key.shape)
    order = np.argsort(np.take_along_axis(key, cols, 1), axis=1, kind="stable")
    return np.take_along_axis(cols, order, 1)


class _Best:
    """The k least keys so far of every user of a chunk, in order, ties by place; fed in the order of places. ``block`` places make a block, whose
    list of a user holds k at most."""

    def __init__(self, users: int, k: int, block: int = 1 << 62):
        self.k, self.seen, self.block = k, 0, block
        self.top, self.at = np.empty((users, 0)), np.empty((users, 0), np.int64)

    def look(self, places: np.ndarray, whole, below) -> None:
        """whole(a, b): keys (users x b - a) of the places a to b. below(a, b, edge): those of them that are less than the users' edge, as
        (places from a, users, keys) in the order of places."""
        t = 0
        while t < len(places):
            if self.top.shape[1] < self.k:
                end = min(len(places), t + max(FIRST_ITEMS, self.k), int(np.searchsorted(places, places[t] - places[t] % self.block + self.block)))
                new = whole(t, end)
                key = np.concatenate([self.top, new], axis=1)
                at = np.concatenate([self.at, np.broadcast_to(places[t:end], new.shape)], axis=1)
                cols = _best(key, self.k)
                self.top, self.at = np.take_along_axis(key, cols, 1), np.take_along_axis(at, cols, 1)
            else:  # the edge falls fast at first: blocks double
                end = min(len(places), t + max(self.seen, FIRST_ITEMS))
                self._merge(places[t:end], *below(t, end, self.top[:, -1]))
            self.seen += end - t
            t = end

    def _merge(self, places: np.ndarray, col: np.ndarray, row: np.ndarray, key: np.ndarray) -> None:
        if not len(row):
            return
        if places[0] // self.block < places[-1] // self.block:
            kept = self._lists(places // self.block - places[0] // self.block, col, row, key)
            col, row, key = col[kept], row[kept], key[kept]
        k, order = self.k, np.argsort(row, kind="stable")
        n = np.bincount(row, minlength=len(self.top))
        rows = np.nonzero(n)[0]
        n = n[rows]
        line, slot = np.repeat(np.arange(len(rows)), n), k + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        keys = np.full((len(rows), k + n.max()), np.inf)
        at = np.zeros(keys.shape, self.at.dtype)
        keys[:, :k], at[:, :k] = self.top[rows], self.at[rows]
        keys[line, slot], at[line, slot] = key[order], places[col[order]]
        order = np.argsort(keys, axis=1, kind="stable")[:, :k]
        self.top[rows], self.at[rows] = np.take_along_axis(keys, order, 1), np.take_along_axis(at, order, 1)

    def _lists(self, block: np.ndarray, col: np.ndarray, row: np.ndarray, key: np.ndarray):
        """Which entries are on the list of their block and user: the k least, ties by place."""
        each = row * (int(block[-1]) + 1) + block[col]
        full = (np.bincount(each) > self.k)[each]
        if not full.any():
            return slice(None)
        some = np.nonzero(full)[0]
        order = some[np.lexsort((key[some], each[some]))]
        starts = np.concatenate([[0], np.nonzero(np.diff(each[order]))[0] + 1])
        n = np.diff(np.append(starts, len(order)))
        full[order[np.arange(len(order)) - np.repeat(starts, n) < self.k]] = False
        return ~full

    def look_at(self, places: np.ndarray, key: np.ndarray) -> None:
        """key (places x users)."""
        def below(a, b, edge):
            hit = np.flatnonzero(key[a:b] < edge)
            col, row = np.divmod(hit, key.shape[1])
            return col, row, key[a:b].ravel()[hit]

        self.look(places, lambda a, b: key[a:b].T, below)


def _best_of(key: np.ndarray, pos: np.ndarray, k: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places in pos) of the k least keys of each row among the columns pos, in order, ties by place, looked at in blocks of ``most``."""
    best = _Best(len(key), k)
    for t in range(0, len(pos), most):
        best.look_at(np.arange(t, min(t + most, len(pos))), np.ascontiguousarray(np.take(key, pos[t:t + most], axis=1).T))
    return best.top, best.at


class _Head:
    """The learned head over a chunk of users: sums of 16-bit integers for all items of a tile, doubles for the few that matter."""

    def __init__(self, U: np.ndarray, head: dict, budget: int):
        d = U.shape[1]
        self.U, self.head, self.budget = U, head, budget
        self.w1i, self.w2, self.b1, self.b2 = head["w1"][:, d:], head["w2"][0], head["b1"], head["b2"][0]
        self.hu = U @ head["w1"][:, :d].T
        self.p = np.ascontiguousarray((self.hu * np.abs(self.w2)).T)  # |w| relu(u + i) = relu(|w| u + |w| i)

    def tile(self, I: np.ndarray) -> None:
        self.I, self.hi = I, I @ self.w1i.T + self.b1
        q = np.ascontiguousarray((self.hi * np.abs(self.w2)).T)
        self.step, self.sums = self._sums(q)

    def _sums(self, q: np.ndarray) -> tuple[float, np.ndarray | None]:
        """(step, sums): step x sums is off the score without b2 by a step per hidden unit at most; None where numbers are not finite.

        A unit's terms p and q are rounded to the step, half a step off each. Where p + q can't be positive they are lifted to the least value
        that keeps it so, which bounds them from below too. The units with w2 >= 0 of a group, or the others, fill 16 bits at most."""
        p, plus = self.p, self.w2 >= 0
        high_p, high_q = p.max(axis=1), q.max(axis=1)
        span = np.maximum(high_p + high_q, 0.0)
        units = [np.arange(g, min(g + UNITS, len(p))) for g in range(0, len(p), UNITS)]
        step = max(max(span[g][plus[g]].sum(), span[g][~plus[g]].sum()) for g in units) / 32_000
        if not np.isfinite(p).all() or not np.isfinite(q).all() or not np.isfinite(step):
            return 0.0, None
        step = step or 1.0
        P = np.rint(np.maximum(p, -high_q[:, None]) / step).clip(-32_700, 32_700).astype(np.int16)
        Q = np.rint(np.maximum(q, -high_p[:, None]) / step).clip(-32_700, 32_700).astype(np.int64)
        # relu(P + Q) = max(P, -Q) + Q; sums may run over and back, the last one fits
        N = (-Q).astype(np.int16)
        out = np.zeros((q.shape[1], p.shape[1]), np.int16 if len(units) == 1 else np.int32)
        term, part = np.empty((2, min(SUM_ITEMS, len(out)), out.shape[1]), np.int16)
        for g in units:
            used = g[span[g] > 0]  # the others are nothing everywhere
            base = (Q[used] * np.where(plus[used], 1, -1)[:, None]).sum(axis=0).astype(np.int16)[:, None]
            for t in range(0, len(out), SUM_ITEMS):
                n = min(SUM_ITEMS, len(out) - t)
                part[:n] = base[t:t + n]
                for h in used:
                    np.maximum(P[h], N[h, t:t + n, None], out=term[:n])
                    (np.add if plus[h] else np.subtract)(part[:n], term[:n], out=part[:n])
                out[t:t + n] += part[:n]
        return step, out

    def look(self, best: _Best, places: np.ndarray, at: np.ndarray) -> None:
        """The items of the tile at ``at``."""
        if self.sums is None:
            best.look_at(places, np.ascontiguousarray(-learned_scores(self.U, self.I[at], self.head, self.budget).T))
            return
        sums = self.sums if len(at) == len(self.sums) else self.sums.take(at, axis=0)

        def whole(a, b):
            return -learned_scores(self.U, self.I[at[a:b]], self.head, self.budget)

        def below(a, b, edge):
            least = np.floor((-edge - self.b2) / self.step - len(self.w2) - 2)
            info = np.iinfo(sums.dtype)
            hit = np.flatnonzero(sums[a:b] >= least.clip(info.min, info.max).astype(sums.dtype))
            col, row = np.divmod(hit, sums.shape[1])
            key = np.empty(len(hit))
            for s in range(0, len(hit), 16_384):
                c, r = col[s:s + 16_384], row[s:s + 16_384]
                key[s:s + 16_384] = -np.einsum("ij,j->i", np.maximum(self.hu[r] + self.hi[at[a + c]], 0.0), self.w2) - self.b2
            less = key < edge[row]
            return col[less], row[less], key[less]

        best.look(places, whole, below)


def _topk_chunks(user_ids, U, item_ids, I, pools, methods, k, head, budget: int = CELL_BUDGET, user_block: int = 65_536, item_block: int = 4096):
    """Exact top-k lists per (user, pool, method) of some users against some items, chunk by chunk:
    (user ids, pool, method, item ids, scores), the last two with a row per user.

    A chunk has at most LOOK_USERS users, a tile at most LOOK_ITEMS items, both at most budget pairs, so a task holds one tile of scores and the
    lists of one chunk, never (batch x items x methods). A tile is cut in blocks of item_block items, a chunk's lists leave by user_block users.
    pools: list of (pool name, positions into the item arrays, sorted by movie_id)."""
    if not len(user_ids) or not len(item_ids):
        return
    tile = max(1, min(LOOK_ITEMS, budget, len(item_ids)))
    tile -= tile % item_block if item_block < tile else 0  # whole blocks
    chunk = max(1, min(LOOK_USERS, budget // tile))
    need_dot = any(m in ("cosine", "dot", "l2") for m in methods)
    sq_i = np.einsum("ij,ij->i", I, I)[:, None]
    norm_i = np.maximum(np.sqrt(sq_i), EPS)
    for s in range(0, len(user_ids), chunk):
        Uc, ids = U[s:s + chunk], user_ids[s:s + chunk]
        best = {(pool, m): _Best(len(ids), k, item_block) for m in methods for pool, _ in pools}
        minus = np.ascontiguousarray(-Uc.T)
        scorer = _Head(Uc, head, budget) if "learned" in methods else None
        for t in range(0, len(item_ids), tile):
            It = I[t:t + tile]
            dots = It @ minus if need_dot else None  # (items x users), negated: least first
            if scorer is not None:
                scorer.tile(It)
            for pool, pos in pools:
                places = pos[np.searchsorted(pos, t):np.searchsorted(pos, t + len(It))]
                if not len(places):
                    continue
                some = dots if dots is None or len(places) == len(It) else dots.take(places - t, axis=0)
                # keys leave out what is the same for all items of a user; the scores of the chosen get it back
                for m in methods:
                    if m == "learned":
                        scorer.look(best[pool, m], places, places - t)
                    elif m == "dot":
                        best[pool, m].look_at(places, some)
                    elif m == "cosine":
                        best[pool, m].look_at(places, some / norm_i[places])
                    else:
                        key = 2.0 * some
                        key += sq_i[places]
                        best[pool, m].look_at(places, key)
        sq_u = np.einsum("ij,ij->i", Uc, Uc)[:, None]
        for m in methods:
            for pool, _ in pools:
                top, at = best[pool, m].top, best[pool, m].at
                scores = top + sq_u if m == "l2" else -top / np.maximum(np.sqrt(sq_u), EPS) if m == "cosine" else -top
                chosen = item_ids[at].astype(np.int32)
                for b in range(0, len(ids), user_block):
                    yield ids[b:b + user_block], pool, m, chosen[b:b + user_block], scores[b:b + user_block]


def _topk_block(user_ids, U, item_ids, I, pools, methods, k, head, budget: int = CELL_BUDGET) -> pd.DataFrame:
    """_topk_chunks as one pandas frame."""
    out: dict[str, list] = {c: [] for c in LIST_COLUMNS}
    for ids, pool, m, chosen, scores in _topk_chunks(user_ids, U, item_ids, I, pools, methods, k, head, budget):
        out["user_id"] += ids.tolist()
        out["genre"] += [pool] * len(ids)
        out["scoring_method"] += [m] * len(ids)
        out["movie_ids"] += list(chosen)
        out["scores"] += list(scores)
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in out.items()})


def _topk_table(*args, **kw) -> pa.Table:
    """_topk_chunks as Arrow lists over flat numbers: no object per list or value, some 12 bytes an entry."""
    batches = []
    for ids, pool, m, chosen, scores in _topk_chunks(*args, **kw):
        n, width = chosen.shape
        ends = pa.array(np.arange(0, n * width + 1, max(width, 1), dtype=np.int32) if width else np.zeros(n + 1, np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (chosen, scores)]
        batches.append(pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.repeat(pa.scalar(pool), n), pa.repeat(pa.scalar(m), n), *lists], schema=LIST_ARROW))
    return pa.Table.from_batches(batches, LIST_ARROW)


def _one_list_a_user(lists: pa.Table, k: int) -> pa.Table:
    """Lists of rows with one user id become one, as where lists of several blocks merge; all of an id's rows lie in one cell."""
    keys = pd.DataFrame({c: lists[c].to_numpy(zero_copy_only=False) for c in LIST_COLUMNS[:3]})
    again = keys.duplicated(keep=False).to_numpy()
    if not again.any():
        return lists
    frame = lists.filter(pa.array(again)).to_pandas()
    out: dict[str, list] = {c: [] for c in LIST_COLUMNS}
    for key, rows in frame.groupby(LIST_COLUMNS[:3], sort=False):
        items, scores = np.concatenate(rows["movie_ids"].to_numpy()), np.concatenate(rows["scores"].to_numpy())
        order = np.lexsort((items, scores if key[2] == "l2" else -scores))[:k]
        for c, v in zip(LIST_COLUMNS, (*key, items[order], scores[order])):
            out[c].append(v)
    return pa.concat_tables([lists.filter(pa.array(~again)), pa.table(out, LIST_ARROW)])


def _vectors(column) -> np.ndarray:
    """Matrix of an Arrow column of lists of one length."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


class _Items:
    """Items of a cell, gathered from batches: sorted by id, one row of each, their matrix, and the positions of each pool."""

    def __init__(self):
        self.ids, self.vectors, self.pools = [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        self.ids.append(batch["id"].to_numpy(zero_copy_only=False))
        self.vectors.append(_vectors(batch["v"]).copy())  # frees the batch
        names = batch["pools"]
        self.pools.append((names.flatten().dictionary_encode(), np.diff(names.offsets.to_numpy())))

    def block(self):
        if not self.ids:
            return np.zeros(0, np.int64), np.zeros((0, 0)), []
        ids, first, place = np.unique(np.concatenate(self.ids), return_index=True, return_inverse=True)
        kept = np.zeros(len(place), bool)
        kept[first] = True
        matrix = np.empty((len(ids), self.vectors[0].shape[1]))
        pools: dict[str, list[np.ndarray]] = {}
        s = 0
        for n, (names, counts) in enumerate(self.pools):
            some, to = kept[s:s + len(counts)], place[s:s + len(counts)]
            matrix[to[some]] = self.vectors[n][some]
            self.vectors[n] = None
            code, owner = names.indices.to_numpy(), np.repeat(np.where(some, to, -1), counts)
            for c, name in enumerate(names.dictionary.to_pylist()):
                pools.setdefault(name, []).append(owner[(code == c) & (owner >= 0)])
            s += len(counts)
        return ids, matrix, [(name, np.sort(np.concatenate(p))) for name, p in sorted(pools.items())]


def _cell_lists(batches, methods, k, head, user_block: int, item_block: int, merge: bool):
    """Lists of the cells of a task, from batches (cell, side, id, v, pools) sorted by the first three: a cell's items, side 0, come before its users."""
    cell = held = carry = None

    def out(lists: pa.Table):
        return lists.combine_chunks().to_batches()

    for batch in batches:
        cells, sides = batch["cell"].to_numpy(), batch["side"].to_numpy()
        cuts = np.nonzero((np.diff(cells) != 0) | (np.diff(sides) != 0))[0] + 1
        for s, e in zip([0, *cuts], [*cuts, len(cells)]):
            if s == e:
                continue
            if cells[s] != cell:
                if carry is not None:
                    yield from out(carry)
                cell, held, block, carry = cells[s], _Items(), None, None
            part = batch.slice(s, e - s)
            if sides[s] == 0:
                held.add(part)
                continue
            if block is None:
                block, held = held.block(), None
            ids, U = part["id"].to_numpy(), _vectors(part["v"])
            for n in range(0, len(ids), LOOK_USERS):
                lists = _topk_table(ids[n:n + LOOK_USERS], U[n:n + LOOK_USERS], *block, methods, k, head, user_block=user_block, item_block=item_block)
                if merge and len(lists):  # an id's rows may go on in the next chunk
                    lists = _one_list_a_user(lists if carry is None else pa.concat_tables([carry, lists]), k)
                    last = pa.array(lists["user_id"].to_numpy() == ids[n:n + LOOK_USERS][-1])
                    carry, lists = lists.filter(last), lists.filter(pc.invert(last))
                yield from out(lists)
    if carry is not None:
        yield from out(carry)


# ---------------------------------------------------------------- plan

def _pool_items(items: DataFrame, membership: DataFrame | None) -> DataFrame:
    """One row per item: (movie_id, pools, i); items in no pool are left out."""
    if membership is None:
        return items.select("movie_id", F.array(F.lit(ALL_POOL)).alias("pools"), "i")
    pools = membership.groupBy("movie_id").agg(F.collect_set("genre").alias("pools"))  # at most the vocabulary
    return items.select("movie_id", "i").join(pools, "movie_id").select("movie_id", "pools", "i")


def default_user_block(pools: int, methods: int, k: int) -> int:
    """Users of a cell whose lists fill OUT_BYTES, at most 65 536."""
    return max(1, min(65_536, OUT_BYTES // (12 * max(1, k) * max(1, pools) * max(1, methods))))


def cell_grid(users: int, items: int, user_block: int, share_items: int, cores: int) -> tuple[int, int]:
    """(shares of users, shares of items): every share of users is another copy of the items, so there are no more than keep the cores busy,
    hold the lists of user_block users and MANY_PAIRS pairs in a cell."""
    nib = max(1, math.ceil(items / share_items))
    pairs = users * math.ceil(items / nib)
    busy = min(max(LEAST_CELLS, 2 * cores), math.ceil(pairs / FEW_PAIRS))
    return max(1, min(users, max(busy, math.ceil(users / user_block), math.ceil(pairs / MANY_PAIRS)))), nib


def topk_lists(users: DataFrame, items: DataFrame, membership: DataFrame | None, methods=("cosine", "dot", "l2"),
               k: int = TOP_N, user_block: int = 65_536, item_block: int = 32_768, head: dict | None = None,
               share_items: int = SHARE_ITEMS) -> DataFrame:
    """Exact top-k per (user, pool, method): (user_id, genre, scoring_method, movie_ids, scores), best first.

    users: (user_id, u array<double>); items: (movie_id, i array<double>);
    membership: (movie_id, genre) or None for one global pool. A cell's lists take OUT_BYTES at most."""
    methods = list(methods)
    if "learned" in methods and head is None:
        raise ValueError("the learned method needs the weights of a trained head")
    pooled = _pool_items(items, membership)
    share = default_user_block(len(GENRE_VOCAB) if membership is not None else 1, len(methods), k)
    n_users, n_items = users.count(), items.count()
    spark = users.sparkSession
    nub, nib = cell_grid(n_users, n_items, share, share_items, spark.sparkContext.defaultParallelism)
    blocks = math.ceil(n_items / item_block)
    keys = F.array(*[F.lit(n) for n in task_keys(spark, nub * nib)])
    ub = F.pmod(F.xxhash64("user_id"), F.lit(nub)).cast("int")
    ib = F.pmod(F.xxhash64("movie_id"), F.lit(nib)).cast("int")
    u_rep = users.select("user_id", "u").withColumn("ub", ub).withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(nib - 1))))
    i_rep = pooled.withColumn("ib", ib).withColumn("ub", F.explode(F.sequence(F.lit(0), F.lit(nub - 1))))
    cell = F.get(keys, F.col("ub") * nib + F.col("ib")).alias("cell")
    rows = i_rep.select(cell, F.lit(0).alias("side"), F.col("movie_id").alias("id"), F.col("i").alias("v"), "pools").unionByName(
        u_rep.select(cell, F.lit(1).alias("side"), F.col("user_id").alias("id"), F.col("u").alias("v"), F.lit(None).cast("array<string>").alias("pools")))

    def run(batches):
        return _cell_lists(batches, methods, k, head, user_block, min(item_block, LOOK_ITEMS), blocks > 1)

    # a task per cell: its items first, so that the users need not be kept
    cand = rows.repartition(nub * nib, "cell").sortWithinPartitions("cell", "side", "id").mapInArrow(run, LIST_SCHEMA)
    return cand if nib == 1 else merge_lists(cand, k)


def merge_lists(cand: DataFrame, k: int) -> DataFrame:
    """The k best of the lists of each (user, pool, method): at most k entries per share of items."""
    keys = ["user_id", "genre", "scoring_method"]
    sign = F.when(F.col("scoring_method") == "l2", 1.0).otherwise(-1.0)
    entries = cand.select(*keys, F.transform(F.arrays_zip("movie_ids", "scores"), lambda z: F.struct(
        (z["scores"] * sign).alias("key"), z["movie_ids"].alias("movie_id"), z["scores"].alias("score"))).alias("e"))
    best = entries.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("e"))), 1, k).alias("e"))
    return best.select(*keys, F.transform("e", lambda x: x["movie_id"]).alias("movie_ids"), F.transform("e", lambda x: x["score"]).alias("scores"))


def topk_pools(users: DataFrame, items: DataFrame, membership: DataFrame | None, methods=("cosine", "dot", "l2"),
               k: int = TOP_N, **kw) -> DataFrame:
    """topk_lists in long form: (user_id, genre, scoring_method, rank, movie_id, score)."""
    lists = topk_lists(users, items, membership, methods, k, **kw)
    long = lists.select("user_id", "genre", "scoring_method", F.posexplode(F.arrays_zip("movie_ids", "scores")).alias("n", "z"))
    return long.select("user_id", "genre", "scoring_method", (F.col("n") + 1).alias("rank"), F.col("z.movie_ids").alias("movie_id"),
                       F.col("z.scores").alias("score"))


def topk_user_genre(users: DataFrame, items: DataFrame, membership: DataFrame,
                    methods=("cosine", "dot", "l2"), k: int = TOP_N, **kw) -> DataFrame:
    return topk_pools(users, items, membership, methods, k, **kw)


def topk_global(users: DataFrame, items: DataFrame, methods=("cosine", "dot", "l2"), k: int = 10, **kw) -> DataFrame:
    return topk_pools(users, items, None, methods, k, **kw).drop("genre")


def cold_start_genre(items: DataFrame, membership: DataFrame, methods=("cosine", "dot", "l2"),
                     k: int = TOP_N) -> DataFrame:
    """Per genre the k items with the largest vector norm; the same list under every method label."""
    scored = (items.select("movie_id", V.norm("i").alias("score"))
              .join(membership.select("movie_id", "genre").hint("merge"), "movie_id"))  # both sides grow: neither goes through the driver
    w = Window.partitionBy("genre").orderBy(F.desc("score"), F.asc("movie_id"))
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    labels = F.array(*[F.lit(m) for m in methods])
    return top.select("genre", F.explode(labels).alias("scoring_method"), "rank", "movie_id", "score")


def to_serving_rows(long: DataFrame, keys: list[str]) -> DataFrame:
    """Long top-k rows -> one row per key with parallel movie_ids[] and scores[] in rank order."""
    packed = F.array_sort(F.collect_list(F.struct("rank", "movie_id", "score")))
    return (long.groupBy(*keys).agg(packed.alias("_r"))
            .select(*keys, F.transform("_r", lambda x: x["movie_id"]).alias("movie_ids"),
                    F.transform("_r", lambda x: x["score"]).alias("scores")))


def precompute_serving(users: DataFrame, items: DataFrame, membership: DataFrame, model_name: str,
                       methods=("cosine", "dot", "l2"), k: int = TOP_N, head: dict | None = None, **kw):
    """(top_n_user_genre rows, cold_start_genre rows) for one model; 'learned' only with a head."""
    ms = [m for m in methods if m != "learned"] + (["learned"] if head is not None else [])
    personal = topk_lists(users, items, membership, ms, k, head=head, **kw)
    cold = cold_start_genre(items, membership, ms, k)
    top = personal.withColumn("model_name", F.lit(model_name))
    cs = to_serving_rows(cold, ["genre", "scoring_method"]).withColumn("model_name", F.lit(model_name))
    return top, cs


def precompute_counts(top: DataFrame, cold: DataFrame) -> DataFrame:
    a = top.groupBy("model_name").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit("top_n_user_genre"))
    b = cold.groupBy("model_name").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit("cold_start_genre"))
    return a.unionByName(b)


def search_item_index(index: DataFrame | ItemIndex, queries: DataFrame, method: str, k: int = TOP_N, **kw) -> DataFrame:
    """Exact search of a loaded index: (user_id, rank, movie_id, score). Cosine indexes hold unit vectors, so the dot
    product with the unit query is the cosine. An opened index (open_item_index) reads only the cells it needs; the rows of
    a loaded one are all compared."""
    if isinstance(index, ItemIndex):
        return index.search(queries, k)
    if method == "cosine":
        queries = V.with_normalized(queries.select("user_id", "u"), "u", "u", EPS)
    found = topk_global(queries, index, ("dot" if method == "cosine" else method,), k, **kw)
    return found.drop("scoring_method")
