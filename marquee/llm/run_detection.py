"""Periodic runs of words: suffix-tree longest common extensions and Lyndon-root candidates.

A run is a stretch of words with smallest period q, at least ``max(least_words, powers * q)`` long, that no neighbouring word extends
with that period. By the runs theorem every run holds a Lyndon root, in one of the two orders of the words, that is the longest Lyndon
word starting where it starts; so each place gives one candidate per order. The candidate's period is extended to the right
by the longest common extension of two suffixes and to the left by that of two prefixes:

* Ukkonen's algorithm gives the suffix tree of the words and that of their reversal;
* an Euler tour of each tree, folded to its leaves, with a sparse table answers lowest common ancestors, and with the string depth of the
  ancestor the extension, in constant time (all candidates at once);
* the longest Lyndon words are the next smaller (or, in the inverted order, next larger) suffixes by the tour's leaf order.

Before that, words that lie in no run of the wanted power are left out, which loses none: every five words in a row of such a run come again
inside it, so a stretch is kept only while each of its words is in five that repeat within the stretch (by hash; a collision
keeps words, it drops none). Stretches of many documents share one pair of trees, parted by words that occur once.

One Arrow pass over the texts, no shuffle. Trees are built over at least ``TREE_WORDS`` words, or one longer stretch.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; words are split at ASCII white space only; equal rows
give equal results; ties need no rule here (runs come by start, then period, which are distinct); a text of any length is searched whole, with
memory in proportion to it (about 1 kB a word of its longest repeating stretch); an empty table gives an empty table; columns
named like a result are left out of ``keep`` by default.
"""
from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import quoted

TREE_WORDS, BATCH_BYTES, GRAM, ROUNDS = 1 << 15, 4 << 20, 5, 8
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


class SuffixTree:
    """Ukkonen's tree of integers whose last one occurs once. Nodes are numbered; 0 is the root."""

    def __init__(self, s: list[int], symbols: int):
        n = len(s)
        start, end, link = array("i", [0]), array("i", [0]), array("i", [0])
        place = array("i", [0])  # of a leaf: where its suffix starts; of an inner node: minus its string depth
        child: dict[int, int] = {}  # node * symbols + first symbol of the edge
        node, edge, length, left = 0, 0, 0, 0
        for i, c in enumerate(s):
            left += 1
            fresh = 0
            while left:
                if not length:
                    edge = i
                key = node * symbols + s[edge]
                at = child.get(key)
                if at is None:
                    child[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    place.append(i - left + 1)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    first = start[at]
                    span = min(end[at], i + 1) - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = at
                        continue
                    if s[first + length] == c:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    split = len(start)
                    child[key] = split
                    start.append(first)
                    end.append(first + length)
                    link.append(0)
                    place.append(1 - left)
                    start[at] = first + length
                    child[split * symbols + s[first + length]] = at
                    child[split * symbols + c] = split + 1
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    place.append(i - left + 1)
                    if fresh:
                        link[fresh] = split
                    fresh = split
                left -= 1
                if node == 0 and length:
                    length -= 1
                    edge = i - left + 1
                else:
                    node = link[node]
        self.n, self.symbols = n, symbols
        self.keys = np.fromiter(child.keys(), np.int64, len(child))
        self.kids = np.fromiter(child.values(), np.int64, len(child))
        self.leaf = np.frombuffer(end, np.int32) == n
        self.leaf[0] = False
        self.place = np.frombuffer(place, np.int32).astype(np.int64)

    def extensions(self) -> Extensions:
        """The Euler tour with children in order of their symbols, folded to the leaves."""
        order = np.argsort(self.keys, kind="stable")
        parent, kids = self.keys[order] // self.symbols, self.kids[order]
        nodes = len(self.place)
        up = np.zeros(nodes, np.int64)
        up[kids] = parent
        first = np.searchsorted(parent, np.arange(nodes + 1)).tolist()
        listed, is_leaf, tour, stack = kids.tolist(), self.leaf.tolist(), [], [0]
        while stack:
            v = stack.pop()
            tour.append(v)
            if not is_leaf[v]:
                stack += listed[first[v]:first[v + 1]][::-1]
        tour = np.array(tour)
        depth = np.where(self.leaf, self.n - self.place, -self.place)
        depth[0] = 0
        over = depth[up[tour]]  # string depth of the parent of each node of the tour
        leaves = np.flatnonzero(self.leaf[tour])
        # lowest ancestor of neighbouring leaves: the least depth over all nodes entered between them
        lcp = np.minimum.reduceat(over, leaves[:-1] + 1) if len(leaves) > 1 else np.empty(0, np.int64)
        return Extensions(self.place[tour[leaves]], lcp)


class Extensions:
    """Longest common extensions of suffixes from their order and the depth of neighbours' ancestors."""

    def __init__(self, suffixes: np.ndarray, lcp: np.ndarray):
        self.n = len(suffixes)
        self.rank = np.empty(self.n, np.int64)
        self.rank[suffixes] = np.arange(self.n)
        self.table = [lcp.astype(np.int32)]
        width = 1
        while 2 * width <= len(lcp):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length from places a and b (a != b, both inside)."""
        ra, rb = self.rank[a], self.rank[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            t = self.table[k]
            out[at] = np.minimum(t[low[at]], t[high[at] - (1 << int(k))])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """For every place the next one to the right with a smaller value, or the length."""
    n = len(rank)
    out, stack = [n] * n, []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def all_runs(words: np.ndarray, least_words: int = 6, powers: int = 4) -> np.ndarray:
    """(start, length, period) of every run of a sequence of integers from 0 on, by start, then period."""
    n = len(words)
    if n < max(least_words, 2):
        return np.empty((0, 3), np.int64)
    symbols = int(words.max()) + 2
    s = words.tolist()
    forward = SuffixTree([*s, symbols - 1], symbols).extensions()
    found = []
    suffix_rank = forward.rank
    # in the inverted order the ranks are reversed: the last symbol occurs once, so no suffix begins another
    for rank in (suffix_rank, n - suffix_rank):
        after = np.array(next_smaller(rank.tolist())[:n])
        at = np.flatnonzero((after < n) & ((after - np.arange(n)) * powers <= n))
        found.append(np.stack((at, after[at]), axis=1))
    pairs = np.concatenate(found)
    if not len(pairs):
        return np.empty((0, 3), np.int64)
    i, j = pairs[:, 0], pairs[:, 1]
    right = forward.lce(i, j)
    del forward
    backward = SuffixTree([*reversed(s), symbols - 1], symbols).extensions()
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = backward.lce(n - i[inner], n - j[inner])  # place p stands at n - 1 - p of the reversal
    period, start = j - i, i - left
    length = period + right + left
    ok = (length >= powers * period) & (length >= least_words)
    rows = np.stack((start, length, period), axis=1)[ok]
    return np.unique(rows[np.lexsort((rows[:, 2], rows[:, 0]))], axis=0) if len(rows) else rows


_ODD = np.uint64(0x9E3779B97F4A7C15)


def stretches(words: np.ndarray, part: np.ndarray, least_words: int = 6, powers: int = 4) -> list[tuple[int, int]]:
    """(first, end) of the stretches that may hold a run; part numbers the document of each word, in order."""
    n = len(words)
    if powers < 4 or least_words < GRAM + 1:  # below that, five words in a row need not come again
        cut = np.flatnonzero(np.diff(part)) + 1
        return list(zip([0, *cut.tolist()], [*cut.tolist(), n])) if n else []
    at = np.arange(n)  # places of the words still in question
    group = part.astype(np.int64)  # of each of them, its document, later its stretch
    before = None
    for _ in range(ROUNDS):
        if len(at) < least_words:
            return []
        m = len(at) - GRAM + 1
        w = words[at].astype(np.uint64) + np.uint64(1)
        h = group[:m].astype(np.uint64)
        with np.errstate(over="ignore"):
            for k in range(GRAM):
                h = (h ^ (h >> np.uint64(29))) * _ODD + w[k:k + m]
        gram = np.flatnonzero(group[:m] == group[GRAM - 1:])
        h = h[gram]
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        again = np.zeros(len(h), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        gram = gram[again]
        covered = np.cumsum(np.bincount(gram, minlength=len(at)) - np.bincount(gram + GRAM, minlength=len(at))[:len(at)]) > 0
        at, group = at[covered], group[covered]
        if not len(at):
            return []
        number = np.cumsum(np.concatenate(([True], (np.diff(at) > 1) | (np.diff(group) != 0)))) - 1
        long = np.bincount(number)[number] >= least_words
        at, group = at[long], number[long]
        state = len(at), len(np.unique(group))
        if state == before:
            break
        before = state
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
    last = np.concatenate((first[1:], [len(at)])) - 1
    return list(zip(at[first].tolist(), (at[last] + 1).tolist()))


def _search(words: np.ndarray, spans: list[tuple[int, int]], least_words: int, powers: int) -> np.ndarray:
    """Runs inside the spans, found in one pair of trees."""
    size = sum(b - a for a, b in spans) + len(spans)
    joined, place = np.empty(size, np.int64), np.empty(size, np.int64)
    at = 0
    for k, (a, b) in enumerate(spans):
        joined[at:at + b - a] = words[a:b]
        place[at:at + b - a] = np.arange(a, b)
        joined[at + b - a] = -1 - k  # parts the spans; occurs once
        place[at + b - a] = -1
        at += b - a + 1
    joined = np.unique(joined[:-1], return_inverse=True)[1]
    runs = all_runs(joined, least_words, powers)
    runs[:, 0] = place[runs[:, 0]]
    return runs


def runs_of(words: np.ndarray, part: np.ndarray, least_words: int = 6, powers: int = 4) -> np.ndarray:
    """Runs of many documents laid end to end, by start, then period; places count from the first word of all."""
    out, held, size = [], [], 0
    spans = stretches(words, part, least_words, powers)
    for k, (a, b) in enumerate(spans):
        held.append((a, b))
        size += b - a
        if size >= TREE_WORDS or k == len(spans) - 1:
            out.append(_search(words, held, least_words, powers))
            held, size = [], 0
    return np.concatenate(out) if out else np.empty((0, 3), np.int64)


def analyse(texts: list[str | None], least_words: int = 6, powers: int = 4) -> Iterator[tuple[np.ndarray, bytes]]:
    """(runs, collapsed text in UTF-8) of every text."""
    split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    number = defaultdict(count().__next__)
    sizes = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(sizes)
    words = np.fromiter((number[w] for doc in split for w in doc), np.int64, int(sizes.sum()))
    part = np.repeat(np.arange(len(split)), sizes)
    runs = runs_of(words, part, least_words, powers)
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    cut = np.searchsorted(owner, np.arange(len(split) + 1))
    for d, doc in enumerate(split):
        mine = runs[cut[d]:cut[d + 1]].copy()
        if len(mine):
            mine[:, 0] -= ends[d] - sizes[d]
            edges = np.zeros(len(doc) + 1, np.int64)
            np.add.at(edges, mine[:, 0] + mine[:, 2], 1)
            np.add.at(edges, mine[:, 0] + mine[:, 1], -1)
            doc = [doc[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
        yield mine, b" ".join(doc)


def portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in lists of some megabytes."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_runs(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] | None = None, runs: str = "runs",
              collapsed: str | None = "collapsed", least_words: int = 6, powers: int = 4) -> DataFrame:
    """The columns named in ``keep`` (default: all but those named like a result), the runs as array<struct<start, length, period>> and,
    unless collapsed is None, the words outside of what runs repeat, joined by one space."""
    keep = tuple(c for c in docs.columns if c not in (runs, collapsed)) if keep is None else tuple(keep)
    # by number on the way in: mapInArrow looks names up unquoted
    rows = docs.select(*[F.col(quoted(c)).alias(f"__{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("__text"))
    kept = [T.StructField(c, f.dataType) for c, f in zip(keep, rows.schema.fields)]
    schema = T.StructType([*kept, T.StructField(runs, T.ArrayType(RUN))])
    if collapsed:
        schema.add(collapsed, T.StringType())
    names = [f.name for f in RUN.fields]

    def run(batches):
        for b in batches:
            texts, at = b.column(len(keep)), 0
            for part in portions(texts.to_pylist()):
                made = list(analyse(part, least_words, powers))
                flat = np.concatenate([r for r, _ in made])
                ends = np.cumsum([0] + [len(r) for r, _ in made], dtype=np.int32)
                found = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], names)
                out = [c.slice(at, len(part)) for c in b.columns[:-1]] + [pa.ListArray.from_arrays(pa.array(ends), found)]
                if collapsed:
                    out.append(pa.array([c for _, c in made], pa.binary()).cast(pa.string()))
                at += len(part)
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(run, schema)
