"""Document fingerprints by winnowing: rolling k-gram hashes, the minimum of every window, rightmost on ties, places kept.

A polynomial hash of every ``k`` code points is mixed to 32 bits; from every ``window`` consecutive hashes the smallest is
kept, the rightmost of equal ones, together with its place. Any passage of ``window + k - 1`` code points that two texts
share therefore leaves at least one common hash in both fingerprints. A text with fewer hashes than a window is one window;
a text shorter than k is one k-gram; an empty text has an empty fingerprint. Likeness is the Jaccard index of the hash sets,
1 for two empty ones.

``next_texts`` pairs every document with the one after it in descending id order (the first follows the last). The order is
(id, hash of the text), so the rows of one id, or of null ids, are cut like any others: a written sort of these two narrow
columns gives ranges and the first row of each; whole texts are dealt to the ranges and each range is sorted and streamed by
one task. The first row of every range also goes, as a guest, to the end of the range before. Equal rows (id and text) are
folded, batch by batch, to one with a count before they are shuffled, and their results are repeated afterwards. So whole
texts are shuffled once and no task holds more than two documents and a batch. Ids never pass through a nullable pandas column.

Edge cases: null texts are empty; null ids come last in the order; rows of one id stand in descending order of their text's hash; equal rows
follow each other (each is the next of the one before); a lone document is its own next; very long texts are
fingerprinted whole, in memory of about 40 bytes a code point; an empty table gives an empty table; extra columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import shuffle_partitions, text_of
from marquee.session import materialize, task_keys

K, WINDOW, REPEAT = 12, 32, 4096
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def kgram_hashes(text: str, k: int = K) -> np.ndarray:
    """32-bit hash of the k code points at every place, as uint64. Grams double in length until k is made up."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    if not len(codes):
        return codes
    k = min(k, len(codes))
    n = len(codes) - k + 1
    gram, length, out, done = codes, 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if k & length:
                out = gram[:n].copy() if out is None else out * np.uint64(pow(_BASE, length, 1 << 64)) + gram[done:done + n]
                done += length
            if length * 2 > k:
                break
            gram = gram[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + gram[length:]
            length *= 2
        out ^= out >> np.uint64(31)
        out *= _MIX
    return out >> np.uint64(32)


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the fingerprint, both uint32, in order of place."""
    h = kgram_hashes(text, k)
    if not len(h):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    low = np.uint64(0xFFFFFFFF)
    best = (h << np.uint64(32)) | (low - np.arange(len(h), dtype=np.uint64))  # least hash first, then the rightmost place
    need, have = min(window, len(h)), 1
    while have < need:
        step = min(have, need - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    best = best[np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))]
    return (best >> np.uint64(32)).astype(np.uint32), (low - (best & low)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two hash sets, given sorted without repeats."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(a) + len(b) - common)


def as_string(hashes: np.ndarray, places: np.ndarray) -> str:
    """Base64 of (hash, place) pairs, 32 bits each, little-endian."""
    return base64.b64encode(np.stack((hashes, places), axis=1).astype("<u4").tobytes()).decode()


def from_string(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(base64.b64decode(fingerprint), "<u4").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", k: int = K, window: int = WINDOW) -> DataFrame:
    """docs plus the fingerprint of every whole text."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([as_string(*winnow(t or "", k, window)) for t in texts], dtype=object)

    return docs.withColumn(out, run(F.col(text_col)))


class Ranges:
    """Ranges of the descending order (null ids last, then id, then hash of the text), from the first row of each."""

    def __init__(self, heads: list[tuple[bool, int, int]]):
        self.heads = sorted(heads, reverse=True)  # (has an id, id, hash)
        known = [h for h in self.heads if h[0]]
        # the rows with an id and the others, each in ascending order
        self.sides = [(np.array([h[1] for h in part][::-1], np.int64), np.array([h[2] for h in part][::-1], np.int64), first)
                      for part, first in ((known, 0), (self.heads[len(known):], len(known)))]

    def place(self, known: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(range of each row, whether it is the range's first row)."""
        at, head = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        for (h_ids, h_hashes, first), rows in zip(self.sides, (np.flatnonzero(known), np.flatnonzero(~known))):
            low = np.searchsorted(h_ids, ids[rows], side="left")
            high = end = np.searchsorted(h_ids, ids[rows], side="right")
            while (low < high).any():  # the first head of the id that is not below the row
                middle = (low + high) // 2
                below = h_hashes[np.minimum(middle, len(h_hashes) - 1)] < hashes[rows]
                low, high = np.where((low < high) & below, middle + 1, low), np.where((low < high) & ~below, middle, high)
            if len(h_ids):
                equal = (low < end) & (h_hashes[np.minimum(low, len(h_hashes) - 1)] == hashes[rows])
                head[rows] = equal
            at[rows] = first + len(h_ids) - low - 1
        return at, head


def _dealt(ranges: Ranges, keys: list[int]):
    """Rows with their range and its task, equal rows of a batch folded; first rows also as guests of the range before."""
    task = np.array([keys[r % len(keys)] for r in range(len(ranges.heads))], np.int32)

    def run(batches):
        for b in batches:
            known, ids, hashes = (b.column(c).to_numpy(zero_copy_only=False) for c in ("known", "id", "hash"))
            at, head = ranges.place(known, ids, hashes)
            order = np.lexsort((hashes, ids, known))
            first = np.ones(len(ids), bool)
            first[1:] = (np.diff(hashes[order]) != 0) | (np.diff(ids[order]) != 0) | (known[order][1:] != known[order][:-1])
            start = np.flatnonzero(first)
            copies, rows = np.diff(np.append(start, len(ids))), order[start]
            guest = np.flatnonzero(head[rows])
            take = pa.array(np.concatenate((rows, rows[guest])))
            where = np.concatenate((at[rows], (at[rows][guest] - 1) % len(ranges.heads))).astype(np.int32)
            kind = np.concatenate((np.zeros(len(rows), np.int32), np.ones(len(guest), np.int32)))
            part = b.take(take)
            counts = np.concatenate((copies, copies[guest])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(task[where]), pa.array(where), pa.array(kind), *part.columns, pa.array(counts)],
                                             ["task", "range", "guest", *part.schema.names, "copies"])
    return run


def next_texts(docs: DataFrame, visit, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Run visit(row, next_row) over every document and the next one in descending id order. Rows are (id, text, memo
    dict); visit returns the values of one result row, and what it leaves in a memo is still there when that
    document has become the row."""
    n = shuffle_partitions(docs.sparkSession)
    id_ = F.col(id_col).cast("long")
    rows = docs.select(id_.isNotNull().alias("known"), F.coalesce(id_, F.lit(0)).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("known", "id", F.xxhash64("text").alias("hash"), "text")
    down = [F.col(c).desc() for c in ("known", "id", "hash")]
    order = rows.select("known", "id", "hash").repartitionByRange(4 * n, *down)
    order = materialize(order.withColumn("part", F.spark_partition_id()), "winnow-order")
    # one row per range
    heads = order.groupBy("part").agg(F.max(F.struct("known", "id", "hash")).alias("h")).select("h.*").collect()
    ranges = Ranges([tuple(h) for h in heads])
    dealt = rows.mapInArrow(_dealt(ranges, task_keys(docs.sparkSession, n)),
                            "task int, range int, guest int, known boolean, id long, hash long, text string, copies long")
    dealt = dealt.repartition(n, "task").sortWithinPartitions("range", "guest", *down)
    names = [c.strip().split()[0] for c in schema.split(",")]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # [range, (known, id, hash), row, copies] still waiting for its next
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("range", "guest", "known", "id", "hash", "text", "copies"))
            for range_, guest, known, id_, hash_, text, copies in zip(*columns):
                key = (known, id_, hash_)
                if held is not None and held[0] == range_ and held[1] == key and not guest:
                    held[3] += copies
                    continue
                row = (id_ if known else None, text, {})
                if held is not None and held[0] == range_:
                    if held[3] > 1:
                        out.append((*visit(held[2], held[2]), held[3] - 1))
                    out.append((*visit(held[2], row), 1))
                held = None if guest else [range_, key, row, copies]
            # as objects: integers next to nulls would become floats
            yield pd.DataFrame(out, columns=[*names, "__copies"], dtype=object)

    found = dealt.select("range", "guest", "known", "id", "hash", "text", "copies").mapInPandas(stream, schema + ", __copies long")
    again = found.withColumn("__more", F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / REPEAT)))
    again = again.withColumn("__more", F.explode("__more"))
    left = F.least(F.lit(REPEAT), F.col("__copies") - F.col("__more") * REPEAT)
    return again.withColumn("__more", F.explode(F.sequence(F.lit(1).cast("long"), left))).select(*names)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the last third replaced by the beginning of the next
    document's text), and the likeness of its fingerprint to the edited one's and to the next document's."""
    def print_of(row) -> tuple:
        _, text, memo = row
        if "print" not in memo:
            h, p = winnow(text, k, window)
            memo["print"] = as_string(h, p), np.unique(h)
        return memo["print"]

    def visit(row, following) -> tuple:
        id_, text, _ = row
        third = len(text) // 3
        edited = text[:len(text) - third] + following[1][:third]
        own, own_set = print_of(row)
        h, p = winnow(edited, k, window)
        return (id_, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, as_string(h, p),
                likeness(own_set, np.unique(h)), likeness(own_set, print_of(following)[1]))

    return next_texts(docs, visit, f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double", id_col, text_col)
