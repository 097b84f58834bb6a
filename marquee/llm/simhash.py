"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints. A text's A-Z are lower-cased; its words are runs other than ASCII white space; XXH64 (UTF-8, seed 42) of every
``shingle`` words joined by a space (repeats included; a shorter text is one shingle) votes for each bit, which is 1 if set in
over half the hashes. A text without words has fingerprint zero.

Links. The 64 bits are cut in segments of 23, 23 and 18. The perfect Golay code (23, 12, 7) gives a segment the indices of the
codewords to which it and its 23 neighbours at one bit decode, one to six of them; two segments at most two bits apart share
an index, because a word half way between is a neighbour of both. With at most four differing bits (a, b, c in the segments) one
of these holds, and each gives keys: one segment equal and another at most two apart (equal bits and a Golay index: a + b + c <= 4 leaves some
pair (0, <= 2)), or all three differ, so by one, one and at most two bits: then one half of each of the first two is equal
and the third shares an index. A key thus fixes 30 bits or more. Fingerprints of one key are verified by bit count; what fails is dropped.

Plan: equal fingerprints are collapsed first, so copies never meet in a join. Keys are repartitioned and sorted, and each
task streams runs of equal keys; short runs are compared by shifted copies of the batch, long ones block by block with a
union-find that emits a spanning forest, never all pairs. Keys that a deterministic sample of the fingerprints shows to be
frequent are dealt to several tasks, one for each pair of blocks, so that no key is one task's work. Components come from minimum
contraction over distinct edges, and only labels that differ from their fingerprint are joined back.

Edge cases: null texts are empty; all texts without words are linked, as their fingerprints are equal; a null id is no candidate for a
component's smallest id (a component of null ids only has a null one); repeated rows have equal results; an empty table gives an
empty one; extra columns are ignored.
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import shuffle_partitions, text_of
from marquee.llm.components import components
from marquee.session import materialize

SHINGLE, MAX_BITS, SEED = 4, 4, 42
SEGMENTS = ((41, 23), (18, 23), (0, 18))  # (shift, bits)
GENERATOR = 0b101011100011  # of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SHORT_RUN, STEP, BLOCK = 48, 64, 2048
SAMPLE_RATE, HOT_ROWS, HOT_BLOCK = 64, 20_000, 8_192


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h64, n = xxhash.xxh64_intdigest, len(words) - k + 1
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 15):  # few hashes at a time, however long the text
        cut = zip(starts[i:min(n, i + (1 << 15))].tolist(), ends[k - 1 + i:k - 1 + i + (1 << 15)].tolist())
        hashes = np.array([h64(joined[a:b], SEED) for a, b in cut], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text", out: str = "fp") -> DataFrame:
    """docs plus the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, run(F.col(text_col)))


@lru_cache(maxsize=1)
def _decoder() -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word; the code is perfect, so it is unique."""
    data = np.arange(1 << 12, dtype=np.int64)
    code = np.zeros(1 << 12, dtype=np.int64)
    for i in range(12):
        code ^= np.where(data >> i & 1, GENERATOR << i, 0)
    index = np.full(1 << 23, -1, dtype=np.int16)
    bits = [1 << i for i in range(23)]
    errors = [0, *bits]
    errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    for e in errors:
        index[code ^ e] = data
    return index


def golay_indices(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of the distinct codeword indices of each segment and its 23 neighbours."""
    near = np.stack([segment, *[segment ^ (1 << i) for i in range(23)]])
    found = np.sort(_decoder()[near], axis=0)
    new = np.concatenate((np.ones((1, len(segment)), bool), found[1:] != found[:-1]))
    at, row = np.nonzero(new)
    return row, found[at, row].astype(np.int64)


def keys(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of each fingerprint (uint64); keys of different kinds never meet."""
    if max_bits > 4:
        raise ValueError("the segments are cut for at most 4 differing bits")
    fps = fps.astype(np.uint64)
    segs = [((fps >> np.uint64(s)) & np.uint64((1 << b) - 1)).astype(np.int64) for s, b in SEGMENTS]
    golay = [golay_indices(s) for s in segs]
    rows, out = [], []

    def add(kind: int, row: np.ndarray, key: np.ndarray) -> None:
        rows.append(row)
        out.append(key | (np.int64(kind) << np.int64(48)))

    for i in range(3):
        for j in range(3):
            if i != j:  # segment i equal, segment j at most two bits apart
                row, index = golay[j]
                add(3 * i + j, row, segs[i][row] << 12 | index)
    if max_bits >= 3:
        for j in range(3):  # all three differ: one bit in each of two segments, at most two in segment j
            row, index = golay[j]
            a, b = (i for i in range(3) if i != j)
            for x in range(2):
                for y in range(2):
                    halves = _half(segs[a], SEGMENTS[a][1], x)[row] << 12 | _half(segs[b], SEGMENTS[b][1], y)[row]
                    add(16 + 4 * j + 2 * x + y, row, halves << 12 | index)
    return np.concatenate(rows), np.concatenate(out)


def _half(segment: np.ndarray, bits: int, which: int) -> np.ndarray:
    cut = bits // 2
    return segment >> cut if which else segment & ((1 << cut) - 1)


class Forest:
    """Union-find over rows of one run."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def run_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Row pairs of a spanning forest of the fingerprints (uint64) at most max_bits apart, block by block."""
    n, links = len(fps), []
    forest = Forest(n)
    step = STEP
    for i in range(0, n, step):
        left = fps[i:i + step]
        for j in range(i, n, BLOCK):
            right = fps[j:j + BLOCK]
            a, b = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= max_bits)
            a, b = a + i, b + j
            while True:  # vectorised sweep: keep links between different trees, one per tree and pass
                root = _roots(forest.up)
                ra, rb = root[a], root[b]
                open_ = ra != rb
                if not open_.any():
                    break
                a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
                _, first = np.unique(np.maximum(ra, rb), return_index=True)
                for k in first:
                    if forest.join(int(a[k]), int(b[k])):
                        links.append((int(a[k]), int(b[k])))
    return links


def _roots(up: np.ndarray) -> np.ndarray:
    while True:
        nxt = up[up]
        if np.array_equal(nxt, up):
            return up
        up = nxt


def links_of_sorted(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key, every run whole: verified pairs of short runs, spanning forests of long ones."""
    if len(key) < 2:
        return fp[:0], fp[:0]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    us, vs = [], []
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    k, f = key[short], fp[short]
    for shift in range(1, int(min(SHORT_RUN, sizes.max()))):
        if len(k) <= shift:
            break
        near = np.flatnonzero(k[shift:] == k[:-shift])
        if not len(near):
            break
        near = near[np.bitwise_count(f[near] ^ f[near + shift]) <= max_bits]
        us.append(f[near])
        vs.append(f[near + shift])
    for s, n in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
        pairs = run_links(run := np.unique(fp[s:s + n]), max_bits)
        us.append(run[[a for a, _ in pairs]] if pairs else run[:0])
        vs.append(run[[b for _, b in pairs]] if pairs else run[:0])
    return (np.concatenate(us), np.concatenate(vs)) if us else (fp[:0], fp[:0])


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v) between distinct fingerprints (column fp) at most max_bits apart: enough links to connect every component."""
    spark = distinct.sparkSession
    n = shuffle_partitions(spark)

    def explode(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fps), 4096):
                part = fps[i:i + 4096]
                row, key = keys(part.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], ["key", "fp"])

    # a few bytes a row make some hundred keys: the tasks are counted by the keys, not by the bytes read
    distinct = distinct.select("fp").repartition(n, "fp")
    keyed = distinct.mapInArrow(explode, "key long, fp long")
    # keys that a sample of one fingerprint in SAMPLE_RATE shows to be frequent; fewer than rows * keys / HOT_ROWS of them
    some = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE_RATE)) == 0).mapInArrow(explode, "key long, fp long")
    hot = some.groupBy("key").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= HOT_ROWS // SAMPLE_RATE)
    hot = hot.select(F.col("key").alias("h_key"), F.ceil(F.col("seen") * SAMPLE_RATE / HOT_BLOCK).cast("int").alias("blocks"))
    dealt = keyed.join(materialize(hot, "hot-keys"), F.col("key") == F.col("h_key"), "left")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    # a row of a frequent key goes to every pair of blocks that has its own block
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.least(own, b) * F.col("blocks") + F.greatest(own, b))
    dealt = dealt.select("key", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("pair"), "fp")
    dealt = dealt.repartition(n, "key", "pair").sortWithinPartitions("key", "pair")

    def link(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False) * np.int64(1_000_003) + batch.column(1).to_numpy(zero_copy_only=False)
            key = np.concatenate((key, k))
            fp = np.concatenate((fp, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)))
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0  # the last run may go on
            yield from made(key[:last], fp[:last])
            key, fp = key[last:], fp[last:]
        yield from made(key, fp)

    def made(key, fp):
        u, v = links_of_sorted(key, fp, max_bits)
        if len(u):
            u, v = u.view(np.int64), v.view(np.int64)
            pair = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v))), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["u", "v"])

    return dealt.select("key", F.col("pair").cast("long"), "fp").mapInArrow(link, "u long, v long").distinct()


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(id, text_key, fp, group_fp, component_id) per row: group_fp names the component of links of at most max_bits,
    component_id is the smallest id in it."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(text_of(text_col)).alias("text_key"))
    base = materialize(fingerprints(base, shingle, "t").select("id", "text_key", "fp"), "simhash")
    distinct = materialize(base.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    labels = materialize(components(fingerprint_links(distinct, max_bits)), "simhash-labels")
    joined = distinct.join(labels, F.col("fp") == F.col("vertex"), "left").select("fp", "least_id", F.coalesce("label", "fp").alias("group_fp"))
    least = materialize(joined.groupBy("group_fp").agg(F.min("least_id").alias("component_id")), "simhash-least")
    by_print = materialize(joined.join(least, "group_fp").select("fp", "group_fp", "component_id"), "simhash-groups")
    return base.join(by_print, "fp").select(F.col("id").alias(id_col), "text_key", "fp", "group_fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The document of the smallest id of each group (of equal ids the smallest text hash; a null id only where there is no
    other), with the columns of docs."""
    groups = near_groups(docs, shingle, max_bits, id_col, text_col)
    first = F.struct(F.col(id_col).isNull().alias("null"), F.col(id_col).alias("id"), F.col("text_key").alias("text_key"))
    kept = groups.groupBy("group_fp").agg(F.min(first).alias("f")).select(F.xxhash64("f.id").alias("__k"), F.col("f.text_key").alias("__tk"))
    row = docs.select(F.xxhash64(id_col).alias("__k"), F.xxhash64(text_of(text_col)).alias("__tk"), F.struct("*").alias("__row"))
    # equal rows share both keys; one of them is enough
    return row.join(materialize(kept, "simhash-kept"), ["__k", "__tk"], "left_semi").dropDuplicates(["__k", "__tk"]).select("__row.*")
