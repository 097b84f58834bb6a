"""Token counts against the library, runs and clusters against brute force; edge rows of all three."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marquee.llm import centroids as ce
from marquee.llm import run_detection as rd
from marquee.llm.queries import QUERIES
from marquee.llm.token_counts import SLICE, PairCounter, count_tokens

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return PairCounter(BPE)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BPE)
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


# token counts

ODDS = ["a", "b", " ", "  ", "\n", "'s", "'re", "<|endoftext|>", "<|endoftext", "1", "٣", "é", "中", "😀", "՘", "Ᲊ", "\U00010800",
        "\x1c", "\x85", "᠎", "　", "Ω", "!", "​", "\t", "the", "\x00"]


def test_counts_equal_the_library(counter, library):
    rng = random.Random(3)
    for _ in range(3000):
        s = "".join(rng.choices(ODDS, k=rng.randint(0, 25)))
        assert counter.count(s) == library(s), s
    for s in ("".join(chr(rng.choice([rng.randint(32, 0x2FFF), rng.randint(0x10000, 0x323AF)])) for _ in range(20_000)), "a" * 50_000,
              "ab" * 30_000, "x" * 3 + "<|endoftext|>" * 500, "\n" * 999 + " x"):
        assert counter.count(s) == library(s)


def test_very_long_texts_are_counted_whole(counter, library):
    for s in ("some words of a text, 12 and 345.\n" * 70_000, "z" * (SLICE + 7)):
        assert len(s) > SLICE and counter.count(s) == library(s)


def test_merges_pop_the_lowest_rank_leftmost(counter):
    """Brute force: the best pair of all, over and over."""
    rng = random.Random(4)
    for _ in range(300):
        sym = [counter.byte_id[b] for b in "".join(rng.choices(["th", "e", " a", "in", "g", "ing", "  ", "aa"], k=8)).encode()]
        parts, n = list(sym), 0
        while found := min(((counter.pairs[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in counter.pairs), default=None):
            i = found[1]
            parts[i:i + 2] = [counter.pairs[parts[i], parts[i + 1]][1]]
            n += 1
        assert counter.merges(sym) == n


def test_count_edges(spark, library):
    rows = [(1, None, 5), (2, "", 6), (None, "two words", 7), (2**60 + 1, "é" * 3, 8), (2**60 + 1, "é" * 3, 8), (4, "word " * 1025, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, BPE).collect())
    assert got == Counter((i, len((t or "").encode()), library(t or ""), library(t or "") > 1024) for i, t, _ in rows)
    assert count_tokens(df.limit(0), BPE).count() == 0


def test_op11_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op11_token_counts"](spark, SF).collect()}
    assert got == {i: (len(t.encode()), library(t), library(t) > 1024) for i, t in texts.items()}


# runs

def brute_runs(x, least=6, powers=4):
    n, out = len(x), []
    for q in range(1, n // powers + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            size, seg = j - i + q, x[i:j + q]
            if size >= max(least, powers * q) and not any(seg[p:] == seg[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, kinds):
    out, n = [], rng.randint(0, 45)
    while len(out) < n:
        root = [rng.randrange(kinds) for _ in range(rng.randint(1, 6))]
        out += [rng.randrange(kinds)] if rng.random() < 0.5 else (root * 8)[:rng.randint(1, 30)]
    return out


@pytest.mark.parametrize("least, powers", [(6, 4), (2, 2), (7, 5)])
def test_runs_against_brute_force(least, powers):
    rng = random.Random(5)
    for _ in range(400):
        docs = [periodic(rng, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 4))]
        words = np.array([w for d in docs for w in d], np.int64)
        part, want, at = np.repeat(np.arange(len(docs)), [len(d) for d in docs]), [], 0
        for d in docs:
            want += [(a + at, b, c) for a, b, c in brute_runs(d, least, powers)]
            at += len(d)
        assert [tuple(r) for r in rd.runs_of(words, part, least, powers).tolist()] == want


def test_lyndon_candidates_reach_every_maximal_repetition():
    """Without the first filter: all runs of two periods or more of a sequence."""
    rng = random.Random(6)
    for _ in range(200):
        x = periodic(rng, 2)
        assert [tuple(r) for r in rd.all_runs(np.array(x, np.int64), 2, 2).tolist()] == brute_runs(x, 2, 2)


def test_extensions_are_common_prefixes():
    rng = random.Random(7)
    x = [rng.randrange(2) for _ in range(120)]
    ext = rd.SuffixTree([*x, 2], 3).extensions()
    a, b = np.array([(i, j) for i in range(121) for j in range(121) if i != j]).T
    s = [*x, 2]
    want = [next(k for k in range(122) if max(i, j) + k >= 121 or s[i + k] != s[j + k]) for i, j in zip(a, b)]
    assert ext.lce(a, b).tolist() == want


def by_hand(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_op12_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    tenth = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(rng.choices("a b c d é 😀".split(), k=rng.randint(0, 60)))) for i in tenth[:60]]
    rows += [(i, rng.choice([" ", "\n", "\t\x0b "]).join(map(str, periodic(rng, 4)))) for i in range(2000, 2060)]
    rows += [(tenth[61], None), (tenth[62], ""), (tenth[63], " \n "), (tenth[64], "one"), (None, "x " * 9), (2**60, "y " * 9), (7, "a a " * 8),
             (7, "a a " * 8), (8, "the same " * 60_000)]
    df = spark.createDataFrame([(*r, "z", 3) for r in rows], "doc_id long, text string, runs string, n_runs int")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect())
    want = Counter(by_hand(*r) for r in rows if r[0] != 8)
    kept = hashlib.sha256(b"the same").hexdigest()
    want[8, 1, 0, 120_000, 2, 60_000_000, hashlib.sha256(b"0,120000,2\n").hexdigest(), kept] = 1
    assert got == want


def test_op12_on_the_given_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 5000}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert {i: got[i] for i in docs} == {i: by_hand(i, t) for i, t in docs.items()}


def test_find_runs_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a " * 9, "mine", 2)], "doc_id long, text string, collapsed string, other int")
    r = rd.find_runs(df).first()
    assert r.asDict(True) == {"doc_id": 1, "text": "a " * 9, "other": 2, "runs": [{"start": 0, "length": 9, "period": 1}], "collapsed": "a"}
    dotted = rd.find_runs(df.withColumnRenamed("other", "a.b")).first()
    assert dotted["a.b"] == 2
    kept = rd.find_runs(df, runs="r", collapsed=None).first()
    assert kept["collapsed"] == "mine" and len(kept["r"]) == 1
    assert rd.find_runs(df.limit(0)).count() == 0


# clusters

def clusters_by_hand(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in order[:k]]
    if not cents:
        return Counter()

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        cents = [[sum(col) // len(col) for col in zip(*m)] if (m := [v for (_, v), o in zip(kept, own) if o == n]) else c
                 for n, c in enumerate(cents)]
    last = [nearest(v) for _, v in kept]
    total = sum(d for d, _ in last)
    return Counter((i, c, d, sum(e for e, o in last if o == c), total, hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, last))


def op13(spark, path):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return Counter(tuple(r[n] for n in names) for r in QUERIES["op13_centroid_clustering"](spark, str(path)).collect())


@pytest.mark.parametrize("n", [0, 3, 150])
def test_op13_query_against_brute_force(spark, tmp_path, n):
    rng = random.Random(n)
    rows = [(rng.randrange(100) if n > 3 else i, [rng.choice([-0.5, 0.25, 0.1]) * rng.choice([1, 1, 2]) for _ in range(64)]) for i in range(n)]
    rows += [(200, None), (201, [0.5] * 63), (202, [None] + [0.5] * 63), (203, [float("nan")] * 64), (204, [float("inf")] * 64), (205, [])]
    if n > 3:
        same = [0.3] * 64
        rows += [(300 + i % 2, same) for i in range(60)] + [(None, same), (None, [9.0] * 64), (2**60 + 1, [-3.0] * 64), (2**60 + 1, [-3.5] * 64)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, distance int, id string")
    df.repartition(4).write.parquet(str(tmp_path / "embeddings.parquet"))
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert op13(spark, tmp_path) == clusters_by_hand(f32)


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 5).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    make = lambda d: Counter(map(str, ce.cluster_vectors(d, 4, 6, 5, 100, "s", "id", "v").collect()))
    want = make(df.repartition(1))
    monkeypatch.setattr(ce, "BLOCK", 7)
    assert make(df.repartition(6)) == want


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        ce.cluster_vectors(df).collect()


def test_op13_on_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert op13(spark, SF) == clusters_by_hand(rows)
