"""SimHash, vector search, WARC and the pipeline against brute force."""
import base64
import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from marquee.llm import simhash as S
from marquee.llm.components import components
from marquee.llm.queries import QUERIES
from marquee.llm.vector_search import BallTree, exact_top_k, search
from marquee.llm.warc import coalesced, digest, open_fs, parse, read_records, record, write_archives

SF = "/root/testdata/sf0.001"


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints):
    """Least position reachable over links of at most 4 bits."""
    up = list(range(len(prints)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t", "one", "One two\x0bthree", "a b c d", "A b C d e", "é É x y z \x1c w", "a\x85b c d e", "word " * 5000])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_print(text)


def test_golay_code_is_perfect_and_halfway_words_meet():
    assert (S._decoder() >= 0).all()
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 300)
    for flips in (1, 2):
        other = words.copy()
        for i in range(len(other)):
            for b in rng.choice(23, flips, replace=False):
                other[i] ^= 1 << int(b)
        a, b = ({*zip(*map(np.ndarray.tolist, S.golay_indices(x)))} for x in (words, other))
        assert {r for r, _ in a & b} == set(range(300))


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_every_near_pair_shares_a_key(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for x in rng.choice(64, bits, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(x)
    ka, kb = ({*zip(*map(np.ndarray.tolist, S.keys(x)))} for x in (a, b))
    assert {r for r, _ in ka & kb} == set(range(500))


def test_long_runs_give_a_spanning_forest():
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = np.unique(np.array([int(centre[i % 3]) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6))) for i in range(600)], dtype=np.uint64))
    links = S.run_links(fps, 4)
    want = slow_groups([int(x) for x in fps])
    up = list(range(len(fps)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        assert int(fps[a] ^ fps[b]).bit_count() <= 4
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == want and len(links) == len(fps) - len(set(want))
    u, v = S.links_of_sorted(np.zeros(len(fps), np.int64), fps, 4)
    assert len(u) == len(links)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000 + rng.randrange(60), 1000 + rng.randrange(60)) for _ in range(40)] + [(5000, i) for i in range(4000, 4100)]
    got = {r.vertex: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in list(up)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def near_copies(rng, n):
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(9999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_near_groups(spark, monkeypatch, hot):
    if hot:  # small limits, so that frequent keys are dealt to block pairs
        monkeypatch.setattr(S, "SAMPLE_RATE", 2)
        monkeypatch.setattr(S, "HOT_ROWS", 8)
        monkeypatch.setattr(S, "HOT_BLOCK", 16)
    rng = random.Random(7)
    texts = near_copies(rng, 60) + near_copies(rng, 10) + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    texts += [None, "", "\t", "same", "SAME ", texts[0].upper()]
    ids = rng.sample(range(1000), len(texts))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, fp string, label int").repartition(4)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in S.near_groups(df).collect()}
    order = sorted(zip(ids, texts))
    prints = [slow_print(t) for _, t in order]
    want = slow_groups(prints)
    assert got == {i: (p, order[w][0]) for (i, _), p, w in zip(order, prints, want)}
    kept = S.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got.values()})


def test_near_groups_edges(spark):
    schema = "doc_id long, text string"
    assert S.near_groups(spark.createDataFrame([], schema)).count() == S.one_of_each(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "lone text of a null id"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (9, None)]
    got = S.near_groups(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter({(None, None): 1, (4, 4): 2, (None, 4): 1, (9, 9): 1})
    kept = S.one_of_each(spark.createDataFrame(rows, schema)).collect()
    assert Counter(r.doc_id for r in kept) == Counter([None, 4, 9])


# vector search

def slow_top(vectors, queries, k):
    """queries: positions in vectors; a row's candidates are all rows but itself."""
    out = []
    for at in queries:
        qi, q = vectors[at]
        s = sorted((-sum(a * b for a, b in zip(q, v)), i) for n, (i, v) in enumerate(vectors) if n != at and len(v) == len(q))
        out += [(qi, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def floors(v):
    return [int(np.floor(256.0 * float(np.float32(x)))) for x in v]


@pytest.mark.parametrize("shard_rows", [10_000, 90])
def test_exact_top_k(spark, shard_rows):
    rng = np.random.default_rng(3)
    vecs = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)]
    vecs += [(1000 + i, [0.5] * 8) for i in range(400)] + [(2000, [1.0, 2.0]), (2050, [3.0, -1.0]), (2001, [0.1, 0.2])]
    bad = [(3000, None), (3050, [1.0, None] + [0.0] * 6), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (None, [9.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, "r") for i, v in vecs + bad], "vec_id long, embedding array<float>, rank int, id string")
    got = exact_top_k(df, df.where("vec_id % 50 = 0"), 5, shard_rows=shard_rows)
    ints = [(i, floors(v)) for i, v in vecs]
    assert sorted(map(tuple, got.collect())) == slow_top(ints, [n for n, x in enumerate(ints) if x[0] % 50 == 0], 5)


def test_rows_that_share_an_id_or_a_vector(spark):
    """A third of the rows on one id, a third equal rows, ids above 2**53: every row is a query and a candidate of the others."""
    rng = np.random.default_rng(5)
    vecs = [(100, rng.normal(size=4).tolist()) for _ in range(60)] + [(50, [0.5, 0.25, 1.0, -1.0])] * 60
    vecs += [(2**60 + 50 * i, rng.normal(size=4).tolist()) for i in range(30)] + [(7, [0.5, 0.25, 1.0, -1.0])] * 3
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>").repartition(5)
    got = exact_top_k(df, df.where("vec_id % 50 = 0"), 5, shards=6)
    ints = [(i, floors(v)) for i, v in vecs]
    assert sorted(map(tuple, got.collect())) == slow_top(ints, [n for n, x in enumerate(ints) if x[0] % 50 == 0], 5)


def test_top_k_edges(spark):
    schema = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], schema)
    assert exact_top_k(none, none).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (0, [1.0, 0.0])], schema)
    got = exact_top_k(few, few.where("vec_id = 0")).collect()
    # the two equal rows are each other's candidates
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 0, 65536)] * 2 + [(0, 2, 1, 0)] * 2


def test_branch_and_bound_prunes_and_keeps_ties():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16)) * 400
    rows = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 16)) * 5)
    tree = BallTree(np.arange(4000), rows)
    q = rows[::500].copy()
    n = len(q)
    row, ids, score, _ = search(tree, np.arange(0, 4000, 500), q, 3, np.full(n, -np.inf), np.full(n, 2**63 - 1), False)
    for i in range(n):
        s = rows @ q[i]
        s[i * 500] = -np.inf
        want = sorted(zip(-s, range(4000)))[:3]
        assert [(int(b), int(-a)) for a, b in want] == list(zip(ids[row == i].tolist(), score[row == i].tolist()))
    # a shared score above everything in the tree leaves no leaf to visit
    assert len(search(tree, np.arange(n), q, 3, np.full(n, 1e12), np.full(n, -1), False)[0]) == 0


# WARC

def test_record_round_trip():
    raw = record(7, "http://x/a\r\nEvil: 1%20é", "päge".encode(), None, False)
    fields, body = parse(raw)
    assert body.decode() == "päge" and fields["WARC-Target-URI"] == "http://x/a%0D%0AEvil: 1%20é" and "Evil" not in fields
    assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1("päge".encode()).digest()).decode()
    assert parse(record(8, None, b"x" * 9, 7, True))[1] == b""


def test_coalesced_ranges():
    assert coalesced([(0, 10), (10, 5), (100, 5), (106, 4)], gap=2, most=1000) == [(0, 15, 2), (100, 10, 2)]
    assert coalesced([(0, 10), (10, 10), (20, 10)], gap=0, most=20) == [(0, 20, 2), (20, 10, 1)]
    assert coalesced([]) == []


PAGES = "page_id long, url string, html string, refers_to int"


def test_archives(spark):
    rows = [(5, "u5", "same", 0), (2, "u2", "same", 0), (9, None, None, 0), (1, "u1", "", 0), (3, "u3", "ünique" * 3000, 0), (2, "u2", "same", 0), (None, "n", "same", 0), (None, "m", "own", 0)]
    index = write_archives(spark.createDataFrame(rows, PAGES).repartition(3), roll_bytes=300)
    got = read_records(index).collect()
    bodies = {"same": 2, "": 1, "ünique" * 3000: 3, "own": None}
    want = Counter()
    for i, _, h, _ in rows:
        first = bodies[h or ""]
        want[(i, len((h or "").encode()), digest((h or "").encode()), "response" if i == first else "revisit", None if i == first else first)] += 1
    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == set(bodies)
    # every index row leads to its own record, in any selection
    one = index.where("url = 'u3'")
    assert [r.url for r in read_records(one).collect()] == ["u3"]
    r = one.first()
    fs, path = open_fs(r.file)
    with fs.open_input_file(path) as f:
        f.seek(r.offset)
        assert parse(gzip.decompress(f.read(r.length)))[0]["WARC-Target-URI"] == "u3"
    assert index.select("file").distinct().count() > 1


def test_small_payloads_are_all_responses_below_the_limit(spark):
    df = spark.createDataFrame([(1, "a", "x", 0), (2, "b", "x", 0), (3, "c", "long one", 0), (4, "d", "long one", 0)], PAGES)
    got = {r.id: r.record_type for r in read_records(write_archives(df, min_revisit_bytes=3)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert read_records(write_archives(df.limit(0))).count() == 0


# pipeline

def test_pipeline_stages_against_brute_force(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    import corpus_pipeline as P
    from marquee.llm.mixing import mix
    from marquee.llm.quality import fit
    from test_llm_native import brute_lines
    from test_llm_text import brute_scores

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, made = docs, {}
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, before, SF)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        made[name] = (before, out := spark.read.parquet(str(tmp_path / str(i))))
        before = out
    a, b = made["quality classifier"]
    scores = brute_scores([(r.doc_id, r.text, r.n_chars) for r in a.collect()], fit(a, labels))
    assert sorted(map(tuple, b.collect())) == sorted(tuple(r) for r in a.collect() if scores[r.doc_id] >= 0.3)
    a, b = made["line dedup"]
    want = brute_lines([(r.doc_id, r.text) for r in a.collect()])
    assert Counter((r.doc_id, r.text) for r in b.collect()) == Counter({(i, t): n for (i, _, _, t), n in want.items()})
    assert all(r.n_chars == len(r.text) for r in b.collect())
    a, b = made["SimHash near-dedup"]
    rows = sorted((r.doc_id, r.text) for r in a.collect())
    roots = slow_groups([slow_print(t) for _, t in rows])
    assert sorted(r.doc_id for r in b.collect()) == sorted({rows[i][0] for i in roots})
    a, b = made["mixing sources"]
    times = {r.doc_id: r.copies + (r.part > 0 and 2 * r.part >= r.size) for r in mix(a).collect()}
    assert Counter(r.doc_id for r in b.collect()) == Counter({k: v for k, v in times.items() if v})
    a, b = made["SentencePiece encoding"]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in a.collect()}
    assert b.count() == a.count() and all(r.ids == sp.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in b.collect())
    assert Counter(map(str, P.run(spark, SF).collect())) == Counter(map(str, b.collect()))


#: Names of the operators' results and of what they use inside.
TAKEN = ("n_lines n_dropped kept_text score held_out predicted fp group_fp component_id text_key copies part taken size source_size target "
         "ids n_tokens decoded id t tk carried key bucket row_key r pos line h1 h2 drop_flag d_id d_tk y l_id least f null __row __text __k __tk "
         "__rk __n __many __one label quality").split() + ["a.b", "with space"]


@pytest.mark.parametrize("stage", range(5))
def test_columns_of_any_name_keep_their_values(spark, stage):
    import corpus_pipeline as P

    rng = random.Random(9)
    rows = [(i if i % 9 else 2**60 + i, " ".join(rng.choices("some words of a plain text about nothing".split(), k=30)), "en", "abc"[i % 3], 100) for i in range(40)]
    rows += [(None, None, None, None, None), (50, "", "en", "a", 0), (51, rows[3][1], "en", "a", 1), (52, "a very long text " * 60_000, "de", "b", 1)]
    rows += [rows[5]] * 3
    own = [f"own {name}" for name in TAKEN]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{name}` string" for name in TAKEN)
    docs = spark.createDataFrame([(*r, *own) for r in rows], schema).repartition(3)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    run = P.STAGES[stage][1]
    out, want = run(spark, docs, SF), run(spark, plain, SF)
    if stage < 4:
        assert out.columns == docs.columns
        assert all(r[5:] == tuple(own) for r in map(tuple, out.collect()))
    got = Counter(map(str, out.select(*want.columns).collect()))
    assert got == Counter(map(str, want.collect())) and got
    assert run(spark, docs.limit(0), SF).count() == 0


def test_entry_adds_the_queries():
    import __spark_entry__ as e
    assert {q.split("_")[0] for q in e.queries() if q.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in e.queries()
    assert set(QUERIES) <= set(e.queries())
