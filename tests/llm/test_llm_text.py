"""Fingerprints, SentencePiece, quality and HTML against brute force, the library and held-out labels."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from marquee.llm import quality as q
from marquee.llm.html_text import extract, extract_pages
from marquee.llm.pieces import PieceCodec, encode_documents, token_digests
from marquee.llm.queries import QUERIES
from marquee.llm.winnow import (K, WINDOW, edited_fingerprints, fingerprints, from_string, kgram_hashes, likeness, winnow)

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# fingerprints

def brute_winnow(text, k=K, w=WINDOW):
    h = [int(x) for x in kgram_hashes(text, k)]
    w, out = min(w, len(h)), []
    for i in range(len(h) - w + 1 if h else 0):
        j = min(range(i, i + w), key=lambda j: (h[j], -j))
        if not out or out[-1] != j:
            out.append(j)
    return [(h[j], j) for j in out]


@pytest.mark.parametrize("text", ["", "a", "ab" * 3, "aaaa" * 50, "The quick 😀 brown fox. " * 9, "".join(map(chr, range(40, 400)))])
def test_winnow_is_the_windows_minimum(text):
    h, p = winnow(text)
    assert list(zip(h.tolist(), p.tolist())) == brute_winnow(text)


def test_gram_hash_depends_on_the_gram_alone():
    a, b = "x" * 50 + "the shared passage of some length here", "yy the shared passage of some length here too"
    at, bt = a.index("the shared"), b.index("the shared")
    n = len("the shared passage of some length here") - K + 1
    assert (kgram_hashes(a)[at:at + n] == kgram_hashes(b)[bt:bt + n]).all()


def test_match_guarantee():
    rng = random.Random(1)
    letters = "abcdefgh "
    for _ in range(50):
        passage = "".join(rng.choices(letters, k=WINDOW + K - 1))
        a, b = ("".join(rng.choices(letters, k=300)) + passage + "".join(rng.choices(letters, k=200)) for _ in range(2))
        assert set(winnow(a)[0].tolist()) & set(winnow(b)[0].tolist())


def edited_by_hand(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (d, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        sets = [{h for h, _ in brute_winnow(x)} for x in (t, e, n)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out[d] = (len(t), hashlib.sha256(e.encode()).hexdigest(), *near)
    return out


def test_edited_fingerprints(spark):
    rng = random.Random(2)
    rows = [(i * 7 - 50, "".join(rng.choices("abc de\nfé", k=rng.choice([0, 1, 5, 40, 300])))) for i in range(40)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, near_next string").repartition(5)
    got = {r.doc_id: (r.n_chars, r.edited_sha256, pytest.approx(r.near_edited), pytest.approx(r.near_next)) for r in edited_fingerprints(df).collect()}
    assert got == edited_by_hand(rows)


def test_edited_fingerprint_edges(spark):
    schema = "doc_id long, text string"
    assert edited_fingerprints(spark.createDataFrame([], schema)).count() == 0
    one = edited_fingerprints(spark.createDataFrame([(4, "abcdef")], schema)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    rows = [(None, "zz" * 40), (None, None), (2, "same " * 30), (2, "same " * 30), (9, None)]
    got = edited_fingerprints(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and sorted(r.doc_id for r in got if r.doc_id is not None) == [2, 2, 9]
    same = [r for r in got if r.doc_id == 2]
    assert same[0].fingerprint == same[1].fingerprint and max(r.near_next for r in same) == 1.0
    assert [r.fingerprint for r in got if r.doc_id == 9] == [""]


def test_fingerprint_column(spark):
    r = fingerprints(spark.createDataFrame([("some text to print, long enough",), (None,)], "text string")).collect()
    assert from_string(r[0].fingerprint)[0].tolist() == winnow("some text to print, long enough")[0].tolist() and r[1].fingerprint == ""
    assert likeness(np.array([1, 2, 3]), np.array([2, 3, 4])) == 0.5


# SentencePiece

@pytest.fixture(scope="module")
def both():
    return PieceCodec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_codec_equals_the_library_on_random_texts(both):
    own, lib = both
    rng = random.Random(4)
    parts = [" ", "  ", "a", "the", "\n", "\t", "ing", "é", "▁", "ß", "\x00", "7", ".", "$$$", "日", "本", "😀", "S", "ion", "　", "--", "<s>", "﻿"]
    for _ in range(4000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        ids = lib.encode(t)
        text, n, decoded = own.process(t)
        assert (text, n, decoded, own.decode(ids)) == (",".join(map(str, ids)), len(ids), lib.decode(ids), lib.decode(ids)), repr(t)


def test_codec_on_long_runs(both):
    own, lib = both
    for t in ("a" * 4000, "aaab" * 900, " " * 1000, " " * 15, "日本" * 400, "=" * 2500, "the" * 1500, " " * 17 + "x", "0" * 333):
        assert own.encode(t) == lib.encode(t), t[:9]


def test_backtracking_is_needed_somewhere(both):
    own, lib = both
    greedy = 0
    for t in ("thonanea", "undenpflichlich", "ciónmente", "aaaaab", "ingesble", "Ouwhea"):
        at, out = 0, []
        marked = "▁" + t
        while at < len(marked):
            p = max((marked[at:at + n] for n in range(1, 17) if marked[at:at + n] in own.id), key=len)
            out.append(p)
            at += len(p)
        greedy += out != own.backtrack(marked)
        assert [own.id[p] for p in own.backtrack(marked)] == lib.encode(t)
    assert greedy


def test_decode_of_broken_bytes(both):
    own, lib = both
    ids = [own.byte_id[b] for b in b"\xe6\x97a\xff\xf0\x9f\x98"] + [own.id["▁the"], 0, 1, 2, own.byte_id[0x41]]
    assert own.decode(ids) == lib.decode(ids)


def test_token_digests_of_documents(spark, both):
    lib = both[1]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op5_sentencepiece"](spark, SF).collect():
        ids = lib.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_encode_documents_edges(spark, both):
    df = spark.createDataFrame([(1, None, 3), (2, "", 4), (3, "a b", 5), (3, "a b", 5)], "doc_id long, text string, ids int")
    got = encode_documents(df, MODEL).collect()
    assert [(r.ids, r.decoded) for r in got[:2]] == [([], ""), ([], "")]
    assert got[2].ids == both[1].encode("a b") and got[2].decoded == "a b" and len(got) == 4
    assert encode_documents(df.limit(0), MODEL).count() == 0


# quality

def test_factorisation_equals_pairwise_sum():
    rng = np.random.default_rng(0)
    m = q.Model(3, 0.2, rng.normal(size=8 + q.N_STATS), rng.normal(size=(8 + q.N_STATS, 4)), np.zeros(q.N_STATS), np.ones(q.N_STATS))
    at, value = np.array([1, 3, 9, 12]), np.array([0.5, -1.0, 2.0, 0.3])
    pairs = sum(m.v[at[i]] @ m.v[at[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert m.raw(at, value, np.array([4]))[0][0] == pytest.approx(m.bias + m.w[at] @ value + pairs)


def brute_scores(rows, m):
    """doc_id to score from all pairs of features, one by one as a matrix; rows: (doc_id, text, n_chars)."""
    import math
    import zlib
    from collections import Counter
    out = {}
    for i, text, stated in rows:
        text = text or ""
        words = text.split()
        counts = Counter(words)
        raw = text.encode()
        size, n, nw, nc, lines = len(raw), max(1, len(raw)), max(1, len(words)), len(counts), text.count("\n") + 1
        kinds = [sum(c in kind for c in raw) for kind in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(c for c in range(33, 127) if not chr(c).isalnum()))]
        stats = [math.log1p(size), math.log1p(len(words)), math.log1p(lines), nc / nw, max(counts.values(), default=0) / nw, size / nw / 10,
                 kinds[0] / n, kinds[1] / n, kinds[2] / n, kinds[2] / nw, lines / nw, sum(c > 1 for c in counts.values()) / max(1, nc), math.log1p(stated)]
        x = np.log1p(np.array(list(counts.values()), float))
        x = x / (math.sqrt(float(x @ x)) or 1.0)
        at = [zlib.crc32(w.lower().encode()) % 2**m.bits for w in counts] + [2**m.bits + j for j in range(q.N_STATS)]
        x = np.concatenate((x, np.clip((np.array(stats) - m.mean) / m.scale, -4, 4) / 4))
        both = (m.v[at] @ m.v[at].T) * np.outer(x, x)
        out[i] = 1 / (1 + math.exp(-(m.bias + m.w[at] @ x + np.triu(both, 1).sum())))
    return out


def test_op2_query_against_all_pairs(spark):
    import zlib
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    want = brute_scores([(r.doc_id, r.text, r.n_chars) for r in docs.collect()], q.fit(docs, labels))
    got = QUERIES["op2_quality_classifier"](spark, SF).collect()
    assert len(got) == len(want) > 100
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id]) and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_metadata_counts_and_has_defaults(spark):
    rng = np.random.default_rng(1)
    m = q.Model(4, 0.1, rng.normal(size=16 + q.N_STATS), rng.normal(size=(16 + q.N_STATS, 3)), np.zeros(q.N_STATS), np.ones(q.N_STATS))
    df = spark.createDataFrame([(0, "a b", 3), (1, "a b", None), (2, "a b", -1), (3, "a b", 40)], "doc_id long, text string, n_chars long")
    s = {r.doc_id: r.score for r in q.with_scores(df, m).collect()}
    assert s[0] == s[1] == s[2] != s[3]
    assert {r.score for r in q.with_scores(df.drop("n_chars"), m).collect()} == {s[0]}
    assert {r.score for r in q.with_scores(df.where("doc_id = 0").withColumn("n_chars", q.F.lit("no number")), m).collect()} == {s[0]}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = QUERIES["op2_quality_classifier"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(got) > 500 and (got.predicted == got.quality).mean() > 0.97 and got.score.between(0, 1).all()
    assert (got[got.quality == 1].predicted == 1).mean() > 0.99


def test_quality_reruns_and_edges(spark):
    docs = spark.createDataFrame([(i, None if i == 3 else ("good words here " if i % 2 else "BAD!! $$ ") * 20, "en") for i in range(60)] + [(None, "x", None), (5, "y", "en")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(1, None), (None, 1), (7, 1), (8, 1)], "doc_id long, quality int")
    a = q.score_documents(docs, labels).select("doc_id", "score", "predicted", "held_out")
    assert sorted(map(str, a.collect())) == sorted(map(str, q.score_documents(docs, labels).select("doc_id", "score", "predicted", "held_out").collect()))
    assert a.count() == 62 and a.where("score < 0 or score > 1 or score is null").count() == 0
    import zlib
    for r in a.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
    assert {r.score for r in q.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert q.score_documents(docs.limit(0), labels).count() == 0


def test_one_row_of_each_sampled_id(spark, monkeypatch):
    hot = [(1, f"copy {i % 3} of a text") for i in range(300)]  # 1 is not held out
    docs = spark.createDataFrame(hot + [(i, f"text number {i}") for i in range(2, 100)] + [(99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    fitted, collected = [], []
    fit_rows, to_pandas = q.fit_rows, type(docs).toPandas
    monkeypatch.setattr(q, "fit_rows", lambda rows, y, bits: fitted.append((rows, y)) or fit_rows(rows, y, bits))
    monkeypatch.setattr(type(docs), "toPandas", lambda df: collected.append(out := to_pandas(df)) or out)
    a = q.fit(docs.repartition(7), labels, sample=90)
    b = q.fit(docs.orderBy("text").coalesce(2), labels, sample=90)
    ids = [x for x in docs.select("doc_id").distinct().where(~q.held_out()).toPandas()["doc_id"]]
    assert 1 in ids and len(ids) < 90 and len(collected[0]) == len(fitted[0][0]) == len(ids)
    assert sorted(collected[0]["id"]) == sorted(ids) and 0 < fitted[0][1].mean() < 1
    assert np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)
    q.fit(docs, labels, sample=10)
    assert len(collected[-1]) == len(fitted[-1][0]) <= 10 and len(set(collected[-1]["id"])) == len(collected[-1])


# HTML

def page(body, before="", after=""):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{before}{body}{after}</body></html>'


def test_article_without_its_surroundings():
    noise = ('<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now, ' + "really " * 40 + '</div><script>var t="</p>";</script>',
             '<aside>' + "side " * 60 + '</aside><section id="comments"><article><p>' + "first! " * 50 + '</p></article></section><footer>&copy; x</footer>')
    body = "<article><header><h1>Head  line</h1></header><p>One &amp; two\n three<p>Short.<ul><li>item<li>item 2</ul><form>mail</form><div class='cookie-notice'>ok</div></article>"
    assert extract(page(body, *noise)) == "Head line\n\nOne & two three\n\nShort.\n\nitem\n\nitem 2"


def test_pages_without_article_element():
    para = "<p>" + "plain words of a longer paragraph " * 6 + "</p>"
    got = extract(page(f'<div id="wrap"><div class="story">{para}<p>short one</p>{para}</div><div><a href="#">a</a> <a href="#">b</a></div></div>'))
    assert got.count("\n\n") == 2 and "short one" in got and not got.endswith("b")
    assert extract("just text &lt;here&gt;") == "just text <here>"


LONG = " ".join(["plain words of a longer paragraph"] * 6)


@pytest.mark.parametrize("body, want", [
    ('<article><h2 id="related-work">Related work</h2><p>L</p><p id="share-price">Share price</p><section id="social-impact"><p>Impact</p></section></article>',
     "Related work|L|Share price|Impact"),
    ('<a href="#c">Skip to content</a><main class="has-sidebar"><h1>T</h1><p>L</p></main>', "T|L"),
    ('<a href="#c">Skip to content</a><article class="post comments-open"><h1>T</h1><p>L</p></article>', "T|L"),
    ('<main class="sidebar" id="menu"><h1 class="banner">T</h1><p class="notice">L</p></main>', "T|L"),
    ('<div class="entry-header"><h1>T</h1></div><article><p>L</p></article>', "T|L"),
    ('<div class="entry-header"><h1>T</h1><p>Sub</p></div><div class="entry-content"><p>L</p></div>', "T|Sub|L"),
    ('<form action="x"><a href="#c">Skip to content</a><div><h1>T</h1><p>L</p></div></form>', "T|L"),
    ('<a href="#c">Skip to content</a><form><div id="notice"><h1>T</h1><p>L</p></div></form>', "T|L"),
    ('<a href="#c">Skip to content</a><form><main><p>L</p></main><div class="ad">L L</div></form>', "L"),
    ('<article><h1>T</h1><div class="notice"><p>L</p></div></article>', "T|L"),
    ('<div class="story"><p>L</p></div><div id="comments">L L L</div>', "L"),
    ('<div class="story"><p>L</p></div><div class="share-buttons">L</div><div class="site-footer">L</div><form>L</form>', "L"),
])
def test_names_and_forms_do_not_hide_content(body, want):
    assert extract(page(body.replace("L", LONG))) == want.replace("|", "\n\n").replace("L", LONG)


def sized(n, i):
    return (f"line {i} " * n)[:n - 1] + "."


def test_short_blocks_around_the_cluster_stay():
    sizes = [40, 18, 22, 600, 700, 650, 500, 620, 30, 25, 28, 20, 24]
    want = [sized(n, i) for i, n in enumerate(sizes)]
    body = "".join(f"<{t}>{x}</{t}>" for t, x in zip(["h1"] + ["p"] * 12, want))
    menu = '<ul><li><a href="#">one</a></li><li><a href="#">two</a></li></ul>'
    assert extract(page(f'<div class="story">{body}</div>', menu, menu)) == "\n\n".join(want)
    assert extract(page(f'<div class="story">{menu}{body}<div class="share-buttons">Share</div>{menu}</div>')) == "\n\n".join(want)
    middle = want[3:8] + want[:3] + want[8:]  # short blocks at the end only
    assert extract(page("<div>" + "".join(f"<p>{x}</p>" for x in middle) + "</div>")) == "\n\n".join(middle)


def test_short_second_article_stays():
    first = f"<article><h1>One</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article>"
    want = f"One\n\n{LONG}\n\n{LONG}\n\n{LONG}"
    assert extract(page(first + "<article><h2>Two</h2><p>Short.</p></article>")) == want + "\n\nTwo\n\nShort."
    assert extract(page("<article><p>Short.</p></article>" + first)) == "Short.\n\n" + want
    assert extract(page(first + '<article><h3><a href="#">More of this</a></h3></article>')) == want


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<!-- x", "<script>never closed", "</p></div>", "<article></article>", "<nav>a</nav>", "<div " * 3000, "<b>" * 3000])
def test_odd_pages(html):
    assert isinstance(extract(html), str)


def test_given_pages_equal_their_articles(spark):
    import html as H
    import re
    for r in extract_pages(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(H.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h\d)>", inner))
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_pages_table_edges(spark):
    df = spark.createDataFrame([(1, "u", None, "z"), (1, "u", "<p>a", "z"), (None, None, "", "z")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in extract_pages(df).collect()) == ["", "", "a"]
    assert extract_pages(df.limit(0)).count() == 0
