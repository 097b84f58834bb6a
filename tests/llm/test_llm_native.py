"""Line dedup, secret scans and mixing: SQL on the smallest tables, and edge cases against plain Python."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from marquee.llm.line_dedup import line_dedup
from marquee.llm.mixing import mix, repeat_rows
from marquee.llm.queries import ORACLES, QUERIES
from marquee.llm.secrets import scan_secrets

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(names, res.fetchall())


def brute_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), k)

    docs = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                docs[key(line)].add(i)
    bad = {k: max(v) for k, v in docs.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in bad or bad[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup_edges(spark):
    rng = random.Random(3)
    long = ["All rights reserved, and this line is long enough é.", " \tALL RIGHTS RESERVED, AND THIS LINE IS LONG ENOUGH é.\r",
            "x" * 39, "y" * 40, "ÄÖÜ" * 14, "", "short", "\x0b" + "z" * 41 + "\x0c", "\x1c" + "z" * 41]
    rows = [(i % 60, "\n".join(rng.choices(long, k=rng.randint(0, 9)))) for i in range(70)]
    rows += [(None, long[0]), (None, None), (200, None), (201, ""), (202, "\n\n"), (203, "\n".join([long[0]] * 3000)), (5, rows[5][1])]
    df = spark.createDataFrame([(i, t, 1, "v") for i, t in rows], "doc_id long, text string, pos int, n_dropped string")
    got = Counter(tuple(r) for r in line_dedup(df).select("doc_id", "n_lines", "n_dropped", "kept_text").collect())
    assert got == brute_lines(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert line_dedup(none).count() == scan_secrets(none).count() == mix(none).count() == repeat_rows(none).count() == 0


def brute_spans(text):
    found = []
    kinds = ((r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), (r"AKIA[A-Z0-9]+", 0, 20),
             (r"[0-9a-f]+", 0, 24))
    for order, (pattern, group, least) in enumerate(kinds):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), order, m.end()))
    return ",".join(f"{('assign', 'access', 'hex')[o]}:{s}:{e}" for s, o, e in sorted(found))


def test_secret_edges(spark):
    h = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [None, "", "é😀 password = token = abcdef12", f'Token : "{h}" x {h}', "AKIA" + "A" * 15, "AKIA" + "B7" * 8 + " AKIAAKIA" + "C" * 16,
             f"api_key='{h[:23]}'", "secret=abc", "APIKEY:abcdef", f"{h}{h}", "ſecret=abcdefgh", "passwd\n=abcdefg", "token = " * 500 + h]
    rows = [(i, t, "o1" if i % 2 else None) for i, t in enumerate(texts)] + [(3, texts[3], "o1"), (None, texts[5], "o2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = scan_secrets(df.withColumn("kind", df.source).withColumn("found", df.text)).collect()
    assert Counter((r.doc_id, r.base) for r in got) == Counter((i, brute_spans(t)) for i, t, _ in rows)
    for r in got:
        spans = r.spans.split(",") if r.spans else []
        assert set(filter(None, r.base.split(","))) <= set(spans)
        assert r.n_assign + r.n_access + r.n_hex == len([x for x in r.base.split(",") if x])


def test_ownership_separates_copied_examples(spark):
    own, shared = "9f8e7d6c5b4a39281706f5e4", "0a9b8c7d6e5f40312233aabb"
    rows = [(1, f"token = {own}", "alice"), (2, f"again {own}", "alice")] + [(i, f"token = {shared}", f"o{i}") for i in range(3, 9)]
    got = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1].n_live == 1 and got[1].spans.endswith(f"live:8:{8 + len(own)}") and got[2].n_live == 1
    assert all(got[i].n_live == 0 and got[i].n_assign == 1 for i in range(3, 9))


def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    clamped, total = set(), 1.5 * sum(sizes.values())
    while True:
        free = sum(w[s] for s in names if s not in clamped)
        level = (total - sum(2 * sizes[s] for s in clamped)) / free if free else 0
        more = {s for s in names if s not in clamped and 2 * sizes[s] <= w[s] * level}
        if not more:
            return {s: 2.0 * sizes[s] if s in clamped else w[s] * level for s in names}
        clamped |= more


@pytest.mark.parametrize("seed", range(3))
def test_mix_targets_and_words(spark, seed):
    rng = random.Random(seed)
    names = [None, "a", "b", "ä", "B", "zz", "empty"]
    rows = [(i, " ".join("w" * rng.randint(1, 40)), rng.choice(names[:-1])) for i in range(150)]
    rows += [(900 + i, None, "empty") for i in range(3)] + [(999, "\t \n", "zz"), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, size int, key string")
    got = mix(df).collect()
    sizes = Counter({s: 0 for s in names})
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets({s: sizes[s] for s in {r[2] for r in rows}})
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - t) <= 1 for s, t in want.items())
    assert Counter(map(tuple, got)) == Counter(map(tuple, mix(df).collect()))


def test_repeat_rows_follows_the_mix(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    out = repeat_rows(df)
    assert out.columns == df.columns
    want = {r.doc_id: r.copies + (r.part > 0 and r.part * 2 >= r.size) for r in mix(df).collect()}
    got = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert got == Counter({k: v for k, v in want.items() if v})


def test_repeat_rows_keeps_rows_of_equal_id_and_text_apart(spark):
    rows = [(1, "same text of five words", s, l) for s in ("a", "b", None) for l in ("en", None)] + [(1, "same text of five words", "a", "en")]
    rows += [(i, f"other text number {i}", "abc"[i % 3], "de") for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = Counter(map(tuple, repeat_rows(df).collect()))
    want = Counter()
    for r in mix(df).collect():
        want[r.source, r.doc_id] += r.copies + (r.part > 0 and r.part * 2 >= r.size)
    by_source = Counter()
    for (i, _, source, _), n in got.items():
        by_source[source, i] += n
    assert set(got) <= set(rows) and by_source == Counter({k: v for k, v in want.items() if v})
    assert {r[2:] for r in got if r[0] == 1 and r[2] is None} == {(None, "en"), (None, None)}


def test_kept_hash_is_utf8(spark):
    r = QUERIES["op1_line_dedup"](spark, SF).where("doc_id = 3").first()
    text = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id = 3").first().text
    assert r.n_dropped or r.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
