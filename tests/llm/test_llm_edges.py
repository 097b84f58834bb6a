"""Large ids beside null ones, hot ids, very long texts, and work that is dealt to several tasks."""
import hashlib
import random
from collections import Counter

import pytest
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from marquee.llm import mixing
from marquee.llm.line_dedup import line_dedup
from marquee.llm.quality import score_documents
from marquee.llm.secrets import scan_secrets, secret_spans
from marquee.llm.simhash import fingerprint_links
from marquee.llm.warc import digest, read_records, read_tasks, write_archives
from marquee.llm.winnow import Ranges, edited_fingerprints, next_texts

BIG = 2**60


def text_hash(t):
    h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    return h - 2**64 if h >> 63 else h


def in_order(rows):
    """(id, text) in the operator's descending order."""
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1])), reverse=True)


def test_next_texts_with_large_null_and_hot_ids(spark):
    """41 ids above 2**53 with a null one, a third of the rows on one id, a third on none, equal rows among them."""
    rng = random.Random(1)
    rows = [(BIG + i, f"text {i}") for i in range(400)] + [(7, f"hot {rng.random()} " * rng.randrange(4)) for _ in range(500)]
    rows += [(None, f"none {rng.random()}") for _ in range(400)] + [(9, "the same")] * 60 + [(None, None)] * 5 + [(-(2**63), "least")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = next_texts(df, lambda r, n: (r[0], r[1], n[0], n[1]), "i long, t string, ni long, nt string").collect()
    want = in_order(rows)
    assert Counter(map(tuple, got)) == Counter((*a, *b) for a, b in zip(want, want[1:] + want[:1]))


@pytest.mark.parametrize("hot", [5, None])
def test_a_hot_id_is_dealt_to_many_tasks(spark, hot):
    rows = [(hot, f"text {i}") for i in range(6000)] + [(100 + i, f"other {i}") for i in range(12_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    tasks = Counter(r.task for r in next_texts(df, lambda r, n: (TaskContext.get().partitionId(),), "task int").collect())
    assert sum(tasks.values()) == len(rows) and max(tasks.values()) < 2 * len(rows) / 8


def test_ranges_place_every_row_once():
    rng = random.Random(2)
    heads = sorted({(rng.random() < 0.8, rng.choice([0, 3, BIG]), rng.randrange(-9, 9)) for _ in range(12)}, reverse=True)
    heads = [(k, i if k else 0, h) for k, i, h in heads]
    ranges = Ranges(sorted(set(heads)))
    rows = [h for h in ranges.heads] + [h for h in ranges.heads for _ in range(1)]
    import numpy as np
    at, head = ranges.place(*(np.array(c) for c in zip(*rows)))
    assert at.tolist() == list(range(len(ranges.heads))) * 2 and head.all()


def test_fingerprints_of_large_ids_and_a_long_text(spark):
    long = "".join(random.Random(3).choices("abcdefgh ", k=3_000_000))
    rows = [(BIG + i, f"text number {i} " * 9) for i in range(40)] + [(None, "none"), (BIG + 99, long)]
    got = {r.doc_id: r for r in edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert set(got) == {i for i, _ in rows}
    order = in_order(rows)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        third = len(t) // 3
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256((t[:len(t) - third] + n[:third]).encode()).hexdigest())


def test_archives_of_large_ids_and_a_long_payload(spark):
    rows = [(BIG + i if i != 3 else None, f"u{i}", f"payload {i % 30}") for i in range(41)] + [(BIG + 50, "long", "é<p>" * 1_500_000)]
    index = write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6))
    first = {}
    for i, _, h in rows:
        first[h] = min(first.get(h, 2**63), 2**63 if i is None else i)
    want = Counter((i, digest(h.encode()), "response" if i == first[h] else "revisit", None if i == first[h] else first[h]) for i, _, h in rows)
    assert Counter((r.id, r.payload_digest, r.record_type, r.refers_to) for r in read_records(index, payloads=False).collect()) == want


def test_archives_are_read_by_several_tasks(spark):
    rows = [(i, f"u{i}", f"{i} " * 400) for i in range(300)]
    index = write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8), roll_bytes=2000)
    files = index.select("file").distinct().count()
    assert files > 8 and read_tasks(index) == 8 and read_tasks(index, task_bytes=1000) > 20
    tasks = Counter(r.p for r in read_records(index).select(F.spark_partition_id().alias("p")).collect())
    assert len(tasks) == 8 and max(tasks.values()) < 3 * 300 / 8


def test_key_expansion_is_dealt_to_all_tasks(spark, tmp_path):
    spark.range(4000).select(F.xxhash64("id").alias("fp")).coalesce(1).write.parquet(str(tmp_path / "fp"))
    plan = fingerprint_links(spark.read.parquet(str(tmp_path / "fp")))._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_mixing_spreads_one_id(spark):
    rows = [(7, f"words of text {i} " * (i % 5 + 1), "a") for i in range(600)] + [(None, f"no id {i}", "a") for i in range(300)] + [(i, "x y z", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    buckets = Counter(r[0][:1] for r in df.where("doc_id = 7 or doc_id is null").select(mixing.order_key("doc_id", "text", "s")).collect())
    assert len(buckets) == 16 and max(buckets.values()) < 2 * 900 / 16
    out = mixing.mix(df)
    assert out.count() == len(rows)
    taken = {r.source: (r.t, r.target) for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("target")).collect()}
    assert all(abs(t - target) <= 1 for t, target in taken.values())


def test_a_row_repeated_very_often_is_no_array(spark, monkeypatch):
    monkeypatch.setattr(mixing, "REPEAT", 7)
    rows = [(1, "one row of the corpus", "a")] * 50 + [(i, "other words here", "b") for i in range(2, 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = {}
    for r in mixing.mix(df).collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + r.copies + (r.part > 0 and 2 * r.part >= r.size)
    out = mixing.repeat_rows(df)
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in times.items() if v})
    assert "array_repeat" not in out._jdf.queryExecution().toString()


def test_ownership_does_not_follow_the_number_of_repositories(spark):
    own, short, plain, shared = "9f8e7d6c5b4a39281706f5e4", "Tr7kPq2x", "password1", "0a9b8c7d6e5f40312233aabb"
    rows = [(i, f"token = {own} password: {short} secret={plain} api_key=changeme-1a2b3c4d", "alice") for i in range(40)]
    rows += [(100 + i, f"token = {shared}", f"o{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for part in (df, df.where("doc_id < 3 or doc_id >= 100")):
        got = {r.doc_id: r for r in scan_secrets(part).collect()}
        live = [s for s in got[0].spans.split(",") if s.startswith("live:")]
        at = [rows[0][1].index(x) for x in (own, short, plain)]
        assert live == [f"live:{a}:{a + len(x)}" for a, x in zip(at, (own, short, plain))]  # the placeholder's token is not live
        assert all(got[100 + i].n_live == 0 for i in range(3))
    spans = secret_spans(df)[1].where(F.col("vhash") == hashlib.sha256(own.encode()).hexdigest()).first()
    assert (spans.n_owners, spans.n_repos) == (1, 40)


@pytest.mark.parametrize("value, live", [("abc123", True), ("aaaa11", False), ("12345678", False), ("abcdefgh", False), ("1234567890abcdefABCDEF", True),
                                         ("x1234-abc987", True), ("abq-1234-xyz9", False), ("my-example-key-77aB", False), ("examples99xyzwq", False), ("zq0000Xw81mk", True)])
def test_generated_looking_values(spark, value, live):
    df = spark.createDataFrame([(1, f"secret={value}", "o")], "doc_id long, text string, source string")
    assert scan_secrets(df).first().n_live == int(live)


def test_very_long_texts(spark):
    """Several MB in one document beside short ones, for the operators that the other tests give short texts only."""
    line = "this line is long enough to be a candidate for removal, number "
    long = "\n".join(f"{line}{i % 3}" for i in range(50_000)) + "\ntoken = 9f8e7d6c5b4a39281706f5e4"
    rows = [(BIG, long, "a", len(long))] + [(i, f"{line}1\nown line {i}", "ab"[i % 2], None) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    cut = {r.doc_id: r for r in line_dedup(df).collect()}
    assert cut[BIG].n_lines == 50_001 and cut[BIG].n_dropped == 0 and cut[0].n_dropped == 1 and cut[0].kept_text == "own line 0"
    spans = {r.doc_id: r.base for r in scan_secrets(df).collect()}
    assert spans[BIG].startswith(f"assign:{len(long) - 32}:")
    mixed = {r.doc_id: r.size for r in mixing.mix(df).collect()}
    assert mixed[BIG] == len(long.split())
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in score_documents(df, labels).collect())
