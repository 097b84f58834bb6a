"""The registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import oracles
from marquee.llm.common import WORD, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def sha256(col: str):
    return F.sha2(F.col(col), 256)


@query("op1_line_dedup", oracles.LINE_DEDUP)
def op1(spark, d):
    from marquee.llm.line_dedup import line_dedup
    out = line_dedup(table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256("kept_text").alias("kept_sha256"))


@query("op8_secret_scans", oracles.SECRET_SCANS)
def op8(spark, d):
    from marquee.llm.secrets import scan_secrets
    out = scan_secrets(table(spark, d, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", sha256("base").alias("base_sha256"), "spans")


@query("op10_mixing", oracles.MIXING)
def op10(spark, d):
    from marquee.llm.mixing import mix
    return mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_quality_classifier")
def op2(spark, d):
    from marquee.llm.quality import score_documents
    out = score_documents(table(spark, d, "documents"), table(spark, d, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op4_document_fingerprints")
def op4(spark, d):
    from marquee.llm.winnow import edited_fingerprints
    return edited_fingerprints(table(spark, d, "documents"))


@query("op5_sentencepiece")
def op5(spark, d):
    import public_tokenizers

    from marquee.llm.pieces import token_digests
    return token_digests(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op7_html_extraction")
def op7(spark, d):
    from marquee.llm.html_text import extract_pages
    out = extract_pages(table(spark, d, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op3_warc", oracles.WARC)
def op3(spark, d):
    from marquee.llm.warc import read_records, write_archives
    out = read_records(write_archives(table(spark, d, "pages")), payloads=False)
    return out.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_simhash_near_dedup")
def op6(spark, d):
    from marquee.llm.simhash import near_groups
    out = near_groups(table(spark, d, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_exact_top_k", oracles.TOP_K)
def op9(spark, d):
    from marquee.llm.vector_search import exact_top_k
    vectors = table(spark, d, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("op11_token_counts")
def op11(spark, d):
    import public_tokenizers

    from marquee.llm.token_counts import count_tokens
    return count_tokens(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def stretched(text, doc_id):
    """The contract's texts: of every tenth document, by the CRC-32 of its id, the words from one place on repeat a few of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.nullif(F.size(words).cast("long"), F.lit(0))
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    tail = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int")))
    return F.when((h % 10 == 0) & (F.regexp_count(text, F.lit(WORD)) > 0), F.array_join(made, " ")).otherwise(text)


@query("op12_periodic_runs")
def op12(spark, d):
    from marquee.llm.run_detection import find_runs
    docs = table(spark, d, "documents").select("doc_id", stretched(F.col("text"), F.col("doc_id")).alias("text"))
    out = find_runs(docs, keep=("doc_id",))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("back"), (-r.period).alias("low"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                     sha256("collapsed").alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.low")
    thousand = F.lit(1000) * length
    return out.select("doc_id", "n_runs", (-F.col("best.back")).alias("start"), length.alias("length"), period.alias("period"),
                      ((thousand - thousand % period) / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query("op13_centroid_clustering", oracles.CLUSTERS)
def op13(spark, d):
    from marquee.llm.centroids import cluster_vectors
    out = cluster_vectors(table(spark, d, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string"))), 256).alias("centroid_sha256"))
