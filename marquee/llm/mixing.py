"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Sources in order of code points (null last) weigh 3, 1, 2, 3, 1, 2, ... and share ``budget`` times all words by weight. A
source stops at ``max_epochs`` times its own words; what it cannot take goes to the others by weight, until none is above.
A source of rate r = target / words takes every document floor(r) times, and the rest of its target from the documents in
seeded order: whole ones as long as they fit, then a part of the one at the edge. So each source meets its target to
within one word, whatever its size, and no document exceeds ceil(r) times its words.

Plan (SQL functions only): words are counted in the scan; everything after is narrow (id, source, size, order key). Sources
are aggregated with partial sums, numbered by a range-partitioned global index (no single-task window), and the water
level is found by repeated one-row aggregates over the source table, one round per set of newly clamped sources. The seeded
order is cut in hash buckets of id and text: sums per (source, bucket) give each bucket's place, and only documents of the bucket at
the edge are ordered exactly, so neither a source nor an id holding a third of the rows is a single group.

Edge cases: a null text has size 0; very long texts are counted whole in the scan; null is a source of its own, last; documents of size 0 take nothing; rows that share id
and text stand in any order, as they are interchangeable, or by ``row_key`` where it is given; a source without words has target 0; an empty
table gives an empty table. Columns named like the results are only returned when named in ``carry``, and the operator's
own columns win.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from marquee.llm.common import quoted, text_of, word_count
from marquee.operators.split import with_global_index
from marquee.session import materialize

WEIGHTS = (3, 1, 2)
SEED = "mix-1"
BUCKET_DIGITS = 3  # 4096 hash buckets in each source
REPEAT = 4096


def order_key(id_col: str, text_col: str, seed: str) -> Column:
    """Seeded place of a document: MD5 of seed, id and text, the same in every run; rows of one id stand apart."""
    own = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), own).cast("binary"))


def water_fill(sources: DataFrame, total: int, max_epochs: int = 2, rounds: int | None = None) -> DataFrame:
    """sources(source, weight, source_size) plus target: total shared by weight, no source above its cap.

    Every round clamps the sources whose share reaches their cap and shares the rest anew; the level only rises,
    so a clamped source stays clamped and the rounds end. The driver holds one level, not the sources."""
    cap = F.col("source_size") * max_epochs
    level, n = 0.0, 0
    while True:
        clamped = cap <= F.col("weight") * F.lit(level) if n else F.lit(False)
        r = sources.agg(F.sum(F.when(clamped, cap).otherwise(0)).alias("taken"), F.sum(clamped.cast("long")).alias("k"),
                        F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("free")).first()
        free, taken, k = r["free"] or 0, r["taken"] or 0, r["k"] or 0
        if not free:
            return sources.withColumn("target", cap.cast("double"))
        nxt = (total - taken) / free
        done = n and k == last
        level, last, n = (level if done else nxt), k, n + 1
        if done or (rounds and n >= rounds):
            break
    return sources.withColumn("target", F.when(cap <= F.col("weight") * F.lit(level), cap.cast("double"))
                              .otherwise(F.col("weight") * F.lit(level)))


def source_targets(sized: DataFrame, budget: tuple[int, int] = (3, 2), max_epochs: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, size); budget is a fraction of all words."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("last", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    s = with_global_index(s, ["last", "name"], "nth")
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("nth") % len(WEIGHTS)).cast("int")).cast("long")
    s = s.select("source", "source_size", weight.alias("weight"))
    words = s.agg(F.sum("source_size")).first()[0] or 0
    return water_fill(s, words * budget[0] / budget[1], max_epochs).select("source", "source_size", "target")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED, budget: tuple[int, int] = (3, 2), max_epochs: int = 2, row_key: Column | None = None) -> DataFrame:
    """Per row: id, text_key, size, source_size, target, copies (whole repetitions), part (words of one more), taken, and
    row_key if given."""
    extra_key = [] if row_key is None else ["row_key"]
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        word_count(text_of(text_col)).alias("size"), order_key(id_col, text_col, seed).alias("key"),
                        F.xxhash64(text_of(text_col)).alias("text_key"), *[row_key.alias(k) for k in extra_key])
    sized = materialize(sized.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)), "mix-sizes")
    targets = materialize(source_targets(sized, budget, max_epochs), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate).cast("long")
    targets = targets.select(F.col("source").alias("t_source"), "source_size", "target", whole.alias("whole"),
                             F.round(F.col("target") - whole * F.col("source_size")).cast("long").alias("rest"))
    # where each bucket begins in its source's seeded order; at most 4096 rows a source
    w = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = (sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
               .withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0))))
    buckets = buckets.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
    buckets = materialize(buckets.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "source_size",
                                         "target", "whole", "rest", "words", "before"), "mix-buckets")
    rows = sized.join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    at_edge = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    sure = rows.where(~at_edge).withColumn("extra", F.when(F.col("before") < F.col("rest"), F.col("size")).otherwise(0))
    inside = W.partitionBy("source", "bucket").orderBy("key", "id", "text_key", *extra_key).rowsBetween(W.unboundedPreceding, -1)
    edge = rows.where(at_edge).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    edge = edge.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead")))).drop("ahead")
    full = F.col("whole") + F.when((F.col("extra") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)
    return sure.unionByName(edge).select(
        F.col("id").alias(id_col), "text_key", F.col("source").alias(source_col), "size", "source_size", "target", full.alias("copies"),
        F.when(F.col("extra") == F.col("size"), 0).otherwise(F.col("extra")).cast("long").alias("part"),
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"), *extra_key)


def rest_key(docs: DataFrame, *but: str) -> Column:
    """Hash of all columns but those named; nulls count, and what xxhash64 does not take is hashed as JSON."""
    kinds = [(c, kind) for c, kind in docs.dtypes if c not in but]
    values = [F.to_json(F.struct(F.col(quoted(c)))) if "map<" in kind or "variant" in kind else F.col(quoted(c)) for c, kind in kinds]
    return F.xxhash64(*[x for v in values for x in (v.isNull(), v)])


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """docs with every row as often as the mix takes it, in whole documents: the one at the edge of a source's target is
    taken once more if at least half of it fits."""
    others = rest_key(docs, id_col, text_col)  # source among them
    mixed = mix(docs, id_col, text_col, source_col, row_key=others, **how)
    times = F.col("copies") + F.when((F.col("part") * 2 >= F.col("size")) & (F.col("part") > 0), 1).otherwise(0)
    mixed = mixed.groupBy(F.xxhash64(id_col).alias("__k"), F.col("text_key").alias("__tk"), F.col("row_key").alias("__rk"))
    mixed = mixed.agg(F.sum(times).cast("long").alias("__n"))
    row = docs.select(F.xxhash64(id_col).alias("__k"), F.xxhash64(text_of(text_col)).alias("__tk"), others.alias("__rk"),
                      F.struct("*").alias("__row"))
    # equal rows share all keys; their repetitions are added up
    keys = ["__k", "__tk", "__rk"]
    row = row.join(materialize(mixed.where("__n > 0"), "mix-repeats"), keys).dropDuplicates(keys)
    # repetitions in two steps of numbers, not as an array of rows: however often a row is taken, it is held once
    row = row.select("__row", "__n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / REPEAT))).alias("__many"))
    left = F.least(F.lit(REPEAT).cast("long"), F.col("__n") - F.col("__many") * REPEAT)
    return row.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("__one")).select("__row.*")
