r"""Line dedup: explode lines, hash their normalised form, count distinct documents per hash, drop frequent lines.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at least ``min_chars``
code points found in at least ``min_docs`` documents lose all their lines, except in the document of the largest id that
holds the key. The other lines stay in their order, joined by ``\n``.

Plan (SQL functions only): hashes of the long lines are written once as a narrow table (id, text hash, position, 128 bits
of key); distinct documents per key come from two partial aggregations; the frequent keys are written too, so the
join that finds the dropped lines has an exchange on both sides and a line that every document holds is split by AQE's
skew join. Only the positions to drop travel to the documents; whole texts are shuffled once, by document.

Edge cases: a null or empty text is one empty line; a null id is no document in the counts and never the largest id, so its
frequent lines go; rows that share an id are one document for the counts and are cut separately; ties cannot arise, as the
largest id is one document. Texts of any length are cut whole: lines become rows, and a document's own lines are the only array that is
held. An empty table gives an empty table. Extra columns are ignored unless named in ``carry``; of a carried column named like a result the
result is returned.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACES, ascii_lower, quoted, text_of
from marquee.session import materialize


RESULTS = ("n_lines", "n_dropped", "kept_text")


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40) -> DataFrame:
    """One row per line whose key has min_chars code points: (id, tk, pos, h1, h2); tk tells texts of one id apart."""
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    lines = base.select("id", F.xxhash64("t").alias("tk"), F.posexplode(F.split("t", "\n", -1)).alias("pos", "line"))
    keys = (lines.withColumn("line", F.btrim("line", F.lit(SPACES))).where(F.length("line") >= min_chars)
            .withColumn("line", ascii_lower(F.col("line"))))
    return keys.select("id", "tk", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def frequent_keys(lines: DataFrame, min_docs: int = 5) -> DataFrame:
    """Keys in at least min_docs distinct documents, with the largest document id of each."""
    per_doc = lines.select("h1", "h2", "id").distinct()
    return (per_doc.groupBy("h1", "h2").agg(F.count("id").alias("n_docs"), F.max("id").alias("keep_id"))
            .where(F.col("n_docs") >= min_docs))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
               min_docs: int = 5, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) per document, plus the carried columns of the input."""
    lines = materialize(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    frequent = materialize(frequent_keys(lines, min_docs), "frequent-lines")
    dropped = (lines.join(frequent, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keep_id")))
               .groupBy("id", "tk").agg(F.sort_array(F.collect_set("pos")).alias("drop_pos")))
    # drop_flag[i] tells whether line i goes; it ends at the last dropped line
    gap = F.transform("drop_pos", lambda p, i: F.concat(
        F.array_repeat(F.lit(False), p - F.when(i == 0, F.lit(-1)).otherwise(F.get("drop_pos", i - 1)) - 1),
        F.array(F.lit(True))))
    dropped = dropped.select(F.col("id").alias("d_id"), F.col("tk").alias("d_tk"),
                             F.size("drop_pos").cast("long").alias("n_dropped"), F.flatten(gap).alias("drop_flag"))
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"),
                       F.struct(*[F.col(quoted(c)) for c in carry]).alias("carried") if carry else F.lit(0).alias("carried"))
    base = base.withColumn("tk", F.xxhash64("t"))
    both = base.join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("tk") == F.col("d_tk")), "left")
    split = F.split("t", "\n", -1)
    kept = F.array_join(F.filter(split, lambda x, i: ~F.coalesce(F.get("drop_flag", i), F.lit(False))), "\n")
    return both.select(
        F.col("id").alias(id_col), F.size(split).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop_flag").isNull(), F.col("t")).otherwise(kept).alias("kept_text"),
        *[F.col("carried")[c].alias(c) for c in carry if c not in (id_col, *RESULTS)])
