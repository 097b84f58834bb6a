"""Corpus pipeline: documents to token ids in five stages, each on all that its predecessor kept.

Every function takes (spark, docs, sf_dir); all but the last return the columns of documents, in their order. A stage's result
is written as Parquet and read again as the next one's docs. Part of the training-data subpackage.

Edge cases, in every stage: a null text is empty (a stage that rewrites texts makes it one, the others hand it on as it is); a null id is an id
of its own; very long texts are worked on whole; equal rows are treated alike (near-duplicate removal keeps one, mixing repeats them together);
an empty table gives an empty table. Columns beside doc_id, text, source and n_chars travel as one struct around every operator, so they may
have any names, those of an operator's results among them, and keep their values; the mixing stage hashes them to tell rows apart. Texts
without words have a score like any other, no lines to drop, equal fingerprints, no share of the mix (so they end there) and no tokens.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import quoted, table
from marquee.llm.line_dedup import line_dedup
from marquee.llm.mixing import repeat_rows
from marquee.llm.pieces import encode_documents
from marquee.llm.quality import score_documents
from marquee.llm.simhash import one_of_each
from marquee.session import materialize

#: SimHash stage, as in its contract: words of a shingle, differing bits of a link.
SHINGLE, MAX_BITS = 4, 4


def beside(docs: DataFrame, *but: str) -> Column:
    """The columns of docs but those named, as one struct out of the way of an operator's own (doc_id is always in it)."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns if c not in but]).alias("__row")


def restored(out: DataFrame, docs: DataFrame, **own: Column) -> DataFrame:
    """The columns of docs in their order: own ones, the others from the struct."""
    return out.select(*[own[c].alias(c) if c in own else F.col("__row")[c].alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of at least 0.3). Ties: a score equal to the threshold is accepted."""
    scored = score_documents(docs.select("doc_id", "text", "n_chars", beside(docs, "text", "n_chars")), table(spark, sf_dir, "labels"))
    return restored(scored.where("predicted = 1"), docs, text=F.col("text"), n_chars=F.col("n_chars"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; n_chars follows the text."""
    out = line_dedup(docs.select("doc_id", "text", beside(docs, "text", "n_chars")), carry=("__row",))
    return restored(out, docs, text=F.col("kept_text"), n_chars=F.length("kept_text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest id (of equal ids, of the smallest text hash)."""
    return one_of_each(docs, SHINGLE, MAX_BITS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, in seeded order; equal rows have no order and need none."""
    return repeat_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of every row; other columns end here."""
    out = encode_documents(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"), decoded=None)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("mixing sources", mixture), ("SentencePiece encoding", tokens)]

#: The classifier is trained, so SQL cannot give the rows; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
