"""Shared pieces of the training-data operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space of the contracts, ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
#: One word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    """A column's name as F.col takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def text_of(col: str) -> Column:
    """The column's text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character untouched."""
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
