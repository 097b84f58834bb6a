"""Readers for the rating/movie/tag/link/genome file layouts, always with an explicit schema."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.vocab import NO_GENRES, PANDAS_NA
from marquee.operators.merge import drop_null_keys
from marquee.sources.quoted import quoted_records

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RATINGS = _schema(("user_id", I), ("movie_id", I), ("rating", D), ("timestamp", L))
MOVIES = _schema(("movie_id", I), ("title", S), ("genres", S))
TAGS = _schema(("user_id", I), ("movie_id", I), ("tag", S), ("timestamp", L))
LINKS = _schema(("movie_id", I), ("imdb_id", S), ("tmdb_id", S))
GENOME = _schema(("movie_id", I), ("tag_id", I), ("relevance", D))
ITEM_PIPE = _schema(("movie_id", I), ("title", S))

# header names in the modern CSV layout -> our column names
HEADER_NAMES = {"userId": "user_id", "movieId": "movie_id", "imdbId": "imdb_id", "tmdbId": "tmdb_id",
                "tagId": "tag_id"}


CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool):
    """RFC 4180 quoting: a doubled quote inside a quoted field is a quote."""
    return (spark.read.option("sep", sep).option("escape", '"').option("encoding", encoding).option("mode", "PERMISSIVE")
            .option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT))


def _broken(df: DataFrame) -> F.Column:
    """Whether a record does not parse in any of its fields. A scan only parses the columns that a query uses, so the test
    uses all of them (through a hash that is always in range): a record is broken or not whatever is selected later."""
    fields = [F.col(f"`{c}`") for c in df.columns if c != CORRUPT]
    return F.col(CORRUPT).isNotNull() & (F.xxhash64(*fields) >= F.lit(-(1 << 63)).cast("long"))


def header_of(spark: SparkSession, path, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    return _reader(spark, sep, encoding, False).option("header", True).csv(path).columns


def require_columns(spark: SparkSession, path, needed: list[str], sep: str = ",") -> list[str]:
    """Our names of a file's columns, in file order; raise naming the needed ones that are missing and those found."""
    found = [HEADER_NAMES.get(c.strip(), c.strip()) for c in header_of(spark, path, sep)]
    missing = [c for c in needed if c not in found]
    if missing:
        raise ValueError(f"missing columns {missing}; found {found}")
    return found


def _by_name(spark: SparkSession, path, schema: T.StructType, optional: tuple[str, ...] = (), multi_line: bool = False,
             bad: bool = False) -> DataFrame:
    """Columns by their header names, whatever their order; other columns are ignored, optional ones may be absent (null).

    Files read together must share one header (Spark checks each). Records that do not parse are left out; bad=True gives
    those instead, with their raw text."""
    found = require_columns(spark, path, [f.name for f in schema if f.name not in optional])
    types = {f.name: f.dataType for f in schema}
    file_schema = T.StructType([T.StructField(h, types.get(n, S)) for h, n in zip(header_of(spark, path), found)]
                               + [T.StructField(CORRUPT, S)])
    df = _reader(spark, ",", "UTF-8", multi_line).schema(file_schema).option("header", True).option("enforceSchema", False).csv(path)
    at = {n: F.col(f"`{h}`") for h, n in zip(file_schema.names, found)}
    cols = [at.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.where(_broken(df)).select(*cols, CORRUPT) if bad else df.where(~_broken(df)).select(*cols)


#: File, split and row of a record, for readers whose rows have lost the scan's own metadata.
PLACE = ("_file", "_start", "_row")


def _by_record(spark: SparkSession, path, schema: T.StructType, bad: bool = False, located: bool = False) -> DataFrame:
    """As _by_name for files whose quoted fields hold line breaks, in splits (sources.quoted); ``located`` adds PLACE."""
    found = require_columns(spark, path, schema.names)
    header = header_of(spark, path)
    types = {f.name: f.dataType for f in schema}
    file_schema = T.StructType([T.StructField(f"_{i}", types.get(n, S)) for i, n in enumerate(found)] + [T.StructField(CORRUPT, S)])
    options = {"sep": ",", "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    records = quoted_records(spark, path, header)
    place = [F.col(c).alias(p) for c, p in zip(("file", "start", "row"), PLACE)]
    parsed = records.select(*place, F.from_csv("value", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in file_schema), options).alias("r"))
    rows = parsed.select(*PLACE, "r.*")
    ok = rows.drop(*PLACE)
    cols = [F.col(f"_{found.index(f.name)}").alias(f.name) for f in schema]
    keep = [*cols, *(PLACE if located else ())]
    return rows.where(_broken(ok)).select(*keep, CORRUPT) if bad else rows.where(~_broken(ok)).select(*keep)


def _by_place(spark: SparkSession, path, schema: T.StructType, sep: str, encoding: str = "UTF-8", bad: bool = False) -> DataFrame:
    """Files without a header: fields in the layout's order. Records that do not parse as with _by_name."""
    df = _reader(spark, sep, encoding, False).schema(T.StructType([*schema, T.StructField(CORRUPT, S)])).csv(path)
    return df.where(_broken(df)) if bad else df.where(~_broken(df)).select(*schema.names)


def _na_to_null(col: str) -> F.Column:
    return F.when(F.col(col).isin(PANDAS_NA), F.lit(None).cast("string")).otherwise(F.col(col))


def read_ratings_csv(spark, path, bad: bool = False) -> DataFrame:
    return _by_name(spark, path, RATINGS, bad=bad)


def read_movies_csv(spark, path, pandas_na: bool = False, multi_line: bool = True, bad: bool = False, located: bool = False) -> DataFrame:
    """Titles may hold quoted line breaks, so records may span lines; files are read in splits all the same. Files known to have
    none can be read with multi_line=False, which needs no pass for the quotes."""
    df = _by_record(spark, path, MOVIES, bad, located) if multi_line else _by_name(spark, path, MOVIES, bad=bad)
    return df.withColumn("title", _na_to_null("title")) if pandas_na else df


def read_tags_csv(spark, path, pandas_na: bool = True, multi_line: bool = True, bad: bool = False, located: bool = False) -> DataFrame:
    """Tags may hold quoted line breaks, so records may span lines, as with read_movies_csv."""
    df = _by_record(spark, path, TAGS, bad, located) if multi_line else _by_name(spark, path, TAGS, bad=bad)
    if bad:
        return df
    if pandas_na:
        df = df.withColumn("tag", _na_to_null("tag"))
    return drop_null_keys(df, ["tag"])


def read_links_csv(spark, path, bad: bool = False) -> DataFrame:
    """Ids as text, so leading zeros stay; a missing id column reads as null; 'nan' text is null."""
    df = _by_name(spark, path, LINKS, optional=("imdb_id", "tmdb_id"), bad=bad)
    return df.withColumn("imdb_id", F.nullif(F.col("imdb_id"), F.lit("nan"))).withColumn("tmdb_id", F.nullif(F.col("tmdb_id"), F.lit("nan")))


def read_genome_csv(spark, path, bad: bool = False) -> DataFrame:
    return _by_name(spark, path, GENOME, bad=bad)


def read_ratings_dat(spark, path, bad: bool = False) -> DataFrame:
    return _by_place(spark, path, RATINGS, "::", "ISO-8859-1", bad)


def read_movies_dat(spark, path, bad: bool = False) -> DataFrame:
    return _by_place(spark, path, MOVIES, "::", "ISO-8859-1", bad)


def read_ratings_tab(spark, path, bad: bool = False) -> DataFrame:
    return _by_place(spark, path, RATINGS, "\t", bad=bad)


def read_movies_pipe(spark, path, bad: bool = False) -> DataFrame:
    """u.item layout: first two of many columns; every title gets the no-genres token; lines without a movie id are bad."""
    df = _reader(spark, "|", "ISO-8859-1", False).schema(ITEM_PIPE).csv(path)
    if bad:
        return df.where(F.col("movie_id").isNull()).withColumn(CORRUPT, F.col("title"))
    return df.filter(F.col("movie_id").isNotNull()).withColumn("genres", F.lit(NO_GENRES))


# (file name, table, layout) -> reader
READERS = {
    "ratings.csv": ("ratings", read_ratings_csv), "movies.csv": ("movies", read_movies_csv),
    "tags.csv": ("tags", read_tags_csv), "links.csv": ("links", read_links_csv),
    "genome-scores.csv": ("genome_scores", read_genome_csv),
    "ratings.dat": ("ratings", read_ratings_dat), "movies.dat": ("movies", read_movies_dat),
    "u.data": ("ratings", read_ratings_tab), "u.item": ("movies", read_movies_pipe),
}

# the stream and the stages read a table's own layout with these
TABLE_READERS = {t: r for n, (t, r) in READERS.items() if n.endswith(".csv")}

def read_located(reader, spark: SparkSession, path) -> DataFrame:
    """A reader's rows with what merge.arrival_ids needs to number them in file order."""
    return reader(spark, path, located=True) if reader in (read_movies_csv, read_tags_csv) else reader(spark, path)


CONFLICT_KEYS = {
    "ratings": ["user_id", "movie_id"], "movies": ["movie_id"],
    "tags": ["user_id", "movie_id", "tag", "timestamp"], "links": ["movie_id"],
    "genome_scores": ["movie_id", "tag_id"],
}


def ingest_report(offered: dict[str, DataFrame], skipped: dict[str, str] | None = None,
                  errors: dict[str, str] | None = None) -> DataFrame:
    """Rows offered per table plus a total; ok iff ratings and movies were both ingested.

    Skipped files and errors are small driver-side dicts (file name -> reason), returned as extra rows.
    """
    ok = F.lit("ratings" in offered and "movies" in offered)
    parts = [df.agg(F.count(F.lit(1)).alias("rows_offered"))
             .select(F.lit(name).alias("table_name"), "rows_offered") for name, df in offered.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.sum("rows_offered").alias("rows_offered")).select(F.lit("total").alias("table_name"),
                                                                      "rows_offered")
    report = out.unionByName(total).withColumn("ok", ok)
    extra = [(f"skipped:{k}", v) for k, v in (skipped or {}).items()] + \
            [(f"error:{k}", v) for k, v in (errors or {}).items()]
    if extra:
        spark = report.sparkSession
        notes = spark.createDataFrame(extra, "table_name string, note string")
        report = report.unionByName(notes, allowMissingColumns=True)
    return report


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, encoding: str = "UTF-8") -> None:
    """Write in the same dialect the readers expect."""
    (df.write.option("header", header).option("sep", sep).option("escape", '"').option("encoding", encoding)
     .csv(path))
