"""Title search over a trigram index, for many requests at once.

The index holds, for every three characters of the lower-cased titles (each title is followed by two blanks of its own, so that
every character begins a trigram), the ids of the titles that have them, in lists of bounded length. It lies in blocks of ids, each
some ``GROWTH`` times as large as the one before, and in a block sorted by trigram, so a search reads only the files and row groups of its trigrams.
Equal patterns are searched once, block by block: the smallest ids are the answer, so a pattern that has them is not searched for in larger blocks. A request's pattern is contained in a title whatever the case, and
``%`` and ``_`` in it act as wildcards. Its literal stretches give trigrams; the rarest few name candidate titles, and every
candidate is verified by ``ilike`` itself.

Short patterns: without three literal characters in a row, the trigrams that begin with the longest stretch (one or two characters)
give the candidates; a pattern without literal characters matches every title. Requests with a null pattern, or with a limit
outside 1..50, have no rows; a null limit is 10. Null titles are not indexed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.split import with_global_index
from marquee.session import materialize

#: Ends every title in the index; two of them fill the last trigrams.
END = "\0"
LIST_IDS, USED_GRAMS, SCAN_PATTERNS = 65_536, 3, 1000
#: Titles of the first block of ids, growth of the blocks, most titles of an answer.
FIRST_IDS, GROWTH, MOST = 4096, 4, 50


def _grams(text) -> F.Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, 3)))


def _block(bounds: list) -> F.Column:
    """The block of an id: how many bounds it reaches."""
    at = F.lit(0)
    for b in bounds:
        at = at + (F.col("movie_id") >= b).cast("int")
    return at


def build_title_index(mv: DataFrame, path: str, first_ids: int = FIRST_IDS) -> None:
    """Write the index of (movie_id, title) to a folder: ``grams`` (gram, part, ids by block), ``sizes`` (gram, n), ``titles`` and ``bounds``,
    the first id of every block but one."""
    spark = mv.sparkSession
    titles = mv.where(F.col("title").isNotNull()).select("movie_id", "title")
    titles.repartitionByRange("movie_id").sortWithinPartitions("movie_id").write.mode("overwrite").parquet(f"{path}/titles")
    titles = spark.read.parquet(f"{path}/titles")
    count = titles.count()
    parts = max(1, -(-count // LIST_IDS))
    places, at = [], first_ids
    while at < count:
        places.append(at)
        at *= GROWTH
    nth = with_global_index(titles.select("movie_id"), ["movie_id"], "nth").where(F.col("nth").isin(places)).select("movie_id")
    bounds = sorted({r["movie_id"] for r in nth.collect() if r["movie_id"] is not None}) if places else []  # some log of the titles
    spark.createDataFrame([(b,) for b in bounds], "movie_id long").coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
    text = titles.where(F.length("title") > 0).select("movie_id", F.concat(F.lower("title"), F.lit(END * 2)).alias("text"))
    rows = text.select("movie_id", F.explode(_grams(F.col("text"))).alias("gram")).where("movie_id is not null")
    lists = rows.groupBy("gram", _block(bounds).alias("block"), F.pmod(F.xxhash64("movie_id"), F.lit(parts)).cast("int").alias("part")).agg(
        F.sort_array(F.collect_list("movie_id")).alias("ids"))  # about LIST_IDS
    lists.repartitionByRange("block", "gram", "part").sortWithinPartitions("block", "gram", "part").write.mode("overwrite").partitionBy("block").parquet(f"{path}/grams")
    id_type = titles.schema["movie_id"].dataType.simpleString()
    sizes = spark.read.schema(f"gram string, ids array<{id_type}>, block int").parquet(f"{path}/grams").groupBy("gram").agg(F.sum(F.size("ids")).alias("n"))
    sizes.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/sizes")


def _hits(lists: DataFrame, sizes: DataFrame, titles: DataFrame, ask: DataFrame) -> DataFrame:
    """(q, movie_id, title): the titles of one block of ids that contain the patterns (q, parts, longest)."""
    # three characters or more: the rarest trigrams, all of which a title must have; one that the index lacks leaves no title
    of = F.flatten(F.transform(F.filter("parts", lambda s: F.length(s) >= 3), _grams))
    asked = ask.where("longest >= 3").select("q", F.explode(F.array_distinct(of)).alias("gram"))
    asked = asked.join(sizes, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = Window.partitionBy("q").orderBy("n", "gram")  # a row per trigram of a pattern
    asked = asked.withColumn("nth", F.row_number().over(rare)).where(F.col("nth") <= USED_GRAMS)
    need = asked.groupBy("q").agg(F.count(F.lit(1)).alias("need"))
    found = asked.select("q", "gram").join(lists, "gram").select("q", F.explode("ids").alias("movie_id"))
    rows = (found.groupBy("q", "movie_id").agg(F.count(F.lit(1)).alias("have")).join(need, "q")
            .where(F.col("have") == F.col("need")).select("q", "movie_id"))
    # one or two characters: they begin a trigram
    for n in (1, 2):
        stretch = F.get(F.filter("parts", lambda s: F.length(s) == n), F.lit(0)).alias("head")
        short = ask.where(F.col("longest") == n).select("q", stretch)
        one = short.join(lists.withColumn("head", F.substring("gram", 1, n)), "head").select("q", F.explode("ids").alias("movie_id")).distinct()
        rows = rows.unionByName(one)
    rows = rows.join(titles, "movie_id").where(F.expr("title ilike concat('%', q, '%')")).select("q", "movie_id", "title")
    # no literal characters: every title is a candidate, compared with blocks of patterns in one scan each
    patterns = ask.where("longest is null").select("q")
    blocks = -(-patterns.count() // SCAN_PATTERNS)
    for b in range(blocks):
        part = F.broadcast(patterns.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b))  # about SCAN_PATTERNS rows
        rows = rows.unionByName(titles.join(part, F.expr("title ilike concat('%', q, '%')")).select("q", "movie_id", "title"))
    return rows


def search_titles(spark: SparkSession, path: str, requests: DataFrame, itf: DataFrame | None = None) -> DataFrame:
    """(request_id, rank, movie_id, title[, year]) for requests (request_id, q, limit): titles that contain q, by movie_id."""
    sizes, titles = (spark.read.parquet(f"{path}/{t}") for t in ("sizes", "titles"))
    id_type = titles.schema["movie_id"].dataType.simpleString()
    grams = spark.read.schema(f"gram string, part int, ids array<{id_type}>, block int").parquet(f"{path}/grams")
    bounds = sorted(r["movie_id"] for r in spark.read.parquet(f"{path}/bounds").collect())
    req = requests.select("request_id", "q", F.coalesce("limit", F.lit(10)).alias("top")).where(f"q is not null and top between 1 and {MOST}")
    req = materialize(req, "title-requests")
    parts = F.filter(F.split(F.lower("q"), r"[%_\\\\]"), lambda s: F.length(s) > 0)
    ask = req.groupBy("q").agg(F.max("top").alias("top")).withColumn("parts", parts)
    ask = materialize(ask.withColumn("longest", F.array_max(F.transform("parts", F.length))), "title-patterns")
    found = None
    for n in range(len(bounds) + 1):
        here = _hits(grams.where(F.col("block") == n).drop("block"), sizes, titles.where(_block(bounds) == n), ask)
        first = here.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy("movie_id"))).where(F.col("nth") <= MOST).drop("nth")
        first = materialize(first, "title-hits")
        found = first if found is None else found.unionByName(first)
        have = found.groupBy("q").agg(F.count(F.lit(1)).alias("have"))
        if n == len(bounds):
            break
        ask = materialize(ask.join(have, "q", "left").where(F.coalesce("have", F.lit(0)) < F.col("top")).drop("have"), "title-patterns")
        if ask.isEmpty():
            break
    by_id = Window.partitionBy("request_id").orderBy("movie_id")
    rows = req.join(found, "q").select("request_id", "top", "movie_id", "title")
    out = rows.withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= F.col("top")).select("request_id", "rank", "movie_id", "title")
    return out if itf is None else out.join(itf.select("movie_id", F.col("release_year").alias("year")), "movie_id", "left")
