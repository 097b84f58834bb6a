"""File-reader and discovery queries: a fixture view is written in a file layout under the shared
scratch folder, then read back with the reader; the oracle is the view itself."""
from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.vocab import PANDAS_NA
from marquee.session import scratch_path
from marquee.sources import discover as dv
from marquee.sources import files as fl
from marquee.sources import fixtures as fx
from marquee.operators.merge import drop_null_keys
from marquee.plans.catalog import query
from marquee.plans.oracle_views import with_views as W

_NA_SQL = "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in PANDAS_NA) + ")"


def _genome(spark, d):
    lab = fx.table(spark, d, "labels")
    return lab.select(F.col("doc_id").cast("int").alias("movie_id"), (F.col("quality") + 1).cast("int").alias("tag_id"),
                      (F.lit(0.25) + F.col("toxic") * F.lit(0.5)).alias("relevance"))


_GENOME_SQL = ("fx_genome", "select cast(doc_id as int) as movie_id, cast(quality + 1 as int) as tag_id, "
                            "0.25e0 + toxic * 0.5e0 as relevance from labels")


def _ratings_out(spark, d):
    return fx.fx_ratings(spark, d).select(F.col("user_id").alias("userId"), F.col("movie_id").alias("movieId"),
                                          "rating", "timestamp")


@query("read_ratings_csv", W("fx_ratings") + "select user_id, movie_id, rating, timestamp from fx_ratings")
def q_read_ratings_csv(spark, d):
    p = scratch_path(spark, "ratings.csv")
    fl.write_csv(_ratings_out(spark, d), p)
    return fl.read_ratings_csv(spark, p)


@query("read_movies_csv", W("fx_movies") + "select movie_id, title, genres from fx_movies")
def q_read_movies_csv(spark, d):
    p = scratch_path(spark, "movies.csv")
    fl.write_csv(fx.fx_movies(spark, d).withColumnRenamed("movie_id", "movieId"), p)
    return fl.read_movies_csv(spark, p)


@query("read_tags_csv", W("fx_tags") + f"""
select user_id, movie_id, tag, timestamp from fx_tags where tag is not null and tag not in {_NA_SQL}""")
def q_read_tags_csv(spark, d):
    p = scratch_path(spark, "tags.csv")
    t = fx.fx_tags(spark, d).select(F.col("user_id").alias("userId"), F.col("movie_id").alias("movieId"),
                                    "tag", "timestamp")
    fl.write_csv(t, p)
    return fl.read_tags_csv(spark, p)


@query("read_links_csv", W("fx_links") + "select movie_id, imdb_id, tmdb_id from fx_links")
def q_read_links_csv(spark, d):
    p = scratch_path(spark, "links.csv")
    fl.write_csv(fx.fx_links(spark, d).select(F.col("movie_id").alias("movieId"), F.col("imdb_id").alias("imdbId"),
                                              F.col("tmdb_id").alias("tmdbId")), p)
    return fl.read_links_csv(spark, p)


@query("read_links_csv_no_tmdb", W("fx_links") + "select movie_id, imdb_id, cast(null as varchar) as tmdb_id from fx_links")
def q_read_links_csv_no_tmdb(spark, d):
    """A links file without the tmdbId column: the column reads as null."""
    p = scratch_path(spark, "links.csv")
    fl.write_csv(fx.fx_links(spark, d).select(F.col("movie_id").alias("movieId"), F.col("imdb_id").alias("imdbId")), p)
    return fl.read_links_csv(spark, p)


@query("read_ratings_reordered", W("fx_ratings") + "select user_id, movie_id, rating, timestamp from fx_ratings")
def q_read_ratings_reordered(spark, d):
    """Columns in another order, and one more: they go by their header names."""
    p = scratch_path(spark, "ratings.csv")
    fl.write_csv(_ratings_out(spark, d).select("timestamp", F.lit("x").alias("note"), "movieId", "rating", "userId"), p)
    return fl.read_ratings_csv(spark, p)


@query("read_links_no_imdb", W("fx_links") + "select movie_id, cast(null as varchar) as imdb_id, tmdb_id from fx_links")
def q_read_links_no_imdb(spark, d):
    """A links file without the imdbId column: that column is null, the tmdb ids stay where they belong."""
    p = scratch_path(spark, "links.csv")
    fl.write_csv(fx.fx_links(spark, d).select(F.col("movie_id").alias("movieId"), F.col("tmdb_id").alias("tmdbId")), p)
    return fl.read_links_csv(spark, p)


@query("read_movies_multiline", W("fx_movies") + "select movie_id, replace(title, ' (', chr(10) || '(') as title, genres from fx_movies")
def q_read_movies_multiline(spark, d):
    """Titles with a quoted line break are one record each."""
    p = scratch_path(spark, "movies.csv")
    broken = fx.fx_movies(spark, d).withColumn("title", F.replace("title", F.lit(" ("), F.lit("\n(")))
    fl.write_csv(broken.withColumnRenamed("movie_id", "movieId"), p)
    return fl.read_movies_csv(spark, p)


@query("read_quoted_documents", """
select cast(doc_id as int) as movie_id, md5(text) as title_md5, lang as genres from documents where text <> '' and lang <> ''""")
def q_read_quoted_documents(spark, d):
    """Whole documents as titles: fields of many lines, quotes and commas, read in splits."""
    p = scratch_path(spark, "movies.csv")
    docs = fx.table(spark, d, "documents").where("text <> '' and lang <> ''")
    fl.write_csv(docs.select(F.col("doc_id").alias("movieId"), F.col("text").alias("title"), F.col("lang").alias("genres")), p)
    return fl.read_movies_csv(spark, p).select("movie_id", F.md5(F.col("title").cast("binary")).alias("title_md5"), "genres")


@query("unparsable_ratings", W("fx_ratings") + """
select user_id, movie_id, timestamp, rating > 4.0e0 as bad from fx_ratings""")
def q_unparsable_ratings(spark, d):
    """Every rating above four is written as a word: those records are kept apart, all others read."""
    p = scratch_path(spark, "ratings.csv")
    word = F.when(F.col("rating") > 4.0, F.lit("great")).otherwise(F.col("rating").cast("string"))
    fl.write_csv(_ratings_out(spark, d).withColumn("rating", word), p)
    cols = ["user_id", "movie_id", "timestamp"]
    return fl.read_ratings_csv(spark, p).select(*cols, F.lit(False).alias("bad")).unionByName(
        fl.read_ratings_csv(spark, p, bad=True).select(*cols, F.lit(True).alias("bad")))


@query("read_genome_csv", W(extra=[_GENOME_SQL]) + "select movie_id, tag_id, relevance from fx_genome")
def q_read_genome_csv(spark, d):
    p = scratch_path(spark, "genome-scores.csv")
    fl.write_csv(_genome(spark, d).select(F.col("movie_id").alias("movieId"), F.col("tag_id").alias("tagId"),
                                          "relevance"), p)
    return fl.read_genome_csv(spark, p)


@query("read_ratings_dat", W("fx_ratings") + "select user_id, movie_id, rating, timestamp from fx_ratings")
def q_read_ratings_dat(spark, d):
    p = scratch_path(spark, "ratings.dat")
    fl.write_csv(_ratings_out(spark, d), p, sep="::", header=False, encoding="ISO-8859-1")
    return fl.read_ratings_dat(spark, p)


@query("read_movies_dat", W("fx_movies") + "select movie_id, title, genres from fx_movies")
def q_read_movies_dat(spark, d):
    p = scratch_path(spark, "movies.dat")
    fl.write_csv(fx.fx_movies(spark, d), p, sep="::", header=False, encoding="ISO-8859-1")
    return fl.read_movies_dat(spark, p)


@query("read_ratings_tab", W("fx_ratings") + "select user_id, movie_id, rating, timestamp from fx_ratings")
def q_read_ratings_tab(spark, d):
    p = scratch_path(spark, "u.data")
    fl.write_csv(_ratings_out(spark, d), p, sep="\t", header=False)
    return fl.read_ratings_tab(spark, p)


def _item_pipe(spark, d):
    """u.item layout: id | title | release date | video date | url | 19 genre flags."""
    mv = fx.fx_movies(spark, d)
    flags = [F.lit(0).alias(f"g{n}") for n in range(19)]
    return mv.select("movie_id", "title", F.lit("01-Jan-1995").alias("release_date"), F.lit("").alias("video_date"),
                     F.concat(F.lit("http://example.invalid/"), F.col("movie_id").cast("string")).alias("url"), *flags)


@query("read_movies_pipe", W("fx_movies") + "select movie_id, title, '(no genres listed)' as genres from fx_movies")
def q_read_movies_pipe(spark, d):
    p = scratch_path(spark, "u.item")
    fl.write_csv(_item_pipe(spark, d), p, sep="|", header=False, encoding="ISO-8859-1")
    return fl.read_movies_pipe(spark, p)


# ---------------------------------------------------------------- discovery and the whole ingest

def _landing(spark, d):
    """Write a download-like folder: five datasets plus files to skip and one to reject."""
    root = scratch_path(spark, "download")
    fl.write_csv(_ratings_out(spark, d), f"{root}/ml-latest/ratings.csv")
    fl.write_csv(fx.fx_movies(spark, d).withColumnRenamed("movie_id", "movieId"), f"{root}/ml-latest/movies.csv")
    fl.write_csv(fx.fx_tags(spark, d).select(F.col("user_id").alias("userId"), F.col("movie_id").alias("movieId"),
                                             "tag", "timestamp"), f"{root}/ml-latest/tags.csv")
    fl.write_csv(fx.fx_links(spark, d).select(F.col("movie_id").alias("movieId"), F.col("imdb_id").alias("imdbId"),
                                              F.col("tmdb_id").alias("tmdbId")), f"{root}/ml-latest/links.csv")
    fl.write_csv(_genome(spark, d).select(F.col("movie_id").alias("movieId"), F.col("tag_id").alias("tagId"),
                                          "relevance"), f"{root}/ml-latest/genome-scores.csv")
    bench = fx.table(spark, d, "benchmark").select("text")
    bench.write.text(f"{root}/ml-latest/README.txt")
    bench.write.text(f"{root}/ml-latest/genome-tags.csv")
    bench.write.text(f"{root}/ml-latest/stray_table.csv")
    return root


_COUNTS = [_GENOME_SQL, ("n_rows", f"""
  select 'ratings' as table_name, count(*) as rows_offered from fx_ratings
  union all select 'movies', count(*) from fx_movies
  union all select 'tags', count(*) from fx_tags where tag is not null and tag not in {_NA_SQL}
  union all select 'links', count(*) from fx_links
  union all select 'genome_scores', count(*) from fx_genome""")]
_COUNT_VIEWS = ("fx_ratings", "fx_movies", "fx_tags", "fx_links")


def _rows_per_dataset(spark, plan):
    """(name, rows) of the loadable datasets: one small count per dataset of the listing."""
    parts = [dv.read_dataset(spark, r["name"], r["dataset_path"])[1].agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(r["name"]).alias("name"), "n_rows") for r in plan.collect() if r["action"] == "load"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("discover_inputs", W(*_COUNT_VIEWS, extra=_COUNTS) + """
select t.name, t.action, t.table_name, t.layout, n.rows_offered as n_rows
from (values ('ratings.csv', 'load', 'ratings', 'modern'), ('movies.csv', 'load', 'movies', 'modern'),
  ('tags.csv', 'load', 'tags', 'modern'), ('links.csv', 'load', 'links', 'modern'),
  ('genome-scores.csv', 'load', 'genome_scores', 'modern'), ('README.txt', 'skip', null, null),
  ('genome-tags.csv', 'skip', null, null), ('stray_table.csv', 'reject', null, null))
  as t(name, action, table_name, layout) left join n_rows n on n.table_name = t.table_name""")
def q_discover_inputs(spark, d):
    """Every dataset of a download with its classification and, where it is loaded, its rows."""
    c = dv.discover_inputs(spark, _landing(spark, d))
    return c.join(_rows_per_dataset(spark, c), "name", "left").select("name", "action", "table_name", "layout", "n_rows")


@query("detect_variant", W(*_COUNT_VIEWS, extra=_COUNTS) + "select 'ml-25m' as variant, table_name, rows_offered as n_rows from n_rows")
def q_detect_variant(spark, d):
    """The variant of a download next to the rows of each of its tables."""
    root = _landing(spark, d)
    c = dv.discover_inputs(spark, root)
    rows = c.select("name", "table_name").join(_rows_per_dataset(spark, c), "name")
    return rows.crossJoin(F.broadcast(dv.detect_variant(dv.list_files(spark, root)))).select("variant", "table_name", "n_rows")  # one row


def ingest_all(spark, root: str):
    """Discover, read each loadable dataset with its reader, drop null keys; report rows offered per table
    and one row per skipped, rejected or failed file."""
    from marquee.sources.files import CONFLICT_KEYS
    c = dv.discover_inputs(spark, root).select("dataset_path", "name", "action", "table_name", "reason")
    plan = c.collect()  # one row per dataset file or folder: listing metadata, not data
    offered, skipped, errors = {}, {}, {}
    for r in plan:
        if r["action"] == "load":
            try:
                table, df = dv.read_dataset(spark, r["name"], r["dataset_path"])
            except Exception as e:  # noqa: BLE001 - the others go on; the report names it
                errors[r["name"]] = f"{type(e).__name__}: {str(e).splitlines()[0]}"
                continue
            df = drop_null_keys(df, CONFLICT_KEYS[table])
            offered[table] = df if table not in offered else offered[table].unionByName(df)
        else:
            skipped[r["name"]] = r["reason"]
    return fl.ingest_report(offered, skipped=skipped, errors=errors)


@query("ingest_all", W(*_COUNT_VIEWS, extra=_COUNTS) + """
select table_name, rows_offered from n_rows union all select 'total', sum(rows_offered)::bigint from n_rows""")
def q_ingest_all(spark, d):
    return ingest_all(spark, _landing(spark, d)).filter(F.col("note").isNull()).select("table_name", "rows_offered")


@query("ingest_with_bad_file", W("fx_movies") + """
select 'movies' as table_name, count(*) as rows_offered, false as ok, cast(null as varchar) as note from fx_movies
union all select 'total', count(*), false, null from fx_movies
union all select 'error:ratings.csv', null, null,
  'ValueError: missing columns [''movie_id'', ''timestamp'']; found [''user_id'', ''rating'']'""")
def q_ingest_with_bad_file(spark, d):
    """A ratings file without two of its columns is reported, the other files are read, and the whole is not ok."""
    root = scratch_path(spark, "download")
    fl.write_csv(_ratings_out(spark, d).select("userId", "rating"), f"{root}/ratings.csv")
    fl.write_csv(fx.fx_movies(spark, d).withColumnRenamed("movie_id", "movieId"), f"{root}/movies.csv")
    return ingest_all(spark, root).select("table_name", "rows_offered", "ok", "note")


def _zip_parts(spark, src: str, zips: str):
    """Zip every part file of a written dataset into its own archive (member name = the dataset name);
    the first part is also zipped a second time with a path-traversal member, an archive to refuse whole."""
    import io
    import zipfile

    import pandas as pd

    parts = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
             .load(src).select("path", "content"))
    root = zips.rstrip("/")

    def zipped(content, poison):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr("ratings.csv", content)
            if poison:
                zf.writestr("../evil.py", b"raise SystemExit")
        return buf.getvalue()

    def run(batches):
        fs, base = dv.task_filesystem(root)
        fs.create_dir(base, recursive=True)
        out = []
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                stem = path.rsplit("/", 1)[-1].split(".")[0]
                with fs.open_output_stream(f"{base}/{stem}.zip") as fh:
                    fh.write(zipped(content, False))
                if stem.startswith("part-00000"):
                    with fs.open_output_stream(f"{base}/{stem}-bad.zip") as fh:
                        fh.write(zipped(content, True))
                out.append((path, stem))
        yield pd.DataFrame(out, columns=["path", "stem"])

    parts.mapInPandas(run, "path string, stem string").count()


@query("expand_archives", W("fx_ratings") + """
select user_id, movie_id, rating, timestamp from fx_ratings""")
def q_expand_archives(spark, d):
    """Ratings zipped part by part plus one archive carrying '../evil.py', which is refused whole;
    every rating must come back exactly once."""
    base = scratch_path(spark, "archives")
    src = f"{base}/ratings.csv"
    fl.write_csv(_ratings_out(spark, d), src)
    _zip_parts(spark, src, f"{base}/zips")
    statuses = dv.expand_archives(spark, f"{base}/zips", f"{base}/out").collect()  # one row per member
    if not any(r["status"] == "refused" for r in statuses):
        raise AssertionError("the traversal archive was not refused")
    return fl.read_ratings_csv(spark, f"{base}/out/*/ratings.csv")


@query("require_columns", W("fx_ratings") + """
select 'user_id' as found, 0 as pos, count(user_id) as n_values from fx_ratings union all select 'movie_id', 1, count(movie_id) from fx_ratings
union all select 'rating', 2, count(rating) from fx_ratings union all select 'timestamp', 3, count(timestamp) from fx_ratings""")
def q_require_columns(spark, d):
    """Header check of a written ratings file: the found columns in file order, with the values that each holds."""
    p = scratch_path(spark, "ratings.csv")
    fl.write_csv(_ratings_out(spark, d), p)
    found = fl.require_columns(spark, p, ["user_id", "movie_id", "rating", "timestamp"])
    counts = fl.read_ratings_csv(spark, p).agg(*[F.count(c).alias(c) for c in found])
    cells = F.array(*[F.struct(F.lit(c).alias("found"), F.lit(n).alias("pos"), F.col(c).alias("n_values")) for n, c in enumerate(found)])
    return counts.select(F.explode(cells).alias("c")).select("c.*")
