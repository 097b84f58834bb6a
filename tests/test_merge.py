from marquee.operators import merge

SCHEMA = "id long, user_id int, movie_id int, rating double"


def _rows(df):
    return sorted((r["user_id"], r["movie_id"], r["rating"], r["id"]) for r in df.collect())


def test_upsert_last_wins_and_replaces(spark):
    tgt = spark.createDataFrame([(1, 1, 10, 1.0), (2, 1, 20, 2.0)], SCHEMA)
    src = spark.createDataFrame([(3, 1, 10, 3.0), (4, 1, 10, 4.0), (5, 2, 10, 5.0), (6, None, 1, 1.0)], SCHEMA)
    assert _rows(merge.merge_upsert(tgt, src, ["user_id", "movie_id"], "id")) == [
        (1, 10, 4.0, 1), (1, 20, 2.0, 2), (2, 10, 5.0, 5)]  # an existing key keeps its row id


def test_skip_keeps_existing_and_first(spark):
    tgt = spark.createDataFrame([(1, 1, 10, 1.0)], SCHEMA)
    src = spark.createDataFrame([(3, 1, 10, 3.0), (4, 2, 10, 4.0), (5, 2, 10, 5.0)], SCHEMA)
    assert _rows(merge.merge_skip(tgt, src, ["user_id", "movie_id"], "id")) == [(1, 10, 1.0, 1), (2, 10, 4.0, 4)]


def test_replace_drops_old_rows(spark):
    src = spark.createDataFrame([(3, 1, 10, 3.0), (4, 1, 10, 4.0)], SCHEMA)
    assert _rows(merge.merge_replace(src, ["user_id", "movie_id"], "id")) == [(1, 10, 3.0, 3)]


def test_stamp_is_one_literal(spark):
    df = spark.range(100).withColumnRenamed("id", "x")
    assert merge.stamp_inserted_at(df).select("inserted_at").distinct().count() == 1


def test_hot_key_dedupe(spark):
    """A third of the rows on one key still collapses to one row (partial aggregation)."""
    from pyspark.sql import functions as F
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int")
                                  .alias("user_id"), F.lit(1).alias("movie_id"), F.lit(1.0).alias("rating"))
    out = merge.dedupe_last(df, ["user_id", "movie_id"], "id")
    assert out.count() == 2001
    assert out.filter("user_id = 0").first()["id"] == 2997


def test_rows_without_order_value(spark):
    schema = "id long, user_id int, movie_id int, rating double, note string"
    src = spark.createDataFrame([(None, 1, 10, 3.0, "only"), (None, 2, 20, 1.0, "loses"), (4, 2, 20, 4.0, "wins")], schema)
    for pick in (merge.dedupe_last, merge.dedupe_first):
        assert sorted((r.user_id, r.rating, r.note) for r in pick(src, ["user_id", "movie_id"], "id").collect()) == [
            (1, 3.0, "only"), (2, 4.0, "wins")]


def test_equal_order_values_give_one_whole_row(spark):
    rows = [(7, 1, 10, float(i), f"n{i}") for i in range(20)]
    schema = "id long, user_id int, movie_id int, rating double, note string"
    got = {tuple(merge.dedupe_last(spark.createDataFrame(rows[::s], schema).repartition(n), ["user_id", "movie_id"], "id").first())
           for s, n in ((1, 1), (-1, 5), (1, 7))}
    assert len(got) == 1 and got.pop() in rows


def test_upsert_can_blank_a_value(spark):
    tgt = spark.createDataFrame([(1, 1, 10, 1.0)], SCHEMA)
    src = spark.createDataFrame([(2, 1, 10, None)], SCHEMA)
    assert _rows(merge.merge_upsert(tgt, src, ["user_id", "movie_id"], "id")) == [(1, 10, None, 1)]


def test_next_id(spark):
    assert merge.next_id(None) == 0
    assert merge.next_id(spark.createDataFrame([], SCHEMA)) == 0
    assert merge.next_id(spark.createDataFrame([(0, 1, 10, 1.0)], SCHEMA)) == 1


def test_arrival_ids_follow_file_names(spark, tmp_path):
    """Scans take large files first; the arrival order is that of the files."""
    (tmp_path / "part-0.csv").write_text("userId,movieId,rating,timestamp\n1,10,1.0,1\n")
    (tmp_path / "part-1.csv").write_text("userId,movieId,rating,timestamp\n" + "".join(f"{i},20,2.0,1\n" for i in range(2, 3000)) + "1,10,5.0,1\n")
    from marquee.sources.files import read_ratings_csv
    df = merge.arrival_ids(read_ratings_csv(spark, str(tmp_path)), 100)
    ids = {r.user_id: r.id for r in df.where("rating < 5").collect()}
    assert ids == {i: 99 + i for i in range(1, 3000)}
    assert merge.dedupe_last(df, ["user_id", "movie_id"], "id").where("user_id = 1").first().rating == 5.0


def test_watermarks_of_other_tables_stay(spark):
    from datetime import datetime
    s = "table_name string, last_inserted_at timestamp_ntz"
    old = spark.createDataFrame([("ratings", datetime(2024, 1, 1)), ("movies", datetime(2024, 1, 2))], s)
    new = spark.createDataFrame([("ratings", datetime(2024, 2, 1))], s)
    got = {r.table_name: r.last_inserted_at for r in merge.merge_watermarks(old, new).collect()}
    assert got == {"ratings": datetime(2024, 2, 1), "movies": datetime(2024, 1, 2)}
    assert merge.merge_watermarks(None, new).count() == 1
