from pyspark.sql import functions as F

from marquee.functions.vocab import GENRE_VOCAB
from marquee.operators import lookup as lk

SERVING = "user_id int, genre string, model_name string, scoring_method string, movie_ids array<int>, scores array<double>"
COLD = "genre string, model_name string, scoring_method string, movie_ids array<int>, scores array<double>"


def _serving(spark):
    top = spark.createDataFrame([
        (1, "Drama", lk.MODEL_A, "cosine", [10, 20, 30], [0.9, 0.8, 0.7]),
        (1, "Action", lk.MODEL_A, "cosine", [40, 50], [0.95, 0.5]),
        (2, "Comedy", lk.MODEL_B, "cosine", [60], [0.4]),
    ], SERVING)
    cold = spark.createDataFrame([("Action", lk.MODEL_A, "cosine", [7, 8, 9], [3.0, 2.0, 1.0]),
                                  ("Drama", lk.MODEL_A, "cosine", [5, 6], [4.0, 1.0])], COLD)
    return top, cold


def test_lookup_with_and_without_genre(spark):
    top, _ = _serving(spark)
    req = spark.createDataFrame([("a", 1, "Drama", 2), ("b", 1, None, 10)], "request_id string, user_id int, genre string, top_n int")
    got = {r["request_id"]: (r["genre"], r["movie_ids"]) for r in lk.lookup_user(top, req).collect()}
    assert got["a"] == ("Drama", [10, 20])
    assert got["b"] == ("Action", [40, 50])  # lowest vocabulary genre when none asked


def test_batch_falls_back_to_cold_start(spark):
    top, cold = _serving(spark)
    req = spark.createDataFrame([(1, 1), (9, 9)], "request_id int, user_id int")
    got = {r["user_id"]: (r["source"], r["movie_ids"]) for r in lk.batch_recommend(top, cold, req).collect()}
    assert got[1] == ("personal", [40, 50])
    assert got[9] == ("cold_start", [7, 8, 9])


def test_defaults_fill_nulls_in_each_request(spark):
    top, cold = _serving(spark)
    schema = "request_id int, user_id int, genre string, top_n int, scoring_method string, model_name string"
    req = spark.createDataFrame([(1, 1, None, None, None, None), (2, 1, "Drama", 2, "cosine", None)], schema)
    got = {r["request_id"]: (r["genre"], r["movie_ids"], r["top_n"]) for r in lk.lookup_user(top, req).collect()}
    assert got == {1: ("Action", [40, 50], 10), 2: ("Drama", [10, 20], 2)}


def test_every_request_has_one_answer(spark):
    top, cold = _serving(spark)
    req = spark.createDataFrame([(1, 1, "Drama", 2), (1, 1, None, 1), (3, 9, "Comedy", 5), (4, 9, "Drama", 500), (5, 9, "Nonsense", 5), (6, 1, "Drama", 0)],
                                "request_id int, user_id int, genre string, top_n int")
    got = sorted((r.request_id, r.source, r.genre, r.movie_ids) for r in lk.batch_recommend(top, cold, req).collect())
    assert got == [(1, "personal", "Action", [40]), (1, "personal", "Drama", [10, 20]), (3, "none", "Comedy", None), (4, "invalid", "Drama", None),
                   (5, "none", "Nonsense", None), (6, "invalid", "Drama", None)]
    assert {r.request_id: r.error for r in lk.bad_requests(req).collect()} == {
        4: "top_n 500 is outside 1..100", 5: "unknown genre Nonsense", 6: "top_n 0 is outside 1..100"}


def test_limits_out_of_range_raise(spark):
    import pytest

    from marquee.operators import metrics as mt
    mv = spark.createDataFrame([(1, "A (1995)")], "movie_id int, title string")
    for bad in (0, 51):
        with pytest.raises(ValueError, match="outside 1..50"):
            lk.search_titles(mv, mv, "a", bad)
    with pytest.raises(ValueError, match="outside 1..500"):
        mt.runs_filtered(mv, limit=501)


def test_multi_model_skips_models_without_rows(spark):
    top, _ = _serving(spark)
    req = spark.createDataFrame([(1, 1)], "request_id int, user_id int")
    got = lk.multi_model_recommend(top, req, [lk.MODEL_A, lk.MODEL_B]).collect()
    assert [r["model_name"] for r in got] == [lk.MODEL_A]


def test_top_genres_ties_in_vocab_order(spark):
    vec = [0.0] * 20
    vec[GENRE_VOCAB.index("Drama")] = 0.5
    vec[GENRE_VOCAB.index("Action")] = 0.5
    vec[GENRE_VOCAB.index("Comedy")] = 0.2
    uf = spark.createDataFrame([(1, vec), (2, [0.0] * 20)], "user_id int, genre_affinity array<double>")
    got = [(r["genre"], r["rank"]) for r in lk.top_genres(uf).orderBy("user_id", "rank").collect()]
    assert got == [("Action", 1), ("Drama", 2)]


def test_explain_reasons(spark):
    vec = [0.0] * 20
    vec[GENRE_VOCAB.index("Drama")] = 1.0
    uf = spark.createDataFrame([(1, vec)], "user_id int, genre_affinity array<double>")
    mh = [0.0] * 20
    mh[GENRE_VOCAB.index("Drama")] = 1.0
    itf = spark.createDataFrame([(10, mh), (20, [0.0] * 20)], "movie_id int, genre_multihot array<double>")
    recs = spark.createDataFrame([(1, 0, 10, 0.12345), (1, 1, 20, 0.5)], "user_id int, pos int, movie_id int, score double")
    got = {r["movie_id"]: (r["reason"], r["overlap"], r["score3"]) for r in lk.explain(recs, uf, itf).collect()}
    assert got[10] == ("affinity", "Drama", 0.123)
    assert got[20][0] == "embedding"
    assert lk.explain(recs, uf, itf, cold_genre="Drama").filter("movie_id = 20").first()["reason"] == "cold_start"


def test_ab_assignment_parity(spark):
    users = spark.createDataFrame([(2,), (3,), (-3,)], "user_id int")
    got = {r["user_id"]: r["assigned_model"] for r in lk.ab_assign(users).collect()}
    assert got == {2: lk.MODEL_A, 3: lk.MODEL_B, -3: lk.MODEL_B}


def test_search_titles_wildcards(spark):
    mv = spark.createDataFrame([(1, "Toy Story (1995)"), (2, "toy_soldier (1990)"), (3, "Heat (1995)")], "movie_id int, title string")
    itf = mv.select("movie_id", F.lit(1995).alias("release_year"))
    assert [r["movie_id"] for r in lk.search_titles(mv, itf, "TOY", 10).collect()] == [1, 2]
    assert [r["movie_id"] for r in lk.search_titles(mv, itf, "toy_s", 10).collect()] == [1, 2]
    assert lk.search_titles(mv, itf, "o", 1).count() == 1


def test_title_index_equals_a_scan(spark, tmp_path, monkeypatch):
    """Patterns of every kind against ilike over all titles: long, short, wildcards, escapes, other cases, none."""
    import random

    from marquee.operators import titles as ti
    monkeypatch.setattr(ti, "LIST_IDS", 40)  # several lists a trigram
    rng = random.Random(3)
    words = ["The", "Night", "of", "é", "STRASSE", "100%", "a_b", "x", "Ünder", "\\", "2001", "..", "Naïve"]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(300)] + ["", "a", "ab", None, "abc", "İstanbul"]
    mv = spark.createDataFrame(list(enumerate(names)), "movie_id int, title string")
    ti.build_title_index(mv, str(tmp_path / "ix"))
    patterns = ["night of", "THE", "é", "ün", "Stra", "%", "", "_", "____________________________", "t%t", "n_g", "zzz", "ab", "a", "100\\%", "a\\_b",
                "\\%", "the%of%x", "..", "_b_", "20%", None, "naïve", "i"]
    req = [(f"r{i}", q, rng.choice([None, 1, 7, 50])) for i, q in enumerate(patterns)] + [("bad", "the", 51), ("bad2", "the", 0)]
    got = {}
    out = ti.search_titles(spark, str(tmp_path / "ix"), spark.createDataFrame(req, "request_id string, q string, limit int"))
    for r in sorted(out.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.request_id, []).append((r["rank"], r.movie_id, r.title))
    for rid, q, limit in req:
        want = []
        limit = 10 if limit is None else limit
        if q is not None and 1 <= limit <= 50:
            hits = mv.where(F.col("title").ilike(f"%{q}%")).orderBy("movie_id").limit(limit).collect()
            want = [(n, r.movie_id, r.title) for n, r in enumerate(hits, 1)]
        assert got.get(rid, []) == want, q


def test_title_patterns_stop_at_the_block_that_answers_them(spark, tmp_path, monkeypatch):
    """Blocks of ids: equal patterns are searched once, and only those without an answer go on to larger ids."""
    from marquee.operators import titles as ti
    names = [f"{'rare ' if i in (3, 390) else ''}night {i}" for i in range(400)]
    mv = spark.createDataFrame([(1000 - i, n) for i, n in enumerate(names)] + [(700, "night again")], "movie_id int, title string")
    ti.build_title_index(mv, str(tmp_path / "ix"), first_ids=30)
    assert spark.read.parquet(str(tmp_path / "ix" / "bounds")).count() == 2
    asked, hits = [], ti._hits
    monkeypatch.setattr(ti, "_hits", lambda lists, sizes, titles, ask: asked.append(sorted(r["q"] for r in ask.collect())) or hits(lists, sizes, titles, ask))
    req = [(n, q, 5) for n, q in enumerate(["night", "rare", "n", "%", "night", "a__re", "1_"])]
    got = {}
    for r in sorted(ti.search_titles(spark, str(tmp_path / "ix"), spark.createDataFrame(req, "request_id long, q string, limit int")).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.request_id, []).append(r.movie_id)
    for n, q, top in req:
        want = [r.movie_id for r in mv.where(F.col("title").ilike(f"%{q}%")).orderBy("movie_id").limit(top).collect()]
        assert got.get(n, []) == want, q
    assert asked[0] == sorted({q for _, q, _ in req}) and asked[1:] and all("night" not in a and "%" not in a for a in asked[1:])
