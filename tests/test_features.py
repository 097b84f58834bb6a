import math
import random
from collections import Counter

import pytest

from marquee.functions.text import extract_year
from marquee.functions.vocab import GENRE_VOCAB
from marquee.operators import features as fe


def test_decay_weights_known_answers(ratings5):
    w = {r["id"]: r["weight"] for r in fe.time_decay_weight(ratings5, 0.1).collect()}
    expected = {1: 0.904837, 2: 0.951229, 3: 0.927743, 4: 0.975310, 5: 1.0}
    for k, v in expected.items():
        assert w[k] == pytest.approx(v, abs=1e-6)


def test_single_timestamp_weight_is_one(spark):
    df = spark.createDataFrame([(1, 1, 10, 4.0, 500)], "id long, user_id int, movie_id int, rating double, timestamp long")
    assert fe.time_decay_weight(df).first()["weight"] == pytest.approx(1.0)


def test_genre_affinity_normalises_by_all_ratings(ratings5, movies3, spark):
    # user 2 rated movie 10 (Action) and 30 (Comedy|Drama); a movie without genres still counts in the total
    extra = spark.createDataFrame([(6, 2, 99, 3.0, 3000)], ratings5.schema)
    rk = ratings5.unionByName(extra)
    aff = {(r["user_id"], r["genre"]): r["affinity"] for r in fe.genre_affinity(rk, movies3).collect()}
    w = {r["id"]: r["weight"] for r in fe.time_decay_weight(rk).collect()}
    total = w[3] + w[4] + w[6]
    assert aff[(2, "Action")] == pytest.approx(w[3] / total)
    assert aff[(2, "Drama")] == pytest.approx(w[4] / total)
    assert aff[(1, "Action")] + aff[(1, "Drama")] == pytest.approx(1.0)


def test_user_features_shape(ratings5, movies3):
    uf = {r["user_id"]: r for r in fe.user_features(ratings5, movies3).collect()}
    assert set(uf) == {1, 2, 3}
    assert len(uf[1]["genre_affinity"]) == len(GENRE_VOCAB)
    assert uf[1]["rating_count"] == 2 and uf[1]["avg_rating"] == pytest.approx(3.75)
    assert uf[2]["history_items"] == 2
    hist = {(r["user_id"], r["movie_id"]) for r in fe.decayed_history(ratings5).collect()}
    assert {m for u, m in hist if u == 2} == {10, 30}


def test_extract_year(spark):
    df = spark.createDataFrame([("Movie (1999)",), ("No year",), ("Odd (12345) (2001)",), ("(2000) first",)], "t string")
    got = [r[0] for r in df.select(extract_year("t")).collect()]
    assert got == [1999, None, 2001, 2000]


def test_multihot_ignores_unknown(movies3, spark):
    mv = movies3.unionByName(spark.createDataFrame([(40, "X (1990)", "Nonsense|Western")], movies3.schema))
    mh = {r["movie_id"]: r["genre_multihot"] for r in fe.genre_multihot(mv).collect()}
    assert sum(mh[40]) == 1.0 and mh[40][GENRE_VOCAB.index("Western")] == 1.0
    assert mh[30][GENRE_VOCAB.index("Comedy")] == 1.0 and mh[30][GENRE_VOCAB.index("Drama")] == 1.0


def test_tag_tfidf_matches_hand_computation(spark, movies3):
    tags = spark.createDataFrame([(1, 10, "funny dark", 1), (2, 10, "funny", 2), (3, 20, "dark x", 3)],
                                 "user_id int, movie_id int, tag string, timestamp long")
    got = {(r["movie_id"], r["term"]): r["tfidf"] for r in fe.tag_tfidf(tags, movies3).collect()}
    n = 3  # all movies, including the one without tags
    idf = {"funny": math.log((1 + n) / (1 + 1)) + 1, "dark": math.log((1 + n) / (1 + 2)) + 1}
    x10 = {"funny": 2 * idf["funny"], "dark": idf["dark"]}
    norm = math.sqrt(sum(v * v for v in x10.values()))
    assert got[(10, "funny")] == pytest.approx(x10["funny"] / norm)
    assert got[(20, "dark")] == pytest.approx(1.0)
    assert (20, "x") not in got  # single-character tokens are not terms


def test_tag_tfidf_vocabulary_cap(spark, movies3):
    words = " ".join(f"w{i:03d}" for i in range(150))
    tags = spark.createDataFrame([(1, 10, words, 1)], "user_id int, movie_id int, tag string, timestamp long")
    assert fe.tag_tfidf(tags, movies3, max_features=100).count() == 100


@pytest.mark.parametrize("capacity", [3, 8, 40, 1000])
def test_frequent_terms_are_exact_whatever_the_summaries_hold(spark, capacity):
    """From summaries that hold everything to ones too small to tell anything, with ties at the edge."""
    rng = random.Random(capacity)
    for skew in (0.0, 1.5):
        words = [f"w{int(300 * rng.random() ** (1 + skew * 3))}" for _ in range(4000)] + ["tie1", "tie2"] * 30
        rng.shuffle(words)
        rows = [(words[i:i + 7],) for i in range(0, len(words), 7)]
        df = spark.createDataFrame(rows, "terms array<string>").repartition(5)
        want = [t for t, n in sorted(Counter(words).items(), key=lambda x: (-x[1], x[0]))]
        for k in (1, 5, 30):
            assert fe.frequent_terms(df, k, capacity) == want[:k]
    assert fe.frequent_terms(df.limit(0), 5) == []


def test_summaries_are_bounded_and_bracket_the_counts():
    import pyarrow as pa
    rng = random.Random(1)
    words = [f"w{int(500 * rng.random() ** 3)}" for _ in range(5000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([words[i:i + 100]])], ["terms"]) for i in range(0, 5000, 100)]
    out = pa.Table.from_batches(list(fe._summary(40)(batches)))
    rows = dict(zip(out["term"].to_pylist(), out["n"].to_pylist()))
    error, true = sum(out["error"].to_pylist()), Counter(words)
    assert len(rows) <= 41 and error < len(words) / 40
    assert all(rows.get(t, 0) <= n <= rows.get(t, 0) + error for t, n in true.items())
