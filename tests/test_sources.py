import io
import random
import os
import zipfile

import pytest

from marquee.sources import discover as dv
from marquee.sources import files as fl


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


@pytest.fixture()
def download(tmp_path):
    d = tmp_path / "ml"
    _write(str(d / "ratings.csv"), "userId,movieId,rating,timestamp\n31,210,1.5,86400\n47,305,4.5,172800\n")
    _write(str(d / "movies.csv"), 'movieId,title,genres\n10,"Lantern, The (2011)",Action\n20,Quiet Harbour (2016),Drama\n')
    _write(str(d / "tags.csv"), 'userId,movieId,tag,timestamp\n1,10,slow burn,1500\n1,10,,1600\n2,20,"two\nlines",1700\n')
    _write(str(d / "links.csv"), "movieId,imdbId,tmdbId\n10,0450017,7731\n20,0620031,\n")
    _write(str(d / "genome-scores.csv"), "movieId,tagId,relevance\n210,7,0.35\n305,7,0.8125\n")
    _write(str(d / "README.txt"), "hello\n")
    _write(str(d / "genome-tags.csv"), "tagId,tag\n1,a\n")
    _write(str(d / "stray_table.csv"), "a,b\n1,2\n")
    return str(d)


def test_modern_readers(spark, download):
    r = fl.read_ratings_csv(spark, f"{download}/ratings.csv").collect()
    assert [(x.user_id, x.movie_id, x.rating, x.timestamp) for x in r] == [(31, 210, 1.5, 86400), (47, 305, 4.5, 172800)]
    m = fl.read_movies_csv(spark, f"{download}/movies.csv").collect()
    assert m[0].title == "Lantern, The (2011)"
    t = fl.read_tags_csv(spark, f"{download}/tags.csv").collect()
    assert sorted(x.tag for x in t) == ["slow burn", "two\nlines"]  # the empty tag is dropped
    links = {x.movie_id: (x.imdb_id, x.tmdb_id) for x in fl.read_links_csv(spark, f"{download}/links.csv").collect()}
    assert links == {10: ("0450017", "7731"), 20: ("0620031", None)}
    g = fl.read_genome_csv(spark, f"{download}/genome-scores.csv").collect()
    assert [(x.movie_id, x.tag_id, x.relevance) for x in g] == [(210, 7, 0.35), (305, 7, 0.8125)]


def test_links_without_tmdb(spark, tmp_path):
    p = str(tmp_path / "links.csv")
    _write(p, "movieId,imdbId\n10,0450017\n")
    assert fl.read_links_csv(spark, p).first().tmdb_id is None


def test_columns_go_by_name(spark, tmp_path):
    p = str(tmp_path / "links.csv")
    _write(p, "movieId,tmdbId\n10,7731\n11,nan\n")
    assert [tuple(r) for r in fl.read_links_csv(spark, p).collect()] == [(10, None, "7731"), (11, None, None)]
    p = str(tmp_path / "ratings.csv")
    _write(p, "timestamp,rating,extra,movieId,userId\n1000,4.5,x,10,1\n")
    assert [tuple(r) for r in fl.read_ratings_csv(spark, p).collect()] == [(1, 10, 4.5, 1000)]
    p = str(tmp_path / "short.csv")
    _write(p, "userId,rating\n1,4.0\n")
    with pytest.raises(ValueError, match=r"missing columns \['movie_id', 'timestamp'\]; found \['user_id', 'rating'\]"):
        fl.read_ratings_csv(spark, p)


def test_files_of_another_header_are_not_mixed(spark, tmp_path):
    d = str(tmp_path / "parts")
    _write(f"{d}/part-0.csv", "userId,movieId,rating,timestamp\n1,10,4.0,1000\n")
    _write(f"{d}/part-1.csv", "movieId,userId,rating,timestamp\n10,1,4.0,1000\n")
    with pytest.raises(Exception, match="(?i)header"):
        fl.read_ratings_csv(spark, d).collect()


def test_records_that_do_not_parse_are_kept_apart(spark, tmp_path):
    p = str(tmp_path / "ratings.csv")
    _write(p, "userId,movieId,rating,timestamp\n1,10,4.0,1000\n2,x,4.0,1000\n3,30,high,1000\n4,40,1.0\n5,50,,1000\n")
    assert [r.user_id for r in fl.read_ratings_csv(spark, p).collect()] == [1, 5]
    bad = fl.read_ratings_csv(spark, p, bad=True).collect()
    assert sorted(r[fl.CORRUPT] for r in bad) == ["2,x,4.0,1000", "3,30,high,1000", "4,40,1.0"]


def test_title_with_a_line_break(spark, tmp_path):
    p = str(tmp_path / "movies.csv")
    _write(p, 'movieId,title,genres\n10,"Two\nLines (2001)",Drama\n11,Next (2002),Action\n')
    assert [tuple(r) for r in fl.read_movies_csv(spark, p).collect()] == [(10, "Two\nLines (2001)", "Drama"), (11, "Next (2002)", "Action")]


def test_legacy_readers(spark, tmp_path):
    p = str(tmp_path / "ratings.dat")
    _write(p, "1::10::4::1000\n2::20::3::2000\n", encoding="latin-1")
    assert [(x.user_id, x.rating) for x in fl.read_ratings_dat(spark, p).collect()] == [(1, 4.0), (2, 3.0)]
    p = str(tmp_path / "movies.dat")
    _write(p, "10::Café (1995)::Action|Adventure\n20::B (1996)::Drama\n", encoding="latin-1")
    mv = fl.read_movies_dat(spark, p).collect()
    assert mv[0].title == "Café (1995)" and mv[0].genres == "Action|Adventure"
    p = str(tmp_path / "u.data")
    _write(p, "1\t10\t4\t1000\n2\t20\t3\t2000\n")
    assert fl.read_ratings_tab(spark, p).count() == 2
    p = str(tmp_path / "u.item")
    _write(p, "1|Paper Moons (1995)|01-Jan-1995||http://x|" + "|".join(["0"] * 19) + "\nnot a row\n", encoding="latin-1")
    items = fl.read_movies_pipe(spark, p).collect()
    assert [(x.movie_id, x.title, x.genres) for x in items] == [(1, "Paper Moons (1995)", "(no genres listed)")]


def test_require_columns(spark, download):
    with pytest.raises(ValueError, match="missing"):
        fl.require_columns(spark, f"{download}/ratings.csv", ["user_id", "movie_id", "rating", "timestamp", "extra"])
    assert "user_id" in fl.require_columns(spark, f"{download}/ratings.csv", ["user_id", "movie_id"])


def test_classify_and_variant(spark, download):
    got = {r["name"]: (r["action"], r["table_name"]) for r in dv.discover_inputs(spark, download).collect()}
    assert got["ratings.csv"] == ("load", "ratings")
    assert got["genome-scores.csv"] == ("load", "genome_scores")
    assert got["README.txt"][0] == "skip" and got["genome-tags.csv"][0] == "skip"
    assert got["stray_table.csv"][0] == "reject"
    assert dv.detect_variant(dv.list_files(spark, download)).first()["variant"] == "ml-25m"


@pytest.mark.parametrize("names,label", [(["u.data", "ratings.csv"], "ml-100k"), (["movies.dat"], "ml-1m"),
                                         (["ratings.csv"], "ml-latest-small"), (["x.bin"], "unknown")])
def test_variant_priority(spark, names, label):
    files = spark.createDataFrame([(n,) for n in names], "name string")
    assert dv.detect_variant(files).first()["variant"] == label


def test_zip_traversal_refused(spark, tmp_path):
    good, bad = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("ratings.csv", "userId,movieId,rating,timestamp\n1,10,4.0,1000\n")
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("ratings.csv", "userId,movieId,rating,timestamp\n9,9,1.0,1\n")
        z.writestr("../evil.py", "x")
    os.makedirs(tmp_path / "zips")
    (tmp_path / "zips" / "good.zip").write_bytes(good.getvalue())
    (tmp_path / "zips" / "bad.zip").write_bytes(bad.getvalue())
    os.makedirs(tmp_path / "zips" / "more")
    (tmp_path / "zips" / "more" / "good.zip").write_bytes(good.getvalue().replace(b"1,10,4.0,1000", b"1,10,4.0,1000"))
    (tmp_path / "zips" / "broken.zip").write_bytes(b"PK no zip at all")
    rows = dv.expand_archives(spark, str(tmp_path / "zips"), str(tmp_path / "out")).collect()
    res = sorted((os.path.basename(r["archive"]), r["member"] or "", r["status"].split(":")[0]) for r in rows)
    assert res == [("bad.zip", "../evil.py", "refused"), ("bad.zip", "ratings.csv", "refused"), ("broken.zip", "", "error"),
                   ("good.zip", "ratings.csv", "extracted"), ("good.zip", "ratings.csv", "extracted")]
    # archives of one name stay apart, and a second run over the same archives changes nothing
    assert fl.read_ratings_csv(spark, str(tmp_path / "out" / "*" / "ratings.csv")).count() == 2
    dv.expand_archives(spark, str(tmp_path / "zips"), str(tmp_path / "out")).collect()
    assert fl.read_ratings_csv(spark, str(tmp_path / "out" / "*" / "ratings.csv")).count() == 2
    assert not list((tmp_path / "out").glob("*/.*part"))


def test_one_archive_is_unpacked_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    rng = random.Random(3)
    texts = {f"folder/m{i}.csv": "".join(rng.choices("abc,\n", k=rng.randint(0, 30_000))) for i in range(24)}
    os.makedirs(tmp_path / "zips")
    with zipfile.ZipFile(tmp_path / "zips" / "big.zip", "w") as z:
        for n, (name, text) in enumerate(texts.items()):
            z.writestr(name, text, zipfile.ZIP_STORED if n % 3 == 0 else zipfile.ZIP_DEFLATED)
        z.writestr("folder/", "")
    done = dv.expand_archives(spark, str(tmp_path / "zips"), str(tmp_path / "out"), task_bytes=10_000)
    rows = done.withColumn("task", F.spark_partition_id()).collect()
    assert {(r.member, r.status) for r in rows} == {(m, "extracted") for m in texts}
    load = {}
    for r in rows:
        load[r.task] = load.get(r.task, 0) + 1
    assert len(load) >= 8 and max(load.values()) <= 4
    out = next((tmp_path / "out").iterdir())
    assert {str(p.relative_to(out)): p.read_text() for p in out.rglob("*.csv")} == texts
    assert not list(out.rglob("*.part"))


def test_damaged_members_are_reported_alone(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        for name in ("a.csv", "b.csv", "b.csv"):
            z.writestr(name, f"content of {name} {len(buf.getvalue())}")
        z.writestr("c.csv", "packed otherwise " * 50, zipfile.ZIP_BZIP2)
    raw = bytearray(buf.getvalue())
    raw[raw.index(b"content of a.csv")] = ord("C")
    os.makedirs(tmp_path / "zips")
    (tmp_path / "zips" / "x.zip").write_bytes(raw)
    (tmp_path / "zips" / "empty.zip").write_bytes(b"PK\x05\x06" + bytes(18))
    rows = dv.expand_archives(spark, str(tmp_path / "zips"), str(tmp_path / "out")).collect()
    got = {r.member: r.status.split(":")[0] + (r.status.split(":")[1] if ":" in r.status else "") for r in rows}
    assert got == {"a.csv": "error ValueError", "b.csv": "extracted", "c.csv": "error NotImplementedError"}
    out = next((tmp_path / "out").iterdir())
    assert [p.name for p in out.iterdir()] == ["b.csv"] and not (out / "b.csv").read_text().endswith(" 0")
