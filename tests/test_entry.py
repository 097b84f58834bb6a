import __spark_entry__ as entry_module


def test_entry_runs_on_smoke_tables(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["user_id", "genre", "affinity"]
    assert df.count() > 0


def test_oracles_belong_to_queries():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    assert all(isinstance(v, str) and v.strip() for v in o.values())


def test_stage_cli(spark, tmp_path, capsys):
    import json

    from marquee.plans import stages
    from marquee.plans.q_sources import _landing
    src = _landing(spark, "/root/testdata/sf0.001")
    stages.main(["--data-dir", src, "--out", str(tmp_path / "wh"), "--stages", "ingest,validate"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert {r["check"] for r in out["validate"]} >= {"ratings_row_count", "orphan_ratings"}
