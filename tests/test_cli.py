"""The command line on small tables."""

import pytest

from dyadlake import cli


def run(spark, *argv):
    return cli.run(spark, cli.parser().parse_args(list(argv)))


def test_leaderboard_leaks_and_diversity(spark, tmp_path):
    metrics = [("m", s, f"model_{k}", v) for s, values in (("s1", [0.1, 0.9]), ("s2", [0.2, 0.1])) for k, v in enumerate(values, 1)]
    spark.createDataFrame(metrics, "method string, system string, model_name string, DockQ double").write.parquet(f"{tmp_path}/metrics")
    row = run(spark, "leaderboard", f"{tmp_path}/metrics", "--k", "1", "2").first()
    assert (row.n_systems, row.hit_top1, row.hit_top2, row.median_top2) == (2, 0.0, 50.0, 0.55)
    index = [("test", "A", "B", "c1", "c2"), ("test", "C", "D", "c1", "c3"), ("train", "B", "A", "c4", "c4")]
    spark.createDataFrame(index, "split string, uniprot_R string, uniprot_L string, cluster_id_R string, cluster_id_L string").write.parquet(f"{tmp_path}/index")
    leaks = run(spark, "leaks", f"{tmp_path}/index").first()
    assert (leaks.n_rows, leaks.n_leaking, leaks.percent) == (2, 1, 50.0)
    got = {r.grp: (r.n_labels, r.n_all) for r in run(spark, "diversity", f"{tmp_path}/index").collect()}
    assert got == {"test": (3, 4), "train": (1, 4)}


def test_queries_by_name(spark):
    assert run(spark, "query", "batch_pairs", "/root/testdata/sf0.001").count() == 15
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["query", "no_such_query", "x"])


def test_results_go_to_a_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    cli.main(["--out", f"{tmp_path}/out", "query", "batch_pairs", "/root/testdata/sf0.001"])
    assert spark.read.parquet(f"{tmp_path}/out").count() == 15
