"""File-to-file jobs on the fixture files; outputs go under the shared folder."""

from prefkit.plans import jobs
from prefkit.session import scratch_path


def test_genre_jobs_write_text(spark, fixture_dir):
    r, i = str(fixture_dir / "ratings.csv"), str(fixture_dir / "items.csv")
    out = scratch_path(spark, "job-avg")
    jobs.genre_average_job(spark, r, i, out)
    lines = {row.value for row in spark.read.text(out).collect()}
    assert "Documentary\t3.0\t1" in lines and len(lines) == 6
    out2 = scratch_path(spark, "job-top")
    jobs.genre_top_items_job(spark, r, i, out2)
    lines = {row.value for row in spark.read.text(out2).collect()}
    assert "Drama\tEmber (1995):3" in lines
    out3 = scratch_path(spark, "job-users")
    jobs.genre_top_users_job(spark, r, i, out3)
    # Adventure 4 users, Animation 3, Comedy 3, Crime 4, Documentary 1, Drama 3
    assert spark.read.text(out3).count() == 18


def test_matrix_and_cf_jobs(spark, fixture_dir):
    r, p, i = (str(fixture_dir / f) for f in ("ratings.csv", "personal.csv", "items.csv"))
    out = scratch_path(spark, "job-matrix")
    dims = jobs.matrix_statistics_job(spark, r, out, threshold=2)
    assert dims == {"n_rows": 4, "n_cols": 7}
    assert sorted(row.value for row in spark.read.text(out).collect()) == ["1\t3", "3\t3", "6\t3"]
    out2 = scratch_path(spark, "job-cf")
    jobs.item_cf_job(spark, r, p, i, out2)
    first = [row.value for row in spark.read.text(out2).collect() if row.value.startswith("1\t")]
    assert len(first) == 1 and first[0].startswith("1\t1\tPaper Kite (1995)\t1.97895")


def test_cli_runs_jobs(spark, fixture_dir):
    from prefkit.__main__ import parser, run

    r, p, i = (str(fixture_dir / f) for f in ("ratings.csv", "personal.csv", "items.csv"))
    out = scratch_path(spark, "cli-avg")
    run(parser().parse_args(["genre-average", "--ratings", r, "--items", i, "--out", out]), spark)
    assert spark.read.text(out).count() == 6
    out2 = scratch_path(spark, "cli-matrix")
    dims = run(parser().parse_args(["matrix-statistics", "--ratings", r, "--out", out2, "--threshold", "2"]), spark)
    assert dims == {"n_rows": 4, "n_cols": 7}
    out3 = scratch_path(spark, "cli-als")
    res = run(parser().parse_args(["als", "--ratings", r, "--personal", p, "--items", i, "--out", out3, "--n", "3"]), spark)
    assert res["best"]["grid_pos"] in range(8)
    assert spark.read.text(out3 + "/trials").count() == 8
    assert spark.read.text(out3 + "/recommendations").count() == 3
