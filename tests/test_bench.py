import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "genre_avg_rating", "split_sizes"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"genre_avg_rating", "split_sizes"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)


def test_bench_reports_a_failing_query_without_crashing():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "split_sizes", "no_such_query"],
        env=env, capture_output=True, text=True, timeout=600, check=True,
    ).stdout.strip().splitlines()
    rec = json.loads(out[-1])
    assert set(rec["queries"]) == {"split_sizes"} and "no_such_query" in rec["errors"]
