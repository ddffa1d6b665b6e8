import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefkit.llm import mixing
from cases import ODD_ROWS


def filled(sizes, weights, total, most):
    """Water-filling by clamping one round after another."""
    target, free, left = {}, set(range(len(sizes))), float(total)
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > most * sizes[i] + 1e-9]
        if not over:
            target |= {i: left * weights[i] / w for i in free}
            break
        for i in over:
            target[i] = most * sizes[i]
        left -= sum(target[i] for i in over)
        free -= set(over)
    return [target[i] for i in range(len(sizes))]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=12))
def test_water_filling_matches_rounds(spark, sizes):
    weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame(list(zip(range(len(sizes)), sizes, weights)), "i int, source_size long, weight double")
    got = {r["i"]: r["target"] for r in mixing.water_filled(df, sum(sizes), 3).collect()}
    assert [got[i] for i in range(len(sizes))] == pytest.approx(filled(sizes, weights, sum(sizes), 3))


def test_mix_comes_near_its_targets(documents, prose):
    rows = [(i, prose(20 + i % 70, i), "en", f"s{i % 7 if i % 3 else 0}") for i in range(1500)]
    rows += [(9000 + i, prose(12, i), "en", None) for i in range(4)]
    docs = documents(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["epochs"] * r["size"]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 12), s
    again = mixing.mix(docs).collect()
    assert sorted(got, key=str) == sorted(again, key=str)
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, *_ in rows}
    assert all(words[r["doc_id"]] == r["size"] for r in got)


def test_odd_rows_and_empty_table(documents):
    got = mixing.mix(documents(ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    assert {r["doc_id"]: r["size"] for r in got}[1] == 0 and {r["doc_id"]: r["size"] for r in got}[3] == 0
    assert mixing.mix(documents([])).count() == 0


def test_repeated_keeps_columns(documents, prose):
    docs = documents([(i, prose(9, i), "en", "ab"[i % 2]) for i in range(40)] + [(None, "no id", "en", "a")])
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    times = defaultdict(int)
    for r in out.collect():
        times[r["doc_id"]] += 1
    assert times == {r["doc_id"]: r["epochs"] for r in mixing.mix(docs).collect() if r["epochs"] and r["doc_id"] is not None} | {None: 1}


def test_long_documents_leave_no_gap(spark):
    """A long text in the sample's order neither ends the sample nor is taken far beyond the target."""
    sizes = {"a": [20000] + [300] * 60, "b": [10000] + [100] * 60, "c": [10000] * 3 + [100] * 60, "d": [9000]}
    extra = {"a": 15000, "b": 12000, "c": 15000, "d": 5000}
    rows = [(1000 * i + j, s, n) for i, (s, all_) in enumerate(sizes.items()) for j, n in enumerate(all_)]
    df = spark.createDataFrame(rows, "id long, source string, size long")
    targets = [(s, sum(n), len(n), float(extra[s])) for s, n in sizes.items()]
    targets = spark.createDataFrame(targets, "source string, source_size long, source_rows long, target double")
    for seed in (1, 2):
        got = mixing.taken_rows(df, targets, seed=seed).collect()
        assert len(got) == len(rows)
        taken = {s: sum(r["taken"] for r in got if r["source"] == s) for s in sizes}
        assert taken == {"a": 15000, "b": 12000, "c": 15000, "d": 9000}


def test_repeated_rows_with_clashing_names(spark):
    names = ["mix_id", "mix_epochs", "mix_times", "_mix_times", "epochs"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, "w " * (10 + i), "ab"[i % 2], *(f"{n}{i}" for n in names)) for i in range(40)]
    docs = spark.createDataFrame(rows, schema)
    out = mixing.repeated(docs, weights=(5.0, 2.0, 1.0), share=1.0, max_epochs=3)
    assert out.columns == docs.columns
    assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_repeated_decides_rows_by_bin_and_exception(spark, documents, prose, monkeypatch, threshold):
    """Every document as often as ``mix`` says, whether or not the small tables are broadcast; no text moves."""
    monkeypatch.setattr(mixing, "BIN_ROWS", 16)
    words = [1 + (i * 7) % 23 for i in range(400)]
    words[3], words[50], words[77] = 900, 0, 400
    docs = documents([(i, prose(n, i), "en", [None, "a", "a", "b", "a"][i % 5]) for i, n in enumerate(words)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = mixing.repeated(docs)
        times = defaultdict(int)
        for r in out.collect():
            times[r["doc_id"]] += 1
        if threshold != "-1":
            assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    taken = mixing.mix(docs)
    assert times == {r["doc_id"]: r["epochs"] for r in taken.collect() if r["epochs"]}
    bins, others = mixing.decisions(taken)
    assert bins.count() > 12 and others.count() < 200
