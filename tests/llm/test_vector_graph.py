import numpy as np
import pytest

from prefkit.llm import vector_graph as vg


def brute(x, ids, least):
    sim = x @ x.T >= least
    np.fill_diagonal(sim, False)
    comp = np.arange(len(x))
    while True:
        new = np.minimum(comp, np.where(sim, comp[None, :], len(x)).min(1))
        if (new == comp).all():
            break
        comp = new
    return {int(i): (int(n), int(min(ids[comp == c]))) for i, n, c in zip(ids, sim.sum(1), comp)}


def crowd(seed, n=500, d=24, hot=120):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d))
    x[1:hot] = x[0] + 0.12 * r.normal(size=(hot - 1, d))
    for i in range(hot, n, 9):
        x[i + 1 : i + 4] = x[i] + 0.1 * r.normal(size=(min(3, n - i - 1), d))
    return x[r.permutation(n)]


@pytest.mark.parametrize("most", [8192, 150])
def test_links_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(vg, "SHARD_MOST", most)  # the small bound splits shards into parts
    x = crowd(1).astype(np.float32)
    x[7], x[8] = x[6], 2 * x[6]  # an equal vector, and a parallel one
    ids = np.arange(1000, 1000 + len(x))
    rows = [(int(i), v.tolist(), 0, "e") for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, e string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vg.near_duplicate_vectors(df, vg.Settings(shard=300)).collect()}
    want = brute(vg.unit(x), ids, 0.95)
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.97 * links
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.98 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]),
        (8, [1.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, -0.0]), (11, [0.0, 1.0]), (12, [1e-30, 0.0]), (None, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, id string")
    got = sorted((tuple(r) for r in vg.near_duplicate_vectors(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 11)]
    near = [(8, 4, 8, True), (9, 4, 8, False), (9, 4, 8, False), (10, 4, 8, False), (12, 4, 8, False)]
    assert got == sorted([*alone, *near, (None, 0, None, False)], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vg.near_duplicate_vectors(df).count() == 0


def test_leaders_are_apart_and_cover():
    x = vg.unit(crowd(2)).astype(np.float32)
    lead = vg.leading(x, 0.95)
    own = np.flatnonzero(lead == np.arange(len(x)))
    sim = x[own] @ x[own].T
    np.fill_diagonal(sim, 0)
    assert sim.max() < 0.95 and (np.einsum("nd,nd->n", x, x[lead]) > 0.949).all()


def test_pruned_neighbours_do_not_cover_each_other():
    x = vg.unit(np.random.default_rng(3).normal(size=(200, 8))).astype(np.float32)
    near = vg.robust_pruned(x, 6, 40, 1.2)
    assert (near[:, 0] == np.argsort(-(x @ x.T - 9 * np.eye(200)), axis=1)[:, 0]).all()
    for v in range(0, 200, 20):
        chosen = near[v][near[v] >= 0]
        d = np.linalg.norm(x[chosen] - x[v], axis=1)
        between = np.linalg.norm(x[chosen][:, None] - x[chosen][None], axis=2)
        for i in range(len(chosen)):
            assert all(1.2 * between[i, j] > d[j] - 1e-5 for j in range(i + 1, len(chosen)))


def test_search_finds_every_row_from_the_medoids():
    x = vg.unit(crowd(4, n=800, hot=300)).astype(np.float32)
    s = vg.Settings()
    a, b = vg.flat_graph(x, s)
    assert (a != b).all()
    lead = np.flatnonzero(vg.leading(x, s.least) == np.arange(len(x)))
    near = np.full((len(x), 200), -1, np.int32)
    for v in lead:
        out = [w for w in b[a == v] if w in set(lead.tolist())][:200]
        near[v, : len(out)] = out
    ids, _ = vg.beam_search(x, near, lead[vg.medoids(x[lead])], x[lead], s.beam)
    assert (ids == lead[:, None]).any(1).mean() > 0.98


def test_audit_measures_recall(spark):
    x = crowd(5, n=300)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, e array<double>")
    none = spark.createDataFrame([], "a long, b long")
    s = vg.Settings(audited=10_000)
    recall, links = vg.audited_recall(vectors, none, s)
    want = sum(n for n, _ in brute(vg.unit(x), np.arange(300), 0.95).values()) // 2
    assert recall == 0.0 and links == want
    recall, _ = vg.audited_recall(vectors, vg.graph_links(vectors, s), s)
    assert recall >= 0.97


def test_audit_counts_vectors_and_grows(spark):
    """A crowd whose links are all found does not hide lost pairs; a small sample is enlarged."""
    r = np.random.default_rng(8)
    x = r.normal(size=(140, 24))
    x[:40] = x[0] + 0.01 * r.normal(size=(40, 24))
    x[41:140:2] = x[40:140:2]  # 50 pairs
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, e array<double>")
    crowd_links = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 40)], "a long, b long")
    recall, links = vg.audited_recall(vectors, crowd_links, vg.Settings(audited=5))
    assert recall == pytest.approx(40 / 140) and links == 40 * 39 // 2 + 50


def test_low_recall_fails(spark, monkeypatch):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<double>")
    monkeypatch.setattr(vg, "audited_recall", lambda *_: (0.5, 40))
    with pytest.raises(RuntimeError, match="0.500 of 40"):
        vg.near_duplicate_vectors(table, vg.Settings(tries=1))


def test_vectors_of_rarer_lengths_are_linked_among_themselves(spark):
    rows = [(i, [1.0, 0.0, float(i)]) for i in range(5)] + [(10, [1.0, 0.0]), (11, [2.0, 0.0]), (12, [1.0, 0.0]), (13, [0.0, 1.0]), (14, [3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vg.near_duplicate_vectors(table).collect()}
    assert [got[i] for i in (10, 11, 12, 13, 14)] == [(2, 10), (2, 10), (2, 10), (0, 13), (0, 14)]
    near = {(a, b) for a, x in rows[:5] for b, y in rows[:5] if a != b and sum(p * q for p, q in zip(x, y)) >= 0.95 * (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5}
    assert all(got[a][0] == sum(x == a for x, _ in near) for a in range(5))
