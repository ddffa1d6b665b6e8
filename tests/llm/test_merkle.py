import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from prefkit.llm import merkle as M

SCHEMA = "doc_id long, source string, text string, tree string, `way.x` string, item string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The levels of one tree, leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        low = out[-1]
        out.append([h(*low[i : i + 3]) for i in range(0, len(low), 3)])
    return out


def way(tree, k):
    for level in tree[:-1]:
        first = k // 3 * 3
        run = level[first : first + 3]
        yield "".join(run[: k - first]), "".join(run[k - first + 1 :])
        k //= 3


def brute(rows):
    groups = defaultdict(list)
    for i, source, text in rows:
        groups[source].append((i is not None, i or 0, framed(i, source, text)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: climb([x for *_, x in sorted(groups[s])]) for s in order}
    top = climb([low[s][-1][0] for s in order])
    out = []
    for j, s in enumerate(order):
        for k, leaf in enumerate(low[s][0]):
            out.append((leaf, low[s][-1][0], top[-1][0], [*way(low[s], k), *way(top, j)]))
    return sorted(out)


def made(spark, rows):
    docs = spark.createDataFrame([(*r, "t", "w", "i") for r in rows], SCHEMA)
    leaf = M.row_hash([F.col(c) for c in ("doc_id", "source", "text")])
    return M.manifest(docs.withColumn("leaf", leaf), "source", ["doc_id"], "leaf")


def found(spark, rows):
    got = made(spark, rows)
    assert got.columns == ["doc_id", "source", "text", "tree", "way.x", "item", "leaf", "subroot", "root", "way"]
    return sorted(
        (r.leaf.hex(), r.subroot.hex(), r.root.hex(), [(s.left.hex(), s.right.hex()) for s in r.way]) for r in got.collect()
    )


def rows_of(sizes, seed=1):
    r = random.Random(seed)
    rows = [(i, f"s{k}", f"text {i} é") for k, n in enumerate(sizes) for i in range(n)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [[1], [3], [4, 1, 1], [100, 9, 10, 28, 2, 1, 1, 82]])
def test_against_brute_force(spark, sizes):
    rows = rows_of(sizes)
    assert found(spark, rows) == brute(rows)


def test_deep_tree_with_a_hot_group(spark):
    """Eight levels and more: upper nodes reach the root among themselves."""
    rows = rows_of([2300, 700, 1])
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, None, ""), (None, None, "x"), (2, "", "b"), (2, "", "b"), (2, "", "a"), (3, "é", "c" * 3_000_000), (3, "z", None)]
    rows += [(4, "same", "copy")] * 40
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_only_changed_leaves_fail(spark):
    rows = rows_of([30, 5, 1])
    got = made(spark, rows)
    seen = F.when(F.col("doc_id") % 2 == 0, F.unhex(F.sha2(F.hex("leaf").cast("binary"), 256))).otherwise(F.col("leaf"))
    for r in got.select("doc_id", "root", M.folded(seen, F.col("way")).alias("folded"), M.proof_hash(F.col("way")).alias("p"), "way").collect():
        assert (r.folded == r.root) == (r.doc_id % 2 == 1)
        assert r.p.hex() == h(*(x.hex() for s in r.way for x in (s.left, s.right)))


def test_the_partitioning_does_not_matter(spark):
    rows = rows_of([200, 40])
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "31")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
