"""Merkle manifest of a dataset: a hash tree over all rows, with a proof for each.

Per group (for instance a source) the rows are leaves in a fixed order; every ``FAN`` consecutive nodes
of a level have their hash as parent (a shorter last run too) until one node, the group's subroot,
remains. The subroots, in the order of their groups, make a tree of the same kind above them.

Positions come from a range partitioning by (group, order, leaf, a number per row), so that neither a
group with a third of all rows nor one row repeated as often is one task: each row's place in its
partition, plus the rows of its group in the partitions before. Levels are built one by one; each is a
third of the one below.

Proofs come by pointer jumping. A node holds the siblings on the way towards an ancestor: a list of
(left, right), what stands left and right of the way at each level. A self-join looks up the ancestor
and appends its list, which doubles the distance. Only nodes at multiples of the distance are looked
up again, so those above the first ``LEAF_REACH`` levels (a fraction of FAN ** -LEAF_REACH) reach
the root among themselves, and the leaves need one more join with them. The children of a subroot begin
with the way through the upper tree, so the leaves meet it there and are never joined by group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefkit.llm.common import written

#: Children of a node.
FAN = 3
#: Levels that the leaves' own lists cover before they meet nodes that know their way to the root.
LEAF_REACH = 4

_WAY = "array<struct<left: binary, right: binary>>"


def row_hash(columns: Sequence[Column]) -> Column:
    """sha256 (32 bytes) of the values: each its byte count, a colon and its text in UTF-8; null is ``-``."""

    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[framed(c) for c in columns]).cast("binary"), 256))


def text_of(digest: Column) -> Column:
    """A digest as lower-case hex text."""
    return F.lower(F.hex(digest))


def _hash_of(parts: Column) -> Column:
    """The hash of digests (array of binary), each as its hex text."""
    return F.unhex(F.sha2(F.array_join(F.transform(parts, text_of), "").cast("binary"), 256))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place`` (from 0 within ``tree``) and ``n`` (rows of the tree), by ``order``, null
    first. The table is written twice: once with a number per row that parts equal rows, once sorted."""
    rows = written(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-rows")
    by = ["tree", *order, "tie"]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()  # the partition and the place in it
    dealt = written(dealt.drop("tie").withColumn("at", at).withColumn("part", F.shiftright(at, 33)), "merkle-sorted")
    runs = dealt.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    # One row per tree and partition that holds it: a tree has as many rows here as it has partitions.
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("tree").alias("r_tree"),
        F.col("part").alias("r_part"),
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy("tree")).alias("n"),
    )
    met = dealt.join(runs, (F.col("part") == F.col("r_part")) & F.col("tree").eqNullSafe(F.col("r_tree")))
    return met.withColumn("place", F.col("at") + F.col("shift")).drop("r_tree", "r_part", "at", "part", "shift")


def levels(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level (``tree, level, up, n, members``: the run's nodes in order, with the row's
    ``item`` at level 0) and the roots (``tree, hash, item``; ``item`` where a root is a lone leaf).

    ``leaves`` has ``tree, place, n, hash, item``.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, runs, roots = leaves, [], leaves.filter("n = 1").select("tree", "hash", "item")
    level = 0
    while most > 1:
        member = F.struct((F.col("place") % FAN).cast("int").alias("at"), "hash", "item")
        up = F.floor(F.col("place") / FAN).cast("bigint")
        run = nodes.filter("n > 1").groupBy("tree", up.alias("up")).agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(member), lambda a, b: a["at"] - b["at"]).alias("members")
        )
        run = written(run.withColumn("level", F.lit(level)), f"merkle-level{level}")
        runs.append(run)
        nodes = run.select(
            "tree",
            F.col("up").alias("place"),
            F.ceil(F.col("n") / FAN).cast("bigint").alias("n"),
            _hash_of(F.col("members.hash")).alias("hash"),
            F.lit(None).cast(leaves.schema["item"].dataType).alias("item"),
        )
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", "hash", "item"))
        most, level = -(-most // FAN), level + 1
    return runs, roots


def _steps(runs: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """Every node below a root: ``tree, level, place, hash, item, way, root``. ``way`` holds its own step;
    children of a root also what ``above`` (``tree, up_way, root``) says of the way on."""
    out = None
    for run in runs:
        flat = run.select("tree", "level", "up", "n", "members", F.posexplode("members").alias("at", "me"))
        side = lambda keep: F.array_join(
            F.transform(F.filter("members", keep), lambda m: F.hex(m["hash"])), ""
        )
        step = F.struct(
            F.unhex(side(lambda m: m["at"] < F.col("at"))).alias("left"),
            F.unhex(side(lambda m: m["at"] > F.col("at"))).alias("right"),
        )
        rows = flat.select(
            "tree",
            "level",
            (F.col("up") * FAN + F.col("at")).alias("place"),
            F.col("me.hash").alias("hash"),
            F.col("me.item").alias("item"),
            F.array(step).cast(_WAY).alias("way"),
            (F.col("n") <= FAN).alias("last"),
        )
        out = rows if out is None else out.unionByName(rows)
    if above is None:
        return out.drop("last").withColumn("root", F.lit(None).cast("binary"))
    # A root has FAN children at most.
    top = above.select(F.col("tree").alias("a_tree"), "up_way", "root")
    met = out.filter("last").join(top, F.col("tree").eqNullSafe(F.col("a_tree"))).drop("a_tree", "last")
    met = met.withColumn("way", F.concat("way", "up_way")).drop("up_way")
    return out.filter("NOT last").drop("last").withColumn("root", F.lit(None).cast("binary")).unionByName(met)


def _jumped(nodes: DataFrame, ancestors: DataFrame, distance: int) -> DataFrame:
    """``nodes`` whose ways go on with those of the ancestors ``distance`` levels up (of a way that has
    ended there is no ancestor)."""
    up = ancestors.select(
        F.col("tree").alias("a_tree"),
        (F.col("level") - distance).alias("a_level"),
        F.col("place").alias("a_place"),
        F.col("way").alias("a_way"),
        F.col("root").alias("a_root"),
    )
    reach = F.floor(F.col("place") / FAN**distance).cast("bigint")
    met = nodes.join(
        up, F.col("tree").eqNullSafe(F.col("a_tree")) & (F.col("level") == F.col("a_level")) & (reach == F.col("a_place")), "left"
    )
    none = F.array().cast(_WAY)
    return met.select(
        *[c for c in nodes.columns if c not in ("way", "root")],
        F.concat("way", F.coalesce("a_way", none)).alias("way"),
        F.coalesce("root", "a_root").alias("root"),
    )


def leaf_ways(runs: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The leaves of trees with more than one: ``tree, hash, item, way, root``, by pointer jumping."""
    height = len(runs)
    nodes = _steps(runs, above)
    distance = 1
    while distance < min(height, LEAF_REACH):
        nodes = written(nodes, f"merkle-reach{distance}")
        far = F.col("level") % (2 * distance)
        nodes = _jumped(nodes.filter(far == 0), nodes.filter(far == distance), distance)
        distance *= 2
    if height > distance:
        nodes = written(nodes, f"merkle-reach{distance}")
        upper, reach = nodes.filter(F.col("level") > 0).drop("item", "hash"), distance
        while distance + reach < height:
            far = (F.col("level") - distance) % (2 * reach)
            upper = written(_jumped(upper.filter(far == 0), upper.filter(far == reach), reach), f"merkle-upper{reach}")
            reach *= 2
        nodes = _jumped(nodes.filter("level = 0"), upper.filter(F.col("level") == distance), distance)
    return nodes.filter("level = 0").select("tree", "hash", "item", "way", "root")


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` (32 bytes each) and ``way``: for each level from the leaf to the
    root the siblings (``left``, ``right``: digests one behind the other, empty where there are none).

    ``leaf`` names the column of leaf hashes (binary). The rows of one ``group`` (null is a group of its
    own, and the first) stand by ``order``, null first, then by leaf; repeated rows are leaves of their
    own. A group of one row has its leaf as subroot, a table with one group its subroot as root. An empty
    table gives no rows. Other columns come back under their names.
    """
    item = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    flat = rows.select(F.col(f"`{group}`").alias("tree"), F.col(f"`{leaf}`").alias("hash"), item.alias("item"))
    keys = [F.col("item")[c].alias(f"o{k}") for k, c in enumerate(order)]
    leaves = written(
        numbered(flat.select("*", *keys), [*(f"o{k}" for k in range(len(keys))), "hash"]).select("tree", "place", "n", "hash", "item"),
        "merkle-leaves",
    )
    runs, subroots = levels(leaves)
    # The upper tree: its leaves are the subroots, its items the groups. A lone leaf's item waits below.
    subroots = written(subroots, "merkle-subroots")
    named = subroots.select(F.lit(0).alias("tree"), "hash", F.struct("tree").alias("item"), F.col("tree").alias("o0"))
    top_runs, roots = levels(written(numbered(named, ["o0"]).select("tree", "place", "n", "hash", "item"), "merkle-tops"))
    root = roots.select(F.col("hash").alias("root"))
    if top_runs:
        above = leaf_ways(top_runs, None).select(F.col("item.tree").alias("tree"), F.col("way").alias("up_way"), F.col("hash").alias("root"))
    else:
        above = subroots.select("tree", F.array().cast(_WAY).alias("up_way"), F.col("hash").alias("root"))
    above = written(above, "merkle-above")
    # From here on ``root`` of a way is its subroot: the root of its group's tree.
    lone = subroots.filter("item IS NOT NULL").join(
        above.select(F.col("tree").alias("a_tree"), "up_way", "root"), F.col("tree").eqNullSafe(F.col("a_tree"))
    )
    out = lone.select("item", F.col("up_way").alias("way"), F.col("root").alias("subroot"))
    if runs:
        out = out.unionByName(leaf_ways(runs, above).select("item", "way", F.col("root").alias("subroot")))
    taken = [f"`{c}`" for c in rows.columns]
    return out.select(*[F.col(f"item.{c}") for c in taken], "subroot", root.scalar().alias("root"), "way")


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf hash gives with the siblings of ``way``."""

    def parent(node: Column, step: Column) -> Column:
        return F.unhex(F.sha2(F.lower(F.concat(F.hex(step["left"]), F.hex(node), F.hex(step["right"]))).cast("binary"), 256))

    return F.aggregate(way, leaf, parent)


def proof_hash(way: Column) -> Column:
    """sha256 of all siblings of ``way`` as hex text, level by level, left to right."""
    sides = F.transform(way, lambda s: F.lower(F.concat(F.hex(s["left"]), F.hex(s["right"]))))
    return F.unhex(F.sha2(F.array_join(sides, "").cast("binary"), 256))
