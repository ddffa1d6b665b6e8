"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards (each to its nearest centroids). Every shard builds a
graph: a vector's candidates are pruned robustly, so that its few neighbours lie in different
directions. A vector's adjacency lists of all its shards are united. Each vector then searches the
shards' united graph of its nearest centroid: a greedy beam search from medoids, and from whatever
it finds within the range an expansion along the graph until nothing new is within it. Found pairs
are verified by their cosine in double precision. A brute-force audit of sampled vectors measures the
recall; if it is below what is asked, more overlap and a wider beam are tried. Links that are still
below ``demanded`` then are not used: the query fails.

Bounds: equal vectors are one class, carried by one of them. A shard of more than ``SHARD_MOST``
vectors is split by hash into parts, and the cluster's vectors search all parts in blocks, so no
task holds more than one part and one block, however many vectors lie in one place.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit.llm.common import written
from prefkit.llm.components import components


@dataclass(frozen=True)
class Settings:
    least: float = 0.95  # cosine of a link
    overlap: int = 3  # shards of a vector
    shard: int = 4096  # vectors of a shard, on average
    clusters_most: int = 4096  # centroids, which are broadcast
    sample: int = 65_536  # vectors that centroids are fitted on, in expectation
    degree: int = 24  # neighbours of a vector in a shard's graph
    pool: int = 64  # candidates that are pruned to them
    alpha: float = 1.2  # how much nearer a neighbour must be to cover a candidate
    beam: int = 40  # width of the greedy search
    audited: int = 400  # vectors whose links are found by brute force as well, at first
    audited_most: int = 6400  # the same, while few of them have links
    linked: int = 100  # of them with links, for the audit to say anything
    recall: float = 0.97  # what the audit asks for
    demanded: float = 0.9  # below this after the last try the query fails
    tries: int = 3
    seed: int = 20240604


#: Vectors of one part of a shard, and of one block of searching vectors.
SHARD_MOST = 8192
#: Audited vectors that a batch is compared with at once.
AUDIT_BLOCK = 512


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _rows(lists: pd.Series) -> np.ndarray:
    return np.stack(lists.to_list()) if len(lists) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaled by the largest component first, so that
    neither squares overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_centroids(x: np.ndarray, k: int, seed: int, rounds: int = 4) -> np.ndarray:
    """Unit centroids of unit rows by a few rounds of k-means from sampled rows."""
    draw = np.random.Generator(np.random.PCG64(seed))
    centers = x[draw.choice(len(x), k, replace=False)].astype(np.float32)
    x = x.astype(np.float32)
    for _ in range(rounds if k > 1 else 0):
        near = np.concatenate([(x[i : i + 8192] @ centers.T).argmax(1) for i in range(0, len(x), 8192)])
        order = np.argsort(near, kind="stable")
        present, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers[present] = np.where(norm > 1e-6, sums / np.maximum(norm, 1e-6), centers[present])
    return centers


def leading(x: np.ndarray, least: float) -> np.ndarray:
    """For each unit row the row that leads it: the first one of at least ``least`` that is led by
    itself. Leaders are less alike than ``least``; a row without any such neighbour leads itself."""
    n = len(x)
    near = np.zeros(n, bool)
    for i in range(0, n, 1024):
        sim = x[i : i + 1024] @ x.T
        sim[np.arange(len(sim)), np.arange(i, i + len(sim))] = -9
        near[i : i + 1024] = sim.max(1) >= least
    lead = np.where(near, -1, np.arange(n))
    for v in np.flatnonzero(near).tolist():
        if lead[v] < 0:
            lead[(x @ x[v] >= least) & (lead < 0)] = v
            lead[v] = v
    return lead


def robust_pruned(x: np.ndarray, degree: int, pool: int, alpha: float) -> np.ndarray:
    """Adjacency (rows x degree, -1 for none) of unit rows: of the nearest ``pool`` and a few far rows,
    the nearest is taken again and again, and what it covers is dropped: candidates that are
    ``alpha`` times nearer to it than to the row itself."""
    n = len(x)
    draw = np.random.Generator(np.random.PCG64(n))
    pool = min(pool, n - 1)
    out = np.full((n, degree), -1, np.int32)
    if pool <= 0:
        return out
    for i in range(0, n, 512):
        rows = np.arange(i, min(i + 512, n))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -9
        near = np.argpartition(-sim, pool - 1, axis=1)[:, :pool]
        far = draw.integers(0, n, (len(rows), 8))
        cand = np.concatenate([near, far], axis=1)
        sims = np.take_along_axis(sim, cand, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        free = sims > -2
        free[:, 1:] &= cand[:, 1:] != cand[:, :-1]
        dist = np.sqrt(np.maximum(2 - 2 * sims, 0))
        vectors = x[cand]
        between = alpha * np.sqrt(np.maximum(2 - 2 * vectors @ vectors.transpose(0, 2, 1), 0))
        at = np.arange(len(rows))
        for d in range(degree):
            first = free.argmax(1)
            some = free[at, first]
            if not some.any():
                break
            out[rows[some], d] = cand[at, first][some]
            free[at, first] = False
            free &= between[at, first] > dist
    return out


def near_edges(x: np.ndarray, least: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, row) of each row and its nearest ``most`` rows of at least ``least``."""
    n, a, b = len(x), [], []
    k = min(most, n - 1)
    for i in range(0, n if k > 0 else 0, 1024):
        sim = x[i : i + 1024] @ x.T
        sim[np.arange(len(sim)), np.arange(i, i + len(sim))] = -9
        rows = np.flatnonzero(sim.max(1) >= least)
        best = np.argpartition(-sim[rows], k - 1, axis=1)[:, :k]
        good = np.take_along_axis(sim[rows], best, 1) >= least
        a.append(np.repeat(rows + i, k)[good.ravel()])
        b.append(best.ravel()[good.ravel()])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def wider(least: float) -> float:
    """The cosine of twice the angle: two rows within ``least`` of a third are within this."""
    return max(-1.0, 2 * least * least - 1)


def flat_graph(x: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of a shard's graph. Leaders have robustly pruned edges among themselves, so
    that crowds of near-equal rows do not trap the search; rows are joined, both ways, with their
    leader and their nearest rows within twice the range."""
    lead = leading(x, s.least)
    leaders = np.flatnonzero(lead == np.arange(len(x)))
    near = robust_pruned(x[leaders], s.degree, s.pool, s.alpha)
    row, nth = np.nonzero(near >= 0)
    led = np.flatnonzero(lead != np.arange(len(x)))
    a, b = near_edges(x, wider(s.least), s.degree // 2)
    out_a = [leaders[row], a, b, led, lead[led]]
    out_b = [leaders[near[row, nth]], b, a, lead[led], led]
    edges = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)]), axis=1)
    return edges[0], edges[1]


def beam_search(x: np.ndarray, near: np.ndarray, starts: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all rows of ``q`` at once over adjacency ``near``: ids and similarities of the
    best ``beam`` rows met (-1 where there are fewer)."""
    m = len(q)
    ids = np.full((m, beam), -1, np.int64)
    sims = np.full((m, beam), -9, np.float32)
    starts = starts[:beam]
    ids[:, : len(starts)] = starts
    sims[:, : len(starts)] = q @ x[starts].T
    done = ids < 0
    active = np.arange(m)
    for _ in range(6 * beam):
        open_sims = np.where(done[active], -9, sims[active])
        best = open_sims.argmax(1)
        go = open_sims[np.arange(len(active)), best] > -9
        active, best = active[go], best[go]
        if not len(active):
            break
        done[active, best] = True
        step = near[ids[active, best]]
        known = (step[:, :, None] == ids[active][:, None, :]).any(2) | (step < 0)
        s = np.einsum("qrd,qd->qr", x[np.maximum(step, 0)], q[active])
        s[known] = -9
        all_s = np.concatenate([sims[active], s], 1)
        all_i = np.concatenate([ids[active], np.where(known, -1, step)], 1)
        all_d = np.concatenate([done[active], known], 1)
        top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        sims[active] = np.take_along_axis(all_s, top, 1)
        ids[active] = np.take_along_axis(all_i, top, 1)
        done[active] = np.take_along_axis(all_d, top, 1)
    return ids, sims


def range_expansion(x, bounds, ends, q, ids, sims, least: float):
    """(row of q, row of x) of all pairs of at least ``least`` met by following the graph (edges of row
    i: ``ends[bounds[i]:bounds[i + 1]]``) from what the search found, within twice the range."""
    n, wide = len(x), wider(least)
    row, col = np.nonzero((sims >= wide) & (ids >= 0))
    a, b, s = row.astype(np.int64), ids[row, col], sims[row, col]
    seen = np.zeros(len(q) * n, bool)
    seen[a * n + b] = True
    found_a, found_b = [], []
    while len(a):
        found_a.append(a[s >= least])
        found_b.append(b[s >= least])
        degree = bounds[b + 1] - bounds[b]
        steps = np.cumsum(degree)
        nexts = []
        i = 0
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(steps, (steps[i - 1] if i else 0) + (1 << 18), "right")))
            d = degree[i:j]
            at = np.arange(d.sum()) - np.repeat(np.cumsum(d) - d - bounds[b[i:j]], d)
            keys = np.repeat(a[i:j] * n, d) + ends[at]
            keys = np.unique(keys[~seen[keys]])
            seen[keys] = True
            u, v = keys // n, keys % n
            sim = np.einsum("pd,pd->p", q[u], x[v])
            good = sim >= wide
            nexts.append((u[good], v[good], sim[good]))
            i = j
        a, b, s = (np.concatenate(c) for c in zip(*nexts))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def medoids(x: np.ndarray, count: int = 8) -> np.ndarray:
    """Start rows: the row nearest to the mean of all, and of ``count`` runs of rows."""
    parts = [x, *np.array_split(x, min(count, len(x)))]
    at, out = 0, []
    for i, part in enumerate(parts):
        out.append((0 if i == 0 else at) + int((part @ part.mean(0)).argmax()))
        at += len(part) if i else 0
    return np.unique(out)


_GRAPH = "id long, near array<long>"
_LINKS = "a long, b long"


def _build(s: Settings):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        ids = group["id"].to_numpy()
        a, b = flat_graph(unit(_rows(group["e"])).astype(np.float32), s)
        bounds = np.searchsorted(a, np.arange(len(ids) + 1))
        return pd.DataFrame({"id": ids, "near": [ids[b[i:j]] for i, j in zip(bounds[:-1], bounds[1:])]})

    return run


def _search(s: Settings):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        members = group[group["member"]].sort_values("id", kind="stable")
        asking = group[~group["member"]].sort_values("id", kind="stable")
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        if not len(members) or not len(asking):
            return none
        ids, ask = members["id"].to_numpy(), asking["id"].to_numpy()
        x, q = unit(_rows(members["e"])), unit(_rows(asking["e"]))
        x32, q32 = x.astype(np.float32), q.astype(np.float32)
        lists = members["near"].to_list()
        flat = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
        owner = np.repeat(np.arange(len(ids)), [len(r) for r in lists])
        at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        here = ids[at] == flat  # a list united from several shards also names vectors of others
        owner, at = owner[here], at[here]
        bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
        # The greedy search walks leaders only.
        leads = leading(x32, s.least) == np.arange(len(ids))
        walk = leads[owner] & leads[at]
        w_owner, w_at = owner[walk], at[walk]
        w_bounds = np.searchsorted(w_owner, np.arange(len(ids) + 1))
        near = np.full((len(ids), max(1, int(np.diff(w_bounds).max()))), -1, np.int32)
        near[w_owner, np.arange(len(w_at)) - w_bounds[w_owner]] = w_at
        walkers = np.flatnonzero(leads)
        starts = walkers[medoids(x32[walkers])]
        pairs_a, pairs_b = [], []
        for i in range(0, len(q), 1024):
            part = q32[i : i + 1024]
            found, sims = beam_search(x32, near, starts, part, s.beam)
            a, b = range_expansion(x32, bounds, at, part, found, sims, s.least - 1e-4)
            for j in range(0, len(a), 1 << 16):
                u, v = a[j : j + (1 << 16)] + i, b[j : j + (1 << 16)]
                cosine = np.einsum("pd,pd->p", q[u], x[v])
                good = (cosine >= s.least) & (ask[u] != ids[v])
                pairs_a.append(ask[u[good]])
                pairs_b.append(ids[v[good]])
        if not pairs_a:
            return none
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    return run


def _assign(centers, overlap: int):
    """(id, e) -> one row per vector and shard: cluster, rank (0: the nearest centroid)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centers.value
        k = min(overlap, len(c))
        for batch in batches:
            if not len(batch):
                continue
            x = unit(_matrix(batch.column("e"))).astype(np.float32)
            sim = x @ c.T
            order = np.argsort(-sim, axis=1, kind="stable")[:, :k]
            take = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [batch.column("id").take(take), batch.column("e").take(take)]
            columns += [pa.array(order.ravel().astype(np.int32)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(x)))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "e", "cluster", "rank"])

    return run


def graph_links(vectors: DataFrame, s: Settings) -> DataFrame:
    """Links (a < b) found among ``vectors`` (id long, distinct; e: array<double> of one length)."""
    spark = vectors.sparkSession
    n = vectors.count()
    k = max(1, min(s.clusters_most, -(-n * s.overlap // s.shard)))
    draw = F.pmod(F.xxhash64("id", F.lit(s.seed)), F.lit(1 << 20)) / float(1 << 20)
    rows = vectors.filter(draw < min(1.0, max(s.sample, 0) / max(n, 1))).orderBy("id").select("e").collect()
    if not rows:
        rows = vectors.orderBy("id").limit(s.sample).select("e").collect()
    if not rows:
        return vectors.select(F.col("id").alias("a"), F.col("id").alias("b"))
    sample = unit(np.array([r["e"] for r in rows]))
    k = min(k, len(sample))
    centers = spark.sparkContext.broadcast(spherical_centroids(sample, k, s.seed))
    kind = "id long, e array<double>, cluster int, rank int"
    placed = written(vectors.select("id", "e").mapInArrow(_assign(centers, s.overlap), kind), "vector-shards")
    # Parts of a cluster: as many as its vectors need, and as many blocks of searching vectors.
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("size"))
    sizes = written(sizes.withColumn("parts", F.ceil(F.col("size") / SHARD_MOST).cast("int")), "shard-sizes")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = placed.join(F.broadcast(sizes.select("cluster", "parts")), "cluster").withColumn("part", part)
    built = placed.groupBy("cluster", "part").applyInPandas(_build(s), _GRAPH)
    united = built.select("id", F.explode("near").alias("other")).groupBy("id").agg(F.collect_set("other").alias("near"))
    united = written(united, "vector-graph")
    blocks = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    members = placed.join(united, "id", "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
    members = members.select("cluster", "part", blocks.alias("block"), "id", "e", F.lit(True).alias("member"), "near")
    asking = placed.filter("rank = 0").select(
        "cluster", blocks.alias("part"), F.col("part").alias("block"), "id", "e", F.lit(False).alias("member"), F.array().cast("array<long>").alias("near")
    )
    tasks = members.unionByName(asking).groupBy("cluster", "part", "block")
    return written(tasks.applyInPandas(_search(s), _LINKS).distinct(), "vector-links")


def true_links(vectors: DataFrame, sample: DataFrame, s: Settings) -> DataFrame:
    """(a, b) of all links of the ``sample``'s vectors, by brute force over ``vectors``."""
    rows = sample.collect()
    held = vectors.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in rows]), unit(np.array([r["e"] for r in rows]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = held.value
        for batch in batches:
            if len(batch):
                own, x = batch.column("id").to_numpy(), unit(_matrix(batch.column("e")))
                for at in range(0, len(ids), AUDIT_BLOCK):
                    u, v = np.nonzero(x @ q[at : at + AUDIT_BLOCK].T >= s.least)
                    a, b = own[u], ids[at + v]
                    lo, hi = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
                    yield pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], ["a", "b"])

    return written(vectors.select("id", "e").mapInArrow(run, _LINKS).distinct(), "true-links")


def audited_recall(vectors: DataFrame, links: DataFrame, s: Settings) -> tuple[float, int]:
    """Share of its true links that ``links`` holds, averaged over the sampled vectors that have any (so
    that a crowd does not outweigh pairs), and the number of true links of the sample. 1.0 without any.

    The sample begins with ``audited`` vectors and grows fourfold until ``linked`` of them have links, or
    it holds all vectors or ``audited_most``; with fewer a warning says how many there were.
    """
    n = vectors.count()
    if not n:
        return 1.0, 0
    draw = F.pmod(F.xxhash64("id", F.lit(s.seed + 1)), F.lit(1 << 20)) / float(1 << 20)
    audited = s.audited
    while True:
        sample = vectors.filter(draw < min(1.0, audited / n)).select("id", "e")
        if not sample.isEmpty():
            true = true_links(vectors, sample, s)
            held = true.join(links.select("a", "b").distinct().withColumn("held", F.lit(1.0)), ["a", "b"], "left")
            ends = held.select(F.explode(F.array("a", "b")).alias("id"), F.coalesce("held", F.lit(0.0)).alias("held"))
            per = ends.join(sample.select("id"), "id", "left_semi").groupBy("id").agg(F.avg("held").alias("held"))
            row = per.agg(F.avg("held").alias("recall"), F.count("*").alias("n")).first()
            found, recall, total = row["n"], row["recall"], true.count()
        else:
            found, recall, total = 0, None, 0
        if found >= s.linked or audited >= min(n, max(s.audited, s.audited_most)):
            break
        audited *= 4
    if found < s.linked and audited < n:
        warnings.warn(f"the audit of about {audited} of {n} vectors found only {found} with links", stacklevel=2)
    return (1.0 if recall is None else recall), total


def audited_links(vectors: DataFrame, s: Settings) -> DataFrame:
    """``graph_links`` of vectors of one length, with the recall audited; built again, wider, where it is low."""
    for _ in range(s.tries):
        links = graph_links(vectors, s)
        recall, audited = audited_recall(vectors, links, s)
        if recall >= s.recall:
            return links
        s = replace(s, overlap=s.overlap * 2, beam=s.beam * 2)
    if recall < s.demanded:
        raise RuntimeError(f"recall {recall:.3f} of {audited} audited links after {s.tries} tries, {s.demanded} is demanded")
    warnings.warn(f"recall {recall:.3f} of {audited} audited links after {s.tries} tries, {s.recall} was asked for", stacklevel=2)
    return links


def near_duplicate_vectors(
    table: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links (other vectors linked directly), component_id (the
    least vec_id reachable by links, itself included), kept (vec_id = component_id).

    Vectors of cosine ``least`` or more are linked. Null vectors, zero vectors, and those with null or
    non-finite components are linked with nothing. Vectors of different lengths are not compared: each
    length has a graph of its own, one after the other. Equal vectors are linked; repeated rows count as vectors
    of their own. An empty table gives no rows; a null id has no component. Only the id and vector
    columns are read.
    """
    e = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), e.alias("e"))
    odd = F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    valid = F.col("e").isNotNull() & ~odd & F.exists("e", lambda v: v != 0.0)
    rows = rows.withColumn("e", F.when(F.coalesce(valid, F.lit(False)), F.col("e")))
    # -0.0 counts as 0.0 in the key of equal vectors.
    text = F.array_join(F.transform("e", lambda v: (v + F.lit(0.0)).cast("string")), ",")
    rows = rows.withColumn("key", F.sha2(text, 256))
    classes = rows.filter("e IS NOT NULL AND vec_id IS NOT NULL").groupBy("key")
    classes = classes.agg(F.min("vec_id").alias("id"), F.count("*").alias("size"), F.first("e").alias("e"))
    classes = written(classes, "vector-classes")
    # A repeated vec_id with different vectors: each class needs an id of its own.
    vectors = classes.select(F.xxhash64("key").alias("id"), "e")
    lengths = sorted(r[0] for r in vectors.select(F.size("e")).distinct().collect())  # one row per length
    parts = [audited_links(vectors.filter(F.size("e") == k), settings) for k in lengths]
    links = reduce(DataFrame.unionByName, parts) if parts else graph_links(vectors, settings)
    near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.xxhash64("key").alias("id"), "size", F.col("id").alias("least"))
    counts = near.join(size.select(F.col("id").alias("b"), "size"), "b").groupBy("a").agg(F.sum("size").alias("others"))
    comps = written(components(links), "vector-components")
    named = size.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = written(named.join(counts.withColumnRenamed("a", "id"), "id", "left"), "vector-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select(
        F.col("id").alias("class"), (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("linked"), "component_id"
    )
    out = rows.withColumn("class", F.when(F.col("vec_id").isNotNull(), F.xxhash64("key"))).join(named, "class", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
