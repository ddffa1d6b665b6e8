"""Sharding by longest-processing-time scheduling.

Groups that must stay together (rows with equal keys) are sorted by size, and each goes to the
least-loaded shard through a heap. The number of groups grows with the table, so the heap runs
over a bounded number of pieces: every group larger than ``1 / (n_shards * HEAVY)`` of the total is
a piece of its own (there are at most ``n_shards * HEAVY`` of them), and the lighter groups are
bundled by a hash of their key into ``n_shards * BUNDLES`` pieces. A bundle stays together, hence so
do its groups. The loads then differ by about one bundle, a fraction ``1 / BUNDLES`` of a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit.llm.common import written

#: Groups above 1 / (n_shards * HEAVY) of all bytes are scheduled one by one.
HEAVY = 512
#: Bundles of light groups per shard.
BUNDLES = 1024
#: Cells per shard in which rows are numbered; a cell is sorted by one task.
CELLS = 1024


def longest_first(pieces: Iterable[tuple[object, int]], n_shards: int) -> dict:
    """Piece -> shard: the largest piece first, each to the least-loaded shard (a heap; of equal
    loads the lowest shard). Pieces of equal size go in the order of their keys."""
    loads = [(0, shard) for shard in range(n_shards)]
    placed = {}
    for key, size in sorted(pieces, key=lambda p: (-p[1], p[0])):
        load, shard = heapq.heappop(loads)
        placed[key] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard_groups(
    rows: DataFrame, n_shards: int, heavy: int = HEAVY, bundles: int = BUNDLES, cells: int = CELLS
) -> DataFrame:
    """``rows`` (id, size long >= 1, key binary or string, never null, and further columns) with
    ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long, gapless from 0 within a shard).

    Rows of equal key share a shard. Slots follow cells of rows (by a hash of id and key) and the id
    within a cell, so no task sorts a whole shard. An empty table gives no rows; repeated rows get
    different slots, ties are broken by id. Extra columns are carried along; the names ``shard``,
    ``slot`` and those beginning with ``_ls_`` are the operator's own.
    """
    spark = rows.sparkSession
    n_bundles = n_shards * bundles
    # The bundle of a light key, and the key itself of a heavy one, name a piece.
    bundle = F.pmod(F.xxhash64("key"), F.lit(n_bundles)).cast("int")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("_ls_bytes")), "shard-groups")
    total = groups.agg(F.coalesce(F.sum("_ls_bytes"), F.lit(0))).first()[0]
    limit = total / (n_shards * heavy)
    # Bounded by construction: fewer than n_shards * heavy groups are above the limit.
    big = groups.filter(F.col("_ls_bytes") > limit).collect()
    light = groups.filter(F.col("_ls_bytes") <= limit)
    light = light.groupBy(bundle.alias("_ls_b")).agg(F.sum("_ls_bytes").alias("n")).collect()
    pieces = [((0, bytes(r["key"]).hex()), r["_ls_bytes"]) for r in big]
    pieces += [((1, f"{r['_ls_b']:010d}"), r["n"]) for r in light]
    placed = longest_first(pieces, n_shards)
    by_key = [(bytearray.fromhex(k), s) for (kind, k), s in placed.items() if kind == 0]
    by_bundle = [(int(k), s) for (kind, k), s in placed.items() if kind == 1]
    key_map = spark.createDataFrame(by_key, "key binary, _ls_own int")
    bundle_map = spark.createDataFrame(by_bundle, "_ls_b int, _ls_shared int")
    placed_rows = rows.withColumn("_ls_b", bundle).join(F.broadcast(key_map), "key", "left")
    placed_rows = placed_rows.join(F.broadcast(bundle_map), "_ls_b", "left")
    placed_rows = placed_rows.withColumn("shard", F.coalesce("_ls_own", "_ls_shared")).drop("_ls_own", "_ls_shared")
    cell = F.pmod(F.xxhash64("id", "key", F.lit(7)), F.lit(cells)).cast("int")
    placed_rows = placed_rows.drop("_ls_b").withColumn("_ls_cell", cell)
    return numbered(placed_rows, "shard", "_ls_cell", ["id"]).drop("_ls_cell")


def numbered(rows: DataFrame, part: str, cell: str, order: list[str]) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 within each value of ``part``: by ``cell``, then by
    ``order`` within a cell. The window spans one cell; the offsets of cells (bounded by the parts
    times the cells) come from counts."""
    from pyspark.sql import Window

    counts = rows.groupBy(part, cell).agg(F.count(F.lit(1)).alias("_ls_n"))
    before = F.sum("_ls_n").over(Window.partitionBy(part).orderBy(cell)) - F.col("_ls_n")
    offsets = counts.select(part, cell, before.alias("_ls_before"))
    inner = F.row_number().over(Window.partitionBy(part, cell).orderBy(*order)) - 1
    out = rows.withColumn("_ls_inner", inner).join(F.broadcast(offsets), [part, cell])
    return out.withColumn("slot", F.col("_ls_before") + F.col("_ls_inner")).drop("_ls_before", "_ls_inner")


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents in ``n_shards`` shards of nearly equal bytes; equal texts share a shard.

    Returns doc_id, size (UTF-8 bytes plus 1; null text: 1), text_crc32 (unsigned; null text: that
    of the empty text), law ('bytes'), shard, slot, grown_shard (null: adding a shard reschedules).
    A null text counts as equal to the empty one. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )
    out = shard_groups(rows, n_shards)
    return out.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
