"""Best-fit packing of documents into sequences of bounded length, with swap-based local search.

A document's ids end in an id of their own. Documents longer than a sequence are cut into full pieces;
the first piece takes what is left over. Pieces are dealt to groups of bounded size, and each group
is packed by itself: best fit of the longest first, then a local search among the underfull
sequences. It moves a piece, or exchanges one for one or two for one, wherever that raises the sum of
squared fills, so that full sequences get fuller and sparse ones run empty. The sparse sequences that
every group is left with go to the next round, in fewer groups, until one group is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit.llm.common import small_batches, written
from prefkit.llm.textblocks import text_blocks
from prefkit.llm.token_ids import chunk_ids

LENGTH = 2048
END_ID = 0
#: Pieces that one task packs at a time (groups are drawn by hash, so they vary a little).
GROUP_PIECES = 32768
#: A sequence this far from full goes to the next round.
SPARSE = 0.05
#: Trials of the local search per group and round, in units of pieces.
EFFORT = 8

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECE + ", sequence_id long, offset long, sparse boolean"


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"):
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32 (no row is left out)."""
    out = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def cut(ids, texts):
        flat, offsets = ids(texts)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            own = np.append(flat[a:b], np.uint32(END_ID)).astype("<u4")
            at, end = 0, len(own) % length or min(length, len(own))
            n = 0
            while at < len(own):
                yield i, n, at, end - at, zlib.crc32(own[at:end])
                at, end, n = end, end + length, n + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids(tokenizer)
        for batch in batches:
            for first, texts in text_blocks(batch.column("text")):
                rows = np.array(list(cut(ids, texts)), np.int64).reshape(-1, 5)
                doc = batch.column("doc_id").take(pa.array(rows[:, 0] + first))
                columns = [doc, pa.array(rows[:, 1].astype(np.int32)), *(pa.array(rows[:, k]) for k in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _PIECE)


class Bins:
    """Sequences of one group: the lengths in each, and the sequences by free room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.fill: list[int] = []
        self.content: list[list[tuple[int, int]]] = []  # (length, piece), sorted
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r: some sequence has room r

    def best_fit(self, length: int, piece: int) -> None:
        """Into the fullest sequence that has room, else into a new one."""
        fitting = self.rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms ^= 1 << room
        else:
            b, room = len(self.fill), self.capacity
            self.fill.append(0)
            self.content.append([])
        self.fill[b] += length
        self.content[b].append((length, piece))
        room -= length
        if not self.by_room[room]:
            self.rooms |= 1 << room
        self.by_room[room].append(b)

    def change(self, b: int, out: list, into: list) -> None:
        for x in out:
            self.content[b].pop(bisect_left(self.content[b], x))
            self.fill[b] -= x[0]
        for x in into:
            insort(self.content[b], x)
            self.fill[b] += x[0]


def best_exchange(poor: list, rich: list, room: int) -> tuple[int, list, list]:
    """The exchange that brings most into the fuller sequence, at most ``room``: (gain, pieces that
    leave ``poor``, pieces that leave ``rich``); one or two pieces for none or one. Sorted lists."""
    best = (0, [], [])
    sizes = [x[0] for x in poor]
    for give in [None, *rich]:
        most = room + (give[0] if give else 0)
        back = [give] if give else []
        i = bisect_right(sizes, most) - 1
        if i >= 0 and sizes[i] - most + room > best[0]:
            best = (sizes[i] - most + room, [poor[i]], back)
        lo, hi = 0, len(sizes) - 1
        while lo < hi:  # two of ``poor``
            two = sizes[lo] + sizes[hi]
            if two > most:
                hi -= 1
                continue
            if two - most + room > best[0]:
                best = (two - most + room, [poor[lo], poor[hi]], back)
            lo += 1
        if best[0] == room:
            break
    return best


def local_search(bins: Bins, effort: int) -> None:
    """Moves and exchanges from the emptiest sequences into fuller ones, while each raises the sum of
    squared fills, until as few sequences are left as the lengths need or the effort is spent."""
    for c in bins.content:
        c.sort()
    total = sum(bins.fill)
    fewest = -(-total // bins.capacity)
    open_bins = sorted((b for b, f in enumerate(bins.fill) if 0 < f < bins.capacity), key=lambda b: bins.fill[b])
    used = sum(f > 0 for f in bins.fill)
    while used > fewest and len(open_bins) > 1 and effort > 0:
        poor = open_bins[0]
        moved = False
        for rich in reversed(open_bins[1:]):
            room = bins.capacity - bins.fill[rich]
            effort -= 1
            if room and bins.content[poor]:
                gain, leave, back = best_exchange(bins.content[poor], bins.content[rich], room)
                if gain > 0:  # fill[rich] >= fill[poor], so squares grow
                    bins.change(poor, leave, back)
                    bins.change(rich, back, leave)
                    moved = True
            if not bins.fill[poor] or effort <= 0:
                break
        if not bins.fill[poor]:
            used -= 1
            open_bins = open_bins[1:]
        elif not moved:
            open_bins = open_bins[1:]  # nothing of it can be placed; the next emptiest
        open_bins = sorted((b for b in open_bins if 0 < bins.fill[b] < bins.capacity), key=lambda b: bins.fill[b])


def packed_group(lengths: list[int], capacity: int, effort: int = EFFORT) -> list[list[int]]:
    """Indices of ``lengths`` by sequence; as few sequences as the search finds."""
    bins = Bins(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        bins.best_fit(lengths[i], i)
    local_search(bins, effort * max(1000, len(lengths)))
    return [[i for _, i in sorted(c, reverse=True)] for c in bins.content if c]


def _pack(capacity: int, level: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        length = group["length"].to_numpy()
        order, seq, offset, sparse = [], [], [], []
        for b, members in enumerate(packed_group(length.tolist(), capacity)):
            ends = np.cumsum(length[members])
            order += members
            seq += [(level << 56) + (key[0].as_py() << 24) + b] * len(members)
            offset += (ends - length[members]).tolist()
            sparse += [bool(ends[-1] < (1 - SPARSE) * capacity)] * len(members)
        out = group.select(["doc_id", "piece", "start", "length", "ids_crc32"]).take(pa.array(order, pa.int64()))
        out = out.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
        return out.append_column("sparse", pa.array(sparse, pa.bool_()))

    return run


def pack_pieces(rows: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``rows`` (as ``pieces`` gives them, written) with sequence_id and offset."""
    done, level = None, 0
    n = rows.count()
    while True:
        groups = max(1, -(-n // group_pieces))
        # The position in the written files spreads equal rows too.
        spread = F.xxhash64("doc_id", "piece", "start", F.monotonically_increasing_id())
        dealt = rows.withColumn("g", F.pmod(spread, F.lit(groups)))
        packed = written(dealt.groupBy("g").applyInArrow(_pack(length, level), _PACKED), f"packed{level}")
        left = packed.filter("sparse").count() if groups > 1 else 0
        # Another round pays while its pieces fit into fewer groups.
        if not left or -(-left // group_pieces) >= groups:
            last = packed.drop("sparse")
            return last if done is None else done.unionByName(last)
        settled = packed.filter("NOT sparse").drop("sparse")
        done = settled if done is None else done.unionByName(settled)
        rows, n, level = packed.filter("sparse").drop("sequence_id", "offset", "sparse"), left, level + 1


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document's pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.

    ``tokenizer`` is a file of the tokenizers library that exists on every executor. A null or empty
    text is one piece of the end id alone. Repeated rows are packed each for itself; an empty table
    gives no rows. Only the id and text columns are read. Sequences hold ``length`` ids at most.
    """
    return pack_pieces(written(pieces(docs, tokenizer, length, id_col, text_col), "pieces"), length)
