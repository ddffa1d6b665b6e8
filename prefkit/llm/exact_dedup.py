"""Exact deduplication by Grace hashing.

Records are dealt by a hash of their content into buckets (the exchange's files are the spill
files). Each bucket is read by one task into an open-addressing table that compares complete
contents. A table has a byte budget: once it is full, contents that it does not hold yet go on, as
written spill files, to the next level, where another hash deals them into buckets anew, until no
record is left over. Every level places at least one content per bucket, so the recursion ends.

Before the first exchange each task combines its own copies in a table of the same kind, so a
content that a third of all rows carry crosses the exchange once per task and not once per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefkit.llm.common import concerned, free_name, shuffle_partitions, small_batches, written

#: Bytes of distinct content that one table holds before it passes contents on.
TABLE_BYTES = 96 * 1024 * 1024
#: ASCII letters folded to lower case, as a byte table.
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_CONTENT = "h long, content binary, n long, top long, n_top long"
_CLASS = "sha string, n long, top long, n_top long"
_LEVEL = "h long, content binary, n long, top long, n_top long, sha string"


class OpenTable:
    """Open addressing with linear probing over (hash, complete content) -> (rows, largest id, rows
    that carry it). ``add`` returns False for a content that is new when the budget is used up."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.hashes, self.contents, self.values = [], [], []
        self.slots = [-1] * 1024

    def _slot(self, h: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 29)) & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return at
            at = (at + 1) & mask
        return at

    def add(self, h: int, content: bytes, n: int, top: int | None, n_top: int) -> bool:
        at = self._slot(h, content)
        if (i := self.slots[at]) >= 0:
            value = self.values[i]
            value[0] += n
            if top is not None and (value[1] is None or top > value[1]):
                value[1:] = [top, n_top]
            elif top == value[1]:
                value[2] += n_top
            return True
        if self.used and self.used + len(content) > self.budget:
            return False
        self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.values.append([n, top, n_top])
        self.used += len(content) + 128
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            mask = len(self.slots) - 1
            for i, g in enumerate(self.hashes):
                at = (g ^ (g >> 29)) & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = i
        return True

    def rows(self) -> Iterator[tuple]:
        for h, content, (n, top, n_top) in zip(self.hashes, self.contents, self.values, strict=True):
            yield h, content, n, top, n_top


def normalised(text: str | None, fold: bool) -> bytes:
    content = (text or "").encode("utf-8", "surrogatepass")
    return content.translate(FOLD) if fold else content


def _hash64(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little") >> 1


def _batches(rows: Iterator[tuple], schema: pa.Schema, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 64 + (len(row[1]) if isinstance(row[1], bytes) else 0)
        if size > most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


_PA_CONTENT = pa.schema(
    [("h", pa.int64()), ("content", pa.binary()), ("n", pa.int64()), ("top", pa.int64()), ("n_top", pa.int64())]
)
_PA_LEVEL = pa.schema([*_PA_CONTENT, ("sha", pa.string())])
_PA_MEMBER = pa.schema([("doc_id", pa.int64()), ("sha", pa.string())])


def _combine(fold: bool, budget: int):
    """Rows (id, text) of a task -> its distinct contents with their counts and largest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable(budget)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = normalised(text.as_py(), fold)
                h = _hash64(content)
                if not table.add(h, content, 1, i, 1):
                    yield from _batches(table.rows(), _PA_CONTENT)
                    table = OpenTable(budget)
                    table.add(h, content, 1, i, 1)
        yield from _batches(table.rows(), _PA_CONTENT)

    return run


def _bucket(budget: int):
    """A bucket's records -> its classes (content null, sha set), then what did not fit (sha null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable(budget)
        full = False

        def left(batch):
            nonlocal full
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                h, content = row[0], row[1]
                if full and table.slots[table._slot(h, content)] < 0:
                    yield (*row, None)
                elif not table.add(*row):
                    full = True
                    yield (*row, None)

        for batch in batches:
            yield from _batches(left(batch), _PA_LEVEL)
        done = ((h, None, n, top, n_top, hashlib.sha256(c).hexdigest()) for h, c, n, top, n_top in table.rows())
        yield from _batches(done, _PA_LEVEL)

    return run


def _members(fold: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha = [hashlib.sha256(normalised(t.as_py(), fold)).hexdigest() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.string())], schema=_PA_MEMBER)

    return run


def content_classes(rows: DataFrame, fold: bool = True, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Classes of equal contents of ``rows`` (doc_id, text): sha, n, top (largest doc_id), n_top.

    Runs one job per level of the recursion. The leftover of a level is written to the shared
    folder, as are the classes found.
    """
    spark = rows.sparkSession
    small_batches(spark)
    parts = shuffle_partitions(spark)
    records = rows.mapInArrow(_combine(fold, table_bytes // 4), _CONTENT)
    found, level = [], 0
    while True:
        dealt = records.repartition(parts, F.xxhash64(F.lit(level), F.col("h")))
        level_rows = written(dealt.mapInArrow(_bucket(table_bytes), _LEVEL), f"dedup-level{level}")
        found.append(level_rows.filter(F.col("sha").isNotNull()).select("sha", "n", "top", "n_top"))
        records = level_rows.filter(F.col("sha").isNull()).drop("sha")
        if records.isEmpty():
            break
        level += 1
    classes = found[0]
    for more in found[1:]:
        classes = classes.unionByName(more)
    return classes


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: bool = True, table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after A-Z are lower-cased (``fold``); null counts as empty. Of
    equal texts the row with the largest id stays. Defined cases: an empty table gives no rows; a
    null id loses to any other id, and a group of null ids only has a null ``keep_id`` and keeps
    one row; when several rows carry the largest id (repeated rows), exactly one of them is kept.
    Only the id and text columns are read, so other columns may have any name. Ids are integers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    classes = content_classes(rows, fold, table_bytes)
    members = rows.mapInArrow(_members(fold), "doc_id long, sha string")
    joined = members.join(classes, "sha")
    largest = F.col("doc_id").eqNullSafe(F.col("top"))
    out = joined.select(
        "doc_id",
        F.col("top").alias("keep_id"),
        F.col("n").alias("group_size"),
        largest.alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_top",
    )
    if classes.filter(F.col("n_top") > 1).isEmpty():
        return out.drop("n_top")
    # Several rows carry a group's largest id: they are identical, so the group gives one kept
    # row and n_top - 1 others, made from its class.
    plain = out.filter(~F.col("kept") | (F.col("n_top") == 1)).drop("n_top")
    tied = classes.filter(F.col("n_top") > 1).select(
        F.col("top").alias("doc_id"),
        F.col("top").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_top"))).alias("k"),
        F.col("sha").alias("text_sha256"),
    )
    tied = tied.select("doc_id", "keep_id", "group_size", (F.col("k") == 1).alias("kept"), "text_sha256")
    return plain.unionByName(tied)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts (see ``exact_duplicates``); all columns
    are kept as they are, whatever their names. Of repeated rows one stays.

    The rows to go, and those that occur several times, are looked up by id and digest: a table of these
    alone meets the documents whose ids a map of them does not rule out; the other texts stay where they lie."""
    marks = written(exact_duplicates(docs, id_col, text_col), "dedup-marks")
    seen = marks.groupBy(F.col("doc_id").alias("x_id"), F.col("text_sha256").alias("x_sha"))
    seen = seen.agg(F.max("kept").alias("x_kept"), F.count("*").alias("x_n"))
    # Written, so that its size is known when the joins are planned.
    special = written(seen.filter("NOT x_kept OR x_n > 1"), "dedup-special")
    own_id, own_sha = free_name(docs, "own_id"), free_name(docs, "own_sha")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Rows whose id is not among these stay as they are; the others are told apart by their digests too.
    may, rest = concerned(docs, F.col(f"`{id_col}`").cast("long"), special.select("x_id"))
    own = may.withColumns({own_id: F.col(f"`{id_col}`").cast("long"), own_sha: F.sha2(text, 256)})

    def met(rows: DataFrame, how: str) -> DataFrame:
        rows = rows.select(F.col("x_id").alias(free_name(own, "x_id")), F.col("x_sha").alias(free_name(own, "x_sha")))
        x_id, x_sha = rows.columns
        return own.join(rows, (F.col(own_sha) == F.col(x_sha)) & F.col(own_id).eqNullSafe(F.col(x_id)), how)

    single = met(special, "left_anti")
    repeated = written(special.filter("x_kept"), "dedup-repeated")
    several = met(repeated, "left_semi").dropDuplicates([own_id, own_sha])
    return rest.union(single.unionByName(several).drop(own_id, own_sha))
