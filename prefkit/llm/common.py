"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefkit.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    It cuts the lineage: whatever is recomputed after an executor is lost starts from these files,
    and later plans see the same rows in the same files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch on its way to a Python task (Spark's other limit, of rows, bounds no texts).
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Tasks hold ``BATCH_BYTES`` of Arrow data at a time, on Spark's side and on Python's, however long the
    texts are. A limit that the session has already stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, spark.conf.get(key, str(BATCH_BYTES)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column of that name already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc32(col: str) -> Column:
    """crc32 of a column's text form (null: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def renamed_schema(df: DataFrame, column: str, name: str) -> T.StructField:
    """The field of ``column`` under another name (keeps the data type of ids generic)."""
    return T.StructField(name, df.schema[column].dataType, True)


#: Bits of the map that tells which rows a table of ids can concern (4 MiB).
ID_MAP_BITS = 25


def concerned(docs: DataFrame, id: Column, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two parts: rows whose ``id`` (long) is null or may be among ``ids`` (one column of longs), and
    rows whose id is not among them.

    The ids' hashes are set in a map of fixed size, which is broadcast: whatever the number of ids, the
    rows of the second part need not be moved to be told apart from them."""
    slots = F.lit(1 << ID_MAP_BITS)
    own = F.col(ids.columns[0])
    slot = F.pmod(F.xxhash64(own), slots) + 1
    k, m = free_name(docs, "map_k"), free_name(docs, "map_m")
    maps = ids.filter(own.isNotNull()).groupBy(F.bitmap_bucket_number(slot).alias(k))
    maps = written(maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias(m)), "id-map")
    slot = F.pmod(F.xxhash64(id), slots) + 1
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(m, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1
    marked = docs.join(F.broadcast(maps), F.bitmap_bucket_number(slot) == F.col(k), "left")
    may = id.isNull() | F.coalesce(hit, F.lit(False))
    return marked.filter(may).drop(k, m), marked.filter(~may).drop(k, m)
