"""What a Python task holds at a time: bounded by bytes, whatever the number and length of the texts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prefkit.llm import common, exact_dedup, packing, quality
from prefkit.llm.jaccard_join import JaccardJoin
from prefkit.llm.shingles import shingle_sets
from prefkit.llm.textblocks import byte_blocks, span_hashes, weights
from prefkit.llm.token_ids import ChunkIds

tokenizer_path = pytest.importorskip("public_tokenizers").path
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("operator", ["near", "exact", "quality", "packing"])
def test_long_texts_reach_python_in_small_batches(spark, operator):
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a word "), 1500).alias("text"))

    def batch_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    spark.conf.unset(LIMIT)
    try:
        if operator == "near":
            JaccardJoin(docs, 3, 9, 10, "doc_id", "text", 10)
        elif operator == "exact":
            exact_dedup.content_classes(docs.limit(2))
        elif operator == "quality":
            labels = docs.limit(2).select("doc_id", F.lit(1).alias("quality"))
            quality.trained_on(docs.limit(2), labels, F.lit(True))
        else:
            packing.pieces(docs, tokenizer_path("byte_bpe_50k.json"))
        sizes = [r.n for r in docs.mapInArrow(batch_bytes, "n long").collect()]
        assert sum(sizes) > 20_000_000
        assert max(sizes) < 2 * common.BATCH_BYTES
    finally:
        spark.conf.unset(LIMIT)


def test_a_limit_of_the_session_stays(spark):
    spark.conf.set(LIMIT, "1000000")
    try:
        common.small_batches(spark)
        assert spark.conf.get(LIMIT) == "1000000"
    finally:
        spark.conf.unset(LIMIT)


@pytest.mark.parametrize("work", [lambda d, o: shingle_sets(d, o, 5), quality.features], ids=["shingles", "features"])
def test_arrays_of_a_block_are_bounded(work):
    draw = np.random.default_rng(5)
    texts = pa.array([" ".join(map(str, draw.integers(0, 10**6, 300))) for _ in range(2000)])
    tracemalloc.start()
    try:
        for _, data, offsets in byte_blocks(texts):
            work(data, offsets)
        assert tracemalloc.get_traced_memory()[1] < 32 << 20
    finally:
        tracemalloc.stop()


def test_span_hashes_are_those_of_each_span_alone():
    values = np.random.default_rng(6).integers(0, 1 << 63, 1000, dtype=np.uint64)
    starts = np.arange(3, 990, 10)
    ends = starts + np.arange(len(starts)) % 8 + 1
    before = weights(8).copy()
    found = span_hashes(values.copy(), starts, ends)
    alone = [span_hashes(values[s:e], np.array([0]), np.array([e - s]))[0] for s, e in zip(starts, ends)]
    assert found.tolist() == alone
    assert (weights(8) == before).all()


def test_the_large_tokenizer_is_loaded_for_special_strings_only():
    ids = ChunkIds(tokenizer_path("byte_bpe_50k.json"))
    flat, _ = ids(["plain words, 12 of them", ""])
    assert len(flat) and "tokenizer" not in vars(ids)
    whole = ids.tokenizer.encode("plain words, 12 of them", add_special_tokens=False).ids
    assert flat.tolist() == whole
