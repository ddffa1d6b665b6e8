import re
from collections import Counter, defaultdict

import pytest

from test_exact_dedup import fold
from test_jaccard_join import brute

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output) of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = corpus_pipeline.written(stage(spark, docs, SF), f"stage{i}")
        out.append((name, docs, made))
        docs = made
    return out


def rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_stage(spark, stages):
    _, before, after = stages[0]
    gone = {r[0] for r in rows(before)} - {r[0] for r in rows(after)}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [labels[i] for i in gone if i in labels]
    assert gone and sum(judged) <= 0.1 * len(judged)
    assert sum(labels[r[0]] == 0 for r in rows(after) if r[0] in labels) <= 2


def test_exact_stage(stages):
    _, before, after = stages[1]
    keep = {}
    for i, t, *_ in rows(before):
        keep[fold(t)] = max(keep.get(fold(t), i), i)
    assert sorted(r[0] for r in rows(after)) == sorted(keep.values())


def test_near_stage(stages):
    _, before, after = stages[2]
    want = sorted(d for d, _, c in brute(rows(before), 5, 4, 5) if d == c)
    assert sorted(r[0] for r in rows(after)) == want


def test_mix_stage(stages):
    _, before, after = stages[3]
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows(before)}
    sources = sorted({r[3] for r in rows(before)})
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, _, _, s in rows(before):
        sizes[s] += words[i]
    for i, _, _, s in rows(after):
        taken[s] += words[i]
    assert max(Counter(r[0] for r in rows(after)).values()) <= 3
    from test_mixing import filled

    target = filled([sizes[s] for s in sources], [(5, 2, 1)[i % 3] for i in range(len(sources))], sum(sizes.values()), 3)
    for s, t in zip(sources, target):
        assert abs(taken[s] - t) <= max(0.15 * t, 150), s


def test_packing_stage(stages):
    from tokenizers import Tokenizer
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    _, before, after = stages[4]
    length = {r[0]: len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows(before)}
    got = after.collect()
    want = Counter()
    for r in rows(before):
        want[r[0]] += length[r[0]]
    have = Counter()
    for r in got:
        have[r["doc_id"]] += r["length"]
    assert have == want
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 2


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.groupBy("doc_id").count().count() == stages[4][2].groupBy("doc_id").count().count()
    assert got.count() == stages[4][2].count()
