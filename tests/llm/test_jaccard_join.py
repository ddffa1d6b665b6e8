import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefkit.llm import jaccard_join
from prefkit.llm.components import components
from prefkit.llm.shingles import shingle_sets
from prefkit.llm.textblocks import text_bytes
from cases import ODD_ROWS


def shingles(t, width):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, num, den):
    sets = [shingles(t, width) for _, t, *_ in rows]
    leader = list(range(len(rows)))

    def find(i):
        while leader[i] != i:
            i = leader[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and den * both >= num * (len(s) + len(sets[j]) - both):
                leader[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, *_) in enumerate(rows))


def edited(words, r, share):
    return [("x" + str(r.randint(0, 99)) if r.random() < share else w) for w in words]


def corpus(seed, n=160):
    """Documents of common passages, near copies at all distances, copies, and short texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [[r.choice(vocabulary) for _ in range(40)] for _ in range(4)]
    rows = []
    for i in range(n):
        kind = i % 5
        if kind < 2:
            words = edited(passages[r.randint(0, 3)] * 2, r, r.choice([0, 0.005, 0.01, 0.02, 0.1]))
        elif kind == 2:
            words = passages[r.randint(0, 3)] + [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        elif kind == 3:
            words = [r.choice(vocabulary[:4]) for _ in range(r.randint(1, 6))]
        else:
            words = [r.choice(vocabulary) for _ in range(r.randint(5, 90))]
        rows.append((i, " ".join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("width,num,den,frequent", [(3, 90, 100, 32), (3, 90, 100, 1), (2, 4, 5, 2), (5, 4, 5, 0)])
def test_components_match_brute_force(documents, monkeypatch, width, num, den, frequent):
    # With a low bound for frequent tokens, nearly all index keys are pairs.
    monkeypatch.setattr(jaccard_join, "FREQUENT_SIGMAS", 0)
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", frequent)
    rows = corpus(width * 100 + frequent)
    got = jaccard_join.jaccard_components(documents(rows), width, num, den).collect()
    assert sorted(map(tuple, got)) == brute(rows, width, num, den)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([(3, 4), (4, 5), (9, 10)]), st.integers(0, 6))
def test_similar_sets_share_a_key(seed, ratio, frequent):
    r = np.random.default_rng(seed)
    num, den = ratio
    base = r.integers(0, 1 << 63, r.integers(2, 120), dtype=np.uint64)
    counters = r.integers(0, 10, 1 << 12)
    index = jaccard_join.Prefixes(num, den, counters, frequent)
    for _ in range(6):
        a = base[r.random(len(base)) > r.random() * 0.2]
        b = np.concatenate([base[r.random(len(base)) > r.random() * 0.2], r.integers(0, 1 << 63, 3, dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if len(a) and den * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b)) and len(np.union1d(a, b)) > len(np.intersect1d(a, b)):
            keys, owner = index.keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            assert len(np.intersect1d(keys[owner == 0], keys[owner == 1]))


def test_profiles_bound_the_intersection():
    r = np.random.default_rng(4)
    base = np.unique(r.integers(0, 1 << 63, 9000, dtype=np.uint64))
    words = jaccard_join.PLANES * jaccard_join.PROFILE // 64
    for n in (1, 40, 700, 9000):
        a, b = base[:n], np.unique(np.concatenate([base[n // 10 : n], r.integers(0, 1 << 63, n // 9, dtype=np.uint64)]))
        p = jaccard_join.profiles(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        most = min(p[0, words], p[1, words])
        most += sum(int(x & y & 0xFFFFFFFFFFFFFFFF).bit_count() for x, y in zip(p[0, :words].view(np.uint64).tolist(), p[1, :words].view(np.uint64).tolist()))
        assert len(np.intersect1d(a, b)) <= most <= min(len(a), len(b)) + len(a) // 10


def test_shingle_sets_match_words():
    import pyarrow as pa

    texts = ["a b a b a b", "One TWO", "", None, "é ü\té", "x", "\n "]
    for width in (1, 2, 3, 5):
        _, bounds = shingle_sets(*text_bytes(pa.array(texts)), width)
        assert np.diff(bounds).tolist() == [len(shingles(t, width)) for t in texts]


def test_hot_group_and_mixed_keys(documents, monkeypatch, prose):
    monkeypatch.setattr(jaccard_join, "HELD_ROWS", 50)  # tasks bring their own sets together many times
    monkeypatch.setattr(jaccard_join, "PIVOT_SHARE", 3)
    base = prose(120, 1).split()
    rows = [(i, " ".join(edited(base, random.Random(i), 0.004)), "en", "a") for i in range(150)]
    rows += [(500 + i, " ".join(base[:40]) + " " + prose(60, i), "en", "a") for i in range(20)]
    got = jaccard_join.jaccard_components(documents(rows), 3, 90, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 90, 100)


def test_odd_rows(documents):
    got = jaccard_join.jaccard_components(documents(ODD_ROWS), 3, 90, 100).collect()
    by = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert len(got) == len(ODD_ROWS)
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[5] == by[6] == (1, 5)
    assert by[None] == (1, None)
    docs = documents(ODD_ROWS)
    kept = jaccard_join.drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 5, None, 7, 8], key=str)


def test_empty_table(documents):
    assert jaccard_join.jaccard_components(documents([]), 3, 90, 100).count() == 0


def test_components_of_random_graphs(spark):
    r = random.Random(5)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(900, 901 + i) for i in range(60)] + [(7, 7)]
    edges += [(1000 + i, 1001 + i) for i in range(40)]
    got = {x["id"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    seen = {}
    for start in sorted(near):
        stack = [start]
        while stack:
            v = stack.pop()
            if v not in seen:
                seen[v] = seen.get(start, start)
                stack += near[v]
    assert got == seen
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def thue_morse(n):
    """A word of two letters and its complement: polynomials modulo 2 ** 64 give both one value."""
    word = "a"
    while len(word) < n:
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def test_words_that_collide_in_polynomial_hashes(documents):
    one, other = thue_morse(1024)
    rows = [(1, one, "en", "a"), (2, other, "en", "a"), (3, one, "en", "a")]
    got = jaccard_join.jaccard_components(documents(rows), 3, 90, 100).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_repeated_ids_with_different_texts(documents, prose):
    a, b = prose(120, 1), prose(120, 2)
    rows = [(1, a, "en", "x"), (1, b, "en", "x"), (8, a + " x", "en", "x"), (9, b + " y", "en", "x"), (10, prose(90, 3), "en", "x")]
    got = jaccard_join.jaccard_components(documents(rows), 3, 90, 100).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (8, 1), (9, 1), (10, 10)]


def test_very_long_texts(documents, prose):
    base = " ".join(prose(400, i) for i in range(400))  # about two megabytes
    rows = [(1, base, "en", "x"), (2, base + " end", "en", "x"), (3, prose(300, 900), "en", "x"), (4, "y" * 3_000_000, "en", "x")]
    got = jaccard_join.jaccard_components(documents(rows), 5, 4, 5).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3), (4, 4)]


@pytest.mark.parametrize("crowded,listed,narrowing", [(0, 1, 0), (0, 16, 2), (3, 2, 1), (10**9, 16, 1)])
def test_every_way_of_pairing_gives_all_links(documents, monkeypatch, crowded, listed, narrowing):
    """Crowded and sparse keys, short lists and any number of rounds: the same components."""
    for name, value in (("CROWDED", crowded), ("LISTED_KEYS", listed), ("NARROWING", narrowing), ("FIRST_PIVOTS", 1)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus(31, 140)
    got = jaccard_join.jaccard_components(documents(rows), 3, 90, 100)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 90, 100)


def near_copies(prose, n):
    """Copies of one text with up to three words changed: some pairs are similar, many just not."""
    base, rows = prose(150, 1).split(), []
    for i in range(n):
        r, words = random.Random(i), list(base)
        for _ in range(r.randint(1, 4)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "a"))
    return rows


def test_a_group_of_near_copies_makes_few_pairs(documents, monkeypatch, prose):
    made, plain = {}, jaccard_join.written

    def counted(df, name):
        out = plain(df, name)
        if name == "untried-pairs":
            made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    rows = near_copies(prose, 300)
    got = jaccard_join.jaccard_components(documents(rows), 5, 4, 5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 4, 5)
    assert made["untried-pairs"] < 6 * len(rows)


def test_texts_that_stay_are_not_moved(spark, documents, prose):
    rows = [(i, prose(60, i % 40), "en", "a") for i in range(60)] + [(None, prose(60, 1), "en", "a")]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard_join.drop_similar(documents(rows))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        first = plan.split("SortMergeJoin")[0]
        assert "Union" in first and "BroadcastHashJoin" in first and "Exchange hashpartitioning" not in first
        assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([*range(40), None], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_fine_profiles_bound_the_intersection(monkeypatch):
    r = np.random.default_rng(5)
    base = np.unique(r.integers(0, 1 << 63, 9000, dtype=np.uint64))
    crowd = np.arange(1, 9001, dtype=np.uint64) << np.uint64(20)  # all in one class: beyond a byte
    assert jaccard_join.fine_profile(base[: jaccard_join.FINE_FROM]) is None
    for tokens in (base, crowd):
        for n, m, start in ((2040, 2070, 100), (9000, 8100, 0), (1100, 9000, 0), (4000, 4000, 4000)):
            a, b = tokens[:n], tokens[start : start + m]
            both = len(np.intersect1d(a, b))
            p, q = jaccard_join.fine_profile(a), jaccard_join.fine_profile(b)
            assert jaccard_join.most_common(p, len(a), q, len(b)) >= both
            assert jaccard_join.most_common(p, len(a), p, len(a)) >= len(a)
    # Long sets without a common token are told apart.
    a, b = base[:4000], base[4000:8000]
    assert jaccard_join.most_common(jaccard_join.fine_profile(a), 4000, jaccard_join.fine_profile(b), 4000) < 3600


@pytest.mark.parametrize("crowded", [0, 32])
def test_fine_profiles_lose_no_link(documents, monkeypatch, crowded):
    for name, value in (("FINE_FROM", 5), ("FINE_TOKENS", 2), ("CROWDED", crowded)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = corpus(57, 140)
    got = jaccard_join.jaccard_components(documents(rows), 3, 90, 100)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 90, 100)


def test_long_texts_that_only_share_keys_are_not_compared(documents, monkeypatch):
    """Long texts of few words share many index keys; their texts need not meet."""
    compared, plain = [], jaccard_join.JaccardJoin.verified

    def counted(self, pairs):
        compared.append(pairs.count())
        return plain(self, pairs)

    monkeypatch.setattr(jaccard_join.JaccardJoin, "verified", counted)
    rows = []
    for i in range(40):
        r = random.Random(i)
        words = [f"w{r.randrange(15)}" for _ in range(2500)]
        rows.append((2 * i, " ".join(words), "en", "a"))
        if i < 5:
            rows.append((2 * i + 1, " ".join(edited(words, r, 0.005)), "en", "a"))
    got = jaccard_join.jaccard_components(documents(rows), 3, 90, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 90, 100)
    assert sum(r.component_id != r.doc_id for r in got) == 5
    assert sum(compared) <= 10
