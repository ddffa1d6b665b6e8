import hashlib
from collections import defaultdict

import pytest

from prefkit.llm import exact_dedup
from cases import ODD_ROWS


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[fold(t)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept = False
        for i in ids:
            stays = i == keep and not kept
            kept |= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force_on_odd_rows(documents):
    got = exact_dedup.exact_duplicates(documents(ODD_ROWS)).collect()
    assert sorted(map(tuple, got), key=str) == brute(ODD_ROWS)


def test_recursion_and_hot_group(documents, prose):
    rows = [(i, prose(30, i % 40), "en", "a") for i in range(300)] + [(1000 + i, "Hot Copy", "en", "a") for i in range(150)]
    # A budget of two contents per table: several levels of spill files are needed.
    got = exact_dedup.exact_duplicates(documents(rows), table_bytes=900).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(documents):
    assert exact_dedup.exact_duplicates(documents([])).count() == 0


def test_drop_duplicates_keeps_columns_and_one_row(documents):
    docs = documents(ODD_ROWS)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == [2, 3, 4, 6, 7, 8, None] or ids == sorted([2, 3, 4, 6, 7, 8, None], key=str)


def test_open_table_compares_contents_of_equal_hashes():
    table = exact_dedup.OpenTable(10_000)
    assert table.add(5, b"a", 1, 1, 1) and table.add(5, b"b", 1, 2, 1) and table.add(5, b"a", 2, 9, 1)
    assert sorted(r[1:] for r in table.rows()) == [(b"a", 3, 9, 1), (b"b", 1, 2, 1)]


@pytest.mark.parametrize("n", [1, 2000])
def test_open_table_grows(n):
    table = exact_dedup.OpenTable(1 << 30)
    for i in range(n):
        table.add(i * 1024, str(i).encode(), 1, i, 1)
    assert sorted(int(r[1]) for r in table.rows()) == list(range(n))


def test_drop_duplicates_with_clashing_names(spark):
    names = ["own_id", "own_sha", "_own_id", "x_id", "x_sha", "X_KEPT", "kept"]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, t, *(f"{n}{i}" for n in names)) for i, t in ((1, "a"), (2, "A"), (3, "b"), (3, "b"), (None, "c"), (None, "c"), (4, None), (5, ""))]
    docs = spark.createDataFrame(rows, schema)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(kept.collect(), key=str)
    assert sorted((r.doc_id for r in got), key=str) == [2, 3, 5, None]
    assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)


def test_repeated_ids_with_different_texts(documents):
    rows = [(1, "a", "en", "x"), (1, "b", "en", "x"), (2, "A", "en", "x"), (2, "A", "en", "x")]
    kept = exact_dedup.drop_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "b"), (2, "A")]


def test_very_long_texts(documents):
    rows = [(1, "é" * 3_000_000, "en", "x"), (2, "é" * 3_000_000, "en", "x"), (3, "é" * 2_999_999 + "x", "en", "x")]
    assert sorted(map(tuple, exact_dedup.exact_duplicates(documents(rows)).collect())) == brute(rows)
    assert sorted(r.doc_id for r in exact_dedup.drop_duplicates(documents(rows)).collect()) == [2, 3]
