import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefkit.llm import packing
from prefkit.llm.token_ids import ChunkIds
from cases import ODD_ROWS

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ids():
    return ChunkIds(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab eE'st\n\t.,!1é 中 |<>", max_size=60), min_size=1, max_size=6))
def test_ids_are_those_of_the_library(ids, library, texts):
    flat, offsets = ids(texts)
    assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings_and_forgotten_chunks(ids, library, monkeypatch):
    monkeypatch.setattr("prefkit.llm.token_ids.MOST_CHUNKS", 3)
    for texts in (["a<|endoftext|>b <|endoftext|>", "<|endo ftext|>"], ["we'll see", "don't we'll"], ["", "  two  spaces "]):
        flat, offsets = ids(texts)
        assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_groups_are_packed_whole_and_within_capacity(lengths):
    bins = packing.packed_group(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in bins)


def test_local_search_empties_a_sequence():
    # Best fit leaves 70+24 and 60+30 and 6; exchanging 24 for 30 fills one sequence.
    bins = packing.Bins(100)
    for b, content in enumerate(([70, 24], [60, 30], [10, 6])):
        bins.fill.append(sum(content))
        bins.content.append(sorted((x, 10 * b + i) for i, x in enumerate(content)))
    packing.local_search(bins, 1000)
    assert sorted(f for f in bins.fill if f) == [100, 100]


def test_best_exchange_two_for_one():
    gain, leave, back = packing.best_exchange([(20, 0), (25, 1)], [(30, 2), (60, 3)], 15)
    assert gain == 15 and [x[0] for x in leave] == [20, 25] and [x[0] for x in back] == [30]


def check(rows, got, library, length):
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        own = np.array(want[r["doc_id"]][0][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    for i, p in pieces.items():
        n = len(want[i][0])
        assert sum(x[2] for x in p) == n * len(want[i])
        if n <= length:
            assert {x[0] for x in p} == {0}
        else:
            assert all(x[2] == length for x in p if x[0] > 0)
    return len(sequences)


def test_documents_are_packed_whole(documents, prose, library):
    r = random.Random(3)
    rows = [*ODD_ROWS, *((100 + i, prose(r.randint(1, 150), i), "en", "a") for i in range(120)), (900, prose(900, 5), "en", "a")]
    got = packing.pack_documents(documents(rows), PATH, length=256).collect()
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows)
    assert check(rows, got, library, 256) <= -(-total // 256) + 2


def test_sparse_sequences_meet_in_further_rounds(documents, prose, library, spark):
    rows = [(i, prose(3 + i % 9, i), "en", "a") for i in range(200)]
    pieces = packing.written(packing.pieces(documents(rows), PATH, 256), "test-pieces")
    got = packing.pack_pieces(pieces, 256, group_pieces=20).collect()
    total = sum(r["length"] for r in got)
    assert check(rows, got, library, 256) <= -(-total // 256) + 2


def test_empty_table(documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_words_that_collide_in_polynomial_hashes():
    """Thue-Morse words and their complements: one value under any polynomial modulo 2 ** 64."""
    from tokenizers import Tokenizer

    from prefkit.llm import queries
    from prefkit.llm.token_ids import ChunkIds

    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    texts = [word[:1024], word[1024:], f"x {word[:1024]} {word[1024:]}"]
    path = queries.tokenizer_file("byte_bpe_50k.json")
    ids, offsets = ChunkIds(path)(texts)
    library = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def test_large_ids_beside_a_null_id(documents):
    from prefkit.llm import packing, queries

    big = 2**60 + 1
    rows = [(big, "some words here", "en", "a"), (None, "no id", "en", "a"), (big + 1, "", "en", "a"), (-big, None, "en", "a")]
    got = packing.pack_documents(documents(rows), queries.tokenizer_file("byte_bpe_50k.json")).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted([big, None, big + 1, -big], key=str)
