import random
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefkit.llm import token_counts
from cases import ODD_ROWS

P = pytest.importorskip("public_tokenizers")
PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="the ain▁  \n.é中😀", max_size=80)), min_size=1, max_size=5))
def test_counts_are_those_of_the_library(library, texts):
    engine = token_counts.transducer(PATH)
    assert engine.counts(texts, chunk=7).tolist() == [len(library.encode(t)) for t in texts]


@pytest.mark.parametrize("text", ["x" * 5000, " " * 3000, "abab" * 900, "0123456789abcdef" * 300, "<s></s><unk><0x0A>" * 20])
def test_long_runs_without_a_place_to_cut(library, text):
    assert token_counts.transducer(PATH).counts([text, "", text]).tolist() == [len(library.encode(text)), 0, len(library.encode(text))]


@pytest.mark.parametrize("text", ["=" * 1_000_000, "a" * 300_001, "abc" * 100_000, "=-" * 90 + "=" * 200_000])
def test_chunk_maps_are_compiled_in_few_passes(library, text, monkeypatch):
    """Chunks of one content share a map, so no state travels chunk by chunk."""
    engine, passes = token_counts.Transducer(token_counts.Vocabulary(PATH)), []
    run = engine.run
    monkeypatch.setattr(engine, "run", lambda *a: passes.append(len(a[1])) or run(*a))
    assert engine.counts([text]).tolist() == [len(library.encode(text))]
    assert len(passes) <= 24 and sum(passes) < 200


def test_texts_without_spaces_agree_after_two_passes(library, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(200_000))
    engine, passes = token_counts.Transducer(token_counts.Vocabulary(PATH)), []
    run = engine.run
    monkeypatch.setattr(engine, "run", lambda *a: passes.append(len(a[1])) or run(*a))
    assert engine.counts([text, text[1:]]).tolist() == [len(library.encode(t)) for t in (text, text[1:])]
    assert len(passes) <= 4


def test_a_full_table_is_forgotten(library, prose, monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_TRANSITIONS", 50)
    engine = token_counts.Transducer(token_counts.Vocabulary(PATH))
    for seed in range(4):
        assert engine.counts([prose(60, seed)]).tolist() == [len(library.encode(prose(60, seed)))]


def test_documents(documents, library):
    got = token_counts.count_tokens(documents(ODD_ROWS), PATH, limit=900).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in ODD_ROWS]
    assert sorted((tuple(r) for r in got), key=str) == sorted(((*w, w[2] > 900) for w in want), key=str)
    assert token_counts.count_tokens(documents([]), PATH).count() == 0
