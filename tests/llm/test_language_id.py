import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prefkit.llm import language_id
from cases import ODD_ROWS

WORDS = {
    "aa": ["thorn", "whisk", "that", "with", "they", "shall", "ought", "where"],
    "bb": ["niño", "mañana", "porque", "ciudad", "ción", "llave", "queso", "dado"],
    "cc": ["über", "schloss", "zwischen", "können", "straße", "heißen", "pfund"],
}


def text(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    return [(i, text(lang, 3 + i % 20, i), lang, "s") for i in range(240) for lang in [["aa", "bb", "cc"][i % 3]]]


def test_held_out_accuracy(documents, rows):
    train = F.col("doc_id") % 4 != 2
    got = language_id.identify(documents(rows), train).collect()
    want = {i: lang for i, _, lang, _ in rows}
    held = [r for r in got if r["doc_id"] % 4 == 2]
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(rows)


def test_the_whole_text_decides(documents, rows):
    mixed = [(9001, text("aa", 5, 1) + " " + text("bb", 400, 2), None, "s")]
    got = language_id.identify(documents(rows + mixed), F.col("doc_id") < 9000).filter("doc_id = 9001").first()
    assert got["lang_pred"] == "bb"


def test_counts_match_brute_force():
    buckets, owner, lettered = language_id.ngram_buckets(["ab a", "", "1 2"], (1, 2), 16)
    # "ab " and "a ": letters a, b, a; pairs ab, b_, _a, a_ (n-grams do not span texts).
    assert [int((owner == i).sum()) for i in range(3)] == [3 + 4, 0, 0]
    assert lettered.tolist() == [True, False, False]


def test_odd_rows(documents):
    got = language_id.identify(documents(ODD_ROWS), F.lit(True)).collect()
    assert len(got) == len(ODD_ROWS)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[1] == by[2] == by[3] == by[8] == ("und", 0.0)
    assert by[7][0] == "fr"


def test_without_training_rows_and_empty(documents):
    got = language_id.identify(documents(ODD_ROWS), F.lit(False)).collect()
    assert {r["lang_pred"] for r in got} == {"und"}
    assert language_id.identify(documents([]), F.lit(True)).count() == 0


def grams(text):
    """The n-grams of a text by hand: words of letters, each followed by one space."""
    low = "".join(c.lower() if c.isalpha() else " " for c in text + "\n").split()
    line = "".join(w + " " for w in low)
    every = [line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)]
    return Counter(g for g in every if g != " ")


def test_posteriors_are_those_of_brute_force(spark, rows):
    """Model and posterior computed from n-gram counts in dictionaries (2^20 buckets: no collisions here)."""
    rows = [(i, t[: 3 + i % 9] if i % 5 == 0 else t, lang) for i, t, lang, _ in rows[:90]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    buckets = 1 << 20
    model = language_id.train(docs, bits=20)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    counts = {lang: sum((grams(t) for _, t, own in rows if own == lang), Counter()) for lang in WORDS}
    sums = {lang: sum(c.values()) + buckets * language_id.SMOOTHING for lang, c in counts.items()}
    for i, t, _ in rows:
        logs = {
            lang: sum(n * math.log((counts[lang][g] + language_id.SMOOTHING) / sums[lang]) for g, n in grams(t).items())
            for lang in counts
        }
        top = max(logs.values())
        likely = 1 / sum(math.exp(v - top) for v in logs.values())
        assert logs[got[i]["lang_pred"]] == pytest.approx(top, abs=1e-3)
        assert got[i]["score"] == pytest.approx(likely, abs=1e-3)


def test_too_many_languages_fail_before_the_collect(spark):
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(6)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="6 languages"):
        language_id.train(docs, most_languages=5)
