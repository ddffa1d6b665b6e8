"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of labelled texts in hashed buckets, language by language; the model is
the matrix of smoothed log probabilities (languages x buckets), whose size does not depend on the
input. It is broadcast, and each batch of texts is scored as a sparse product: the counts of a text's
n-grams times the matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefkit.llm.common import written
from prefkit.llm.textblocks import code_points, mixed, text_blocks

_U = np.uint64
ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.5
#: Labelled texts that train a language, at most in expectation; a seeded hash of the id picks them.
TRAINING_TEXTS = 20_000
#: Languages at most: the matrix is collected and broadcast (256 KB a language).
MOST_LANGUAGES = 500
SEED = 20240602
UNKNOWN = "und"
#: Counts of these many buckets make one row while training.
_SLICE = 4096

_TABLES: dict = {}


def _letter_table() -> np.ndarray:
    """1 for letters, by code point."""
    if "letter" not in _TABLES:
        _TABLES["letter"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _TABLES["letter"]


def _lower_table() -> np.ndarray:
    """The lower-case code point of each (where it is a single one); other than letters: a space."""
    if "lower" not in _TABLES:
        lower = np.full(0x110000, 32, np.uint32)
        for c in np.flatnonzero(_letter_table()).tolist():
            low = chr(c).lower()
            lower[c] = ord(low) if len(low) == 1 else c
        _TABLES["lower"] = lower
    return _TABLES["lower"]


@dataclass
class Model:
    """languages (sorted) and their log probabilities by bucket: float32, buckets x languages."""

    languages: list[str]
    weights: np.ndarray
    orders: tuple[int, ...]


def ngram_buckets(texts: list[str], orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, index of the text) of all n-grams of letters and the spaces around words, and whether
    a text has a letter. Runs of other characters count as one space; n-grams do not span texts."""
    text = "\n".join(texts) + "\n"
    points = code_points(text)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    letter = _letter_table()[points]
    lettered = np.bincount(owner[letter], minlength=len(texts)) > 0
    low = _lower_table()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a word
    low, owner = low[keep].astype(np.uint64), owner[keep]
    buckets, owners = [], []
    for n in orders:
        h = mixed(low[: max(0, len(low) - n + 1)] + _U(n << 32))
        for j in range(1, n):
            h = mixed(h ^ low[j : len(low) - n + 1 + j])
        if n == 1:
            same = low != 32
        else:
            same = owner[: len(h)] == owner[n - 1 :]
        buckets.append((h[same] >> _U(64 - bits)).astype(np.int64))
        owners.append(owner[: len(h)][same])
    return np.concatenate(buckets), np.concatenate(owners), lettered


def train(
    labelled: DataFrame,
    orders: tuple[int, ...] = ORDERS,
    bits: int = BUCKET_BITS,
    most: int = TRAINING_TEXTS,
    most_languages: int = MOST_LANGUAGES,
) -> Model:
    """The model of ``labelled`` (doc_id, text, lang: no nulls in lang).

    Of a language with more than ``most`` texts a share of about ``most`` is counted, picked by a
    seeded hash of doc_id, so that the work of training is bounded by languages times ``most``.
    Languages are taken as equally likely. More than ``most_languages`` are an error, before anything
    is collected.
    """
    spark = labelled.sparkSession
    shares = labelled.groupBy("lang").count().select(F.col("lang").alias("_lang"), (F.lit(float(most)) / F.col("count")).alias("share"))
    shares = written(shares, "lang-shares")
    if (found := shares.count()) > most_languages:
        raise ValueError(f"{found} languages are labelled, more than most_languages={most_languages}")
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    picked = labelled.join(F.broadcast(shares), F.col("lang") == F.col("_lang"))
    picked = picked.filter(draw < F.col("share")).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("slice", pa.int32()), ("counts", pa.list_(pa.int64()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, texts in text_blocks(batch.column("text")):
                at, owner, _ = ngram_buckets(texts, orders, bits)
                own = langs[first : first + len(texts)]
                for lang in set(own.tolist()):
                    part = np.bincount(at[(own == lang)[owner]], minlength=1 << bits)
                    sums[lang] = sums[lang] + part if lang in sums else part
        for lang, total in sums.items():
            for i in range(0, len(total), _SLICE):
                row = [[lang], [i // _SLICE], [total[i : i + _SLICE]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [key[0]], "slice": [key[1]], "counts": [np.sum(group["counts"].tolist(), axis=0)]})

    kind = "lang string, slice int, counts array<long>"
    parts = picked.mapInArrow(count, kind).groupBy("lang", "slice").applyInPandas(add, kind)
    rows = parts.collect()  # languages x buckets, whatever the input
    languages = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(languages), 1 << bits))
    for r in rows:
        counts[languages.index(r["lang"]), r["slice"] * _SLICE : (r["slice"] + 1) * _SLICE] = r["counts"]
    smooth = counts + SMOOTHING
    weights = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if languages else smooth
    return Model(languages, np.ascontiguousarray(weights.T, np.float32), tuple(orders))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the posterior of the predicted language) for every row.

    The whole text counts. Without text, letter or any learned language: ``und`` and 0. Of equally
    likely languages the first in the order of their names is taken.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        bits = len(m.weights).bit_length() - 1
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            preds, scores = [], []
            for _, texts in text_blocks(batch.column("text")):
                at, owner, lettered = ngram_buckets(texts, m.orders, bits)
                sums = np.stack([np.bincount(owner, w[at], len(texts)) for w in m.weights.T.copy()], axis=1) if m.languages else np.zeros((len(texts), 1))
                best = sums.argmax(axis=1)
                likely = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                known = lettered & bool(m.languages)
                preds.append(names[np.where(known, best, len(m.languages))])
                scores.append(np.where(known, likely, 0.0))
            columns = [batch.column("doc_id"), pa.array(np.concatenate(preds) if preds else [], pa.string())]
            columns.append(pa.array(np.concatenate(scores) if scores else [], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """Trains on the rows of ``docs`` for which ``trains`` holds and whose language is not null, and
    predicts every row: doc_id, lang_pred, score. Repeated rows are predicted alike; an empty table
    gives no rows; other columns are not read."""
    labelled = docs.filter(trains & F.col(lang_col).isNotNull())
    labelled = labelled.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    return predict(docs, train(labelled), id_col, text_col)
