"""Quality scores by Bradley-Terry pairwise ranking.

A document's score is a linear function of features of its whole text. It is learned from preference
pairs (a document labelled good is preferred to one labelled poor): the probability that one beats
the other is the logistic function of the difference of their scores, so the weights minimise the
logistic loss on feature differences. The threshold is a quantile of the scores of the labelled
documents: the share of them that is labelled poor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefkit.llm.common import id_crc32, small_batches, written
from prefkit.llm.shingles import shingle_sets
from prefkit.llm.textblocks import byte_blocks, span_hashes, word_hashes, word_spans

#: Labelled documents that are fitted, in expectation; a seeded hash of the id picks them.
TRAINING_DOCUMENTS = 20_000
#: Preference pairs drawn from them.
PAIRS = 60_000
PENALTY = 1e-3
SEED = 20240603

_PUNCTUATION = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
_SHARES = [
    "upper",
    "digits",
    "spaces",
    "lines",
    "wide",
    "repeated_word",
    "seen_word",
    "seen_trigram",
    "seen_line",
    "ends_in_mark",
    "word_of_marks",
    "one_letter",
    "long_word",
]
FEATURES = [*_SHARES, "log_words", "word_length", "length_spread", *(f"mark_{chr(c)}" for c in _PUNCTUATION)]


def _seen(keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Per text: how many of its keys occur in it before."""
    if not len(keys):
        return np.zeros(texts)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    again = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[1:][again], minlength=texts).astype(float)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The features of the texts of a block, a row each. Shares are taken to the square root, so that
    small ones differ visibly. A text without words has zeros."""
    texts = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    histogram = np.bincount(owner * 256 + data, minlength=texts * 256).reshape(texts, 256).astype(float)
    per_byte = {
        "upper": histogram[:, 65:91].sum(1),
        "digits": histogram[:, 48:58].sum(1),
        "spaces": histogram[:, 32],
        "lines": histogram[:, 10],
        "wide": histogram[:, 192:].sum(1),
    }
    starts, ends, word_owner = word_spans(data, offsets)
    count = np.bincount(word_owner, minlength=texts).astype(float)
    words = np.maximum(count, 1)
    h = word_hashes(data, starts, ends)
    length = (ends - starts).astype(float)
    letter = np.zeros(256, bool)
    letter[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    per = lambda hit: np.bincount(word_owner[hit], minlength=texts).astype(float)
    letters = np.concatenate([[0], np.cumsum(letter[data])])
    own_letters = letters[ends] - letters[starts]
    beside = np.zeros(len(h), bool)
    beside[1:] = (h[1:] == h[:-1]) & (word_owner[1:] == word_owner[:-1])
    plain_end = np.zeros(256, bool)
    plain_end[[ord(c) for c in ".,;:?'\")"]] = True
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    per_word = {
        "repeated_word": per(beside),
        "seen_word": _seen(h, word_owner, texts),
        "ends_in_mark": per(~letter[last] & ~plain_end[last]),
        "word_of_marks": per(own_letters == 0),
        "one_letter": per(length == 1),
        "long_word": per(length > 25),
    }
    triples, bounds = shingle_sets(data, offsets, 3)
    per_word["seen_trigram"] = np.maximum(count - 2 - np.diff(bounds), 0)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[:-1] |= data == 10
    cuts = np.flatnonzero(edge)
    skip = (data[cuts[:-1]] == 10).astype(np.int64) if len(data) else np.zeros(0, np.int64)
    begin, end = cuts[:-1] + skip, cuts[1:]
    begin, end = begin[end - begin > 2], end[end - begin > 2]
    line_owner = np.searchsorted(offsets, begin, "right") - 1
    line_hash = span_hashes(data.astype(np.uint64) + np.uint64(1), begin, end)
    n_lines = np.maximum(np.bincount(line_owner, minlength=texts), 1)
    shares = {k: v / size for k, v in per_byte.items()} | {k: v / words for k, v in per_word.items()}
    shares["seen_line"] = _seen(line_hash, line_owner, texts) / n_lines
    mean = np.bincount(word_owner, length, texts) / words
    spread = np.sqrt(np.maximum(np.bincount(word_owner, length**2, texts) / words - mean**2, 0))
    marks = histogram[:, _PUNCTUATION] / size[:, None]
    columns = [np.sqrt(shares[k]) for k in _SHARES] + [np.log1p(count), np.log1p(mean), np.log1p(spread)]
    out = np.column_stack([*columns, np.sqrt(marks)])
    out[count == 0] = 0
    return out


@dataclass
class Ranking:
    """score = scale * (weights . clipped standard features - threshold), through the logistic function."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * (self.raw(x) - self.threshold), -500, 500)))


def fit_ranking(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> Ranking:
    """Bradley-Terry weights of features ``x`` from labels ``good`` (bool), by Newton steps on pairs
    drawn with a seed. With labels of one kind only there are no pairs: all weights are 0 and every
    document is of that kind (good without any label)."""
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    mean = x.mean(0) if len(x) else np.zeros(width)
    spread = x.std(0) if len(x) else np.ones(width)
    ranking = Ranking(mean, np.where(spread > 1e-9, spread, 1.0), np.zeros(width), 0.0, 1.0)
    above, below = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(above) or not len(below):
        ranking.threshold = 1.0 if len(below) else 0.0
        return ranking
    z = np.clip((x - ranking.mean) / ranking.spread, -8, 8)
    draw = np.random.Generator(np.random.PCG64(seed))
    d = z[draw.choice(above, pairs)] - z[draw.choice(below, pairs)]
    w = np.zeros(width)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))
        gradient = d.T @ (p - 1) / pairs + PENALTY * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / pairs + PENALTY * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    ranking.weights = w
    raw = np.sort(ranking.raw(x))
    at = len(below)  # the quantile that the poor ones make up, between two scores
    ranking.threshold = float((raw[at - 1] + raw[at]) / 2)
    spread_raw = raw.std()
    ranking.scale = float(4 / spread_raw) if spread_raw > 0 else 1.0
    return ranking


def _features_of(rows: DataFrame, extra: str) -> DataFrame:
    """``rows`` (``extra``, text) -> ``extra`` and the features as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in byte_blocks(batch.column("text")):
                x = features(data, offsets)
                values = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1]).astype(np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(extra).slice(first, len(x)), values], [extra, "x"])

    return rows.mapInArrow(run, f"{extra} boolean, x array<double>")


def train(labelled: DataFrame, most: int = TRAINING_DOCUMENTS, pairs: int = PAIRS) -> Ranking:
    """The ranking of ``labelled`` (doc_id, text, good: boolean without nulls). Of more than ``most``
    rows a share of about ``most`` is fitted, picked by a seeded hash of doc_id; their features (a
    bounded table) are fitted on the driver."""
    labelled = written(labelled.select("doc_id", "text", "good"), "quality-labelled")
    n = labelled.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    picked = labelled.filter(draw < min(1.0, most / n)) if n else labelled
    rows = _features_of(picked.select("good", "text"), "good").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    good = np.array([r["good"] for r in rows], bool)
    order = np.lexsort([*x.T, good])  # rows arrive in any order; the draw must not depend on it
    return fit_ranking(x[order], good[order], pairs)


def score(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.5) of every row's whole text. A null text
    counts as empty and is scored by the features of an empty text."""
    held = docs.sparkSession.sparkContext.broadcast(ranking)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for first, data, offsets in byte_blocks(batch.column("text")):
                s = model.score(features(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(s)), pa.array(s)], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def trained_on(
    docs: DataFrame,
    labels: DataFrame,
    trains: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = TRAINING_DOCUMENTS,
) -> Ranking:
    """The ranking learned from the rows of ``docs`` for which ``trains`` (a condition on its column
    ``doc_id``) holds and that ``labels`` (doc_id and ``label_col``, 1 for good) covers. Null labels
    are left out; a document with several labels counts with each. Of more than ``most`` labels a
    share of about ``most`` is used, picked by a seeded hash of doc_id; these few are broadcast to
    the documents, so no text is moved but theirs."""
    small_batches(docs.sparkSession)
    marks = labels.filter(F.col(label_col).isNotNull())
    marks = marks.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label_col) == 1).alias("good")).filter(trains)
    marks = written(marks, "quality-labels")
    n = marks.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    picked = marks.filter(draw < min(1.0, most / max(n, 1)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return train(rows.join(F.broadcast(picked), "doc_id"))


def is_held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``remainder`` (null ids: not)."""
    return F.coalesce(id_crc32("doc_id") % modulus == remainder, F.lit(False))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted poor; all columns are kept. Learns from two thirds of the
    labels. Every row is judged by its own text where it lies: nothing is shuffled."""
    ranking = trained_on(docs, labels, ~is_held_out(3, 1), id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(ranking)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            good = [model.score(features(data, offsets)) >= 0.5 for _, data, offsets in byte_blocks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(good))) if good else batch

    return docs.mapInArrow(run, docs.schema)
