"""Toxicity: an ordinal model of severity over words and their beginnings.

A document's features are the different words it holds and the first letters of longer
words, hashed into a fixed number of slots. The model (``ordinal``) is fitted on a bounded
sample of labelled documents; every document is then scored in one pass over its whole
text, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexipost.llm.arrow import map_batches
from lexipost.llm.ordinal import OrdinalModel, fit_ordinal
from lexipost.session import stage

#: Labelled documents to fit on, at most: those with the least hashes of their keys.
TRAIN_DOCS = 6_000
FEATURE_BITS = 20
MIN_DOCS = 4  # documents of the sample that must have a feature
PREFIXES = (4, 5, 6, 7)
GRADES = 4  # 0 is clean; 1 to 3 are toxic
#: A document is toxic if P(grade > 0) is this or more. Below one half, because one marked
#: word in a document is weak evidence, and clean documents have none.
TOXIC_AT = 0.4
CACHE_WORDS = 200_000

_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    """The slots of what stands between two white spaces."""
    names = []
    for part in _WORD.findall(word.lower()):
        names.append(part)
        names += ["^" + part[:k] for k in PREFIXES if len(part) > k]
    return [xxhash.xxh3_64_intdigest(n.encode()) >> (64 - FEATURE_BITS) for n in names]


def text_features(text: str | None) -> np.ndarray:
    """The ascending different slots of a whole text; none for null."""
    found: set[int] = set()
    for word in set((text or "").split()):
        found.update(word_features(word))
    return np.array(sorted(found), np.int32)


class Scorer:
    """Scores whole texts: the sum of the weights of their different features."""

    def __init__(self, weights: dict[int, float]) -> None:
        self.weights = weights
        self.known: dict[str, tuple[int, ...]] = {}

    def _weighted(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        found = tuple(f for f in word_features(word) if f in self.weights)
        self.known[word] = found
        return found

    def __call__(self, text: str | None) -> float:
        known, hits = self.known, set()
        for word in set((text or "").split()):
            found = known.get(word)
            if found is None:
                found = self._weighted(word)
            if found:
                hits.update(found)
        # In a fixed order, so that equal texts have equal scores to the last bit.
        return sum(self.weights[f] for f in sorted(hits))


class ToxicityModel:
    """An ordinal model with its weights by feature."""

    def __init__(self, model: OrdinalModel, features: np.ndarray) -> None:
        used = np.flatnonzero(model.weights)
        self.thresholds = model.thresholds
        self.weights = dict(zip(features[used].tolist(), model.weights[used].tolist(), strict=True))

    def judge(self, scores: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected severity, P(toxic) and the most likely grade."""
        model = OrdinalModel(np.empty(0), self.thresholds)
        above = model.above(np.asarray(scores, float))
        edges = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
        return above.sum(axis=1), above[:, 0], np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)


def graded_by_evidence(
    features: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, n_features: int
) -> np.ndarray:
    """Severity grades of a sample that is labelled only toxic or not.

    A two-grade model weighs the evidence; toxic documents get 1 to ``GRADES - 1`` by the
    quantile of their score among toxic documents, the others 0.
    """
    if not toxic.any():
        return np.zeros(len(toxic), np.int64)
    model = fit_ordinal(features, lengths, toxic.astype(np.int64), n_features, 2, steps=60)
    owner = np.repeat(np.arange(len(toxic)), lengths)
    scores = np.bincount(owner, model.weights[features], minlength=len(toxic))
    cuts = np.quantile(scores[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    return np.where(toxic, 1 + np.searchsorted(cuts, scores, "left"), 0)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    train_docs: int = TRAIN_DOCS,
) -> ToxicityModel:
    """Fit on at most ``train_docs`` labelled documents.

    A document with several labels counts as toxic if one of them says so; null labels
    and null keys are passed over, and so are labels without a document. The sample is
    chosen by the hash of the key, alike at every size, and has one text per key, that of
    the least hash; its features are the one thing that goes to the driver. Without labels the model rejects nothing.
    """
    chosen = (
        labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_toxic"))
        .dropna()
        .groupBy("_key")
        .agg(F.max("_toxic").alias("_toxic"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(train_docs)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t) for t in batch.column("_text").to_pylist()]
            arrays = [batch.column("_key"), pa.array(found, pa.list_(pa.int32())), batch.column("_toxic")]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", "features", "toxic"])

    texts = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    # At most train_docs keys: a bound that holds at every size.
    found = texts.join(F.broadcast(chosen), "_key")
    # One text per key, found without moving texts: repeats count once, however many.
    least = F.broadcast(
        stage(found.groupBy("_key").agg(F.min(F.xxhash64("_text")).alias("_hash")), "toxicity-texts")
    )
    sample = found.withColumn("_hash", F.xxhash64("_text")).join(least, ["_key", "_hash"])
    picked = map_batches(
        sample.select("_key", "_text", "_toxic"), work, f"_key {dict(texts.dtypes)['_key']}, features array<int>, toxic int"
    )
    rows = (
        picked.groupBy("_key")
        .agg(F.min(F.struct("features", "toxic")).alias("_row"))
        .orderBy(F.xxhash64("_key"), "_key")
        .select("_row.features", "_row.toxic")
        .toArrow()
    )
    lists = rows.column("features").combine_chunks()
    flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    toxic = rows.column("toxic").to_numpy() > 0
    names, numbers = np.unique(flat, return_inverse=True)
    often = np.bincount(numbers, minlength=len(names)) >= MIN_DOCS
    kept = often[numbers]
    starts = np.concatenate(([0], np.cumsum(kept)))
    ends = np.cumsum(lengths)
    lengths = starts[ends] - starts[ends - lengths]
    numbers = (np.cumsum(often) - 1)[numbers[kept]]
    names = names[often]
    grades = graded_by_evidence(numbers, lengths, toxic, len(names))
    return ToxicityModel(fit_ordinal(numbers, lengths, grades, len(names), GRADES), names)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row (key, expected_severity, p_toxic, grade, toxic, kept) per row of ``docs``.

    ``toxic`` says that the chance of a grade above 0 is TOXIC_AT or more. A null text is
    an empty one and gets the score 0. Repeated rows are scored each; other columns are
    left out, whatever their names; an empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model.weights)
        for batch in batches:
            severity, toxic, grade = model.judge([score(t) for t in batch.column("_text").to_pylist()])
            arrays = [batch.column("_key"), pa.array(severity), pa.array(toxic)]
            arrays += [pa.array(grade, pa.int32()), pa.array(toxic >= TOXIC_AT), pa.array(toxic < TOXIC_AT)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["_key", "expected_severity", "p_toxic", "grade", "toxic", "kept"]
    kept = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = dict(kept.dtypes)["_key"]
    return map_batches(
        kept,
        work,
        f"_key {kind}, expected_severity double, p_toxic double, grade int, toxic boolean, kept boolean",
    ).withColumnRenamed("_key", key)


def without_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not find toxic."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model.weights)
        for batch in batches:
            _, toxic, _ = model.judge([score(t) for t in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(toxic < TOXIC_AT))

    return map_batches(docs, work, docs.schema)
