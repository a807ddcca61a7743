"""A small classifier of whole texts, learned from a bounded sample of labelled ones.

Softmax regression on a few rates (symbols, repeats, capitals, word length) and
on the presence of the words that tell the classes apart best in the sample.
Features are counted in Spark tasks; the driver holds the sample's only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import BATCH_ROWS, batches, ship
from daybook.llm.shingles import Words, blocks
from daybook.llm.text_stats import counts

#: Labelled rows to learn from (those with the least hash of their id), the words
#: kept of each, and the words that the model may use.
MAX_LABELLED, MAX_WORDS_OF_ONE, MODEL_WORDS = 10_000, 2_000, 256
MIN_DOCUMENTS = 5
STEPS, RATE, SHRINK = 500, 0.5, 5e-5

_TRIM = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def rates(stats: Sequence[tuple[int, ...]]) -> np.ndarray:
    n = np.array(stats, float).reshape(-1, 6)
    words, chars = np.maximum(n[:, 0], 1), np.maximum(n[:, 1], 1)
    return np.column_stack(
        [
            np.ones(len(n)),
            np.minimum(n[:, 2] / words, 4),
            np.minimum(n[:, 1] / words, 20) / 5,
            n[:, 3] / words * 10,
            n[:, 4] / words,
            n[:, 5] / chars * 4,
            np.log1p(n[:, 0]) / 5,
        ]
    )


def word_sets(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the distinct words of each text, without the ASCII marks around them."""
    trim = bytes.maketrans(_TRIM, b" " * len(_TRIM))
    for run in blocks(texts):
        words = Words([x.translate(trim) for x in run], lower=True)
        for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
            yield np.unique(words.hashes[begin:end])


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    words: np.ndarray
    weights: np.ndarray

    def design(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[tuple[int, ...]]]:
        stats = list(counts(texts))
        present = np.zeros((len(texts), len(self.words)))
        for row, own in enumerate(word_sets(texts)):
            at = np.searchsorted(self.words, own)
            hit = at < len(self.words)
            hit[hit] = self.words[at[hit]] == own[hit]
            present[row, at[hit]] = 1
        return np.hstack([rates(stats), present]), stats

    def posteriors(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[tuple[int, ...]]]:
        design, stats = self.design(texts)
        return _softmax(design @ self.weights), stats


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _telling(sets: list[np.ndarray], kind: np.ndarray, classes: int) -> np.ndarray:
    """The words whose presence says most about the class (G statistic), sorted."""
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    words, at = np.unique(flat, return_inverse=True)
    owner = np.repeat(kind, [len(x) for x in sets])
    sizes = np.bincount(kind, minlength=classes).astype(float)
    table = np.zeros((classes, len(words)))
    np.add.at(table, (owner, at), 1)
    total = table.sum(axis=0)
    gain = np.zeros(len(words))
    for observed, whole in ((table, total), (sizes[:, None] - table, len(kind) - total)):
        expected = sizes[:, None] * whole / len(kind)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain += np.where(observed > 0, observed * np.log(observed / expected), 0).sum(axis=0)
    gain[total < MIN_DOCUMENTS] = 0
    # Chance alone gives a gain of a few units to some of very many words.
    best = np.argsort(-gain, kind="stable")[:MODEL_WORDS]
    return np.sort(words[best[gain[best] > 12]])


def fit(classes: Sequence[str], sets: list[np.ndarray], stats: list[tuple[int, ...]], kind: np.ndarray) -> Model:
    words = _telling(sets, kind, len(classes))
    present = np.array([np.isin(words, own) for own in sets], float).reshape(len(sets), len(words))
    design = np.hstack([rates(stats), present])
    weights = np.zeros((design.shape[1], len(classes)))
    goal = np.eye(len(classes))[kind]
    squares = np.full_like(weights, 1e-8)
    for _ in range(STEPS):
        slope = design.T @ (_softmax(design @ weights) - goal) / len(kind) + SHRINK * weights
        squares += slope**2
        weights = weights - RATE * slope / np.sqrt(squares)
    return Model(tuple(classes), words, weights)


def sampled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``doc_id, text`` and the labels of ``most`` labelled ids at most, one row for each.

    They are those with the least hash of their id among the ids in ``labels``, which
    has one row each. So few rows are broadcast, and no other text moves. Of an id that
    repeats with several texts, the one with the least hash counts.
    """
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    kinds = [c for c in labels.columns if c != "doc_id"]
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return found.groupBy("doc_id", *kinds).agg(least).select("doc_id", F.col("least.text").alias("text"), *kinds)


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn the classes of ``labels`` (``doc_id, kind``) from texts; None without labelled texts.

    Of each sampled text the words with the least hashes stand for it if it has
    more than MAX_WORDS_OF_ONE different ones.
    """
    ship(docs.sparkSession)
    kinds = labels.where("doc_id is not null and kind is not null").groupBy("doc_id").agg(F.min("kind").alias("kind"))
    rows = sampled(docs, kinds, MAX_LABELLED)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, BATCH_ROWS):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("kind"),
                    pa.array([list(x) for x in counts(texts)], pa.list_(pa.int64())),
                    pa.array([x[:MAX_WORDS_OF_ONE].tobytes() for x in word_sets(texts)], pa.binary()),
                ],
                names=["doc_id", "kind", "stats", "words"],
            )

    taken = rows.mapInArrow(run, "doc_id long, kind string, stats array<long>, words binary").collect()
    if not taken:
        return None
    taken.sort(key=lambda row: row["doc_id"])
    classes = sorted({row["kind"] for row in taken})
    kind = np.array([classes.index(row["kind"]) for row in taken])
    sets = [np.frombuffer(row["words"], np.uint64) for row in taken]
    return fit(classes, sets, [tuple(row["stats"]) for row in taken], kind)


def scored(docs: DataFrame, model: Model | None, classes: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_words, p``: the posterior of each of ``classes``, in this order, for each row.

    The text columns named in ``carry`` come along.
    A class that the model never saw has 0. Without a model all are equal.
    """
    ship(docs.sparkSession)
    classes = list(classes)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, BATCH_ROWS):
            texts = batch.column("text").to_pylist()
            if model is None:
                stats = list(counts(texts))
                p = np.full((len(texts), len(classes)), 1 / len(classes))
            else:
                found, stats = model.posteriors(texts)
                p = np.zeros((len(texts), len(classes)))
                for at, name in enumerate(model.classes):
                    if name in classes:
                        p[:, classes.index(name)] = found[:, at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in stats], pa.int64()),
                    pa.array(p.tolist(), pa.list_(pa.float64())),
                    *(batch.column(name) for name in carry),
                ],
                names=["doc_id", "n_words", "p", *carry],
            )

    schema = "".join(f", {name} string" for name in carry)
    return docs.select("doc_id", "text", *carry).mapInArrow(run, "doc_id long, n_words long, p array<double>" + schema)
