"""Toxicity by a chain of linear classifiers.

Categories are 0/1 columns of a labels table, in chain order. Each has a
logistic model over the presence of selected words and over the
probabilities of the categories before it. Those are out-of-fold
predictions while fitting, so a later model learns how far an earlier one
can be trusted on texts it has not seen.

The chain is fitted in one task on at most ``max_labelled`` labelled rows,
chosen by a hash of the id; every document is scored.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_list, text_of

MAX_LABELLED = 10_000
MAX_FEATURES = 1024
MIN_DOCS = 3
FOLDS = 5
STEPS = 150
RIDGE = 1e-4
KNOWN_WORDS = 400_000
_EDGE = "\"'`.,;:!?()[]{}<>#*$%&|-_=+"


class Words:
    """Distinct words of a text as 32-bit hashes; lower-cased, without the
    punctuation around them."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        known = self._known
        if len(known) > KNOWN_WORDS:
            known.clear()
        words = set(text.split())
        for w in words.difference(known):
            known[w] = zlib.crc32(w.lower().strip(_EDGE).encode())
        return np.unique(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))


@dataclass
class Linear:
    """One link of the chain: words, their weights, those of the earlier
    probabilities, an intercept and the decision threshold."""

    words: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float
    threshold: float = 0.5

    def probability(self, docs: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        score = np.full(len(docs), self.intercept)
        if len(self.words):
            flat = np.concatenate(docs) if docs else np.empty(0, np.uint32)
            owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
            at = np.searchsorted(self.words, flat)
            at[at == len(self.words)] = 0
            hit = self.words[at] == flat
            score += np.bincount(owner[hit], self.weights[at[hit]], len(docs))
        score += before[:, :len(self.earlier)] @ self.earlier
        return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def select_words(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The words whose frequency differs most between the classes."""
    flat = np.concatenate(docs)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    words, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    positive = np.bincount(column, y[owner], len(words))
    n1 = max(1.0, y.sum())
    n0 = max(1.0, len(y) - y.sum())
    share = counts / len(y)
    gap = np.abs(positive / n1 - (counts - positive) / n0)
    score = gap / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
    score[counts < MIN_DOCS] = 0
    best = np.argsort(-score, kind="stable")[:MAX_FEATURES]
    return np.sort(words[best[score[best] > 0]])


def fit_linear(docs: list[np.ndarray], before: np.ndarray, y: np.ndarray) -> Linear:
    """Ridge logistic regression, classes weighted alike, by accelerated
    gradient steps. With one class only, the model is its constant."""
    if not len(y) or y.min() == y.max():
        sure = float(y[0]) if len(y) else 0.0
        return Linear(np.empty(0, np.uint32), np.empty(0), np.zeros(before.shape[1]), 8.0 * sure - 4.0)
    words = select_words(docs, y)
    x = np.zeros((len(docs), len(words) + before.shape[1] + 1), np.float32)
    for row, doc in enumerate(docs):
        at = np.searchsorted(words, doc)
        at[at == len(words)] = 0
        if len(words):
            x[row, at[words[at] == doc]] = 1
    x[:, len(words):-1] = before
    x[:, -1] = 1
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v /= np.linalg.norm(v)
        v = x.T @ (weight * (x @ v))
    rate = 1 / (0.25 * float(np.linalg.norm(v)) * 1.05 + RIDGE)
    w = np.zeros(x.shape[1], np.float32)
    ahead = w.copy()
    for step in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -40, 40)))
        gradient = x.T @ (weight * (p - y.astype(np.float32))) + RIDGE * ahead
        new = ahead - rate * gradient
        ahead = new + step / (step + 3) * (new - w)
        w = new
    w = w.astype(np.float64)
    k = len(words)
    return Linear(words, w[:k], w[k:-1], float(w[-1]))


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1, midway to the next lower prediction."""
    if not len(y) or not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    at = int(np.argmax(f1))
    lower = p[order[at + 1]] if at + 1 < len(y) else 0.0
    return float((p[order[at]] + lower) / 2)


def fit_chain(docs: list[np.ndarray], labels: np.ndarray) -> list[Linear]:
    """One model per label column, each given the ones before out of fold."""
    before = np.zeros((len(docs), 0))
    fold = np.arange(len(docs)) % FOLDS
    chain = []
    for y in labels.T.astype(np.float64):
        out = np.zeros(len(docs))
        for k in range(FOLDS):
            train, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(held):
                model = fit_linear([docs[i] for i in train], before[train], y[train])
                out[held] = model.probability([docs[i] for i in held], before[held])
        model = fit_linear(docs, before, y)
        model.threshold = best_threshold(out, y)
        chain.append(model)
        before = np.column_stack([before, out])
    return chain


def _dump(chain: list[Linear]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{k}_{name}": value for k, m in enumerate(chain) for name, value in vars(m).items()})
    return out.getvalue()


def _restore(data: bytes) -> list[Linear]:
    with np.load(io.BytesIO(data)) as stored:
        n = len({name.split("_")[0] for name in stored})
        return [Linear(stored[f"{k}_words"], stored[f"{k}_weights"], stored[f"{k}_earlier"],
                       float(stored[f"{k}_intercept"]), float(stored[f"{k}_threshold"])) for k in range(n)]


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        data = [words.of(t).tobytes() for t in text_list(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())],
                                         names=["doc_id", "y", "words"])


def _fit(n_categories: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
        docs = [np.frombuffer(r[2], np.uint32) for r in rows]
        labels = np.array([r[1] for r in rows], np.float64).reshape(len(rows), n_categories)
        yield pa.RecordBatch.from_arrays([pa.array([_dump(fit_chain(docs, labels))], pa.binary())], names=["model"])

    return run


def train(docs: DataFrame, labels: DataFrame, categories: list[str], max_labelled: int = MAX_LABELLED,
          text_col: str = "text", id_col: str = "doc_id") -> list[Linear]:
    """Fit the chain on labelled documents.

    Rows without an id or with a null label are passed over; of several
    labels for one id the largest count, of several texts the least. Without labelled documents every
    probability is low and nothing is toxic.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                          *[F.col(f"`{c}`").cast("int").alias(f"y{k}") for k, c in enumerate(categories)])
    ys = [f"y{k}" for k in range(len(categories))]
    bounded = (known.dropna().groupBy("doc_id").agg(*[F.max(y).alias(y) for y in ys])
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
               .select("doc_id", F.array(*ys).alias("y")))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    # At most max_labelled rows of an id and a few labels: a bounded broadcast.
    rows = (texts.join(F.broadcast(bounded), "doc_id").groupBy("doc_id")
            .agg(F.max("y").alias("y"), F.min("text").alias("text")))
    schema = T.StructType([T.StructField("doc_id", T.LongType()),
                           T.StructField("y", T.ArrayType(T.IntegerType())), T.StructField("words", T.BinaryType())])
    model = rows.mapInArrow(_features, schema).repartition(1).mapInArrow(_fit(len(categories)), "model binary").first()
    return _restore(model["model"]) if model else fit_chain([], np.zeros((0, len(categories))))


def _score(chain: list[Linear], names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            docs = [words.of(t) for t in text_list(batch.column(1))]
            before = np.zeros((len(docs), 0))
            for model in chain:
                before = np.column_stack([before, model.probability(docs, before)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p) for p in before.T],
                 pa.array(before[:, -1] > chain[-1].threshold)], names=names)

    return run


def score(docs: DataFrame, chain: list[Linear], categories: list[str],
          text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: a probability per category, and whether the
    last one is over its threshold.

    Null text reads as empty; null and repeated ids pass through; extra
    columns are ignored; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    out = T.StructType([T.StructField("doc_id", T.LongType()),
                        *[T.StructField(f"p_{c}", T.DoubleType()) for c in categories],
                        T.StructField(categories[-1], T.BooleanType())])
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return narrow.mapInArrow(_score(chain, out.names), out)
