"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every word of the vocabulary has a sparse random index vector.  A word's vector is the sum of the index vectors of its
neighbours in the training texts, scaled to length one, beside its own index vector.  Words outside the vocabulary are
replaced by their shape (case, length, digits); a word that repeats the one before it is marked.  A document is the mean of
its tokens' vectors.  The network (one hidden layer) is trained on part of the labelled rows; a temperature chosen on the
rest calibrates its probabilities.

Fitted on at most ``MOST_ROWS`` labelled rows (chosen by hash, whole texts); applied to all.  Defined results: null text
counts as empty and is pooled to zeros; without labels of both kinds every score is the share of good labels (one half
without any); repeated rows get equal scores.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from upkeep.llm.support import map_batches
from upkeep.llm.training import Adam, bounded, filtered, labelled_texts, scored, sigmoid

MOST_ROWS = 5000
VOCABULARY = 2048
LEAST_DOCUMENTS = 20
SIZE, NONZERO, WINDOW = 64, 8, 2
HIDDEN, ROUNDS, RATE, SHRINK = 32, 300, 0.01, 1e-3
CALIBRATION = 5  # every fifth training row
THRESHOLD = 0.7
KEPT_WORDS = 100_000

TOKEN = re.compile(r"\w+|[^\w\s]|\n")
REPEATED = "<again>"


def shape(token: str) -> str:
    if token.isalpha():
        case = "upper" if token.isupper() and len(token) > 1 else "title" if token[0].isupper() else "lower"
        return f"<{case} {min(len(token), 20) // 2}>"
    return "<number>" if token[0].isdigit() else token if not token.isalnum() else "<mixed>"


def tokens(text: str) -> list[str]:
    found = TOKEN.findall(text)
    return [REPEATED if a == b and a.isalpha() else a for a, b in zip(found, ["", *found])]


class Pooler:
    """Texts to pooled vectors, by the token numbers and vectors of a model."""

    def __init__(self, numbers: dict[str, int], vectors: np.ndarray):
        self.numbers, self.vectors, self.unknown = numbers, vectors, len(numbers)
        self.known: dict[str, int] = {}

    def number(self, token: str) -> int:
        found = self.numbers.get(token)
        return self.numbers.get(shape(token), self.unknown) if found is None else found

    def ids(self, text: str) -> np.ndarray:
        found, known = tokens(text), self.known
        new = set(found).difference(known)
        if new:
            if len(known) > KEPT_WORDS:
                known.clear()
                new = set(found)
            known.update((t, self.number(t)) for t in new)
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.vectors.shape[1]))
        for i, text in enumerate(texts):
            counts = np.bincount(self.ids(text), minlength=self.unknown + 1)
            used = np.flatnonzero(counts)
            if len(used):
                out[i] = counts[used] @ self.vectors[used] / counts.sum()
        return out


def numbered_tokens(documents: Counter) -> dict[str, int]:
    """Numbers of the most frequent tokens and of all shapes seen."""
    frequent = [(t, n) for t, n in documents.items() if n >= LEAST_DOCUMENTS]
    frequent = [t for t, _ in sorted(frequent, key=lambda x: (-x[1], x[0]))[:VOCABULARY]]
    shapes = sorted({shape(t) for t in documents if t != REPEATED})
    return {t: i for i, t in enumerate(dict.fromkeys([REPEATED, *frequent, *shapes]))}


def word_vectors(sequences: list[np.ndarray], words: int, seed: int = 3) -> np.ndarray:
    """Context sums and index vectors side by side; one row more for what is unknown."""
    draw = np.random.default_rng(seed)
    index = np.zeros((words + 1, SIZE))
    for row in index:
        row[draw.choice(SIZE, NONZERO, replace=False)] = draw.choice([-1.0, 1.0], NONZERO) / np.sqrt(NONZERO)
    together = np.zeros((words + 1) ** 2, dtype=np.float32)  # how often one word follows another, nearer ones counting more
    for ids in sequences:
        for gap in range(1, WINDOW + 1):
            pairs, counts = np.unique(ids[gap:].astype(np.int64) * (words + 1) + ids[:-gap], return_counts=True)
            together[pairs] += counts / gap
    together = together.reshape(words + 1, words + 1)
    context = together @ index + together.T @ index
    return np.hstack([context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-12), index])


class Network:
    """Two layers over standardised inputs, with a temperature."""

    def __init__(self, inputs: np.ndarray, labels: np.ndarray, seed: int = 5):
        draw = np.random.default_rng(seed)
        rest = np.arange(len(inputs)) % CALIBRATION == CALIBRATION - 1
        if len(set(labels[rest])) < 2 or len(set(labels[~rest])) < 2:
            rest[:] = False
        self.mean, self.scale = inputs.mean(axis=0), inputs.std(axis=0) + 1e-6
        size = inputs.shape[1]
        self.layers = [draw.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        x, y = (inputs[~rest] - self.mean) / self.scale, labels[~rest]
        adam = Adam(self.layers, RATE)
        for _ in range(ROUNDS):
            first, shift, second, bias = self.layers
            hidden = np.tanh(x @ first + shift)
            error = (sigmoid(hidden @ second + bias) - y) / len(y)
            inner = np.outer(error, second) * (1 - hidden * hidden)
            adam.apply([x.T @ inner + SHRINK * first, inner.sum(axis=0), hidden.T @ error + SHRINK * second, error.sum(keepdims=True)])
        if rest.any():
            logits, y = self.logits(inputs[rest]), labels[rest]
            loss = lambda t: -np.log(np.where(y == 1, sigmoid(logits / t), sigmoid(-logits / t)) + 1e-12).mean()
            self.temperature = float(min(np.geomspace(0.25, 4, 33), key=loss))

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        first, shift, second, bias = self.layers
        return np.tanh((inputs - self.mean) / self.scale @ first + shift) @ second + bias

    def __call__(self, inputs: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(inputs) / self.temperature)


def fit(texts: Iterable[list[str]], labels: np.ndarray) -> dict:
    """A model from tokenised texts: token numbers, vectors and network, or a constant share."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return {"share": share}
    first, documents, sequences = {}, Counter(), []
    for text in texts:  # one at a time: numbers take far less room than words
        documents.update(set(text))
        sequences.append(np.array([first.setdefault(t, len(first)) for t in text], dtype=np.int32))
    numbers = numbered_tokens(documents)
    of = Pooler(numbers, np.zeros((len(numbers) + 1, 1))).number
    final = np.array([of(t) for t in first], dtype=np.int32)
    sequences = [final[s] for s in sequences]
    vectors = word_vectors(sequences, len(numbers))
    counts = [np.bincount(s, minlength=len(numbers) + 1) for s in sequences]
    inputs = np.array([c @ vectors / max(1, c.sum()) for c in counts])
    return {"numbers": numbers, "vectors": vectors, "network": Network(inputs, labels)}


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> dict:
    def work(batches):
        for batch in batches:
            content = pa.array([pickle.dumps(tokens(t), protocol=5) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), content], ["doc_id", "label", "content"])

    texts = labelled_texts(docs, labels, "quality", most)
    texts = texts.select(texts["doc_id"].cast("long").alias("doc_id"), texts["label"].cast("int").alias("label"), "text")
    found = bounded(map_batches(texts, work, "doc_id long, label int, content binary"), most)
    return fit((pickle.loads(row.content) for row in found), np.array([row.label for row in found], dtype=float))


class Scorer:
    def __init__(self, model: dict):
        self.share, self.network = model.get("share"), model.get("network")
        self.pool = Pooler(model["numbers"], model["vectors"]) if self.network else None

    def __call__(self, texts: list[str]) -> np.ndarray:
        return self.network(self.pool(texts)) if self.network else np.full(len(texts), self.share)


def scorer(docs: DataFrame, model: dict):
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vectors of a bounded vocabulary
    return lambda: Scorer(shared.value)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    return scored(docs, scorer(docs, train(docs, labels)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows scored at ``threshold`` or above."""
    return filtered(docs, scorer(docs, train(docs, labels)), lambda score: score >= threshold)
