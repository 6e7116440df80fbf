"""Toxicity classifier with counterfactual regularisation.

A document's features are its distinct words and their beginnings (four to seven letters), hashed.  A logistic model is
fitted to the labels; besides, each labelled sentence that names a group is written again with another group, or with a
neutral word, in its place, and the squared change of the score is penalised.  So a model cannot gain from the mere mention
of a group, and neutral mentions raise no alarm.

Fitted on at most ``MOST_ROWS`` labelled rows (chosen by hash, whole texts) and the ``MOST_FEATURES`` features that tell most;
applied to all.  Defined results: null text counts as empty and gets the score of no feature at all; without labels of both
kinds every score is the share of toxic labels (one half without any); repeated rows get equal scores.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from upkeep.llm.support import map_batches
from upkeep.llm.training import Adam, bounded, filtered, labelled_texts, scored, sigmoid

MOST_ROWS = 10_000
MOST_FEATURES = 8192
CHANCE = 50
THRESHOLD = 0.3
HASHES = 1 << 20
ROUNDS, RATE, SHRINK, COUNTERFACTUAL = 300, 0.05, 1e-4, 1.0
KEPT_WORDS = 100_000

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
#: Words for groups of people, and a neutral word in each list (fixed values).
IDENTITIES = [
    ["people", "women", "men", "girls", "boys"],
    ["people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["person", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["people", "blacks", "whites", "asians", "latinos", "arabs", "immigrants", "refugees"],
    ["person", "black", "white", "asian", "latino", "arab", "immigrant", "refugee"],
    ["person", "gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["person", "disabled", "blind", "deaf", "old", "young"],
    ["leute", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"],
    ["gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés"],
    ["gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados"],
]


def swaps(identities: list[list[str]] = IDENTITIES) -> dict[str, list[str]]:
    """For each identity word, the other words of its first list."""
    table: dict[str, list[str]] = {}
    for words in identities:
        for word in words[1:]:
            table.setdefault(word, [w for w in words if w != word])
    return table


def word_features(word: str) -> list[int]:
    beginnings = [f"{word[:n]}-" for n in range(4, 8) if len(word) > n]
    return [zlib.crc32(f.encode()) % HASHES for f in [word, *beginnings]]


def features(words) -> np.ndarray:
    return np.array(sorted({f for word in set(words) for f in word_features(word)}), dtype=np.int64)


def counterfactuals(text: str, identities: list[list[str]] = IDENTITIES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of each sentence that names a group, as it is and with another word for the group."""
    table, pairs = swaps(identities), []
    for sentence in SENTENCE.findall(text.lower()):
        words = WORD.findall(sentence)
        named = sorted(table.keys() & set(words))
        for turn in range(max((len(table[w]) for w in named), default=0)):
            other = {w: table[w][turn % len(table[w])] for w in named}
            pairs.append((features(words), features([other.get(w, w) for w in words])))
    return pairs


def described(text: str, identities: list[list[str]] = IDENTITIES) -> bytes:
    return pickle.dumps((features(WORD.findall(text.lower())), counterfactuals(text, identities)), protocol=5)


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The features that go with one label more than chance explains: likelihood-ratio test of the 2 x 2 table.

    The cut grows with the number of features tried (``CHANCE`` of them pass by chance alone), so that a small training
    set is not drowned in words that it holds once or twice.
    """
    count = lambda wanted: np.bincount(
        np.concatenate([np.zeros(0, np.int64), *[r for r, y in zip(rows, labels) if y == wanted]]), minlength=HASHES
    )
    toxic, clean, all_toxic, every = count(1), count(0), labels.sum(), len(labels)
    share = (toxic + clean) / every

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0)

    strength = 2 * (
        part(toxic, all_toxic * share)
        + part(clean, (every - all_toxic) * share)
        + part(all_toxic - toxic, all_toxic * (1 - share))
        + part(every - all_toxic - clean, (every - all_toxic) * (1 - share))
    )
    best = np.argsort(-strength, kind="stable")[:MOST_FEATURES]
    return np.sort(best[strength[best] > 2 * np.log(max(CHANCE, (share > 1 / every).sum()) / CHANCE)])


class Sparse:
    """Rows of feature places with weights, for sums per row and their gradient."""

    def __init__(self, rows: list[np.ndarray], kept: np.ndarray):
        place = np.full(HASHES, -1)
        place[kept] = np.arange(len(kept))
        found = [place[r][place[r] >= 0] for r in rows]
        self.at = np.concatenate([np.zeros(0, np.int64), *found])
        self.row = np.repeat(np.arange(len(rows)), [len(f) for f in found])
        self.rows, self.columns = len(rows), len(kept)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.at], minlength=self.rows)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=errors[self.row], minlength=self.columns)


def fit(rows: list[np.ndarray], labels: np.ndarray, pairs: list, strength: float = COUNTERFACTUAL) -> dict:
    """Weights by feature, and the bias; ``strength`` weighs the counterfactual penalty."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return {"weights": {}, "bias": float(np.log((share + 1e-9) / (1 - share + 1e-9)))}
    kept = telling(rows, labels)
    table, before, after = Sparse(rows, kept), Sparse([a for a, _ in pairs], kept), Sparse([b for _, b in pairs], kept)
    weights, bias = np.zeros(len(kept)), np.zeros(1)
    adam = Adam([weights, bias], RATE)
    for _ in range(ROUNDS):
        error = (sigmoid(table.times(weights) + bias) - labels) / len(labels)
        gradient = table.back(error) + SHRINK * weights
        if pairs:
            change = (before.times(weights) - after.times(weights)) * (2 * strength / len(pairs))
            gradient += before.back(change) - after.back(change)
        adam.apply([gradient, error.sum(keepdims=True)])
    return {"weights": dict(zip(kept.tolist(), weights.tolist())), "bias": float(bias[0])}


def train(
    docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, identities: list[list[str]] = IDENTITIES
) -> dict:
    """The model; ``identities`` lists words (lower case, a neutral one first) that may stand for one another."""

    def work(batches):
        for batch in batches:
            content = pa.array([described(t, identities) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), content], ["doc_id", "label", "content"])

    texts = labelled_texts(docs, labels, "toxic", most)
    texts = texts.select(texts["doc_id"].cast("long").alias("doc_id"), texts["label"].cast("int").alias("label"), "text")
    found = bounded(map_batches(texts, work, "doc_id long, label int, content binary"), most)
    contents = [pickle.loads(row.content) for row in found]
    return fit([c[0] for c in contents], np.array([row.label for row in found], dtype=float), [p for c in contents for p in c[1]])


class Scorer:
    """Scores of whole texts under a model; the features that a word adds are looked up once per worker."""

    def __init__(self, model: dict):
        self.weights, self.bias = model["weights"], model["bias"]
        self.words: dict[str, tuple] = {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        out, known = np.empty(len(texts)), self.words
        for i, text in enumerate(texts):
            words = set(WORD.findall(text.lower()))
            new = words.difference(known)
            if new:
                if len(known) > KEPT_WORDS:
                    known.clear()
                    new = words
                known.update((w, tuple(f for f in word_features(w) if f in self.weights)) for w in new)
            found = {f for features in map(known.__getitem__, words) if features for f in features}
            out[i] = self.bias + sum(map(self.weights.__getitem__, sorted(found)))
        return sigmoid(out)


def scorer(docs: DataFrame, model: dict):
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MOST_FEATURES weights
    return lambda: Scorer(shared.value)


def scores(docs: DataFrame, labels: DataFrame, identities: list[list[str]] = IDENTITIES) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    return scored(docs, scorer(docs, train(docs, labels, identities=identities)))


def keep_clean(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, identities: list[list[str]] = IDENTITIES
) -> DataFrame:
    """The rows scored below ``threshold``."""
    return filtered(docs, scorer(docs, train(docs, labels, identities=identities)), lambda score: score < threshold)
