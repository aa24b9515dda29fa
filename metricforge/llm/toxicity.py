"""Toxicity by cumulative-link ordinal regression.

The model predicts a severity grade 0 to ``GRADES - 1`` from sparse text
features (how often words and the beginnings of words stand in a stretch of
text, whatever its length) with one weight vector for all grades and an
ordered threshold for each step: P(grade > k) = sigmoid(w . x - theta_k). It
returns the grades' probabilities and the expected severity; a document is
rejected when it is more likely above grade 0 than not.

The labels only say toxic or not. The grade of a toxic training text is set
by how dense the terms that set toxic texts apart stand in it (per word, so
its length does not matter): thirds of that share among the toxic texts give
grades 1 to 3.

Fitting uses at most ``SAMPLE`` labelled documents (chosen by a hash of the
id) and ``VOCABULARY`` terms; both bounds are parameters. Scoring reads every
whole text. Counting terms is a Spark aggregation; the fit itself has a
matrix bounded by those two numbers.

Defined cases: a null text counts as empty and scores by its thresholds
alone; rows with null labels are not used; a document with several label
rows counts with the highest; without labels of both kinds nothing is known
to be toxic, and every document gets grade 0; repeated rows get the same
scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricforge.llm.common import keep, map_arrow

SAMPLE = 20_000
VOCABULARY = 4096
GRADES = 4
#: Lengths of the word beginnings that are features, and the least number of
#: sample documents with a term.
BEGINNINGS = (4, 5, 6)
LEAST_DOCUMENTS = 3
#: How many times likelier a term is in toxic than in other texts, at least: to
#: be a feature, and to count for the grade of a training text.
TELLING = 8
STRONG = 20
#: A feature is a term's count in ``STRETCH`` words; texts count as ``PRIOR``
#: words longer, so that one word of a short text is no certainty.
STRETCH = 300
PRIOR = 100
#: Words whose weight a task holds at a time.
WORDS_HELD = 1 << 18

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> Counter:
    """How often each term occurs in the whole text."""
    words = Counter(_WORD.findall((text or "").lower()))
    out = Counter({f"={w}": n for w, n in words.items()})
    for w, n in words.items():
        for k in BEGINNINGS:
            if len(w) > k:
                out[w[:k]] += n
    return out


def rate(n, words):
    """A term's count in ``STRETCH`` words of a text with ``n`` in ``words``."""
    return n * STRETCH / (words + PRIOR)


class _Weights(dict):
    """The weight of a word, with those of its beginnings, worked out once."""

    def __init__(self, vocabulary: dict[str, int], weights: np.ndarray):
        super().__init__()
        self.of = {t: float(weights[k]) for t, k in vocabulary.items()}

    def __missing__(self, w: str) -> float:
        of = self.of.get
        x = self[w] = of(f"={w}", 0.0) + sum(of(w[:k], 0.0) for k in BEGINNINGS if len(w) > k)
        return x


@dataclass
class Model:
    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray | None = None

    def grades(self, texts: list[str | None], weight: _Weights | None = None) -> np.ndarray:
        """Probability of each grade, one row for each text. ``weight`` holds
        words' weights from one call to the next."""
        out = np.zeros((len(texts), GRADES))
        if self.thresholds is None:
            out[:, 0] = 1
            return out
        score = np.zeros(len(texts))
        weight = self.word_weights() if weight is None else weight
        for i, text in enumerate(texts):
            words = _WORD.findall((text or "").lower())
            score[i] = rate(sum(map(weight.__getitem__, words)), len(words))
            if len(weight) > WORDS_HELD:
                weight.clear()
        return _probabilities(score, self.thresholds)

    def word_weights(self) -> _Weights:
        return _Weights(self.vocabulary, self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _probabilities(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    above = _sigmoid(score[:, None] - thresholds[None, :])
    above = np.hstack([np.ones((len(score), 1)), above, np.zeros((len(score), 1))])
    return above[:, :-1] - above[:, 1:]


def _thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free parameters: a start and log steps."""
    return free[0] + np.append(0, np.cumsum(np.exp(free[1:])))


def fit_cumulative_link(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
                        rounds: int = 300, penalty: float = 1e-3, rate: float = 0.1):
    """``(weights, thresholds)`` by Adam on the mean log likelihood of the
    sparse matrix (row, column, value)."""
    n, steps = len(grade), GRADES - 1
    part = np.ones(n) / n
    # Both sides of the first threshold weigh the same.
    toxic = grade > 0
    part[toxic] *= 0.5 / max(part[toxic].sum(), 1e-12)
    part[~toxic] *= 0.5 / max(part[~toxic].sum(), 1e-12)
    w, free = np.zeros(width), np.append(0.0, np.zeros(steps - 1))
    m, v = np.zeros(width + steps), np.zeros(width + steps)
    for t in range(1, rounds + 1):
        score = np.bincount(row, value * w[column], n)
        theta = _thresholds(free)
        above = _sigmoid(score[:, None] - theta[None, :])
        full = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))])
        at = np.arange(n)
        p = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        pull = part * (slope[at, grade] - slope[at, grade + 1]) / p      # d log p / d score
        by_theta = np.zeros(steps)
        for k in range(steps):
            by_theta[k] = -(part * slope[:, k + 1] / p * ((grade == k + 1).astype(float) - (grade == k))).sum()
        by_free = np.append(by_theta.sum(), [by_theta[k:].sum() * math.exp(free[k]) for k in range(1, steps)])
        gradient = np.append(np.bincount(column, value * pull[row], width) - penalty * w, by_free)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, free = w + move[:width], free + move[width:]
    return w, _thresholds(free)


def training_grades(toxic: np.ndarray, telling: np.ndarray, words: np.ndarray) -> np.ndarray:
    """0 for texts that are not toxic; the others by thirds of their share of
    strongly telling terms among all words."""
    dense = telling / np.maximum(words, 1)
    cuts = np.quantile(dense[toxic == 1], [1 / 3, 2 / 3])
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, dense, side="left"), 0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from ``labels(doc_id, toxic)`` and the texts they name."""
    chosen = (labels.select(labels[id_col].alias("id"), labels["toxic"].cast("int").alias("toxic"))
              .where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    # At most ``sample`` ids, so the chosen side is broadcast; of several
    # texts with one id the least counts.
    texts = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(chosen), "id")
             .groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))
    texts = keep(texts.select("toxic", "text"), "labelled")

    def split(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                found = [list(terms(t)) for t in part.column(1).to_pylist()]
                size = np.array([len(x) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), size).astype(np.int32)),
                     pa.array([t for x in found for t in x], pa.string())], names=["toxic", "term"])

    kinds = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not kinds.get(0) or not kinds.get(1):
        return Model()
    # Terms that tell toxic texts apart: smoothed odds above ``TELLING``, those
    # first that are both telling and frequent.
    counts = (map_arrow(texts, split, "toxic int, term string").groupBy("term")
              .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
              .where(F.col("a") + F.col("b") >= LEAST_DOCUMENTS))
    p, q = (F.col("a") + 0.5) / (kinds[1] + 1.0), (F.col("b") + 0.5) / (kinds[0] + 1.0)
    counts = counts.select("term", F.log(p / q).alias("odds"), (F.log(p / q) * p).alias("weight"))
    top = (counts.where(F.col("odds") > math.log(TELLING)).orderBy(F.desc("weight"), "term")
           .limit(vocabulary).collect())
    if not top:
        return Model()
    number = {r["term"]: i for i, r in enumerate(top)}

    def entries(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                held = [terms(x) for x in part.column(1).to_pylist()]
                found = [[(number[t], n) for t, n in x.items() if t in number] for x in held]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int32()),
                     pa.array([[k for k, _ in x] for x in found], pa.list_(pa.int32())),
                     pa.array([[n for _, n in x] for x in found], pa.list_(pa.int32())),
                     pa.array([sum(n for t, n in x.items() if t[0] == "=") for x in held], pa.int64())],
                    names=["toxic", "at", "n", "words"])

    rows = map_arrow(texts, entries, "toxic int, at array<int>, n array<int>, words long").toArrow()
    toxic = rows.column("toxic").to_numpy()
    at, n = (rows.column(c).combine_chunks() for c in ("at", "n"))
    size = at.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(toxic)), size)
    column = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    value = n.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    words = rows.column("words").to_numpy()
    odds = np.array([r["odds"] for r in top])
    telling = np.bincount(row, value * (odds[column] > math.log(STRONG)), len(toxic))
    grade = training_grades(toxic, telling, words)
    value = rate(value, words[row])
    weights, thresholds = fit_cumulative_link(row, column, value, grade, len(top))
    return Model(number, weights, thresholds)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``__mf_grades`` (probabilities), ``__mf_severity``
    (expected) and ``__mf_rejected``."""
    at = docs.columns.index(text_col)
    held = docs.sparkSession.sparkContext.broadcast(model)   # bounded by the vocabulary

    def run(batches):
        weight = held.value.word_weights()
        for batch in batches:
            for a in range(0, max(batch.num_rows, 1), 256):
                part = batch.slice(a, 256)
                p = held.value.grades(part.column(at).to_pylist(), weight)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(list(p), pa.list_(pa.float64())), pa.array(p @ np.arange(GRADES)),
                     pa.array(p[:, 0] < 0.5)],
                    names=[*batch.schema.names, "__mf_grades", "__mf_severity", "__mf_rejected"])

    plain = [f"c{i}" for i in range(len(docs.columns))]      # names may hold anything
    schema = docs.toDF(*plain).schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    out = map_arrow(docs.toDF(*plain), run,
                    f"{fields}, __mf_grades array<double>, __mf_severity double, __mf_rejected boolean")
    return out.toDF(*docs.columns, "__mf_grades", "__mf_severity", "__mf_rejected")
