"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a feature vector x is sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The
pairwise part equals half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so it takes time
linear in the features. Features are the distinct words of the whole text, hashed, shares and counts
that describe its structure, and its recorded number of characters.

The machine is fitted by Adam on a sample of labelled rows that ``per_class`` bounds; the sample's
features are computed where the documents are, and one task fits. Everything is scored, in place.

A null or empty text has no words and is scored by its statistics. A null ``n_chars`` is replaced by
the text's own length. Repeated rows get the same score, and null ids change nothing. With labels of
one class only, or none, every text gets the smoothed share of label 1.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import Memo, bound_batches
from delaycast.llm.labelled import fit_in_task, labelled_sample

WORD_MEMO, MEMO_CHARS = 100_000, 48
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
STOPS = b".,;:'\"()-?"
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in STOPS)
HIGH = bytes(range(128, 256))
STATISTICS = 12


class MachineParameters(NamedTuple):
    """``bits`` of the word hash, ``rank`` of the factors, and how the machine is fitted."""

    bits: int = 16
    rank: int = 8
    per_class: int = 2500
    steps: int = 500
    batch: int = 128
    rate: float = 0.01
    penalty: float = 1e-5
    threshold: float = 0.7


def statistics(raw: bytes, words: list[bytes], distinct: int, n_chars: int | None) -> list[float]:
    """Structure statistics, each about 0 to 1."""
    size, count = max(1, len(raw)), max(1, len(words))
    lines = raw.split(b"\n")

    def share(kind: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kind))) / size

    chars = n_chars if n_chars is not None else len(raw.decode("utf-8", "replace"))
    marked = raw.count(b"!") + raw.count(b"#") + raw.count(b"$") + raw.count(b"%") + raw.count(b"*") + raw.count(b"&")
    return [
        math.log1p(len(words)) / 10,
        math.log1p(max(0, chars)) / 12,
        math.log1p(len(lines)) / 8,
        3 * share(UPPER),
        5 * share(DIGITS),
        5 * share(SYMBOLS),
        5 * share(STOPS),
        3 * share(HIGH),
        min(3.0, len(raw) / count / 10),
        distinct / count,
        1 - len(set(lines)) / len(lines),
        min(2.0, marked / count),
    ]


class Featurizer:
    """Word numbers and statistics of texts; remembers the numbers of frequent words."""

    def __init__(self, bits: int) -> None:
        mask = (1 << bits) - 1
        self.numbers = Memo(lambda word: zlib.crc32(word) & mask, WORD_MEMO, MEMO_CHARS)

    def __call__(self, raw: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
        raw = raw or b""
        words = raw.lower().split()
        numbers = np.unique(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        return numbers, np.array(statistics(raw, words, len(numbers), n_chars), np.float32)


class Machine(NamedTuple):
    """Bias, linear weights and factors: words first, then statistics; ``center`` of the statistics."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    center: np.ndarray
    spread: np.ndarray

    @property
    def learnt(self) -> bool:
        """Whether there were two classes to learn from; else every text gets the same score."""
        return bool(self.factors.any())

    def logit(self, numbers: np.ndarray, dense: np.ndarray) -> float:
        """The machine's sum for one text, in time linear in its features."""
        size = len(self.linear) - STATISTICS
        scale = np.float32(1 / math.sqrt(max(1, len(numbers))))
        values = (dense - self.center) / self.spread
        own = self.factors[numbers]
        word_sum = own.sum(axis=0) * scale
        word_squares = np.einsum("ij,ij->j", own, own) * scale * scale
        tail = self.factors[size:] * values[:, None]
        total = word_sum + tail.sum(axis=0)
        pairs = 0.5 * float((total * total - word_squares - (tail * tail).sum(axis=0)).sum())
        return self.bias + float(self.linear[numbers].sum() * scale + self.linear[size:] @ values) + pairs


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit_machine(rows: list[dict], parameters: MachineParameters) -> Machine:
    """Fit by Adam on logistic loss; ``rows`` have numbers, dense, label and weight."""
    size, rank = (1 << parameters.bits) + STATISTICS, parameters.rank
    chance = np.random.default_rng(7)
    dense = np.array([r["dense"] for r in rows], np.float32).reshape(-1, STATISTICS)
    labels = np.array([r["label"] for r in rows], np.float32)
    weights = np.array([r["weight"] for r in rows], np.float32)
    positive, total = float((weights * labels).sum()), float(weights.sum())
    bias = math.log((positive + 1) / (total - positive + 1))
    center = dense.mean(axis=0) if len(rows) else np.zeros(STATISTICS, np.float32)
    spread = dense.std(axis=0) + 0.05 if len(rows) else np.ones(STATISTICS, np.float32)
    theta = np.zeros((size, rank + 1), np.float32)
    if len(set(labels.tolist())) < 2:
        return Machine(bias, theta[:, 0], theta[:, 1:], center, spread)
    theta[:, 1:] = chance.normal(0, 0.02, (size, rank))
    values = (dense - center) / spread
    numbers = [np.array(r["numbers"], np.int64) for r in rows]
    mean, square, step = np.zeros_like(theta), np.zeros_like(theta), 0
    bias_mean = bias_square = 0.0
    weights = weights * len(rows) / total
    for _ in range(math.ceil(parameters.steps * parameters.batch / len(rows))):
        order = chance.permutation(len(rows))
        for at in range(0, len(rows), parameters.batch):
            some = order[at : at + parameters.batch]
            lengths = np.array([len(numbers[i]) for i in some])
            owner = np.repeat(np.arange(len(some)), lengths)
            index = np.concatenate([numbers[i] for i in some])
            x = (1 / np.sqrt(np.maximum(1, lengths)))[owner].astype(np.float32)
            tail = np.arange(size - STATISTICS, size)
            index = np.concatenate([index, np.tile(tail, len(some))])
            owner = np.concatenate([owner, np.repeat(np.arange(len(some)), STATISTICS)])
            x = np.concatenate([x, values[some].ravel()])
            rows_x = theta[index] * x[:, None]
            sums = np.zeros((len(some), rank + 1), np.float32)
            np.add.at(sums, owner, rows_x)
            squares = np.zeros(len(some), np.float32)
            np.add.at(squares, owner, (rows_x[:, 1:] ** 2).sum(axis=1))
            logit = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]) * weights[some] / len(some)
            slope = np.empty_like(rows_x)
            slope[:, 0] = x
            slope[:, 1:] = x[:, None] * (sums[owner, 1:] - rows_x[:, 1:])
            gradient = np.zeros_like(theta)
            np.add.at(gradient, index, slope * error[owner, None])
            gradient += parameters.penalty * theta
            step += 1
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient * gradient - square)
            theta -= parameters.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            bias_mean += 0.1 * (float(error.sum()) - bias_mean)
            bias_square += 0.001 * (float(error.sum()) ** 2 - bias_square)
            bias -= parameters.rate * (bias_mean / (1 - 0.9**step)) / (math.sqrt(bias_square / (1 - 0.999**step)) + 1e-8)
    return Machine(bias, np.ascontiguousarray(theta[:, 0]), np.ascontiguousarray(theta[:, 1:]), center, spread)


def train_quality(
    documents: DataFrame, labels: DataFrame, parameters: MachineParameters = MachineParameters(), target: str = "quality"
) -> Machine:
    """The machine for ``target``, learnt from labelled rows whose crc32 remainder by 4 is not 2."""
    bound_batches(documents.sparkSession)
    sample = labelled_sample(documents, labels, target, 4, 2, parameters.per_class, ["text", "n_chars"])
    kind = "struct<numbers: array<int>, dense: array<float>>"

    @F.arrow_udf(kind)
    def describe(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        featurize = Featurizer(parameters.bits)
        for raw, sizes in batches:
            found = [featurize(r.as_py(), n.as_py()) for r, n in zip(raw, sizes, strict=True)]
            yield pa.array(
                [{"numbers": numbers, "dense": dense} for numbers, dense in found],
                pa.struct([("numbers", pa.list_(pa.int32())), ("dense", pa.list_(pa.float32()))]),
            )

    features = sample.select("doc_id", "label", "weight", describe(F.col("text").cast("binary"), F.col("n_chars")).alias("f"))
    features = features.select("doc_id", "label", "weight", "f.numbers", "f.dense")
    return pickle.loads(fit_in_task(features, lambda rows: fit_machine(rows, parameters)))


def quality_score(
    df: DataFrame, machine: Machine, parameters: MachineParameters = MachineParameters(), text: str = "text", n_chars: str = "n_chars"
) -> Column:
    """The probability of label 1 as a column of ``df``."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(tuple(machine))

    @F.arrow_udf("double")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own, featurize = Machine(*shared.value), Featurizer(parameters.bits)
        for raw, sizes in batches:
            found = [
                sigmoid(own.logit(*featurize(r.as_py(), n.as_py()))) for r, n in zip(raw, sizes, strict=True)
            ]
            yield pa.array(found, pa.float64())

    return score(F.col(f"`{text}`").cast("binary"), F.col(f"`{n_chars}`").cast("long"))
