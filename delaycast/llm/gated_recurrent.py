"""Toxicity: a bidirectional gated recurrent network with attention pooling, over overlapping windows.

The inputs of a word are an embedding of the hashed word, the mean embedding of its hashed character
four-grams, and how far the shares of toxic and of other sample documents that have the word, and the most
telling of its four-grams, lie apart. Their
projection to the gates does not depend on the neighbours, so it is computed once for a distinct word
and remembered. A forward and a backward gated recurrent layer read a window of words, attention weighs
their states, and the weighted state gives the window's logit. Windows start every ``stride`` words and
the last one ends with the text, so every word of the whole text is seen, most of them twice; a text's
score is that of its most toxic window.

The network is trained in numpy, with gradients through time written out, in one task on a sample of
labelled rows that ``per_class`` bounds. Labels tell whether a text is toxic, not where: the first
round trains on the windows with the most suspicious words, the second on those that the network itself
scores highest, for toxic texts as examples and for the others as counterexamples.

Null texts and texts without words get the smoothed share of toxic labels, as do all texts if labels
of one class only, or none, are given. Repeated rows get the same score, and null ids change nothing.
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

from delaycast.llm.common import bound_batches
from delaycast.llm.labelled import fit_in_task, labelled_sample

EDGE = ".,;:!?()[]{}<>\"'*#$%&"
GRAM_BITS, GRAM, EMBEDDING = 15, 4, 8
WORD_BUCKETS, GRAM_BUCKETS = 1 << 15, 1 << GRAM_BITS
# Documents with a word before it gets an embedding; how much slower embeddings learn than gates, once
# the rarer label has so many documents (with fewer in proportion, or they would learn the documents by heart).
LEAST_DOCUMENTS, EMBEDDING_RATE, EMBEDDING_DOCUMENTS = 8, 0.3, 1000
INPUTS = 2 * EMBEDDING + 2
# Words of a worker's table, words scored at a time, windows in one block of the recurrence.
TABLE_WORDS, CHUNK_WORDS, BLOCK = 100_000, 50_000, 1024


class NetworkParameters(NamedTuple):
    """Shape of windows and network, how it is trained, and the threshold of a prediction."""

    window: int = 32
    stride: int = 16
    hidden: int = 8
    attention: int = 8
    per_class: int = 2000
    steps: int = 600
    batch: int = 192
    rate: float = 0.01
    threshold: float = 0.7


class Network(NamedTuple):
    """Weights; a recurrent matrix has the columns (update, reset, candidate) x (forward, backward)."""

    words: np.ndarray
    grams: np.ndarray
    inward: np.ndarray
    offset: np.ndarray
    recurrent: np.ndarray
    attend: np.ndarray
    attend_offset: np.ndarray
    query: np.ndarray
    out: np.ndarray
    out_offset: np.ndarray


class Model(NamedTuple):
    """The network, the evidence of word and of gram buckets, and the share of label 1; no network without two classes."""

    network: Network | None
    evidence: tuple[np.ndarray, np.ndarray]
    share: float


class Buckets(NamedTuple):
    """Of each of some words the bucket, those of its character four-grams end to end, and how many these are."""

    words: np.ndarray
    grams: np.ndarray
    lengths: np.ndarray

    def take(self, numbers: np.ndarray) -> Buckets:
        starts = (np.cumsum(self.lengths) - self.lengths)[numbers]
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(int(lengths.sum())) + np.repeat(starts - (ends - lengths), lengths)
        return Buckets(self.words[numbers], self.grams[at], lengths)


def word_buckets(words: list[str]) -> Buckets:
    """Buckets of words without the punctuation at their ends; every word has a gram."""
    bare = [w.strip(EDGE) or w for w in words]
    own = np.fromiter((zlib.crc32(w.encode()) % WORD_BUCKETS for w in bare), np.int64, len(bare))
    framed = [f"<{w}>" if len(w) > 1 else f"<{w}>>" for w in bare]
    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
    points = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashed = np.zeros(max(0, len(points) - GRAM + 1), np.uint64)
    for at in range(GRAM):
        hashed = hashed * np.uint64(0x9E3779B1) + points[at : at + len(hashed)]
    hashed = (hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS)
    # A window that reaches into the next word is no gram.
    inside = np.ones(len(points), bool)
    ends = np.cumsum(sizes)
    for at in range(1, GRAM):
        inside[ends - at] = False
    return Buckets(own, hashed[inside[: len(hashed)]].astype(np.int64), sizes - GRAM + 1)


def inputs_of(words: Buckets, network: Network, evidence: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Input vectors of words."""
    starts = np.cumsum(words.lengths) - words.lengths
    means = np.add.reduceat(network.grams[words.grams], starts, axis=0) / words.lengths[:, None]
    telling = np.maximum.reduceat(evidence[1][words.grams], starts)
    own = words.words
    return np.concatenate([network.words[own], means, evidence[0][own, None], telling[:, None]], axis=1).astype(np.float32)


def window_starts(count: int, parameters: NetworkParameters) -> np.ndarray:
    """Starts of the windows over ``count`` words."""
    last = max(0, count - parameters.window)
    return np.unique(np.append(np.arange(0, last + 1, parameters.stride), last))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def split_gates(gates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = gates.shape[1] // 3
    return gates[:, :width], gates[:, width : 2 * width], gates[:, 2 * width :]


def recurrence(projected: np.ndarray, index: np.ndarray, mask: np.ndarray | None, network: Network, trace: list | None = None) -> np.ndarray:
    """States (window, place, forward and backward) of windows whose words are rows of ``projected``.

    ``projected`` has the gates in the order of the recurrent matrix. Places outside ``mask`` keep
    the state at zero. ``trace`` collects what the gradients need.
    """
    count, length = index.shape
    hidden = network.recurrent.shape[0] // 2
    forward = np.tile(np.r_[np.ones(hidden, bool), np.zeros(hidden, bool)], 3)
    ahead, back = np.ascontiguousarray(projected[:, forward]), np.ascontiguousarray(projected[:, ~forward])
    states = np.empty((count, length, 2 * hidden), np.float32)
    state = np.zeros((count, 2 * hidden), np.float32)
    gates = np.empty((count, 6 * hidden), np.float32)
    shaped = gates.reshape(count, 3, 2, hidden)
    for t in range(length):
        shaped[:, :, 0] = ahead[index[:, t]].reshape(count, 3, hidden)
        shaped[:, :, 1] = back[index[:, length - 1 - t]].reshape(count, 3, hidden)
        update_in, reset_in, candidate_in = split_gates(gates)
        own = state @ network.recurrent
        update_own, reset_own, candidate_own = split_gates(own)
        both = sigmoid(gates[:, : 4 * hidden] + own[:, : 4 * hidden])
        update, reset = both[:, : 2 * hidden], both[:, 2 * hidden :]
        candidate = np.tanh(candidate_in + reset * candidate_own)
        before = state
        state = candidate + update * (before - candidate)
        if mask is not None:
            seen = np.repeat(np.stack([mask[:, t], mask[:, length - 1 - t]], axis=1), hidden, axis=1)
            state = state * seen
        if trace is not None:
            trace.append((before, update, reset, candidate, candidate_own.copy()))
        states[:, t, :hidden] = state[:, :hidden]
        states[:, length - 1 - t, hidden:] = state[:, hidden:]
    return states


def pooled(states: np.ndarray, mask: np.ndarray | None, network: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Logits, with the attention's inner values, its weights, and the weighted states."""
    inner = np.tanh(states @ network.attend + network.attend_offset)
    scores = inner @ network.query
    if mask is not None:
        scores = np.where(mask > 0, scores, -1e9)
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    weights /= weights.sum(axis=1, keepdims=True)
    context = np.einsum("bt,bth->bh", weights, states)
    return context @ network.out + network.out_offset[0], inner, weights, context


def gradients(index: np.ndarray, mask: np.ndarray, inputs: np.ndarray, labels: np.ndarray, weights: np.ndarray, network: Network):
    """Gradients of the weighted mean logistic loss: of each weight but the embeddings, and of ``inputs``."""
    count, length = index.shape
    hidden = network.recurrent.shape[0] // 2
    trace: list = []
    projected = inputs @ network.inward + network.offset
    states = recurrence(projected, index, mask, network, trace)
    logits, inner, attention, context = pooled(states, mask, network)
    error = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * weights / count).astype(np.float32)
    d_out, d_out_offset = context.T @ error, np.array([error.sum()], np.float32)
    d_context = error[:, None] * network.out
    d_weights = np.einsum("bh,bth->bt", d_context, states)
    d_scores = attention * (d_weights - (attention * d_weights).sum(axis=1, keepdims=True))
    d_query = np.einsum("bta,bt->a", inner, d_scores)
    d_inner = d_scores[:, :, None] * network.query * (1 - inner * inner)
    d_attend = np.einsum("bth,bta->ha", states, d_inner)
    d_states = attention[:, :, None] * d_context[:, None, :] + d_inner @ network.attend.T
    d_recurrent = np.zeros_like(network.recurrent)
    d_projected = np.zeros_like(projected)
    d_state = np.zeros((count, 2 * hidden), np.float32)
    for t in range(length - 1, -1, -1):
        before, update, reset, candidate, candidate_own = trace[t]
        d_state = d_state + np.concatenate([d_states[:, t, :hidden], d_states[:, length - 1 - t, hidden:]], axis=1)
        d_state = d_state * np.repeat(np.stack([mask[:, t], mask[:, length - 1 - t]], axis=1), hidden, axis=1)
        d_candidate = d_state * (1 - update) * (1 - candidate * candidate)
        d_update = d_state * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * candidate_own * reset * (1 - reset)
        d_own = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
        d_gates = np.concatenate([d_update, d_reset, d_candidate], axis=1).reshape(count, 3, 2, hidden)
        d_recurrent += before.T @ d_own
        d_state = d_state * update + d_own @ network.recurrent.T
        for side, at in ((0, t), (1, length - 1 - t)):
            part = np.zeros((count, 3, 2, hidden), np.float32)
            part[:, :, side] = d_gates[:, :, side]
            np.add.at(d_projected, index[:, at], part.reshape(count, -1))
    d_recurrent *= block_pattern(hidden)
    d_inputs = d_projected @ network.inward.T
    found = (inputs.T @ d_projected, d_projected.sum(axis=0), d_recurrent, d_attend, d_inner.sum(axis=(0, 1)), d_query, d_out, d_out_offset)
    return found, d_inputs


def block_pattern(hidden: int) -> np.ndarray:
    """Ones where a direction's state reaches its own gates."""
    return np.tile(np.kron(np.eye(2), np.ones((hidden, hidden))), (1, 3)).astype(np.float32)


def new_network(parameters: NetworkParameters, bias: float) -> Network:
    chance, h, a = np.random.default_rng(5), parameters.hidden, parameters.attention

    def normal(*shape: int, scale: float) -> np.ndarray:
        return chance.normal(0, scale, shape).astype(np.float32)

    return Network(
        # Words and grams that training never sees stay at zero and so say nothing.
        np.zeros((WORD_BUCKETS, EMBEDDING), np.float32),
        np.zeros((GRAM_BUCKETS, EMBEDDING), np.float32),
        normal(INPUTS, 6 * h, scale=0.4),
        np.zeros(6 * h, np.float32),
        normal(2 * h, 6 * h, scale=0.4) * block_pattern(h),
        normal(2 * h, a, scale=0.5),
        np.zeros(a, np.float32),
        normal(a, scale=0.5),
        normal(2 * h, scale=0.5),
        np.array([bias], np.float32),
    )


class Scorer:
    """Scores texts; keeps the projections of the words it has met, up to a bound."""

    class _Table(dict):
        def __init__(self) -> None:
            super().__init__()
            self.fresh: list[str] = []

        def __missing__(self, word: str) -> int:
            self.fresh.append(word)
            self[word] = number = len(self) + 1  # row 0 stands for no word
            return number

    def __init__(self, model: Model, parameters: NetworkParameters) -> None:
        self.model, self.parameters = model, parameters
        self.table = self._Table()
        self.projected = np.zeros((1, 6 * parameters.hidden), np.float32)

    def _look_up(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))

    def _project_fresh(self) -> None:
        network, fresh = self.model.network, self.table.fresh
        if fresh:
            rows = inputs_of(word_buckets(fresh), network, self.model.evidence) @ network.inward + network.offset
            if len(self.table) >= len(self.projected):
                grown = np.zeros((2 * len(self.table) + 1000, self.projected.shape[1]), np.float32)
                grown[: len(self.projected)] = self.projected
                self.projected = grown
            self.projected[len(self.table) - len(fresh) + 1 : len(self.table) + 1] = rows
            self.table.fresh = []

    def _window_logits(self, index: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        out = np.empty(len(index), np.float32)
        for at in range(0, len(index), BLOCK):
            part, own = index[at : at + BLOCK], None if mask is None else mask[at : at + BLOCK]
            # Only the rows that the block needs, so the gathers stay in cache.
            words, local = np.unique(part, return_inverse=True)
            states = recurrence(self.projected[words], local.reshape(part.shape), own, self.model.network)
            out[at : at + BLOCK] = pooled(states, own, self.model.network)[0]
        return out

    def windows(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all windows of all parts, the part of each, and the places that hold words."""
        size = self.parameters.window
        rows, owners, masks = [], [], []
        for owner, part in enumerate(parts):
            starts = window_starts(len(part), self.parameters)
            seen = np.arange(size) < len(part)
            padded = part if len(part) >= size else np.append(part, np.zeros(size - len(part), np.int64))
            rows.append(padded[starts[:, None] + np.arange(size)])
            owners.append(np.full(len(starts), owner))
            masks.append(np.broadcast_to(seen.astype(np.float32), (len(starts), size)))
        return np.concatenate(rows), np.concatenate(owners), np.concatenate(masks)

    def best_logits(self, parts: list[np.ndarray]) -> np.ndarray:
        """The highest window logit of each part."""
        self._project_fresh()
        index, owners, mask = self.windows(parts)
        whole = mask[:, -1] > 0
        logits = np.empty(len(index), np.float32)
        logits[whole] = self._window_logits(index[whole], None)
        logits[~whole] = self._window_logits(index[~whole], mask[~whole])
        return np.maximum.reduceat(logits, np.searchsorted(owners, np.arange(len(parts))))

    def scores(self, texts: Iterator[str | None]) -> list[float]:
        """Scores in order; long texts are read in parts that share a window."""
        p, out, parts, owners, held = self.parameters, [], [], [], 0

        def flush() -> None:
            nonlocal parts, owners, held
            for owner, logit in zip(owners, self.best_logits(parts) if parts else [], strict=True):
                out[owner] = max(out[owner], float(logit))
            parts, owners, held = [], [], 0
            if len(self.table) > TABLE_WORDS:
                self.table = self._Table()
                self.projected = self.projected[:1]

        for text in texts:
            words = (text or "").lower().split() if self.model.network is not None else []
            out.append(-math.inf)
            step = CHUNK_WORDS // p.stride * p.stride
            for at in range(0, max(1, len(words) - p.window + p.stride), step) if words else ():
                part = words[at : at + step + p.window - p.stride]
                parts.append(self._look_up(part))
                owners.append(len(out) - 1)
                held += len(part)
                if held >= CHUNK_WORDS:
                    flush()
        flush()
        return [self.model.share if x == -math.inf else 1 / (1 + math.exp(-max(-500.0, x))) for x in out]


def evidence_of(rows: list[dict], found: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many deviations a bucket's share of toxic documents exceeds that of others, scaled and clipped.

    One document of each label is left out of the count, so that a bucket says nothing about the only
    document that has it. Also: which buckets are in enough documents to learn an embedding.
    """
    with_label = np.zeros((2, size))
    totals = np.zeros(2)
    for row, buckets in zip(rows, found, strict=True):
        with_label[row["label"]][np.unique(buckets)] += 1
        totals[row["label"]] += 1
    frequent = with_label.sum(axis=0) >= LEAST_DOCUMENTS
    with_label = np.maximum(0, with_label - 1)
    shares = with_label / totals[:, None]
    mean = with_label.sum(axis=0) / totals.sum()
    deviation = np.sqrt(mean * (1 - mean) * (1 / totals).sum()) + 1e-3
    return (np.clip((shares[1] - shares[0]) / deviation, -3, 12) / 4).astype(np.float32), frequent


def fit_network(rows: list[dict], parameters: NetworkParameters) -> Model:
    """Train on rows with text, label and weight."""
    positive = sum(r["weight"] for r in rows if r["label"] == 1)
    total = sum(r["weight"] for r in rows)
    share = (positive + 1) / (total + 2)
    none = (np.zeros(WORD_BUCKETS, np.float32), np.zeros(GRAM_BUCKETS, np.float32))
    rows = [r for r in rows if (r["text"] or "").split()]
    labels = np.array([r["label"] for r in rows], np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(None, none, share)
    table = Scorer._Table()
    parts = [np.fromiter(map(table.__getitem__, r["text"].lower().split()), np.int64) for r in rows]
    words = word_buckets([" ", *table])  # number 0 stands for no word
    by_word, frequent_words = evidence_of(rows, [words.words[p] for p in parts], WORD_BUCKETS)
    by_gram, frequent_grams = evidence_of(rows, [words.take(np.unique(p)).grams for p in parts], GRAM_BUCKETS)
    evidence = (by_word, by_gram)
    starts = np.cumsum(words.lengths) - words.lengths
    telling = np.maximum(by_word[words.words], np.maximum.reduceat(by_gram[words.grams], starts))
    network = new_network(parameters, math.log(share / (1 - share)))
    scorer = Scorer(Model(network, evidence, share), parameters)
    index, owners, mask = scorer.windows(parts)
    first = np.searchsorted(owners, np.arange(len(parts)))
    weights = np.array([r["weight"] for r in rows], np.float32)
    weights /= weights.mean()
    rarer = min(float(labels.sum()), float(len(labels) - labels.sum()))
    embedding_rate = EMBEDDING_RATE * min(1.0, rarer / EMBEDDING_DOCUMENTS)
    chance = np.random.default_rng(6)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in network]
    step = 0
    for round_number in range(2):
        if round_number:
            logits = np.empty(len(index), np.float32)
            scorer = Scorer(Model(network, evidence, share), parameters)
            scorer.projected = inputs_of(words, network, evidence) @ network.inward + network.offset
            for at in range(0, len(index), BLOCK):
                some = slice(at, at + BLOCK)
                logits[some] = scorer._window_logits(index[some], mask[some])
            suspicion = logits
        else:
            suspicion = np.where(mask > 0, np.maximum(0, telling[index]) ** 2, 0).sum(axis=1)
        order = np.lexsort((-suspicion, owners))
        top = order[first]
        # Counterexamples: of other texts the most suspicious window and two more.
        more = np.concatenate([first + chance.integers(0, np.diff(np.append(first, len(index)))) for _ in range(2)])
        more = more[labels[owners[more]] == 0]
        chosen = np.concatenate([top, more])
        for _ in range(parameters.steps // 2):
            step += 1
            some = chosen[chance.integers(0, len(chosen), parameters.batch)]
            used, local = np.unique(index[some], return_inverse=True)
            picked = words.take(used)
            inputs = inputs_of(picked, network, evidence)
            doc = owners[some]
            found, d_inputs = gradients(local.reshape(index[some].shape), mask[some], inputs, labels[doc], weights[doc], network)
            d_words, d_grams = np.zeros_like(network.words), np.zeros_like(network.grams)
            np.add.at(d_words, picked.words, d_inputs[:, :EMBEDDING])
            shared = d_inputs[:, EMBEDDING : 2 * EMBEDDING] / picked.lengths[:, None]
            np.add.at(d_grams, picked.grams, np.repeat(shared, picked.lengths, axis=0))
            d_words[~frequent_words] = 0
            d_grams[~frequent_grams] = 0
            rates = [embedding_rate, embedding_rate, *[1.0] * len(found)]
            for w, slope, (m, s), rate in zip(network, (d_words, d_grams, *found), moments, rates, strict=True):
                m += 0.1 * (slope - m)
                s += 0.01 * (slope * slope - s)
                w -= rate * parameters.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return Model(network, evidence, share)


def train_toxicity(
    documents: DataFrame, labels: DataFrame, parameters: NetworkParameters = NetworkParameters(), target: str = "toxic"
) -> Model:
    """The model for ``target``, learnt from labelled rows whose crc32 remainder by 3 is not 1."""
    bound_batches(documents.sparkSession)
    sample = labelled_sample(documents, labels, target, 3, 1, parameters.per_class, ["text"])
    return pickle.loads(fit_in_task(sample, lambda rows: fit_network(rows, parameters)))


def toxicity_score(df: DataFrame, model: Model, parameters: NetworkParameters = NetworkParameters(), text: str = "text") -> Column:
    """The probability of label 1 as a column of ``df``."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(pickle.loads(shared.value), parameters)
        for batch in batches:
            yield pa.array(scorer.scores(v.as_py() for v in batch), pa.float64())

    return score(F.col(f"`{text}`"))
