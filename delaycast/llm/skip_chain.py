"""Personal data: fixed patterns, and a skip-chain conditional random field for what they miss.

Patterns find addresses, IP numbers, cards and phones. The field labels tokens: a word without a digit
and without ``@`` is none of these for certain, so only the others are variables, and a fixed neighbour
just adds its transition to a variable's own potential. Neighbouring variables share a transition
potential; distant ones share a skip potential if they are the same token, punctuation and case
aside, or carry the same five or more digits. Each occurrence is linked to the one before it, so a
token that occurs a thousand times has a thousand links and not their square. Loopy belief propagation
carries labels along both kinds of links through the whole document, so that what is plain in one place
holds where it is not. A round is a sweep forward and one backward, each in time linear in the links, so
evidence crosses any number of links in one; the rounds of a document end when none of its messages
changes by more than a tolerance, whatever other documents need. Where loops would keep them changing,
later rounds move them less and less, so they end in any case. The field is fitted on a bounded sample
of documents, labelled by the patterns;
the pattern hint and the token's looks are hidden at random in fitting, so that context, neighbours and
repetitions get weights of their own; tokens that repeat a match without matching are left out. Runs of tokens with the same label and a high enough belief become
spans, unless they touch a pattern's span.

A null text counts as empty and has no spans. Rows do not interact beyond the fitted weights, so
repeated rows and null ids get the answer of their text. Positions are code points, ends exclusive.
Texts are read whole, whatever their length: patterns in linear time, messages in time linear in the
links of a round. A token's features see 60 characters to either side and 24 of its shape. An empty
table gives an empty result. Columns other than id and text are not read, so their names may clash.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, settle
from delaycast.llm.labelled import fit_in_task

# The base patterns and their bounds.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A search from inside a run of digits fails or ends as the one from the run's start, and no match ends
# inside a run, so only starts of runs are tried: long runs take linear time.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IP_PART_MOST, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

MARK = re.compile("[0-9@]")
DIGIT = re.compile("[0-9]")
LETTERS = re.compile(r"[^\W\d_]+")
EDGE = ".,;:!?()[]{}<>\"'"
LABELS = 1 + len(KINDS)
WEIGHTS = 1 << 12
# Messages that change less than this have converged.
TOLERANCE = 1e-4
SKIP_PRIOR = 1.5

FOUND_TYPE = (
    "struct<spans: array<struct<kind: int, start: int, stop: int>>,"
    " tokens: array<struct<start: int, stop: int, base: int, joined: boolean, looks: array<int>, around: array<int>, links: array<int>>>>"
)
SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
TOKEN_KIND = pa.struct(
    [("start", pa.int32()), ("stop", pa.int32()), ("base", pa.int32()), ("joined", pa.bool_())]
    + [(n, pa.list_(pa.int32())) for n in ("looks", "around", "links")]
)


class FieldParameters(NamedTuple):
    """``belief`` that makes a span; ``rounds`` of messages after which those that
    still change are damped more and more; the bounds of the sample (documents, tokens in
    all and of one document); how to fit."""

    belief: float = 0.9
    rounds: int = 10
    sample_documents: int = 3000
    sample_tokens: int = 30_000
    document_tokens: int = 200
    epochs: int = 60
    rate: float = 0.08
    penalty: float = 1e-4


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def email_spans(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern, from each ``@`` to both sides."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) of the fixed patterns, by kind, then start."""
    out = [(0, a, b) for a, b in email_spans(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= IP_PART_MOST for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = "".join(DIGIT.findall(m[0]))
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and passes_luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(DIGIT.findall(m[0])) <= PHONE_DIGITS[1]:
                out.append((3, m.start(), m.end()))
    return out


def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) % WEIGHTS


def describe(text: str) -> tuple[list[tuple[int, int, int]], list[dict]]:
    """The base spans, and the variables: tokens with a digit or ``@``, their features and links."""
    if not MARK.search(text):
        return [], []
    spans = base_spans(text)
    by_start = sorted((start, stop, kind) for kind, start, stop in spans)
    tokens: list[dict] = []
    last: dict[str, int] = {}
    passed = before = 0
    # Runs between white space; the search starts at the word that holds the next digit or @.
    at = MARK.search(text)
    while at:
        start = at.start()
        while start > before and not text[start - 1].isspace():
            start -= 1
        stop = at.end()
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        word = text[start:stop]
        while passed < len(by_start) and by_start[passed][1] <= start:
            passed += 1
        base = next((kind for a, b, kind in by_start[passed : passed + len(KINDS)] if a < stop and start < b), -1)
        bare = word.strip(EDGE)
        digits = "".join(DIGIT.findall(word))
        shape = re.sub("[0-9]+", "9", LETTERS.sub("a", word))[:24]
        looks = [
            f"shape {shape}",
            f"sizes {','.join(str(len(d)) for d in re.findall('[0-9]+', word)[:8])}",
            f"digits {min(len(digits), 20)}",
            f"dots {min(word.count('.'), 5)}",
            f"at {'@' in word}",
            f"sum {len(digits) >= CARD_DIGITS[0] and passes_luhn(digits)}",
        ]
        left, right = text[max(0, start - 60) : start].split(), text[stop : stop + 60].split()
        around = [
            f"before {DIGIT.sub('0', left[-1].lower())[:16] if left else ''}",
            f"after {DIGIT.sub('0', right[0].lower())[:16] if right else ''}",
            "bias",
        ]
        keys = [f"same {bare.lower()}"] + ([f"digits {digits}"] if len(digits) >= 5 else [])
        links = sorted({last[k] for k in keys if k in last})
        for k in keys:
            last[k] = len(tokens)
        joined = bool(tokens) and tokens[-1]["stop"] < start and text[tokens[-1]["stop"] : start].isspace()
        tokens.append(
            {
                "start": start,
                "stop": stop,
                "base": base,
                "joined": joined,
                "looks": [_number(f) for f in looks],
                "around": [_number(f) for f in around],
                "links": [i for i in links if not (joined and i == len(tokens) - 1)],
            }
        )
        before = stop
        at = MARK.search(text, stop)
    return spans, tokens


class Field(NamedTuple):
    """Weights by feature and label, by pattern hint and label, and of the two kinds of links."""

    features: np.ndarray
    hints: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


class Graph:
    """All variables and links of some documents, side by side."""

    def __init__(self, documents: list[list[dict]]) -> None:
        tokens = [t for d in documents for t in d]
        self.size = len(tokens)
        self.base = np.array([t["base"] for t in tokens], np.int64)
        joined = np.array([t["joined"] for t in tokens], bool)
        self.looks = [np.array(t["looks"], np.int64) for t in tokens]
        self.around = [np.array(t["around"], np.int64) for t in tokens]
        chain = np.flatnonzero(joined)
        skips, offset = [], 0
        for document in documents:
            skips += [(offset + i, offset + at) for at, t in enumerate(document) for i in t["links"]]
            offset += len(document)
        skip = np.array(skips, np.int64).reshape(-1, 2)
        self.left = np.concatenate([chain - 1, skip[:, 0]])
        self.right = np.concatenate([chain, skip[:, 1]])
        self.is_chain = np.arange(len(self.left)) < len(chain)
        self.owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])[self.left]
        self.documents = len(documents)
        self.forward = self._levels(self.left, self.right, range(self.size))
        self.backward = self._levels(self.right, self.left, range(self.size - 1, -1, -1))
        # A neighbour that is no variable is fixed to label 0.
        self.fixed_before = ~joined
        self.fixed_after = ~np.append(joined[1:], False)

    def _levels(self, source: np.ndarray, target: np.ndarray, order: range) -> list[np.ndarray]:
        """Links by the level of their target: all links into their sources are on earlier levels."""
        into: dict[int, list[int]] = {}
        for a, b in zip(source.tolist(), target.tolist(), strict=True):
            into.setdefault(b, []).append(a)
        level = [0] * self.size
        for token in order:
            if token in into:
                level[token] = 1 + max(level[a] for a in into[token])
        levels = np.array(level, np.int64)[target]
        ranked = np.argsort(levels, kind="stable")
        return np.split(ranked, np.flatnonzero(np.diff(levels[ranked])) + 1) if len(ranked) else []

    def known(self) -> np.ndarray:
        """Tokens whose label the patterns tell: those that match, and those that repeat none that does."""
        matched = self.base >= 0
        out = np.ones(self.size, bool)
        skip = ~self.is_chain
        for one, other in ((self.left[skip], self.right[skip]), (self.right[skip], self.left[skip])):
            out[one[matched[other]]] = False
        return out | matched

    def unary(self, field: Field, see_hint: np.ndarray, see_looks: np.ndarray) -> np.ndarray:
        rows = np.zeros((self.size, LABELS))
        for features, seen in ((self.looks, see_looks), (self.around, None)):
            if self.size:
                lengths = np.array([len(f) for f in features])
                total = np.add.reduceat(field.features[np.concatenate(features)], np.cumsum(lengths) - lengths, axis=0)
                rows += total if seen is None else total * seen[:, None]
        rows += field.hints[self.base + 1] * see_hint[:, None]
        rows += self.fixed_before[:, None] * field.chain[0] + self.fixed_after[:, None] * field.chain[:, 0]
        return rows

    def beliefs(self, unary: np.ndarray, field: Field, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Beliefs of the variables and of the links, by loopy propagation until it converges."""
        pair = np.where(self.is_chain[:, None, None], field.chain, field.skip)
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True)) if len(pair) else pair
        to_right = np.full((len(self.left), LABELS), 1 / LABELS)
        to_left = to_right.copy()

        def total() -> np.ndarray:
            logs = unary.copy()
            np.add.at(logs, self.right, np.log(to_right))
            np.add.at(logs, self.left, np.log(to_left))
            return logs

        def normal(logs: np.ndarray) -> np.ndarray:
            values = np.exp(logs - logs.max(axis=-1, keepdims=True))
            return values / values.sum(axis=-1, keepdims=True)

        def sweep(logs: np.ndarray, levels: list[np.ndarray], right: bool, step: float) -> None:
            """Send all messages of one direction in order; ``moved`` keeps the largest change of each link."""
            source, target = (self.left, self.right) if right else (self.right, self.left)
            own, back = (to_right, to_left) if right else (to_left, to_right)
            for links in levels:
                sent = normal(logs[source[links]] - np.log(back[links]))
                new = np.einsum("ei,eij->ej" if right else "ej,eij->ei", sent, pair[links])
                new = (1 - step) * own[links] + step * new / new.sum(axis=1, keepdims=True) + 1e-12
                np.add.at(logs, target[links], np.log(new) - np.log(own[links]))
                moved[links] = np.maximum(moved[links], np.abs(new - own[links]).max(axis=1))
                own[links] = new

        def of_documents(levels: list[np.ndarray]) -> list[np.ndarray]:
            return [links for level in levels if len(links := level[moving[self.owner[level]]])]

        number, forward, backward = 0, self.forward, self.backward
        while forward:
            step = 1.0 if number == 0 else 0.7 * 0.9 ** max(0, number - rounds)
            logs, moved = total(), np.zeros(len(self.left))
            sweep(logs, forward, True, step)
            sweep(logs, backward, False, step)
            number += 1
            moving = np.zeros(self.documents, bool)
            moving[self.owner[moved > TOLERANCE]] = True  # the others keep their messages from here on
            forward, backward = of_documents(forward), of_documents(backward)
        logs = total()
        ends = normal(logs[self.left] - np.log(to_left))[:, :, None] * normal(logs[self.right] - np.log(to_right))[:, None, :]
        links = ends * pair
        return normal(logs), links / links.sum(axis=(1, 2), keepdims=True) if len(links) else links


def fit_field(documents: list[list[dict]], parameters: FieldParameters) -> Field:
    """Fit by Adam: observed minus expected counts, expectations by the same propagation."""
    chance = np.random.default_rng(11)
    # Before any evidence, equal tokens favour equal labels.
    prior = Field(np.zeros((WEIGHTS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)), SKIP_PRIOR * np.eye(LABELS))
    field = Field(*(w.copy() for w in prior))
    graph = Graph(documents)
    if not graph.size:
        return field
    labels = np.eye(LABELS)[graph.base + 1]
    # A token that repeats personal data where no pattern matches is no example of either.
    known = graph.known()
    both = known[graph.left] & known[graph.right]
    observed = labels[graph.left][:, :, None] * labels[graph.right][:, None, :]
    lengths = [np.array([len(f) for f in features]) for features in (graph.looks, graph.around)]
    index = [np.concatenate(features) for features in (graph.looks, graph.around)]
    mean, square = [np.zeros_like(w) for w in field], [np.zeros_like(w) for w in field]
    for step in range(1, parameters.epochs + 1):
        see_hint = (chance.random(graph.size) < 0.5).astype(float)
        see_looks = (chance.random(graph.size) < 0.8).astype(float)
        beliefs, links = graph.beliefs(graph.unary(field, see_hint, see_looks), field, parameters.rounds)
        error, pairs = (labels - beliefs) * known[:, None], (observed - links) * both[:, None, None]
        slopes = [np.zeros_like(w) for w in field]
        np.add.at(slopes[0], index[0], np.repeat(error * see_looks[:, None], lengths[0], axis=0))
        np.add.at(slopes[0], index[1], np.repeat(error, lengths[1], axis=0))
        np.add.at(slopes[1], graph.base + 1, error * see_hint[:, None])
        slopes[1][0] = 0  # that no pattern matches is no evidence against personal data
        slopes[2] += pairs[graph.is_chain].sum(axis=0)
        slopes[2][0] += error[graph.fixed_before].sum(axis=0)
        slopes[2][:, 0] += error[graph.fixed_after].sum(axis=0)
        slopes[3] += pairs[~graph.is_chain].sum(axis=0)
        slopes[3] = (slopes[3] + slopes[3].T) / 2  # a skip link has no direction
        for w, before, slope, m, s in zip(field, prior, slopes, mean, square, strict=True):
            slope = slope / graph.size - parameters.penalty * (w - before)
            m += 0.1 * (slope - m)
            s += 0.01 * (slope * slope - s)
            w += parameters.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return field


def added_spans(documents: list[tuple[list[dict], list[dict]]], field: Field, parameters: FieldParameters) -> list[list[dict]]:
    """Spans of the field for each (base spans, tokens); touching base spans give way."""
    graph = Graph([tokens for _, tokens in documents])
    ones = np.ones(graph.size)
    beliefs, _ = graph.beliefs(graph.unary(field, ones, ones), field, parameters.rounds)
    best, sure = beliefs.argmax(axis=1).tolist(), beliefs.max(axis=1).tolist()
    out, at = [], 0
    for spans, tokens in documents:
        own: list[dict] = []
        free = None  # kind of the span that a joined token may extend
        for token in tokens:
            kind = best[at] - 1
            if kind >= 0 and sure[at] >= parameters.belief and token["base"] < 0:
                if token["joined"] and free == kind:
                    own[-1]["stop"] = token["stop"]
                else:
                    own.append({"kind": kind, "start": token["start"], "stop": token["stop"]})
                free = kind
            else:
                free = None
            at += 1
        out.append(own)
    return out


def _describe_batch(texts: list[str | None]) -> pa.Array:
    spans, tokens = [], []
    for text in texts:
        found, variables = describe(text or "")
        spans.append([dict(zip(("kind", "start", "stop"), s, strict=True)) for s in found])
        tokens.append(variables)
    return pa.StructArray.from_arrays(
        [pa.array(spans, pa.list_(SPAN)), pa.array(tokens, pa.list_(TOKEN_KIND))], ["spans", "tokens"]
    )


def personal_spans(
    df: DataFrame, parameters: FieldParameters = FieldParameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: doc_id, base and added, both arrays of (kind, start, stop)."""
    bound_batches(df.sparkSession)

    @F.arrow_udf(FOUND_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _describe_batch(batch.to_pylist())

    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), find(F.col(f"`{text}`")).alias("found"))
    described = settle(rows.select("doc_id", "found.*"), "variables")

    def fit(sample: list[dict]) -> Field:
        documents, left = [], parameters.sample_tokens
        for row in sample:
            documents.append(row["tokens"][:left])
            left -= len(documents[-1])
            if left <= 0:
                break
        return fit_field(documents, parameters)

    with_tokens = described.where("size(tokens) > 0 AND doc_id IS NOT NULL")
    # No single document fills the sample.
    sample = with_tokens.orderBy(F.xxhash64("doc_id"), "doc_id").limit(parameters.sample_documents)
    sample = sample.select("doc_id", F.slice("tokens", 1, parameters.document_tokens).alias("tokens"))
    shared = df.sparkSession.sparkContext.broadcast(tuple(pickle.loads(fit_in_task(sample, fit))))

    @F.arrow_udf("array<struct<kind: int, start: int, stop: int>>")
    def infer(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        field = Field(*shared.value)
        for spans, tokens in batches:
            documents = list(zip(spans.to_pylist(), tokens.to_pylist(), strict=True))
            yield pa.array(added_spans(documents, field, parameters), pa.list_(SPAN))

    return described.select("doc_id", F.col("spans").alias("base"), infer("spans", "tokens").alias("added"))


def digest_columns(spans: DataFrame) -> DataFrame:
    """doc_id, counts of the pattern kinds, digest of the pattern spans, and all spans as text."""
    names = "element_at(array({}), s.kind + 1)".format(", ".join(f"'{k}'" for k in KINDS))
    written = f"array_join(transform(array_sort({{}}), s -> concat_ws(':', {names}, s.start, s.stop)), ',')"
    return spans.selectExpr(
        "doc_id",
        *[f"CAST(size(filter(base, s -> s.kind = {i})) AS BIGINT) AS n_{kind}" for i, kind in enumerate(KINDS)],
        f"sha2({written.format('base')}, 256) AS base_sha256",
        f"{written.format('concat(base, added)')} AS spans",
        "CAST(size(added) AS BIGINT) AS n_added",
    )
