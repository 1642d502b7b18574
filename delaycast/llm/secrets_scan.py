"""Secret scan: fixed patterns, and a battery of randomness tests with false-discovery control.

Patterns find assignments, access keys and hexadecimal runs. Beside them every run of 20 or more
characters of the usual encodings is a candidate, with ``=`` only as padding at its end. Its encoding is
the smallest alphabet that holds all its characters; runs of letters of one case, or of digits, are
words and numbers and infer none. A run that no alphabet holds, as it mixes the signs of several, is cut
into the longest runs of letters and digits, and where there are none of each alphabet's. A
candidate then passes a battery against the hypothesis that its characters are random:

* chi-squared uniformity over the alphabet,
* a runs test of characters above and below the middle of the alphabet,
* the serial correlation of neighbouring characters,

combined by Fisher's method. The Benjamini-Hochberg procedure on these p-values, applied to each class of
lengths by itself, tells which candidates are structured and no secrets, so that among those put aside
few are random, however many structured runs a class has. Short
runs of ordinary text can look random, so each of the rest is also tested against the hypothesis that it
is text: the coincidences of equal characters (the chi-squared statistic in other units) have a mean and
a variance for any length, given the letter frequencies of the whole corpus. Where the alphabet is so
small that random strings have about the coincidences of text (hexadecimal, base32, base36), the runs
of letters and of digits tell: text seldom changes between a letter and a digit, and the changes of a run
are tested against the rate of the corpus, taken as ``CHANGE_RATE`` at least. A run counts by the better of
the two scores, with twice its p-value. The same procedure, again by classes of length, bounds the share of false discoveries, so the
weak tests of the many short runs cannot borrow from the strong ones of the few long runs.

One pass over the texts finds patterns, candidates and letter counts. Everything that is gathered is
26 letter counts, a count of changes, and two histograms of some hundred bins for each length class.

A null text counts as empty and has no spans. Rows do not interact beyond the statistics, so repeated
rows and null ids get the answer of their text. Positions are code points, ends are exclusive. Texts are
read whole, whatever their length. An empty table gives an empty result. Columns other than id and text
are not read, so their names may clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, settle

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

CANDIDATE_LEAST = 20
CANDIDATE = re.compile("[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
PARTS = [re.compile(f"[A-Za-z0-9{signs}]{{20,}}") for signs in ("", "+/", "_-")]
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets from the smallest to the largest, in the order of their codes.
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
CODES = {name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ALPHABETS.items()}
ALPHABET_SETS = {name: frozenset(alphabet) for name, alphabet in ALPHABETS.items()}
WORD_SETS = (frozenset(LOWER), frozenset(UPPER), frozenset(DIGITS))
# Lower ends of the length classes, and the resolution of the histogram of text scores.
LENGTH_CLASSES = (20, 24, 32, 48, 96)
BINS_PER_UNIT, BINS = 10, 400
# Bins of the battery's p-values: tenths of their decimal logarithm.
P_BINS = 300
# Least rate of changes between a letter and a digit that text is taken to have, by characters.
CHANGE_RATE = 0.02
DIGIT_AFTER, DIGIT_BEFORE = re.compile("(?<=[A-Za-z])[0-9]"), re.compile("[0-9](?=[A-Za-z])")

SCAN_TYPE = (
    "struct<spans: array<struct<start: int, kind: int, stop: int>>,"
    " tests: array<struct<start: int, stop: int, length: int, coincidences: double, changes: int, randomness: double>>,"
    " letters: array<bigint>>"
)


class SecretParameters(NamedTuple):
    """``rejection``: share of random strings among those the battery puts aside; ``discovery``: share of false finds."""

    rejection: float = 0.001
    discovery: float = 0.05


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_tail(x: float, freedom: int) -> float:
    """Upper tail by the cube-root approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * freedom)
    return normal_tail(((x / freedom) ** (1 / 3) - 1 + spread) / math.sqrt(spread))


def infer_encoding(run: str) -> str | None:
    """The smallest alphabet with all characters of the run, padding aside; None for words and numbers."""
    used = set(run.rstrip("="))
    if not used or any(used <= words for words in WORD_SETS):
        return None
    return next((name for name, alphabet in ALPHABET_SETS.items() if used <= alphabet), None)


def coincidences(run: str) -> int:
    """Pairs of equal characters."""
    return sum(n * (n - 1) // 2 for n in (run.count(c) for c in set(run)))


def changes(run: str) -> int:
    """Letters next to a digit, by pairs."""
    return len(DIGIT_AFTER.findall(run)) + len(DIGIT_BEFORE.findall(run))


def uniformity(values: list[int], size: int) -> float:
    """p-value of the chi-squared test that all ``size`` symbols are equally likely."""
    n = len(values)
    squares = sum(values.count(v) ** 2 for v in set(values))
    return chi_squared_tail(size * squares / n - n, size - 1)


def runs(values: list[int], size: int) -> float:
    """p-value of the runs test of symbols in the upper and the lower half of the alphabet."""
    high = [2 * v >= size for v in values]
    above, n = sum(high), len(values)
    below = n - above
    if not above or not below:
        return 2.0 ** (1 - n)
    seen = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 1 + 2 * above * below / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 2 * normal_tail(abs(seen - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_correlation(values: list[int]) -> float:
    """p-value of the correlation of each symbol with the next, around a ring."""
    n, total = len(values), sum(values)
    squares = sum(v * v for v in values)
    spread = n * squares - total * total
    if not spread:
        return 0.0
    products = sum(a * b for a, b in zip(values, values[1:], strict=False)) + values[-1] * values[0]
    found = (n * products - total * total) / spread
    return 2 * normal_tail(abs(found + 1 / (n - 1)) * math.sqrt(n))


def randomness(run: str, encoding: str) -> float:
    """Combined p-value of the battery, by Fisher's method."""
    values = [CODES[encoding][c] for c in run.rstrip("=")]
    size = len(ALPHABETS[encoding])
    parts = (uniformity(values, size), runs(values, size), serial_correlation(values))
    x = -sum(math.log(max(p, 1e-300)) for p in parts)  # half of Fisher's statistic
    return math.exp(-x) * (1 + x + x * x / 2)


def base_spans(text: str, words: list[tuple[int, str]]) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the fixed patterns; ``words``: the parts without white space of 20 characters on."""
    out = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    for at, word in words:
        if "AKIA" in word:
            out += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(word) if len(m[0]) >= ACCESS_LEAST]
        if len(word) >= HEX_LEAST:
            out += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(word) if len(m[0]) >= HEX_LEAST]
    out.sort()
    return out


def long_words(text: str, least: int) -> list[tuple[int, str]]:
    """(start, word) of the parts between white space that have ``least`` characters or more."""
    out, at = [], 0
    for word in text.split():
        if len(word) >= least:
            at = text.index(word, at)
            out.append((at, word))
            at += len(word)
    return out


def candidates(word: str) -> Iterator[tuple[int, str, str]]:
    """(start, run, encoding) of the runs of a word that may be encoded."""
    for m in CANDIDATE.finditer(word):
        encoding = infer_encoding(m[0])
        if encoding:
            yield m.start(), m[0], encoding
        elif not {"+", "/"}.isdisjoint(m[0]) and not {"_", "-"}.isdisjoint(m[0]):
            taken: list[tuple[int, int]] = []
            for pattern in PARTS:
                for part in pattern.finditer(m[0]):
                    apart = all(part.end() <= a or b <= part.start() for a, b in taken)
                    if apart and (encoding := infer_encoding(part[0])):
                        taken.append(part.span())
                        yield m.start() + part.start(), part[0], encoding


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float, int, float]]]:
    """The base spans of a text, and its candidates with the figures of their tests."""
    words = long_words(text, CANDIDATE_LEAST)
    tests = []
    for at, word in words:
        for start, found, encoding in candidates(word):
            if len(run := found.rstrip("=")) >= CANDIDATE_LEAST:
                figures = float(coincidences(run)), changes(run), randomness(found, encoding)
                tests.append((at + start, at + start + len(found), len(run), *figures))
    return base_spans(text, words), tests


def _scan_batch(texts: list[str | None]) -> pa.Array:
    spans, tests = [], []
    letters = [0] * 27  # and the changes between letters and digits
    for text in texts:
        found, tested = scan(text or "")
        spans.append([dict(zip(("start", "kind", "stop"), s, strict=True)) for s in found])
        names = ("start", "stop", "length", "coincidences", "changes", "randomness")
        tests.append([dict(zip(names, t, strict=True)) for t in tested])
        raw = (text or "").encode().lower()
        for i in range(26):
            letters[i] += raw.count(97 + i)
        letters[26] += changes(text or "")
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])
    test = pa.struct(
        [("start", pa.int32()), ("stop", pa.int32()), ("length", pa.int32()), ("coincidences", pa.float64())]
        + [("changes", pa.int32()), ("randomness", pa.float64())]
    )
    # The letters of a whole batch stand in its first row.
    counts = [letters, *[None] * (len(texts) - 1)] if texts else []
    return pa.StructArray.from_arrays(
        [pa.array(spans, pa.list_(span)), pa.array(tests, pa.list_(test)), pa.array(counts, pa.list_(pa.int64()))],
        ["spans", "tests", "letters"],
    )


def letter_moments(scanned: DataFrame) -> tuple[float, float, float]:
    """Sums of the squares and of the cubes of the corpus's letter frequencies; changes to or from a digit by letter."""
    counts = scanned.select(F.posexplode("found.letters").alias("letter", "n")).groupBy("letter").agg(F.sum("n").alias("n"))
    found = {r.letter: r.n for r in counts.collect()}  # at most 27
    changed = found.pop(26, 0)
    total = max(1, sum(found.values()))
    return sum((n / total) ** 2 for n in found.values()), sum((n / total) ** 3 for n in found.values()), changed / total


def text_score(length: str, found: str, second: float, third: float) -> str:
    """SQL: by how many deviations a run has fewer coincidences than text of its length would."""
    pairs, triples = f"({length} * ({length} - 1) / 2)", f"({length} * ({length} - 1) * ({length} - 2) / 6)"
    variance = f"({pairs} * {second - second**2!r}D + 6 * {triples} * {max(0.0, third - second**2)!r}D)"
    return f"(({pairs} * {second!r}D - {found}) / sqrt(greatest({variance}, 1e-9D)))"


def change_score(length: str, found: str, rate: float) -> str:
    """SQL: deviations by which a run has more changes than text; the root evens out the variance of rare events."""
    return f"(2 * (sqrt({found}) - sqrt({length} * {max(rate, CHANGE_RATE)!r}D)))"


def length_class(length: str) -> str:
    return "(" + " + ".join(f"int({length} >= {least})" for least in LENGTH_CLASSES) + " - 1)"


def lowest_bin(counts: dict[int, int], share: float, largest_p: Callable[[int], float]) -> int | None:
    """The lowest bin whose tests are discoveries by Benjamini and Hochberg; None if there is none.

    ``counts``: tests by bin, higher bins with smaller p-values. A bin counts by its largest p-value,
    so binning never adds discoveries.
    """
    total, above, lowest = sum(counts.values()), 0, None
    for number in sorted(counts, reverse=True):
        above += counts[number]
        if largest_p(number) <= share * above / total:
            lowest = number
    return lowest


def discovery_threshold(counts: dict[int, int], share: float) -> float:
    """The lowest text score that counts as a discovery; ``counts``: tests by bin of the score."""
    lowest = lowest_bin(counts, share, lambda number: normal_tail(number / BINS_PER_UNIT))
    return math.inf if lowest is None else lowest / BINS_PER_UNIT


def by_class(rows: DataFrame) -> dict[int, dict[int, int]]:
    """Tests by length class and bin; as many rows as there are classes and bins at most."""
    histogram: dict[int, dict[int, int]] = {}
    for row in rows.groupBy("class", "bin").agg(F.count("*").alias("n")).collect():
        histogram.setdefault(row["class"], {})[row["bin"]] = row["n"]
    return histogram


def bound_of_class(length: str, bounds: dict[int, float]) -> str:
    """SQL: the bound of a length's class, null where it has none."""
    cases = " ".join(f"WHEN {k} THEN {v!r}D" for k, v in bounds.items())
    return f"CASE {length_class(length)} {cases} END" if cases else "CAST(NULL AS DOUBLE)"


def secret_spans(
    df: DataFrame, parameters: SecretParameters = SecretParameters(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``df``: doc_id and ``spans``, an array of (start, kind, stop) in that order.

    Kinds are numbered as in KINDS. Random finds that overlap a pattern's span are left out.
    """
    bound_batches(df.sparkSession)

    @F.arrow_udf(SCAN_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _scan_batch(batch.to_pylist())

    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), find(F.col(f"`{text}`")).alias("found"))
    scanned = settle(rows, "secrets")
    second, third, rate = letter_moments(scanned)
    score = text_score("t.length", "t.coincidences", second, third)
    score = f"greatest({score}, {change_score('t.length', 't.changes', rate)})"
    tests = scanned.select(F.explode("found.tests").alias("t"))
    p_bin = f"int(least({P_BINS}D, floor(-10 * log10(greatest(t.randomness, 1e-30D)))))"
    surprises = by_class(tests.selectExpr(f"{length_class('t.length')} AS class", f"{p_bin} AS bin"))
    put_aside = {k: lowest_bin(v, parameters.rejection, lambda number: 10.0 ** (-number / 10)) for k, v in surprises.items()}
    structured = bound_of_class("t.length", {k: float(v) for k, v in put_aside.items() if v is not None})
    passed = f"NOT coalesce({p_bin} >= {structured}, false)"
    scores = tests.selectExpr(
        f"{length_class('t.length')} AS class",
        f"CASE WHEN {passed} THEN int(floor(greatest(-1D, least({BINS}D, {score} * {BINS_PER_UNIT})))) ELSE -1 END AS bin",
    )
    # The better of two scores: twice the p-value, or half the share.
    lowest = {k: discovery_threshold(v, parameters.discovery / 2) for k, v in by_class(scores).items()}
    bound = bound_of_class("t.length", {k: v for k, v in lowest.items() if v < math.inf})
    apart = "NOT exists(found.spans, s -> s.start < t.stop AND t.start < s.stop)"
    binned = f"floor(least({BINS}D, {score} * {BINS_PER_UNIT})) / {BINS_PER_UNIT}"
    random = (
        f"transform(filter(found.tests, t -> {passed} AND coalesce({binned} >= {bound}, false) AND {apart}),"
        " t -> named_struct('start', t.start, 'kind', 3, 'stop', t.stop))"
    )
    return scanned.selectExpr("doc_id", f"array_sort(concat(found.spans, {random})) AS spans")


def digest_columns(spans: DataFrame) -> DataFrame:
    """doc_id, counts of the pattern kinds, digest of the pattern spans, and all spans as text."""
    names = "element_at(array({}), s.kind + 1)".format(", ".join(f"'{k}'" for k in KINDS))
    written = f"array_join(transform({{}}, s -> concat_ws(':', {names}, s.start, s.stop)), ',')"
    return spans.selectExpr(
        "doc_id",
        *[f"CAST(size(filter(spans, s -> s.kind = {i})) AS BIGINT) AS n_{kind}" for i, kind in enumerate(KINDS[:3])],
        f"sha2({written.format('filter(spans, s -> s.kind < 3)')}, 256) AS base_sha256",
        f"{written.format('spans')} AS spans",
        "CAST(size(filter(spans, s -> s.kind = 3)) AS BIGINT) AS n_random",
    )
