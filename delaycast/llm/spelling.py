"""Spelling variants by finite-state composition: the vocabulary, one edit, the vocabulary again.

The minimised acceptor of the vocabulary is composed with a transducer that copies, edits once, and
copies on, and with the acceptor again. Until the edit both copies of the acceptor are in one
state; after it a pair of states accepts what the right languages of both have in common. That
common language is built once for a pair of states, as a state of the same minimised machine.

Partitions: a pair is found where its edit lies. Two words of m letters, or one of m and one of
m - 1, agree outside any stretch of positions that holds the edit. So every word goes to the first
and the second half of the positions of m, keyed by m and by what lies outside; a key is an initial
state of the machine, and a task composes the machine from its own initial states. Each edit has
one place (of equal letters in a row, the first is the one inserted), so each pair is accepted
once, whatever the partitions are. Keys with more than ``largest_group`` words are split: their
stretch is halved again and again, down to one position, where a key holds no more words than the
alphabet has letters. Nothing is dropped, and no task gathers more than that many words of a key.

Rows: null texts have no words; a null id is written as an empty text. Repeated rows count as often
as they occur. Of near words with equal counts the smallest in code-point order is the form. Empty
tables give empty results. Texts and words of any length are read whole; the walks through the
machine keep their own stack. Columns other than id and text are not read, so their names may clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import bound_batches, settle

RUN = "A-Za-zÀ-ÿ"
LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
# Distinct words and letters of a task's tally before it is handed on.
TALLY_WORDS, TALLY_LETTERS = 300_000, 24 << 20
# States of a worker's machine before a new one is begun, and rows of an output batch.
MACHINE_STATES, OUT_ROWS = 150_000, 20_000

NEAR_TYPE = "word string, near string, near_n bigint"


@dataclass(frozen=True)
class SpellingParameters:
    """Words have ``min_length`` letters and occur ``min_count`` times; a form is ``factor`` times as frequent."""

    min_length: int = 5
    min_count: int = 3
    factor: int = 2
    largest_group: int = 4096


def _tallies(words: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"]
    )


def count_words(documents: DataFrame, parameters: SpellingParameters, slip: int | None = None) -> DataFrame:
    """(word, n) of the lower-cased letter runs of ``text``, with the parameters' least length and count.

    With ``slip``, a run loses one letter where the checksum h of ``<doc_id>:<run>`` is divisible
    by ``slip``: the one at h modulo its length. Tasks hand on tallies of bounded size.
    """
    least = parameters.min_length
    bound_batches(documents.sparkSession)
    runs = re.compile(f"[{RUN}]{{{least},}}")  # shorter runs never count

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = Counter(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(runs.findall(text.as_py()))
                if not found:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                lowered = Counter()
                for run, n in found.items():
                    lowered[run.lower() if run.isascii() else run.translate(LOWER)] += n
                for word, n in lowered.items():
                    if slip and (h := zlib.crc32(word.encode(), start)) % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    if word not in held:
                        letters += len(word)
                    held[word] += n
                if len(held) >= TALLY_WORDS or letters >= TALLY_LETTERS:
                    yield _tallies(held)
                    held, letters = Counter(), 0
        if held:
            yield _tallies(held)

    source = documents.select("doc_id", "text").where("text IS NOT NULL")
    tallies = source.mapInArrow(tally, "word string, n bigint")
    return tallies.groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {parameters.min_count}")


class Machine:
    """Minimised acyclic acceptors that share their states; state 0 accepts the end of a word."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.register: dict[tuple, int] = {(): 0}
        self.common: dict[tuple[int, int], int] = {}

    def state(self, arcs: dict[str, int]) -> int:
        signature = tuple(arcs.items())
        found = self.register.get(signature)
        if found is None:
            found = self.register[signature] = len(self.arcs)
            self.arcs.append(arcs)
        return found

    def accept(self, words: list[str]) -> int:
        """The initial state of the minimised acceptor of sorted, distinct words of one length."""
        open_states: list[dict[str, int]] = [{}]
        last = ""
        for word in words:
            same = 0
            for one, other in zip(last, word):
                if one != other:
                    break
                same += 1
            self._close(open_states, same, last)
            open_states.extend({} for _ in range(len(word) - same))
            last = word
        self._close(open_states, 0, last)
        return self.state(open_states[0])

    def _close(self, open_states: list[dict[str, int]], depth: int, word: str) -> None:
        for at in range(len(open_states) - 1, depth, -1):
            done = self.state(open_states.pop())
            open_states[-1][word[at - 1]] = done

    def meet(self, p: int, q: int) -> int:
        """The state that accepts what ``p`` and ``q`` both accept; -1 if that is nothing."""
        if p == q:
            return p
        arcs, common = self.arcs, self.common
        top = (p, q) if p < q else (q, p)
        if top in common:
            return common[top]
        frames = [(top, iter(sorted(arcs[p].keys() & arcs[q].keys())), {})]
        while frames:
            pair, letters, built = frames[-1]
            for letter in letters:
                one, other = arcs[pair[0]][letter], arcs[pair[1]][letter]
                if one == other:
                    built[letter] = one
                    continue
                below = (one, other) if one < other else (other, one)
                found = common.get(below)
                if found is None:
                    shared = arcs[one].keys() & arcs[other].keys()
                    if shared:
                        frames.append((below, iter(sorted(shared)), {}))
                        # The letter is read again when the pair below is known.
                        frames[-2] = (pair, _again(letter, letters), built)
                        break
                    common[below] = found = -1
                if found >= 0:
                    built[letter] = found
            else:
                common[pair] = self.state(built) if built else -1
                frames.pop()
        return common[top]

    def words(self, state: int) -> Iterator[str]:
        """All words that a state accepts."""
        path: list[str] = []
        frames = [iter(self.arcs[state].items())]
        if state == 0:
            yield ""
        while frames:
            for letter, target in frames[-1]:
                path.append(letter)
                if target == 0:
                    yield "".join(path)
                    path.pop()
                    continue
                frames.append(iter(self.arcs[target].items()))
                break
            else:
                frames.pop()
                if path:
                    path.pop()

    def one_edit(self, longer: int, shorter: int, before: str) -> Iterator[tuple[str, str, bool]]:
        """Accepted pairs of the composition from one initial state, each once, with the kind of edit.

        Yields (word, word, True) for a replaced letter, both accepted from ``longer``, and (word,
        word less one letter, False), the second accepted from ``shorter``. ``before`` is the letter
        before the initial state: of equal letters in a row the first counts as the inserted one.
        """
        arcs, meet = self.arcs, self.meet
        path = [before]
        frames: list[tuple[int, Iterator[tuple[str, int]]]] = []
        state, other = longer, shorter
        while True:
            mine = list(arcs[state].items())
            for at, (a, to_a) in enumerate(mine):
                for b, to_b in mine[:at]:
                    both = meet(to_a, to_b)
                    if both >= 0:
                        start = "".join(path[1:])
                        for rest in self.words(both):
                            yield start + a + rest, start + b + rest, True
                if other >= 0 and a != path[-1]:
                    both = meet(to_a, other)
                    if both >= 0:
                        start = "".join(path[1:])
                        for rest in self.words(both):
                            yield start + a + rest, start + rest, False
            frames.append((other, iter(mine)))
            while frames:
                other, letters = frames[-1]
                step = next(letters, None)
                if step is not None:
                    break
                frames.pop()
                path.pop()
            else:
                return
            path.append(step[0])
            state = step[1]
            other = -1 if other < 0 else arcs[other].get(step[0], -1)


def _again(letter: str, letters: Iterator[str]) -> Iterator[str]:
    yield letter
    yield from letters


def _near_in_group(machine: Machine, group: list[tuple], out: list[list]) -> None:
    """Append both directions of all near pairs of the words that share one key."""
    length, start, end = group[0][0], group[0][1], group[0][2]
    outer: dict[tuple[str, str], tuple[dict[str, int], dict[str, int]]] = {}
    for _, _, _, word, n in group:
        short = len(word) < length
        tail = end - 1 if short else end
        inside = outer.setdefault((word[:start], word[tail:]), ({}, {}))
        inside[short][word[start:tail]] = n
    for (head, rest), (longer, shorter) in outer.items():
        if not longer or len(longer) + len(shorter) < 2:
            continue
        whole = machine.accept(sorted(longer))
        less = machine.accept(sorted(shorter)) if shorter else -1
        for one, other, replaced in machine.one_edit(whole, less, head[-1:]):
            counts = longer if replaced else shorter
            one_word, other_word = head + one + rest, head + other + rest
            for column, values in zip(out, ((one_word, other_word), (other_word, one_word), (counts[other], longer[one]))):
                column.extend(values)


def _near_batch(out: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["word", "near", "near_n"])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows (key, m, a, b, word, n) that come sorted by key."""
    machine, out = Machine(), [[], [], []]
    key, group = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[0] != key:
                if len(group) > 1:
                    yield from _handle(machine, group, out)
                    if len(machine.arcs) + len(machine.common) > MACHINE_STATES:
                        machine = Machine()
                key, group = row[0], []
            group.append(row[1:])
    if len(group) > 1:
        yield from _handle(machine, group, out)
    if out[0]:
        yield _near_batch(out)


def _handle(machine: Machine, group: list[tuple], out: list[list]) -> Iterator[pa.RecordBatch]:
    stretches: dict[tuple, list[tuple]] = {}
    for row in group:  # one, unless two keys have one hash
        stretches.setdefault(row[:3], []).append(row)
    for rows in stretches.values():
        _near_in_group(machine, rows, out)
        if len(out[0]) >= OUT_ROWS:
            yield _near_batch(out)
            for column in out:
                column.clear()


def _halved(frame: DataFrame, *stretches: tuple[str, str, str]) -> DataFrame:
    """Rows (key, m, a, b, word, n): each word in both halves [a, b) of stretches of m positions given as SQL."""
    halves = []
    for m, a, b in stretches:
        middle = f"shiftright({a} + {b}, 1)"
        halves += [f"struct({m} AS m, {a} AS a, {middle} AS b)", f"struct({m} AS m, {middle} AS a, {b} AS b)"]
    placed = frame.selectExpr("word", "n", f"inline(array({', '.join(halves)}))").where("b > a")
    outside = "substr(word, 1, a), substr(word, IF(char_length(word) < m, b, b + 1))"
    return placed.selectExpr(f"xxhash64(m, a, b, {outside}) AS key", "m", "a", "b", "word", "n")


def near_words(vocabulary: DataFrame, largest_group: int) -> DataFrame:
    """(word, near, near_n): both directions of all pairs of words exactly one edit apart.

    ``vocabulary`` holds distinct words with their counts ``n``. The keys that hold too many words
    are known from counts that were summed before they met, and are split before anything meets.
    """

    length = "char_length(word)"
    rows = _halved(vocabulary, (length, "0", length), (f"{length} + 1", "0", f"{length} + 1"))
    found = None
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.expr("b - a")).alias("stretch"))
        sizes = settle(sizes.where("size > 1"), "spelling-keys")
        large = f"size > {largest_group} AND stretch > 1"
        cold = rows.join(sizes.where(f"NOT ({large})").select("key"), "key")
        cold = cold.repartition(F.col("key")).sortWithinPartitions("key")
        pairs = cold.select("key", "m", "a", "b", "word", "n").mapInArrow(_compose, NEAR_TYPE)
        found = pairs if found is None else found.unionByName(pairs)
        if sizes.where(large).isEmpty():
            return found
        hot = rows.join(sizes.where(large).select("key"), "key")
        hot = settle(hot.selectExpr("word", "n", "m AS m0", "a AS a0", "b AS b0"), "spelling-hot")
        rows = _halved(hot, ("m0", "a0", "b0"))


def spelling_groups(words: DataFrame, parameters: SpellingParameters = SpellingParameters()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct ``word`` with its count ``n``.

    ``form`` is the near word of the largest count if that is ``factor`` times the word's own, and
    ``root`` where the forms lead in the end. Counts grow along forms, so forms never lead back and
    doubling the steps ends after a few joins.
    """
    vocabulary = settle(words.select("word", "n"), "vocabulary")
    near = near_words(vocabulary, parameters.largest_group)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    joined = vocabulary.join(best, "word", "left")
    frequent = F.col("best.less") <= -parameters.factor * F.col("n")
    forms = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    forms = settle(forms, "forms")
    roots = settle(_roots(forms.where("form IS NOT NULL").selectExpr("word", "form AS at")), "roots")
    followed = forms.join(roots.selectExpr("word", "at AS root"), "word", "left")
    return followed.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """(word, at): where following the steps (word, at) ends, by doubling them until none leads on."""
    while True:
        steps = settle(steps, "steps")
        further = steps.selectExpr("word AS at", "at AS beyond")
        ahead = settle(steps.join(further, "at", "left").select("word", "at", "beyond"), "ahead")
        if ahead.where("beyond IS NOT NULL").isEmpty():
            return steps
        steps = ahead.selectExpr("word", "coalesce(beyond, at) AS at")


def oracle(parameters: SpellingParameters, slip: int) -> str:
    """SQL for the registered query: checksums by a table made of its rule, edits by equal remainders."""
    return f"""
WITH RECURSIVE bytes AS (
    SELECT list(c ORDER BY i) AS crc FROM (
        SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
        FROM range(256) t(i)
    )
), runs AS (
    SELECT doc_id, lower_ascii AS run, count(*) AS k
    FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{RUN}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
        FROM documents
    ) WHERE length(lower_ascii) >= {parameters.min_length} GROUP BY ALL
), coded AS (
    SELECT *, hex(encode(concat(doc_id, ':', run))) AS code FROM runs
), summed AS (
    SELECT run, k, xor(4294967295, list_reduce(
        [4294967295] || list_transform(range(length(code) // 2), lambda i: CAST(concat('0x', substr(code, CAST(2 * i + 1 AS INT), 2)) AS BIGINT)),
        lambda c, b: xor(c // 256, crc[CAST(xor(c % 256, b) + 1 AS INT)])
    )) AS h FROM coded, bytes
), slipped AS (
    SELECT k, CASE WHEN h % {slip} = 0
        THEN concat(substr(run, 1, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) + 2 AS INT))) ELSE run END AS word
    FROM summed
), words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slipped
    WHERE length(word) >= {parameters.min_length} GROUP BY word HAVING sum(k) >= {parameters.min_count}
), less AS (
    SELECT word, n, i, concat(substr(word, 1, CAST(i AS INT)), substr(word, CAST(i + 2 AS INT))) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
    UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word
), forms AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN most >= {parameters.factor} * words.n THEN most END AS form_n,
        CASE WHEN most >= {parameters.factor} * words.n
            THEN (SELECT min(other) FROM near WHERE near.word = words.word AND other_n = most) END AS form
    FROM words LEFT JOIN best USING (word)
), walk AS (
    SELECT word, coalesce(form, word) AS at, form IS NOT NULL AS more FROM forms
    UNION ALL
    SELECT walk.word, f.form, true FROM walk JOIN forms f ON walk.at = f.word WHERE walk.more AND f.form IS NOT NULL
)
SELECT f.word, f.form, f.n, f.n_near, f.form_n, w.at AS root
FROM forms f JOIN walk w USING (word) LEFT JOIN forms g ON w.at = g.word
WHERE g.form IS NULL OR NOT w.more
"""
