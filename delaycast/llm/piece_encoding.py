"""SentencePiece BPE encoding by a prefix table, and decoding.

Merging pairs by score gives every prefix of a word exactly one last token, and the tokens before
it are the encoding of the shorter prefix. So one table, a last token for each prefix, replaces the
merge queue: an Aho-Corasick automaton yields the tokens that end at a position, and the one that
is compatible with the last token before it is the entry. Reading the table from the end gives the
ids. Two tokens are compatible if merging their characters side by side yields those two again;
undoing their merges from the latest to the earliest tells, and is remembered.

Rows: a null text counts as empty; an empty text encodes to the begin and end ids alone. Ids,
repeated rows and further columns do not matter: every row is encoded by itself. Characters that
the vocabulary lacks become byte ids, which no merge crosses.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import Memo, bound_batches, fresh_name

SPACE = "▁"
UNEVEN = re.compile(f"  | \n|{SPACE}")
UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
# Entries of the two memos of a worker, and the longest unit that is worth an entry.
UNIT_MEMO, PAIR_MEMO, MEMO_CHARS = 200_000, 300_000, 48

DIGEST_TYPE = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"
IDS_TYPE = "array<int>"


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback and an identity normaliser."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        parsed = proto.ModelProto()
        parsed.ParseFromString(model)
        spec = parsed.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.escape_whitespaces and not spec.remove_extra_whitespaces
        if not (plain and parsed.trainer_spec.byte_fallback and spec.add_dummy_prefix):
            raise ValueError("only models with identity normalisation, dummy prefix and byte fallback")
        kinds = type(parsed.pieces[0])
        self.pieces = [p.piece for p in parsed.pieces]
        # Merge order: the better score first.
        self.order = [-p.score for p in parsed.pieces]
        self.ids = {p.piece: i for i, p in enumerate(parsed.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(parsed.pieces) if p.type == kinds.BYTE}
        self.control = {i for i, p in enumerate(parsed.pieces) if p.type == kinds.CONTROL}
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        if "\n" in self.ids or any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece spans a word boundary")


class Encoder:
    """Encodes and decodes with one vocabulary; keeps its memos as long as the worker lives."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = self.vocabulary = vocabulary
        self.parts: list[tuple[int, int] | None] = [None] * len(v.pieces)
        self.length = [len(p) for p in v.pieces]
        self.automaton = ahocorasick.Automaton()
        for piece, token in sorted(v.ids.items(), key=lambda x: len(x[0])):
            if len(piece) == 1:
                self.automaton.add_word(piece, token)
            elif piece.strip(SPACE) and self._last_merge(piece, token):
                self.automaton.add_word(piece, token)
        self.automaton.make_automaton()
        self.compatible = Memo(self._compatible, PAIR_MEMO)
        self.plain = Memo(self._plain_bytes, UNIT_MEMO, MEMO_CHARS)
        self.units = Memo(self._unit_bytes, UNIT_MEMO // 10, MEMO_CHARS)
        self.first, self.final = struct.pack("<I", v.begin), struct.pack("<I", v.end)
        self.surface = [p.replace(SPACE, " ").encode() for p in v.pieces]
        for value, token in v.bytes.items():
            self.surface[token] = bytes([value])
        for token in v.control:
            self.surface[token] = b""
        self.byte_tokens = set(v.bytes.values())

    def _last_merge(self, piece: str, token: int) -> bool:
        """Record which two tokens merge last into ``token``; false if merging never reaches it."""
        v = self.vocabulary
        row = [v.ids.get(c, -1) for c in piece]
        while len(row) > 1:
            merges = [
                (v.order[m], at, m)
                for at in range(len(row) - 1)
                if row[at] >= 0 and row[at + 1] >= 0
                if (m := v.ids.get(v.pieces[row[at]] + v.pieces[row[at + 1]])) is not None
            ]
            if not merges:
                return False
            _, at, merged = min(merges)
            if len(row) == 2 and merged == token:
                self.parts[token] = (row[0], row[1])
                return True
            row[at : at + 2] = [merged]
        return False

    def _compatible(self, pair: int) -> bool:
        """Whether no merge across the seam of the two tokens comes before both are complete.

        Going back in time, the later of the two is taken apart, and a merge across the seam must
        not have been due before it was made. Equal merges happen from left to right, so the left
        one of two equal tokens was made first.
        """
        v, parts = self.vocabulary, self.parts
        left, right = pair >> 20, pair & 0xFFFFF
        due, also_when_equal = float("inf"), False
        while True:
            across = v.ids.get(v.pieces[left] + v.pieces[right])
            if across is not None:
                at = v.order[across]
                if at < due or (also_when_equal and at == due):
                    return False
            inner, outer = parts[left], parts[right]
            if inner is None and outer is None:
                return True
            if outer is None or (inner is not None and v.order[left] > v.order[right]):
                due, also_when_equal, left = v.order[left], False, inner[1]
            else:
                due, also_when_equal, right = v.order[right], True, outer[0]

    def _word(self, word: str) -> list[int]:
        """Ids of a word with at most one leading space mark, by the prefix table."""
        size, length, compatible = len(word), self.length, self.compatible
        last = [-1] * (size + 1)
        reached = 0
        for at, token in self.automaton.iter(word):
            at += 1
            while reached < at - 1:  # characters that no piece covers
                reached += 1
                if last[reached] < 0:
                    last[reached] = -2
            if last[at] >= 0:
                continue
            before = last[at - length[token]]
            if before < 0 or compatible[before << 20 | token]:
                last[at] = token
                reached = at
        out: list[int] = []
        at = size
        while at:
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= length[token]
            else:
                at -= 1
                out.extend(self.vocabulary.bytes[b] for b in reversed(word[at].encode()))
        out.reverse()
        return out

    def _spaces(self, count: int) -> list[int]:
        """Ids of a run of space marks: equal scores, so the leftmost pair merges first."""
        ids, rest = self.vocabulary.ids, count
        done: list[int] = []  # what lies left of the next pair; no two neighbours in it can merge
        while True:
            if len(done) >= 2 and SPACE * (done[-2] + done[-1]) in ids:
                done[-2:] = [done[-2] + done[-1]]
            elif rest:
                done.append(1)
                rest -= 1
            else:
                break
        return [ids[SPACE * n] for n in done]

    def _unit(self, unit: str) -> list[int]:
        word = unit.lstrip(SPACE)
        marks = len(unit) - len(word)
        if not word:
            return self._spaces(marks)
        if word == "\n":
            return [self.vocabulary.bytes[10]]
        if marks <= 1:
            return self._word(unit)
        ids = self._word(SPACE + word)
        if ids[0] == self.vocabulary.ids[SPACE]:
            return self._spaces(marks) + ids[1:]
        return self._spaces(marks - 1) + ids

    def _unit_bytes(self, unit: str) -> bytes:
        ids = self._unit(unit)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain_bytes(self, word: str) -> bytes:
        """As ``_unit_bytes`` for a word after a single space, or after a newline that it starts with."""
        if word[0] == "\n":
            ids = [self.vocabulary.bytes[10], *self._word(word[1:])]
        else:
            ids = self._word(SPACE + word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        out = [self.first]
        if text:
            if text[0] in " \n" or text[-1] == " " or UNEVEN.search(text):
                out += map(self.units.__getitem__, UNITS.findall(SPACE + text.replace(" ", SPACE)))
            else:
                out += map(self.plain.__getitem__, text.replace("\n", " \n").split(" "))
        out.append(self.final)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids vanish, byte runs join, the dummy space goes."""
        text = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if i not in self.vocabulary.control), None)
        if text[:1] == b" " and first not in self.byte_tokens:
            text = text[1:]
        try:
            return text.decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids)

    def _decode_broken(self, ids: list[int]) -> str:
        """As ``decode`` for byte runs that are no UTF-8: each byte in error becomes U+FFFD."""
        out, run, first = [], b"", True
        for token in [*ids, -1]:
            if token in self.byte_tokens:
                run += self.surface[token]
                first = False
                continue
            while run:
                size = 1 if run[0] < 0x80 else 2 if run[0] < 0xE0 else 3 if run[0] < 0xF0 else 4
                try:
                    out.append(run[:size].decode())
                    run = run[size:]
                except UnicodeDecodeError:
                    out.append("�")
                    run = run[1:]
            if token >= 0 and self.surface[token]:
                piece = self.surface[token].decode()
                out.append(piece[1:] if first and piece[0] == " " else piece)
                first = False
        return "".join(out)


_encoders: dict[str, Encoder] = {}


def worker_encoder(key: str, model: bytes) -> Encoder:
    """This worker's encoder for a model, built once."""
    if key not in _encoders:
        _encoders[key] = Encoder(Vocabulary(model))
    return _encoders[key]


def _texts(batch: pa.Array) -> Iterator[str]:
    for value in batch:
        yield value.as_py() or ""


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate([*rows, np.zeros(0, "<i4")])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def read_model(path: str) -> tuple[str, bytes]:
    """The model file with a key of its content; checks on the driver that it can be used."""
    with open(path, "rb") as file:
        model = file.read()
    Vocabulary(model)
    return hashlib.sha256(model).hexdigest(), model


def encode_ids(df: DataFrame, model_path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add (or replace) the array column ``into`` with the ids of ``text``."""
    bound_batches(df.sparkSession)
    key, model = read_model(model_path)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(IDS_TYPE)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(key, shared.value)
        for batch in batches:
            yield _lists([np.frombuffer(encoder.encode(t), "<i4") for t in _texts(batch)])

    return df.withColumn(into, encode(F.col(f"`{text}`")))


def decode_ids(df: DataFrame, model_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """Add (or replace) the string column ``into`` with the text of the ids; null ids give null."""
    bound_batches(df.sparkSession)
    key, model = read_model(model_path)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(key, shared.value)
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.array([None if r is None else encoder.decode(r) for r in rows], pa.string())

    return df.withColumn(into, decode(F.col(f"`{ids}`")))


def with_digests(df: DataFrame, model_path: str, text: str = "text", ids: str | None = None) -> DataFrame:
    """Add n_tokens, ids_sha256 and decoded_sha256 of ``text``: encoded, decoded, digested in one pass.

    ``ids`` names a column for the ids themselves. Columns of these names are replaced.
    """
    bound_batches(df.sparkSession)
    key, model = read_model(model_path)
    shared = df.sparkSession.sparkContext.broadcast(model)
    with_ids = ids is not None

    @F.arrow_udf(f"{DIGEST_TYPE[:-1]}, ids: {IDS_TYPE}>" if with_ids else DIGEST_TYPE)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(key, shared.value)
        for batch in batches:
            counts, encoded, decoded, found = [], [], [], []
            for value in _texts(batch):
                packed = encoder.encode(value)
                numbers = np.frombuffer(packed, "<i4")
                back = encoder.decode(numbers.tolist())
                counts.append(len(numbers))
                encoded.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(back.encode()).hexdigest())
                found.append(numbers)
            columns = [pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(_lists(found))
                names.append("ids")
            yield pa.StructArray.from_arrays(columns, names)

    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (*names, ids)]
    packed = fresh_name(df, "digests")
    parts = [F.col(f"{packed}.{n}").alias(n) for n in names] + ([F.col(f"{packed}.ids").alias(ids)] if with_ids else [])
    return df.select(*kept, digests(F.col(f"`{text}`")).alias(packed)).select(*kept, *parts)
