"""SentencePiece encoding and decoding by weighted finite-state transducers.

A model file is compiled to three machines. The normaliser rewrites spaces to the meta symbol and
puts one in front. The lexicon reads the characters of a piece and writes its id, at a cost; a
character that no piece reads is written as its UTF-8 bytes. For BPE models a third machine
remembers the last piece and lets a piece follow only if merging the two texts as one gives just
these two pieces. A sequence is what BPE makes of its text exactly if every neighbouring pair is,
so one path is left and it is the shortest one. Unigram models have no third machine and the path
of least total cost in the tropical semiring is taken.

Each text is composed with the machines on the fly. Where no piece reads on past a meta symbol,
the lattice falls apart at words, and within them between characters that are neighbours in no
piece. The paths of words and parts are remembered by each task's process up to a bounded number.

Defined results: null and empty texts have no ids. Decoding gives the text back, with the meta
symbol itself (U+2581) read as a space. Repeated rows are encoded alike; empty tables give no
rows. Texts are encoded whole; a text without any space is one lattice, walked without recursion.
Rows travel as one struct, so other columns pass through whatever their names.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.shared import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
#: Words whose paths, and pairs whose merges, a process remembers; of words so many older ones,
#: too. Half a million words take about 100 MB.
REMEMBERED = 300_000
#: Rows worked on at once, which bounds a task's memory beside its batch.
ROWS = 256
#: Longer words are not remembered.
REMEMBERED_CHARS = 64
#: What an unknown character costs beyond the dearest piece (unigram models).
UNKNOWN_COST = 10.0

# The model file's piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
START = -1
BROKEN = -2
#: How ids are kept: as 32-bit numbers.
IDS = np.dtype("<i4")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message: number and value."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield number, data[at : at + size]
        at += size


class Paths(dict):
    """The ids of words as bytes, found when a word is first asked for and then remembered.

    When there are too many, those not asked for since the last time are forgotten.
    """

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        path = self.older.get(word)
        if path is None:
            path = self.find(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = path
        return path


@dataclass
class Machine:
    """The machines of a model. Remembered words and pairs are not sent to tasks."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    prefix: bool

    def __getstate__(self):
        named = ("pieces", "scores", "kinds", "bpe", "prefix")
        return {name: self.__dict__[name] for name in named}

    @cached_property
    def words(self) -> Paths:
        return Paths(self.path)

    @cached_property
    def pairs(self) -> dict[int, bool]:
        """Whether the third machine has an arc, by both ids as one number."""
        return {}

    @classmethod
    def of(cls, model: bytes) -> Machine:
        """Compile a model file's content."""
        pieces, scores, kinds = [], [], []
        spec: dict[str, dict[int, int | bytes]] = {"trainer": {}, "normalizer": {}}
        for number, value in _fields(model):
            if number == 1:
                entry = dict(_fields(value))
                pieces.append(entry.get(1, b"").decode())
                scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                kinds.append(entry.get(3, NORMAL))
            elif number in (2, 3):
                spec["trainer" if number == 2 else "normalizer"] = dict(_fields(value))
        trainer, normalizer = spec["trainer"], spec["normalizer"]
        kind = trainer.get(3, UNIGRAM)
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {kind} is neither unigram nor BPE")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only the identity normaliser with escaped spaces is compiled")
        if {UNUSED, USER_DEFINED} & set(kinds) or kinds.count(BYTE) != 256:
            raise ValueError("a model with byte fallback and without user symbols is needed")
        return cls(pieces, scores, kinds, kind == BPE, bool(normalizer.get(3, 1)))

    @cached_property
    def lexicon(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}

    @cached_property
    def states(self) -> dict:
        """The lexicon's states, from the first one: next states by character, ids under ""."""
        first: dict = {}
        for piece, number in self.lexicon.items():
            state = first
            for char in piece:
                state = state.setdefault(char, {})
            state[""] = number
        return first

    @cached_property
    def joints(self) -> set[str]:
        """Neighbouring characters within pieces: nothing is merged across any others."""
        return {p[k : k + 2] for p in self.lexicon for k in range(len(p) - 1)}

    def arcs(self, word: str, at: int) -> list[tuple[int, int]]:
        """Where pieces that begin at a place end, with their ids; the shortest first.

        A character that is no piece by itself is an arc of its own.
        """
        state, out = self.states, []
        for end, char in enumerate(word[at : at + self.longest], at + 1):
            state = state.get(char)
            if state is None:
                break
            if (piece := state.get("")) is not None:
                out.append((end, piece))
        if not out or out[0][0] > at + 1:
            out.insert(0, (at + 1, BROKEN))
        return out

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.lexicon))

    @cached_property
    def byte_ids(self) -> list[int]:
        found = [i for i, kind in enumerate(self.kinds) if kind == BYTE]
        return sorted(found, key=lambda i: int(self.pieces[i][3:5], 16))

    @cached_property
    def word(self) -> re.Pattern[str]:
        """What a path may be found for by itself: the whole text if a piece reads past words."""
        if any(re.search(f"[^{META}]{META}", p) for p in self.lexicon):
            return re.compile(r"(?s).+")
        return re.compile(f"{META}+[^{META}]*|[^{META}]+")

    @cached_property
    def output(self) -> list[bytes]:
        """The bytes that each id stands for; none for control symbols."""
        return [
            bytes([int(p[3:5], 16)])
            if kind == BYTE
            else (p.replace(META, " ").encode() if kind == NORMAL else b"")
            for p, kind in zip(self.pieces, self.kinds, strict=True)
        ]

    def normalised(self, text: str) -> str:
        return (META if self.prefix else "") + text.replace(" ", META) if text else ""

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]

    def merged(self, text: str) -> list[str]:
        """What BPE makes of a short text: the best pair is merged, the leftmost of equal ones."""
        parts = list(text)
        lexicon, scores = self.lexicon, self.scores
        while True:
            best = None
            for at in range(len(parts) - 1):
                found = lexicon.get(parts[at] + parts[at + 1])
                if found is not None and (best is None or scores[found] > best[0]):
                    best = (scores[found], at)
            if best is None:
                return parts
            at = best[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, last: int, piece: int) -> bool:
        """Whether the third machine has an arc for ``piece`` after ``last``."""
        pair = (last << 32) + piece
        known = self.pairs.get(pair)
        if known is None:
            parts = [self.pieces[i] for i in (last, piece) if i >= 0]
            known = self.merged("".join(parts)) == parts
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            self.pairs[pair] = known
        return known

    def bpe_path(self, word: str) -> list[int]:
        """The one path that the third machine leaves of a word's lattice.

        Its prefixes are unique, too, so a position needs to be entered only once. Long pieces
        are tried first. A character without piece never merges, so what follows it starts anew.
        """
        n, follows = len(word), self.follows
        entered = bytearray(n + 1)
        path = [(0, START, self.arcs(word, 0))]
        while path[-1][0] < n:
            at, last, arcs = path[-1]
            while arcs:
                end, piece = arcs.pop()
                free = piece == BROKEN or last == BROKEN and follows(START, piece)
                if not entered[end] and (free or follows(last, piece)):
                    entered[end] = 1
                    path.append((end, piece, self.arcs(word, end) if end < n else []))
                    break
            else:
                path.pop()
                if not path:
                    raise ValueError(f"no path through {word!r}")
        ids: list[int] = []
        for (start, _, _), (_, piece, _) in zip(path, path[1:], strict=False):
            if piece == BROKEN:
                ids += self.fallback(word[start])
            else:
                ids.append(piece)
        return ids

    def unigram_path(self, word: str) -> list[int]:
        """The path of least cost through a word's lattice."""
        scores, n = self.scores, len(word)
        unknown = UNKNOWN_COST - min(scores[i] for i in self.lexicon.values())
        cost = [0.0] + [float("inf")] * n
        back = [(0, START)] * (n + 1)
        for at in range(n):
            for end, piece in self.arcs(word, at):
                new = cost[at] + (unknown if piece == BROKEN else -scores[piece])
                if new < cost[end]:
                    cost[end], back[end] = new, (at, piece)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else self.fallback(word[start])[::-1]
            at = start
        return ids[::-1]

    def path(self, word: str) -> bytes:
        """The ids of a word as 32-bit numbers, from paths of the parts that cannot be merged."""
        joints = self.joints
        cuts = [k for k in range(1, len(word)) if word[k - 1 : k + 1] not in joints]
        if cuts:
            parts = [word[i:j] for i, j in zip([0, *cuts], [*cuts, None], strict=True)]
            return b"".join(map(self.words.__getitem__, parts))
        ids = self.bpe_path(word) if self.bpe else self.unigram_path(word)
        return np.array(ids, dtype=IDS).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        return b"".join(
            map(self.words.__getitem__, self.word.findall(self.normalised(text)))
        )

    def ids(self, text: str) -> list[int]:
        """The ids of a text."""
        return np.frombuffer(self.encode(text), dtype=IDS).tolist()

    @cached_property
    def written(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ids write, one after the other, and where each begins and how long it is."""
        sizes = np.array([len(x) for x in self.output], dtype=np.int64)
        joined = np.frombuffer(b"".join(self.output), dtype=np.uint8)
        return joined, np.cumsum(sizes) - sizes, sizes

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text that ids stand for."""
        joined, starts, sizes = self.written
        ids = np.asarray(ids, dtype=np.int64)
        size = sizes[ids]
        ends = np.cumsum(size)
        begin = np.repeat(starts[ids] - (ends - size), size)
        text = joined[begin + np.arange(len(begin))].tobytes().decode(errors="replace")
        return text.removeprefix(" ") if self.prefix else text


def load(spark: SparkSession, path: str = MODEL) -> Broadcast[Machine]:
    """The machines of a model file, on every executor: a vocabulary, whatever the corpus."""
    ship(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(Machine.of(file.read()))


def _encoded(machine: Machine, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The ids of each text, and their numbers."""
    found = [machine.encode(t or "") for t in texts.to_pylist()]
    sizes = np.array([len(x) // IDS.itemsize for x in found], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.frombuffer(b"".join(found), dtype=IDS)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sizes)


def _decoded(machine: Machine, ids: pa.ListArray) -> list[str]:
    flat, ends = ids.flatten().to_numpy(), np.cumsum(ids.value_lengths().to_numpy())
    starts = [0, *ends[:-1]]
    return [machine.decode(flat[i:j]) for i, j in zip(starts, ends, strict=True)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _rows(docs: DataFrame, carry: Sequence[str] | None) -> tuple[DataFrame, T.StructType]:
    """Each row's ``carry`` columns as struct ``row`` beside its text, and the result's schema."""
    names = [f"`{c}`" for c in carry] if carry else ["*"]
    rows = docs.select(F.struct(*names).alias("row"), F.col("text").alias("text"))
    schema = T.StructType([rows.schema["row"]])
    return rows, schema.add("ids", T.ArrayType(T.IntegerType())).add("n_ids", "long")


def encode(
    docs: DataFrame, machine: Broadcast[Machine], carry: Sequence[str] | None = None
) -> DataFrame:
    """Each row as struct ``row`` with the ``ids`` of its text and their number ``n_ids``.

    ``carry`` names the columns of ``row``, if not all are wanted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, sizes = _encoded(machine.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, sizes], ["row", "ids", "n_ids"])

    rows, schema = _rows(docs, carry)
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, machine: Broadcast[Machine]) -> DataFrame:
    """The rows of ``encoded`` (row, ids, n_ids) with their ``decoded`` text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = pa.array(_decoded(machine.value, batch.column(1)), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, texts], [*batch.schema.names, "decoded"]
            )

    rows = encoded.select("row", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"), "n_ids")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields]).add("decoded", "string"))


def encode_checked(
    docs: DataFrame, machine: Broadcast[Machine], carry: Sequence[str] | None = None
) -> DataFrame:
    """What ``encode`` gives, with ``given_back``: whether decoding the ids gives the text.

    The ids are decoded where they were made, so each text crosses to Python once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, sizes = _encoded(machine.value, batch.column(1))
            texts = [(t or "").replace(META, " ") for t in batch.column(1).to_pylist()]
            same = [a == b for a, b in zip(texts, _decoded(machine.value, ids), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, sizes, pa.array(same, pa.bool_())],
                ["row", "ids", "n_ids", "given_back"],
            )

    rows, schema = _rows(docs, carry)
    return rows.mapInArrow(run, schema.add("given_back", "boolean"))
