"""Best-two-fit packing of tokenised documents into sequences of a fixed size.

A sequence is opened with the longest piece left and filled greedily with the longest that still
fits. If a gap remains, the smallest piece gives way to two unpacked ones that fill the widened
gap better. All that this needs to know of the corpus is how many pieces there are of each
length, at most as many numbers as a sequence has tokens: the driver packs lengths, and repeats a
filled sequence as long as all its lengths last, so its work does not grow with the corpus.

Tasks number the pieces of each length as they cut them. The numbers of the tasks before, summed
per length, make that a number over the whole corpus, and a table of runs (which numbers of a
length lie in which sequences, where) turns it into a sequence and an offset. Texts are read and
encoded once; of the pieces only narrow columns are shuffled, spread over tasks and lengths.

Words between ASCII white space are encoded one by one, which gives the ids of the whole text: no
rule of the tokenizer looks across white space. Latin words are put in lower case and parted here,
for all texts of a batch at once; their parts and the other words are encoded once and remembered.

Defined results: a null text is empty and gives the end id alone. Every row is a document, with
its id, null or repeated, carried along. A document longer than a sequence is cut into full pieces
and a rest; no other is cut. A text is held in memory several times over. An empty table gives no
rows. Only id and text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import compress
from string import ascii_letters

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from ledgerlake.llm.shared import SPACE_BYTES, ship, stored

MODEL = public_tokenizers.path("word_bpe_49k.json")
SIZE = 2048
#: The id that ends a document.
END = 0
#: Parts that a task remembers, and as many older ones.
HELD = 1 << 18
#: Bytes of texts that are split into parts at once; a longer text is split alone.
AT_ONCE = 4 << 20
#: Parts that are encoded together.
TOGETHER = 1024

#: Kinds of bytes. The letters are those of two bytes, too: U+00C0 to U+017F, which no normal form
#: changes and whose lower case is per letter, but for three; words with others are not Latin.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
#: Signs for multiplication and division, and a capital whose lower case is two letters.
_NO_LETTERS = "\u00d7\u00f7\u0130"
#: The end of the last token of a part.
_LAST = "</w>"


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[33:127] = _MARK
    kinds[list(b"0123456789")] = _DIGIT
    kinds[list(ascii_letters.encode())] = _LETTER
    kinds[0x80:0xC0] = kinds[0xC3:0xC6] = _LETTER
    kinds[list(SPACE_BYTES)] = _SPACE
    return kinds


_KINDS = _kinds()
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
#: Lower case of the letters of two bytes, counted from the first; -1 for none.
_LOWER_PAIR = np.array(
    [-1 if chr(c) in _NO_LETTERS else ord(chr(c).lower()) - 0xC0 for c in range(0xC0, 0x180)]
)


def _shortened(low: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where 's, 't, 're, 've, 'm, 'll and 'd begin and end; other marks before make them none."""
    at = np.flatnonzero(low == ord("'"))
    at = at[kind[at - 1] != _MARK]
    one, two = low[at + 1], low[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == two) & (one == ord("l")))
    return at[short | long], np.concatenate([at[short] + 2, at[long] + 3])


def _parts(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Parts of words, as the tokenizer parts them; where they begin; which are whole words.

    Latin words are parted into shortened forms and runs of letters and of marks, in lower case,
    and single digits. Other words stay whole, as they are. ``data`` ends with two spaces of any
    kind.
    """
    data.decode()  # Fails on what is not UTF-8.
    raw = np.frombuffer(data, dtype=np.uint8)
    kind, low = _KINDS[raw], _LOWER[raw]
    pair = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC5))
    lower = _LOWER_PAIR[(raw[pair] - 0xC3) * 64 + raw[pair + 1] % 64]
    low[pair], low[pair + 1] = 0xC3 + lower // 64, 0x80 + lower % 64
    begins = kind == _DIGIT
    begins[0] = True
    begins[1:] |= kind[1:] != kind[:-1]
    marks, ends = _shortened(low, kind)
    begins[marks + 1] = False
    begins[ends] = True
    special = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
    odd = kind == _OTHER
    odd[special] = odd[pair[lower < 0]] = True
    whole = np.zeros(len(raw), dtype=bool)
    if odd.any():
        edges = np.append(0, np.flatnonzero(kind == _SPACE))
        place = np.flatnonzero(np.logical_or.reduceat(odd, edges))
        first = edges[place] + (place > 0)
        step = np.zeros(len(raw), dtype=np.int8)
        step[first], step[edges[place + 1]] = 1, -1
        whole = np.cumsum(step, dtype=np.int8).astype(bool)
        low[whole] = raw[whole]
        begins[whole] = False
        begins[first] = True
    at = np.flatnonzero(begins)
    buffers = [None, pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(low)]
    all_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), buffers)
    filled = kind[at] != _SPACE
    at = at[filled]
    return all_.filter(pa.array(filled)), at, whole[at]


PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, nth long"


def _byte_letters() -> dict[str, str]:
    """The letters of byte-level tokens for the bytes beyond ASCII that have others."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): chr(256 + i) for i, b in enumerate(others) if b > 127}


class Encoder:
    """Ids of texts as bytes, four to an id, little-endian.

    Of the parts met (see ``_parts``), those of the last while are remembered, and older ones that
    were asked for.
    """

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_file(model)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(_LAST)]] = True
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _merge(self, parts: list[bytes]) -> None:
        """Encode parts of Latin words together: spelled here, merged by the library."""
        spelled = b" ".join(parts).decode("latin-1")
        for byte, letter in self.letters.items():
            spelled = spelled.replace(byte, letter)
        encoded = self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, dtype="<u4")
        ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
        data, start = ids.tobytes(), 0
        for part, end in zip(parts, ends.tolist(), strict=True):
            self.known[part] = data[start:end]
            start = end

    def _unknown(self, parts: Iterable[bytes]) -> list[bytes]:
        """The parts that are to be encoded; older ones are remembered anew."""
        new = [p for p in parts if p not in self.known]
        if not self.older:
            return new
        self.known.update((p, self.older[p]) for p in new if p in self.older)
        return [p for p in new if p not in self.known]

    def _learn(self, parts: list[bytes], whole: np.ndarray) -> None:
        """Encode the parts that are not known; ``whole`` marks the words that are not Latin."""
        latin = self._unknown(compress(parts, (~whole).tolist()))
        for at in range(0, len(latin), TOGETHER):
            self._merge(latin[at : at + TOGETHER])
        for word in self._unknown(compress(parts, whole.tolist())):
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > HELD:
            self.known, self.older = {}, self.known
        parts, at, whole = _parts(b"\n".join([*texts, b"\n"]))
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        once = np.zeros(len(distinct), dtype=bool)
        once[coded.indices.to_numpy()] = whole
        self._learn(distinct, once)
        known = pa.array([self.known[p] for p in distinct], pa.large_binary())
        ends = np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))
        bounds = pa.array(np.append(0, ends), pa.int32())
        ids = pa.ListArray.from_arrays(bounds, known.take(coded.indices))
        return pc.binary_join(ids, pa.scalar(b"", pa.large_binary())).to_pylist()


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``AT_ONCE`` bytes at most."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        ends = np.cumsum(lengths.to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
            yield batch.slice(at, to - at)
            at = to


def _cut(model: str, size: int):
    """A task's documents as pieces, numbered within the task by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(model), np.array([END], dtype="<u4").tobytes()
        met = [0] * (size + 1)
        for batch in _in_pieces(batches):
            columns: list[list] = [[] for _ in range(6)]
            doc_ids = batch.column("doc_id").to_pylist()
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(doc_ids, encoder.encode(texts), strict=True):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, size)):
                    part = ids[4 * start : 4 * (start + size)]
                    length = len(part) // 4
                    row = (doc_id, piece, start, length, part, met[length])
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    met[length] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            task = batch.column("task")[0].as_py() if batch.num_rows else 0
            arrays.append(pa.array(np.full(len(columns[0]), task, dtype=np.int32)))
            arrays.append(pa.array(columns[5], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                arrays, ["doc_id", "piece", "start", "length", "ids", "task", "nth"]
            )

    return run


def pieces(docs: DataFrame, model: str = MODEL, size: int = SIZE) -> DataFrame:
    """Every document's pieces: ``doc_id``, ``piece``, ``start``, ``length`` and ``ids``.

    ``ids`` holds unsigned little-endian 32-bit numbers; ``task`` and ``nth`` number the pieces
    of a length. The table is stored: a task that runs again would have to number them alike.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.spark_partition_id().alias("task"),
    )
    return stored(rows.mapInArrow(_cut(model, size), PIECES), "pieces")


def _best_two(free: dict[int, int], lengths: np.ndarray, room: int) -> tuple[int, int]:
    """The two free lengths with the largest sum of at most ``room``, (0, 0) if there are none."""
    open_ = lengths[[free[x] > 0 for x in lengths.tolist()]]
    small = open_[2 * open_ <= room]
    if not len(small):
        return 0, 0
    place = np.searchsorted(open_, room - small, "right") - 1
    alone = (open_[place] == small) & np.array([free[x] < 2 for x in small.tolist()])
    place = place - alone
    sums = np.where(place >= 0, open_[place] + small, 0)
    # An only copy whose next shorter one lies below it has been tried the other way round.
    sums[(place < 0) | (open_[place] < small)] = 0
    best = int(sums.argmax())
    return (int(open_[place[best]]), int(small[best])) if sums[best] else (0, 0)


def fill(left: dict[int, int], lengths: np.ndarray, size: int) -> dict[int, int]:
    """How many pieces of each length the next sequence takes.

    ``left`` has the number of unpacked pieces of every length, ``lengths`` those lengths sorted.
    """
    use: dict[int, int] = {}
    gap, reach = size, len(lengths) - 1
    while reach >= 0:
        length = int(lengths[reach])
        n = min(gap // length, left[length])
        if n:
            use[length] = n
            gap -= n * length
        reach = min(reach, int(np.searchsorted(lengths, gap, "right"))) - 1
    if not gap or sum(use.values()) < 2:
        return use
    smallest = min(use)
    use[smallest] -= 1
    free = {x: left[x] - use.get(x, 0) for x in lengths.tolist()}
    one, two = _best_two(free, lengths, gap + smallest)
    for length in (one, two) if one + two > smallest else (smallest,):
        use[length] = use.get(length, 0) + 1
    return {length: n for length, n in use.items() if n}


def pack_lengths(counts: dict[int, int], size: int = SIZE) -> list[tuple[dict[int, int], int]]:
    """What sequences hold of each length, and how many are filled that way."""
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        lengths = np.array(sorted(left), dtype=np.int64)
        use = fill(left, lengths, size)
        copies = min(left[length] // n for length, n in use.items())
        out.append((use, copies))
        for length, n in use.items():
            left[length] -= n * copies
            if not left[length]:
                del left[length]
    return out


def runs(packed: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows of: first number, pieces per sequence, first sequence, offset there."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    met: dict[int, int] = {}
    sequence = 0
    for use, copies in packed:
        offset = 0
        for length in sorted(use, reverse=True):
            first = met.get(length, 0)
            found.setdefault(length, []).append((first, use[length], sequence, offset))
            met[length] = first + use[length] * copies
            offset += length * use[length]
        sequence += copies
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence = np.zeros(len(length), dtype=np.int64)
            offset = np.zeros(len(length), dtype=np.int64)
            for one in np.unique(length).tolist():
                rows, own = known[one], length == one
                run_ = rows[np.searchsorted(rows[:, 0], number[own], "right") - 1]
                copy, slot = np.divmod(number[own] - run_[:, 0], run_[:, 1])
                sequence[own] = run_[:, 2] + copy
                offset[own] = run_[:, 3] + slot * one
            columns = [*batch.columns, pa.array(sequence), pa.array(offset)]
            names = [*batch.schema.names, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``cut`` (see ``pieces``) with ``sequence_id`` and ``offset``.

    All columns travel with them, so ids should be left out where they are not wanted. The runs
    that are sent to the executors are bounded by the lengths, whatever the number of pieces.
    """
    spark = cut.sparkSession
    counted = stored(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {
        r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    table = spark.sparkContext.broadcast(runs(pack_lengths(counts, size)))
    earlier = Window.partitionBy("length").orderBy("task")
    before = F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    first = counted.select("task", "length", F.coalesce(before, F.lit(0)).alias("first"))
    numbered = cut.join(first, ["task", "length"]).withColumn("number", F.expr("first + nth"))
    placed = numbered.drop("task", "nth", "first")
    schema = T.StructType([*placed.schema.fields])
    schema.add("sequence_id", "long").add("offset", "long")
    return placed.mapInArrow(_place(table), schema).drop("number")


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, the pieces in order; needs the pieces' ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
