"""Line dedup: lines that many documents share stay in one of them.

A line's key is the line stripped of outer white space with A-Z lower-cased. Tasks hash the keys
of their documents; the distinct pairs of hash and document id are counted by hash, once, which
gives every hash that several documents hold its number of documents and its largest id. These
hashes are dealt into shards. A shard builds a minimal perfect hash over its own, which indexes
arrays of fingerprints, counts and keepers, and writes it to the shared folder. The documents are
then read once more where they lie: a task opens the shards that its lines fall in, in order, and
probes their arrays. Documents are never shuffled and lines are never joined; a line in a third
of all documents costs one pair per document in a shuffle that spreads it by document, then one
row per task.

A line that one document alone holds stays whatever the threshold, so the index leaves it out.
Fingerprints are the whole 64-bit hashes, so an absent line is never taken for another one.
Two keys could only be taken for one if their hashes were equal.

Each batch of documents reads the shards its lines fall in, so reading grows with the product of
batches and shared lines; the arrays are mapped, not copied, where the shared folder is mounted.

Defined results: a null or empty text is one empty line. Rows with the same id are one document:
all that have the keeper's id keep the line, and rows without an id are one document whose id is
the smallest. Empty tables give no rows. Rows travel as one struct, so other columns pass through
whatever their names.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.shared import ship, stored, text_of
from ledgerlake.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
#: Keys per shard, on average.
SHARD_KEYS = 1 << 20
#: Bytes of opened shards that a task keeps for its next batches.
OPEN_BYTES = 128 << 20
#: Bits per key of a level of the perfect hash, as a multiple of its keys.
GAMMA = 2.0
NO_ID = np.iinfo(np.int64).min


def key_of(line: bytes) -> int | None:
    """The hash of a line's key, none if the key is too short to count.

    ``bytes`` methods know ASCII only, which is just what a key's definition asks for.
    """
    key = line.strip().lower()
    if len(key) < MIN_CHARS or len(key.decode()) < MIN_CHARS:
        return None
    return xxhash.xxh64_intdigest(key)


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of the keys for each level (the finaliser of SplitMix64)."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ShardIndex:
    """A minimal perfect hash over distinct hashes, and the arrays it indexes.

    Each level is a bit array; a key's place there counts if no other key of the level has it,
    and the keys left over go to the next level. A key's slot is the number of set bits before,
    which is stored for the first bit of every 64-bit word.
    """

    ARRAYS = {
        "sizes": pa.int64(), "words": pa.uint64(), "ranks": pa.int64(),
        "fingerprints": pa.uint64(), "counts": pa.uint32(), "keepers": pa.int64(),
    }

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.sizes: np.ndarray = arrays["sizes"]
        self.words: np.ndarray = arrays["words"]
        self.ranks: np.ndarray = arrays["ranks"]
        self.fingerprints: np.ndarray = arrays["fingerprints"]
        self.counts: np.ndarray = arrays["counts"]
        self.keepers: np.ndarray = arrays["keepers"]

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> ShardIndex:
        """From distinct ``keys`` (uint64), their document counts and largest ids."""
        sizes: list[int] = []
        levels: list[np.ndarray] = []
        left = keys
        while len(left):
            size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            at = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=bool)
            bits[at[alone]] = True
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone]
        words = np.concatenate(levels) if levels else np.empty(0, np.uint64)
        set_bits = np.bitwise_count(words).astype(np.int64)
        index = cls(
            {
                "sizes": np.array(sizes, dtype=np.int64),
                "words": words,
                "ranks": np.cumsum(set_bits) - set_bits,
                "fingerprints": np.empty(len(keys), dtype=np.uint64),
                "counts": np.empty(len(keys), dtype=np.uint32),
                "keepers": np.empty(len(keys), dtype=np.int64),
            }
        )
        slots = index.slots(keys)
        index.fingerprints[slots] = keys
        index.counts[slots] = np.minimum(counts, np.iinfo(np.uint32).max)
        index.keepers[slots] = keepers
        return index

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot, -1 if it certainly is not in the index."""
        slots = np.full(len(keys), -1, dtype=np.int64)
        todo, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = (_mixed(keys[todo], level) % np.uint64(size)).astype(np.int64)
            word = first + (at >> 6)
            bit = np.uint64(1) << (at & 63).astype(np.uint64)
            found = self.words[word]
            hit = (found & bit) != 0
            before = np.bitwise_count(found[hit] & (bit[hit] - np.uint64(1)))
            slots[todo[hit]] = self.ranks[word[hit]] + before
            todo = todo[~hit]
            first += size >> 6
        return slots

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document count and keeper of each key; the count is 0 where the index lacks it."""
        slots = self.slots(keys)
        known = slots >= 0
        known[known] = self.fingerprints[slots[known]] == keys[known]
        counts = np.zeros(len(keys), dtype=np.uint32)
        keepers = np.full(len(keys), NO_ID, dtype=np.int64)
        counts[known] = self.counts[slots[known]]
        keepers[known] = self.keepers[slots[known]]
        return counts, keepers

    def arrays(self) -> pa.RecordBatch:
        """One row, a list per array: such a file can be mapped without reading it."""
        lists = [
            pa.ListArray.from_arrays([0, len(own)], pa.array(own, kind))
            for name, kind in self.ARRAYS.items()
            for own in [getattr(self, name)]
        ]
        return pa.RecordBatch.from_arrays(lists, list(self.ARRAYS))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> ShardIndex:
        return cls(
            {name: batch.column(name).values.to_numpy() for name in cls.ARRAYS}
        )


def _shard_path(root: str, shard: int) -> str:
    return f"{root}/shard-{shard:09d}.arrow"


def _write_shard(folder: str):
    """Of a shard's keys: build the index and store it.

    The keys are put in order first, so every attempt of a task makes the same file; it gets its
    name when it is whole.
    """

    def write(numbers: pa.Table, keys: pa.Table) -> pa.Table:
        shard = numbers.column("shard")[0].as_py()
        hashes = keys.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        batch = ShardIndex.build(
            hashes[order],
            keys.column("n_docs").to_numpy()[order],
            keys.column("keeper").to_numpy()[order],
        ).arrays()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        path = _shard_path(root, shard)
        unfinished = f"{path}-{np.random.default_rng().integers(1 << 62):x}"
        with store.open_output_stream(unfinished) as out:
            with pa.ipc.new_file(out, batch.schema) as writer:
                writer.write_batch(batch)
        store.move(unfinished, path)
        return pa.table({"shard": [shard], "n_keys": [len(hashes)]})

    return write


class Index:
    """The stored shards as a task sees them; the last ones opened stay open."""

    def __init__(self, folder: str, shards: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.shards = shards
        self.opened: OrderedDict[int, tuple[ShardIndex, int]] = OrderedDict()

    def _open(self, shard: int) -> ShardIndex:
        if shard not in self.opened:
            path = _shard_path(self.root, shard)
            mapped = isinstance(self.store, fs.LocalFileSystem)
            source = pa.memory_map(path) if mapped else self.store.open_input_file(path)
            batch = pa.ipc.open_file(source).get_batch(0)
            self.opened[shard] = ShardIndex.of(batch), batch.nbytes
            while len(self.opened) > 1 and sum(n for _, n in self.opened.values()) > OPEN_BYTES:
                self.opened.popitem(last=False)
        self.opened.move_to_end(shard)
        return self.opened[shard][0]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and keeper of each hash (uint64)."""
        counts = np.zeros(len(hashes), dtype=np.uint32)
        keepers = np.full(len(hashes), NO_ID, dtype=np.int64)
        where = shard_of(hashes, self.shards)
        order = np.argsort(where, kind="stable")
        starts = np.flatnonzero(np.diff(where[order], prepend=-1))
        for own in np.split(order, starts[1:]) if len(order) else []:
            counts[own], keepers[own] = self._open(int(where[own[0]])).lookup(hashes[own])
        return counts, keepers


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)


HELD = "hash long, id long"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of key hash and document id of each batch."""
    for batch in batches:
        ids = batch.column("id").to_pylist()
        pairs = {
            (key, NO_ID if doc_id is None else doc_id)
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True)
            for line in text.split(b"\n")
            if (key := key_of(line)) is not None
        }
        hashes = np.fromiter((h for h, _ in pairs), dtype=np.uint64, count=len(pairs))
        holders = np.fromiter((i for _, i in pairs), dtype=np.int64, count=len(pairs))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(holders)], ["hash", "id"]
        )


def _dropped(folder: str, shards: int, min_docs: int):
    """Every document without the lines that another one keeps."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, shards)
        for batch in batches:
            ids = batch.column("id").to_pylist()
            split = [text.split(b"\n") for text in batch.column("text").to_pylist()]
            keys = [key_of(line) for lines in split for line in lines]
            probed = [at for at, key in enumerate(keys) if key is not None]
            hashes = np.array([keys[at] for at in probed], dtype=np.uint64)
            owner = np.repeat(
                np.array([NO_ID if i is None else i for i in ids], dtype=np.int64),
                [len(lines) for lines in split],
            )[probed]
            counts, keepers = index.lookup(hashes)
            goes = np.zeros(len(keys), dtype=bool)
            goes[np.array(probed, dtype=np.int64)] = (counts >= min_docs) & (keepers != owner)
            kept_texts, n_dropped, at = [], [], 0
            for lines in split:
                own = goes[at : at + len(lines)].tolist()
                at += len(lines)
                n_dropped.append(sum(own))
                kept_texts.append(
                    b"\n".join([x for x, gone in zip(lines, own, strict=True) if not gone])
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(kept_texts, pa.binary()).cast(pa.string()),
                    pa.array(map(len, split), pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                ],
                ["row", "kept", "n_lines", "n_dropped"],
            )

    return drop


def build_index(rows: DataFrame) -> tuple[str, int]:
    """Store the index of ``rows`` (id, text as bytes); its folder and number of shards."""
    spark: SparkSession = rows.sparkSession
    held = rows.select("id", "text").mapInArrow(_held, HELD).distinct()
    keys = stored(
        held.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .filter("n_docs > 1"),
        "line-keys",
    )
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    folder = scratch_path(spark, "line-index")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    numbers = spark.range(shards).select(F.col("id").alias("shard"))
    dealt = keys.withColumn(
        "shard", F.pmod(F.shiftrightunsigned("hash", 1), F.lit(shards))
    )
    written = numbers.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(
        _write_shard(folder), "shard long, n_keys long"
    )
    stored(written, "line-shards")
    return folder, shards


def deduplicate(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Each row as struct ``row`` with its ``kept`` text, ``n_lines`` and ``n_dropped``.

    ``min_docs`` is 2 at least.
    """
    if min_docs < 2:
        raise ValueError("a line is shared by two documents at least")
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        text_of("text").cast("binary").alias("text"),
        F.struct(*_but_text(docs)).alias("row"),
    )
    folder, shards = build_index(rows)
    schema = T.StructType([rows.schema["row"]])
    schema = schema.add("kept", "string").add("n_lines", "long").add("n_dropped", "long")
    return rows.mapInArrow(_dropped(folder, shards, min_docs), schema)


def _but_text(docs: DataFrame) -> list[Column]:
    """The columns other than the text, which travels beside them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return rest or [F.lit(None).cast("string").alias("none")]


def with_kept_lines(docs: DataFrame) -> DataFrame:
    """The documents with their columns and the kept text; ``n_chars`` follows the text."""
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return deduplicate(docs).select(
        *[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
