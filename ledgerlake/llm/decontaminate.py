"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-cased word tokens; characters of scripts that are written without
spaces are tokens of their own. Documents are joined with the benchmark's items by
shared seeds, runs of ``LEAST`` tokens. Where the seeds could cover enough of an item, the document
is tiled: running Karp-Rabin hashes find the longest match of tokens not yet marked, it is marked
in both, and so on until none has ``LEAST`` tokens. Tiles may lie in any order, so the share of an
item's tokens that tiles cover also finds passages whose parts were moved.

The benchmark is dealt into blocks of a bounded number of characters, and the documents are read
once per block against its seeds; an ordinary benchmark is one block. With several, what was found
is stored after each block and its broadcast goes, so that one block is held at a time.

Defined results: a null text has no tokens, and items without tokens are in no document. Items
under ``LEAST`` tokens are looked for as a whole: seed and tile are all their tokens; ``clean`` lets
those under ``shortest`` tokens remove no document (1: all items count). Repeated items and
documents are all reported. Empty tables give no rows. Rows travel as one struct, so other columns
pass through whatever their names. Time and memory are in proportion to the text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.shared import ship, stored, text_of

#: Tokens of a seed, and the least of a tile.
LEAST = 5
#: Share of an item's tokens that tiles must cover for the document to be contaminated.
COVERAGE = 0.5
#: Characters of the items that are held in memory and sent to the executors at once.
BLOCK_CHARS = 32 << 20

BASE = 1_000_003
MASK = (1 << 61) - 1
#: Thai to Tibetan, Burmese, Khmer, kana and Han characters.
UNSPACED = (
    "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
TOKEN = re.compile(rf"[^\W{UNSPACED}]+|(?=\w)[{UNSPACED}]")

MATCHES = "array<struct<item_id:long,covered:int,n_tokens:int,n_tiles:int>>"


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def least_of(item: Sequence[int]) -> int:
    """Tokens of an item's seeds, and the least of its tiles."""
    return min(LEAST, len(item))


def _windows(tokens: Sequence[int], marked: bytearray, size: int) -> Iterator[tuple[int, int]]:
    """Start and running hash of every window without marked tokens."""
    top = pow(BASE, size - 1, MASK)
    value = held = 0
    for at, token in enumerate(tokens):
        if marked[at]:
            value = held = 0
            continue
        if held == size:
            value = (value - tokens[at - size] * top) % MASK
            held -= 1
        value = (value * BASE + token) % MASK
        held += 1
        if held == size:
            yield at - size + 1, value


def tile(
    item: Sequence[int], text: Sequence[int], least: int = LEAST
) -> list[tuple[int, int, int]]:
    """Greedy tiles as start in the item, start in the text and length, in marking order.

    Tokens are positive numbers; zeros in the text match nothing. The longest tiles are marked
    first, of equal ones those that begin first in the item and then in the text.
    """
    item_marked, text_marked = bytearray(len(item)), bytearray(t == 0 for t in text)
    tiles: list[tuple[int, int, int]] = []
    while True:
        places = defaultdict(list)
        for start, value in _windows(item, item_marked, least):
            places[value].append(start)
        best, found = least, []
        for at, value in _windows(text, text_marked, least):
            for start in places.get(value, ()):
                before = start > 0 and at > 0 and item[start - 1] == text[at - 1]
                if before and not item_marked[start - 1] and not text_marked[at - 1]:
                    continue  # part of a match that begins earlier
                size = 0
                while (
                    start + size < len(item)
                    and at + size < len(text)
                    and item[start + size] == text[at + size]
                    and not item_marked[start + size]
                    and not text_marked[at + size]
                ):
                    size += 1
                if size > best:
                    best, found = size, []
                if size == best:
                    found.append((start, at))
        if not found:
            return tiles
        for start, at in sorted(found):
            ends = start + best, at + best
            if not any(item_marked[start : ends[0]]) and not any(text_marked[at : ends[1]]):
                item_marked[start : ends[0]] = text_marked[at : ends[1]] = b"\x01" * best
                tiles.append((start, at, best))


@dataclass
class Items:
    """A block of the benchmark: its vocabulary, its items as numbers, and its seeds."""

    ids: list[int | None]
    vocabulary: dict[str, int]
    tokens: list[list[int]]
    #: By their size, and beside them their sorted hashes.
    seeds: dict[int, dict[int, list[tuple[int, int]]]]
    sorted_seeds: dict[int, np.ndarray]

    @classmethod
    def of(cls, rows: Sequence[tuple[int | None, str]]) -> Items:
        vocabulary: dict[str, int] = {}
        tokens = [
            [vocabulary.setdefault(t, len(vocabulary) + 1) for t in tokens_of(text)]
            for _, text in rows
        ]
        seeds: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for number, item in enumerate(tokens):
            if not item:
                continue
            of_size = seeds.setdefault(size := least_of(item), {})
            for at, value in enumerate(_hashes(np.array(item, dtype=np.uint64), size).tolist()):
                of_size.setdefault(value, []).append((number, at))
        return cls(
            [item_id for item_id, _ in rows],
            vocabulary,
            tokens,
            seeds,
            {
                size: np.sort(np.fromiter(of_size, dtype=np.uint64, count=len(of_size)))
                for size, of_size in seeds.items()
            },
        )

    def matches(self, text: str, coverage: float) -> list[dict[str, int | None]]:
        """The items that a text covers by at least that share."""
        get = self.vocabulary.get
        words = tokens_of(text)
        numbers = np.fromiter((get(w, 0) for w in words), dtype=np.uint64, count=len(words))
        by_item: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size, of_size in self.seeds.items():
            for at, value in self._seeded(numbers, size):
                for number, start in of_size[value]:
                    by_item[number].append((start, at))
        out = []
        for number, hits in sorted(by_item.items()):
            item = self.tokens[number]
            least = least_of(item)
            reached = {start + k for start, _ in hits for k in range(least)}
            if len(reached) < coverage * len(item):
                continue
            tiles = tile(item, _near(numbers, sorted({at for _, at in hits}), least), least)
            covered = sum(size for _, _, size in tiles)
            if covered >= coverage * len(item):
                out.append(
                    {
                        "item_id": self.ids[number],
                        "covered": covered,
                        "n_tokens": len(item),
                        "n_tiles": len(tiles),
                    }
                )
        return out

    def _seeded(self, numbers: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
        """Places and hashes of the text's windows that are seeds."""
        seeds = self.sorted_seeds[size]
        n = len(numbers) - size + 1
        if n < 1:
            return
        known = numbers > 0
        whole = known[:n].copy()
        for k in range(1, size):
            whole &= known[k : n + k]
        at = np.flatnonzero(whole)
        if not len(at):
            return
        values = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            values = values * _FACTOR + numbers[at + k]
        place = np.searchsorted(seeds, values)
        place[place == len(seeds)] = 0
        hit = seeds[place] == values
        for where, value in zip(at[hit].tolist(), values[hit].tolist(), strict=True):
            yield where, value


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the windows of ``size`` numbers; tiling compares the tokens themselves."""
    n = max(0, len(numbers) - size + 1)
    values = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        values = values * _FACTOR + numbers[k : n + k]
    return values


def _near(numbers: np.ndarray, places: list[int], size: int) -> list[int]:
    """The tokens of the windows that begin at the places, a zero where some are left out."""
    out: list[int] = []
    end = 0
    for at in places:
        if at > end and out:
            out.append(0)
        first = max(at, end) if out else at
        out += numbers[first : at + size].tolist()
        end = at + size
    return out


def _blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of about ``BLOCK_CHARS`` characters, dealt out by hash."""
    texts = items.select(
        F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text")
    )
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = -(-chars // BLOCK_CHARS)
    for block in range(n):
        dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block
        yield Items.of([(r["item_id"], r["text"]) for r in texts.filter(dealt).collect()])


def _matching(items: Broadcast[Items], coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [("item_id", pa.int64())]
                + [(name, pa.int32()) for name in ("covered", "n_tokens", "n_tiles")]
            )
        )
        for batch in batches:
            found = [
                (before or []) + items.value.matches(text or "", coverage)
                for text, before in zip(
                    batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, kind)],
                ["row", "text", "matches"],
            )

    return run


def _stored(rows: DataFrame) -> DataFrame:
    """Write rows and read them back; in the files the columns of ``row`` go by their places."""
    kind = rows.schema["row"].dataType
    numbered = T.StructType(
        [T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(kind.fields)]
    )
    written = stored(rows.withColumn("row", F.col("row").cast(numbered)), "matches")
    return written.withColumn("row", F.col("row").cast(kind))


def matched(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Each row as struct ``row`` with ``matches``, the items that its text covers.

    ``items`` has item_id and text.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("text").cast("string").alias("text"),
        F.array().cast(MATCHES).alias("matches"),
    )
    schema = T.StructType([*rows.schema.fields])
    sent = None
    for block in _blocks(items):
        if sent is not None:
            rows = _stored(rows)
            sent.destroy()
        # Bounded by the block's characters, whatever the benchmark's size.
        sent = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_matching(sent, coverage), schema)
    return rows.select("row", "matches")


def clean(docs: DataFrame, items: DataFrame, shortest: int = 1) -> DataFrame:
    """The documents that cover no item, with the columns they came with.

    An item of a word or two is in many clean documents; with ``shortest`` such items, of fewer
    tokens than that, remove none.
    """
    counted = F.exists("matches", lambda m: m["n_tokens"] >= shortest)
    return matched(docs, items).filter(~counted).select("row.*")
