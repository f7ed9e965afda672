"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints within three bits of each other are linked. The 64 bits are cut into bands. If two
fingerprints differ in one to three bits, then without some band they differ in at most two, and
a value in the middle lies within one bit of both. So for each band that is left out, every
distinct fingerprint emits all variants of the rest within half the radius, variants are shuffled,
and fingerprints that collide are verified bit by bit. Groups that share a variant are linked
without comparing all pairs: large groups meet in the middle once more within the band left out.
Links are joined to components over distinct fingerprints; exact copies share one.

Defined results: a null text has no words, as the empty text; without words the fingerprint is
zero and linked like any other. A row is a document; of ids the smallest of a component is its id,
null ids do not count unless there is no other. An empty table gives no rows. Only id and text
are read, so other columns do not matter. Texts are hashed in pieces, so memory grows with the
text's words but not with their number of bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import components
from ledgerlake.llm.shared import ship, stored

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
#: Widths of the bands, which add up to all bits. One is left out of each variant, so more bands
#: mean longer variants, fewer chance collisions and more rows.
BANDS = (22, 21, 21)
#: Where a key holds its band's number: above every variant and below the sign.
BAND_AT = 60
#: Groups up to this size are compared pair by pair, in one go.
SMALL_GROUP = 64
#: Shingles hashed before their bits are counted.
PIECE = 1 << 15


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles. ``bytes`` methods know ASCII only, as wanted."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - width + 1)
    last = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, dtype=np.int64)
    for first in range(0, n, PIECE):
        hashes = np.array(
            [
                digest(line[ends[i] : ends[i + last] - 1], SEED)
                for i in range(first, min(n, first + PIECE))
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def majority(hashes: np.ndarray) -> int:
    """The SimHash of given 64-bit hashes: the bits that are set in over half of them."""
    set_bits = np.zeros(BITS, dtype=np.int64)
    for first in range(0, len(hashes), PIECE):
        piece = hashes[first : first + PIECE].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(piece, axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or b"", width) for t in batch.column(1).to_pylist()]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""
    ship(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(_fingerprints(width), "doc_id long, fp long")


def _rotations() -> list[tuple[int, int]]:
    """Per band: the rotation that brings it to the top, and how many bits stay below it."""
    out, low = [], 0
    for band in BANDS:
        low += band
        out.append(((BITS - low) % BITS, BITS - band))
    return out


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    if by == 0:
        return values
    return (values << np.uint64(by)) | (values >> np.uint64(BITS - by))


def variants(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (band and variant of the other bits) and, beside each, the fingerprint."""
    keys = []
    for number, (by, below) in enumerate(_rotations()):
        rest = _rotated(prints, by) & np.uint64((1 << below) - 1)
        flips = np.array([0, *(1 << bit for bit in range(below))], dtype=np.uint64)
        keys.append((rest[:, None] ^ flips) | np.uint64(number << BAND_AT))
    every = np.concatenate(keys, axis=1)
    return every.ravel(), np.repeat(prints, every.shape[1])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for first in range(0, len(prints), 512):
            keys, own = variants(prints[first : first + 512])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(own.view(np.int64))], ["key", "fp"]
            )


def _forest(n: int, links: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The links that join two parts when taken in turn: at most n - 1 of them."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for a, b in links:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _meeting(
    near: tuple[np.ndarray, np.ndarray], far: tuple[np.ndarray, np.ndarray]
) -> Iterator[tuple[int, int]]:
    """Links of all members at a place, ``near`` and ``far``, that has a near one.

    Both arguments are places and members.
    """
    hub: dict[int, int] = {}
    for place, member in zip(near[0].tolist(), near[1].tolist(), strict=True):
        if (first := hub.setdefault(place, member)) != member:
            yield first, member
    for place, member in zip(far[0].tolist(), far[1].tolist(), strict=True):
        if (first := hub.get(place, member)) != member:
            yield first, member


def link_group(prints: np.ndarray, key: int) -> list[tuple[int, int]]:
    """Links that join all members of a variant's group that chains of close pairs join.

    Every pair linked differs in at most ``RADIUS`` bits. Members differ from the variant in at
    most one bit outside the band, so pairs differ there in 0, 1 or 2 bits and may differ in 3, 2
    or 1 within it. Each case meets in the middle of the band.
    """
    n = len(prints)
    if n <= SMALL_GROUP:
        apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
        a, b = np.nonzero(np.triu(apart <= RADIUS, 1))
        return _forest(n, zip(a.tolist(), b.tolist(), strict=True))
    by, below = _rotations()[key >> BAND_AT]
    turned = _rotated(prints, by)
    outside = (turned ^ np.uint64(key)) & np.uint64((1 << below) - 1)
    within = (turned >> np.uint64(below)).astype(np.int64)
    member = np.arange(n)
    flips = np.array([1 << bit for bit in range(BITS - below)], dtype=np.int64)
    pairs = np.array([x | y for i, x in enumerate(flips) for y in flips[:i]], dtype=np.int64)

    def ball(of: np.ndarray, by_flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (within[of][:, None] ^ by_flips).ravel(), np.repeat(of, len(by_flips))

    def joined(*parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    same = member[outside == 0]
    exact, one = (within, member), ball(member, flips)
    middle = joined((within[same], same), ball(same, flips))
    return _forest(
        n,
        chain(
            _meeting(exact, one),  # up to 2 outside, up to 1 within
            _meeting(middle, joined(exact, one)),  # up to 1 outside, up to 2 within
            _meeting(middle, ball(same, pairs)),  # none outside, up to 3 within
        ),
    )


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each group of a partition that is sorted by key."""

    def linked(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        two = starts[sizes == 2]
        a, b = prints[two], prints[two + 1]
        close = np.bitwise_count(a ^ b) <= RADIUS
        left, right = [a[close]], [b[close]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            group = prints[start : start + size]
            links = link_group(group, int(keys[start]))
            if links:
                at = np.array(links)
                left.append(group[at[:, 0]])
                right.append(group[at[:, 1]])
        pairs = np.stack([np.concatenate(left), np.concatenate(right)], axis=1)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"]
        )

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        keys = batch.column(0).to_numpy().view(np.uint64)
        prints = batch.column(1).to_numpy().view(np.uint64)
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if held and (cut or held[0][0][-1] != keys[-1]):
            held.append((keys[:cut], prints[:cut]))
            yield linked(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held = []
        elif cut:
            yield linked(keys[:cut], prints[:cut])
        held.append((keys[cut:].copy(), prints[cut:].copy()))
    if held:
        yield linked(*(np.concatenate(x) for x in zip(*held, strict=True)))


def links(prints: DataFrame) -> DataFrame:
    """Links ``a`` and ``b`` that join the close fingerprints of ``prints`` (distinct ``fp``)."""
    return (
        prints.mapInArrow(_emit, "key long, fp long")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_link, "a long, b long")
    )


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, ``fp`` and ``component_id``, the smallest id reachable over close fingerprints.

    Every table that is joined back is stored first, so both sides of each join are plain
    exchanges, which adaptive execution splits where a fingerprint or component is hot.
    """
    known = stored(fingerprints(docs, width), "fingerprints")
    prints = stored(known.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    joined = components(links(prints.select("fp")))
    rooted = stored(
        prints.join(joined, prints["fp"] == joined["node"], "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    least = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "components")
    return known.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_of(print_column: str | Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(print_column)), 16, "0")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each component the one with the smallest id.

    Rows of one id are one document and stay or go together, and so do rows without one.
    """
    kept = stored(
        near_duplicates(docs)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("kept_id"))
        .distinct(),
        "kept",
    )
    # The ids grow with the corpus, so they are shuffled, not broadcast where they happen to fit.
    kept = kept.hint("merge")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
