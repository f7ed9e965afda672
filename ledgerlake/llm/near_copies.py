"""Near copies by SimHash with an exact check, completed by a join on word shingles.

Texts are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more.
Every text has a SimHash of these shingles. Texts whose fingerprints differ in three bits or fewer
(found by ``simhash.links``, ball hashing as in op4) are candidates, and so are those of one
fingerprint; they are verified on their texts. Fewer than
all similar texts are that close, so a complete join (a prefix filter) adds the others. Under any
one order of all shingles, two such sets share ``MEETINGS`` of the first fifth of each
and as many more (prefix filter), so every text emits these, they are shuffled, and texts that
meet that often are candidates. The order puts the shingles of many texts last, by an array of
``SLOTS`` counters over all texts that shingles are hashed into; it keeps groups small and changes
no result. Candidates are verified on their texts, so no pair is missed or linked by chance, but
for collisions of 64-bit hashes.

Large groups of copies are not compared pair by pair. First, beside the candidates
by SimHash, every text that meets others is compared with the centre of each group, the text that has the largest share of its shingles in
common with others, and with the next one in size: two rows per place. What that links is one
component, and only pairs of different components are left, all of which are compared, unless a
bound rules them out before they leave the task: a text's sketch has the parity of the number of
its shingles in each of many buckets, and where two sketches differ a shingle of one text is not
in the other. Groups that are large even so are dealt over tasks in tiles.

Defined results: words are the lower-cased (ASCII) runs without white space; a text of fewer than
five has one shingle, all of them; texts without words, null too, are exact copies of each other.
A row is a document; of ids the smallest of a component is its id, null ids do not count unless
there is no other. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import components
from ledgerlake.llm.shared import ship, stored
from ledgerlake.llm.simhash import links as ball_links, majority

SHINGLE = 5
#: Least similarity, as a fraction.
ALIKE = (4, 5)
SEED = 42
#: How often candidates must meet, or as often as their least overlap if that is smaller.
MEETINGS = 3
#: Counters of the shingles' texts, and how many of them are sent together.
SLOTS = 1 << 22
BLOCK = 1 << 16
#: Bits of a sketch, at least and at most.
BITS = (64, 1 << 16)
#: Texts of a group that one task pairs up.
TILE = 4096
#: Pairs handed on at once.
PIECE = 1 << 16

NODES = "doc_id long, node long, n int, sketch binary, fp long"
SEEN = "block int, slots binary, counts binary"
PLACES = "shingle long, n int, at int, node long"
SHARED = f"{PLACES}, many int"
ROOTED = f"{SHARED}, root long"
PAIRS = "a long, b long"
MET = f"{PAIRS}, need int"


def words_line(text: bytes | None) -> tuple[list[bytes], bytes]:
    """A text's words and the line they make."""
    words = (text or b"").lower().split()
    return words, b" ".join(words)


def node_of(line: bytes) -> int:
    """The number of a text: a signed hash of its words."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(line, SEED)).view(np.int64))


def shingles(words: list[bytes], line: bytes, width: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's shingles, each once."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    last, digest = min(width, len(words)), xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    hashes = (digest(line[ends[i] : ends[i + last] - 1], SEED) for i in range(n))
    return np.unique(np.fromiter(hashes, dtype=np.uint64, count=n))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles are similar enough."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return ALIKE[1] * both >= ALIKE[0] * (len(a) + len(b) - both)


def sketch(hashes: np.ndarray) -> bytes:
    """The parity of the number of shingles in each bucket; twice as many buckets as shingles."""
    bits = BITS[0]
    while bits < min(2 * len(hashes), BITS[1]):
        bits *= 2
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of ``size`` bytes, or twice as many, as rows of ``size`` bytes; others are zero."""
    rows = np.zeros((len(sketches), size), dtype=np.uint8)
    for row, given in zip(rows, sketches, strict=True):
        if len(given) in (size, 2 * size):
            halves = np.frombuffer(given, dtype=np.uint8).reshape(-1, size)
            np.bitwise_xor.reduce(halves, axis=0, out=row)
    return rows


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def prefix(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first shingles of a set, some of which every similar set has among its own first."""
    hashes = hashes[np.argsort(levels[_slot(hashes)], kind="stable")]
    n = len(hashes)
    return hashes[: n + (-ALIKE[0] * n // ALIKE[1]) + MEETINGS]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document's node; with one that a task meets first, its size, sketch and SimHash."""
    met: set[int] = set()
    for batch in batches:
        nodes, sizes, sketches, prints = [], [], [], []
        for text in batch.column(1).to_pylist():
            words, line = words_line(text)
            node = node_of(line)
            new = node not in met
            met.add(node)
            own = shingles(words, line) if new else None
            nodes.append(node)
            sizes.append(len(own) if new else None)
            sketches.append(sketch(own) if new else None)
            fp = majority(own) if new and words else None
            prints.append(None if fp is None else int(np.uint64(fp).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
             pa.array(sketches, pa.binary()), pa.array(prints, pa.int64())],
            ["doc_id", "node", "n", "sketch", "fp"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Per batch, the nodes a task has not met yet and their shingles."""
    met: set[int] = set()
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            words, line = words_line(text)
            if words and (node := node_of(line)) not in met:
                met.add(node)
                out.append((node, shingles(words, line)))
        if out:
            yield out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counters by block: all of a block's, or those in use and where they are."""
    counts = np.zeros(SLOTS, dtype=np.int64)
    for sets in _sets(batches):
        slots, n = np.unique(_slot(np.concatenate([s for _, s in sets])), return_counts=True)
        counts[slots] += n
    few = np.minimum(counts, 255).astype(np.uint8).reshape(-1, BLOCK)
    for block, own in enumerate(few):
        used = np.flatnonzero(own)
        if not len(used):
            continue
        dense = 3 * len(used) > BLOCK
        slots = b"" if dense else used.astype(np.uint16).tobytes()
        columns = [[block], [slots], [(own if dense else own[used]).tobytes()]]
        types = [pa.int32(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "slots", "counts"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the counters of the blocks that a task gets, as logarithms."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total = sums.setdefault(block, np.zeros(BLOCK, dtype=np.int64))
            at = np.frombuffer(slots, dtype=np.uint16) if slots else slice(None)
            total[at] += np.frombuffer(counts, dtype=np.uint8)
    for block, total in sums.items():
        levels = np.log2(np.maximum(total, 1)).astype(np.uint8).tobytes()
        arrays = [pa.array([block], pa.int32()), pa.array([levels], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["block", "levels"])


def _levels(texts: DataFrame) -> np.ndarray:
    """Of each slot the logarithm of the number of texts: ``SLOTS`` bytes, whatever the corpus."""
    seen = texts.mapInArrow(_counted, SEEN).repartition("block")
    found = seen.mapInArrow(_added, "block int, levels binary").collect()
    levels = np.zeros(SLOTS, dtype=np.uint8)
    for block, given in found:
        levels[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(given, dtype=np.uint8)
    return levels


def _places(order: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _sets(batches):
            first = [prefix(s, order.value) for _, s in sets]
            sizes = [len(p) for p in first]
            columns = [
                np.concatenate(first).view(np.int64),
                np.repeat(np.array([len(s) for _, s in sets], dtype=np.int32), sizes),
                np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
                np.repeat(np.array([node for node, _ in sets], dtype=np.int64), sizes),
            ]
            for at in range(0, len(columns[0]), PIECE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[at : at + PIECE]) for c in columns],
                    ["shingle", "n", "at", "node"],
                )

    return run


Rows = list[np.ndarray]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    """Columns of whole groups, of a partition that is sorted by its first column."""
    held: list[Rows] = []

    def joined() -> Rows:
        return [np.concatenate(c) for c in zip(*held, strict=True)]

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(rows[0]):
            continue
        cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if held and (cut or held[0][0][-1] != rows[0][-1]):
            held.append([c[:cut] for c in rows])
            yield joined()
            held = []
        elif cut:
            yield [c[:cut] for c in rows]
        held.append([c[cut:].copy() for c in rows])
    if held:
        yield joined()


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places whose shingle other texts have in their prefixes, too; each once, how many."""
    for rows in _groups(batches):
        once = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[3][1:] != rows[3][:-1])]
        rows = [c[once] for c in rows]
        sizes = np.diff(np.r_[_starts(rows[0]), len(rows[0])])
        many = np.repeat(sizes, sizes).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[many > 1]) for c in (*rows, many)], ["shingle", "n", "at", "node", "many"]
        )


def _may_be_alike(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether sets of n <= m shingles that share those at two places can be similar enough."""
    few, many = ALIKE
    fits = many * n >= few * m
    most = np.minimum(at, to) + np.minimum(n - at, m - to)
    return fits & ((few + many) * most >= few * (n + m))


def _as_pairs(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Pairs, and how often those whose sizes add up to ``sizes`` must meet."""
    few, many = ALIKE
    need = np.minimum(MEETINGS, -(-few * sizes // (few + many))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(need)],
        ["a", "b", "need"],
    )


def _first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group, sorted by size, every text with the next one and with the group's centre."""
    for shingle, n, at, node, common in _groups(batches):
        n, at = n.astype(np.int64), at.astype(np.int64)
        starts = _starts(shingle)
        sizes = np.diff(np.r_[starts, len(shingle)])
        group = np.repeat(np.arange(len(starts)), sizes)
        best = np.lexsort((node, -common, group))[starts]
        one = np.r_[np.arange(len(n) - 1), np.repeat(best, sizes)]
        two = np.r_[np.arange(1, len(n)), np.arange(len(n))]
        one, two = np.minimum(one, two), np.maximum(one, two)
        own = (group[one] == group[two]) & (one != two)
        if not own.any():
            continue
        one, two = np.unique(np.stack([one[own], two[own]]), axis=1)
        fits = _may_be_alike(n[one], at[one], n[two], at[two])
        one, two = one[fits], two[fits]
        yield _as_pairs(node[one], node[two], n[one] + n[two])


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of groups that have texts of several components."""
    names = ["shingle", "n", "at", "node", "many", "root"]
    for rows in _groups(batches):
        starts = _starts(rows[0])
        sizes = np.diff(np.r_[starts, len(rows[0])])
        roots = rows[5]
        other = np.maximum.reduceat(roots, starts) != np.minimum.reduceat(roots, starts)
        kept = np.repeat(other, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in rows], names)


def _all_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each tile, sorted by size, all pairs of different components that may be alike."""
    few, many = ALIKE
    a: Rows = []
    b: Rows = []
    sizes: Rows = []
    waiting = 0
    for key, n, at, node, root, tile, whole, given in _groups(batches):
        n, at = n.astype(np.int64), at.astype(np.int64)
        starts = _starts(key)
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
            reach = np.searchsorted(n[start:end], many * n[start:end] // few, "right") + start
            sketches = given[start:end].tolist()
            rows = {size: _folded(sketches, size) for size in set(map(len, sketches))}
            for i in range(start, end - 1):
                other = np.arange(i + 1, int(reach[i - start]))
                fits = _may_be_alike(n[i], at[i], n[other], at[other]) & (root[other] != root[i])
                other = other[fits & (whole[other] | (tile[other] != tile[i]))]
                if not len(other):
                    continue
                own = rows[len(sketches[i - start])]
                differ = np.bitwise_count(own[other - start] ^ own[i - start]).sum(axis=1)
                apart = (few + many) * differ.astype(np.int64)
                other = other[apart <= (many - few) * (n[i] + n[other])]
                if len(other):
                    a.append(np.full(len(other), node[i]))
                    b.append(node[other])
                    sizes.append(n[i] + n[other])
                    waiting += len(other)
                if waiting >= PIECE:
                    yield _as_pairs(*map(np.concatenate, (a, b, sizes)))
                    a, b, sizes, waiting = [], [], [], 0
    if waiting:
        yield _as_pairs(*map(np.concatenate, (a, b, sizes)))


def _tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Places dealt to the tiles of their group: pairs of its parts, and each part with itself."""
    parts = F.ceil(F.col("many") / tile).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    dealt = (
        rows.withColumn("tile", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("whole", F.col("other") == F.col("tile"))
    )
    pair = F.xxhash64("shingle", F.least("tile", "other"), F.greatest("tile", "other"))
    key = F.when(F.col("many") <= tile, F.col("shingle")).otherwise(pair)
    return dealt.select(
        key.alias("shingle"), "n", "at", "node", "root", "tile", "whole", "sketch"
    )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets: dict[int, np.ndarray] = {}
        fits = []
        for a, b, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for node, text in ((a, one), (b, two)):
                if node not in sets:
                    sets[node] = shingles(*words_line(text))
            fits.append(alike(sets[a], sets[b]))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(fits))


def _links(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose texts are alike. Only candidates' texts are shuffled, one of each node."""
    often = F.count(F.lit(1)) >= F.min("need")
    met = pairs.groupBy("a", "b").agg(often.alias("often")).filter("often").select("a", "b")
    pairs = stored(met, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = (
        _texts(docs)
        .mapInArrow(_with_nodes, "node long, text binary")
        .join(wanted.hint("merge"), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )
    texts = stored(texts, "texts")
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("one")).hint("merge")
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("two")).hint("merge")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return stored(both.mapInArrow(_verified, PAIRS), "links")


def _with_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each of a task's texts once, with its node."""
    met: set[int] = set()
    for batch in batches:
        nodes = [node_of(words_line(t)[1]) for t in batch.column(1).to_pylist()]
        new = [i for i, node in enumerate(nodes) if not (node in met or met.add(node))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([nodes[i] for i in new], pa.int64()),
                batch.column(1).take(pa.array(new, pa.int64())),
            ],
            ["node", "text"],
        )


def simhash_pairs(known: DataFrame) -> DataFrame:
    """Candidates: texts of one fingerprint, and one text of each of two close fingerprints."""
    own = known.filter("fp IS NOT NULL").select("node", "fp").distinct()
    first = stored(own.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    same = own.join(first.hint("merge"), "fp").select("first", "node")
    close = stored(ball_links(first.select("fp")), "close-prints")
    one, two = (first.select(F.col("fp").alias(n), F.col("first").alias(f"{n}_node")) for n in "ab")
    across = close.join(one.hint("merge"), "a").join(two.hint("merge"), "b")
    both = same.union(across.select("a_node", "b_node")).filter("first <> node").distinct()
    least, greatest = F.least("first", "node"), F.greatest("first", "node")
    return both.select(least.alias("a"), greatest.alias("b"), F.lit(1).alias("need"))


def _sorted(rows: DataFrame, *by: str) -> DataFrame:
    return rows.repartition("shingle").sortWithinPartitions("shingle", *by)


def links(docs: DataFrame, known: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``a`` and ``b`` that join the nodes of similar texts.

    ``known`` has their sketches and fingerprints.
    """
    spark, texts = docs.sparkSession, _texts(docs)
    close = stored(simhash_pairs(known), "simhash-pairs")
    order = spark.sparkContext.broadcast(_levels(texts))
    places = texts.mapInArrow(_places(order), PLACES)
    shared = stored(_sorted(places, "node").mapInArrow(_shared, SHARED), "shared-shingles")
    in_common = F.sum(F.lit(1 << 20) / F.col("n")).alias("common")
    common = shared.groupBy("node").agg(in_common)
    centred = shared.join(common.hint("merge"), "node").select(
        "shingle", "n", "at", "node", "common"
    )
    central = _sorted(centred, "n", "node").mapInArrow(_first_ones, MET)
    first = _links(close.unionByName(central), docs)
    joined = stored(components(first).withColumnRenamed("root", "known_root"), "first-components")
    rooted = shared.join(joined.hint("merge"), "node", "left").select(
        *shared.columns, F.coalesce("known_root", "node").alias("root")
    )
    several = stored(_sorted(rooted).mapInArrow(_several, ROOTED), "several-components")
    sketches = known.filter("sketch IS NOT NULL").groupBy("node").agg(
        F.first("sketch").alias("sketch")
    )
    sketched = several.join(sketches.hint("merge"), "node")
    rest = _sorted(_tiled(sketched, tile), "n", "node").mapInArrow(_all_pairs, MET)
    return first.unionByName(_links(rest, docs))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, ``node`` (of its text) and ``component_id``, the smallest id among near copies."""
    ship(docs.sparkSession)
    known = stored(_texts(docs).mapInArrow(_nodes, NODES), "nodes")
    joined = components(links(docs, known))
    first = known.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = stored(
        first.join(joined.hint("merge"), "node", "left").select(
            "node", "first_id", F.coalesce("root", "node").alias("root")
        ),
        "rooted",
    )
    least = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    named = stored(rooted.join(least, "root").select("node", "component_id"), "components")
    return known.join(named, "node").select("doc_id", "node", "component_id")


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
