"""Source divergence audit: which terms a source uses more than its language, and how sources differ.

Terms are counted by language and source under 64-bit digests, and only digests are shuffled with
the counts. Each task tells a term's text once beside the counts; the least and the greatest text
of every kept digest are compared, and where they differ two terms share a digest, which is then
counted anew by text and split. Texts come back by a join for the rows that are put out, and for
those that tie with the last of them.

How far two sources part is a sum over all kept terms. Terms are dealt into buckets, in which
every source has one number per term, and a task sums over a block of sources by arrays, so no
pair of rows is made for each term: what leaves a task is one row per pair of sources. Terms that
neither source of a pair uses count alike and are added by their number.

A count is summed per task before it is shuffled, keys are spread by digest, and no source, term
or language is gathered in one task.

Defined results: null text, language or source is ''. Every row is a document, so that repeated
rows count. Languages and sources without terms stay: their terms have count 0, and where a
language keeps no term its pairs have value 0. Values are exact in whole numbers. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.shared import ship, stored, text_of

#: A kept term is in at least this many documents of its language.
MIN_DOCS = 3
#: Terms told per language and source.
TOP = 200
#: What shares are expressed in.
UNIT = 1_000_000_000
#: Digest bits. Fewer make terms share digests, as tests want.
BITS = 64
#: Distinct terms, over groups, that a task counts before it hands them on.
HELD = 1 << 20
#: Sources whose pairs a task sums at once, and rows it should be given.
BLOCK = 64
BLOCK_ROWS = 1 << 17
#: Terms that are worked on at once.
TERMS = 1 << 12

COUNTED = "lang string, source string, digest long, n long, docs long, term string"
SUMS = "lang string, s int, t int, value long, terms long"

#: Bytes of terms, A-Z as a-z, and a blank for all others.
_TERM_BYTES = bytes(
    c if c >= 128 or chr(c).islower() else ord(chr(c).lower()) if chr(c).isupper() else 32
    for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """A text's terms; a byte of a longer UTF-8 character is always part of one."""
    return text.translate(_TERM_BYTES).split()


def digest_of(term: bytes, bits: int = BITS) -> int:
    value = xxhash.xxh64_intdigest(term) & ((1 << bits) - 1)
    return value - (1 << 64) if value >> 63 else value


class _Counts:
    """What a task has counted: per language and source, a term's occurrences and documents."""

    def __init__(self, bits: int, texts: bool):
        self.bits, self.texts = bits, texts
        self.n: dict[tuple[str, str], Counter] = {}
        self.docs: dict[tuple[str, str], Counter] = {}

    def add(self, group: tuple[str, str], text: bytes) -> None:
        terms = terms_of(text)
        if group not in self.n:
            self.n[group], self.docs[group] = Counter(), Counter()
        self.n[group].update(terms)
        self.docs[group].update(set(terms))

    def held(self) -> int:
        return sum(map(len, self.n.values()))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Counts by digest, with the text if asked for; each text once; groups without terms."""
        digests: dict[bytes, int] = {}
        for group, n in self.n.items():
            terms = list(n) or [None]
            for term in terms:
                if term is not None and term not in digests:
                    digests[term] = digest_of(term, self.bits)
            of = [digests.get(t) for t in terms]
            texts = terms if self.texts else [None] * len(terms)
            docs = map(self.docs[group].__getitem__, terms)
            yield _counted(*group, of, map(n.__getitem__, terms), docs, texts)
        if not self.texts and digests:
            none = [None] * len(digests)
            yield _counted(None, None, list(digests.values()), none, none, list(digests))
        self.n, self.docs = {}, {}


def _counted(lang, source, digests, n, docs, terms) -> pa.RecordBatch:
    size = len(digests)
    arrays = [
        pa.array([lang] * size, pa.string()),
        pa.array([source] * size, pa.string()),
        pa.array(digests, pa.int64()),
        pa.array(list(n), pa.int64()),
        pa.array(list(docs), pa.int64()),
        pa.array(terms, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(
        arrays, ["lang", "source", "digest", "n", "docs", "term"]
    )


def _count(bits: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(bits, texts)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
            for lang, source, text in zip(*columns, strict=True):
                counts.add((lang, source), text)
            if counts.held() > HELD:
                yield from counts.batches()
        yield from counts.batches()

    return run


def counted(docs: DataFrame, bits: int = BITS, texts: bool = False) -> DataFrame:
    """What tasks have counted: terms per group, groups without terms, and every term's text.

    Texts are rows of their own, without a language, or with ``texts`` part of the counts.
    """
    rows = docs.select(
        text_of("lang").alias("lang"),
        text_of("source").alias("source"),
        text_of("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(_count(bits, texts), COUNTED)


def _kept(counts: DataFrame, *key: str) -> DataFrame:
    """Counts of the terms in enough documents; one row of each term and language is ``first``."""
    term = Window.partitionBy("lang", *key)
    return (
        counts.repartition("lang", "digest")
        .groupBy("lang", "source", *key)
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumn("docs", F.sum("docs").over(term))
        .filter(F.col("docs") >= MIN_DOCS)
        .withColumn("all_n", F.sum("n").over(term))
        .withColumn("first", F.col("source") == F.min("source").over(term))
        .drop("docs")
    )


def _split(docs: DataFrame, bits: int, shared: DataFrame) -> DataFrame:
    """Counts of the terms that share a digest, by text; ``part`` numbers a digest's texts."""
    counts = counted(docs, bits, texts=True).join(shared, "digest", "left_semi")
    parts = F.dense_rank().over(Window.partitionBy("digest").orderBy("term"))
    return _kept(counts, "digest", "term").withColumn("part", parts)


def kept_terms(
    docs: DataFrame, counts: DataFrame, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms per language and source, and the terms' texts.

    A term is known by ``digest`` and ``part``, which is 0 unless digests are shared.
    """
    by_digest = counts.filter("lang IS NOT NULL AND digest IS NOT NULL")
    kept = _kept(by_digest, "digest").withColumn("part", F.lit(0))
    kept = stored(kept, "kept-terms")
    told = (
        counts.filter("lang IS NULL")
        .repartition("digest")
        .groupBy("digest")
        .agg(F.min("term").alias("term"), F.max("term").alias("last"))
        .join(kept.select("digest").distinct().hint("merge"), "digest", "left_semi")
    )
    texts = stored(told.withColumn("part", F.lit(0)), "term-texts")
    shared = texts.filter("term <> last").select("digest")
    texts = texts.drop("last")
    if shared.isEmpty():
        return kept, texts
    split = stored(_split(docs, bits, shared), "split-terms")
    kept = kept.join(shared, "digest", "left_anti").unionByName(split.drop("term"))
    own = split.select("digest", "part", "term").distinct()
    return kept, texts.join(shared, "digest", "left_anti").unionByName(own)


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + terms)), exact for any 64-bit count."""
    whole = f"DECIMAL({len(str(UNIT))}, 0)"
    product = F.lit(UNIT).cast(whole) * (n + 1).cast("decimal(19, 0)")
    return 1 + F.call_function("div", product, (total + terms).cast("decimal(19, 0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_sizes(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """Every language and source with its sums, its number in the language and its least share."""
    groups = counts.filter("lang IS NOT NULL").select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("group_n"), F.count_if("first").alias("firsts")
    )
    lang = Window.partitionBy("lang")
    sized = (
        groups.join(sums, ["lang", "source"], "left")
        .withColumn("group_n", F.coalesce("group_n", F.lit(0)))
        .withColumn("lang_n", F.sum("group_n").over(lang))
        .withColumn("v", F.sum(F.coalesce("firsts", F.lit(0))).over(lang))
        .withColumn("at", F.row_number().over(lang.orderBy("source")) - 1)
        .withColumn("sources", F.count("*").over(lang))
        .drop("firsts")
    )
    none = F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("group_n"), F.col("v")))
    return stored(sized.withColumn("unused", none), "groups")


def term_part(kept: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """The terms that each group uses more than its language, up to ``TOP``."""
    q = _share(F.col("all_n"), F.col("lang_n"), F.col("v"))
    scored = (
        kept.join(groups, ["lang", "source"])
        .select(
            "lang", "source", "digest", "part",
            _share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"), q.alias("q"),
        )
        .filter("p > q")
        .select("lang", "source", "digest", "part", _apart(F.col("p"), F.col("q")).alias("value"))
    )
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = scored.withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= TOP)
    least = best.groupBy("lang", "source").agg(F.min("value").alias("least"))
    least = stored(least, "least-values")
    may = stored(
        scored.join(least, ["lang", "source"]).filter("value >= least").drop("least"), "best-terms"
    )
    named = may.join(texts, ["digest", "part"]).withColumnRenamed("term", "item")
    by_text = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = named.withColumn("rank", F.row_number().over(by_text)).filter(F.col("rank") <= TOP)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _block_sums(rows: pa.Table, block: int) -> pa.Table:
    """Of a bucket of terms and one or two blocks of sources: the sums over the bucket's terms."""
    source, p = rows.column("at").to_numpy(), rows.column("p").to_numpy()
    digest, part = rows.column("digest").to_numpy(), rows.column("part").to_numpy()
    whole = part < 0  # a source's share of terms that it does not use
    ids, at = np.unique(source, return_inverse=True)
    unused = np.zeros(len(ids), dtype=np.int64)
    unused[at[whole]] = p[whole]
    at, p, digest, part = (x[~whole] for x in (at, p, digest, part))
    order = np.lexsort((part, digest))
    at, p, digest, part = (x[order] for x in (at, p, digest, part))
    new = np.r_[True, (digest[1:] != digest[:-1]) | (part[1:] != part[:-1])][: len(p)]
    term = np.cumsum(new) - 1
    terms = int(term[-1]) + 1 if len(term) else 0
    sums = np.zeros((len(ids), len(ids)), dtype=np.int64)
    for low in range(0, terms, TERMS):
        high = min(terms, low + TERMS)
        mine = slice(*np.searchsorted(term, [low, high]))
        shares = np.repeat(unused[:, None], high - low, axis=1)
        shares[at[mine], term[mine] - low] = p[mine]
        for s in range(len(ids)):
            gap = shares[s] - shares
            sums[s] += (gap * gap // shares).sum(axis=1)
    s, t = (x.ravel() for x in np.indices(sums.shape))
    blocks = ids // block
    # Of two blocks, the pairs within one are another group's.
    wanted = (s != t) & ((blocks[s] != blocks[t]) | (blocks[0] == blocks[-1]))
    s, t = s[wanted], t[wanted]
    return pa.table(
        {
            "lang": pa.array([rows.column("lang")[0].as_py()] * len(s), pa.string()),
            "s": ids[s].astype(np.int32),
            "t": ids[t].astype(np.int32),
            "value": sums[s, t],
            "terms": np.full(len(s), terms, dtype=np.int64),
        }
    )


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """How far every group is from each other source of its language."""
    block = BLOCK
    blocks = -(-groups.agg(F.max("sources")).first()[0] // block)
    buckets = max(1, -(-kept.count() * blocks // BLOCK_ROWS))
    share = _share(F.col("n"), F.col("group_n"), F.col("v"))
    bucket = F.pmod(F.xxhash64("digest", "part"), F.lit(buckets)).cast("int")
    used = kept.join(groups, ["lang", "source"]).select(
        "lang", "at", "sources", "digest", "part", share.alias("p"), bucket.alias("bucket")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    unused = groups.filter("v > 0").select(
        "lang", "at", "sources", F.lit(0).cast("long").alias("digest"), F.lit(-1).alias("part"),
        F.col("unused").alias("p"), every.alias("bucket"),
    )
    own = F.floor(F.col("at") / block).cast("int")
    others = F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / block).cast("int"))
    dealt = (
        used.unionByName(unused)
        .withColumn("other", F.explode(others))
        .withColumn("low", F.least(own, "other"))
        .withColumn("high", F.greatest(own, "other"))
        .select("lang", "low", "high", "bucket", "at", "digest", "part", "p")
    )
    sums = (
        dealt.groupBy("lang", "low", "high", "bucket")
        .applyInArrow(lambda rows: _block_sums(rows, block), SUMS)
        .groupBy("lang", "s", "t")
        .agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    )
    sums = stored(sums, "pair-sums")
    one = groups.select("lang", "source", F.col("at").alias("s"), "v", F.col("unused").alias("p"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("t"),
                        F.col("unused").alias("q"))
    rest = (F.col("v") - F.coalesce("terms", F.lit(0))) * _apart(F.col("p"), F.col("q"))
    value = F.coalesce("value", F.lit(0)) + F.coalesce(rest, F.lit(0))
    pairs = (
        one.join(two, "lang")
        .filter("s <> t")
        .join(sums, ["lang", "s", "t"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    )
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(group))


def audit(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank``."""
    ship(docs.sparkSession)
    counts = stored(counted(docs, bits), "counted-terms")
    kept, texts = kept_terms(docs, counts, bits)
    groups = group_sizes(counts, kept)
    if groups.isEmpty():
        none = "lang string, source string, part string, item string, value long, rank int"
        return docs.sparkSession.createDataFrame([], none)
    return pair_part(kept, groups).unionByName(term_part(kept, groups, texts))
