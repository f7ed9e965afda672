"""Quality rules: repetition counts, and how far a document's histograms are from its language's.

For each document two histograms are taken, of character classes and of the language's common
words, and compared by Jensen-Shannon distance with the mean histograms of all documents of the
same language. Everything is DataFrame functions. The references are a few dozen sums per
language, and the verdicts follow without a shuffle of rows.

Defined results: a null text is the empty text and fails the base rules (under ten words). A
language that is null or has no word list is compared with all documents of that kind by
character classes only. Texts under ``MIN_CHARS`` characters (``MIN_WORDS`` words) are not judged
by the character (word) histogram. Repeated rows are judged alike; an empty table gives no rows.
Other columns pass through whatever their names, because each row travels as one struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import SPACE, let, stored, text_of, words_of

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "das", "den", "von", "mit", "ist", "nicht", "sich"],
    "en": ["the", "of", "and", "to", "in", "that", "is", "it", "for", "was"],
    "es": ["de", "la", "que", "el", "en", "los", "las", "por", "una", "del"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "que"],
}
OTHER = "other"
N_COMMON = 10

#: Character classes in the order in which they are taken out of the text.
CLASSES = {
    "lower": "[a-z]+",
    "space": f"[{SPACE}]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "point": r"[.,;:!?'\"()\-]+",
    "letter": r"\p{L}+",
}
CLASS_NAMES = [*CLASSES, "rest"]

WINDOW = 5
MIN_WORDS_KEPT = 10
MAX_REPEAT_PERCENT = 20
MIN_CHARS = 200
MIN_WORDS = 30
#: A histogram further than this (0 to 1) rejects by itself.
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.6
#: Both histograms further than these reject together.
BOTH_CLASS_DISTANCE = 0.15
BOTH_WORD_DISTANCE = 0.2
#: Shares are summed as whole millionths, so that sums do not depend on their order.
UNIT = 1_000_000


def repeated_words(words: Column) -> Column:
    """How many words lie in five-word windows that occur twice or more.

    Windows are compared by 64-bit hashes chained over their words. Only texts with an equal
    pair of windows are sorted for the places, whose gaps then give the words covered.
    """
    span = F.lit(WINDOW)
    n_windows = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    shifted = [F.slice(words, k + 1, n_windows).alias(f"w{k}") for k in range(WINDOW)]
    windows = F.transform(F.arrays_zip(*shifted), lambda window: F.xxhash64(window))

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda s, k: F.when(k == 0, span).otherwise(F.least(span, s - F.get(starts, k - 1))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def starts(found: Column) -> Column:
        pairs = F.sort_array(
            F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def twice(placed: Column) -> Column:
            return F.filter(
                placed,
                lambda p, k: (F.get(placed, k - 1)["h"] == p["h"])
                | (F.get(placed, k + 1)["h"] == p["h"]),
            )

        return F.sort_array(F.transform(let(pairs, twice), lambda p: p["i"]))

    return let(
        windows,
        lambda found: F.when(
            F.size(F.array_distinct(found)) == F.size(found), F.lit(0)
        ).otherwise(let(starts(found), covered)),
    )


def features(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """Each row's ``carry`` columns as struct ``row``, with its counts and its language's key."""
    lists = F.create_map(
        *[
            x
            for lang, words in COMMON_WORDS.items()
            for x in (F.lit(lang), F.array(*map(F.lit, words)))
        ]
    )
    df = docs.select(
        F.struct(*([f"`{c}`" for c in carry] if carry else ["*"])).alias("row"),
        text_of("text").alias("text"),
        F.col("lang").alias("lang"),
    ).select(
        "row",
        "text",
        words_of(F.col("text")).alias("words"),
        F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang"))
        .otherwise(F.lit(OTHER))
        .alias("lang"),
    )
    rest, sizes = F.col("text"), []
    for name, pattern in CLASSES.items():
        df = df.withColumn(f"less_{name}", F.regexp_replace(rest, pattern, ""))
        sizes.append(F.length(rest) - F.length(f"less_{name}"))
        rest = F.col(f"less_{name}")
    sizes.append(F.length(rest))
    known = F.coalesce(
        F.try_element_at(lists, F.col("lang")), F.array().cast("array<string>")
    )
    every = sorted({w for words in COMMON_WORDS.values() for w in words})
    common = let(
        F.filter("words", lambda w: w.isin(*every)),
        lambda hits: F.transform(known, lambda k: F.size(F.filter(hits, lambda w: w == k))),
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return (
        df.select(
            "row",
            "lang",
            "words",
            F.array(*sizes).alias("classes"),
            common.alias("common"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("dup"),
        )
        .select(
            "row",
            "lang",
            "classes",
            "common",
            F.size("words").alias("n_words"),
            repeated_words(F.col("words")).alias("n_repeat_words"),
            F.col("dup").alias("n_dup_lines"),
        )
    )


def shares(counts: Column, total: Column) -> Column:
    """Counts as whole millionths of their total."""
    return F.transform(
        counts, lambda n: F.floor(n.cast("long") * F.lit(UNIT) / F.greatest(total, F.lit(1)))
    )


def _histograms(df: DataFrame) -> DataFrame:
    """Character shares, and shares of the common words with all other words in the last bin."""
    n_chars = F.aggregate("classes", F.lit(0), lambda total, n: total + n)
    n_common = F.aggregate("common", F.lit(0), lambda total, n: total + n)
    every = F.concat(F.col("common"), F.array(F.col("n_words") - n_common))
    return df.select(
        "*",
        n_chars.alias("n_chars"),
        shares(F.col("classes"), n_chars).alias("class_shares"),
        shares(every, F.col("n_words")).alias("word_shares"),
    )


def references(judged: DataFrame) -> DataFrame:
    """Per language the summed shares of all documents long enough to be judged.

    One row for each word list and one for all other languages: at most five rows.
    """

    def total(column: str, at: int, enough: Column) -> Column:
        share = F.when(enough, F.get(F.col(column), F.lit(at))).otherwise(0)
        return F.coalesce(F.sum(share), F.lit(0))

    by_class = F.array(
        *[
            total("class_shares", i, F.col("n_chars") >= MIN_CHARS)
            for i in range(len(CLASS_NAMES))
        ]
    )
    by_word = F.array(
        *[
            total("word_shares", i, F.col("n_words") >= MIN_WORDS)
            for i in range(N_COMMON + 1)
        ]
    )
    return judged.groupBy(F.col("lang").alias("ref_lang")).agg(
        by_class.alias("ref_classes"), by_word.alias("ref_words")
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x.cast("double"))


def js_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two lists of weights of equal length.

    The root of the mean divergence of both from their middle; 0 if either has no weight.
    """

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def of(a: Column, b: Column) -> Column:
        def divergence(na: Column, nb: Column) -> Column:
            p = F.zip_with(a, b, lambda x, y: part(x / na, y / nb))
            q = F.zip_with(a, b, lambda x, y: part(y / nb, x / na))
            return F.when(
                (na > 0) & (nb > 0),
                F.sqrt(F.greatest(F.lit(0.0), (_sum(p) + _sum(q)) / 2)),
            ).otherwise(0.0)

        return let(_sum(a), lambda na: let(_sum(b), lambda nb: divergence(na, nb)))

    return let(left, lambda a: let(right, lambda b: of(a, b)))


def judge(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """Every row as struct ``row`` with its counts, distances and the verdict ``kept``.

    ``carry`` names the columns of ``row``, if not all are wanted. Then the counts are stored and
    the texts read once; rows with texts are not stored but read twice, the first time for the
    histograms only.
    """
    judged = _histograms(features(docs, carry))
    if carry:
        judged = stored(judged, "quality")
    # At most one row per word list and one more, so this side is bounded by the lists above.
    near = F.broadcast(references(judged))
    class_at = {name: F.get(F.col("classes"), F.lit(i)) for i, name in enumerate(CLASS_NAMES)}
    failed = (F.col("n_words") < MIN_WORDS_KEPT) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    by_class = F.when(F.col("n_chars") >= MIN_CHARS, F.col("class_distance")).otherwise(0.0)
    by_word = F.when(
        (F.col("n_words") >= MIN_WORDS) & (F.col("lang") != OTHER), F.col("word_distance")
    ).otherwise(0.0)
    far = (
        (by_class > MAX_CLASS_DISTANCE)
        | (by_word > MAX_WORD_DISTANCE)
        | ((by_class > BOTH_CLASS_DISTANCE) & (by_word > BOTH_WORD_DISTANCE))
    )
    # One condition, not two that a filter could be split into: the part that needs no reference
    # would be moved below the counts and compute them again.
    kept = F.greatest(failed.cast("int"), far.cast("int")) == 0
    return (
        judged.join(near, judged["lang"] == F.col("ref_lang"), "left")
        .select(
            "row",
            "lang",
            "n_chars",
            F.col("n_words").cast("long").alias("n_words"),
            (F.col("n_chars") - class_at["space"]).cast("long").alias("word_chars"),
            class_at["symbol"].cast("long").alias("n_symbols"),
            F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
            F.col("n_repeat_words").cast("long").alias("n_repeat_words"),
            js_distance(F.col("class_shares"), F.col("ref_classes")).alias("class_distance"),
            js_distance(F.col("word_shares"), F.col("ref_words")).alias("word_distance"),
        )
        .select("*", failed.alias("base_failed"), kept.alias("kept"))
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows that pass, with the columns they came with."""
    return judge(docs).filter("kept").select("row.*")
