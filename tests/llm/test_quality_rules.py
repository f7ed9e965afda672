import math
import random

import brute
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import quality_rules as Q

CLEAN = (
    "The house of the old family stood in a quiet street, and the garden was full of trees that"
    " gave shade in summer. It is said that for many years nobody lived in the rooms of the upper"
    " floor, and the stairs to it were closed."
)


def judged(frame):
    return {r.row.doc_id: r for r in Q.judge(frame).collect()}


def corpus():
    random.seed(9)
    words = ["the", "of", "and", "x", "Word,", "é", "12", "a|b", "##"]
    docs = []
    for i in range(60):
        text = ""
        for _ in range(random.randint(0, 60)):
            text += random.choice(words) + random.choice([" ", "  ", "\n", "\t", "\u00a0", "\n\n"])
        docs.append((i, text))
    block = "one two three four five six seven"
    return [
        *docs, (100, None), (101, ""), (102, " \n\t"), (103, f"{block} {block}"),
        (104, "a a a a a a a"), (105, "a b c d"), (106, f"{block}\n{block}\n{block} \n"),
        (107, CLEAN), (108, CLEAN * 40), (109, "word " * 20_000),
    ]


def test_counts_equal_brute_force(documents, clashing):
    docs = corpus()
    got = judged(documents(docs, clashing))
    for doc_id, text in docs:
        r = got[doc_id]
        counts = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words
        assert counts == brute.base_quality(text), doc_id
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.kept and r.base_failed)


def test_distance(spark):
    def expected(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        parts = [
            x * math.log2(2 * x / (x + y)) for a, b in ((p, q), (q, p))
            for x, y in zip(a, b, strict=True) if x
        ]
        return math.sqrt(max(0.0, sum(parts) / 2))

    pairs = [([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 1]), ([2, 4], [1, 2]), ([0, 5, 1], [7, 0, 1])]
    frame = spark.createDataFrame([*pairs, ([0, 0], [1, 1])], "a array<long>, b array<long>")
    got = [r[0] for r in frame.select(Q.js_distance(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([*[expected(*p) for p in pairs], 0.0])
    assert got[1] == pytest.approx(1.0)


def test_verdicts(documents):
    """Junk goes, clean documents of every kind stay."""
    random.seed(10)
    sentences = CLEAN.replace(".", "").replace(",", "").split()
    clean = [(i, " ".join(random.sample(sentences, 30))) for i in range(40)]
    symbols = " ".join(f"{w}%%%&&&" for w in sentences)
    docs = documents(
        [*clean, (100, symbols), (101, " ".join(sentences).upper()), (102, "too short"),
         (103, " ".join(sentences[:12])), (104, " ".join(sentences[:30]), None)]
    )
    got = judged(docs)
    assert all(got[i].kept for i, _ in clean)
    assert [got[i].kept for i in (100, 101, 102, 103, 104)] == [False, False, False, True, True]


def test_kept_rows_keep_their_columns(documents, clashing):
    frame = documents([(1, CLEAN), (1, CLEAN), (2, None), (None, CLEAN)], clashing)
    kept = Q.keep(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]
    assert Q.keep(documents([])).count() == 0


def test_main_path_runs_no_python(documents):
    plan = Q.keep(documents([(1, CLEAN)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
