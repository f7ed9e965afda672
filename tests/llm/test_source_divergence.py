import random
import re
from collections import Counter, defaultdict

import pytest

from ledgerlake.llm import source_divergence as divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows):
    docs = [((lang or ""), (source or ""), TERM.findall(lowered(text or "")))
            for text, lang, source in rows]
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= 3}
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in kept)
        total = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def ranked(source, part, values, last):
            order = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:last]
            return [(lang, source, part, item, v, i) for i, (item, v) in enumerate(order, 1)]

        for source, c in counts.items():
            pairs = []
            for other, d in counts.items():
                if other != source:
                    fs = [(share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept]
                    pairs.append((other, sum(fs)))
            found += ranked(source, "pair", pairs, None)
            more = [(t, share(c, t), share(total, t)) for t in kept if c[t]]
            found += ranked(source, "term",
                            [(t, (p - q) ** 2 // q) for t, p, q in more if p > q], 200)
    return sorted(found)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def run(spark, rows, extra="", **options):
    data = [(i, *r, 0) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    for name in extra.split():
        df = df.selectExpr("*", f"'x' AS {name}")
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Ärger", "ÄRGER", "日本"]
    out = []
    for i in range(160):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        text = " ".join(rng.choices(words, k=rng.randint(1, 120)))
        out.append((text, "en" if i % 4 else "fr", source))
    out += [out[0]] * 20  # repeated rows
    out += [(None, None, None), ("", "en", "silent"), ("rare", "xx", "a"), ("other", "xx", "b")]
    out += [("the " * 5000, "en", "hot"), ("1 2 ; 3", "en", "s1"), ("The-end's", "en", None)]
    return out


def test_equals_plain(spark, rows):
    assert run(spark, rows) == plain(rows)


def test_shared_digests_are_split(spark, rows):
    """With few digest bits most terms share one; nothing changes but the way."""
    assert run(spark, rows, bits=4) == plain(rows)


def test_blocks_of_sources(spark, rows, monkeypatch):
    """Pairs within and across blocks, terms in several buckets and passes."""
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 300)
    assert run(spark, rows) == plain(rows)


def test_ties_at_the_last_rank(spark):
    """More terms of one value than ranks: the smallest texts stay."""
    names = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [(" ".join(names), "en", "a")] * 3 + [("common", "en", "b")] * 3
    got = run(spark, rows)
    assert got == plain(rows)
    assert sum(r[1:3] == ("a", "term") for r in got) == divergence.TOP


def test_clashing_columns(spark, rows):
    assert run(spark, rows[:60], extra="term digest n part item value rank") == plain(rows[:60])


def test_empty(spark):
    assert run(spark, []) == []


def test_tasks_hand_on_what_they_hold(rows):
    counts = divergence._Counts(64, False)
    for text, lang, source in rows[:5]:
        counts.add((lang, source), text.encode())
    n = sum(b.column("n").null_count < b.num_rows for b in counts.batches())
    assert n and counts.held() == 0 and list(counts.batches()) == []
