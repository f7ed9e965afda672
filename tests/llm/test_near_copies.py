"""Near copies of the pipeline against all pairs, at similarities from 0.8 up."""

import random

import numpy as np
import pytest

import corpus_pipeline as P
from ledgerlake.llm import near_copies, simhash


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def kept_ids(docs):
    root = {d: d for d, _ in docs}
    for i, (a, one) in enumerate(docs):
        for b, two in docs[:i]:
            if root[a] != root[b] and similar(one, two):
                low, high = sorted((root[a], root[b]))
                root = {d: low if r == high else r for d, r in root.items()}
    return set(root.values())


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=30)
    docs = []
    for base in range(40):
        text = rng.choices(words, k=rng.randint(40, 400))
        docs.append((10 * base, text))
        for copy in range(1, 4):  # up to one changed word in 40: 0.8 is crossed about there
            changed = list(text)
            for at in rng.sample(range(len(text)), max(1, len(text) * copy // 90)):
                changed[at] = "changed"
            docs.append((10 * base + copy, changed))
    docs += [(1000 + i, passage + rng.choices(words, k=25)) for i in range(60)]
    docs += [(2000 + i, rng.choices(words, k=3)) for i in range(5)]
    large = rng.choices(words, k=200)
    for i in range(80):  # a large group of near copies
        changed = list(large)
        changed[rng.randrange(200)] = f"x{i}"
        docs.append((3000 + i, changed))
    return [(d, " ".join(t)) for d, t in docs] + [(4000, ""), (4001, None), (4002, " \n")]


def test_pairs_from_four_fifths_up_are_found(spark, documents):
    docs = corpus()
    planted = [
        len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b))
        for (_, a), (_, b) in zip(docs[0:160:4], docs[1:160:4], strict=True)
    ]
    assert sum(0.8 <= p < 0.95 for p in planted) > 10
    got = {r.doc_id for r in P.near_copies(spark, documents(docs).repartition(5), "").collect()}
    assert got == kept_ids(docs)


@pytest.fixture
def candidates(monkeypatch):
    """The numbers of rows that were candidates, in the order of the rounds."""
    counts, links = [], near_copies._links

    def counted(pairs, docs):
        counts.append(pairs.count())
        return links(pairs, docs)

    monkeypatch.setattr(near_copies, "_links", counted)
    return counts


def test_copies_around_a_hub(spark, documents, candidates):
    """2,000 texts alike to one and not to each other: candidates grow with texts, not pairs."""
    rng = random.Random(8)
    hub = [f"w{i}" for i in range(60)]
    docs = [(0, " ".join(hub))]
    for i in range(1, 2000):
        changed = list(hub)
        changed[rng.randrange(5, 55)] = f"x{i}"
        docs.append((i, " ".join(changed)))
    assert similar(docs[0][1], docs[1][1]) and not similar(docs[1][1], docs[2][1])
    got = near_copies.near_duplicates(documents(docs)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 2000
    places = 15 * 2000
    assert candidates[0] <= 2 * places and candidates[1] <= 2000


def test_groups_that_share_passages(spark, documents, candidates):
    """Texts that share half of their words with all others are no candidates of the last round."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    passage = rng.choices(words, k=60)
    docs = [(i, " ".join(passage + rng.choices(words, k=60))) for i in range(600)]
    docs += [(1000 + i, " ".join(rng.choices(words, k=200))) for i in range(50)]
    got = near_copies.near_duplicates(documents(docs)).collect()
    assert all(r.component_id == r.doc_id for r in got)
    assert candidates[1] < 600


def test_tiles_change_nothing(spark, documents, monkeypatch):
    docs = corpus()
    frame = documents(docs)
    known = near_copies.stored(
        near_copies._texts(frame).mapInArrow(near_copies._nodes, near_copies.NODES), "nodes"
    )
    monkeypatch.setattr(near_copies, "_first_ones", lambda batches: iter([]))

    def linked(tile):
        return {tuple(r) for r in near_copies.links(frame, known, tile).collect()}

    whole = linked(4096)
    assert whole and linked(5) == whole


def test_sketches_lose_no_pair():
    rng = np.random.default_rng(4)
    for size in (1, 3, 40, 500, 3000):
        one = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for share in (1.0, 0.95, 0.9, 0.85, 0.5):
            kept = one[: max(1, int(size * share))]
            more = rng.integers(0, 2**63, size // 8).astype(np.uint64)
            two = np.unique(np.concatenate([kept, more]))
            few, many = sorted((near_copies.sketch(one), near_copies.sketch(two)), key=len)
            if len(many) > 2 * len(few):
                continue
            a, b = near_copies._folded([few, many], len(few))
            differ = int(np.bitwise_count(a ^ b).sum())
            assert differ <= len(np.setxor1d(one, two))
            assert not near_copies.alike(one, two) or 9 * differ <= len(one) + len(two)


def test_ids_nulls_repeated_rows_and_long_texts(spark, documents, clashing):
    long_text = " ".join(f"w{i}" for i in range(120_000))
    docs = [(1, long_text), (2, long_text + " end"), (3, "a b c d e f"), (3, "other words here"),
            (None, "a b c d e f"), (None, None), (5, ""), (3, "a b c d e f")]
    frame = documents(docs, extra=clashing)
    got = {(r.doc_id, r.node): r.component_id for r in near_copies.near_duplicates(frame).collect()}
    assert sorted(got.values(), key=repr) == sorted([1, 1, 3, 3, 3, 5, 5], key=repr)
    kept = near_copies.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in kept.collect() if r.doc_id) == sorted(
        (d, len(t or "")) for d, t in docs if d in (1, 3, 5)
    )


def test_empty(spark, documents):
    assert near_copies.near_duplicates(documents([])).collect() == []


def test_simhash_finds_all_close_fingerprints(spark, documents):
    """The candidates join the texts that chains of fingerprints within three bits join."""
    docs = documents(corpus())
    known = near_copies._texts(docs).mapInArrow(near_copies._nodes, near_copies.NODES)
    prints = {}
    for _, text in corpus():
        words, line = near_copies.words_line((text or "").encode())
        if words:
            hashes = near_copies.shingles(words, line)
            set_bits = [sum(int(h) >> i & 1 for h in hashes) for i in range(64)]
            prints[near_copies.node_of(line)] = sum(
                1 << i for i, n in enumerate(set_bits) if 2 * n > len(hashes)
            )
    pairs = near_copies.simhash_pairs(known).collect()
    assert all((prints[p.a] ^ prints[p.b]).bit_count() <= 3 and p.need == 1 for p in pairs)

    def joined(links):
        root = {n: n for n in prints}
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = {n: low if r == high else r for n, r in root.items()}
        return root

    nodes = list(prints)
    close = [
        (a, b) for i, a in enumerate(nodes) for b in nodes[:i]
        if (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    assert len(close) > 20
    assert joined((p.a, p.b) for p in pairs) == joined(close)


def test_the_stage_takes_simhash_candidates(spark, documents, monkeypatch):
    """Similar texts that only SimHash proposes are one group, and chance neighbours are not."""
    seen = []
    pairs = near_copies.simhash_pairs
    monkeypatch.setattr(near_copies, "simhash_pairs", lambda k: seen.append(pairs(k)) or seen[-1])
    nothing = lambda batches: iter(())
    monkeypatch.setattr(near_copies, "_first_ones", nothing)
    monkeypatch.setattr(near_copies, "_all_pairs", nothing)
    rng = random.Random(8)
    text = [f"w{rng.randrange(900)}" for _ in range(3000)]
    other = [f"w{rng.randrange(900)}" for _ in range(3000)]
    docs = [(1, " ".join(text)), (2, " ".join([*text[:-1], "end"])), (3, " ".join(other))]
    kept = P.near_copies(spark, documents(docs), "")
    assert {r.doc_id for r in kept.collect()} == {1, 3} and seen


def test_close_fingerprints_meet_by_ball_hashing(spark, documents, monkeypatch):
    """The stage links fingerprints through op4's variants; without them close ones stay apart."""
    rng = random.Random(11)
    text = [f"w{rng.randrange(900)}" for _ in range(3000)]
    docs = documents([(1, " ".join(text)), (2, " ".join([*text[:-1], "end"]))])
    known = near_copies._texts(docs).mapInArrow(near_copies._nodes, near_copies.NODES)
    prints = [r.fp for r in known.collect()]
    assert 0 < ((prints[0] ^ prints[1]) & (1 << 64) - 1).bit_count() <= 3
    assert near_copies.simhash_pairs(known).count() == 1
    monkeypatch.setattr(simhash, "_emit", lambda batches: iter(()))
    assert near_copies.simhash_pairs(known).count() == 0
