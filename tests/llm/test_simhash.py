import random

import brute
import numpy as np

from ledgerlake.llm import simhash as S
from ledgerlake.llm.components import components


def flipped(value, bits):
    for bit in bits:
        value ^= 1 << bit
    return value


def array(values):
    return np.array(values, dtype=np.uint64)


def test_fingerprint():
    random.seed(2)
    words = ["The", "a", "É", "x" * 30, "b,", "zZ"]
    for n in (0, 1, 2, 3, 4, 40):
        for _ in range(10):
            text = random.choice(["", " ", "\n"]) + " ".join(random.choices(words, k=n))
            assert S.fingerprint(text.encode()) == brute.fingerprint(text)
    long = " ".join(random.choices(words, k=S.PIECE + 10))
    assert S.fingerprint(long.encode()) == brute.fingerprint(long)
    assert S.fingerprint("a\xa0b c".encode()) == brute.fingerprint("a\xa0b c")


def test_close_fingerprints_share_a_variant():
    random.seed(3)
    for _ in range(300):
        a = random.getrandbits(64)
        b = flipped(a, random.sample(range(64), random.randint(0, 3)))
        mine, others = (set(S.variants(array([x]))[0].tolist()) for x in (a, b))
        assert mine & others


def test_large_groups_are_linked_without_all_pairs():
    """Members of one variant's group; pairs that differ in the same outer bit meet elsewhere."""
    random.seed(4)
    for _ in range(20):
        band = random.randrange(len(S.BANDS))
        by, below = S._rotations()[band]
        rest = random.getrandbits(below)
        reach = random.randint(4, S.BANDS[band])
        turned = {
            (rest ^ (1 << flip if flip < below else 0)) | random.getrandbits(reach) << below
            for flip in [random.randrange(below + 9) for _ in range(200)]
        }
        prints = S._rotated(array(sorted(turned)), (64 - by) % 64)
        links = S.link_group(prints, rest | band << S.BAND_AT)
        assert len(links) < len(prints)
        assert all(np.bitwise_count(prints[a] ^ prints[b]) <= 3 for a, b in links)
        part = brute.groups(len(prints), links)
        outside = ((S._rotated(prints, by) ^ np.uint64(rest)) & np.uint64((1 << below) - 1)).tolist()
        for i in range(len(prints)):
            for j in range(i):
                close = np.bitwise_count(prints[i] ^ prints[j]) <= 3
                if close and not (outside[i] == outside[j] != 0):
                    assert part[i] == part[j]


def test_links_join_what_all_pairs_join(spark):
    random.seed(5)
    prints = {random.getrandbits(64) for _ in range(200)}
    for center in random.sample(sorted(prints), 5):
        for _ in range(150):  # dense balls and chains
            center = flipped(center, random.sample(range(64), random.randint(1, 4)))
            prints.add(center)
    ball = random.getrandbits(64)
    prints |= {flipped(ball, random.sample(range(64), 1)) for _ in range(64)} | {ball}
    prints |= {ball ^ n for n in range(300)}
    prints = sorted(prints)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    place = {s[0]: i for i, s in enumerate(signed)}
    frame = spark.createDataFrame(signed, "fp long").repartition(4)
    found = {(place[r.a], place[r.b]) for r in S.links(frame).collect()}
    assert all((prints[a] ^ prints[b]).bit_count() <= 3 for a, b in found)
    every = [
        (i, j)
        for i in range(len(prints))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 3
    ]
    assert brute.groups(len(prints), found) == brute.groups(len(prints), every)


def test_components(spark):
    random.seed(6)
    edges = [(i, i + 1) for i in range(100, 160)]  # a chain
    edges += [(1, i) for i in range(200, 260)] + [(i, 1) for i in range(200, 230)]  # a star
    edges += [(random.randint(300, 400), random.randint(300, 400)) for _ in range(60)]
    edges += [(7, 7), (-5, 500)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    roots = brute.groups(len(nodes), [(at[a], at[b]) for a, b in edges])
    want = {x: nodes[roots[i]] for x, i in at.items() if nodes[roots[i]] != x}
    assert {r.node: r.root for r in got} == want
    assert len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def corpus():
    random.seed(7)
    base = [f"w{random.randint(0, 400)}" for _ in range(300)]
    docs = [(1000 + i, " ".join(random.choices(base, k=random.randint(1, 80)))) for i in range(60)]
    docs += [(2000 + i, " ".join(base)) for i in range(40)]  # a group of exact copies
    for i in range(40):  # and of near ones
        words = list(base)
        for _ in range(i % 4):
            words[random.randrange(len(words))] = "changed"
        docs.append((500 + i, " ".join(words)))
    return [*docs, (3, ""), (9, None), (4, " \n"), (11, "one"), (12, "ONE")]


def test_near_duplicates_equal_brute_force(documents, clashing):
    docs = corpus()
    got = S.near_duplicates(documents(docs, clashing)).collect()
    prints = {d: brute.fingerprint(t) for d, t in docs}
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == brute.near_components(docs)


def test_hex(spark):
    frame = spark.createDataFrame([(-1,), (0,), (255,)], "fp long")
    got = [r[0] for r in frame.select(S.hex_of("fp")).collect()]
    assert got == ["f" * 16, "0" * 16, "0" * 14 + "ff"]


def test_keep_one(documents, clashing):
    rows = [(5, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (8, "other text"),
            (None, "alone here"), (7, None), (6, "")]
    frame = documents(rows, clashing)
    kept = S.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("2", "a b c d"), ("2", "a b c d"), ("6", ""), ("8", "other text"),
        ("None", "a b c d"), ("None", "alone here"),  # rows of one id, if only of none
    ]
    assert S.keep_one(documents([])).count() == 0
