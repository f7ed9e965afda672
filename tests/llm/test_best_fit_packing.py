import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerlake.llm import best_fit_packing as packing

TOKENIZER = Tokenizer.from_file(packing.MODEL)
ENCODER = packing.Encoder(packing.MODEL)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check_placed(rows, size):
    """Every sequence is filled from 0 without gaps, up to its size."""
    own = {}
    for r in rows:
        own.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in own.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert 0 < end <= size
    return len(own)


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.MODEL)


TRICKY = [
    "", " ", "Hello, (world)!", "it's don't 'S we'LL", "a'b 'tis", "x12y3", "Ümlaut ﬁ İstanbul",
    "é ́e o ̈", "日本語 テスト", "word.́ a,̈b", "tab\tand\nlines\r\n\x0b\x0c",
    "<|endoftext|> a<|endoftext|>b (<|startoftext|>)", " nbsp   em　",
    "\x1c\x1d\x85", "ſ K Å", "a" * 500, "!?" * 300, "foo<|bar|>", "e-mail@host.org/path?x=1",
]


@pytest.mark.parametrize("text", TRICKY)
def test_words_give_the_ids_of_the_text(encoder, text):
    got = np.frombuffer(encoder.encode([text.encode()])[0], dtype="<u4").tolist()
    assert [*got, 0] == ids_of(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.characters(exclude_categories=["Cs"]),
    st.sampled_from("abcXYZ019 .,;'-\n\t<|>́̈ éß"),
), max_size=60))
def test_any_text(text):
    got = np.frombuffer(ENCODER.encode([text.encode()])[0], dtype="<u4").tolist()
    assert [*got, 0] == ids_of(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "HELD", 5)
    encoder = packing.Encoder(packing.MODEL)
    for _ in range(3):
        for text in TRICKY:
            got = np.frombuffer(encoder.encode([text.encode()])[0], dtype="<u4").tolist()
            assert [*got, 0] == ids_of(text)


class Counted:
    """The library's tokenizer; keeps the parts that it is asked to merge."""

    def __init__(self, tokenizer):
        self.tokenizer, self.parts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.parts += " ".join(texts).split()
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_a_part_is_merged_once():
    """Words with a part in common, in other letters or with other marks, have it merged once."""
    encoder = packing.Encoder(packing.MODEL)
    encoder.merges = Counted(encoder.merges)
    texts = ["Heinea heinea, (heinea) HEINEA! heinea's", "", 'heinea. "heinea" heinea-heinea']
    got = [encoder.encode([t.encode()])[0] for t in texts]
    parts = ["heinea", ",", "(", ")", "!", "'s", ".", '"', "-"]
    assert sorted(encoder.merges.parts) == sorted(parts)
    for text, ids in zip(texts, got, strict=True):
        assert [*np.frombuffer(ids, dtype="<u4").tolist(), 0] == ids_of(text)


ODD = "'s't'r'e'vlmd  \n.,5ÀéßĴŸſŉ×÷İ́<|>\x1f\x00\x7f’日SLŁ"


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(ODD), max_size=30), max_size=6))
def test_parts_of_several_texts(texts):
    got = ENCODER.encode([t.encode() for t in texts])
    assert [[*np.frombuffer(g, dtype="<u4").tolist(), 0] for g in got] == list(map(ids_of, texts))


def test_every_letter_of_two_bytes(encoder):
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}'s" for c in range(0x80, 0x250)]
    got = encoder.encode([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        assert [*np.frombuffer(ids, dtype="<u4").tolist(), 0] == ids_of(text)


def best_two(counts, room):
    pairs = [(a + b, a, b) for a in counts for b in counts
             if a >= b and a + b <= room and counts[a] and counts[b] and (a != b or counts[a] > 1)]
    return max(pairs)[0] if pairs else 0


@given(st.dictionaries(st.integers(1, 40), st.integers(0, 3), max_size=12), st.integers(1, 80))
def test_best_two(counts, room):
    lengths = np.array(sorted(counts), dtype=np.int64)
    got = packing._best_two(counts, lengths, room)
    assert sum(got) == best_two(counts, room)


def test_two_take_the_place_of_the_smallest():
    """6 + 3 leaves a gap of 1; 2 + 2 in the place of 3 fill it."""
    assert packing.fill({6: 1, 3: 1, 2: 2}, np.array([2, 3, 6]), 10) == {6: 1, 2: 2}


@settings(deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_lengths_are_packed_once(counts):
    packed = packing.pack_lengths(counts, 64)
    total = {}
    for use, copies in packed:
        assert 0 < sum(length * n for length, n in use.items()) <= 64 and copies > 0
        for length, n in use.items():
            total[length] = total.get(length, 0) + n * copies
    assert total == counts


def test_nearly_as_few_sequences_as_tokens_need():
    rng = random.Random(1)
    counts = {}
    for _ in range(200_000):
        length = min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1)
        counts[length] = counts.get(length, 0) + 1
    packed = packing.pack_lengths(counts)
    least = -(-sum(length * n for length, n in counts.items()) // 2048)
    assert sum(copies for _, copies in packed) <= 1.002 * least
    assert len(packed) < 4 * 2048


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(2)
    words = "alpha beta gamma delta, Epsilon. zeta's 12".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 400)))) for i in range(200)]
    rows += [(200, None), (201, ""), (None, "no id"), (None, "no id"), (7, "again"), (7, "again")]
    return [*rows, (300, "word " * 9000), (301, "word " * 2047), (302, "word " * 2048)]


def test_pack(spark, documents, mixed):
    docs = documents(mixed, extra={"ids": "x", "length": "x", "task": "x", "offset": "x"})
    cut = packing.pieces(docs)
    rows = packing.place(cut).collect()
    want = sorted(
        (repr(d), start // 2048, start, repr(ids_of(t)[start : start + 2048]))
        for d, t in mixed for start in range(0, len(ids_of(t)), 2048)
    )
    got = sorted(
        (repr(r.doc_id), r.piece, r.start, repr(np.frombuffer(r.ids, "<u4").tolist()))
        for r in rows
    )
    assert got == want
    least = -(-sum(r.length for r in rows) // 2048)
    assert least <= check_placed(rows, 2048) <= least + 1
    told = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packing.place(cut)).collect()}
    for sequence, ids in told.items():
        parts = sorted((r.offset, bytes(r.ids)) for r in rows if r.sequence_id == sequence)
        assert ids == b"".join(p for _, p in parts)


def test_empty(spark, documents):
    assert packing.place(packing.pieces(documents([]))).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = entry.queries()["op13_best_fit_packing"](spark, folder).collect()
    want = {}
    for d in docs:
        ids = np.array(ids_of(d.text), dtype="<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            want[d.doc_id, start // 2048] = (start, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    assert len(rows) == len(want)
    assert check_placed(rows, 2048) <= -(-sum(w[1] for w in want.values()) // 2048) + 1
