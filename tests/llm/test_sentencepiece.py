import random

import pytest
import sentencepiece

from ledgerlake.llm import sentencepiece_fst as P


@pytest.fixture(scope="module")
def model():
    with open(P.MODEL, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


TEXTS = [
    "", " ", "  ", "hello  world\nfoo  bar 日本 🎉 \t x", "▁ ▁▁", "<s> <0x41> </s>", "é\u0301ß Ω",
    "internationalization antidisestablishmentarianism", "a" * 5000, "thththeheerer" * 400,
    "日本語" * 300, "   lead and trail   ", "x\u0000y\u2028z",
]


def test_equals_the_library(model, library):
    machine = P.Machine.of(model)
    random.seed(14)
    parts = [" ", "  ", "a", "th", "the", "\n", "日本", "🎉", "é", "1", "00", "ing", "▁", "<s>", ".", "Ω"]
    texts = TEXTS + ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(3000)]
    for text in texts:
        ids = machine.ids(text)
        assert ids == library.encode(text), text
        assert machine.decode(ids) == text.replace("▁", " ")


def test_pairs_name_what_merging_gives(model):
    machine = P.Machine.of(model)
    for word in ("▁therheor", "▁ististed", "▁Anhation,"):
        assert [machine.pieces[i] for i in machine.bpe_path(word)] == machine.merged(word)


def test_unigram_path_has_least_cost():
    pieces = ["<unk>", "▁", "a", "b", "ab", "abc", "c", "▁a"] + [f"<0x{i:02X}>" for i in range(256)]
    scores = [0.0, -1.0, -2.0, -2.5, -3.0, -9.0, -1.5, -2.2] + [0.0] * 256
    kinds = [P.UNKNOWN] + [P.NORMAL] * 7 + [P.BYTE] * 256
    machine = P.Machine(pieces, scores, kinds, bpe=False, prefix=True)

    def cheapest(word):
        best = {0: (0.0, [])}
        for at in range(len(word)):
            for i in range(1, 8):
                if word.startswith(pieces[i], at):
                    end, cost = at + len(pieces[i]), best[at][0] - scores[i]
                    if end not in best or cost < best[end][0]:
                        best[end] = (cost, best[at][1] + [i])
        return best[len(word)][1]

    random.seed(15)
    for _ in range(200):
        word = "▁" + "".join(random.choices("abc", k=random.randint(0, 12)))
        assert machine.unigram_path(word) == cheapest(word)
    assert machine.decode(machine.ids("aé b")) == "aé b"


def test_table(spark, documents, clashing, library):
    rows = [(1, None), (2, ""), (3, "the the"), (3, "the the"), (None, "x" * 30_000)]
    frame = documents(rows, clashing)
    machine = P.load(spark)
    decoded = P.decode(P.encode(frame, machine), machine)
    for r in decoded.collect():
        text = r.row.text or ""
        assert list(r.ids) == library.encode(text) and r.n_ids == len(r.ids)
        assert r.decoded == text
        assert r.row["a.b"] == "x"
    checked = P.encode_checked(frame, machine, carry=["doc_id"])
    assert checked.schema["row"].dataType.names == ["doc_id"]
    assert sorted((str(r.row.doc_id), r.n_ids, list(r.ids), r.given_back) for r in checked.collect()) == (
        sorted((str(r.row.doc_id), r.n_ids, list(r.ids), True) for r in decoded.collect())
    )
    empty = P.decode(P.encode(documents([]), machine), machine)
    assert empty.count() == 0


def test_remembering_is_bounded(model, monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 50)
    machine = P.Machine.of(model)
    text = " ".join(f"word{i}" for i in range(500))
    again = P.Machine.of(model).encode(text)
    assert machine.encode(text) == again
    assert len(machine.words) <= 50 and len(machine.words.older) <= 50
    assert len(machine.pairs) <= 50


def test_unknown_model_kinds_are_refused():
    with pytest.raises(ValueError, match="identity normaliser"):
        P.Machine.of(b"")
