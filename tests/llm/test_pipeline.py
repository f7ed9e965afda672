"""Every stage of the pipeline against a plain version, on documents with planted cases."""

import random
import re

import brute
import pytest
import sentencepiece

import corpus_pipeline as P
from ledgerlake.llm import quality_rules, sentencepiece_fst

WORDS = (
    "the of and to in that is it for was house garden river stone quiet bright winter summer road"
    " letter window table music answer number morning evening story travel market village forest"
    " bridge simple common former steady silver copper wooden broken gentle narrow distant"
).split()


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choices(WORDS, k=n))


ITEM = " ".join(random.Random(99).sample(WORDS, 24))
SHARED = "this passage of over twenty characters repeats across documents"


def corpus():
    docs = [(i, f"{prose(i)}\nown line {i}") for i in range(40)]
    docs += [(100 + i, prose(1000)) for i in range(12)]  # exact copies
    near = prose(1000, 400).split()
    docs += [(200, " ".join(near)), (201, " ".join([*near[:-1], "changed"]))]  # near copies
    docs += [(300 + i, f"{prose(300 + i)}\n{SHARED}\n{prose(400 + i)}") for i in range(5)]
    docs += [(400, f"{prose(400, 60)} {ITEM} {prose(401, 60)}")]  # a benchmark passage
    words = ITEM.split()
    docs += [(401, f"{prose(402, 60)} {' '.join(words[12:])} next {' '.join(words[:12])} end")]
    docs += [(500, "%%% &&& ### " * 40), (501, "too short"), (502, None), (503, "")]
    return docs


@pytest.fixture
def folder(spark, documents, clashing, tmp_path):
    documents(corpus(), clashing).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, ITEM), (2, "never seen words of an item here")],
                                  "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_equal_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {}
    for name, stage in P.STAGES[:4]:
        out = P.stored(stage(spark, docs, folder), name)
        assert out.columns == columns
        rows = out.collect()
        assert all(r.n_chars == len(r.text) for r in rows)
        now = {r.doc_id: r.text for r in rows}
        assert len(now) == len(rows)
        after[name] = now
        if name == "quality_rules":
            verdicts = {r.row.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
            for doc_id, text in before.items():
                n, _, _, _, repeats = brute.base_quality(text)
                failed = n < 10 or 100 * repeats > 20 * n
                assert verdicts[doc_id] == (doc_id in now) and not (failed and doc_id in now)
            assert now.items() <= before.items()
            assert set(before) - set(now) == {500, 501, 502, 503}
        elif name == "line_dedup":
            assert now == {d: kept for d, _, _, kept in brute.kept_lines(list(before.items()))}
            assert sum(SHARED in text for text in now.values()) == 1
        elif name == "simhash_near_dedup":
            component = brute.near_components(list(before.items()))
            assert set(now) == set(component.values())
            assert sum(now[i] != "" for i in set(now) & set(range(100, 112))) == 1
        else:
            assert set(before) - set(now) == {
                d for d, t in before.items() if brute.contaminated(t, [(1, ITEM)])
            } == {400, 401}
        docs, before = out, now
    encoded = P.STAGES[4][1](spark, docs, folder).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    assert {r.doc_id: list(r.ids) for r in encoded} == {
        d: library.encode(t) for d, t in before.items()
    }
    assert all(r.given_back and r.n_ids == len(r.ids) for r in encoded)
    assert set(range(40)) <= set(before)  # clean documents stay


def test_run_applies_all_stages(spark, folder):
    got = P.run(spark, folder)
    assert got.columns == ["doc_id", "ids", "n_ids", "given_back"]
    assert got.count() > 40


def test_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_stage_names_are_plain():
    assert all(re.fullmatch(r"[a-z_]+", name) for name, _ in P.STAGES) and len(P.STAGES) == 5
