import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import line_dedup as L


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 20_000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        counts = rng.integers(1, 9, len(keys))
        keepers = rng.integers(-5, 10**12, len(keys))
        index = L.ShardIndex.build(keys, counts, keepers)
        assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
        found, kept = index.lookup(keys)
        assert found.tolist() == counts.tolist() and kept.tolist() == keepers.tolist()
        strange = rng.integers(0, 2**64, 1000, dtype=np.uint64)
        assert (index.lookup(strange)[0] == 0).all()
        again = L.ShardIndex.of(index.arrays())
        assert all((a == b).all() for a, b in zip(again.lookup(keys), (found, kept), strict=True))


def test_keys():
    line = b"  Ab" + b"x" * 18 + b"\t"
    assert L.key_of(line) == L.key_of(b"aB" + b"x" * 18)
    assert L.key_of("é".encode() * 19) is None
    assert L.key_of("É".encode() * 20) != L.key_of("é".encode() * 20)
    assert L.key_of(b"x" * 19 + b" " * 9) is None


def corpus():
    random.seed(8)
    pool = [f"line number {i} of the pool of lines" for i in range(30)]
    pool += ["short", "", "  Spaced Line with capitals AND more \t", "spaced line with capitals and more"]
    docs = [
        (i, "\n".join(random.choices(pool, k=random.randint(0, 9)) + [f"own {i} " * 5]))
        for i in range(120)
    ]
    return [*docs, (500, None), (501, ""), (502, "\n\n"), (503, "\n".join(pool * 3))]


def test_equals_brute_force(documents, clashing, monkeypatch):
    monkeypatch.setattr(L, "SHARD_KEYS", 4)
    monkeypatch.setattr(L, "OPEN_BYTES", 1)
    docs = corpus()
    got = L.deduplicate(documents(docs, clashing)).collect()
    assert sorted((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == sorted(
        brute.kept_lines(docs)
    )


def test_the_stored_arrays_decide(documents, spark, monkeypatch):
    """Other counts in the stored index, and no line goes."""
    docs = documents([(i, "a line that several documents share") for i in range(4)])
    assert sum(r.n_dropped for r in L.deduplicate(docs).collect()) == 3
    build = L.build_index

    def emptied(rows):
        folder, shards = build(rows)
        index = L.Index(folder, shards)
        for shard in range(shards):
            own = index._open(shard)
            arrays = {name: getattr(own, name).copy() for name in own.ARRAYS}
            arrays["counts"][:] = 0
            batch = L.ShardIndex(arrays).arrays()
            with pa.OSFile(L._shard_path(index.root, shard), "wb") as out:
                with pa.ipc.new_file(out, batch.schema) as writer:
                    writer.write_batch(batch)
        return folder, shards

    monkeypatch.setattr(L, "build_index", emptied)
    assert sum(r.n_dropped for r in L.deduplicate(docs).collect()) == 0


def test_ids_count_not_rows(documents):
    line = "a line that several documents share"
    rows = [(1, line), (1, line), (1, f"{line} "), (2, line)]
    assert [r.n_dropped for r in L.deduplicate(documents(rows)).collect()] == [0] * 4
    with_a_third = L.deduplicate(documents([*rows, (3, line)])).collect()
    assert sorted((r.row.doc_id, r.n_dropped) for r in with_a_third) == [
        (1, 1), (1, 1), (1, 1), (2, 1), (3, 0),
    ]
    with pytest.raises(ValueError):
        L.deduplicate(documents(rows), min_docs=1)


def test_a_line_in_every_document(documents):
    line = "a line that every document holds"
    docs = [(i % 2500, line) for i in range(5000)] + [(9999, "long " * 100_000 + "\n" + line)]
    got = L.deduplicate(documents(docs)).collect()
    assert len(got) == 5001 and sum(r.n_dropped for r in got) == 5000


def test_repeated_rows_and_null_ids(documents):
    line = "a line that several documents share"
    rows = [(1, line), (1, line), (2, f"{line}\nown"), (None, line), (None, line)]
    got = L.deduplicate(documents(rows)).collect()
    assert sorted((str(r.row.doc_id), r.kept) for r in got) == [
        ("1", ""), ("1", ""), ("2", f"{line}\nown"), ("None", ""), ("None", ""),
    ]
    alone = L.deduplicate(documents([(None, line)] * 3)).collect()
    assert [r.kept for r in alone] == [line] * 3  # all have the keeper's id


def test_documents_keep_their_columns(documents, clashing):
    line = "a line that several documents share"
    frame = documents([(i, f"{line}\nown {i}") for i in range(4)], clashing)
    kept = L.with_kept_lines(frame)
    assert kept.schema == frame.schema or kept.columns == frame.columns
    assert sorted((r.doc_id, r.text, r.n_chars, r["a.b"]) for r in kept.collect()) == [
        (0, "own 0", 5, "x"), (1, "own 1", 5, "x"), (2, "own 2", 5, "x"),
        (3, f"{line}\nown 3", len(line) + 6, "x"),
    ]
    assert L.with_kept_lines(documents([])).count() == 0
