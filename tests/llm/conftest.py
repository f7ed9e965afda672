import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table of (id, text) or (id, text, lang), dealt over several partitions."""

    def make(rows, extra=None):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] else None)
            for r in rows
        ]
        schema = DOC_SCHEMA
        if extra:
            full = [(*r, *extra.values()) for r in full]
            schema += "".join(f", `{name}` string" for name in extra)
        return spark.createDataFrame(full, schema).repartition(3)

    return make


#: Columns named as the operators name their own, and as people name theirs.
CLASHING = {
    "row": "x", "words": "x", "lang_": "x", "block": "x", "fp": "x", "kept": "x", "ids": "x",
    "matches": "x", "component_id": "x", "a.b": "x", "spans": "x", "n_words": "x", "host": "x",
}


@pytest.fixture
def clashing():
    return dict(CLASHING)
