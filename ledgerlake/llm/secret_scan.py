"""Secret scans: fixed patterns, and windows of high Shannon entropy per character class.

Candidate strings are the longest runs of one character class. A window slides over each; the
counts of its characters are kept as it moves, so a step costs the same whatever the window's
width. Windows whose entropy reaches the class's threshold and that mix the kinds of characters a
key mixes are joined into spans. Parts of candidates, between ``/``, ``-`` and ``_``, that an
allow-list pattern finds are passed over, and so are spans inside one of the fixed patterns' spans, which stay as they are.

Defined results: a null text has no spans; repeated rows are scanned alike; an empty table gives
no rows. Only the id and the text are read, so other columns do not matter. Texts are scanned
whole, in time proportional to their length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.shared import ship

# The patterns of the base kinds, and the least length of what must match.
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")

#: Every pattern above but ``ASSIGN`` and every class below lies within such a run.
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
#: What stands between the parts of a path or name.
SEPARATOR = re.compile(r"[/_-]")
#: ``ASSIGN`` needs one of these in the lower-cased text.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Scale of the whole numbers in which entropy is summed, so that steps leave no rounding error.
SCALE = 1 << 40


@dataclass(frozen=True)
class CharClass:
    """A class of characters with its window, least entropy in bits, and what must be mixed."""

    kind: str
    run: str
    window: int
    least_bits: float
    mixed: tuple[str, ...]

    def most(self) -> int:
        """Largest scaled sum of n log2 n over the window's counts that is still reported."""
        return math.floor(self.window * (math.log2(self.window) - self.least_bits) * SCALE)


CLASSES = (
    CharClass("entropy_hex", r"[0-9a-f]+|[0-9A-F]+", 16, 2.75, ("0-9", "A-Fa-f")),
    CharClass("entropy_base64", r"[A-Za-z0-9+/_-]+", 20, 3.8, ("0-9", "A-Z", "a-z")),
    CharClass("entropy_upper", r"(?<![A-Za-z0-9])[A-Z0-9]+(?![A-Za-z0-9])", 16, 3.3, ("0-9", "G-Z")),
    CharClass("entropy_lower", r"(?<![A-Za-z0-9])[a-z0-9]+(?![A-Za-z0-9])", 20, 3.6, ("0-9", "g-z")),
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))

#: Candidates that look random but are known not to be secret.
ALLOWED = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)example|placeholder|changeme",
    r"(?i)0123456789|abcdefghijklm",
)

Span = tuple[int, str, int]  # start, kind, end


def entropy_spans(text: str, chars: CharClass) -> list[tuple[int, int]]:
    """Joined windows of high entropy over a string of one class: starts and exclusive ends."""
    width, most = chars.window, chars.most()
    if len(text) < width:
        return []
    cost = [0, *(round(n * math.log2(n) * SCALE) for n in range(1, width + 1))]
    groups = [re.compile(f"[{g}]") for g in chars.mixed]
    kinds = {c: [i for i, g in enumerate(groups) if g.match(c)] for c in set(text)}
    counts = dict.fromkeys(kinds, 0)
    present = [0] * len(groups)
    total, spans = 0, []
    for at, new in enumerate(text):
        if at >= width:
            old = text[at - width]
            counts[old] -= 1
            total -= cost[counts[old] + 1] - cost[counts[old]]
            for g in kinds[old]:
                present[g] -= 1
        total += cost[counts[new] + 1] - cost[counts[new]]
        counts[new] += 1
        for g in kinds[new]:
            present[g] += 1
        start = at + 1 - width
        if start >= 0 and total <= most and all(present):
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((start, at + 1))
    return spans


def not_allowed(run: str, allowed: Iterable[re.Pattern[str]]) -> Iterator[tuple[int, str]]:
    """Starts and texts of what remains of a run without the parts that a pattern finds."""
    found = sorted(m.span() for p in allowed for m in p.finditer(run))
    at = 0
    for start, end in found:
        before = max(run.rfind(c, 0, start) for c in "/-_") + 1
        if before > at:
            yield at, run[at:before]
        after = SEPARATOR.search(run, end)
        at = max(at, after.start() if after else len(run))
    if at < len(run):
        yield at, run[at:]


def find(
    text: str,
    classes: Iterable[CharClass] = CLASSES,
    allowed: Iterable[re.Pattern[str]] = tuple(map(re.compile, ALLOWED)),
) -> list[Span]:
    """All spans of a text as start, kind and end, by start and then by the order of kinds."""
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        spans += [
            (m.start(), "assign", m.end())
            for m in ASSIGN.finditer(text)
            if len(m[1]) >= ASSIGN_LEAST
        ]
    for run in RUN.finditer(text):
        found, at = run[0], run.start()
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            spans += [(at + m.start(), kind, at + m.end()) for m in pattern.finditer(found)]
        for start, rest in not_allowed(found, allowed):
            for chars in classes:
                if not all(re.search(f"[{g}]", rest) for g in chars.mixed):
                    continue
                for part in re.finditer(chars.run, rest):
                    first = at + start + part.start()
                    spans += [
                        (first + s, chars.kind, first + e)
                        for s, e in entropy_spans(part[0], chars)
                    ]
    base = [(s, e) for s, kind, e in spans if kind in BASE_KINDS]
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(
        (
            x
            for x in spans
            if x[1] in BASE_KINDS or not any(s <= x[0] and x[2] <= e for s, e in base)
        ),
        key=lambda x: (x[0], order[x[1]], x[2]),
    )


SPANS = "array<struct<kind:string,start:int,end:int>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [
            [{"kind": kind, "start": s, "end": e} for s, kind, e in find(text or "")]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, _ARROW)], ["doc_id", "spans"]
        )


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's id and its ``spans``: kind, start and exclusive end in code points."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).mapInArrow(
        _scan, f"doc_id {kind}, spans {SPANS}"
    )
