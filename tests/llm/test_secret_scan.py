import math
import random
import re
from collections import Counter

import pytest

from ledgerlake.llm import secret_scan as S


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def brute_spans(text, chars):
    """Windows whose entropy is computed afresh, joined."""
    out = []
    for at in range(len(text) - chars.window + 1):
        window = text[at : at + chars.window]
        mixed = all(re.search(f"[{g}]", window) for g in chars.mixed)
        if mixed and entropy(window) >= chars.least_bits - 1e-9:
            if out and at <= out[-1][1]:
                out[-1] = (out[-1][0], at + chars.window)
            else:
                out.append((at, at + chars.window))
    return out


@pytest.mark.parametrize("chars", S.CLASSES, ids=lambda c: c.kind)
def test_incremental_entropy_equals_entropy_computed_afresh(chars):
    random.seed(1)
    alphabets = ["0123456789abcdef", "ab01", "aA0bB1", "abcdefghijKLMNOP0123456789+/", "a"]
    for _ in range(300):
        alphabet = random.choice(alphabets)
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 90)))
        assert S.entropy_spans(text, chars) == brute_spans(text, chars)


def test_base_kinds():
    key = "AKIA" + "Q" * 16
    text = f'ünï PassWord : "abc.de" secret=abcde {key} AKIAABC {"0a" * 12} {"0a" * 11}'
    found = [x for x in S.find(text) if x[1] in S.BASE_KINDS]
    assert [(kind, text[s:e]) for s, kind, e in found] == [
        ("assign", 'PassWord : "abc.de'),
        ("access", key),
        ("hex", "0a" * 12),
    ]


def test_case_is_ascii_only():
    assert S.find("paſſword=abcdefgh") == []  # long s is not a letter of the pattern


def test_the_method_adds_spans_outside_the_base_ones():
    random_key = "kJ8sQ2mZx7Lw0PvR4tYb"
    text = f"note {random_key} and token = {random_key}"
    assert [(kind, text[s:e]) for s, kind, e in S.find(text)] == [
        ("entropy_base64", random_key),
        ("assign", f"token = {random_key}"),
    ]


def test_allow_list():
    uuid = "1b4e28ba-2fa1-11d2-883f-0016d3cca427"
    assert S.find(f"id {uuid} done") == []
    assert S.find("EXAMPLEkJ8sQ2mZx7Lw0PvR4tYb") == []
    assert S.find("kJ8sQ2mZx7Lw0PvR4tYb", allowed=(re.compile("mZx"),)) == []


def test_prose_is_left_alone():
    prose = "Über internationalization 1234567890123456 +1 (743) 555-3824 227.5.221.1 " * 20
    assert S.find(prose) == []


def test_a_very_long_run():
    run = "kJ8sQ2mZx7Lw0PvR4tYb" * 20_000
    assert S.find(run) == [(0, "entropy_base64", len(run))]


def test_edge_cases(documents, clashing):
    key = "token=abcdef"
    rows = [(1, None), (2, ""), (3, key), (3, key), (None, key), (4, "x" * 100_000)]
    got = S.scan(documents(rows, clashing)).collect()
    spans = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in got)
    one = (("assign", 0, 12),)
    assert spans == Counter(
        {(1, ()): 1, (2, ()): 1, (3, one): 2, (None, one): 1, (4, ()): 1}
    )
    assert S.scan(documents([])).count() == 0


def test_allowed_parts_do_not_hide_others():
    uuid, key = "1b4e28ba-2fa1-11d2-883f-0016d3cca427", "kJ8sQ2mZx7Lw0PvR4tYb"
    for text in (f"users/{uuid}/{key}", f"example-bucket/{key}", f"{key}/{uuid}"):
        ((start, kind, end),) = S.find(text)
        assert kind == "entropy_base64" and key in text[start:end] and uuid not in text[start:end]


def test_keys_in_one_case():
    for kind, key in (("entropy_upper", "JBSWY3DPEHPK3PXP"), ("entropy_lower", "k3x9qz7w1mv8t2rj5ph6")):
        assert S.find(f"the {key} here") == [(4, kind, 4 + len(key))]
