"""Plain versions of the operators for small inputs, and documents to try them on."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text, width=3):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + width]).encode(), seed=42).intdigest()
        for i in range(n)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """The smallest member of each member's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_components(docs):
    """Component id by document id, all pairs of fingerprints compared."""
    prints = [fingerprint(text) for _, text in docs]
    linked = [
        (i, j)
        for i in range(len(docs))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 3
    ]
    members = defaultdict(list)
    for i, root in enumerate(groups(len(docs), linked)):
        members[root].append(docs[i][0])
    return {d: min(m) for m in members.values() for d in m}


def line_key(line):
    key = lower(line.strip(" \t\n\x0b\x0c\r"))
    return key if len(key) >= 20 else None


def kept_lines(docs, min_docs=3):
    """Number of lines, number dropped and kept text of each (id, text)."""
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if line_key(line):
                holders[line_key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if not line_key(x)
            or len(holders[line_key(x)]) < min_docs
            or doc_id == max(holders[line_key(x)])
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def base_quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {
        i + k
        for i in range(len(words) - 4)
        if windows[tuple(words[i : i + 5])] > 1
        for k in range(5)
    }
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(repeated)


def tiles(item, text, least):
    """Greedy string tiling by comparing all places."""
    item_marked, text_marked, out = [0] * len(item), [int(t == 0) for t in text], []
    while True:
        best, found = least - 1, []
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (
                    i + k < len(item)
                    and j + k < len(text)
                    and item[i + k] == text[j + k]
                    and not item_marked[i + k]
                    and not text_marked[j + k]
                ):
                    k += 1
                if k > best:
                    best, found = k, []
                if k == best and k >= least:
                    found.append((i, j))
        if not found:
            return out
        for i, j in found:
            if not any(item_marked[i : i + best]) and not any(text_marked[j : j + best]):
                item_marked[i : i + best] = text_marked[j : j + best] = [1] * best
                out.append((i, j, best))


def contaminated(text, items, least=5, share=0.5):
    """Ids of the items that a text covers."""
    words = re.findall(r"\w+", (text or "").lower())
    out = []
    for item_id, item in items:
        tokens = re.findall(r"\w+", (item or "").lower())
        numbers = {t: n + 1 for n, t in enumerate(dict.fromkeys(tokens))}
        covered = sum(
            x[2] for x in tiles([numbers[t] for t in tokens],
                                [numbers.get(w, 0) for w in words], least)
        )
        if len(tokens) >= least and covered >= share * len(tokens):
            out.append(item_id)
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
