"""Fixture rows and brute-force versions of the llm operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(r: random.Random, n: int, pool: int = 400) -> str:
    return " ".join(f"w{r.randrange(pool)}é" if r.random() < 0.1 else f"word{r.randrange(pool)}" for _ in range(n))


def rows(seed: int = 5) -> list[tuple]:
    """(doc_id, text): nulls, empties, copies, near copies, shared passages, periodic and long texts."""
    r = random.Random(seed)
    passage, base = sentence(r, 120), sentence(r, 150)
    texts: list[str | None] = [None, "", " \n\t ", "Ab", "aB", "one two", "One  two", "x" * 700, "ab " * 300,
                               sentence(r, 30), base, base.upper(), base, passage]
    for i in range(8):
        words = base.split()
        words[r.randrange(150)] = f"edit{i}"
        words[r.randrange(150)] = f"also{i}"
        texts.append(" ".join(words))
    for _ in range(12):
        texts.append(sentence(r, r.randrange(60)) + " " + passage[r.randrange(60):] + "\n" + sentence(r, r.randrange(60)))
    texts.append(" ".join(sentence(r, 40) for _ in range(60)) + " " + passage + " " + passage)
    texts += [sentence(r, r.randrange(5, 200)) for _ in range(15)]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def exact(docs) -> dict:
    norm = {d: (t or "").translate(LOWER) for d, t in docs}
    group: dict[str, list] = {}
    for d, n in norm.items():
        group.setdefault(n, []).append(d)
    return {d: (max(group[n]), len(group[n]), d == max(group[n]), sha(n)) for d, n in norm.items()}


def base_rules(text: str | None) -> tuple:
    w, t = words(text), text or ""
    count, covered = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def earlier_words(docs, window: int = 50) -> dict:
    first: dict[tuple, int] = {}
    split = {d: words(t) for d, t in docs}
    for d, w in split.items():
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def repeated_bytes(docs, window: int = 200) -> dict:
    """By position in the list, as identifiers may repeat."""
    data = [(t or "").encode() for _, t in docs]
    count = Counter(b[i:i + window] for b in data for i in range(len(b) - window + 1))
    out = {}
    for k, b in enumerate(data):
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[k] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept)
    return out


def near(docs, k: int, percent: int) -> dict:
    sets = {}
    for d, t in docs:
        w = words((t or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: (len(sets[d]), top(d), top(d) == d) for d in sets}
