"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def base_counts(text):
    text = text or ""
    w = WORDS.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def without_repeats(texts, size):
    split = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return out


def fingerprint(text, words=3):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, ids, distance=3):
    """Smallest id of each row's component."""
    p = np.array(prints, dtype=np.uint64)
    label = list(range(len(p)))
    moved = True
    while moved:
        moved = False
        for i in range(len(p)):
            near = np.nonzero(np.bitwise_count(p[i] ^ p) <= distance)[0]
            low = min(label[j] for j in near)
            for j in near:
                if label[j] != low:
                    label[j], moved = low, True
    return [min((ids[j] for j in range(len(p)) if label[j] == label[i] and ids[j] is not None), default=None) for i in range(len(p))]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = []
    for k, (pattern, group, least) in enumerate(((ASSIGN, 2, 8), (re.compile("AKIA[A-Z0-9]+"), 0, 16), (re.compile("[0-9a-f]+"), 0, 32))):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))
