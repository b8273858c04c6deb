"""Plain Python forms of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash

_KEYS = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", "password|passwd|secret|token|api_?key")
KINDS = [
    ("assign", re.compile(rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def secret_spans(text: str) -> list[tuple[int, int, str]]:
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern, group, least) in enumerate(KINDS)
        for m in pattern.finditer(text)
        if len(m[group]) >= least
    ]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def simhash(text: str, n: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, pairs) -> dict:
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def digest(turns: list[tuple[str, str]]) -> str:
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
