"""Plain, slow versions of the operators, from their definitions."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secret_digest(text):
    text = text or ""
    found = {"assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 8],
             "access": [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16],
             "hex": [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]}
    kinds = list(found)
    spans = sorted((s, kinds.index(k), e) for k, v in found.items() for s, e in v)
    listed = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
    return [len(found[k]) for k in kinds], hashlib.sha256(listed.encode()).hexdigest(), listed


def quality_counts(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    inside = {i + d for at in windows.values() if len(at) > 1 for i in at for d in range(8)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            doubled += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(inside))


def simhash(text):
    words = SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, bits=3):
    """Smallest id that links reach, for {id: fingerprint}."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    for n, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[n + 1:] ^ values[n]) <= bits):
            a, b = sorted((root(i), root(ids[n + 1 + j])))
            parent[b] = a
    return {i: root(i) for i in ids}


def crc_of_ids(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def nearest(vectors, query, k):
    q = np.array(vectors[query], float)
    scored = sorted((-float(np.dot(q, np.array(v, float))), i) for i, v in vectors.items() if i != query)
    return [(i, -s) for s, i in scored[:k]]
