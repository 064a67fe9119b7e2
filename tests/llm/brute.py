"""The operators restated without Spark and without their methods, for small tables."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import Counter

import xxhash


def unsigned(value: int) -> int:
    return value & (2**64 - 1)


def simhash(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    spans = [words[i:i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(" ".join(span).encode(), seed=42).intdigest() for span in spans]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def grouped(number, links):
    """The least place that each place reaches."""
    root = list(range(number))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(number)]


def components(rows, distance=3):
    """[(doc_id, fingerprint, component_id)] of [(doc_id, text)]."""
    prints = [simhash(text) for _, text in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if bin(prints[i] ^ prints[j]).count("1") <= distance
    ]
    groups = grouped(len(rows), links)
    least = {}
    for (doc_id, _), group in zip(rows, groups):
        if doc_id is not None:
            least[group] = min(least.get(group, doc_id), doc_id)
    return [(doc_id, p, least.get(g)) for (doc_id, _), p, g in zip(rows, prints, groups)]


def without_repeats(rows, window):
    """[(doc_id, n_words, n_removed, kept)] of [(doc_id, text)]."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc_id, _), words in zip(rows, split):
        for i in range(len(words) - window + 1):
            if doc_id is not None:
                span = tuple(words[i:i + window])
                first[span] = min(first.get(span, doc_id), doc_id)
    out = []
    for (doc_id, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i:i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = [word for i, word in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return out


def contamination(rows, items, window):
    """[(doc_id, n_words, n_hit, item ids)] of [(doc_id, text)] and [(item_id, text)]."""
    def words_of(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    windows = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words and item_id is not None else 0):
            windows.setdefault(tuple(words[i:i + size]), set()).add(item_id)
    out = []
    for doc_id, text in rows:
        words, hit, found = words_of(text), set(), set()
        for size in {len(span) for span in windows}:
            for i in range(len(words) - size + 1):
                ids = windows.get(tuple(words[i:i + size]))
                if ids:
                    hit.update(range(i, i + size))
                    found |= ids
        out.append((doc_id, len(words), len(hit), sorted(map(str, found))))
    return out


def chained_hash(*values):
    """xxhash64 of several columns: the hash of one is the seed of the next; NULL is passed over."""
    seed = 42
    for value, form in values:
        if value is not None:
            seed = xxhash.xxh64(value.encode() if form == "s" else struct.pack(form, value), seed=seed).intdigest()
    return seed


def uniform(*values):
    return (chained_hash(*values) >> 11) / float(1 << 53)


def raked(tokens, targets, rounds=2000):
    """Weights of {(values of each dimension): tokens} with the marginals [{value: share}, ...]."""
    total = sum(tokens.values())
    weights = {cell: n / total for cell, n in tokens.items()}
    for _ in range(rounds):
        for at, goal in enumerate(targets):
            sums = Counter()
            for cell, weight in weights.items():
                sums[cell[at]] += weight
            weights = {
                cell: weight * goal.get(cell[at], 0.0) / sums[cell[at]] if sums[cell[at]] else 0.0
                for cell, weight in weights.items()
            }
    return weights


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
