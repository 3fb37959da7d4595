"""Slow plain versions of the operators, for small tables."""

from __future__ import annotations

import re

import numpy as np

TOKENIZER, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def path(name):
    import public_tokenizers

    return str(public_tokenizers.path(name))


def ascii_lower(t: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), t)


def shingle_set(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(rows: list[tuple]) -> dict:
    """{doc_id: (size, smallest doc_id of the component)} of (doc_id, text) rows, all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def nearest(vectors: dict, queries: list, top: int) -> dict:
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in queries:
        s = x @ np.asarray(vectors[q], np.float64)
        got = sorted(((-v, i) for v, i in zip(s, ids) if i != q))[:top]
        out[q] = [(int(i), -v) for v, i in got]
    return out


def token_ids(text, tokenizer):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
