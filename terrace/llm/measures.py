"""Numbers that describe whole texts, for many texts at once."""

from __future__ import annotations

import numpy as np

from terrace.llm.hashing import mix, words_of

_KINDS = ("space", "newline", "upper", "lower", "digit", "stop", "shout", "symbol", "bar", "other_sign", "beyond_ascii")
_KIND = np.full(256, _KINDS.index("other_sign"), dtype=np.int64)
_KIND[[32, 9, 11, 12, 13]] = 0
_KIND[10] = 1
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 2, 3, 4
_KIND[[ord(c) for c in ".,;:"]] = 5
_KIND[[ord(c) for c in "!?"]] = 6
_KIND[[ord(c) for c in "#*$%&<>"]] = 7
_KIND[ord("|")] = 8
_KIND[128:] = 10
NAMES = (
    *[f"{k}_share" for k in _KINDS],
    "log_bytes",
    "log_words",
    "mean_word_bytes",
    "long_word_share",
    "different_word_share",
    "top_word_share",
    "same_as_last_share",
    "different_triple_share",
    "line_words",
    "repeated_line_share",
)


def measures_of(texts: list[str | None]) -> np.ndarray:
    """One row per text, in the order of ``NAMES``; null and empty texts have zeros."""
    raw = [b"" if t is None else t.encode("utf-8") for t in texts]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    n = len(raw)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    kinds = np.bincount(np.repeat(np.arange(n) * len(_KINDS), size) + _KIND[data], minlength=n * len(_KINDS)).reshape(n, -1)
    found = words_of(texts, raw=raw)
    count = np.diff(found.bounds)
    which = np.repeat(np.arange(n), count)
    length = found.end - found.begin
    few = np.maximum(count, 1)
    per = lambda weight: np.bincount(which, weight, n) / few

    same = np.r_[False, found.value[1:] == found.value[:-1]] & np.r_[False, which[1:] == which[:-1]] if len(which) else np.zeros(0, dtype=bool)
    keyed = mix(found.value + which.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, repeats = np.unique(keyed, return_index=True, return_counts=True)
    different = np.bincount(which[first], minlength=n) / few
    top = np.zeros(n)
    np.maximum.at(top, which[first], repeats)
    triple = np.zeros(0, dtype=np.uint64)
    inside = np.zeros(0, dtype=bool)
    if len(which) > 2:
        v = found.value
        triple = mix(v[:-2] * np.uint64(3) + mix(v[1:-1] * np.uint64(5) + v[2:]) + which[2:].astype(np.uint64))
        inside = which[:-2] == which[2:]
    triples = np.bincount(which[2:][inside], minlength=n) if len(triple) else np.zeros(n)
    if len(triple):
        _, at = np.unique(triple[inside], return_index=True)
        distinct_triples = np.bincount(which[2:][inside][at], minlength=n)
    else:
        distinct_triples = np.zeros(n)
    repeated_lines = np.zeros(n)
    for i, r in enumerate(raw):
        lines = [x for x in r.split(b"\n") if x]
        repeated_lines[i] = 1 - len(set(lines)) / len(lines) if lines else 0
    table = np.c_[
        kinds / np.maximum(size, 1)[:, None],
        np.log1p(size),
        np.log1p(count),
        per(length),
        per(length > 20),
        different,
        top / few,
        per(same),
        np.where(triples > 0, distinct_triples / np.maximum(triples, 1), 1.0),
        count / (kinds[:, 1] + 1),
        repeated_lines,
    ]
    table[count == 0] = 0
    return table.astype(np.float64)
