"""Words of many texts at once, as 64-bit values, without a Python object per word.

A word is a maximal run of bytes other than white space (0x20, 0x09-0x0D); A-Z may be
lower-cased. A word's value is a polynomial over its bytes modulo 2^64, taken from one
running sum over the whole batch, and mixed; equal words have equal values in every
process, different words differ but for a chance of 2^-64 each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A word boundary is written before and after every text.
_GAP = b" "
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < size:
        size = max(size, 1 << 20)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of a batch in order: value, first and past-the-last byte, and where each text's words begin and end."""

    value: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    total: np.ndarray

    def prefix(self, size: int) -> np.ndarray:
        """Values of the words' first ``size`` bytes; longer than the word itself, 0."""
        _, down = _power_table(len(self.data) + 1)
        stop = np.minimum(self.begin + size, self.end)
        value = mix((self.total[stop] - self.total[self.begin]) * down[self.begin] + np.uint64(size))
        return np.where(self.end - self.begin > size, value, np.uint64(0))

    def of(self, i: int) -> slice:
        return slice(self.bounds[i], self.bounds[i + 1])


def words_of(texts: list[str | None], lower: bool = True, split=None, raw: list[bytes] | None = None) -> Words:
    """Null texts count as empty. ``split`` may cut words further; ``raw`` is the texts in UTF-8, if at hand."""
    raw = [b"" if t is None else t.encode("utf-8") for t in texts] if raw is None else raw
    data = np.frombuffer(_GAP + _GAP.join(raw) + _GAP, dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = change[0::2], change[1::2]
    if split is not None and len(begin):
        begin, end = split(begin, end, data)
    up, down = _power_table(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.multiply(data + np.uint64(1), up[: len(data)], out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    value = mix((total[end] - total[begin]) * down[begin])
    starts = np.cumsum([1] + [len(r) + 1 for r in raw])
    return Words(value, begin, end, np.searchsorted(begin, starts), data, total)


def chunks(frames, text: str = "text", most_bytes: int = 1_000_000):
    """Cut Arrow-fed pandas frames so that one array pass holds a few megabytes of text, or one longer text."""
    for frame in frames:
        sizes = frame[text].str.len().fillna(0).to_numpy(dtype=np.int64)
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield frame.iloc[first:i]
                first, held = i, 0
            held += size
        if first < len(frame):
            yield frame.iloc[first:]
