"""Token ids of whole texts, through a tokenizer file, once per different word.

The vocabularies used here drop white space and never join two words, so a text's ids are
its words' ids one after the other. A worker keeps the ids of words it has met, up to a
number of words, and asks the tokenizer only for new ones: the ids are the tokenizer's own.
As the vocabulary lower-cases and never joins a letter with a sign, words are lower-cased
and parted from their last signs beforehand, except where a text holds combining marks or
the beginning of a special token, which must reach the tokenizer as they are.
"""

from __future__ import annotations

import os
from array import array

import numpy as np

from terrace.llm.hashing import words_of

#: Words whose ids a worker keeps: about 70 MB.
KNOWN_WORDS = 400_000
_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyz")
#: First bytes of combining marks, and the signs that begin a special token.
_AS_IT_IS = (b"\xcc", b"\xcd", b"<|")
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: ASCII signs but the apostrophe, which begins some pieces.
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[c for c in range(33, 127) if not _ALNUM[c] and c != 39]] = True
#: Byte-level vocabularies write bytes that are no visible sign as the signs from U+0100 on.
_HIDDEN = [b for b in range(256) if b < 33 or 126 < b < 161 or b == 173]
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def part_signs(begin: np.ndarray, end: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a last run of signs after a letter or digit become two."""
    place = np.arange(len(data), dtype=np.int64)
    place[_SIGN[data]] = 0
    cut = np.maximum.accumulate(place)[end - 1] + 1
    parted = (cut < end) & (cut > begin) & _ALNUM[data[cut - 1]]
    begins = np.stack([begin, np.where(parted, cut, -1)], axis=1).reshape(-1)
    ends = np.stack([np.where(parted, cut, end), np.where(parted, end, -1)], axis=1).reshape(-1)
    return begins[begins >= 0], ends[ends >= 0]


class WordTokenizer:
    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.older, self.known_words = Tokenizer.from_file(path), {}, {}, known_words
        self.letters_are_one_piece = False
        self.letters_are_one_piece = self._same_alone("\u00e9t\u00e9 \u00c9T\u00c9 stra\u00dfe \u0153uvre \u00f1u\u017e")

    def _same_alone(self, sample: str) -> bool:
        """Whether words of Latin letters, lower-cased and written byte by byte, get the tokenizer's own ids."""
        tokenize = self.tokenizer.model.tokenize
        signs = [w.lower().encode().decode("latin-1").translate(_BYTE_SIGNS) for w in sample.split()]
        return [t.id for w in signs for t in tokenize(w)] == self.tokenizer.encode(sample, add_special_tokens=False).ids

    def _learn(self, keys: list[int], words: list[bytes]) -> None:
        tokenize, other = self.tokenizer.model.tokenize, []
        for key, word in zip(keys, words, strict=True):
            if _PLAIN.issuperset(word):  # one piece, whose bytes are its letters
                self.known[key] = array("I", [t.id for t in tokenize(word.decode())]).tobytes()
                continue
            text = word.decode("utf-8")
            if self.letters_are_one_piece and (low := text.lower()).isalpha() and max(low) < "\u0180":
                self.known[key] = array("I", [t.id for t in tokenize(low.encode().decode("latin-1").translate(_BYTE_SIGNS))]).tobytes()
            else:
                other.append((key, text))
        encoded = self.tokenizer.encode_batch_fast([w for _, w in other], add_special_tokens=False)
        for (key, _), e in zip(other, encoded, strict=True):
            self.known[key] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str | None], last: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, ``last`` after each text's, as unsigned 32-bit; and where each text's begin, with the end."""
        raw = [b"" if t is None else t.encode("utf-8") for t in texts]
        plain = not any(any(sign in r for sign in _AS_IT_IS) for r in raw)
        found = words_of(texts, lower=plain, split=part_signs if plain else None, raw=raw)
        keys, first, which = np.unique(found.value, return_index=True, return_inverse=True)
        if not plain:  # the same bytes may stand for other ids where words come as they are
            keys = keys ^ np.uint64(0x5555555555555555)
        names, parts, new = keys.tolist(), [], []
        for i, k in enumerate(names):
            part = self.known.get(k)
            if part is None and (part := self.older.get(k)) is not None:
                self.known[k] = part
            if part is None:
                new.append(i)
            parts.append(part)
        if new:
            data = found.data.tobytes()
            begin, end = found.begin[first], found.end[first]
            self._learn([names[i] for i in new], [data[begin[i] : end[i]] for i in new])
            for i in new:
                parts[i] = self.known[names[i]]
        if 2 * len(self.known) > self.known_words:  # words not met since the last time are forgotten
            self.known, self.older = {}, self.known
        flat = np.frombuffer(b"".join(parts), dtype=np.uint32)
        size = np.fromiter((len(p) >> 2 for p in parts), dtype=np.int64, count=len(parts))
        start = np.cumsum(size) - size
        sizes = size[which]
        ends = np.cumsum(sizes)
        bounds = np.r_[0, ends][found.bounds]
        pick = np.repeat(start[which] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        out = np.full(len(pick) + len(texts), last, dtype=np.uint32)
        keep = np.ones(len(out), dtype=bool)
        whole = bounds + np.arange(len(texts) + 1)
        keep[whole[1:] - 1] = False
        out[keep] = flat[pick]
        return out, whole


_open: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process and file."""
    if path not in _open:
        _open[path] = WordTokenizer(path)
    return _open[path]
