"""SuperMinHash signatures of many sets at once.

Every element gets one random permutation of the signature's places, made by Fisher-Yates
swaps, and at its j-th step the value j + r at the place the permutation names, r uniform.
A place keeps its least value. As an element's values rise by one per step, a set is finished
when its largest value is below the next step: sets much larger than the signature need two
steps or so, not one per place. All sets of a batch take a step together.
"""

from __future__ import annotations

import numpy as np

from terrace.llm.hashing import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)


def signatures(elements: np.ndarray, sizes: np.ndarray, places: int) -> np.ndarray:
    """One row of ``places`` values per set. Sets follow one another in ``elements`` and are not empty."""
    out = np.full((len(sizes), places), np.inf)
    which = np.repeat(np.arange(len(sizes)), sizes)
    swaps: list[np.ndarray] = []
    for step in range(places):
        if not len(elements):
            break
        with np.errstate(over="ignore"):
            chance = mix(elements + np.uint64(step + 1) * _STEP)
        swap = step + (mix(chance ^ _STEP) % np.uint64(places - step)).astype(np.int32)
        place = swap.copy()
        for earlier in range(step - 1, -1, -1):  # where the swaps before have put the place
            place[place == swaps[earlier]] = earlier
        np.minimum.at(out.reshape(-1), which * places + place, step + (chance >> np.uint64(11)) * 2.0**-53)
        swaps.append(swap)
        open_sets = out.max(axis=1) >= step + 1
        if not open_sets.all():
            stay = open_sets[which]
            if not stay.all():
                elements, which = elements[stay], which[stay]
                swaps = [s[stay] for s in swaps]
    return out


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """One hash per set and band of ``rows`` neighbouring places."""
    bits = np.ascontiguousarray(values).view(np.uint64)
    out = np.empty((len(values), values.shape[1] // rows), dtype=np.uint64)
    for band in range(out.shape[1]):
        key = np.full(len(values), band + 1, dtype=np.uint64)
        for row in range(rows):
            key = mix(key * np.uint64(31) + bits[:, band * rows + row])
        out[:, band] = key
    return out
