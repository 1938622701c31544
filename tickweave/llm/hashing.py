"""Rolling hashes of whole record batches with numpy: words, grams, stretches, and segments of windows that share an anchor.

Hashes are polynomials over random 64-bit values of the units, modulo 2**64 and mixed afterwards; a stretch's hash comes
from two prefix sums. Texts are worked through in slices of about a megabyte, so memory follows the batch, not a document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Polynomial:
    """Hashes of stretches of a sequence of 64-bit units."""

    def __init__(self, seed: int):
        self.base = int(mixed(np.array([seed], U))[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(max(n, SLICE), b, U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, units: np.ndarray) -> np.ndarray:
        self._powers(len(units) + 1)
        out = np.zeros(len(units) + 1, U)
        np.cumsum(units * self.up[: len(units)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start, end) -> np.ndarray:
        """Hashes of the stretches ``[start, end)``; slices or arrays of places."""
        return mixed((sums[end] - sums[start]) * self.down[start])


BYTES = [mixed(np.arange(256, dtype=U) + U(1 + 1000 * k)) for k in range(2)]  # random values of a byte, for two hashes
POLY = [Polynomial(11), Polynomial(77)]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and where each text starts (one more at the end)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and the first word's number per text (one more at the end) of all words."""
    n = len(raw)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(n + 1, bool)  # a text starts here
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if n else inside
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.concatenate([inside[1:], [False]]) if n else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of a random value for every byte at its place in the word.

    A polynomial modulo 2**64 would not do here: for any odd base it gives a long Thue-Morse word and its complement one hash.
    """
    out, w = np.empty(len(starts), U), 0
    while w < len(starts):
        upto = max(w + 1, int(np.searchsorted(starts, starts[w] + SLICE)))
        sizes = ends[w:upto] - starts[w:upto]
        first = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(first[-1]) - np.repeat(first[:-1], sizes)
        each = raw[np.repeat(starts[w:upto], sizes) + place].astype(U) + (place.astype(U) << U(8))
        sums = np.zeros(first[-1] + 1, U)
        np.cumsum(mixed(each + U(0x9E3779B97F4A7C15)), out=sums[1:])
        out[w:upto] = mixed(sums[first[1:]] - sums[first[:-1]] + sizes.astype(U))
        w = upto
    return out


def grams(units: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` units from each place on."""
    n = len(units) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for k in range(size):
        out *= U(POLY[1].base)
        out += units[k : k + n]
    return mixed(out)


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    have, step = x, 1
    while 2 * step <= width:
        have = np.minimum(have[:-step], have[step:])
        step *= 2
    return have if step == width else np.minimum(have[: len(x) - width + 1], have[width - step :][: len(x) - width + 1])


PLACE = 28  # bits of a packed value that hold the place; the rest orders the grams


def anchored(gram_hashes: np.ndarray, first: np.ndarray, windows: np.ndarray, width: int):
    """Segments: runs of windows that share an anchor, the leftmost gram of lowest hash in each of them.

    ``first`` and ``windows`` say for each text where its windows start and how many it has; a window covers ``width``
    grams. Equal windows have their anchor at equal distance, so they meet under the anchor's hash. Returns text number,
    start, number of windows and place of the anchor.
    """
    none = np.zeros(0, np.int64)
    if len(gram_hashes) < width or not (windows > 0).any():
        return none, none, none, none
    place = (U(1) << U(PLACE)) - U(1)
    low = lowest((gram_hashes & ~place) | np.arange(len(gram_hashes), dtype=U), width) & place
    some = np.flatnonzero(windows > 0)
    first, windows = first[some], windows[some]
    total = np.cumsum(windows)
    text = np.repeat(np.arange(len(some)), windows)
    at = np.arange(total[-1]) - np.repeat(total - windows, windows) + np.repeat(first, windows)
    anchor = low[at].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.append(new, len(at)))
    return some[text[new]], at[new], count, anchor[new]
