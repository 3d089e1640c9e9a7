"""Content-chosen anchors in byte strings.

The anchor of a window of ``size`` bytes is its part of ``part`` bytes with the smallest hash, the leftmost of equals. It
depends on the window's bytes alone, so equal windows anywhere have equal anchors at equal places. Windows
in a row with the same anchor are a stretch; its bytes hold all of them.
"""

from __future__ import annotations

import numpy as np

from veristrata.llm.rolling import PrefixHash, mix

PLACE_BITS = 22
LONGEST = 1 << PLACE_BITS  # bytes that are looked at together


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key in each window, by running minima of blocks from both sides."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Stretches:
    """Stretches of the texts that stand one after another in ``data``; ``ends`` are the ends of the texts.

    ``first``: first window of a stretch; ``count``: its windows; ``anchor``: place of the anchor;
    ``text``: number of the text; ``kind``: hash of the anchor; ``whole``: hash of the stretch.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, size: int, part: int):
        none = np.zeros(0, np.int64)
        self.first = self.count = self.anchor = self.text = none
        self.kind = self.whole = none.astype(np.uint64)
        if len(data) < size:
            return
        prefix = PrefixHash(data)
        hashes = mix(prefix.every(part))
        places = np.arange(len(hashes), dtype=np.uint64)
        keys = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
        anchor = (window_minima(keys, size - part + 1) & np.uint64(LONGEST - 1)).astype(np.int64)
        n = len(data) - size + 1
        starts = np.concatenate([[0], ends[:-1]])
        text = np.repeat(np.arange(len(ends)), ends - starts)[:n]
        valid = np.arange(n) + size <= ends[text]
        new = np.ones(n, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new & valid)
        # A stretch ends before the next new anchor or where its text has no more windows.
        stops = np.flatnonzero(new | ~valid)
        after = np.searchsorted(stops, first, side="right")
        last = np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)], n)
        self.first, self.count, self.anchor, self.text = first, last - first, anchor[first], text[first]
        self.kind = hashes[self.anchor]
        shape = (self.anchor - first).astype(np.uint64) << np.uint64(32) | self.count.astype(np.uint64)
        self.whole = mix(prefix.part(first, last + size - 1) ^ mix(shape))
