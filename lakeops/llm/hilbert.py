"""Places along a Hilbert curve."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells``, grid
    coordinates of ``bits`` bits (J. Skilling, 2004): undo the turns from the
    coarsest bit down, Gray-decode across the axes, interleave the bits."""
    x = [c.astype(np.int64) for c in cells.T]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(len(x)):
            turned = (x[i] >> b) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap) if i else np.where(turned, x[0] ^ low, x[0])
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = key << 1 | ((c ^ flip) >> b) & 1
    return key
