"""Hashes of byte ranges, whole arrays at a time."""

from __future__ import annotations

MULTIPLIER = 0x9E3779B97F4A7C15


class Hasher:
    """Hashes of all grams of a length and of any ranges of a byte array, modulo 2 to the 64."""

    def __init__(self) -> None:
        import numpy as np

        table = np.random.default_rng(20240229).integers(0, 1 << 64, (2, 256), np.uint64)
        self.one, self.two = table
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def mixed(self, h):
        import numpy as np

        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))

    def grams(self, data, k: int):
        import numpy as np

        h, n, parts = self.one[data], 1, {}
        while True:
            parts[n] = h
            if 2 * n > k:
                break
            h = h[: len(h) - n] * np.uint64(pow(MULTIPLIER, n, 1 << 64)) + h[n:]
            n *= 2
        at = n
        for m in sorted(parts, reverse=True)[1:]:
            if at + m <= k:
                size = len(data) - at - m + 1
                h = h[:size] * np.uint64(pow(MULTIPLIER, m, 1 << 64)) + parts[m][at : at + size]
                at += m
        return self.mixed(h)

    def ranges(self, data, start, end):
        import numpy as np

        if len(self.powers) < len(data):
            n = 1 << (len(data) - 1).bit_length()
            back = pow(MULTIPLIER, -1, 1 << 64)
            self.powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, MULTIPLIER, np.uint64))])
            self.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, back, np.uint64))])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.two[data] * self.powers[: len(data)])])
        return self.mixed((sums[end] - sums[start]) * self.inverse[start])


def words(text: str, hasher: Hasher):
    """Hashes of the text's words in order; A-Z count as a-z, words end at ASCII space."""
    import numpy as np

    data = np.frombuffer(text.encode("utf-8").lower(), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return hasher.mixed(hasher.ranges(data, start, end) + (end - start).astype(np.uint64))
