"""Word and window fingerprints inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes:
    """64-bit hash of each word (bytes); a table of known words is slower than hashing
    them again once it has left the processor's cache."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher, so that sums and products spread over all bits."""
    h = (h ^ (h >> np.uint64(31))) * _Q
    return h ^ (h >> np.uint64(29))


def windows(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Fingerprint of each run of ``n`` word hashes, by doubling: the window of
    2k is made of two windows of k; a rest is put in front in the same way."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    base, length, done, covered = mix(h + np.uint64(seed) * _P), 1, None, 0
    while True:
        if n & length:
            if done is None:
                done, covered = base, length
            else:                                      # window of ``length`` followed by the part done
                done = mix(base[:len(done) - length] * _P + done[length:] + np.uint64(length))
                covered += length
        if covered == n:
            return done[:len(h) - n + 1]
        base = mix(base[:-length] * _P + base[length:] + np.uint64(2 * length))
        length *= 2
