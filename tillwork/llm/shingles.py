"""Shingle sets of whole texts as sorted 64-bit hashes, many documents at once in numpy."""

from itertools import chain

import numpy as np
import xxhash

CACHED_WORDS = 200_000  # of a Python worker; beyond it the cache starts anew

def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """A-Z in lower case, split at ASCII white space, which is what bytes.split() does."""
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Turns batches of texts into (sorted distinct shingle hashes, first index of each text)."""

    def __init__(self, width: int):
        self.width = width
        self.hashes = WordHashes()

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        if len(self.hashes) > CACHED_WORDS:
            self.hashes.clear()
        split = [words(text) for text in texts]
        sizes = np.array([len(w) for w in split], dtype=np.int64)
        look = self.hashes.__getitem__
        flat = np.fromiter(map(look, chain.from_iterable(split)), np.uint64, int(sizes.sum()))
        start = np.concatenate([[0], np.cumsum(sizes)])
        found = []
        for k, size in enumerate(sizes):
            w = flat[start[k] : start[k + 1]]
            n = min(self.width, size)  # a shorter text is one shingle
            if n == 0:
                found.append(w)
                continue
            total = np.full(size - n + 1, n, dtype=np.uint64)
            for j in range(n):
                part = w[j : size - n + 1 + j]
                total += (part ^ (part >> np.uint64(29))) * _odd(j)
            total = mixed(total)
            total.sort()
            if len(total) > 1:
                total = total[np.concatenate([[True], total[1:] != total[:-1]])]
            found.append(total)
        counts = np.array([len(x) for x in found], dtype=np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        return flat, np.concatenate([[0], np.cumsum(counts)])


def _odd(j: int) -> np.uint64:
    """An odd multiplier for position ``j``."""
    return np.uint64(xxhash.xxh3_64_intdigest(j.to_bytes(4, "little")) | 1)


def shingle_set(text: str | None, width: int) -> set:
    """The shingles themselves, for the exact test."""
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*[w[j:] for j in range(width)]))
