"""Words, word-run hashes and set keys, computed batch-wise over Arrow columns.

A word is a maximal run of letters and digits of any script after NFKC, removal of invisible characters and lower
casing; an underscore separates words.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash

_INVISIBLE = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])
_ANY = re.compile(r"[^\W_]+")
_ASCII = re.compile(r"[0-9a-z]+")
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Distinct words whose hash a Python worker keeps; past it the cache starts anew.
CACHE_WORDS = 400_000


def words(text: str | None) -> list[str]:
    if not text:
        return []
    if text.isascii():
        return _ASCII.findall(text.lower())
    return _ANY.findall(unicodedata.normalize("NFKC", text).translate(_INVISIBLE).lower())


class WordHash(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), dtype=np.uint64, count=len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words; empty where there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * _M1 + hashes[i : i + n]
    return mix(h)


def text_runs(text: str | None, k: int, cache: WordHash) -> np.ndarray:
    """Sorted distinct run hashes of a text."""
    return np.unique(runs(cache.of(words(text)), k))


def set_key(values: np.ndarray) -> bytes:
    """128-bit key of a sorted hash set: equal sets, equal keys."""
    return xxhash.xxh3_128_digest(values.tobytes())


def long_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64, copy=False).view(np.int64)))
