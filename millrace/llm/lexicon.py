"""How common words are, read off the ranks of a public tokenizer's vocabulary.

Byte-pair vocabularies rank words by how often they were met. A word that stands in them in lower case is a common word; one that
stands there only with a capital is a proper noun; one that doesn't stand there is rare. The vocabularies are read from
``tokenize.TOKENIZERS`` on the driver and never copied.
"""

from __future__ import annotations

import base64
import functools
import os
import unicodedata

from millrace.llm import tokenize

# The vocabularies that are read.
VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
#: What a word counts that isn't there, in doublings of rank.
ABSENT = 18


def fold(w: str) -> str:
    """Lower case without accents."""
    w = w.lower()
    return w if w.isascii() else "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))


class Lexicon:
    def __init__(self, low: dict[str, int], up: dict[str, int]):
        self.low, self.up = low, up

    def rank(self, word: str) -> tuple[int, int]:
        """Doublings of the word's rank in lower case and with a capital; plurals count as their stem where they are unknown."""
        w = word.lower()
        low = self.low.get(w, ABSENT)
        if low == ABSENT and w.endswith("s"):
            low = self.low.get(w[:-1], ABSENT)
        return low, self.up.get(w, ABSENT)

    def stem(self, word: str) -> int:
        """Doublings of the rank of the commonest word that this one may be derived from: it without an ending of up to three
        letters, with or without a negation before it, or with its ending doubled."""
        w, best = word.lower(), ABSENT
        for x in (w, w[2:]) if w[:2] in ("un", "in", "re") and len(w) > 6 else (w,):
            for k in range(1, 4):
                if len(x) - k > 2:
                    best = min(best, self.low.get(x[:-k], ABSENT), self.low.get(x[:-k] + "e", ABSENT))
                    if x[-k - 1] == x[-k - 2] and len(x) - k > 4:
                        best = min(best, self.low.get(x[: -k - 1], ABSENT))
        return best


@functools.lru_cache(maxsize=2)
def read(folder: str | None = None) -> Lexicon:
    """The lexicon of the vocabularies in ``folder``; some 60,000 words, whatever the input."""
    low, up = {}, {}
    for name in VOCABULARIES:
        with open(os.path.join(folder or tokenize.TOKENIZERS, name), "rb") as f:
            for line in f:
                a, rank = line.split()
                try:
                    w = base64.b64decode(a).decode("utf-8")
                except UnicodeDecodeError:
                    continue
                if w[:1] == " " and len(w) > 2 and w[1:].isalpha():
                    to = low if w[1:].islower() else up if w[1].isupper() and w[2:].islower() else None
                    if to is not None:
                        k = w[1:].lower()
                        to[k] = min(to.get(k, ABSENT), (int(rank) + 1).bit_length())
    return Lexicon(low, up)
