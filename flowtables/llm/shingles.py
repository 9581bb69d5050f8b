"""Word shingles as 64-bit hashes, for use inside Python tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from flowtables.llm.common import ship_functions

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class WordHashes(dict):
    """Hash of each word, remembered; emptied when it holds many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: WordHashes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words.

    Words are runs without ASCII white space, A-Z lowered. Fewer words than
    ``width`` make one shingle of all; no words make none.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ h[i : i + n]) * np.uint64(_MULTIPLIERS[i % 5])
        out ^= out >> np.uint64(29)
    return np.unique(out)


ship_functions(__name__)
