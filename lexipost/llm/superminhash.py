"""SuperMinHash signatures of word shingles, computed for many documents at once.

Every element of a set draws a random permutation of the signature's slots; the
slot at rank j is offered the value j + r with r uniform in [0, 1). A slot keeps
the least value offered by any element. Two sets agree in a slot with probability
equal to their Jaccard similarity, and since an element's ranks are a permutation,
the slots are negatively correlated and the estimate varies less than with
independent hash functions.

All ranks below j are offered before rank j, so a slot that has any value after
rank j is final. Documents whose slots are all set need no further ranks: the
early stop of the method, here per document of a batch.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORD_CACHE = 200_000  # words whose hash a task remembers; emptied when full

_U64 = np.uint64
_GAMMA = _U64(0x9E3779B97F4A7C15)
_MIX_1 = _U64(0xBF58476D1CE4E5B9)
_MIX_2 = _U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the splitmix finaliser)."""
    x = (x ^ (x >> _U64(30))) * _MIX_1
    x = (x ^ (x >> _U64(27))) * _MIX_2
    return x ^ (x >> _U64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered while they fit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the ``size``-word shingles of a text.

    A-Z are lower-cased; a word is a run without U+0020 and U+0009-000D. A text of
    fewer words is one shingle, a text without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    at = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    rolled = mix(at[: len(at) - size + 1] + _U64(size))
    for k in range(1, size):
        rolled = mix(rolled * _GAMMA + at[k : len(at) - size + 1 + k])
    rolled.sort()
    return rolled[np.concatenate(([True], rolled[1:] != rolled[:-1]))]


def signatures(elements: np.ndarray, lengths: np.ndarray, slots: int) -> np.ndarray:
    """One row of ``slots`` float32 values per document.

    ``elements`` holds the documents' element hashes one after the other, and
    ``lengths`` how many each has (at least one). Values compare equal only if the
    same element won the slot, up to 24 bits of its draw.
    """
    docs = len(lengths)
    out = np.full(docs * slots, np.inf, np.float32)
    owner = np.repeat(np.arange(docs, dtype=np.int64), lengths)
    state = elements
    drawn: list[np.ndarray] = []  # Fisher-Yates draws so far, per active element
    for rank in range(slots):
        word = mix(state + np.uint64((0x9E3779B97F4A7C15 * (rank + 1)) & 0xFFFFFFFFFFFFFFFF))
        value = (word >> _U64(40)).astype(np.float32) * np.float32(2.0**-24)
        draw = rank + ((word & _U64(0xFFFFFFFF)) * _U64(slots - rank) >> _U64(32)).astype(np.int32)
        slot = draw.copy()
        for earlier in range(rank - 1, -1, -1):  # undo the swaps, latest first
            slot[slot == drawn[earlier]] = earlier
        drawn.append(draw)
        at = owner * slots + slot
        free = np.isinf(out[at])
        # Only slots without a value of an earlier rank take one of this rank.
        np.minimum.at(out, at[free], (value[free] + np.float32(rank)).astype(np.float32))
        open_docs = np.isinf(out.reshape(docs, slots)).any(axis=1)
        if not open_docs.any():
            break
        active = open_docs[owner]
        if not active.all():
            owner, state = owner[active], state[active]
            drawn = [d[active] for d in drawn]
    return out.reshape(docs, slots)
