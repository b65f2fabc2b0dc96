"""Words of texts as 64-bit digests, and digests of runs of words, inside tasks."""

from __future__ import annotations

import re

from tremorlake.llm.worker import held

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Plain text splits on its white space; other characters that Python splits on are part of words here.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_MOST_WORDS = 400_000
# The bytes between words, and bytes that are summed up at once; a longer word is taken whole.
_SPACES = [9, 10, 11, 12, 13, 32]
_PIECE = 1 << 18


class _Digests(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= _MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str) -> list[str]:
    return WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def word_digests(text: str):
    import numpy as np

    words = words_of(text)
    table = held("word digests", _Digests)
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mixed(x):
    """A 64-bit finaliser over an array, in place."""
    import numpy as np

    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _byte_digests(data, first, last):
    """Digests of the words of some bytes, given as 8-bit numbers, from their first bytes and the ends.

    A byte counts by its value and its place in the word; white space counts nothing, so a word is summed up to the next one.
    """
    import numpy as np

    values = mixed(np.arange(1, 257, dtype=np.uint64))
    values[_SPACES] = 0
    out = np.zeros(len(first), np.uint64)
    places = mixed(np.arange(1000, 1000 + int((last - first).max(initial=0)), dtype=np.uint64)) | np.uint64(1)
    n = 0
    while n < len(first):
        m = max(n + 1, int(np.searchsorted(first, first[n] + _PIECE)))
        starts = (first[n:m] - first[n]).astype(np.int32)
        size = int(last[m - 1] - first[n])
        at = np.arange(size, dtype=np.int32) - np.repeat(starts, np.diff(starts, append=np.int32(size)))
        some = values[data[first[n] : first[n] + size]]
        some *= places[np.minimum(at, len(places) - 1)]
        out[n:m] = np.add.reduceat(some, starts)
        n = m
    return mixed(out)


def joined_runs(texts: list[str], size: int):
    """Digests of all runs of ``size`` words of many texts in one array, and where each text's words start.

    A run is at the place of its first word; places whose run would leave its text are zero.
    """
    import numpy as np

    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    space = np.zeros(256, bool)
    space[_SPACES] = True
    in_word = np.concatenate(([False], ~space[data]))
    edges = np.flatnonzero(in_word[1:] != in_word[:-1])
    first, last = edges[::2], edges[1::2]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], np.searchsorted(first, ends)))
    counts = np.diff(starts)
    digests = _byte_digests(data, first, last)
    rolled = np.zeros(len(digests), np.uint64)
    reach = max(0, len(digests) - size + 1)
    for n in range(size):
        rolled[:reach] *= np.uint64(0x9E3779B97F4A7C15)
        rolled[:reach] += digests[n : n + reach]
    mixed(rolled)
    for back in range(1, size):
        # Of a text with fewer words than that, the place belongs to a text before, and is zero there too.
        rolled[starts[1:][counts >= back] - back] = 0
    return rolled, starts


def run_digests(text: str, size: int):
    """Digests of all runs of ``size`` words; a shorter text is one run of all its words."""
    import numpy as np

    digests = word_digests(text)
    size = min(size, len(digests))
    if not size:
        return digests
    rolled = np.zeros(len(digests) - size + 1, np.uint64)
    for n in range(size):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled += digests[n : n + len(rolled)]
    return mixed(rolled)
