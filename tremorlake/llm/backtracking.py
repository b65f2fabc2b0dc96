"""Exact byte-pair encoding of one word in linear time, without replaying the merges.

A sequence of tokens is what the merges give exactly if every pair of neighbours is:
the merges of the two joined strings give the same two tokens again. So the encoder
walks the word once, takes the longest vocabulary entry that starts at each place (all
found in one pass of an Aho-Corasick automaton), checks it against the token before
it in the pair table, and steps back to a shorter entry where the pair can't stand.
Places from which no way leads on are marked, so each is left once.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

# Moves the last symbol of a word to symbols of its own, as the vocabulary has ends of words.
_END = 0x8000
_MOST_PAIRS = 400_000
# Strings of one generation: white-space chunks and words within them. A word is a chunk with the same ids.
_STRINGS = 400_000
_LONGEST_HELD = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    symbols = {b: chr(b) for b in printable} | {b: chr(0x100 + n) for n, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


class BacktrackingBpe:
    """Merges of one vocabulary whose every entry is the encoding of its own string."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str | None):
        import ahocorasick

        self.suffix = suffix or ""
        spelled = {token: self._spell(token) for token in vocab}
        self.most = max(vocab.values()) + 1
        self.length = [0] * self.most
        for token, text in spelled.items():
            self.length[vocab[token]] = len(text)
        self.rank = [-1] * self.most
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            whole = vocab[left + right]
            pair = (vocab[left], vocab[right])
            if whole in self.parts:
                raise ValueError(f"two merges give {left + right!r}; pairs don't decide such a vocabulary")
            self.rank[whole], self.parts[whole], self.joined[pair] = rank, pair, whole
        self.automaton = ahocorasick.Automaton()
        for token, text in spelled.items():
            self.automaton.add_word(text, vocab[token])
        self.automaton.make_automaton()
        by_text = {s: vocab[t] for t, s in spelled.items()}
        self.shorter: list[int | None] = [None] * self.most
        for text, token in by_text.items():
            cuts = (by_text.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[token] = next((c for c in cuts if c is not None), None)
        self.stands: dict[int, bool] = {}

    def _spell(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + _END)
        return token

    def _pair_stands(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges that make both sides.

        The border's neighbours are undone from the latest merge back. A merge that would
        join them must not be earlier than the merge just undone.
        """
        latest = len(self.rank)
        undone_right = False
        while True:
            across = self.joined.get((left, right))
            if across is not None:
                rank = self.rank[across]
                # At equal rank the leftmost pair is merged first: the right side's own merge comes later.
                if rank < latest or (undone_right and rank == latest):
                    return False
            if self.rank[left] < 0 and self.rank[right] < 0:
                return True
            undone_right = self.rank[right] >= self.rank[left]
            if undone_right:
                latest = self.rank[right]
                right = self.parts[right][0]
            else:
                latest = self.rank[left]
                left = self.parts[left][1]

    def pair_stands(self, left: int, right: int) -> bool:
        place = left * self.most + right
        known = self.stands.get(place)
        if known is None:
            if len(self.stands) >= _MOST_PAIRS:
                self.stands.clear()
            known = self.stands[place] = self._pair_stands(left, right)
        return known

    def encode(self, symbols: str) -> list[int]:
        """Ids of one word, given as byte symbols."""
        n = len(symbols)
        if not n:
            return []
        text = symbols[:-1] + chr(ord(symbols[-1]) + _END) if self.suffix else symbols
        length, shorter = self.length, self.shorter
        stands, most, pair_stands = self.stands, self.most, self.pair_stands
        longest: list[int | None] = [None] * n
        for end, token in self.automaton.iter(text):
            longest[end + 1 - length[token]] = token  # ends ascend: the last one is the longest
        token = longest[0]
        if token is not None and length[token] == n:
            return [token]
        closed = None
        out: list[int] = []
        at, last = 0, -1
        while at < n:
            while token is not None:
                if closed is None or at + length[token] not in closed:
                    if last < 0:
                        break
                    known = stands.get(last * most + token)
                    if known or (known is None and pair_stands(last, token)):
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += length[token]
                last = token
                token = longest[at] if at < n else None
            else:
                if last < 0:
                    raise ValueError(f"the vocabulary can't spell {symbols!r}")
                closed = closed or set()
                closed.add(at)
                out.pop()
                at -= length[last]
                token = shorter[last]
                last = out[-1] if out else -1
        return out


class Held:
    """Encodings of the strings met lately, of two generations of a bounded number each."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, text: str) -> bytes | None:
        found = self.old.get(text)
        if found is not None:
            self.put(text, found)
        return found

    def put(self, text: str, ids: bytes) -> None:
        if len(text) > _LONGEST_HELD:
            return
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[text] = ids


# Characters below this compose with nothing below it and lower alike in every Unicode version.
_LATIN = 0x180
_BEYOND = re.compile(f"[^\\x00-{chr(_LATIN - 1)}]")


def latin_pattern(pattern: str) -> str:
    """The word pattern for Latin text, in classes that Python's own engine knows."""
    kinds = {c: unicodedata.category(chr(c))[0] for c in range(_LATIN)}
    letters, numbers = ("".join(f"\\u{c:04x}" for c in kinds if kinds[c] == k) for k in "LN")
    spaces = "\\t-\\r \\x85\\xa0"
    classes = {
        r"[\p{L}]": f"[{letters}]",
        r"[\p{N}]": f"[{numbers}]",
        r"[^\s\p{L}\p{N}]": f"[^{spaces}{letters}{numbers}]",
    }
    for theirs, ours in classes.items():
        pattern = pattern.replace(theirs, ours)
    if "\\p" in pattern:
        raise ValueError(f"unknown class in {pattern}")
    return pattern


class WordVocabulary:
    """A tokenizer file of the word kind: normal form, words, merges, and the decoding table."""

    def __init__(self, path: str):
        from tokenizers import Regex, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = spec["normalizer"]["normalizers"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        known = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
            and (level["type"], level["add_prefix_space"], level["use_regex"]) == ("ByteLevel", False, False)
            and spec["decoder"] is None
            and spec["model"]["type"] == "BPE"
        )
        added = spec["added_tokens"]
        if not known or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: not a lower-case word vocabulary with plain special tokens")
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = BacktrackingBpe(model["vocab"], merges, model["end_of_word_suffix"])
        self.words = re.compile(latin_pattern(split["pattern"]["Regex"]))
        self.symbols = dict(enumerate(byte_symbols()))
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.pieces = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        self.special = {t["content"]: t["id"] for t in added}
        in_order = sorted(self.special, key=len, reverse=True)
        self.borders = re.compile("(" + "|".join(map(re.escape, in_order)) + ")") if in_order else None
        self.strings = Held(_STRINGS)
        tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        # The decoder puts one space between tokens, so each entry ends in one.
        entries = [(tokens[i] + " ").encode() if i in tokens else b"" for i in range(max(tokens) + 1)]
        self.blob = b"".join(entries)
        offsets = array("q", [0])
        for e in entries:
            offsets.append(offsets[-1] + len(e))
        self.offsets = offsets

    def _word(self, word: str) -> bytes:
        ids = self.strings.young.get(word) or self.strings.get(word)
        if ids is None:
            ids = self._spelled(word)
            self.strings.put(word, ids)
        return ids

    def _spelled(self, word: str) -> bytes:
        # Letters and the other visible ASCII characters stand for themselves.
        plain = word.isascii() and word.isprintable()
        symbols = word if plain else word.encode().decode("latin-1").translate(self.symbols)
        return array("I", self.bpe.encode(symbols)).tobytes()

    def _piece(self, chunk: str) -> bytes:
        """Beyond Latin letters, normal form and words come from the tokenizer's own parts: Unicode tables differ by version."""
        if chunk.isascii() or not _BEYOND.search(chunk):
            words = self.words.findall(chunk.lower())
        else:
            words = [w for w, _ in self.pieces.pre_tokenize_str(self.normal.normalize_str(chunk))]
        if words == [chunk]:
            return self._spelled(chunk)
        return self._word(words[0]) if len(words) == 1 else b"".join(map(self._word, words))

    def _chunk(self, chunk: str) -> bytes:
        ids = self.strings.get(chunk)
        if ids is None:
            if "<" in chunk and self.borders:
                parts = self.borders.split(chunk)
                ids = b"".join(
                    array("I", [self.special[p]]).tobytes() if p in self.special else self._piece(p) for p in parts
                )
            else:
                ids = self._piece(chunk)
            self.strings.put(chunk, ids)
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, four bytes each. White space only ends words, so it is cut there first."""
        out = []
        for chunk in split_white(text):
            ids = self.strings.young.get(chunk)
            out.append(self._chunk(chunk) if ids is None else ids)
        return b"".join(out)

    def encode_all(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without white space."""
        young = self.strings.young.get
        return [self._chunk(c) if (ids := young(c)) is None else ids for c in chunks]

    def decode(self, ids: bytes, block: int = 1 << 18) -> bytes:
        """UTF-8 text of ids: each token's bytes are copied from its place in the table."""
        import numpy as np

        blob, offsets = np.frombuffer(self.blob, np.uint8), np.frombuffer(self.offsets, np.int64)
        every, parts = np.frombuffer(ids, np.uint32), []
        for first in range(0, len(every), block):
            some = every[first : first + block]
            starts = offsets[some]
            lengths = offsets[some + 1] - starts
            ends = np.cumsum(lengths)
            places = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
            parts.append(blob[places].tobytes())
        return b"".join(parts)[:-1]


# White space to Python's split, but not to the tokenizer.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_PLAIN_SPACE = re.compile("[ \n\r\t]+")


def split_white(text: str) -> list[str]:
    return [c for c in _PLAIN_SPACE.split(text) if c] if _NOT_SPACE.search(text) else text.split()
