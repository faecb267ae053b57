"""Byte-pair encoding of many words at once by a depth-first walk over their prefix trie.

The encoding of a byte string is a chain of tokens in which every neighbouring pair is itself encoded as that pair. So a
prefix needs only one state, the last token of its encoding: among the tokens that end the prefix exactly one fits the
last token of the prefix that it leaves. Words in sorted order visit their trie depth first, and a word starts with the
states of the prefix it shares with the word before, so the encoding of a shared prefix is computed once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import regex


def read_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: base64 token and rank in each line."""
    with open(path, "rb") as f:
        return parse_ranks(f.read())


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class TrieEncoder:
    """Encodes text without special tokens.

    ``memory`` bounds the words and the token pairs that are remembered from batch to batch; beyond it they are forgotten,
    which costs time but changes no result.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = 400_000):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.words = regex.compile(pattern).findall
        self.memory = memory
        self.known: dict[str, list[int]] = {}
        self.fits: dict[int, bool] = {}
        # Tokens as a trie over their reversed bytes: step maps (node, byte) to a node, ends maps a node to its token.
        self.step: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        nodes = 0
        for token, i in ranks.items():
            at = 0
            for byte in reversed(token):
                key = at << 8 | byte
                nxt = self.step.get(key)
                if nxt is None:
                    nodes += 1
                    nxt = self.step[key] = nodes
                at = nxt
            self.ends[at] = i

    def plain(self, data: bytes) -> list[int]:
        """Merge by merge, lowest rank and leftmost first; only for pairs of tokens and as a reference in tests."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fit(self, left: int, right: int) -> bool:
        """Whether ``left`` may stand before ``right``; left -1 is the start of the word."""
        key = left << 24 | right if left >= 0 else -1 - right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > self.memory:
                self.fits.clear()
            if left < 0:
                known = self.plain(self.bytes_of[right]) == [right]
            else:
                known = self.plain(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self.fits[key] = known
        return known

    def _walk(self, words: list[bytes]) -> Iterable[list[int]]:
        """The encodings of sorted words, in that order."""
        step, ends, length, fit = self.step, self.ends, self.length, self._fit
        last: list[int] = [-1]  # last[n]: last token of the first n bytes of the word at hand
        before = b""
        for word in words:
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            del last[same + 1 :]
            for n in range(same + 1, len(word) + 1):
                at, back, found = 0, n, []
                while back:
                    nxt = step.get(at << 8 | word[back - 1])
                    if nxt is None:
                        break
                    at = nxt
                    back -= 1
                    token = ends.get(at)
                    if token is not None:
                        found.append(token)
                for token in reversed(found):
                    if fit(last[n - length[token]], token):
                        last.append(token)
                        break
                else:
                    raise ValueError("the vocabulary lacks single bytes")
            ids, n = [], len(word)
            while n:
                token = last[n]
                ids.append(token)
                n -= length[token]
            ids.reverse()
            before = word
            yield ids

    def learn(self, words: Iterable[str]) -> None:
        """Encode those of the distinct words that aren't known yet, in one walk."""
        if len(self.known) > self.memory:
            self.known.clear()
        todo = {w.encode("utf-8", "surrogatepass"): w for w in words if w not in self.known}
        order = sorted(todo)
        for data, ids in zip(order, self._walk(order)):
            self.known[todo[data]] = ids

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; none for empty and null texts."""
        split = [self.words(t) if t else [] for t in texts]
        self.learn({w for ws in split for w in ws})
        known = self.known
        return [[i for w in ws for i in known[w]] for ws in split]
