"""Byte-level BPE without a tokenizer library: two exact encoders over a public rank file.

``HeapEncoder`` keeps a piece as a linked list of symbols and a priority queue of merges.
``BacktrackEncoder`` finds the same ids in linear time: longest vocabulary matches from an
Aho-Corasick automaton over Latin-1 mapped bytes, accepted only when two neighbouring
tokens are compatible (their joint encoding is exactly the pair), with backtracking.

Both split text first into *units*, runs of white space with the following run of other
characters. A pre-token never spans a change from other characters to white space, so
units encode independently and can be cached.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from functools import lru_cache

#: Fixed value: the published pre-token pattern of the byte_bpe_50k vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as in PRE_TOKEN: unlike str.isspace without the separators U+001C to U+001F.
UNIT = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
DEFAULT_RANKS = os.environ.get("GLOSSWRIGHT_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
CACHE_ENTRIES = 300_000
CACHE_CHARS = 48


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class _UnitCache(dict):
    """unit -> result of ``encode``; long units are computed but not kept, and size is bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit):
        value = self.encode(unit)
        if len(unit) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[unit] = value
        return value


class HeapEncoder:
    """Merges by rank with a linked symbol list and a heap: O(n log n) in the piece length."""

    def __init__(self, path: str = DEFAULT_RANKS):
        import regex

        self.ranks = load_ranks(path)
        self.pieces = regex.compile(PRE_TOKEN).findall
        self.counts = _UnitCache(self._unit_count)

    def merge(self, piece: bytes) -> list[bytes]:
        """Symbols of *piece* that survive when every applicable merge was made in rank order."""
        n = len(piece)
        if n < 2 or piece in self.ranks:
            return [piece] if n else []
        ranks, symbol = self.ranks, [piece[i : i + 1] for i in range(n)]
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := ranks.get(symbol[i] + symbol[j])) is not None:
                heapq.heappush(queue, (rank, i, len(symbol[i]) + len(symbol[j])))

        for i in range(n - 1):
            offer(i)
        while queue:
            rank, i, size = heapq.heappop(queue)
            if symbol[i] is None or (j := after[i]) < 0 or len(symbol[i]) + len(symbol[j]) != size:
                continue  # one side was merged elsewhere since
            joined = symbol[i] + symbol[j]
            if ranks.get(joined) != rank:
                continue
            symbol[i], symbol[j], after[i] = joined, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbol if s is not None]

    def _unit_count(self, unit: str) -> int:
        return sum(len(self.merge(p.encode("utf-8", "replace"))) for p in self.pieces(unit))

    def count(self, text: str | None) -> int:
        """Tokens of *text*; 0 for null and for empty text."""
        return sum(map(self.counts.__getitem__, UNIT.findall(text))) if text else 0


class BacktrackEncoder:
    """Exact ids through longest matches, neighbour compatibility and backtracking."""

    def __init__(self, path: str = DEFAULT_RANKS):
        import ahocorasick
        import regex

        self.ranks = load_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(PRE_TOKEN).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.units = _UnitCache(self._unit_ids)

    def _split(self, rank: int) -> tuple[int, int]:
        """The two tokens whose merge made *rank*; (rank, rank) for a single byte."""
        if (found := self.halves.get(rank)) is None:
            token = self.tokens[rank]
            if len(token) == 1:
                found = (rank, rank)
            else:
                parts = [token[i : i + 1] for i in range(len(token))]
                while len(parts) > 2:
                    at = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
                    parts[at : at + 2] = [parts[at] + parts[at + 1]]
                found = (self.ranks[parts[0]], self.ranks[parts[1]])
            self.halves[rank] = found
        return found

    def _fits(self, left: int, right: int) -> bool:
        """Whether the bytes of left and right, encoded together, give exactly these two ids."""
        key = (left, right)
        if (known := self.compatible.get(key)) is None:
            if len(self.compatible) >= 1_000_000:
                self.compatible.clear()
            self.compatible[key] = known = self._decide(left, right)
        return known

    def _decide(self, left: int, right: int) -> bool:
        # Undo merges at the seam from the latest to the earliest: a merge across the seam
        # that ranks before the one just undone would have been made first.
        bound = 1 << 60
        while True:
            across = self.ranks.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < bound and self._split(across) == (left, right):
                return False
            a, b = self._split(left)[1], self._split(right)[0]
            if left > right and a != left:
                bound, left = left, a
            elif b != right and (left <= right or a == left):
                bound, right = right + 1, b
            elif a != left:
                bound, left = left, a
            else:
                return True

    def piece_ids(self, piece: bytes) -> list[int]:
        n = len(piece)
        whole = self.ranks.get(piece)
        if whole is not None or not n:
            return [whole] if n else []
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (size, rank) in self.automaton.iter(piece.decode("latin-1")):
            starts[end - size + 1].append((size, rank))  # grows with end, so shortest first
        dead, path, at, turn = bytearray(n + 1), [], 0, [len(s) for s in starts]
        while at < n:
            while turn[at]:
                turn[at] -= 1
                size, rank = starts[at][turn[at]]
                if not dead[at + size] and (not path or self._fits(path[-1][1], rank)):
                    path.append((size, rank))
                    at += size
                    break
            else:
                turn[at] = len(starts[at])
                dead[at] = 1
                at -= path.pop()[0]
                continue
            if at < n:
                turn[at] = len(starts[at])
        return [rank for _, rank in path]

    def _unit_ids(self, unit: str) -> tuple[int, ...]:
        return tuple(i for p in self.pieces(unit) for i in self.piece_ids(p.encode("utf-8", "replace")))

    def ids(self, text: str | None) -> list[int]:
        """Token ids of *text*; an empty list for null and for empty text."""
        out: list[int] = []
        for part in map(self.units.__getitem__, UNIT.findall(text or "")):
            out += part
        return out


@lru_cache(maxsize=2)
def heap_encoder(path: str = DEFAULT_RANKS) -> HeapEncoder:
    return HeapEncoder(path)


@lru_cache(maxsize=2)
def backtrack_encoder(path: str = DEFAULT_RANKS) -> BacktrackEncoder:
    return BacktrackEncoder(path)
