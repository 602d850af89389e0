"""A run-length index over a collection of byte strings.

The Burrows-Wheeler transform of the collection is kept as runs of equal bytes,
with the suffix array sampled at the runs' ends only.  In repetitive collections
there are far fewer runs than bytes.  Matching statistics are then streamed in
text order: the longest match of a position with any other suffix is known
directly where its suffix starts or ends a run, and is one less than its
predecessor's everywhere else.
"""

from __future__ import annotations

import numpy as np


def _order(*keys: np.ndarray) -> np.ndarray:
    """Positions sorted by several columns of small integers, ties by position."""
    n = len(keys[0])
    bits, width = (max(n, 2) - 1).bit_length(), sum(max(int(k.max(initial=0)), 1).bit_length() for k in keys)
    if bits + width > 64:
        return np.lexsort(keys[::-1])
    packed = np.zeros(n, np.uint64)  # one sort of plain numbers is several times faster than an indirect one
    for k in keys:
        packed = (packed << np.uint64(max(int(k.max(initial=0)), 1).bit_length())) | k.astype(np.uint64)
    packed = np.sort((packed << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


class RunLengthIndex:
    """The index of a list of strings without the bytes 255 (UTF-8 has none)."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.data = b"\0".join(strings) + b"\0"
        n = len(self.data)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        # bytes before the string's end, at each position; 0 at the ends themselves
        self.left = (np.repeat(self.starts + lengths, lengths + 1) - np.arange(n)).astype(np.int32)
        symbols = np.frombuffer(self.data, np.uint8) + np.uint8(1)
        symbols[self.left == 0] = 0
        order = self._suffix_array(symbols, int(lengths.max(initial=0)))
        before = symbols[order - 1]
        before[order == 0] = 0
        # each end is a symbol of its own: it never continues a run
        new_run = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
        self.run_heads = np.flatnonzero(new_run)
        self.run_tails = np.concatenate([self.run_heads[1:] - 1, [n - 1]])
        self.run_symbols = before[self.run_heads]
        # the samples: suffixes at the runs' ends, and the suffix next to each in the order
        # (a head's neighbour is the tail of the run before it, so one comparison serves both)
        common = self._common(order[self.run_heads[1:]], order[self.run_tails[:-1]])
        self.head_samples = order[self.run_heads], np.concatenate([[0], common])
        self.tail_samples = order[self.run_tails], np.concatenate([common, [0]])
        del self._levels, self._first

    def _suffix_array(self, symbols: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes in order, by prefix doubling; each string ends in a symbol of its own, so ties go by position.

        A suffix's rank is the place where its group of equal prefixes starts; only
        groups of several suffixes are sorted again.  The ranks of every length are
        kept until the samples are taken.
        """
        n = len(symbols)
        key = symbols.astype(np.uint64)
        for j in (1, 2, 4):  # eight symbols, nothing of the next string
            after = np.zeros(n, np.uint64)
            after[:-j] = key[j:]
            key = (key << np.uint64(8 * j)) | np.where(self.left > j, after, np.uint64(0))
        self._first = key
        order = np.argsort(key)
        ordered = key[order]
        head = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.arange(n, dtype=np.int32) * head)
        open_ = order[~head | ~np.append(head[1:], True)].astype(np.int32)
        self._levels, h = [(8, rank)], 8
        while h < longest and len(open_):
            ahead = np.where(self.left[open_] > h, rank[np.minimum(open_ + np.int32(h), n - 1)] + 1, 0)
            own = rank[open_]
            by = _order(own, ahead)
            open_, own, ahead = open_[by], own[by], ahead[by]
            group = np.concatenate([[True], own[1:] != own[:-1]])
            head = group | np.concatenate([[True], ahead[1:] != ahead[:-1]])
            if head.sum() == group.sum():
                break  # equal prefixes of this length are equal to their ends
            at = np.arange(len(open_), dtype=np.int32)
            rank = rank.copy()
            rank[open_] = own + np.maximum.accumulate(at * head) - np.maximum.accumulate(at * group)
            open_ = open_[~head | ~np.append(head[1:], True)]
            h *= 2
            self._levels.append((h, rank))
        return _order(rank)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes a and b, from the ranks of each length, longest first."""
        # equal ranks of the longest length are equal to their ends
        (_, last), *shorter = reversed(self._levels)
        found = np.where(last[a] == last[b], self.left[a], 0)
        for h, rank in shorter:
            x, y = a + found, b + found
            found += np.where(rank[x] == rank[y], np.minimum(h, self.left[x]), 0)
        x = a + found
        differ = self._first[x] ^ self._first[b + found]
        same_bytes = sum((differ < np.uint64(1 << (64 - 8 * k))).astype(np.int8) for k in range(1, 8))
        return found + np.where(differ > 0, same_bytes, np.minimum(8, self.left[x]))

    def matching_statistics(self) -> np.ndarray:
        """For each position the length of its longest match with any other position of the collection."""
        n = len(self.data)
        longest = np.zeros(n, np.int64)
        for places, values in (self.head_samples, self.tail_samples):
            sampled = np.zeros(n, np.int64)
            sampled[places] = places
            known = np.zeros(n, np.int64)
            known[places] = values
            last = np.maximum.accumulate(sampled)
            np.maximum(longest, known[last] - (np.arange(n) - last), out=longest)
        return longest

    def long_matches(self, least: int) -> list[np.ndarray]:
        """For each string a boolean per position: do the ``least`` bytes from there occur elsewhere?"""
        marks = self.matching_statistics() >= least
        ends = np.append(self.starts[1:], len(marks) + 0) - 1 if len(self.starts) else []
        return [marks[a:b] for a, b in zip(self.starts, ends, strict=True)]


def runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
