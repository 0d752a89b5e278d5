"""A level of an n-gram trie with Elias-Fano sequences over memory-mapped arrays."""

from __future__ import annotations

import mmap

import numpy as np

_ones = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_select = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    _set = [k for k in range(8) if _byte >> k & 1]
    _select[_byte, : len(_set)] = _set


def mapped(x: np.ndarray) -> np.ndarray:
    """x in mapped memory of its own, outside the heap, which goes back to the system with the last use of it."""
    if not x.size:
        return x
    memory = mmap.mmap(-1, x.nbytes)
    out = np.frombuffer(memory, x.dtype)
    out[:] = x
    out.flags.writeable = False
    return out


class EliasFano:
    """A rising sequence of integers: low bits packed, high bits as unary gaps; about two bits more than log2(largest / n) for each."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        top = int(values[-1]) if n else 0
        self.n, self.bits = n, max((top // max(n, 1)).bit_length() - 1, 0)
        low = (values & np.uint64((1 << self.bits) - 1)).astype("<u8")
        stored = np.zeros(n * self.bits // 8 + 9, np.uint8)
        for k in range(0, n, 1 << 16):  # a multiple of 8 numbers at a time
            part = np.unpackbits(low[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, : self.bits]
            data = np.packbits(part.reshape(-1), bitorder="little")
            stored[k * self.bits // 8 :][: len(data)] = data
        self.low = mapped(stored)
        high = (values >> np.uint64(self.bits)).astype(np.int64)
        size = -(-(n + (top >> self.bits) + 2) // 64) * 64
        marks = np.zeros(size, bool)
        marks[high + np.arange(n)] = True
        self.high = mapped(np.packbits(marks, bitorder="little"))
        per_word = _ones[np.asarray(self.high)].reshape(-1, 8).sum(1, dtype=np.int64)
        self.ranks = mapped(np.append(0, np.cumsum(per_word)))

    def _pick(self, turn: np.ndarray, zeros: bool) -> np.ndarray:
        """Places of the turn-th ones (or zeros) of the high bits."""
        ranks = np.arange(len(self.ranks)) * 64 - self.ranks if zeros else self.ranks
        word = np.searchsorted(ranks, turn, "right") - 1
        left = turn - ranks[word]
        data = np.asarray(self.high).reshape(-1, 8)[word]
        data = ~data if zeros else data
        sums = np.cumsum(_ones[data], axis=1, dtype=np.uint8)
        byte = (sums <= left.astype(np.uint8)[:, None]).sum(1, dtype=np.int64)
        rows = np.arange(len(turn))
        left = left - np.where(byte > 0, sums[rows, byte - 1], 0)
        return word * 64 + byte * 8 + _select[data[rows, byte], left]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.bits
        eight = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        return (eight[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)

    def access(self, at: np.ndarray) -> np.ndarray:
        return ((self._pick(at, False) - at).astype(np.uint64) << np.uint64(self.bits)) | self._lows(at)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first place with a value of x or more among those with x's high bits, that run's end, and the high bits searched for (the last ones, for larger x)."""
        high = np.minimum((x >> np.uint64(self.bits)).astype(np.int64), len(self.high) * 8 - self.n - 1)
        low = np.where(high > 0, self._pick(np.maximum(high - 1, 0), True) - (high - 1), 0)
        up = end = self._pick(high, True) - high
        want = x & np.uint64((1 << self.bits) - 1)
        while (open_ := low < up).any():
            middle = (low + up) >> 1
            less = self._lows(np.minimum(middle, self.n - 1)) < want
            low, up = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, up)
        return low, end, high

    def successor(self, x: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place in [first, end) with a value of x or more; end if there's none."""
        return np.minimum(np.maximum(self._search(x)[0], first), end)

    def place(self, x: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place in [first, end) with the value x; -1 if there's none. The successor's bits tell, so its value isn't read once more."""
        low, run, high = self._search(x)
        own = (x >> np.uint64(self.bits)).astype(np.int64) == high
        there = own & (low >= first) & (low < np.minimum(run, end))
        there &= self._lows(np.minimum(low, self.n - 1)) == x & np.uint64((1 << self.bits) - 1)
        return np.where(there, low, -1)


class Trie:
    """Contexts with counts and codes; below each, its followers with codes.

    A follower is the number of its hash among the trie's followers, added to
    the last value of the context before, so one rising sequence holds all.
    """

    def __init__(self, contexts: np.ndarray, owner: np.ndarray, followers: np.ndarray, codes: np.ndarray):
        """contexts: sorted hashes; owner: place of each follower's context, rising; followers: hashes, rising in a context."""
        self.contexts = mapped(contexts)
        self.names, number = np.unique(followers, return_inverse=True)
        self.names = mapped(self.names)
        counts = np.bincount(owner, minlength=len(contexts))
        ends = np.cumsum(counts)
        self.pointers = EliasFano(np.append(0, ends).astype(np.uint64))
        last = np.where(counts > 0, number[np.maximum(ends - 1, 0)] + 1 if len(number) else 0, 0)
        before = np.cumsum(last) - last
        self.followers = EliasFano((number + 1 + before[owner]).astype(np.uint64))
        self.codes = mapped(codes)

    def find(self, context: np.ndarray, follower: np.ndarray) -> np.ndarray:
        """Codes of followers below the contexts at these places; 0 where there's none."""
        out = np.zeros(len(context), np.uint16)
        if not self.followers.n:
            return out
        number = np.searchsorted(self.names, follower)
        known = np.flatnonzero(self.names[np.minimum(number, len(self.names) - 1)] == follower)
        ends = self.pointers.access(np.arange(self.pointers.n)).astype(np.int64)  # each context's run once, not for each question
        base = np.where(ends > 0, self.followers.access(np.maximum(ends - 1, 0)), np.uint64(0))
        for k in range(0, len(known), 1 << 18):
            at = known[k : k + (1 << 18)]
            of = context[at]
            place = self.followers.place(base[of] + (number[at] + 1).astype(np.uint64), ends[of], ends[of + 1])
            hit = place >= 0
            out[at[hit]] = self.codes[place[hit]]
        return out
