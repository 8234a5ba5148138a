"""A bidirectional FM-index over a set of words, for batches of queries.

The words are joined as ``$w1$w2$...$`` in code-point order.  The suffix ranks
(rotations in sorted order) of that string and of its reverse come from prefix
doubling; a wavelet matrix over each Burrows-Wheeler transform counts, for many
intervals at once, the occurrences of a symbol and of all smaller ones.  An
interval of the string and the interval of the reversed pattern in the reversed
string are kept in step, so a pattern can grow at either end.

``one_error`` holds the two search schemes for one error: match one half of a
word exactly, extend across the other half allowing one replaced or one
inserted symbol, up to the delimiters.  Symbol 0 is the delimiter.
"""

from __future__ import annotations

import numpy as np


class Wavelet:
    """Counts of symbols in prefixes of a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.zeros_before, self.zeros, rest = [], [], symbols
        for level in range(bits - 1, -1, -1):
            zero = ((rest >> level) & 1) == 0
            self.zeros_before.append(np.concatenate([[0], np.cumsum(zero, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(zero.sum()))
            rest = np.concatenate([rest[zero], rest[~zero]])
        # The last level keeps equal symbols together: where each begins.
        values, first = np.unique(rest, return_index=True)
        self.start, self.bits = np.zeros(1 << bits, np.int64), bits
        self.start[values] = first

    def narrow(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Occurrences of ``symbol`` before ``lo`` and before ``hi``, and how
        many smaller symbols lie in [lo, hi)."""
        lo, hi = lo.astype(np.int64), hi.astype(np.int64)
        smaller = np.zeros(len(lo), np.int64)
        for level, before, zeros in zip(range(self.bits - 1, -1, -1), self.zeros_before, self.zeros):
            low, high = before[lo].astype(np.int64), before[hi].astype(np.int64)
            one = ((symbol >> level) & 1) == 1
            smaller += np.where(one, high - low, 0)
            lo = np.where(one, zeros + lo - low, low)
            hi = np.where(one, zeros + hi - high, high)
        first = self.start[symbol]
        # An absent symbol has no start; its interval is empty all the same.
        return np.where(hi > lo, lo - first, 0), np.where(hi > lo, hi - first, 0), smaller


def sorted_rotations(text: np.ndarray) -> np.ndarray:
    """Start positions of the rotations of ``text`` in sorted order, by prefix
    doubling.  No two rotations may be equal."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        pair = rank * (n + 1) + np.roll(rank, -width)
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class BidirectionalIndex:
    """Index of distinct words in sorted order, without the delimiter."""

    def __init__(self, words: list[str]):
        joined = "".join("\x00" + w for w in words) + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.alphabet, text = np.unique(points, return_inverse=True)
        text = text.astype(np.int64).ravel()
        self.bits = max(1, int(len(self.alphabet) - 1).bit_length())
        forward = sorted_rotations(text)
        backward = sorted_rotations(text[::-1])
        self.before = text[forward - 1]                 # symbol left of every row
        self.after = text[::-1][backward - 1]           # symbol right of every reversed row
        self.left, self.right = Wavelet(self.before, self.bits), Wavelet(self.after, self.bits)
        self.first = np.searchsorted(np.sort(text), np.arange((1 << self.bits) + 1))
        self.size = len(text)
        # Rows of the delimiter come first; the k-th delimiter precedes word k.
        opening = np.flatnonzero(text == 0)
        self.word_of_row = np.searchsorted(opening, forward[:len(opening)])

    def codes(self, words: list[str]) -> np.ndarray:
        """Symbols of words of one length, a row each; -1 where the index has
        no such symbol."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def everything(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The empty pattern, ``n`` times: (row, reversed row, size)."""
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size, np.int64)

    def extend(self, state, symbol: np.ndarray, to_right: bool):
        """Patterns grown by a symbol at one end; size 0 where none occurs."""
        row, mirrored, size = state
        tree, grown, other = (self.right, mirrored, row) if to_right else (self.left, row, mirrored)
        known = np.maximum(symbol, 0)
        low, high, smaller = tree.narrow(known, grown, grown + size)
        count = np.where(symbol >= 0, high - low, 0)
        grown, other = self.first[known] + low, other + smaller
        return (other, grown, count) if to_right else (grown, other, count)

    def neighbours(self, state, to_right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, symbol) for every symbol that may follow a pattern at one
        end, without the delimiter.  Small intervals are read, larger ones
        try the alphabet."""
        row, mirrored, size = state
        start, symbols = (mirrored, self.after) if to_right else (row, self.before)
        small = np.flatnonzero(size <= len(self.alphabet))
        counts = size[small]
        pattern = np.repeat(small, counts)
        within = np.arange(len(pattern)) - np.repeat(np.cumsum(counts) - counts, counts)
        read = symbols[np.repeat(start[small], counts) + within]
        both = np.unique(pattern << self.bits | read)
        large = np.flatnonzero(size > len(self.alphabet))
        tried = np.arange(len(self.alphabet))
        pattern = np.concatenate([both >> self.bits, np.repeat(large, len(tried))])
        symbol = np.concatenate([both & ((1 << self.bits) - 1), np.tile(tried, len(large))])
        return pattern[symbol > 0], symbol[symbol > 0]


def _taken(state, which):
    return tuple(part[which] for part in state)


def _joined(one, two):
    return tuple(np.concatenate(parts) for parts in zip(one, two))


def one_error(index: BidirectionalIndex, queries: list[str], exact_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) positions of all indexed words that come from a query by
    replacing or inserting one symbol in the half that is not matched exactly
    (the first ``length // 2`` symbols are one half, the others the other).

    ``queries`` have one length.  The pattern is matched exactly over its half
    and the delimiter beside it, then grown at the other end.
    """
    codes = index.codes(queries)
    half = codes.shape[1] // 2
    border = np.zeros((len(codes), 1), codes.dtype)
    if exact_first:                                     # $half, then to the right
        exact, rest = codes[:, :half][:, ::-1], np.hstack([codes[:, half:], border])
        exact = np.hstack([exact, border])
    else:                                               # half$, then to the left
        exact, rest = codes[:, half:][:, ::-1], np.hstack([codes[:, :half][:, ::-1], border])
        exact = np.hstack([border, exact])

    query, state = np.arange(len(codes)), index.everything(len(codes))
    for j in range(exact.shape[1]):
        state = index.extend(state, exact[query, j], to_right=False)
        alive = state[2] > 0
        query, state = query[alive], _taken(state, alive)

    wrong, wrong_state = query[:0], _taken(state, slice(0, 0))
    for j in range(rest.shape[1]):
        # Any other symbol here either stands for this one or comes before it.
        # (An inserted symbol equal to this one is found one step later.)
        pattern, symbol = index.neighbours(state, exact_first)
        other = symbol != rest[query[pattern], j]
        pattern, symbol = pattern[other], symbol[other]
        branch = index.extend(_taken(state, pattern), symbol, exact_first)
        occurs = branch[2] > 0
        branched, branch = query[pattern][occurs], _taken(branch, occurs)

        wrong, wrong_state = np.concatenate([wrong, branched]), _joined(wrong_state, branch)
        wrong_state = index.extend(wrong_state, rest[wrong, j], exact_first)
        alive = wrong_state[2] > 0
        wrong, wrong_state = wrong[alive], _taken(wrong_state, alive)
        if j < rest.shape[1] - 1:                       # the delimiter is never replaced
            wrong, wrong_state = np.concatenate([wrong, branched]), _joined(wrong_state, branch)

        state = index.extend(state, rest[query, j], exact_first)
        alive = state[2] > 0
        query, state = query[alive], _taken(state, alive)
        if not len(query) and not len(wrong):
            break
    # Every pattern is now $word$, which occurs once.
    return wrong, index.word_of_row[wrong_state[0]]
