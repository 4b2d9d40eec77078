"""A run-length index over byte pieces: which strings of a fixed length occur earlier?

The pieces are put one after the other, each with an end mark of its own, and their suffixes
are sorted once. What is kept is the Burrows-Wheeler transform as runs of equal symbols, the text place
sampled at the end of each run, and for each run one match length. In repetitive text runs are far
fewer than bytes.

``stream`` walks all pieces from their ends to their starts in step and gives the matching statistics: for
each place the length of the match between its suffix and the one before it in suffix order, up to
``length``, and the place of that match. Inside a run both follow from the place to the right: the match is
one symbol longer and begins one place earlier. At the head of a run the match is with the suffix that the
sampled end of the previous run of the same symbol gives, and its length is the one kept for the run.
Places whose match has ``length`` symbols are marked, but for the earliest of those that match each other.
"""

import numpy as np


def _ranked(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(values), dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], (np.diff(values[order]) != 0).astype(np.int64))))
    return rank


def suffix_order(symbols: np.ndarray, first_byte: int) -> np.ndarray:
    """The suffix array. Ranks double the number of symbols that they compare until all differ.

    End marks differ from each other, so no match reaches across the end of a piece.
    """
    n, marks = len(symbols), symbols < first_byte
    # The first ranks compare as many bytes at once as fit a number beside that of the end mark, if one
    # is met; what follows an end mark does not count.
    bits = first_byte.bit_length()
    most = (62 - bits) // 9
    rank, size, met = np.zeros(n, dtype=np.int64), 0, np.zeros(n, dtype=np.int64)
    plain, number = np.where(marks, 0, symbols - first_byte + 1), np.where(marks, symbols + 1, 0)
    while size < most:
        later = np.zeros(n, dtype=np.int64)
        later[: n - size] = plain[size:]
        rank = (rank << 9) | np.where(met > 0, 0, later)
        later[:] = 0
        later[: n - size] = number[size:]
        met = np.where(met > 0, met, later)
        size += 1
    longer = rank << bits | met
    order = np.argsort(longer)
    rank = _ranked(longer, order)
    while int(rank[order[-1]]) + 1 < n:
        tail = np.full(n, -1, dtype=np.int64)
        tail[: n - size] = rank[size:]
        longer = rank * (n + 1) + tail + 1
        order = np.argsort(longer)
        rank = _ranked(longer, order)
        size *= 2
    return order


def match_lengths(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes the strings at places a and b agree in, ``most`` at the most; eight at a time."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.zeros(len(text), dtype=np.uint64)
    for i in range(8):
        words = words << np.uint64(8) | padded[i : len(text) + i]
    out, open_pairs, done = most.copy(), np.flatnonzero(most > 0), 0
    while len(open_pairs):
        x, y = a[open_pairs] + done, b[open_pairs] + done
        differ = words[x] ^ words[y]
        found = np.flatnonzero(differ)
        # Equal bytes lead the word: the highest bit that differs tells how many.
        bits = np.frexp((differ[found] >> np.uint64(8)).astype(np.float64))[1] + 8
        bits[differ[found] < np.uint64(256)] = 8
        at = open_pairs[found]
        out[at] = np.minimum(out[at], done + 8 - (bits + 7) // 8)
        done += 8
        rest = open_pairs[differ == 0]
        open_pairs = rest[most[rest] > done]
    return out


class RunIndex:
    def __init__(self, pieces: list[bytes], keys: np.ndarray, starts: np.ndarray, length: int):
        """``keys`` and ``starts`` say where a piece comes from: places are ordered by both."""
        self.length, self.keys, self.starts = length, keys, starts
        k = len(pieces)
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.sizes + 1)[:-1]))
        ends = self.begins + self.sizes
        text = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
        symbols = text.astype(np.int64) + k
        symbols[ends] = np.arange(k)
        order = suffix_order(symbols, k)
        before = symbols[order - 1]  # of the first suffix: the last end mark
        heads = np.flatnonzero(np.concatenate(([True], np.diff(before) != 0)))
        self.run_start, self.run_symbol = heads, before[heads]
        run_size = np.diff(np.append(heads, len(order)))
        self.run_place = order[heads + run_size - 1]
        # Rows of the first column before each run's symbols: runs in order of symbol, then place.
        by_symbol = np.lexsort((heads, self.run_symbol))
        first = np.zeros(len(heads), dtype=np.int64)
        first[by_symbol] = np.concatenate(([0], np.cumsum(run_size[by_symbol])[:-1]))
        self.run_row = first
        # The previous run of the same symbol, whose sampled end gives the match at this run's head.
        same = np.concatenate(([False], np.diff(self.run_symbol[by_symbol]) == 0))
        self.run_before = np.full(len(heads), -1, dtype=np.int64)
        self.run_before[by_symbol[same]] = by_symbol[np.flatnonzero(same) - 1]
        # A symbol's first run has no such run: there the match is empty, with the last suffix of the symbol below.
        self.run_near = np.where(self.run_before >= 0, self.run_place[self.run_before] - 1, order[self.run_row - 1])
        self.run_match = np.zeros(len(heads), dtype=np.int64)
        some = np.flatnonzero(self.run_before >= 0)
        here, there = order[heads[some]] - 1, self.run_near[some]
        owner = np.repeat(np.arange(k), self.sizes + 1)
        reach = np.minimum(ends[owner[here]] - here, ends[owner[there]] - there)
        self.run_match[some] = match_lengths(text, here, there, np.minimum(reach, length))

    def step(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes one symbol longer, and whether that symbol is an end mark."""
        run = np.searchsorted(self.run_start, rows, side="right") - 1
        return self.run_row[run] + rows - self.run_start[run], self.run_symbol[run] < len(self.sizes)

    def stream(self):
        """Matching statistics, step by step: arrays (piece, offset, row, match length, place of the match).

        The match is with the suffix in the row before; its place counts in the pieces put together.
        """
        piece = np.arange(len(self.sizes))
        rows, left = piece.copy(), self.sizes.copy()  # end marks are the first suffixes
        match, place = np.zeros_like(rows), np.concatenate(([-1], (self.begins + self.sizes)[:-1]))
        while len(piece):
            run = np.searchsorted(self.run_start, rows, side="right") - 1
            head = self.run_start[run] == rows
            match = np.where(head, self.run_match[run], np.minimum(match + 1, self.length))
            place = np.where(head, self.run_near[run], place - 1)
            rows = self.run_row[run] + rows - self.run_start[run]
            more = self.run_symbol[run] >= len(self.sizes)
            piece, rows, left, match, place = piece[more], rows[more], left[more] - 1, match[more], place[more]
            if len(piece):
                yield piece, left, rows, match, place

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """(piece, offset) of all places whose string of ``length`` symbols also begins earlier.

        Rows that follow each other with matches of ``length`` begin with one string; of their places the
        earliest by key and start stays.
        """
        n = int(self.sizes.sum()) + len(self.sizes)
        matched, piece_of, offset_of = np.zeros(n, dtype=bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for piece, offset, row, match, _ in self.stream():
            matched[row], piece_of[row], offset_of[row] = match >= self.length, piece, offset
        heads = np.flatnonzero(~matched)
        size = np.diff(np.append(heads, n))
        group = np.repeat(size > 1, size)
        if not group.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        piece, offset = piece_of[group], offset_of[group]
        # order of origin as one number: key, then place
        _, ranks = np.unique(self.keys, return_inverse=True)
        origin = ranks.astype(np.int64)[piece] << 32 | (self.starts[piece] + offset)
        size = size[size > 1]
        least = np.minimum.reduceat(origin, np.concatenate(([0], np.cumsum(size)[:-1])))
        later = origin != np.repeat(least, size)
        return piece[later], offset[later]
