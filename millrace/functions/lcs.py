"""Longest common subsequence of token lists, the one metric step Spark cannot express."""

import pyarrow as pa

from millrace.functions.stem import stem_word

# Rows of a batch whose tokens are Python objects at one time.
ROWS = 128


def lcs_length(left: list[str], right: list[str]) -> int:
    """Bit-parallel LCS: bit i of ``row`` is 0 where the best length grows at left[i]."""
    if not left or not right:
        return 0
    where: dict[str, int] = {}
    for i, token in enumerate(left):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        hits = row & where.get(token, 0)
        if hits:
            row = ((row + hits) | (row - hits)) & full
    return len(left) - row.bit_count()


def lcs_lengths(left: pa.Array, right: pa.Array, stemmed: bool) -> pa.Array:
    """One length per pair of token lists in an Arrow batch; each distinct word is stemmed once.

    A batch may hold thousands of rows, so its tokens become Python objects a few rows at a time.
    """
    stems: dict[str, str] = {}

    def prepared(tokens: list[str] | None) -> list[str]:
        if not tokens or not stemmed:
            return tokens or []
        for token in tokens:
            if token not in stems:
                stems[token] = stem_word(token)
        return [stems[token] for token in tokens]

    lengths = []
    for at in range(0, len(left), ROWS):
        pairs = zip(left.slice(at, ROWS).to_pylist(), right.slice(at, ROWS).to_pylist())
        lengths += [lcs_length(prepared(a), prepared(b)) for a, b in pairs]
    return pa.array(lengths, pa.int32())
