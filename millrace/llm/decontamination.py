"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters may differ in ``m // CHARS_PER_ERROR`` edits. It is cut into one piece
more than that, so a passage within the budget holds at least one piece unchanged. One
automaton finds all pieces of all items in one pass over a text; a hit fixes where the item
would lie, and Myers' bit-parallel distance decides. Texts and items are compared lower-cased
and with white space folded to single blanks.

Items travel to the texts in blocks of at most ``BLOCK_CHARS`` characters, so a task's automaton
is bounded however many items there are; the texts are not shuffled.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns_of, rows_batch

CHARS_PER_ERROR = 16
WHOLE_WORDS_UNDER = 32
BLOCK_CHARS = 2_000_000

HIT = "doc_id long, item_id long, distance int, budget int, start long, end long"


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def places(text: str) -> list[int]:
    """For each character of the folded text, where it comes from; the length at the end."""
    out, pending = [], None
    for i, c in enumerate(text):
        if c.isspace():
            pending = i if pending is None else pending
            continue
        if pending is not None and out:
            out.append(pending)
        pending = None
        out += [i] * len(c.lower())
    return [*out, len(text) if pending is None else pending]


def _masks(pattern: str) -> dict[str, int]:
    masks = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """(least edit distance of the pattern to a part of the text, end of the first such part).

    ``anchored`` parts begin at the start of the text.
    """
    m = len(pattern)
    masks, top, full = _masks(pattern), 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        zero = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | (full & ~(zero | plus)), plus & zero
        score += (up & top > 0) - (down & top > 0)
        up, down = ((up << 1) | anchored) & full, (down << 1) & full
        plus, minus = down | (full & ~(zero | up)), up & zero
        if score < best:
            best, end = score, j
    return best, end


def nearest(pattern: str, text: str) -> tuple[int, int, int]:
    """(distance, start, end) of the part of the text nearest to the pattern, leftmost end first."""
    at = text.find(pattern)
    if at >= 0:
        return 0, at, at + len(pattern)
    best, end = myers(pattern, text)
    _, back = myers(pattern[::-1], text[:end][::-1], anchored=True)
    return best, end - back, end


class Items:
    """A block of items with the automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int):
        import ahocorasick

        self.items, found = [], {}
        for item_id, text in items:
            text = folded(text or "")
            if not text:
                continue
            budget = len(text) // chars_per_error
            number = len(self.items)
            self.items.append((item_id, text, budget))
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                found.setdefault(text[a:b], []).append((number, a))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def hits(self, text: str):
        """(item_id, distance, budget, start, end) of the best place of every item found."""
        clean = folded(text)
        if not self.items or not clean:
            return
        starts = {}
        for last, (length, uses) in self.automaton.iter(clean):
            for number, offset in uses:
                starts.setdefault(number, set()).add(last + 1 - length - offset)
        origin = None
        for number, begun in starts.items():
            item_id, item, budget = self.items[number]
            best = None
            for low, high in _ranges(sorted(begun), budget):
                a, b = max(0, low - budget), min(len(clean), high + len(item) + budget)
                distance, start, end = nearest(item, clean[a:b])
                start, end = start + a, end + a
                if distance > budget or not _whole(item, clean, start, end):
                    continue
                if best is None or (distance, start) < best[:2]:
                    best = (distance, start, end)
            if best is not None:
                origin = origin or places(text)
                yield item_id, best[0], budget, origin[best[1]], origin[best[2] - 1] + 1


def _ranges(starts: list[int], budget: int) -> list[tuple[int, int]]:
    """Starts no more than the budget apart belong to one place."""
    out = [[starts[0], starts[0]]]
    for s in starts[1:]:
        if s - out[-1][1] <= budget:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(x) for x in out]


def _whole(item: str, text: str, start: int, end: int) -> bool:
    """Short items count only where they are not part of a longer word."""
    if len(item) >= WHOLE_WORDS_UNDER:
        return True
    return not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())


def blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int):
    """Items in order of id, in lists of bounded size; one list at a time is in the driver."""
    block, size = [], 0
    chosen = items.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    for row in chosen.distinct().orderBy("i", "t").toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def _searcher(block: list, chars_per_error: int):
    """A function from text to hits; the automaton is built once in each task."""
    state = []

    def search(text: str):
        if not state:
            state.append(Items(block, chars_per_error))
        return state[0].hits(text)

    return search


def find(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    chars_per_error: int = CHARS_PER_ERROR, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(doc_id, item_id, distance, budget, start, end)``: every item that a document contains.

    One row per document row and item, with the place of least distance, the first of equals;
    offsets are code points of the original text. Items without text match nothing, and so do null
    and empty documents. Items under 32 characters must match whole words. Without items or
    documents there are no rows. Repeated documents or items give repeated hits, but equal
    items (id and text) count once.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    found = []
    for block in blocks(items, item_col, item_text_col, block_chars):
        held = context.broadcast(block)

        def run(batches, held=held):
            search = _searcher(held.value, chars_per_error)
            for b in batches:
                yield rows_batch([(i, *h) for i, t in zip(*columns_of(b), strict=True) for h in search(t)], HIT)

        found.append(rows.mapInArrow(run, HIT))
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], HIT)


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """The rows that contain no item, with their own columns, in place.

    Rows are judged one by one by their text: null ids, repeated rows and further columns make no
    difference, a null or empty text is kept. Without items, or without rows, the table comes back as it is.
    """
    context, place = docs.sparkSession.sparkContext, docs.columns.index(text_col)
    item_col, item_text_col = named.get("item_col", "item_id"), named.get("item_text_col", "text")
    per_error = named.get("chars_per_error", CHARS_PER_ERROR)
    for block in blocks(items, item_col, item_text_col, named.get("block_chars", BLOCK_CHARS)):
        held = context.broadcast(block)

        def run(batches, held=held):
            import pyarrow as pa

            search = _searcher(held.value, per_error)
            for b in batches:
                clean = [t is None or next(iter(search(t)), None) is None for t in b.column(place).to_pylist()]
                yield b.filter(pa.array(clean, type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
