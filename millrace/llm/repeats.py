"""Suffix-array dedup: cut out what was said before, by run-length indexes.

A byte goes if a string of ``LENGTH`` bytes that covers it also begins earlier in the corpus. One
index over a corpus has no place on one machine, and most of a corpus never repeats, so strings
that may be equal are brought together first:

1. In every window of ``LENGTH`` bytes the smallest hash of its ``GRAM``-byte strings (no longer than
   the window) is its anchor. Equal
   windows have equal anchors. Neighbouring windows with one anchor are a segment, some 40 windows
   long. Tasks send hashes only: of the anchor and of the segment's bytes; segments that a
   task has already seen are settled there and then.
2. Anchors meet by hash. Segments equal to an earlier one go as a whole; anchors seen once are unique.
3. What is left are segments that share an anchor but are not equal: the edges of repeated passages.
   Only their bytes are fetched, and anchors decide which index they enter. Bytes too far from the
   anchor to be in an equal window are cut off; the index over each part tells which windows begin earlier.
4. Windows that go are merged to byte ranges for each document.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns_of, mix64, partitions, powers, rows_batch, stage, utf8
from millrace.llm.run_index import RunIndex, match_lengths

LENGTH = 100
GRAM = 24
HOT = 20_000
INDEX_BYTES = 1_000_000
_ODD = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)

ENTRY = "bucket int, anchors binary, segments binary, keys binary, starts binary, counts binary, inner binary, gone binary"
SPAN = "key long, start long, n long, anchor long, hot boolean"


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over every run of ``width`` values, by doubling."""
    n, size, now = len(x) - width + 1, 1, x
    while size * 2 <= width:
        now = pick(now[:-size], now[size:])
        size *= 2
    return pick(now[:n], now[width - size : width - size + n])


def gram_hashes(raw: np.ndarray, gram: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash for each run of ``gram`` bytes, and the sums and powers that give the hash of any run."""
    n = len(raw)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[raw] * powers(n, _ODD), out=total[1:])
    back = powers(n, pow(_ODD, -1, 1 << 64))
    return mix64((total[gram:] - total[:-gram]) * back[: n - gram + 1] + np.uint64(seed)), total, back


class Segments:
    """Segments of one text: first window, number of windows, anchor, hash of the bytes, and whether
    the anchor occurs more than once inside, so that the segment may repeat itself.
    """

    def __init__(self, data: bytes, length: int, gram: int = GRAM, seed: int = 0):
        raw = np.frombuffer(data, dtype=np.uint8)
        gram = min(gram, length)
        width = length - gram + 1
        grams, total, back = gram_hashes(raw, gram, seed)
        least = sliding(grams, width, np.minimum)
        cut = np.flatnonzero(np.concatenate(([True], np.diff(least) != 0)))
        self.start, self.count, self.anchor = cut, np.diff(np.append(cut, len(least))), least[cut]
        end = cut + self.count - 1 + length
        self.hash = mix64((total[end] - total[cut]) * back[cut]) ^ mix64(self.count.astype(np.uint64))
        # Places where a gram is the anchor of some window: it equals the largest of the least values around it.
        around = sliding(np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64))), width, np.maximum)
        place = np.flatnonzero(grams == around)
        values, ranks = np.unique(grams[place], return_inverse=True)
        spots = np.sort(ranks.astype(np.int64) << np.int64(40) | place)
        own = np.searchsorted(values, self.anchor).astype(np.int64) << np.int64(40)
        inside = np.searchsorted(spots, own + cut + self.count - 1 + width - 1, side="right") - np.searchsorted(spots, own + cut)
        self.inner = inside > 1


def _packed(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which the shuffle's compression likes."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _unpacked(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _entries(length: int, buckets: int):
    """Texts to segments by anchor bucket, one row for each bucket and batch."""

    def run(batches):
        for b in batches:
            found = []
            for key, text in zip(*columns_of(b), strict=True):
                data = utf8(text)
                if len(data) >= length:
                    s = Segments(data, length)
                    found.append((s.anchor, s.hash, np.full(len(s.start), key, np.int64), s.start.astype(np.uint32), s.count.astype(np.uint32), s.inner))
            if not found:
                continue
            anchor, segment, key, start, count, inner = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((start, key, segment, anchor))
            anchor, segment, key, start, count, inner = (x[order] for x in (anchor, segment, key, start, count, inner))
            again = np.concatenate(([False], (np.diff(anchor) == 0) & (np.diff(segment) == 0)))
            bucket = (anchor % np.uint64(buckets)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            out = []
            for i in range(buckets):
                at = by_bucket[bounds[i] : bounds[i + 1]]
                if len(at):
                    new, old = at[~again[at]], at[again[at]]
                    gone = b"".join(_packed(x[old]) for x in (key, start, count))
                    out.append((i, *(_packed(x[new]) for x in (anchor, segment, key, start, count)), inner[new].tobytes(), gone))
            yield rows_batch(out, ENTRY)

    return run


def _settle(rows: list[tuple]):
    """Entries of one bucket to rows of SPAN: without anchor what goes as a whole, with anchor what
    has to be looked at.
    """
    anchor, segment = (np.concatenate([_unpacked(r[i], np.uint64) for r in rows]) for i in (0, 1))
    key = np.concatenate([_unpacked(r[2], np.int64) for r in rows])
    start, count = (np.concatenate([_unpacked(r[i], np.uint32) for r in rows]).astype(np.int64) for i in (3, 4))
    inner = np.concatenate([np.frombuffer(r[5], dtype=bool) for r in rows])
    order = np.lexsort((start, key, segment, anchor))
    anchor, segment, key, start, count, inner = (x[order] for x in (anchor, segment, key, start, count, inner))
    same_anchor = np.concatenate(([False], np.diff(anchor) == 0))
    again = same_anchor & np.concatenate(([False], np.diff(segment) == 0))
    heads = np.flatnonzero(~same_anchor)
    if len(heads):
        group = np.cumsum(~same_anchor) - 1
        kinds = np.bincount(group[~again], minlength=len(heads))
        open_group = (kinds > 1) | np.logical_or.reduceat(inner, heads)
        look = ~again & open_group[group]
        hot = kinds[group] > HOT
        yield from zip(key[again].tolist(), start[again].tolist(), count[again].tolist(), [None] * int(again.sum()), [False] * int(again.sum()), strict=True)
        yield from zip(
            key[look].tolist(), start[look].tolist(), count[look].tolist(),
            anchor[look].view(np.int64).tolist(), hot[look].tolist(), strict=True,
        )
    for r in rows:
        size = len(r[6]) // 16
        yield from zip(
            _unpacked(r[6][: 8 * size], np.int64).tolist(), _unpacked(r[6][8 * size : 12 * size], np.uint32).tolist(),
            _unpacked(r[6][12 * size :], np.uint32).tolist(), [None] * size, [False] * size, strict=True,
        )


def _settled(batches):
    now, rows = None, []
    for b in batches:
        for bucket, *row in zip(*columns_of(b), strict=True):
            if bucket != now and rows:
                yield rows_batch(list(_settle(rows)), SPAN)
                rows = []
            now = bucket
            rows.append(row)
    if rows:
        yield rows_batch(list(_settle(rows)), SPAN)


PIECE = "anchor long, key long, start long, piece binary"


def _pieces(length: int):
    """Texts with their open segments to the segments' bytes.

    Segments of an anchor with very many forms are cut again by a second kind of anchor, which
    spreads them over as many parts as their surroundings differ.
    """

    def run(batches):
        for b in batches:
            out = []
            for key, text, spans in zip(*columns_of(b), strict=True):
                data = utf8(text)
                for s in spans:
                    piece = data[s["start"] : s["start"] + s["n"] - 1 + length]
                    if not s["hot"]:
                        out.append((s["anchor"], key, s["start"], piece))
                        continue
                    again = Segments(piece, length, seed=1)
                    for at, n, anchor in zip(again.start.tolist(), again.count.tolist(), again.anchor.view(np.int64).tolist(), strict=True):
                        out.append((anchor ^ s["anchor"], key, s["start"] + at, piece[at : at + n - 1 + length]))
            yield rows_batch(out, PIECE)

    return run


def _reach(text: np.ndarray, group: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each string ``text[begin : begin + size]`` the longest prefix that another of its group shares."""
    data = text.tobytes()
    parts = [data[b : b + n] for b, n in zip(begin.tolist(), size.tolist(), strict=True)]
    order = np.array(sorted(range(len(parts)), key=list(zip(group.tolist(), parts, strict=True)).__getitem__), dtype=np.int64)
    a, b = order[:-1], order[1:]
    shared = match_lengths(text, begin[a], begin[b], np.where(group[a] == group[b], np.minimum(size[a], size[b]), 0))
    out = np.zeros(len(parts), dtype=np.int64)
    out[a] = shared
    out[b] = np.maximum(out[b], shared)
    return out


def may_match(rows: list[tuple], length: int) -> list[tuple]:
    """Pieces, sorted by anchor, cut to the bytes that can be in a window of another piece as well.

    Equal windows hold their anchor at the same place. Where no piece of an anchor holds it twice, its
    pieces agree side by side: what is further from the anchor than the longest agreement with any
    other piece, on that side, is in no equal window, nor is a piece left with fewer bytes than a window.
    """
    gram = min(GRAM, length)
    anchor = np.array([r[0] for r in rows], dtype=np.int64)
    size = np.array([len(r[3]) for r in rows], dtype=np.int64)
    end = np.cumsum(size)
    begin, owner = end - size, np.repeat(np.arange(len(rows)), size)
    text = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.uint8)
    grams = gram_hashes(text, gram)[0]
    hit = np.flatnonzero(grams == anchor.view(np.uint64)[owner[: len(grams)]])
    hit = hit[hit + gram <= end[owner[hit]]]
    times = np.bincount(owner[hit], minlength=len(rows))
    group = np.cumsum(np.concatenate(([0], np.diff(anchor) != 0)))
    odd = np.bincount(group, weights=times != 1)[group] > 0
    cut = np.flatnonzero(~odd)
    if not len(cut):
        return rows
    place = np.zeros(len(rows), dtype=np.int64)
    place[owner[hit]] = hit
    at = place[cut]
    right = _reach(text, group[cut], at + gram, end[cut] - at - gram)
    left = _reach(np.ascontiguousarray(text[::-1]), group[cut], len(text) - at, at - begin[cut])
    first, last = at - left - begin[cut], at + gram + right - begin[cut]
    out = [rows[i] for i in np.flatnonzero(odd).tolist()]
    for i, x, y in zip(cut.tolist(), first.tolist(), last.tolist(), strict=True):
        if y - x >= length:
            of, key, start, piece = rows[i]
            out.append((of, key, start + x, piece[x:y]))
    return out


def _indexed(length: int):
    """Pieces sorted by anchor to the windows that begin earlier.

    Anchors do not matter for the result, only that one's pieces are together: an index takes
    the pieces of many anchors, up to ``INDEX_BYTES`` or one anchor.
    """
    result = "key long, start long, n long"

    def repeats(rows):
        rows = may_match(rows, length)
        if not rows:
            return []
        anchor, key, start = (np.array(x, dtype=np.int64) for x in list(zip(*rows, strict=True))[:3])
        index = RunIndex([r[3] for r in rows], key, start, length)
        piece, offset = index.repeats()
        where = np.lexsort((start[piece] + offset, key[piece]))
        key, start = key[piece][where], (start[piece] + offset)[where]
        fresh = np.concatenate(([True], (np.diff(key) != 0) | (np.diff(start) > 1))) if len(key) else np.empty(0, bool)
        heads = np.flatnonzero(fresh)
        last = np.append(heads[1:], len(key)) - 1 if len(heads) else heads
        return list(zip(key[heads].tolist(), start[heads].tolist(), (start[last] - start[heads] + 1).tolist(), strict=True))

    def run(batches):
        rows, size, anchor = [], 0, None
        for b in batches:
            for row in zip(*columns_of(b), strict=True):
                if row[0] != anchor and size >= INDEX_BYTES:
                    yield rows_batch(repeats(rows), result)
                    rows, size = [], 0
                anchor = row[0]
                rows.append(row)
                size += len(row[3]) + 1
        if rows:
            yield rows_batch(repeats(rows), result)

    return run, result


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def kept_bytes(data: bytes, spans: list[tuple[int, int]], length: int) -> tuple[bytes, int, int]:
    """(remaining bytes, removed ones, maximal removed runs); spans are (first window, windows)."""
    if not spans:
        return data, 0, 0
    change = np.zeros(len(data) + 1, dtype=np.int64)
    for start, n in spans:
        change[start] += 1
        change[start + n - 1 + length] -= 1
    gone = np.cumsum(change)[:-1] > 0
    raw = np.frombuffer(data, dtype=np.uint8)
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return raw[~gone].tobytes(), int(gone.sum()), runs


def removed_windows(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(key, start, n)``: runs of windows that also begin earlier, for ``(key, text)`` with distinct keys."""
    spark = texts.sparkSession
    parts = partitions(spark)
    buckets = 4 * parts
    entries = texts.mapInArrow(_entries(length, buckets), ENTRY)
    dealt = entries.repartition(parts, "bucket").sortWithinPartitions("bucket")
    spans = stage(dealt.mapInArrow(_settled, SPAN), "repeat-spans")
    edges = spans.where("anchor is not null").groupBy("key").agg(F.collect_list(F.struct("start", "n", "anchor", "hot")).alias("spans"))
    joined = texts.join(edges.withColumnRenamed("key", "edge_key").hint("shuffle_hash"), F.col("key") == F.col("edge_key"))
    pieces = joined.select("key", "text", "spans").mapInArrow(_pieces(length), PIECE)
    run, result = _indexed(length)
    placed = pieces.repartition(parts, "anchor").sortWithinPartitions("anchor", "key", "start")
    return spans.where("anchor is null").select("key", "start", "n").unionByName(placed.mapInArrow(run, result))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(key, doc_id, text)`` with distinct keys in the order of documents.

    The id is the key where it can be. Tables with repeated or null ids get numbers in order
    of id (null first), then text, and are written once with them.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    clash = rows.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1 or doc_id is null")
    if not clash.limit(1).count():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text")
    # A partition's number and a row's place in it make ids in this order; the written table keeps them.
    ordered = rows.repartitionByRange(partitions(df.sparkSession), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    sorted_rows = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return stage(sorted_rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), "repeat-keys")


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per input row.

    With ``with_text`` the remaining bytes follow as ``kept``; they may begin or end within a character.
    A null text is empty; texts under ``length`` bytes lose nothing. Rows with equal ids are documents of
    their own, ordered by the hash of their text; null ids come first. Of repeated rows one
    stays, and the others lose all they have from ``length`` bytes on. An empty table gives no rows.
    """
    keyed = _keyed(df, id_col, text_col)
    gone = stage(removed_windows(keyed.select("key", "text"), length), "repeat-windows")
    spans = gone.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("spans")).withColumnRenamed("key", "gone_key")
    joined = keyed.join(spans.hint("shuffle_hash"), F.col("key") == F.col("gone_key"), "left").select("doc_id", "text", "spans")
    result = RESULT + (", kept binary" if with_text else "")

    def run(batches):
        for b in batches:
            out = []
            for doc_id, text, found in zip(*columns_of(b), strict=True):
                data = utf8(text)
                kept, removed, runs = kept_bytes(data, [(s["start"], s["n"]) for s in found or ()], length)
                row = (doc_id, len(data), removed, runs, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if with_text else row)
            yield rows_batch(out, result)

    return joined.mapInArrow(run, result)
