"""N-gram Jaccard join as a blocked sparse matrix product.

The matrix has a row per document and a column per n-gram; the product of the matrix with its
transpose counts the n-grams that two documents share. Only a few entries of the product matter, and bounds
that follow from the set sizes say which:

1. Documents with equal sets are one row, whatever their number.
2. Two sets of Jaccard similarity s share at least s times the larger set. So they share ``MEET``
   of the first ``size - ceil(s * size) + MEET`` n-grams of each, in any common order. Rare
   n-grams come first in the order; counting sketches of fixed size, of n-grams and of words, say
   how rare they are, and err only in cost.
3. Columns of up to ``SMALL_COLUMN`` rows list their pairs of fitting sizes, which are counted over columns; pairs
   that meet too seldom for their sizes are dropped. Each row knows its smallest partner; two rows that know the same
   one meet in its block, others in the block of the smaller of the two. So a group of near copies is one block. The
   rows of a larger column meet in a block as they are. A block with too many rows
   or n-grams is cut into parts, and all pairs of parts are multiplied, each in a task of its own.
4. Within a product, overlap counts grow column by column, rare ones first. A pair that cannot reach
   its bound with the columns that are left is dropped, and so are rows without a pair.

A block gives a spanning forest of its links, not all pairs. The forests' components are exact.
"""

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import columns_of, narrow, partitions, rows_batch, shingles, shingles_of, stage, utf8, word_hashes
from millrace.llm.components import components
from millrace.session import broadcast_if_small

WORDS = 3
PERCENT = 90
SKETCH_BITS = 20
SKETCH_BLOCK = 4096
BLOCK_ROWS, BLOCK_GRAMS = 2048, 2_000_000
CELLS = 4_000_000
SMALL_COLUMN = 128
MEET = 3
BITMAP_BITS = 1 << 24


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


class Rarity:
    """How common an n-gram is, on a logarithmic scale; 0 for those that nothing tells from single ones.

    Two estimates, of which the larger counts: from the n-gram's own counter, as far as it
    stands out from the average load of a counter, and from the shares of its words in the text.
    """

    def __init__(self, grams: np.ndarray, words: np.ndarray, bits: int):
        load = float(np.median(grams))
        self.grams = np.round(4 * np.log2(1 + np.maximum(0, grams - load - 4 * np.sqrt(load)))).astype(np.uint8)
        self.words = np.round(4 * np.log2(np.maximum(1, words))).astype(np.uint8)
        self.total, self.bits = 4 * np.log2(max(1.0, float(words.sum()))), bits

    def levels(self, grams: np.ndarray, first: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        width = min(n, len(words))
        share = self.words[_places(words, self.bits)] - self.total
        expected = np.full(len(grams), self.total)
        for i in range(width):
            expected += share[first + i]
        return np.maximum(self.grams[_places(grams, self.bits)], np.maximum(0, np.round(expected))).astype(np.int64)


def rarity(df: DataFrame, words: int, bits: int = SKETCH_BITS) -> Rarity:
    """Counters for n-grams (once a text) and words (every time), ``2**bits`` each.

    They have a fixed size, are summed over tasks in blocks, and arrive as a byte each.
    """

    def count(batches):
        seen = np.zeros((2, 1 << bits), dtype=np.uint32)
        for b in batches:
            found = [word_hashes(utf8(t)) for t in b.column(0).to_pylist()]
            if found:
                grams = np.concatenate([shingles_of(w, words)[0] for w in found])
                for i, hashes in enumerate((grams, np.concatenate(found))):
                    seen[i] += np.bincount(_places(hashes, bits), minlength=1 << bits).astype(np.uint32)
        for block, part in enumerate(seen.reshape(-1, min(SKETCH_BLOCK, 1 << bits))):
            if part.any():
                yield rows_batch([(block, zlib.compress(part.tobytes(), 1))], "block int, counts binary")

    def added(key, table):
        import pyarrow as pa

        total = 0
        for c in table.column("counts").to_pylist():
            # full counters stay full
            total = np.minimum(total + np.frombuffer(zlib.decompress(c), dtype=np.uint32).astype(np.uint64), 2**32 - 1)
        row = (key[0].as_py(), zlib.compress(total.astype(np.uint32).tobytes(), 1))
        return pa.Table.from_batches([rows_batch([row], "block int, counts binary")])

    parts = narrow(df, "text").mapInArrow(count, "block int, counts binary")
    # Counters of many tasks meet in two steps, so that no task has all of them.
    salted = parts.withColumn("salt", F.spark_partition_id() % 64)
    first = salted.groupBy("block", "salt").applyInArrow(added, "block int, counts binary")
    summed = first.groupBy("block").applyInArrow(added, "block int, counts binary")
    counts = np.zeros((2, 1 << bits), dtype=np.uint32).reshape(-1, min(SKETCH_BLOCK, 1 << bits))
    for row in summed.collect():
        counts[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.uint32)
    return Rarity(*counts.reshape(2, -1), bits)


def least_shared(size, percent: int):
    """The overlap that a set of this size must have with any set it links with."""
    return (percent * size + 99) // 100


def least_meets(size, percent: int):
    """How many of their first n-grams two linked sets share, if this is the size of the smaller one."""
    return np.minimum(MEET, least_shared(size, percent))


def _rows(df: DataFrame, rare: Rarity, words: int, percent: int) -> DataFrame:
    """``(doc_id, n, digest, first)``: size and digest of each set, and its first n-grams in the order."""
    held = df.sparkSession.sparkContext.broadcast(rare)
    result = "doc_id long, n long, digest binary, first binary"

    def run(batches):
        for b in batches:
            out = []
            for doc_id, text in zip(*columns_of(b), strict=True):
                hashes = word_hashes(utf8(text))
                grams, begins = shingles_of(hashes, words)
                digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
                n, first = len(grams), grams[:0]
                if n:
                    level = held.value.levels(grams, begins, hashes, words)
                    first = grams[np.argsort(level, kind="stable")[: n - least_shared(n, percent) + least_meets(n, percent)]]
                out.append((doc_id, n, digest, first.tobytes()))
            yield rows_batch(out, result)

    return df.select("doc_id", "text").mapInArrow(run, result)


def _columns(rows: DataFrame) -> DataFrame:
    """``(gram, node, n)``: the incidence matrix, reduced to the first n-grams of each row."""
    result = "gram long, node long, n long"

    def run(batches):
        for b in batches:
            for node, n, first in zip(*columns_of(b), strict=True):
                yield rows_batch([(g, node, n) for g in np.frombuffer(first, dtype=np.int64).tolist()], result)

    return rows.select("node", "n", "first").mapInArrow(run, result)


def product_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs (i, j), i of left and j of right or i < j where a row is in both, that are linked."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    index = np.concatenate(sets)
    own = np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(index, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    own, column = own[shared], column[shared]
    order = np.lexsort((column, times[column]))
    own, column = own[order], column[order]
    # number the shared columns in the order in which they are multiplied: rare ones first
    step = np.cumsum(np.concatenate(([0], (np.diff(column) != 0).astype(np.int64)))) if len(column) else column
    rest = np.bincount(own, minlength=len(sets))
    overlap = np.zeros((len(left), len(right)), dtype=np.float32)
    smaller, larger = np.minimum.outer(size[left], size[right]), np.maximum.outer(size[left], size[right])
    alive = (100 * smaller >= percent * larger) & (left[:, None] < right[None, :] if left is right else True)
    # 100 * both >= percent * (a + b - both)
    need = np.ceil(percent * (smaller + larger) / (100 + percent) - 1e-9)
    rows, cols = np.arange(len(left)), np.arange(len(right))
    at, total = 0, int(step[-1]) + 1 if len(step) else 0
    place = np.full(len(sets), -1)
    while at < total:
        alive &= overlap + np.minimum.outer(rest[left[rows]], rest[right[cols]]) >= need
        keep_rows, keep_cols = alive.any(axis=1), alive.any(axis=0)
        if not keep_rows.any():
            return []
        overlap, alive, need = (x[np.ix_(keep_rows, keep_cols)] for x in (overlap, alive, need))
        rows, cols = rows[keep_rows], cols[keep_cols]
        width = max(64, CELLS // (len(rows) + len(cols)))
        a, b = np.searchsorted(step, [at, at + width])
        blocks = []
        for members in (left[rows], right[cols]):
            place[:] = -1
            place[members] = np.arange(len(members))
            inside = place[own[a:b]] >= 0
            block = np.zeros((len(members), min(width, total - at)), dtype=np.float32)
            block[place[own[a:b][inside]], step[a:b][inside] - at] = 1
            blocks.append(block)
        overlap = overlap + blocks[0] @ blocks[1].T
        rest = rest - np.bincount(own[a:b], minlength=len(sets))
        at += width
    found = alive & (overlap >= need)
    i, j = np.nonzero(found)
    return list(zip(left[rows[i]].tolist(), right[cols[j]].tolist(), strict=True))


def forest(nodes: list[int], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node it is linked with, through any number of links) for all but the smallest."""
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            small, large = (a, b) if nodes[a] <= nodes[b] else (b, a)
            parent[large] = small
    return [(nodes[i], nodes[root(i)]) for i in range(len(nodes)) if nodes[root(i)] != nodes[i]]


def _block_edges(percent: int):
    """Rows of blocks, sorted by block, to the edges of each block's forest."""
    result = "a long, b long"

    def edges(key, members):
        nodes = [m[0] for m in members]
        sets = [np.frombuffer(m[2], dtype=np.uint64) for m in members]
        parts = np.array([m[1] for m in members])
        if key[1] == key[2]:
            left = right = np.arange(len(members))
        else:
            left, right = np.flatnonzero(parts == key[1]), np.flatnonzero(parts == key[2])
        if not len(left) or not len(right):
            return []
        return forest(nodes, product_links(sets, left, right, percent))

    def run(batches):
        key, members = None, []
        for b in batches:
            out = []
            for leader, i, j, node, part, grams in zip(*columns_of(b), strict=True):
                if (leader, i, j) != key:
                    out += edges(key, members) if len(members) > 1 else []
                    key, members = (leader, i, j), []
                members.append((node, part, grams))
            yield rows_batch(out, result)
        if len(members) > 1:
            yield rows_batch(edges(key, members), result)

    return run, result


def _spread(words: int):
    """Texts with the blocks they belong to, to one row for each pair of parts they take part in."""
    result = "leader long, i int, j int, node long, part int, grams binary"

    def run(batches):
        for b in batches:
            for node, text, blocks in zip(*columns_of(b), strict=True):
                grams = shingles(utf8(text), words).tobytes()
                out = []
                for x in blocks:
                    part, parts = x["part"], x["parts"]
                    for other in range(parts):
                        out.append((x["leader"], min(part, other), max(part, other), node, part, grams))
                yield rows_batch(out, result)

    return run, result


def _pairs(percent: int):
    """Rows of small columns to their pairs: ``(a, b, n_a, n_b)``, a under b, sizes within the bound."""
    result = "a long, b long, n_a long, n_b long"

    def run(batches):
        for batch in batches:
            out = []
            for (members,) in zip(*columns_of(batch), strict=True):
                rows = sorted((m["node"], m["n"]) for m in members)
                for i, (a, n) in enumerate(rows):
                    out += [(a, b, n, m) for b, m in rows[i + 1 :] if a < b and 100 * min(n, m) >= percent * max(n, m)]
            yield rows_batch(out, result)

    return run, result


def _pair_meets(percent: int):
    """How many of their first n-grams two linked sets ``n_a``, ``n_b`` share, as a column.

    All shared n-grams up to the end of one of the two first parts, whichever comes first in the
    order, lie in both of them. So the overlap is at most the number of meetings and what the
    longer of the two rests could add. It must reach ``percent`` of the union.
    """

    def rest(n):
        shared = F.floor((F.col(n) * percent + 99) / 100)
        return shared - F.least(F.lit(MEET), shared)

    total = F.col("n_a") + F.col("n_b")
    need = F.floor((total * percent + (99 + percent)) / (100 + percent))
    return need - F.greatest(rest("n_a"), rest("n_b"))


def _of_blocks(texts: DataFrame, own: DataFrame) -> DataFrame:
    """The texts that may be in a block: others need no shuffle.

    A bitmap of ``BITMAP_BITS`` hashed ids decides, 2 MB whatever the number of rows. Ids that share a bit only
    cost a shuffled text.
    """
    width = 32768  # Fixed value: bits of a bitmap that Spark's aggregate builds
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    bits = own.select(F.pmod(F.xxhash64("node"), F.lit(BITMAP_BITS)).alias("spot")).select(
        F.floor(F.col("spot") / width).alias("part"), F.pmod("spot", F.lit(width)).alias("bit")
    )
    maps = stage(bits.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")), "join-bitmap")
    marked = texts.withColumn("spot", spot).withColumn("part", F.floor(F.col("spot") / width))
    held = marked.join(F.broadcast(maps), "part")
    byte = F.conv(F.hex(F.expr(f"substring(bits, int(spot % {width} div 8) + 1, 1)")), 16, 10).cast("long")
    return held.where(F.getbit(byte, F.pmod("spot", F.lit(8)).cast("int")) == 1).select("doc_id", "text")


def _led(pairs: DataFrame) -> DataFrame:
    """Each pair with the ``leader`` of its block: the smallest partner of both ends, or else ``a``."""
    ends = pairs.select("a", F.col("a").alias("b")).unionByName(pairs.select("a", "b"))
    # seen from the larger end, and from the smaller one, which is its own smallest if nothing is under it
    least = ends.groupBy("b").agg(F.min("a").alias("least"))
    of_a, of_b = least.toDF("a", "least_a"), least.toDF("b", "least_b")
    leader = F.when(F.col("least_a") == F.col("least_b"), F.col("least_a")).otherwise(F.col("a"))
    return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "n_a", "n_b", leader.alias("leader"))


def _members(rows: DataFrame, percent: int) -> DataFrame:
    """``(leader, node, n)``: blocks whose rows have to be multiplied with each other."""
    columns = _columns(rows)
    counted = columns.groupBy("gram").agg(F.min("node").alias("leader"), F.count("*").alias("k")).where("k > 1")
    shared = stage(columns.join(counted, "gram"), "join-columns")
    small = shared.where(F.col("k") <= SMALL_COLUMN).groupBy("gram").agg(F.collect_list(F.struct("node", "n")).alias("m"))
    run, result = _pairs(percent)
    pairs = small.select("m").mapInArrow(run, result).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("meets"))
    led = stage(_led(stage(pairs.where(F.col("meets") >= _pair_meets(percent)), "join-pairs")), "join-led")
    large = shared.where(F.col("k") > SMALL_COLUMN).select("leader", "node", "n")
    every = large.unionByName(led.selectExpr("leader", "b AS node", "n_b AS n")).unionByName(
        led.selectExpr("leader", "a AS node", "n_a AS n")
    )
    return stage(every.groupBy("leader", "node").agg(F.max("n").alias("n")), "join-blocks")


def links(texts: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``(a, b)``: spanning forests of the links between ``rows`` of different sets."""
    members = _members(rows, percent)
    sizes = members.groupBy("leader").agg(F.count("*").alias("rows"), F.sum("n").alias("grams")).where("rows > 1")
    parts = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    placed = members.join(sizes.select("leader", parts.alias("parts")), "leader").select(
        "node", "leader", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "parts"
    )
    own = stage(placed.groupBy("node").agg(F.collect_list(F.struct("leader", "part", "parts")).alias("blocks")), "join-own")
    spread, spread_result = _spread(words)
    joined = _of_blocks(texts, own).join(own.hint("shuffle_hash"), F.col("doc_id") == F.col("node")).select("node", "text", "blocks")
    run, result = _block_edges(percent)
    blocks = joined.mapInArrow(spread, spread_result)
    dealt = blocks.repartition(partitions(texts.sparkSession), "leader", "i", "j")
    return dealt.sortWithinPartitions("leader", "i", "j").mapInArrow(run, result)


def join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per input row.

    Null, empty and blank texts have no n-grams, link with nothing and are their own component. Rows
    with a null id link with nothing and have a null component. Rows that share an id are one
    document, linked with whatever one of them links with. Case A-Z is ignored, and texts with the same set
    of n-grams are linked whatever their order. An empty table gives no rows.
    """
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage(_rows(texts, rarity(texts, words, sketch_bits), words, percent), "join-rows")
    sets = rows.where("n > 0 and doc_id is not null")
    classes = stage(
        sets.groupBy("digest", "n").agg(F.min(F.struct("doc_id", "first")).alias("least"))
        .select("digest", "n", F.col("least.doc_id").alias("node"), F.col("least.first").alias("first")),
        "join-classes",
    )
    copies = sets.join(classes.select("digest", "node"), "digest").where("doc_id > node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(links(texts, classes, words, percent))
    # Components of classes first, then each document looks up its class.
    grouped = classes.select("digest", "n", "node").join(found, "node", "left").select(
        "digest", "n", F.coalesce("component", "node").alias("component")
    )
    # The same id in several classes joins them; that is rare enough for a check of the ids alone.
    repeated = sets.groupBy("doc_id").agg(F.count_distinct("digest").alias("k")).where("k > 1")
    if repeated.limit(1).count():
        found = components(links(texts, classes, words, percent).unionByName(copies))
        ids = rows.join(found, rows["doc_id"] == found["node"], "left")
        return ids.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    named = rows.join(grouped.withColumnRenamed("n", "class_n"), "digest", "left")
    linked = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(linked, F.col("doc_id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """The rows that are the first of their component, with their own columns.

    Rows with a null id are kept. Rows that share an id stay or go together, but of those that share
    id and text one stays: the one whose other columns, written as JSON, come first. Rows without n-grams
    are linked with nothing and stay. Columns may be of any type. An empty table gives no rows.
    """
    first = join(df, id_col, text_col, **named).where("doc_id = component_id").groupBy(F.col("doc_id").alias("__first"))
    kept = stage(first.agg((F.count("*") > 1).alias("__again")), "join-kept")
    own = F.col(id_col).cast("long") == F.col("__first")
    joined = df.join(kept.where("not __again").drop("__again").hint("shuffle_hash"), own, "left")
    once = joined.where(F.col("__first").isNotNull() | F.col(id_col).isNull()).drop("__first")
    again = kept.where("__again").drop("__again")
    if not again.limit(1).count():
        return once
    # Combined map-side, so however many copies a row has, a task sends one.
    keys, others = (F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), [F.col(f"`{c}`") for c in df.columns if c not in (id_col, text_col)]
    row = F.struct(F.lit(0).alias("__same"), *others)
    least = df.join(broadcast_if_small(again), own).groupBy(*keys).agg(F.min_by(row, F.to_json(row)).alias("__row"))
    own_columns = [F.col(f"`{c}`") if c in (id_col, text_col) else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
    return once.unionByName(least.select(*own_columns))
