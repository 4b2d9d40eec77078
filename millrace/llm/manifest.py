"""A Merkle manifest of a table, with leaf coordinates from ranked bitmaps.

Each row's digest is a leaf. Per group the leaves stand in order of id, every ``FAN`` consecutive
nodes make a node of the next level until one is left, and the groups' roots make one tree in
the same way.

No leaf is sorted into place. The ids of a group form a bitmap of 64-bit words, of which only those
with a bit exist: every task makes the words of its rows, equal words of all tasks are merged by
OR. A directory sums up the population counts in steps of 16 bits of the id (at most 65,536 entries
below each), so a word knows how many rows stand before it; a leaf's slot is that count plus the
population of the lower bits of its word. Slots are then cut into blocks of ``FAN ** LEVELS``. A block
is one array, filled by slot whatever the order in which its digests arrive; its levels are reduced
inside one task, and its root is a node of the next round. Going down again, each block gets the
siblings above it once and derives those of its own nodes.

Rows with a null id come first in their group. Rows of one id (nulls too) stand in order of their digest:
those alone, found where a word has more rows than bits, are counted by digest, placed by digits of the
digest, and counted out again, so equal rows of any number have consecutive slots. A null group is a
group of its own and the first one. Null values are part of the digest. An empty table gives no rows.
"""

from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import partitions, stage
from millrace.operators.numbering import with_row_numbers

FAN, LEVELS = 2, 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NO_ID = -(1 << 62)
COPIES = 4096
_NODE = "grp string, slot long, size long, digest string"
_PATH = "grp string, slot long, path string, subroot string, root string"
_AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of all values, each with its byte count; a null is a dash."""
    values = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def leaves(df: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "lang", id_col: str = "doc_id", changed=None) -> DataFrame:
    """``(grp, id, leaf, tampered)``. ``changed`` names columns with the values that an intruder has put
    there, and the rows it did so in: ``(condition, {name: Column})``.
    """
    plain = {c: F.col(f"`{c}`") for c in columns}
    tampered = F.lit(None).cast("string")
    if changed is not None:
        tampered = F.when(changed[0], digest([changed[1].get(c, plain[c]) for c in columns]))
    return df.select(
        F.coalesce(F.concat(F.lit("v"), F.col(f"`{group}`").cast("string")), F.lit("n")).alias("grp"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        digest(list(plain.values())).alias("leaf"),
        tampered.alias("tampered"),
    )


def _word(id_col: str = "id") -> Column:
    return F.coalesce(F.shiftright(id_col, 6), F.lit(NO_ID))


def bitmaps(rows: DataFrame) -> DataFrame:
    """``(grp, word, bits, n)``: merged words of the groups' bitmaps, and the rows of each word."""
    bit = F.expr("shiftleft(1L, cast(id & 63L as int))")
    return rows.groupBy("grp", _word().alias("word")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))


def directory(words: DataFrame) -> DataFrame:
    """Adds ``start``, the rows of the group before a word, and ``size``, the rows of the group."""
    levels = [words]
    for bits in (10, 16, 16):
        above = F.shiftright("word", bits).alias("word")
        levels.append(levels[-1].groupBy("grp", above).agg(F.sum("n").alias("n")))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = levels[-1].select("grp", "word", before.alias("start"), F.sum("n").over(group).alias("size"))
    for level, bits in zip(levels[-2::-1], (16, 16, 10), strict=True):
        inside = Window.partitionBy("grp", "above").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn("above", F.shiftright("word", bits)).withColumn(
            "inner", F.coalesce(F.sum("n").over(inside), F.lit(0))
        )
        starts = own.join(starts.select("grp", F.col("word").alias("above"), "start", "size"), ["grp", "above"]).select(
            *level.columns, (F.col("start") + F.col("inner")).alias("start"), "size"
        )
    return starts


def _placed_repeats(rows: DataFrame) -> DataFrame:
    """Slots of rows in words that have more rows than bits.

    Equal rows are counted first. The others of an id are dealt to 65,536 buckets by their digest; the
    ids of a word and the buckets of an id are summed up, and only a bucket is ordered.
    """
    bucket = F.substring("leaf", 1, 4).alias("bucket")
    each = rows.groupBy("grp", "word", "id", "leaf", "tampered", "start", "size").agg(F.count(F.lit(1)).alias("n"))
    each = stage(each.select("*", bucket), "repeats")
    buckets = each.groupBy("grp", "word", "id", "bucket").agg(F.sum("n").alias("n"))
    ids = buckets.groupBy("grp", "word", "id").agg(F.sum("n").alias("n"))

    def before(*group, order):
        spec = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(spec), F.lit(0))

    number = F.coalesce("id", F.lit(0)).alias("number")
    ids = ids.select("grp", "word", number, before("grp", "word", order="id").alias("in_word"))
    buckets = buckets.select(
        "grp", "word", number, "bucket", before("grp", "word", "id", order="bucket").alias("in_id")
    )
    first = (
        F.col("start") + F.col("in_word") + F.col("in_id") + before("grp", "word", "number", "bucket", order="leaf")
    )
    placed = (
        each.select("*", number).join(ids, ["grp", "word", "number"]).join(buckets, ["grp", "word", "number", "bucket"])
        .select("grp", "id", "leaf", "tampered", "size", "n", first.alias("first"))
    )
    some = placed.select("*", F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)")).alias("part"))
    some = some.repartition(partitions(rows.sparkSession), "leaf", "part")
    copy = F.explode(F.expr(f"sequence(part, least(part + {COPIES}, n) - 1)")).alias("copy")
    return some.select("*", copy).select("grp", "id", "leaf", "tampered", (F.col("first") + F.col("copy")).alias("slot"), "size")


def coordinates(rows: DataFrame) -> DataFrame:
    """``(grp, id, leaf, tampered, slot, size)``: every leaf's place in its group by a rank query."""
    words = directory(stage(bitmaps(rows), "bitmaps"))
    asked = rows.withColumn("word", _word()).join(words, ["grp", "word"])
    single = F.coalesce(F.bit_count("bits") == F.col("n"), F.lit(False))
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, cast(id & 63L as int))"))
    found = stage(asked.withColumn("slot", F.when(single, F.col("start") + below)), "ranks")
    ranked = found.where("slot IS NOT NULL").select("grp", "id", "leaf", "tampered", "slot", "size")
    return ranked.unionByName(_placed_repeats(found.where("slot IS NULL")))


def joined(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _levels(size: int) -> int:
    """Levels that a round takes off a group of so many nodes: none where one node is left."""
    levels = 0
    while size > 1 and levels < LEVELS:
        size, levels = -(-size // FAN), levels + 1
    return levels


def _array(slots, digests) -> list[str]:
    """The digests of a block by slot; they come in any order."""
    first = min(slots)
    first -= first % FAN**LEVELS
    out = [""] * len(slots)
    for slot, value in zip(slots, digests, strict=True):
        out[slot - first] = value
    return out


def _reduced(array: list[str], levels: int) -> list[list[str]]:
    """All levels of a block, its leaves first."""
    rows = [array]
    for _ in range(levels):
        below = rows[-1]
        rows.append([joined(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return rows


def _siblings(rows: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level of a block the run's others, before and after the node."""
    out = []
    for level in rows[:-1]:
        first = at - at % FAN
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + FAN])))
        at //= FAN
    return out


def _text(path: list[tuple[str, str]]) -> str:
    return ",".join(f"{a}|{b}" for a, b in path)


def _path(text: str) -> list[tuple[str, str]]:
    return [tuple(p.split("|")) for p in text.split(",")] if text else []


def folded(value: str, path: list[tuple[str, str]]) -> str:
    """The root that a node and its siblings give."""
    for before, after in path:
        value = joined(before, value, after)
    return value


def _block() -> Column:
    return F.expr(f"slot div {FAN**LEVELS}L")


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """Node tables ``(grp, slot, size, digest)`` from the given one up to one node per group."""
    out, most = [nodes], nodes.agg(F.max("size")).first()[0] or 1
    while most > 1:

        def up(key, frame):
            import pandas as pd

            levels = _levels(int(frame["size"].iloc[0]))
            rows = _reduced(_array(frame["slot"].tolist(), frame["digest"].tolist()), levels)
            size = -(-int(frame["size"].iloc[0]) // FAN**LEVELS)
            return pd.DataFrame([(key[0], key[1], size, rows[-1][0])], columns=["grp", "slot", "size", "digest"])

        blocks = out[-1].select("grp", "slot", "size", "digest").groupBy("grp", _block().alias("block"))
        out.append(stage(blocks.applyInPandas(up, _NODE), "nodes"))
        most = -(-most // FAN**LEVELS)
    return out


def _opened(frame, above) -> tuple:
    """A block's levels, and the siblings above it."""
    levels = _levels(int(frame["size"].iloc[0]))
    slots = frame["slot"].tolist()
    rows = _reduced(_array(slots, frame["digest"].tolist()), levels)
    first = min(slots) - min(slots) % FAN**LEVELS
    return rows, [s - first for s in slots], above.iloc[0]


def _below(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Paths of a round's nodes from those of the round above."""

    def down(frame, over):
        import pandas as pd

        rows, places, top = _opened(frame, over)
        upper = [top["path"]] if top["path"] else []
        out = frame[["grp", "slot"]].copy()
        out["path"] = [",".join([*filter(None, [_text(_siblings(rows, i))]), *upper]) for i in places]
        out["subroot"] = top["subroot"] or rows[-1][0]
        out["root"] = top["root"]
        return pd.DataFrame(out)

    blocks = nodes.select("grp", "slot", "size", "digest").groupBy("grp", _block().alias("block"))
    return blocks.cogroup(above.groupBy("grp", "slot")).applyInPandas(down, _PATH)


def paths(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the nodes of the second round; of the top one where there is no other."""
    for nodes in levels[-2:0:-1]:
        top = stage(_below(nodes, top), "paths")
    return top


def tree(rows: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Leaves with their coordinates, the node tables of the groups' trees, and per group its subroot,
    the root and the siblings between the two: ``(grp, slot, path, subroot, root)``.
    """
    placed = stage(coordinates(stage(rows, "leaves")), "leaves")
    levels = rounds(placed.withColumnRenamed("leaf", "digest"))
    groups = with_row_numbers(levels[-1].select("grp", F.col("digest").alias("subroot")), ["grp"], "slot")
    n_groups = groups.count()
    over = groups.select(F.lit("").alias("grp"), "slot", F.lit(n_groups).cast("long").alias("size"), F.col("subroot").alias("digest"))
    whole = rounds(over)
    root = whole[-1].select("grp", "slot", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for nodes in whole[-2::-1]:
        root = stage(_below(nodes, root), "paths")
    top = groups.join(root.select("slot", "path", "root"), "slot").select(
        "grp", F.lit(0).cast("long").alias("slot"), "path", "subroot", "root"
    )
    return placed, levels, top


def proofs(rows: DataFrame) -> DataFrame:
    """Every leaf with its proof, and the root that its own, or its tampered, digest folds to.

    ``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``.
    """
    placed, levels, top = tree(rows)
    above = paths(levels, top)

    def audit(frame, over):
        import pandas as pd

        rows, places, top = _opened(frame.rename(columns={"leaf": "digest"}), over)
        upper = _path(top["path"])
        out, known = [], {}
        rest = "".join(a + b for a, b in upper)
        for own, leaf, changed, i in zip(frame["id"], frame["leaf"], frame["tampered"], places, strict=True):
            inner = _siblings(rows, i)
            value = folded(changed or leaf, inner)
            if value not in known:
                known[value] = folded(value, upper)
            proof = joined("".join(a + b for a, b in inner), rest)
            out.append((None if own is None else int(own), leaf, top["subroot"], top["root"], proof, known[value], known[value] == top["root"]))
        ids, *rest = zip(*out, strict=True)
        names = [c.split()[0] for c in _AUDIT.split(", ")]
        return pd.DataFrame(dict(zip(names, [pd.array(ids, dtype="Int64"), *rest], strict=True)))

    # Ids travel as text: pandas would turn a column of integers with nulls into doubles.
    blocks = placed.withColumn("id", F.col("id").cast("string")).groupBy("grp", _block().alias("block"))
    return blocks.cogroup(above.groupBy("grp", "slot")).applyInPandas(audit, _AUDIT)


def audit(df: DataFrame) -> DataFrame:
    """Proofs of ``documents``, with one column changed where 7 divides the checksum of the id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return proofs(leaves(df, changed=(hit, {"n_chars": more})))
