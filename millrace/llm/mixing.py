"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. Sizes are summed by source and by the first 12 bits of
the hash, which cuts a source into 4096 buckets. The bucket in which a source's word budget
runs out is the only one that is looked into: its sizes are summed by the next 12 bits, and so
on until the whole hash is used. What remains is one hash bound per source, and documents under
it are taken. Nothing is sorted but the buckets, and budgets nest: a smaller budget takes a subset.

The hash is of id and text, so null and repeated ids fall apart. Rows equal in both share it; where the budget
runs out among them, they are numbered and the first ones are taken.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stage
from millrace.operators.numbering import with_row_numbers
from millrace.session import broadcast_if_small

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
DIGITS, LEVELS = 3, 5  # 12 bits a level, 60 bits in all


def _hash(id_col: str, text_col: str) -> Column:
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(text_col, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def sizes(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(doc_id, source, size, h, uid)``: words of the text, the hash of id and text, a number of the row."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        _words(text_col).alias("size"),
        _hash(id_col, text_col).alias("h"),
        F.monotonically_increasing_id().alias("uid"),
    )


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(no, source, source_size, target)``: one row per source, so the windows see few rows.

    Sources in order of code points, null last, take the weights in turn. With the sources sorted by
    cap over weight, the first k are full and the rest share what is left by weight; k is the least
    number for which nobody in the rest is above the cap.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("no") % len(weights) + 1)
    listed = (
        sums.withColumn("no", (F.row_number().over(by_name) - 1).cast("int"))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * most)
    )
    everything, by_ratio = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), "no")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    )
    shared = listed.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    shared = shared.withColumn("level", level)
    fits = F.col("cap") >= F.col("level") * F.col("weight")
    final = F.min(F.when(fits, F.struct("at", "level"))).over(everything)["level"]
    shared = shared.withColumn("at", F.row_number().over(by_ratio)).withColumn("final", final)
    target = F.least(
        F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap").cast("double"))
    )
    return shared.select("no", "source", "source_size", target.alias("target"))


def bounds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``(no, copies, bound, left)``: every document is taken ``copies`` times and once more under the
    hash ``bound``; of those that have this very hash, as many as ``left`` words hold.
    """
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = goals.select(
        "no", full.alias("copies"), (F.col("target") - full * F.col("source_size")).alias("left"),
        F.lit(0).cast("long").alias("prefix"),
    )
    inside = rows.withColumn("prefix", F.lit(0).cast("long"))
    for level in range(LEVELS):
        shift = 4 * DIGITS * (LEVELS - 1 - level)
        last = level == LEVELS - 1
        split = inside.withColumn("next", F.shiftright("h", shift))
        counted = split.groupBy("no", "next").agg(F.sum("size").alias("size"))
        through = F.sum("size").over(Window.partitionBy("no").orderBy("next"))
        # A bucket is the boundary if it is the first whose far end is too much.
        crossing = (
            counted.withColumn("through", through).join(state.select("no", "left"), "no").where("through > left")
            .groupBy("no").agg(F.min(F.struct("next", (F.col("through") - F.col("size")).alias("below"))).alias("b"))
        )
        below = F.coalesce(F.col("b.below"), F.lit(0))
        state = stage(
            state.join(crossing, "no", "left").select(
                "no", "copies", (F.col("left") - below).alias("left"),
                # without a crossing all documents of the bucket are under the bound
                F.coalesce(F.col("b.next"), F.shiftleft(F.col("prefix") + 1, 4 * DIGITS)).alias("prefix"),
            ),
            "mix-bound",
        )
        if not last:
            near = split.drop("prefix").join(state.select("no", "prefix"), "no").where("next = prefix")
            inside = stage(near.select("no", "h", "size", "prefix"), "mix-bucket")
    return state.select("no", "copies", F.col("prefix").alias("bound"), "left")


def _dealt(df: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, most: int):
    """Keyed rows ``(no, doc_id, size, source_size, target, h, uid)``, the targets and the bounds per source."""
    kept = stage(sizes(df, id_col, text_col, source_col), "mix-sizes")
    goals = stage(targets(kept, weights, share, most), "mix-targets")
    keyed = kept.join(goals, kept["source"].eqNullSafe(goals["source"])).drop("source")
    return keyed, goals, bounds(keyed.select("no", "h", "size"), goals)


def _on_the_bound(rows: DataFrame, prefix: str = "") -> DataFrame:
    """Adds ``extra`` to the rows whose hash is the bound: 1 while the middle of a row is in its source's budget.

    They are numbered by source without a sort of all in one task; mostly there is one row per source.
    """
    no, uid, size, left = (F.col(f"{prefix}{c}") for c in ("no", "uid", "size", "left"))
    numbered = with_row_numbers(rows, [no, uid], f"{prefix}n")
    first = numbered.groupBy(no.alias(f"{prefix}of")).agg(F.min(f"{prefix}n").alias(f"{prefix}first"))
    place = F.col(f"{prefix}n") - F.col(f"{prefix}first")
    met = numbered.join(first, no == F.col(f"{prefix}of"))
    return met.withColumn(f"{prefix}extra", ((place + 0.5) * size <= left).cast("int"))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per input row.

    A null or blank text has size 0 and is taken 0 words; null is a source of its own; null and repeated
    ids are told apart by their texts, equal rows by their number. A source whose texts are all empty
    has target 0. An empty table gives no rows. Extra columns are left out.
    """
    keyed, _, cuts = _dealt(df, id_col, text_col, source_col, weights, share, most)
    met = keyed.join(cuts, "no")
    apart = met.where("h <> bound").withColumn("extra", (F.col("h") < F.col("bound")).cast("int"))
    rows = apart.unionByName(_on_the_bound(met.where("h = bound")).select(*apart.columns))
    taken = F.col("size") * (F.col("copies") + F.col("extra"))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """The mix itself: input rows as often as they are taken, with their own columns.

    Each row is repeated in place by the bound of its source, so ids may be null or repeated, as
    in ``mix``; documents without words are not taken. Only rows that have the very hash of the bound are
    written once more, to be numbered.
    """
    _, goals, cuts = _dealt(df, id_col, text_col, source_col, weights, share, most)
    own = "__mix_"
    by_source = goals.join(cuts, "no").select(*[F.col(c).alias(own + c) for c in ("no", "source", "copies", "bound", "left")])
    worded = df.where(F.col(text_col).rlike("[^\\x20\\x09-\\x0D]")).withColumns(
        {f"{own}h": _hash(id_col, text_col), f"{own}size": _words(text_col), f"{own}uid": F.monotonically_increasing_id()}
    )
    met = worded.join(broadcast_if_small(by_source), F.col(source_col).cast("string").eqNullSafe(F.col(f"{own}source")))
    h, bound = F.col(f"{own}h"), F.col(f"{own}bound")
    apart = met.where(h != bound).withColumn(f"{own}extra", (h < bound).cast("int"))
    rows = apart.unionByName(_on_the_bound(met.where(h == bound), own).select(*apart.columns))
    times = (F.col(f"{own}copies") + F.col(f"{own}extra")).cast("int")
    return rows.where(times > 0).withColumn(f"{own}i", F.explode(F.sequence(F.lit(1), times))).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )
