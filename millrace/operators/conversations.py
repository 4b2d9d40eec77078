"""Question and answer pairs from tables of conversation turns ``(conv_id, turn, role, text)``."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 1024
_TURN = ("turn", "role", "text")


def with_next(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """Adds ``next``, the following turn of the conversation as a struct, whatever its number.

    (conv_id, turn) must be unique. Texts are shuffled once, by pieces of ``piece`` turn numbers, so a
    conversation of any length is no hot group; the window over a piece gives all but its last row
    their next turn. That one's is the first turn of the next piece that has any: heads are
    taken of pieces beyond the lowest of the table only, in most tables none.
    """
    cut = turns.select("conv_id", *_TURN, F.floor(F.col("turn") / piece).alias("piece"))
    lowest = turns.select(F.floor(F.min("turn") / piece)).scalar()
    inside = Window.partitionBy("conv_id", "piece").orderBy(F.col("turn").asc_nulls_last())
    led = cut.withColumn("inside", F.lead(F.struct(*_TURN)).over(inside))
    heads = cut.where(F.col("piece") > lowest).groupBy("conv_id", F.col("piece").alias("after")).agg(
        F.min_by(F.struct(*_TURN), "turn").alias("head")
    )
    along = Window.partitionBy("conv_id").orderBy("piece")
    pieces = cut.where("piece IS NOT NULL").select("conv_id", "piece").distinct()
    steps = pieces.select("conv_id", "piece", F.lead("piece").over(along).alias("after")).where("after IS NOT NULL")
    ends = steps.join(heads, ["conv_id", "after"]).select("conv_id", "piece", "head")
    return led.join(ends, ["conv_id", "piece"], "left").select(
        "conv_id", *_TURN, F.coalesce("inside", "head").alias("next")
    )


def pair_id(turns: DataFrame) -> Column:
    """A row id in the order of (conv_id, turn), from 0, that two turns never share.

    Conversations are as many ids apart as the table's turn numbers span; where that leaves the range of
    bigint the job fails.
    """
    conv, turn = (F.col(c).cast("bigint") for c in ("conv_id", "turn"))
    first, low, high = (turns.select(c).scalar() for c in (F.min(conv), F.min(turn), F.max(turn)))
    return (conv - first) * (high - low + 1) + turn - low


def answered(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """User turns that an assistant turn follows: ``row_id, conv_id, turn, instruction, response``."""
    pairs = with_next(turns, piece).where((F.col("role") == "user") & (F.col("next.role") == "assistant"))
    return pairs.select(
        pair_id(turns).alias("row_id"), "conv_id", "turn", F.col("text").alias("instruction"), F.col("next.text").alias("response")
    )
