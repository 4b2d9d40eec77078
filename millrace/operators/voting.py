"""Blind A/B comparison: who sits on which side, and who won."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.seeded import seeded_hash


def assign_sides(results: DataFrame, seed: int = 0, row_id: str = "row_id") -> DataFrame:
    """A seeded coin per row decides whether the tuned output is shown as A."""
    coin = F.substring(seeded_hash(seed, F.col(row_id)), 1, 1) < "8"
    tuned, base = F.col("finetuned_output"), F.col("base_output")
    return results.withColumn("finetuned_first", coin).select(
        row_id,
        "prompt_text",
        F.when(F.col("finetuned_first"), tuned).otherwise(base).alias("response_a"),
        F.when(F.col("finetuned_first"), base).otherwise(tuned).alias("response_b"),
        "finetuned_first",
    )


def resolve_votes(votes: DataFrame, sides: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Turn the choices A, B and Tie into winners; rows without a choice are not votes."""
    tuned_chosen = (F.col("choice") == "A") == F.col("finetuned_first")
    winner = (
        F.when(F.col("choice") == "Tie", "tie").when(tuned_chosen, "finetuned").otherwise("base")
    )
    made = votes.where(F.length("choice") > 0)
    return made.join(sides.select(row_id, "finetuned_first"), row_id).select(
        row_id, winner.alias("winner")
    )


def tally(resolved: DataFrame) -> DataFrame:
    """Votes and share per winner; the total is rolled up from the few winner rows."""
    wins = resolved.groupBy("winner").agg(F.count(F.lit(1)).alias("votes"))
    total = wins.select(F.sum("votes")).scalar()
    return wins.withColumn("share", F.col("votes") / total)
