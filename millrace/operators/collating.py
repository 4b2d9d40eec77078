"""Padded batches of token ids for causal language modelling."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.seeded import leading_number
from millrace.functions.text import words
from millrace.operators.ranking import with_rank
from millrace.session import stage

# Fixed value: label of a position that the loss ignores.
IGNORED = -100


def word_ids(text: Column, vocab_size: int = 32768) -> Column:
    """Stateless stand-in for a model tokenizer: each word hashed to 1..vocab_size-1.

    No vocabulary has to be built, joined or broadcast. 0 is left for padding.
    """
    return F.transform(
        words(text),
        lambda w: (leading_number(F.md5(w), 7) % (vocab_size - 1) + 1).cast("int"),
    )


def collate(
    df: DataFrame,
    ids: str = "ids",
    batch_size: int = 4,
    max_length: int = 2048,
    pad_id: int = 0,
    seed: int = 42,
    row_id: str = "row_id",
) -> DataFrame:
    """Put rows into batches in seeded order, cut to ``max_length``, pad to the longest.

    The token arrays are written once, so no text is tokenized again. Ranks and batch lengths
    are worked out on (id, length) alone. The arrays move once, to meet their row's batch.
    """
    df = stage(df.select(row_id, ids), "token-ids")
    lengths = df.select(row_id, F.least(F.size(ids), F.lit(max_length)).alias("n_ids"))
    placed = with_rank(lengths, seed, row_id=row_id).withColumn(
        "batch", F.floor((F.col("rank") - 1) / batch_size)
    )
    members = F.collect_list(F.struct(F.col(row_id), "rank", "n_ids"))
    batches = placed.groupBy("batch").agg(
        F.max("n_ids").alias("width"), members.alias("members")
    )
    plan = batches.select("batch", "width", F.inline("members"))
    padding = F.col("width") - F.col("n_ids")
    kept = F.slice(F.col(ids), 1, max_length)
    return df.join(plan, row_id).select(
        "batch",
        row_id,
        F.concat(kept, F.array_repeat(F.lit(pad_id), padding)).alias("input_ids"),
        F.concat(
            F.array_repeat(F.lit(1), F.col("n_ids")), F.array_repeat(F.lit(0), padding)
        ).alias("attention_mask"),
        F.concat(kept, F.array_repeat(F.lit(IGNORED), padding)).alias("labels"),
    )
