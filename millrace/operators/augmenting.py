"""Few-shot prompt tables for synthetic rows, and reading the model's replies."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.prose_json import bracketed, string_at, strict_json
from millrace.functions.seeded import leading_number, seeded_hash
from millrace.functions.text import named_domain
from millrace.operators.ranking import group_profiles, keyed, rows_at_ranks
from millrace.session import broadcast_if_small, stage

FIELDS = ("instruction", "input", "output")


def _draw(seed: int, *parts) -> Column:
    """A seeded number in [0, 2^48)."""
    return leading_number(seeded_hash(seed, *parts), 12)


def _distinct_ranks(seed: int, shots: int) -> Column:
    """Up to ``shots`` distinct ranks in 1..group_rows, uniform without replacement.

    Draw j picks among the group_rows - j ranks not yet taken: it counts upwards past the
    taken ones. The accumulator is the sorted list of the ranks taken so far.
    """

    def add(taken: Column, j: Column) -> Column:
        free = F.pmod(_draw(seed, F.col("call"), j), F.col("group_rows") - j) + 1
        pick = F.aggregate(taken, free, lambda at, t: F.when(at >= t, at + 1).otherwise(at))
        return F.array_sort(F.concat(taken, F.array(pick)))

    slots = F.sequence(F.lit(0), F.least(F.lit(shots), F.col("group_rows").cast("int")) - 1)
    return F.aggregate(slots, F.array().cast("array<bigint>"), add)


def few_shot_samples(
    train: DataFrame, calls: int = 20, shots: int = 3, seed: int = 42, row_id: str = "row_id"
) -> DataFrame:
    """Per call one domain and up to ``shots`` of its rows, from the train split.

    A call names ranks in its domain's seeded order and only the rows at those ranks are
    looked up; rows and calls are never paired off. Domains, ids and sort keys are written once
    for the three passes over them; the texts are read at the end, for the ids drawn.
    """
    narrow = train.select(named_domain(F.col("domain")).alias("domain"), row_id)
    rows = stage(keyed(narrow, seed, row_id), "draw")
    profiles = stage(group_profiles(rows, ["domain"]), "profiles")
    by_name = (F.row_number().over(Window.orderBy("domain")) - 1).cast("long")
    domains = broadcast_if_small(profiles.select("domain", "group_rows").withColumn("domain_no", by_name))
    n_domains = domains.select(F.count(F.lit(1))).scalar()
    drawn = train.sparkSession.range(calls).select(
        F.col("id").alias("call"),
        F.pmod(_draw(seed, F.lit("call"), F.col("id")), n_domains).alias("domain_no"),
    )
    wanted = (
        drawn.join(domains, "domain_no")
        .withColumn("rank", F.explode(_distinct_ranks(seed, shots)))
        .select("call", "domain", "rank")
        .join(profiles.select("domain", "steps"), "domain")
    )
    found = rows_at_ranks(rows, wanted, ["domain"], [row_id]).select("call", "domain", "rank", row_id)
    texts = train.select(row_id, *FIELDS)
    return texts.join(broadcast_if_small(found), row_id).select("call", "domain", "rank", row_id, *FIELDS)


def synthesis_prompts(samples: DataFrame, per_call: int = 5) -> DataFrame:
    """One prompt per call: its examples as a JSON list, its domain and the row count."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", *FIELDS)))
    examples = F.transform(ordered, lambda e: F.struct(*[e[f].alias(f) for f in FIELDS]))
    prompt = F.concat(
        F.lit('These records come from the "'),
        F.col("domain"),
        F.lit('" domain:\n\n'),
        F.to_json(F.col("examples")),
        F.lit(
            f"\n\nWrite {per_call} further records for the same task, varied and realistic, "
            "no copies, no real personal data. Answer with a JSON list of objects holding "
            "instruction, input and output, and nothing else."
        ),
    )
    return (
        samples.groupBy("call", "domain")
        .agg(examples.alias("examples"))
        .select("call", "domain", prompt.alias("prompt"))
    )


def reply_items(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """One row per list element of each reply; replies without one sound list drop out."""
    parsed = replies.withColumn("parsed", strict_json(bracketed(F.col(reply)))).drop(reply)
    items = F.try_variant_get("parsed", "$", "array<variant>")
    return parsed.select(
        *[c for c in parsed.columns if c != "parsed"], F.posexplode(items).alias("item_no", "item")
    )


def synthetic_rows(replies: DataFrame, reply: str = "reply", call_id: str = "row_id") -> DataFrame:
    """Reply items whose three fields are strings, under the domain of their call."""
    texts = reply_items(replies, reply).select(
        call_id,
        "item_no",
        "domain",
        *[string_at(F.col("item"), f"$.{f}").alias(f) for f in FIELDS],
    )
    return texts.dropna(subset=list(FIELDS))
