"""Scoring model output against references, and base against tuned by domain."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import metrics
from millrace.functions.chat import user_message
from millrace.functions.decimals import fixed
from millrace.functions.prose_json import braced, kind, number_at, strict_json, string_at
from millrace.functions.text import known_domain, words
from millrace.operators.ranking import first_rows

# Metric names of the report, in its order.
METRICS = ("rougeL", "token_f1", "exact_match")
SIDES = ("base", "finetuned")

# Title, table head and judge label of the report.
REPORT_TITLE = "# Fine-tuned vs Base Model\n"
TABLE_HEAD = "| Metric | Base | Fine-tuned | Delta |\n|---|---|---|---|"
JUDGE_LABEL = "llm_judge (1-5)"


def pair_predictions(
    references: DataFrame, base: DataFrame, finetuned: DataFrame, row_id: str = "row_id"
) -> DataFrame:
    """Meet each reference row with both model outputs by id (each has ``row_id, output``)."""
    return references.join(
        base.select(row_id, F.col("output").alias("base_output")), row_id
    ).join(finetuned.select(row_id, F.col("output").alias("finetuned_output")), row_id)


def pair_by_position(examples: DataFrame, base: DataFrame, finetuned: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Evaluation results from test examples and two prediction files whose rows carry their position.

    ``base`` has ``base_output`` and ``finetuned`` has ``finetuned_output``. A position that only some of the
    three have means that they do not belong together, and fails the job.
    """
    sides = [t.withColumn(f"__{i}", F.lit(True)) for i, t in enumerate((examples, base, finetuned))]
    met = sides[0].join(sides[1], row_id, "full").join(sides[2], row_id, "full")
    whole = F.col("__0") & F.col("__1") & F.col("__2")
    uneven = F.raise_error(F.lit("the files have different numbers of lines")).cast("bigint")
    return met.select(
        F.when(whole, F.col(row_id)).otherwise(uneven).alias(row_id),
        "domain",
        "instruction",
        user_message(F.col("instruction"), F.col("input")).alias("prompt_text"),
        F.col("output").alias("reference"),
        "base_output",
        "finetuned_output",
    )


def with_metrics(
    df: DataFrame, outputs: dict[str, str], ref: str = "reference", stem: bool = True
) -> DataFrame:
    """Add the three metrics of every output column; ``outputs`` maps a name prefix to it.

    Each text is cut into words once, whatever the number of metrics and sides.
    """
    texts = {"ref": ref, **{f"{prefix}pred": column for prefix, column in outputs.items()}}
    cut = df.withColumns(
        {f"{k}__words": words(F.col(c)) for k, c in texts.items()}
        | {f"{k}__tokens": metrics.ascii_tokens(F.col(c)) for k, c in texts.items()}
    )
    ref_words, ref_tokens = F.col("ref__words"), F.col("ref__tokens")
    scores = {}
    for prefix in outputs:
        pred_words, pred_tokens = F.col(f"{prefix}pred__words"), F.col(f"{prefix}pred__tokens")
        scores |= {
            f"{prefix}rougeL": metrics.rouge_l(pred_tokens, ref_tokens, stem),
            f"{prefix}token_f1": metrics.token_f1(pred_words, ref_words),
            f"{prefix}exact_match": metrics.exact_match(pred_words, ref_words),
        }
    return cut.select(*df.columns, *[c.alias(name) for name, c in scores.items()])


def score_predictions(
    df: DataFrame, pred: str = "prediction", ref: str = "reference", stem: bool = True
) -> DataFrame:
    """Add the three metrics of one output column to each row."""
    return with_metrics(df, {"": pred}, ref, stem)


def mean_scores(
    df: DataFrame, pred: str = "prediction", ref: str = "reference", stem: bool = True
) -> DataFrame:
    """One row of metric means; zeros for an empty set."""
    scored = score_predictions(df.select(pred, ref), pred, ref, stem)
    return scored.agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in METRICS])


def compare_by_domain(results: DataFrame, stem: bool = True, row_id: str = "row_id") -> DataFrame:
    """Base, tuned and delta of each metric per domain and over all rows.

    Rows are scored once. Sums per domain come first, and the total row is rolled up from
    those few rows and one of zeros, so that it exists, all zero, for an empty set as well.
    ``is_total`` tells it from a domain that happens to be called ALL.
    """
    columns = [f"{side}_{m}" for side in SIDES for m in METRICS]
    outputs = {f"{side}_": f"{side}_output" for side in SIDES}
    rows = with_metrics(
        results.select(row_id, "domain", "reference", *outputs.values()), outputs, "reference", stem
    ).withColumn("domain", known_domain(F.col("domain")))
    per_domain = rows.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(row_id).alias("first_row"),
        *[F.sum(k).alias(k) for k in columns],
    )
    nothing = results.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("domain"),
        F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("long").alias("first_row"),
        *[F.lit(0.0).alias(k) for k in columns],
    )
    rolled = per_domain.unionByName(nothing).rollup("domain").agg(
        F.grouping("domain").cast("boolean").alias("is_total"),
        F.sum("n").alias("n"),
        F.min("first_row").alias("first_row"),
        *[F.sum(k).alias(k) for k in columns],
    )
    metric_rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("metric_no"),
                F.lit(m).alias("metric"),
                (F.col(f"base_{m}") / F.greatest("n", F.lit(1))).alias("base"),
                (F.col(f"finetuned_{m}") / F.greatest("n", F.lit(1))).alias("finetuned"),
            )
            for i, m in enumerate(METRICS)
        ]
    )
    return rolled.where("n > 0 or is_total").select(
        F.when(F.col("is_total"), "ALL").otherwise(F.col("domain")).alias("domain"),
        "is_total",
        "n",
        "first_row",
        F.inline(metric_rows),
    ).withColumn("delta", F.col("finetuned") - F.col("base"))


def judge_prompts(df: DataFrame, response: str, row_id: str = "row_id") -> DataFrame:
    """The text that asks a judge model to grade a response."""
    prompt = F.concat(
        F.lit(
            "Grade the response from 1 (unusable) to 5 (excellent) for agreement with the "
            "reference, completeness, terms of the field and tone.\n\nTask:\n"
        ),
        F.col("prompt_text"),
        F.lit("\n\nReference:\n"),
        F.col("reference"),
        F.lit("\n\nResponse:\n"),
        F.col(response),
        F.lit('\n\nAnswer only with JSON: {"score": 1 to 5, "reason": "one sentence"}'),
    )
    return df.select(row_id, prompt.alias("prompt"))


def judge_verdicts(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``score`` (numbers only) and ``reason``, which is "parse_error" without sound JSON."""
    verdict = strict_json(braced(F.col(reply)))
    return (
        replies.withColumn("verdict", verdict)
        .withColumn("score", number_at(F.col("verdict"), "$.score"))
        .withColumn(
            "reason",
            F.when(F.col("verdict").isNull(), "parse_error").otherwise(
                string_at(F.col("verdict"), "$.reason")
            ),
        )
        .withColumn("score_type", kind(F.col("verdict"), "$.score"))
        .drop("verdict", reply)
    )


def mean_judge_score(verdicts: DataFrame, score: str = "score") -> DataFrame:
    """Mean over the numeric scores; NaN, not 0, where there is none."""
    return verdicts.agg(F.coalesce(F.avg(score), F.lit(float("nan"))).alias("mean_score"))


def judge_row(replies: DataFrame, judge_limit: int = 50, row_id: str = "row_id") -> DataFrame:
    """The report's judge line: mean scores of the first rows (``base_reply, finetuned_reply``)."""
    first = first_rows(replies, judge_limit, row_id)
    sides = {s: number_at(strict_json(braced(F.col(f"{s}_reply"))), "$.score") for s in SIDES}
    means = first.select(*[c.alias(s) for s, c in sides.items()]).agg(
        *[F.coalesce(F.avg(s), F.lit(float("nan"))).alias(s) for s in SIDES]
    )
    return means.select(
        F.lit("ALL").alias("domain"),
        F.lit(JUDGE_LABEL).alias("metric"),
        "base",
        "finetuned",
        (F.col("finetuned") - F.col("base")).alias("delta"),
    )


def _table_row(places: int) -> Column:
    cells = [F.col("metric"), fixed(F.col("base"), places), fixed(F.col("finetuned"), places), fixed(F.col("delta"), places, True)]
    return F.format_string("| %s | %s | %s | %s |", *cells)


def report_lines(comparison: DataFrame, judge: DataFrame | None = None) -> DataFrame:
    """The Markdown report as ordered lines: domains as first seen, the total last.

    A handful of rows per domain, so one ordered text file is fine.
    """
    first_row = F.when(~F.col("is_total"), F.col("first_row")).alias("first_row")
    table = comparison.select(
        F.col("is_total").alias("part"), first_row, "domain", "n",
        (F.col("metric_no") + 4).alias("line_no"),
        _table_row(3).alias("line"),
    )
    heads = comparison.where("metric_no = 0").select(
        F.col("is_total").alias("part"), first_row, "domain", "n",
        F.posexplode(
            F.array(
                F.lit(""),
                F.format_string("## %s (n=%d)", "domain", "n"),
                F.lit(""),
                F.lit(TABLE_HEAD),
            )
        ).alias("line_no", "line"),
    )
    title = comparison.sparkSession.range(1).select(
        F.lit(False).alias("part"), F.lit(-1).cast("long").alias("first_row"),
        F.lit("").alias("domain"), F.lit(0).cast("long").alias("n"),
        F.lit(0).alias("line_no"), F.lit(REPORT_TITLE).alias("line"),
    )
    parts = title.unionByName(heads).unionByName(table)
    if judge is not None:
        parts = parts.unionByName(
            judge.select(
                F.lit(True).alias("part"), F.lit(None).cast("long").alias("first_row"), "domain",
                F.lit(0).cast("long").alias("n"), F.lit(4 + len(METRICS)).alias("line_no"),
                _table_row(2).alias("line"),
            )
        )
    return parts.select("part", "first_row", "line_no", "line")
