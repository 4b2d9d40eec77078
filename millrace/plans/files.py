"""The steps as file-to-file jobs: JSON Lines in, JSON Lines or a report out.

Each job returns the counts that its own write has seen, as a dict; nothing is read a second time for
them. They are taken in the last stage, after every shuffle, so a lost executor does not make them
count twice. Output is published as a whole when it is complete, so a job may write to the folder it reads.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions import pii
from millrace.operators import (
    augmenting,
    drift,
    evaluating,
    perplexity,
    splitting,
    variant_records,
    voting,
)
from millrace.session import stage
from millrace.sources import jsonl, schemas
from millrace.sources.publishing import replacing

SPLITS = ("train", "val", "test")


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(row_id, record)``: records of any shape as VARIANT, every value with the type it has in the file.

    Records without ``row_id`` are numbered in path and line order; where some have one and others have none,
    the job fails, as it does for a line that is not one JSON object.

    One scan counts the lines and those that name the key. Where all do and the first has an id, the job
    itself fails at a record without; only other mixes are parsed here.
    """
    lines = jsonl.read_lines(spark, paths)
    named = F.contains("value", F.lit('"row_id"'))
    n_lines, n_named = lines.agg(F.count("value"), F.count_if(named)).first()
    own, mixed = variant_records.own_id(F.col("record")), "some records have a row_id and others have none"
    given = variant_records.parse_lines(lines.where(named)).where(own.isNotNull())
    first = variant_records.parse_lines(lines.limit(1)).where(own.isNotNull())
    if not (n_named == n_lines > 0 and first.count()):
        n_given = given.count() if n_named else 0
        if not n_given:
            return variant_records.parse_lines(jsonl.number_rows(lines))
        if n_given < n_lines:
            raise ValueError(mixed)
    lacking = F.raise_error(F.lit(mixed)).cast("long")
    return variant_records.parse_lines(lines).select(F.coalesce(own, lacking).alias("row_id"), "record")


def _counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """Counts that the job's own action takes as it runs."""
    seen = Observation()
    return df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in counts.items()]), seen


def _rows() -> Column:
    return F.count(F.lit(1))


def scrub_files(spark: SparkSession, in_glob: str, out: str) -> dict:
    """Raw files in path order; every record gets its number as ``row_id`` here, unless it has one.

    Returns ``rows`` and ``masked``, the masks set per label.
    """
    rows = variant_records.scrub(records(spark, in_glob))
    changed = rows.withColumn("changed", variant_records.changed_texts(F.col("held"), F.col("clean")))
    masks = changed.withColumns({f"n_{x}": n for x, n in variant_records.mask_counts(F.col("changed")).items()})
    seen, counts = _counted(masks, rows=_rows(), **{x: F.sum(f"n_{x}") for x in pii.LABELS})
    jsonl.write_lines(seen.select(variant_records.as_line(F.col("clean"), F.col("row_id")).alias("value")), out)
    found = counts.get
    return {"rows": found["rows"], "masked": {x: found[x] for x in pii.LABELS}}


def _line() -> Column:
    return variant_records.as_line(variant_records.entries(F.col("record")), F.col("row_id")).alias("value")


def dedup_files(spark: SparkSession, inp: str, out: str) -> dict:
    """Returns ``rows_in`` and ``rows_out``."""
    unique = variant_records.deduplicate(records(spark, inp))
    seen, counts = _counted(unique, rows_in=F.sum("copies"), rows_out=_rows())
    jsonl.write_lines(seen.select(_line()), out)
    return counts.get


def filter_files(spark: SparkSession, inp: str, out: str, min_chars: int = 30, max_chars: int = 8000) -> dict:
    """Returns ``rows_in``, ``rows_out`` and ``dropped``, the rows per reason."""
    rows = records(spark, inp)
    texts = rows.withColumn("texts", variant_records.contents(variant_records.entries(F.col("record"))))
    judged = texts.withColumn("reason", variant_records.drop_reason(F.col("texts"), min_chars, max_chars))
    reasons = ("empty", "length", "letters")
    seen, counts = _counted(judged, rows_in=_rows(), **{r: F.count_if(F.col("reason") == r) for r in reasons})
    jsonl.write_lines(seen.where("reason IS NULL").select(_line()), out)
    found = counts.get
    dropped = {r: found[r] for r in reasons}
    return {"rows_in": found["rows_in"], "rows_out": found["rows_in"] - sum(dropped.values()), "dropped": dropped}


def format_files(spark: SparkSession, inp: str, out: str) -> dict:
    """Records of unknown domains, or whose texts are missing, blank or no strings, are left out.

    Returns ``rows_in`` and ``rows_out``.
    """
    rows, counts = _counted(records(spark, inp), rows_in=_rows())
    kept, written = _counted(variant_records.format_records(rows), rows_out=_rows())
    jsonl.write_jsonl(kept, out)
    return {**counts.get, **written.get}


def split_files(
    spark: SparkSession,
    inp: str,
    out_dir: str,
    train_frac: float = 0.8,
    val_frac: float = 0.1,
    seed: int = 42,
) -> dict:
    """The domain, whatever its type, is the stratum; records are written as they were read.

    Returns the rows of each split.
    """
    rows = records(spark, inp).withColumn("domain", variant_records.stratum(variant_records.entries(F.col("record"))))
    split = splitting.stratified_split(stage(rows.select("row_id", "domain", _line()), "examples"), train_frac, val_frac, seed)
    ordered = jsonl.split_ordered(splitting.with_split_order(split, seed).select("value", "split", "order_key"), "order_key")
    seen, counts = _counted(ordered, **{s: F.count_if(F.col("split") == s) for s in SPLITS})
    with replacing(spark, out_dir) as new:
        seen.write.partitionBy("split").text(new)
    return counts.get


def report_files(
    spark: SparkSession,
    results: str,
    out: str,
    judge_replies: str | None = None,
    judge_limit: int = 50,
) -> DataFrame:
    """Write the base-against-tuned report and return its numbers.

    ``judge_replies`` are answered judge prompts: ``row_id, base_reply, finetuned_reply``.
    """
    compared = stage(
        evaluating.compare_by_domain(jsonl.read_jsonl(spark, results, schemas.RESULT)), "report"
    )
    judged = None
    if judge_replies is not None:
        replies = jsonl.read_jsonl(spark, judge_replies, schemas.JUDGE_REPLIES)
        judged = evaluating.judge_row(replies, judge_limit)
    jsonl.write_report(evaluating.report_lines(compared, judged), out)
    return compared


def drift_files(
    spark: SparkSession, train_dir: str, usage: str, p_threshold: float = 0.01, oov_threshold: float = 0.25
) -> DataFrame:
    """The drift verdict of a usage log against the train part of a split folder."""
    train = jsonl.read_split(spark, train_dir, "train", schemas.EXAMPLE)
    live = jsonl.read_usage(spark, usage)
    return drift.drift_verdict(
        train, live, p_threshold=p_threshold, oov_threshold=oov_threshold
    )


def augment_files(spark: SparkSession, train_dir: str, out: str, calls: int = 20, shots: int = 3, per_call: int = 5, seed: int = 42) -> dict:
    """Prompts that ask a model for further rows, from the train part of a split folder only.

    A line has ``call``, ``domain`` and ``prompt``. Returns ``prompts``.
    """
    train = jsonl.read_split(spark, train_dir, "train", schemas.EXAMPLE)
    prompts = augmenting.synthesis_prompts(augmenting.few_shot_samples(train, calls, shots, seed), per_call)
    seen, counts = _counted(prompts, prompts=_rows())
    jsonl.write_jsonl(seen, out)
    return counts.get


def synthetic_files(spark: SparkSession, replies: str, out: str) -> dict:
    """Model replies ``(row_id, domain, reply)`` to training rows; unsound replies and items go.

    A line has domain, instruction, input and output, as train files have. Returns ``replies`` and ``rows``.
    """
    read, asked = _counted(jsonl.read_jsonl(spark, replies, schemas.REPLY), replies=_rows())
    seen, counts = _counted(augmenting.synthetic_rows(read).drop("row_id", "item_no"), rows=_rows())
    jsonl.write_jsonl(seen, out)
    return {**asked.get, **counts.get}


def side_files(spark: SparkSession, results: str, out: str, seed: int = 0) -> dict:
    """What raters see: ``row_id, prompt_text, response_a, response_b``. Returns ``rows``.

    Which side is the tuned one follows from seed and row id, so it need not be written.
    """
    sides = voting.assign_sides(jsonl.read_jsonl(spark, results, schemas.RESULT), seed)
    seen, counts = _counted(sides.drop("finetuned_first"), rows=_rows())
    jsonl.write_jsonl(seen, out)
    return counts.get


def vote_files(spark: SparkSession, votes: str, results: str, out: str, seed: int = 0) -> DataFrame:
    """Choices ``(row_id, choice)`` of raters to winners, one line each; returns the tally per winner."""
    sides = voting.assign_sides(jsonl.read_jsonl(spark, results, schemas.RESULT), seed)
    jsonl.write_jsonl(voting.resolve_votes(jsonl.read_jsonl(spark, votes, schemas.VOTE), sides), out)
    return voting.tally(jsonl.read_jsonl(spark, out, "row_id bigint, winner string"))


def perplexity_files(spark: SparkSession, losses: str, out: str) -> DataFrame:
    """A loss file ``(n, base_loss, finetuned_loss)``, a line per text, to one line with both perplexities."""
    both = stage(perplexity.perplexity_pair(jsonl.read_jsonl(spark, losses, schemas.LOSS)), "perplexity")
    jsonl.write_jsonl(both, out)
    return both


def pair_files(spark: SparkSession, examples: str, base: str, finetuned: str, out: str) -> dict:
    """Test examples and two files of predictions, paired by position: line n belongs to line n.

    Predictions are lines with ``output``. Files of different length fail, as position would then pair
    the wrong lines. A line has the columns of evaluation results. Returns ``rows``.
    """
    text = "output string"
    sides = {
        name: jsonl.number_rows(jsonl.read_jsonl(spark, path, text), "row_id").withColumnRenamed("output", name)
        for name, path in (("base_output", base), ("finetuned_output", finetuned))
    }
    tests = jsonl.number_rows(jsonl.read_jsonl(spark, examples, schemas.EXAMPLE.partition(", ")[2]), "row_id")
    paired = evaluating.pair_by_position(tests, sides["base_output"], sides["finetuned_output"])
    seen, counts = _counted(paired, rows=_rows())
    jsonl.write_jsonl(seen, out)
    return counts.get
