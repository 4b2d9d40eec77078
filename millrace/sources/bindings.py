"""The input shapes of the stages, derived from the test tables.

Every shape covers its whole tables.
"""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.chat import user_message
from millrace.operators import collect, conversations
from millrace.operators.formatting import DOMAIN_SPECS

SUPPORT_INSTRUCTION = {spec[0]: spec[1] for spec in DOMAIN_SPECS}["support"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of fewer splits than cores one partition per core, for costly text work.

    Scans of larger data have splits enough and stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(
        table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("row_id"), "text", "lang", "source"
        )
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("row_id", "text")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(
        table(spark, sf_dir, "pages").select(
            F.col("page_id").alias("row_id"), F.col("html").alias("text")
        )
    )


def legal_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their first line as summary."""
    first_line = F.substring_index("text", "\n", 1)
    return document_texts(spark, sf_dir).withColumn("summary", first_line)


def medical_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items: the first sentence asks, the rest answers."""
    dot = F.instr("text", ".")
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("row_id"),
        F.when(dot > 0, F.substring("text", F.lit(1), dot)).otherwise(F.col("text")).alias("input"),
        F.when(dot > 0, F.substring("text", dot + 1, F.length("text"))).otherwise("").alias("output"),
    )


def support_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows."""
    return conversations.answered(spread(table(spark, sf_dir, "conversations")))


def mixed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three domains, whole rows and whole texts, under one id space in file order."""
    frames = (
        collect.collect_legal(legal_source(spark, sf_dir), None, max_chars=None),
        collect.collect_medical(medical_source(spark, sf_dir), None),
        collect.collect_support(support_source(spark, sf_dir), None),
    )
    ids = (table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "benchmark").select("item_id"), None)
    return collect.union_domains(*collect.one_id_space(list(zip(frames, ids, strict=True))))


def language_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their language as domain."""
    return documents(spark, sf_dir).select("row_id", F.col("lang").alias("domain"), "text")


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support pairs as formatted examples, before any cleaning."""
    return support_source(spark, sf_dir).select(
        "row_id",
        F.lit("support").alias("domain"),
        F.lit(SUPPORT_INSTRUCTION).alias("instruction"),
        F.col("instruction").alias("input"),
        F.col("response").alias("output"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support pairs as evaluation results; the outputs are parts of the reference.

    Every tenth conversation's tuned output is the reference in ASCII capitals: engines do not
    agree on the capital of sharp s.
    """
    ref = F.col("response")
    n = F.length(ref)

    def head(chars: Column) -> Column:
        return F.substring(ref, F.lit(1), chars.cast("int"))

    return support_source(spark, sf_dir).select(
        "row_id",
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 7 != 0, F.concat(F.lit("d"), F.col("conv_id") % 3)).alias("domain"),
        F.lit(SUPPORT_INSTRUCTION).alias("instruction"),
        user_message(F.lit(SUPPORT_INSTRUCTION), F.col("instruction")).alias("prompt_text"),
        ref.alias("reference"),
        head(F.floor(n / 2)).alias("base_output"),
        F.when(F.col("conv_id") % 10 == 0, F.translate(ref, ascii_lowercase, ascii_uppercase))
        .otherwise(head(F.floor(n * 3 / 4)))
        .alias("finetuned_output"),
    )


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = (F.col("conv_id") + F.col("turn")) % 4
    return support_source(spark, sf_dir).select(
        "row_id", F.when(pick == 0, "A").when(pick == 1, "B").when(pick == 2, "Tie").alias("choice")
    )


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.size(F.split(F.col("response"), " "))
    return support_source(spark, sf_dir).select(
        "row_id",
        (words - 1).alias("n"),
        (2 + F.col("conv_id") % 7 / 7).alias("base_loss"),
        (1 + F.col("turn") % 5 / 5).alias("finetuned_loss"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support pairs as a usage log."""
    return support_source(spark, sf_dir).select(
        (1704067200 + F.col("conv_id") * 600 + F.col("turn") * 30).cast("double").alias("timestamp"),
        F.lit("support").alias("domain"),
        F.col("instruction").alias("query"),
        "response",
        (3 * F.length("response")).alias("latency_ms"),
        F.lit(None).cast("string").alias("feedback"),
    )


def chat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = (
        F.when(F.col("event_type") == "view", "legal")
        .when(F.col("event_type") == "click", "medical")
        .when(F.col("event_type") == "error", "cooking")
        .when(F.col("event_type") == "signup", "support")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        domain.alias("domain"),
        F.when(F.col("event_id") % 11 == 0, "").otherwise(F.col("props")).alias("message"),
        (F.col("event_id") % 5000).cast("int").alias("max_tokens"),
        (F.col("value") / 10).alias("temperature"),
    )


def _spoilt(row: Column, sound: Column, alternatives: list[Column]) -> Column:
    """Every fifth row gets one of the unsound replies."""
    reply = sound
    for i, text in enumerate(alternatives):
        reply = F.when((row % 5 == 0) & (F.floor(row / 5) % len(alternatives) == i), text).otherwise(reply)
    return reply


def _pair_no() -> Column:
    return F.col("conv_id") * 8 + F.col("turn")


def list_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies that hold a JSON list of one record, some of them unsound."""
    item = F.to_json(
        F.struct(
            F.lit("Reply.").alias("instruction"),
            F.col("instruction").alias("input"),
            F.col("response").alias("output"),
        )
    )
    sound = F.concat(F.lit("Here you are: ["), item, F.lit("] Done."))
    bad = [
        F.lit("No list at all."),
        F.concat(F.lit("["), item, F.lit(", ]")),
        F.concat(F.lit('[7, "x", null, '), item, F.lit("]")),
        F.concat(F.lit('[{"instruction": 1, "input": "a", "output": "b"}, '), item, F.lit("]")),
        F.concat(F.lit("["), item, F.lit("] and [1]")),
    ]
    return support_source(spark, sf_dir).select(
        "row_id",
        F.concat(F.lit("d"), F.col("conv_id") % 3).alias("domain"),
        _spoilt(_pair_no(), sound, bad).alias("reply"),
    )


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies for both sides."""
    row = _pair_no()

    def verdict(score: Column) -> Column:
        return F.concat(
            F.lit('Verdict: {"score": '),
            score.cast("string"),
            F.lit(', "reason": '),
            F.to_json(F.struct(F.col("instruction").alias("r"))),
            F.lit("} end."),
        )

    bad = [
        F.lit("No verdict."),
        F.lit('{"score": "4", "reason": "text score"}'),
        F.lit('{"score": null, "reason": "no score"}'),
        F.lit('{"score": true, "reason": "flag"}'),
        F.lit('{"score": 3.5, "reason": "half"} {'),
        F.lit('{"score": 3.5, "reason": "half"} }'),
        F.lit('{"score": 3.5, "reason": "half"}'),
    ]
    return support_source(spark, sf_dir).select(
        "row_id",
        _spoilt(row, verdict(row % 5 + 1), bad).alias("base_reply"),
        _spoilt(row + 1, verdict((row + 2) % 5 + 1), bad).alias("finetuned_reply"),
    )


def chat_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat server replies, with the request they answer and its times."""
    content = F.to_json(F.struct(F.concat(F.lit(" "), F.col("response"), F.lit(" \n")).alias("content")))
    sound = F.concat(F.lit('{"choices": [{"message": '), content, F.lit("}]}"))
    bad = [
        F.lit('{"choices": [{"message": {"content": null}}]}'),
        F.lit('{"choices": []}'),
        F.lit('{"choices": [{"message": {"content": 5}}]}'),
        F.lit("Bad gateway"),
    ]
    start = 1704067200 + F.col("conv_id") * 600 + F.col("turn") * 30
    return support_source(spark, sf_dir).select(
        "row_id",
        F.lit("support").alias("domain"),
        F.col("instruction").alias("message"),
        start.cast("double").alias("started"),
        (start + F.length("response") / 16).alias("ended"),
        _spoilt(_pair_no(), sound, bad).alias("reply"),
    )


def drift_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("lang").alias("domain"), F.col("text").alias("input"))


def drift_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage log's queries; conversations split into pseudo-languages by number."""
    lang = F.element_at(F.array(*[F.lit(x) for x in ("en", "fr", "de", "es")]), (F.col("conv_id") % 4 + 1).cast("int"))
    return support_source(spark, sf_dir).select(lang.alias("domain"), F.col("instruction").alias("query"))


def usage_events(events: DataFrame) -> DataFrame:
    """Events as usage records."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return events.select(
        seconds.alias("timestamp"),
        F.col("event_type").alias("domain"),
        F.col("props").alias("query"),
        F.lit("").alias("response"),
        F.round(F.col("value") * 10).cast("int").alias("latency_ms"),
        F.lit(None).cast("string").alias("feedback"),
    )
