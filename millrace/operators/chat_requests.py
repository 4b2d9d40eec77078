"""Chat requests and replies as tables: validation, prompts, payloads, answers, usage rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.chat import message
from millrace.functions.prose_json import kind, strict_json
from millrace.functions.text import trim_space
from millrace.operators.formatting import DOMAIN_SPECS, domain_specs

# Request defaults and inclusive bounds.
DEFAULT_DOMAIN = "support"
DEFAULT_MAX_TOKENS = 512
DEFAULT_TEMPERATURE = 0.2
MAX_TOKENS_BOUNDS = (1, 4096)
TEMPERATURE_BOUNDS = (0.0, 2.0)


def validate_requests(requests: DataFrame) -> DataFrame:
    """Fill defaults; ``error`` names the first field out of bounds and ``valid`` is its absence."""
    filled = requests.withColumns(
        {
            "domain": F.coalesce("domain", F.lit(DEFAULT_DOMAIN)),
            "max_tokens": F.coalesce("max_tokens", F.lit(DEFAULT_MAX_TOKENS)),
            "temperature": F.coalesce("temperature", F.lit(DEFAULT_TEMPERATURE)),
        }
    )
    error = (
        F.when(F.coalesce(F.length("message"), F.lit(0)) < 1, "message")
        .when(~F.col("max_tokens").between(*MAX_TOKENS_BOUNDS), "max_tokens")
        .when(~F.col("temperature").between(*TEMPERATURE_BOUNDS), "temperature")
    )
    return filled.withColumn("error", error).withColumn("valid", F.col("error").isNull())


def with_prompts(requests: DataFrame) -> DataFrame:
    """Add ``prompt``; an unknown domain gives none and fills ``prompt_error``."""
    specs = domain_specs(requests.sparkSession).select(
        "domain", F.col("instruction").alias("domain_instruction")
    )
    known = ", ".join(spec[0] for spec in DOMAIN_SPECS)
    joined = requests.join(F.broadcast(specs), "domain", "left")
    unknown = F.col("domain_instruction").isNull()
    return joined.withColumns(
        {
            "prompt": F.concat_ws("\n\n", "domain_instruction", "message"),
            "prompt_error": F.concat(F.lit("unknown domain "), "domain", F.lit(f"; known: {known}")),
        }
    ).withColumns(
        {
            "prompt": F.when(~unknown, F.col("prompt")),
            "prompt_error": F.when(unknown, F.col("prompt_error")),
        }
    ).drop("domain_instruction")


def request_payload(
    prompt: Column, max_tokens: Column, temperature: Column, model: str = "domain-llm"
) -> Column:
    """The JSON body for the model server."""
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message("user", prompt)).alias("messages"),
            max_tokens.alias("max_tokens"),
            temperature.alias("temperature"),
        )
    )


def with_answers(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``answer``: the first choice's text, trimmed, '' for null; any other shape is an error."""
    path = "$.choices[0].message.content"
    body = replies.withColumn("body", strict_json(F.col(reply)))
    found = kind(F.col("body"), path)
    text = trim_space(F.try_variant_get("body", path, "string"))
    answer = F.when(found == "VOID", "").when(found == "STRING", text)
    return (
        body.withColumn("answer", answer)
        .withColumn("status", F.when(F.col("answer").isNull(), "error").otherwise("ok"))
        .drop("body", reply)
    )


def latency_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds between two epoch times in seconds."""
    return ((end - start) * 1000).cast("int")


def usage_rows(answered: DataFrame) -> DataFrame:
    """Usage records of answered requests (``started, ended, domain, message, answer``)."""
    return answered.where(F.col("answer").isNotNull()).select(
        F.col("ended").alias("timestamp"),
        "domain",
        F.col("message").alias("query"),
        F.col("answer").alias("response"),
        latency_ms(F.col("started"), F.col("ended")).alias("latency_ms"),
        F.lit(None).cast("string").alias("feedback"),
    )
