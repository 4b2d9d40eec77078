"""Raw records to instruction, input and output rows, and to chat text."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions import chat
from millrace.functions.text import is_blank, trim_space

# Domain, instruction, input column, output column.
DOMAIN_SPECS = (
    ("legal", "Summarize the following legal text.", "text", "summary"),
    (
        "medical",
        "Answer the following medical question accurately and concisely.",
        "question",
        "answer",
    ),
    (
        "support",
        "Write a helpful, polite support reply to the customer message.",
        "ticket",
        "resolution",
    ),
)


def domain_specs(spark: SparkSession) -> DataFrame:
    """The specs as a dimension table: one row per domain known to the code."""
    return spark.createDataFrame(
        list(DOMAIN_SPECS), "domain string, instruction string, input_column string, output_column string"
    )


def with_spec(df: DataFrame) -> DataFrame:
    """Add each row's spec; rows of unknown domains drop out. The table has three fixed rows."""
    return df.join(F.broadcast(domain_specs(df.sparkSession)), "domain")


def _named_column(df: DataFrame, chooser: str, names: list[str]) -> Column:
    """The text of the column whose name ``chooser`` holds; null where the row lacks it or where
    the column holds no text.
    """
    value = F.lit(None).cast("string")
    for name in names:
        if name in df.columns and isinstance(df.schema[name].dataType, StringType):
            value = F.when(F.col(chooser) == name, F.col(name)).otherwise(value)
    return value


def format_records(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """instruction, input, output of known domains; both texts trimmed, neither blank."""
    known = with_spec(df)
    raw_in = _named_column(df, "input_column", [spec[2] for spec in DOMAIN_SPECS])
    raw_out = _named_column(df, "output_column", [spec[3] for spec in DOMAIN_SPECS])
    return known.where(~is_blank(raw_in) & ~is_blank(raw_out)).select(
        row_id,
        "domain",
        "instruction",
        trim_space(raw_in).alias("input"),
        trim_space(raw_out).alias("output"),
    )


def with_user_message(df: DataFrame) -> DataFrame:
    return df.withColumn("user_message", chat.user_message(F.col("instruction"), F.col("input")))


def with_messages(df: DataFrame, include_answer: bool = True) -> DataFrame:
    output = F.col("output") if include_answer else None
    return df.withColumn("messages", chat.messages(F.col("instruction"), F.col("input"), output))


def training_texts(df: DataFrame, template: str = "mistral", row_id: str = "row_id") -> DataFrame:
    """One training text per example; every other column is dropped."""
    turns = chat.messages(F.col("instruction"), F.col("input"), F.col("output"))
    return df.select(row_id, chat.training_text(turns, template).alias("text"))


def generation_prompts(df: DataFrame, template: str = "mistral", row_id: str = "row_id") -> DataFrame:
    prompt = chat.generation_prompt(F.col("instruction"), F.col("input"), template)
    return df.select(row_id, prompt.alias("prompt"))
