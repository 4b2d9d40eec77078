"""Raw records to split examples: scrub, de-duplicate, filter, format, split."""

from pyspark.sql import DataFrame

from millrace.operators.dedup import deduplicate
from millrace.operators.formatting import format_records
from millrace.operators.quality import keep_good
from millrace.operators.scrub import scrub_records
from millrace.operators.splitting import stratified_split
from millrace.session import stage


def clean_examples(raw: DataFrame, staged: bool = False) -> DataFrame:
    """Scrubbing comes first, so records that differ only in masked data fall together."""
    unique = deduplicate(scrub_records(raw), staged=staged)
    return format_records(keep_good(unique))


def prepare(
    raw: DataFrame,
    train_frac: float = 0.8,
    val_frac: float = 0.1,
    seed: int = 42,
    staged: bool = True,
) -> DataFrame:
    """Examples with their split.

    Dedup reads its input twice and the split reads ids before rows, so by default each of
    the two inputs is written once to the shared folder. ``staged=False`` recomputes.
    """
    examples = clean_examples(raw, staged)
    if staged:
        examples = stage(examples, "examples")
    return stratified_split(examples, train_frac, val_frac, seed)
