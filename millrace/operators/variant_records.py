"""The cleaning steps on records of any shape, held as VARIANT.

Rows are ``row_id bigint, record variant``, a JSON object each. Every value keeps its own type,
whatever other records hold under the same key, and a key with a null is not an absent key. A step that
works on texts takes the values that are strings and leaves all others as they are. Keys come back
in alphabetical order; ``1.0`` is written as ``1``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import pii
from millrace.functions.seeded import required
from millrace.functions.text import is_blank, letter_count, squeeze_space, trim_space
from millrace.operators.formatting import domain_specs
from millrace.operators.records import META_COLUMNS

ENTRIES = "map<string,variant>"
ROW_ID = "row_id"


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON Lines to records: ``record`` in place of ``value``.

    A line that is not one JSON object fails the job.
    """
    wrapped = F.parse_json(F.concat(F.lit("["), F.col(value), F.lit("]")))
    listed = lines.withColumn("__list", wrapped).drop(value)
    first = F.try_variant_get("__list", "$[0]", "variant")
    lonely = F.try_variant_get("__list", "$[1]", "variant").isNull() & F.schema_of_variant(first).startswith("OBJECT")
    wrong = F.raise_error(F.lit("a line is not one JSON object")).cast("variant")
    return listed.withColumn("record", F.when(lonely, first).otherwise(wrong)).drop("__list")


def entries(record: Column) -> Column:
    return record.cast(ENTRIES)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    """The value if it is a string, else null."""
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _is_content(key: Column) -> Column:
    return ~key.isin(*META_COLUMNS, ROW_ID)


def contents(held: Column) -> Column:
    """Content strings of a record's entries, in the order of their keys."""
    chosen = F.filter(F.map_entries(held), lambda e: _is_content(e["key"]) & (_kind(e["value"]) == "STRING"))
    return F.transform(F.array_sort(F.transform(chosen, lambda e: F.struct(e["key"].alias("key"), _text(e["value"]).alias("text")))), lambda e: e["text"])


def as_line(held: Column, row_id: Column | None = None) -> Column:
    """Entries as one line of JSON, with the row id among them if one is given."""
    if row_id is not None:
        rest = F.map_filter(held, lambda k, _: k != ROW_ID)
        held = F.map_concat(rest, F.create_map(F.lit(ROW_ID), row_id.cast("variant")))
    return F.to_json(F.call_function("to_variant_object", held))


def scrub(rows: DataFrame) -> DataFrame:
    """Adds ``held``, the entries as they were, and ``clean``, with every content string masked."""
    held = rows.withColumn("held", entries(F.col("record"))).drop("record")
    return held.withColumn(
        "clean",
        F.transform_values(
            "held",
            lambda k, v: F.when(
                _is_content(k) & (_kind(v) == "STRING"), pii.scrub(F.try_variant_get(v, "$", "string")).cast("variant")
            ).otherwise(v),
        ),
    )


def changed_texts(held: Column, clean: Column) -> Column:
    """The content strings that scrubbing has changed, ``before`` and ``after``, each joined to one text."""
    pairs = F.arrays_zip(contents(held).alias("before"), contents(clean).alias("after"))
    changed = F.filter(pairs, lambda p: p["before"] != p["after"])
    return F.struct(*[F.array_join(changed[n], "\n").alias(n) for n in ("before", "after")])


def mask_counts(changed: Column) -> dict[str, Column]:
    """Per label, how many masks scrubbing has set in a record; only its ``changed_texts`` are searched."""
    return {x: pii.label_count(changed["after"], x) - pii.label_count(changed["before"], x) for x in pii.LABELS}


def dedup_key(held: Column) -> Column:
    """MD5 of all content values in key order, lower-cased, white space squeezed.

    Numbers count as they are written, true and false by name, a null as ``none``; lists and
    objects by their JSON.
    """

    def printed(value: Column) -> Column:
        return F.coalesce(_text(value), F.when(_kind(value) == "VOID", "none").otherwise(F.to_json(value)))

    pairs = F.filter(F.map_entries(held), lambda e: _is_content(e["key"]))
    texts = F.array_sort(F.transform(pairs, lambda e: F.struct(e["key"].alias("key"), printed(e["value"]).alias("text"))))
    return F.md5(squeeze_space(F.lower(F.array_join(F.transform(texts, lambda e: e["text"]), " "))))


def deduplicate(rows: DataFrame) -> DataFrame:
    """Keep the first record, by row id, of each key; ``copies`` says how many records had it.

    Only keys and ids are aggregated; records move once, by id. A null id fails the job.
    """
    first = (
        rows.groupBy(dedup_key(entries(F.col("record"))).alias("dedup_key"))
        .agg(F.min(required(ROW_ID)).alias(ROW_ID), F.count(F.lit(1)).alias("copies"))
        .drop("dedup_key")
    )
    return rows.join(first, ROW_ID)


def drop_reason(
    texts: Column, min_chars: int = 30, max_chars: int = 8000, min_letters: float = 0.5
) -> Column:
    """Why a record with these content strings fails, cheapest test first; null if it is good."""
    total = F.aggregate(texts, F.lit(0).cast("long"), lambda n, t: n + F.length(t))
    joined = F.array_join(texts, " ")
    ratio = letter_count(joined).cast("double") / F.greatest(F.length(joined), F.lit(1))
    return (
        F.when((F.size(texts) == 0) | F.exists(texts, is_blank), "empty")
        .when(~total.between(min_chars, max_chars), "length")
        .when(ratio < min_letters, "letters")
    )


def format_records(rows: DataFrame) -> DataFrame:
    """instruction, input, output of known domains; both are strings, trimmed and not blank."""
    held = rows.select(ROW_ID, entries(F.col("record")).alias("held"))
    known = held.withColumn("domain", _text(F.try_element_at("held", F.lit("domain")))).join(
        F.broadcast(domain_specs(rows.sparkSession)), "domain"
    )
    texts = known.select(
        ROW_ID,
        "domain",
        "instruction",
        *[_text(F.try_element_at("held", F.col(f"{c}_column"))).alias(c) for c in ("input", "output")],
    )
    return texts.where(~is_blank(F.col("input")) & ~is_blank(F.col("output"))).withColumns(
        {c: trim_space(F.col(c)) for c in ("input", "output")}
    )


def stratum(held: Column) -> Column:
    """The domain with its type, as text: 5 and "5" are different ones, a missing key is "unknown"."""
    domain = F.try_element_at(held, F.lit("domain"))
    return F.when(domain.isNull(), "text:unknown").otherwise(
        F.coalesce(F.concat(F.lit("text:"), _text(domain)), F.concat(F.lit("json:"), F.to_json(domain)))
    )


def own_id(record: Column) -> Column:
    """The record's own row id; null where it has none, and the job fails where it is no whole number."""
    given = F.try_variant_get(record, f"$.{ROW_ID}", "variant")
    wrong = F.raise_error(F.lit(f"{ROW_ID} is no whole number")).cast("long")
    whole = F.when(_kind(given) == "BIGINT", F.try_variant_get(given, "$", "long")).otherwise(wrong)
    return F.when(given.isNotNull(), whole)

