"""JSON found inside model prose, read as VARIANT."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def bracketed(text: Column) -> Column:
    """From the first ``[`` to the last ``]``; empty if there is none."""
    return F.regexp_extract(text, r"(?s)\[.*\]", 0)


def braced(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; empty if there is none."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def strict_json(text: Column) -> Column:
    """The text as VARIANT if it is exactly one JSON value, else null.

    ``try_parse_json`` alone ignores whatever follows the first value. Wrapped in an object
    and in a list, trailing text either breaks the JSON or makes the list longer.
    """
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    in_list = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    lonely = (
        F.try_variant_get(in_list, "$[0]", "variant").isNotNull()
        & F.try_variant_get(in_list, "$[1]", "variant").isNull()
    )
    return F.when(in_object.isNotNull() & lonely, F.try_variant_get(in_list, "$[0]", "variant"))


def kind(value: Column, path: str = "$") -> Column:
    """Type name at a path: VOID for a JSON null, SQL null for a missing path."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def string_at(value: Column, path: str) -> Column:
    """The string at a path; null for any other type."""
    return F.when(kind(value, path) == "STRING", F.try_variant_get(value, path, "string"))


def number_at(value: Column, path: str) -> Column:
    """The number at a path as double; true and false count as 1 and 0, strings do not count."""
    numeric = kind(value, path).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    return F.when(numeric, F.try_variant_get(value, path, "double"))
