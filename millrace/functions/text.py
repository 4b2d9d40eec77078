"""Unicode-aware text expressions.

Java's ``\\w``, ``\\d`` and ``\\s`` are ASCII, so the classes are spelled out here.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letter beyond the basic plane is a letter anyway: seeing one in the pattern makes Java
# look behind by code points and not by half surrogate pairs.
WORD = r"\p{L}\p{N}_" + "\U00010428"
DIGIT = r"\p{Nd}"
SPACE = r"\s\x1c-\x1f\x85\p{Z}"

# A word boundary on the Unicode word class.
BOUNDARY = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, numbers and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]+"), F.lit(0))


def trim_space(text: Column) -> Column:
    """Strip every kind of white space from both ends (``F.trim`` strips spaces only).

    The first and the last character tell whether there is any; most texts are not searched.
    """
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(ends.rlike(f"[{SPACE}]"), F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")).otherwise(text)


def squeeze_space(text: Column) -> Column:
    """Turn each white-space run into one space and strip the ends. Single spaces, most runs, stay as they are."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE}&&[^ ]][{SPACE}]*+| [{SPACE}]++", " "))


def is_blank(text: Column) -> Column:
    return ~text.rlike(rf"[^{SPACE}]")


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]++", ""))


def known_domain(domain: Column) -> Column:
    """Null and empty domains become "unknown"."""
    return F.coalesce(F.nullif(domain, F.lit("")), F.lit("unknown"))


def evaluated_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` for a costly value that ``use`` mentions several times.

    A lambda variable holds the value, where plain composition would repeat its expression.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def named_domain(domain: Column) -> Column:
    """The stratum of a row: "unknown" stands for a missing domain, an empty one is its own."""
    return F.coalesce(domain, F.lit("unknown"))
