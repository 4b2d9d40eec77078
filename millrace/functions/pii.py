"""Masking of e-mails, SSNs, card numbers, phone numbers and IP addresses."""

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import BOUNDARY, DIGIT, SPACE, WORD, evaluated_once

# Labels and match patterns, applied in this order. Each sees the text the
# previous one left behind. The patterns use the Unicode classes of ``text``. A match that
# starts with a digit tests for that digit first and looks behind it afterwards, since most
# positions fail on the digit.
FIRST_DIGIT = rf"{DIGIT}(?<![{WORD}]{DIGIT})"
LAST = rf"(?![{WORD}])"
EMAIL = rf"{BOUNDARY}[{WORD}.+-]++@[{WORD}-]+\.[{WORD}.-]+{BOUNDARY}"
SSN = rf"{FIRST_DIGIT}{DIGIT}{{2}}-{DIGIT}{{2}}-{DIGIT}{{4}}{LAST}"
CREDIT_CARD = rf"{FIRST_DIGIT}(?:[ -]?{DIGIT}){{12,15}}{LAST}"
PHONE = (
    rf"(?=[+({DIGIT}])(?<![{WORD}])(?:\+?{DIGIT}{{1,3}}[{SPACE}.-]?)?"
    rf"(?:\({DIGIT}{{3}}\)|{DIGIT}{{3}})[{SPACE}.-]?{DIGIT}{{3}}[{SPACE}.-]?{DIGIT}{{4}}{LAST}"
)
IP_ADDRESS = rf"{FIRST_DIGIT}{DIGIT}{{0,2}}\.(?:{DIGIT}{{1,3}}\.){{2}}{DIGIT}{{1,3}}{LAST}"

LABELS = ("EMAIL", "SSN", "CREDIT_CARD", "PHONE", "IP_ADDRESS")


def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit beside its ASCII value."""
    found = [
        chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"
    ]
    return "".join(found), "".join(str(unicodedata.decimal(c)) for c in found)


_WIDE_DIGITS, _ASCII_DIGITS = _decimal_digits()


def _masked(text: Column, label: str, pattern: str, hint: Column) -> Column:
    """Replace where ``hint``, a cheap necessary condition, holds."""
    return F.when(hint, F.regexp_replace(text, pattern, f"[{label}]")).otherwise(text)


def has_digit(text: Column) -> Column:
    return text.rlike(DIGIT)


def mask_email(text: Column) -> Column:
    return _masked(text, "EMAIL", EMAIL, F.contains(text, F.lit("@")))


def mask_ssn(text: Column) -> Column:
    return F.regexp_replace(text, SSN, "[SSN]")


def luhn_valid(number: Column) -> Column:
    """Luhn check of the digits in ``number``; separators are ignored."""
    digits = F.translate(number, _WIDE_DIGITS, _ASCII_DIGITS)
    return F.call_function("luhn_check", F.regexp_replace(digits, "[^0-9]", ""))


def mask_card(text: Column) -> Column:
    """Mask each card-like number that passes the Luhn check, leave the others alone.

    The text is cut at the matches; masked matches and gaps are put back alternately.
    """

    def masked(t: Column) -> Column:
        gaps = F.split(t, CREDIT_CARD, -1)
        found = F.regexp_extract_all(t, F.lit(CREDIT_CARD), F.lit(0))
        shown = F.transform(
            found, lambda m: F.when(luhn_valid(m), F.lit("[CREDIT_CARD]")).otherwise(m)
        )
        pieces = F.transform(
            F.arrays_zip(gaps.alias("gap"), shown.alias("hit")),
            lambda p: F.concat(p["gap"], F.coalesce(p["hit"], F.lit(""))),
        )
        return F.when(t.rlike(CREDIT_CARD), F.array_join(pieces, "")).otherwise(t)

    return evaluated_once(text, masked)


def mask_phone(text: Column) -> Column:
    return F.regexp_replace(text, PHONE, "[PHONE]")


def mask_ip(text: Column) -> Column:
    return F.regexp_replace(text, IP_ADDRESS, "[IP_ADDRESS]")


def scrub(text: Column) -> Column:
    """All five masks in their fixed order. Text without a digit skips the numeric four."""

    def numbers(t: Column) -> Column:
        return F.when(has_digit(t), mask_ip(mask_phone(mask_card(mask_ssn(t))))).otherwise(t)

    return evaluated_once(mask_email(text), numbers)


def label_count(text: Column, label: str) -> Column:
    """Occurrences of the mask ``[label]`` in the text."""
    mark = f"[{label}]"
    without = F.replace(text, F.lit(mark), F.lit(""))
    return ((F.length(text) - F.length(without)) / F.lit(len(mark))).cast("long")
