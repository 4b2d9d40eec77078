import pytest

from millrace.functions import pii
from millrace.operators.scrub import mask_counts, scrub_records

CASES = [
    ("ask m.weaver+loom@mill.example, please", "ask [EMAIL], please"),
    ("file no. 901-22-3344 closed", "file no. [SSN] closed"),
    ("ring 212-867-5309 at noon", "ring [PHONE] at noon"),
    ("ping 10.0.7.254 twice", "ping [IP_ADDRESS] twice"),
    ("billed to 5500 0000 0000 0004 in May", "billed to [CREDIT_CARD] in May"),
    ("(5500-0000-0000-0004)", "([CREDIT_CARD])"),
    ("lots 2210 2211 2212 2213", "lots 2210 2211 2212 2213"),
    # octets are not range-checked
    ("999.999.999.999", "[IP_ADDRESS]"),
    # a letter right before the number, Unicode included, keeps it
    ("é555-123-4567", "é555-123-4567"),
    ("x+1 555-123-4567", "x+[PHONE]"),
    ("+1 (555) 123-4567", "[PHONE]"),
    ("555 123 4567", "[PHONE]"),
    ("4111 1111 1111 1111, 5500 0000 0000 0004", "[CREDIT_CARD], [CREDIT_CARD]"),
    ("4111111111111111 then 4111111111111112", "[CREDIT_CARD] then 4111111111111112"),
    ("mail élan@exämple.de!", "mail [EMAIL]!"),
    ("a@b.c-", "[EMAIL]-"),
    ("a@b", "a@b"),
    ("..x@y.z", "..[EMAIL]"),
    # the digits inside a masked address are gone before phones are looked for
    ("5551234567@example.com", "[EMAIL]"),
    # Arabic-Indic digits count as digits, in the Luhn check too
    ("٤١١١ ١١١١ ١١١١ ١١١١", "[CREDIT_CARD]"),
    ("123-45-67890", "123-45-67890"),
    # letters and digits beyond the basic plane are word characters, emoji are not
    ("𐐷4111 1111 1111 1111", "𐐷4111 1111 1111 1111"),
    ("𝟗123-45-6789", "𝟗123-45-6789"),
    ("😀555-123-4567", "😀[PHONE]"),
    ("", ""),
    ("plain text", "plain text"),
]


def test_scrub_golden_rows(evaluate):
    assert evaluate(pii.scrub, *[c[0] for c in CASES]) == [c[1] for c in CASES]


@pytest.mark.parametrize("number, valid", [("6011 0009 9013 9424", True), ("2210 2211 2212 2213", False)])
def test_luhn(evaluate, number, valid):
    assert evaluate(pii.luhn_valid, number) is valid


def test_record_keeps_meta_columns_and_numbers(spark):
    df = spark.createDataFrame(
        [(1, "a@b.com", "c@d.com", "mail me at a@b.com", 5)],
        "row_id bigint, domain string, source string, text string, n int",
    )
    row = scrub_records(df).first()
    assert (row.domain, row.source, row.text, row.n) == ("a@b.com", "c@d.com", "mail me at [EMAIL]", 5)


def test_mask_counts(spark):
    df = spark.createDataFrame(
        [(1, "legal", "a@b.com and c@d.org [EMAIL]", None), (2, "legal", "192.168.1.1", "123-45-6789")],
        "row_id bigint, domain string, text string, summary string",
    )
    counts = {r.label: r.masked for r in mask_counts(df).collect()}
    assert counts == {"EMAIL": 2, "SSN": 1, "CREDIT_CARD": 0, "PHONE": 0, "IP_ADDRESS": 1}
