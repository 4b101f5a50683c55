"""Value-level masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake import fixed_values as V

# order matters: long card numbers first, so that the phone rule cannot split them
MASKS = [
    (V.CARD, "[card-redacted]"),
    ("(?i)" + V.CVV, "[cvv-redacted]"),
    (V.NATIONAL_ID, "[ssn-redacted]"),
    (V.EMAIL, "[email-redacted]"),
    (V.PHONE, "[phone-redacted]"),
    ("(?i)" + V.CREDENTIAL_WORD, "[redacted]"),
]


def mask_pii(col: Column) -> Column:
    """Mask cards, card codes, national ids, e-mails, phones and credential words."""
    out = F.coalesce(col, F.lit(""))
    for pat, label in MASKS:
        out = F.regexp_replace(out, "(?U)" + pat, label)
    return out


def luhn_valid(digits: Column) -> Column:
    """Checksum test for a run of digits (optional extra filter, off by default)."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
            ),
        ),
        F.lit(0),
        lambda acc, v: acc + F.coalesce(v, F.lit(0)),
    )
    return digits.rlike(r"^\d+$") & (total % 10 == 0)


def masked_kinds(masked: Column) -> Column:
    """array<string> of the kinds of personal data that ``mask_pii`` replaced in a text."""
    kinds = ["card", "cvv", "ssn", "email", "phone", "credential"]
    labels = [label for _, label in MASKS]
    return F.array_compact(F.array(*[F.when(masked.contains(m), F.lit(k)) for k, m in zip(kinds, labels)]))
