"""PII redaction as JVM regex expressions (F1, F2).

ID numbers are replaced before phone numbers: a mobile-number match inside an
18-digit ID would otherwise split the ID and leave part of it readable. The
phone pattern has no word boundary, so it also fires inside longer digit runs.
Java's ``\\d`` is ASCII-only, so full-width digits are left untouched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ID_CARD_PATTERN, ID_REPLACEMENT, PHONE_PATTERN, PHONE_REPLACEMENT


def redact_id_numbers(col: Column) -> Column:
    return F.regexp_replace(col, ID_CARD_PATTERN, ID_REPLACEMENT)


def redact_phone_numbers(col: Column) -> Column:
    return F.regexp_replace(col, PHONE_PATTERN, PHONE_REPLACEMENT)


def redact_pii(col: Column) -> Column:
    """ID numbers first, then phone numbers."""
    return redact_phone_numbers(redact_id_numbers(col))
