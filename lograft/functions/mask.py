"""Masking personal data in log text (M1-M4).

Three rewrites, applied in this order, no word boundaries (digits next to a
match stay): SSN, card number, email. Plain `regexp_replace`, so masking
stays in generated code and runs wherever the text is, batch or stream.
Masking twice is not the same as masking once (`a@b.co1x@c.de`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and replacements of the scrubbing step.
SSN_PATTERN = r"[0-9]{3}-+[0-9]{2}-+[0-9]{4}"
SSN_MASK = "xxx-xx-xxxx"
CARD_PATTERN = r"[0-9]{4} *[0-9]{4} *[0-9]{4} *[0-9]{4}"
CARD_MASK = "xxxx xxxx xxxx xxxx"
EMAIL_PATTERN = r"[A-Za-z0-9+.\-_]+@[A-Za-z0-9+.\-_]+\.[A-Za-z]{2,}"
EMAIL_MASK = "user@email.tld"
# End of fixed values.

RULES = [(SSN_PATTERN, SSN_MASK), (CARD_PATTERN, CARD_MASK), (EMAIL_PATTERN, EMAIL_MASK)]


def mask_text(c) -> Column:
    """M4 on one column: NULL stays NULL."""
    col = F.col(c) if isinstance(c, str) else c
    for pattern, repl in RULES:
        col = F.regexp_replace(col, F.lit(pattern), F.lit(repl))
    return col


def mask_columns(df: DataFrame, columns=("log",)) -> DataFrame:
    """Mask each named column in place. Mask before any copy of the text is
    made (e.g. before merging parsed JSON of `log`), or the copy stays clear."""
    return df.withColumns({c: mask_text(c) for c in columns})
