"""Text normalisation and strict parsing of raw text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character counted as white space when keys are trimmed.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def trimmed(c: Column) -> Column:
    """Spark's plain trim() strips U+0020 only; this strips all white space.

    Text that starts and ends with a printable ASCII character, nearly all of
    it, skips the slower character-set trim.
    """
    plain = F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)
    return F.when(plain, c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def clean_text(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def iso_date(text: Column) -> Column:
    """Full ISO dates only: a bare cast would also take '2024' or '2024-03'."""
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def parse_date(c: Column) -> Column:
    return iso_date(trimmed(c))


def parse_number(c: Column) -> Column:
    return trimmed(c).try_cast("decimal(38,9)")
