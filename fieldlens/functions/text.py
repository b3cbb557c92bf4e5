"""Text expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the character whitelist applied to free-text profile fields
# (letters, digits, parentheses, colon, exclamation mark, full stop, space).
WHITELIST_PATTERN = "[^A-Za-z0-9():!. ]"


def whitelist_strip(c: Column, pattern: str = WHITELIST_PATTERN) -> Column:
    """Remove every character outside the whitelist; null stays null."""
    return F.regexp_replace(c, pattern, "")


def contains_ci(c: Column, needle: str) -> Column:
    """Case-folded plain-substring test (null in -> null out)."""
    return F.lower(c).contains(needle.lower())


def not_contains_ci(c: Column, needle: str) -> Column:
    """Negated contains where a missing value counts as *not containing*.

    The spreadsheet logic treats "pattern found in NA" as false, so the
    negation keeps NA rows; plain SQL ``NOT (x LIKE ..)`` would drop them.
    """
    return ~F.coalesce(contains_ci(c, needle), F.lit(False))


def r_paste0(*cols: Column) -> Column:
    """Concatenate with no separator; a missing value is written as ``NA``."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def r_paste(*cols: Column, sep: str = " ") -> Column:
    """Concatenate with a separator; a missing value is written as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def collated(c: Column, collation: str | None) -> Column:
    """Compare / group under a collation, e.g. ``UTF8_LCASE`` for the
    case-insensitive matching of the operational database; ``None`` keeps
    binary comparison (the default)."""
    return F.collate(c, collation) if collation else c
