"""Timestamp masks for type inference (T3) and the two-digit-year pivot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
# Candidate masks, tried in this order; the first with zero failures wins.
TIMESTAMP_INPUT_FORMATS = [
    "DD-MON-YY",
    "Mon DD, YYYY HH:MI:SS AM",
    "DD-MON-YY HH12.MI.SS.FF9 AM",
    "YYYY-",
    "MM/DD/YYYY HH12:MI AM",
    "AUTO",
]
# The same masks as Spark datetime patterns (None = automatic ISO parse).
SPARK_PATTERNS = {
    "DD-MON-YY": "dd-MMM-yy",
    "Mon DD, YYYY HH:MI:SS AM": "MMM dd, yyyy hh:mm:ss a",
    "DD-MON-YY HH12.MI.SS.FF9 AM": "dd-MMM-yy hh.mm.ss.SSSSSSSSS a",
    "YYYY-": "yyyy-",
    "MM/DD/YYYY HH12:MI AM": "MM/dd/yyyy hh:mm a",
    "AUTO": None,
}
NOT_A_DATE = "NOT_A_DATE"
# Shapes that a text must have for the mask to possibly parse it (each a
# superset of what the parser accepts: blanks allowed at both ends, widths
# relaxed).  A text outside the shape is a failure without calling the
# parser, whose failures are costly exceptions.
_D = r"\p{Nd}"
MASK_SHAPES = {
    "DD-MON-YY": rf"^\s*{_D}{{1,2}}-\p{{L}}{{3,9}}-{_D}{{2,}}\s*$",
    "Mon DD, YYYY HH:MI:SS AM":
        rf"^\s*\p{{L}}{{3,9}} {_D}{{1,2}}, {_D}{{4,}} {_D}{{1,2}}:{_D}{{1,2}}:{_D}{{1,2}} "
        rf"\p{{L}}{{2}}\s*$",
    "DD-MON-YY HH12.MI.SS.FF9 AM":
        rf"^\s*{_D}{{1,2}}-\p{{L}}{{3,9}}-{_D}{{2,}} {_D}{{1,2}}\.{_D}{{1,2}}\.{_D}{{1,2}}"
        rf"\.{_D}{{1,9}} \p{{L}}{{2}}\s*$",
    "YYYY-": rf"^\s*{_D}{{4,}}-\s*$",
    "MM/DD/YYYY HH12:MI AM":
        rf"^\s*{_D}{{1,2}}/{_D}{{1,2}}/{_D}{{4,}} {_D}{{1,2}}:{_D}{{1,2}} \p{{L}}{{2}}\s*$",
    "AUTO": rf"^[\x00-\x20]*([+-]?{_D}|T)",
}
# Two-digit years 80-99 mean 19xx, 00-79 mean 20xx.
TWO_DIGIT_CENTURY_START = 1980


def _two_digit_year(mask: str) -> bool:
    return "YY" in mask and "YYYY" not in mask


def century_fix(ts: Column, mask: str) -> Column:
    """Spark's ``yy`` always gives 20xx; move 20(80..99) back a century."""
    if not _two_digit_year(mask):
        return ts
    hi = TWO_DIGIT_CENTURY_START + 100
    return F.when(F.year(ts) >= hi, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)


def parses_as_timestamp(c: Column | str, mask: str) -> Column:
    """Whether a text parses with one candidate mask (NULL for NULL text).

    Only the outcome is used, so the tolerant parser may go through the
    session time zone; no exception is raised for a text that fails."""
    c = col_(c)
    pattern = SPARK_PATTERNS[mask]
    parsed = (c.try_cast("timestamp_ntz") if pattern is None
              else F.try_to_timestamp(c, F.lit(pattern)))
    return F.when(c.isNotNull(), c.rlike(MASK_SHAPES[mask]) & parsed.isNotNull())


def try_timestamp(c: Column | str, mask: str) -> Column:
    """Tolerant parse with one mask: the exact local date-time (two-digit
    years pivoted), NULL when the text does not fit.  The strict parser
    runs only where the tolerant test passed, so it never fails."""
    return F.when(F.coalesce(parses_as_timestamp(c, mask), F.lit(False)), to_timestamp(c, mask))


def to_timestamp(c: Column | str, mask: str) -> Column:
    """Strict parse with the chosen mask (a bad value fails the job)."""
    c = col_(c)
    pattern = SPARK_PATTERNS[mask]
    parsed = c.cast("timestamp_ntz") if pattern is None else F.to_timestamp_ntz(c, F.lit(pattern))
    return century_fix(parsed, mask)


def first_zero_mask(failure_counts: list[Column]) -> Column:
    """Given per-mask failure counts (same order as the mask list), the first
    mask with no failure, else NOT_A_DATE."""
    out = F.lit(NOT_A_DATE)
    for mask, cnt in reversed(list(zip(TIMESTAMP_INPUT_FORMATS, failure_counts))):
        out = F.when(cnt == 0, F.lit(mask)).otherwise(out)
    return out
