"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
# Header clean-up, applied in this order: space -> "_", "." removed,
# "/" -> "_", "(" removed, ")" removed.  Nothing else changes.
HEADER_REPLACEMENTS = [(" ", "_"), (".", ""), ("/", "_"), ("(", ""), (")", "")]
# Entity colours of the relationship diagram: name ending DIM, ending DFACT, other.
ENTITY_COLOR_DIM = "#d0e0d0"
ENTITY_COLOR_DFACT = "#ececfc"
ENTITY_COLOR_OTHER = "#fcecec"
# Snapshot name prefix and date format.
BACKUP_PREFIX = "zBACKUP_"
BACKUP_DATE_FORMAT = "MM_dd_yyyy"
# Web Mercator (EPSG:3857) sphere radius in metres.
WEB_MERCATOR_RADIUS = 6378137.0


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- P1 ----------------------------------------------------------------------
def normalize_header(name: str) -> str:
    """Header name clean-up done on the driver over the (small) header list."""
    for old, new in HEADER_REPLACEMENTS:
        name = name.replace(old, new)
    return name


def normalize_header_col(c: Column | str) -> Column:
    """The same rule as an expression: ' ' and '/' become '_', '.', '(' and ')' go."""
    return F.translate(col_(c), " /.()", "__")


# -- T1 ----------------------------------------------------------------------
def decimal_scale(c: Column | str) -> Column:
    """Characters after the first '.'; 0 without one; NULL stays NULL."""
    c = col_(c)
    pos = F.instr(c, ".")
    return F.when(c.isNull(), F.lit(None).cast("int")).when(pos == 0, F.lit(0)).otherwise(
        F.length(c) - pos)


# -- T2 / T5 -----------------------------------------------------------------
def strip_thousands(c: Column | str) -> Column:
    return F.replace(col_(c), F.lit(","), F.lit(""))


# A superset of the texts a decimal cast accepts (optional blanks, sign,
# digits and one point, optional exponent).  Texts outside it cannot parse,
# so they skip the parser, whose failures are costly exceptions.
NUMBER_SHAPE = r"^[\x00-\x20]*[+-]?[\p{Nd}.]+([eE][+-]?\p{Nd}+)?[\x00-\x20]*$"


def try_number(c: Column | str, scale: int = 0) -> Column:
    """Tolerant number parse after removing ',' (NULL when it does not parse)."""
    text = strip_thousands(c)
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast(DecimalType(38, scale)))


def to_number(c: Column | str, scale: int = 0) -> Column:
    """Strict number parse (ANSI cast: a bad value fails the job)."""
    return strip_thousands(c).cast(DecimalType(38, scale))


# -- T9 / T25 ----------------------------------------------------------------
def file_base_name(c: Column | str) -> Column:
    """Text after the last '/' (after turning '\\' into '/')."""
    return F.substring_index(F.replace(col_(c), F.lit("\\"), F.lit("/")), "/", -1)


def strip_spaces(c: Column | str) -> Column:
    return F.replace(col_(c), F.lit(" "), F.lit(""))


# -- T10 ---------------------------------------------------------------------
def entity_class(c: Column | str) -> Column:
    c = col_(c)
    return (F.when(c.endswith("DIM"), F.lit(ENTITY_COLOR_DIM))
            .when(c.endswith("DFACT"), F.lit(ENTITY_COLOR_DFACT))
            .otherwise(F.lit(ENTITY_COLOR_OTHER)))


# -- T13 ---------------------------------------------------------------------
def backup_name(db: Column | str, day: Column | str) -> Column:
    return F.concat(F.lit(BACKUP_PREFIX), col_(db), F.lit("_"),
                    F.date_format(col_(day), BACKUP_DATE_FORMAT))


# -- T14 ---------------------------------------------------------------------
def mercator_x(lon: Column | str) -> Column:
    return F.lit(WEB_MERCATOR_RADIUS) * F.radians(col_(lon))


def mercator_y(lat: Column | str) -> Column:
    return F.lit(WEB_MERCATOR_RADIUS) * F.log(
        F.tan(F.lit(math.pi / 4) + F.radians(col_(lat)) / 2))


# -- A11 ---------------------------------------------------------------------
def chunk_count(n_rows: Column | str, batch: int) -> Column:
    """ceil(count / batch)."""
    return F.ceil(col_(n_rows) / F.lit(batch)).cast("long")
