"""Column expressions (X1-X10, D1, V1).  All JVM-side built-ins, no UDFs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """TIMESTAMP_NTZ -> epoch seconds (INT), independent of the session zone."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), _col(ts)).cast("int")


def yearmonth(epoch, zone: str = "UTC") -> Column:
    """Epoch seconds -> yyyyMM as INT in ``zone`` (default UTC).

    Built from ``timestampadd`` on a TIMESTAMP_NTZ so the session time zone
    never enters; a non-UTC zone is applied with ``convert_timezone``.
    """
    local = F.timestamp_add("SECOND", _col(epoch), _epoch_ntz())
    if zone.upper() != "UTC":
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), local)
    return F.date_format(local, "yyyyMM").cast("int")


def round_half_up(x, digits: int) -> Column:
    """Half-up rounding written as floor(x * 10^d + 0.5) / 10^d.

    The same text runs in DuckDB, so oracle values compare exactly (the
    engines' ``round`` functions differ on decimal ties).
    """
    scale = F.lit(float(10 ** digits))
    return F.floor(_col(x) * scale + F.lit(0.5)) / scale


def round6(x) -> Column:
    return round_half_up(x, 6)


def array_norm(v) -> Column:
    """Euclidean norm of an array<float|double> column."""
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def array_dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda acc, x: acc + x)


def cosine(a, b) -> Column:
    """V1: dot / (|a| |b|); NULL when either norm is 0 (never NaN, never raises)."""
    return F.try_divide(array_dot(a, b), array_norm(a) * array_norm(b))


def log10_count(n) -> Column:
    """X6 with the original default: log10 of a count, counting 0 as 1."""
    return F.log10(F.greatest(_col(n), F.lit(1)).cast("double"))


#: Every character up to the blank, which a trim takes off both ends.
TRIMMED = "".join(map(chr, range(33)))


def trim(c) -> Column:
    """Strip blanks, tabs, line breaks and other control characters."""
    return F.btrim(_col(c), F.lit(TRIMMED))


def safe_int(c) -> Column:
    """Trim and cast to INT, NULL on bad input (no ANSI error)."""
    return trim(c).try_cast("int")


def safe_double(c) -> Column:
    return trim(c).try_cast("double")


def split_fields(line, sep: str) -> Column:
    """Split a text line on a literal separator, keeping empty fields."""
    return F.split(_col(line), re.escape(sep), -1)


def field(arr, i: int) -> Column:
    """Element ``i`` (0-based) of an array, NULL when the row is short."""
    return F.get(_col(arr), i)


def genre_text(genres) -> Column:
    """P4 / X5: 'A|B|C' -> 'A B C' for whitespace tokenizers."""
    return F.translate(_col(genres), "|", " ")


def contains_ci(text, needle) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(_col(text)), F.lower(_col(needle)))


def like_flag(score, threshold: float = 3.0) -> Column:
    """1 for a like (score > threshold), else 0."""
    return F.when(_col(score) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
