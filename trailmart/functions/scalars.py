"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(col: Column | str) -> Column:
    """Epoch milliseconds to timestamp, also from text like ``1433221332117.0``; no number becomes null."""
    return F.timestamp_millis(safe_long(col))


def first_number(col: Column | str) -> Column:
    """First signed decimal number found in a text, null when there is none."""
    text = F.regexp_extract(_col(col).cast("string"), r"-?\d+\.?\d*", 0)
    return F.nullif(text, F.lit("")).try_cast("double")


def safe_long(col: Column | str, default: int | None = None) -> Column:
    """Whole number from text or any number type; what is not whole or unparsable is null or ``default``.

    ``257597.0`` is 257597. ``257597.5`` and ``1e3`` are no ids: cut or read as numbers they would be other items. Large
    numbers as a double column spells them (``1.5E12``) are read if they are whole.
    """
    text = F.trim(_col(col).cast("string"))
    plain = F.nullif(F.regexp_extract(text, r"^([+-]?\d+)(?:\.0*)?$", 1), F.lit("")).try_cast("bigint")
    number = F.when(text.rlike(r"^-?\d\.\d+E\d+$"), text).try_cast("double")
    value = F.coalesce(plain, F.when(number == F.floor(number), number.try_cast("bigint")))
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom``, null where the denominator is zero."""
    return _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))


def rounded(col: Column | str, digits: int = 2) -> Column:
    """Half to even on the scaled value, as NumPy rounds; plain double arithmetic."""
    scale = F.lit(float(10**digits))
    return F.rint(_col(col) * scale) / scale


def time_block(col: Column | str, seconds: int) -> Column:
    """Start of the fixed-width time block a timestamp falls in, as epoch microseconds."""
    micros = F.unix_micros(_col(col))
    return micros - F.pmod(micros, F.lit(seconds * 1_000_000).cast("bigint"))


def bin_by_edges(value: Column, edges: list[float]) -> Column:
    """Number of edges at or below ``value``, minus one (left-closed bins)."""
    return _edges_counted(edges, lambda e: value >= F.lit(float(e)))


def bin_right_closed(value: Column, edges: list[float]) -> Column:
    """Right-closed bins over distinct edges; the lowest edge belongs to bin 0."""
    distinct = sorted(set(edges))
    below = _edges_counted(distinct, lambda e: value > F.lit(float(e)))
    return F.when(value.isNotNull(), F.greatest(below, F.lit(0)))


def _edges_counted(edges, test):
    total = F.lit(0)
    for edge in edges:
        total = total + F.when(test(edge), 1).otherwise(0)
    return total - 1


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
