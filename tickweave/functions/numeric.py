"""Casts, bins and number-like text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: text that counts as a number. No plus sign, no exponent.
NUMBER_TEXT = r"^-?\d+(\.\d+)?$"
WHOLE_NUMBER_TEXT = r"^-?\d+$"

INF = float("inf")


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(INF))


def single(c: Column) -> Column:
    """Value as stored in single precision, computed on in double."""
    return c.cast("float").cast("double")


def bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of ``v`` in [lo, hi]: the last one whose lower :func:`bin_edge` is not above ``v``.

    Rounding can put the quotient one bin beside the edges, so it is corrected by them. The top edge belongs to the last
    bin, as does everything if lo = hi.
    """
    last = F.lit(bins - 1)
    raw = F.floor((v - lo) / F.nullif(hi - lo, F.lit(0.0)) * F.lit(bins))
    raw = F.greatest(F.least(raw, last), F.lit(0))
    down = F.when(v < bin_edge(lo, hi, raw, bins), F.lit(1)).otherwise(F.lit(0))
    up = F.when((raw < last) & (v >= bin_edge(lo, hi, raw + 1, bins)), F.lit(1)).otherwise(F.lit(0))
    return F.when(lo == hi, last).otherwise(raw - down + up).cast("int")


def bin_edge(lo: Column, hi: Column, i: Column, bins: int) -> Column:
    """Lower edge of bin ``i``; edge ``bins`` is ``hi`` itself."""
    return F.when(i == F.lit(bins), hi).otherwise(lo + i * ((hi - lo) / F.lit(bins)))


def stripped(c: Column) -> Column:
    """Text without white space around it."""
    return F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))


def number_from_text(c: Column, whole: bool) -> Column:
    return stripped(c).try_cast("bigint" if whole else "double")
