"""Scalar column helpers (text cleaning, typing, fingerprints, grid cells).

Every helper returns a native ``Column`` expression, so it runs inside
whole-stage code generation: no Python worker is involved.  All helpers are
null-tolerant and never raise under ANSI mode (``try_*`` casts), so a bad value
becomes NULL instead of failing the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonescope.constants import MISSING_TOKENS, TRUTHY_VALUES

ColumnLike = Column | str

ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
FRENCH_DATE_PATTERN = r"^\d{2}/\d{2}/\d{4}\z"


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnLike) -> Column:
    return _col(c).cast("string")


def empty_to_null(c: ColumnLike) -> Column:
    """Text with the empty string mapped to NULL."""
    return F.nullif(as_text(c), F.lit(""))


def clean_numeric(c: ColumnLike) -> Column:
    """Tolerant number parse (F1).

    Keeps only digits, ``,``, ``.`` and ``-``; turns the decimal comma into a
    point; empty -> NULL; anything that is still not a number -> NULL.
    ``"1 234,50 EUR"`` -> 1234.5.  Feed it text only: a double rendered as text
    may be in scientific notation.
    """
    kept = F.regexp_replace(F.coalesce(as_text(c), F.lit("")), r"[^0-9,.\-]", "")
    pointed = F.translate(kept, ",", ".")
    return F.nullif(pointed, F.lit("")).try_cast("double")


def parse_date(c: ColumnLike) -> Column:
    """Two-layout date parse (F2): ``YYYY-MM-DD`` or ``DD/MM/YYYY``, else NULL.

    The patterns are anchored with ``\\z`` so a trailing newline does not match,
    and impossible dates (``2024-02-31``) become NULL.
    """
    text = as_text(c)
    return F.when(text.rlike(ISO_DATE_PATTERN), F.try_to_date(text, "yyyy-MM-dd")).when(
        text.rlike(FRENCH_DATE_PATTERN), F.try_to_date(text, "dd/MM/yyyy")
    )


def strip_zero_fraction(c: ColumnLike) -> Column:
    """``"3.0"`` -> ``"3"`` (an integer written as a float); other text unchanged."""
    return F.regexp_replace(as_text(c), r"^([+-]?\d+)\.0*\z", "$1")


def truthy_flag(c: ColumnLike) -> Column:
    """0/1 integer flag (F3): a case-insensitive truthy word -> 1, else 0
    (``1.0`` counts as ``1``)."""
    lowered = F.lower(strip_zero_fraction(F.coalesce(as_text(c), F.lit(""))))
    return F.when(lowered.isin(*TRUTHY_VALUES), F.lit(1)).otherwise(F.lit(0))


def to_int(c: ColumnLike) -> Column:
    """Text -> integer (F8): ``3`` and ``3.0`` -> 3; ``3.5`` or ``abc`` -> NULL."""
    return F.nullif(strip_zero_fraction(c), F.lit("")).try_cast("int")


def missing_to_null(c: ColumnLike) -> Column:
    """A cell holding a missing-value marker (``NA``, ``null``, ...) -> NULL."""
    text = as_text(c)
    return F.when(~text.isin(*MISSING_TOKENS), text)


def to_double(c: ColumnLike) -> Column:
    """Text -> double (F9, F23); bad values -> NULL."""
    return empty_to_null(c).try_cast("double")


def to_date(c: ColumnLike) -> Column:
    """Text -> date (F10); bad values -> NULL."""
    return empty_to_null(c).try_cast("date")


def fingerprint(*cols: ColumnLike) -> Column:
    """Row id (F5, F6): md5 of the fields as text, NULL as empty, joined by ``||``."""
    parts = [F.coalesce(as_text(c), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("||", *parts))


def price_per_m2(value: ColumnLike, surface: ColumnLike) -> Column:
    """value / surface when surface > 0, else NULL."""
    s = _col(surface)
    return F.when(s > 0, _col(value) / s)


def month_start(d: ColumnLike) -> Column:
    """First day of the month as a date."""
    return F.trunc(_col(d), "month")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / nullif(denominator, 0)."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def grid_cell(lat: ColumnLike, lon: ColumnLike, level: int) -> Column:
    """Fixed-degree grid cell id at ``level`` (U1 re-aimed).

    Latitude is cut into 2**(level+6) bands over 180°, longitude into
    2**(level+7) over 360°, so a level-9 cell is a quarter of a level-8 cell.
    NULL when a coordinate is missing or out of range.  Only linear
    arithmetic is used, so every engine computes the same id.
    """
    la = _col(lat).cast("double")
    lo = _col(lon).cast("double")
    rows = float(2 ** (level + 6))
    cols = float(2 ** (level + 7))
    row = F.floor((la + F.lit(90.0)) / F.lit(180.0) * F.lit(rows))
    col = F.floor((lo + F.lit(180.0)) / F.lit(360.0) * F.lit(cols))
    valid = la.between(-90.0, 90.0) & lo.between(-180.0, 180.0)
    return F.when(valid, F.concat(F.lit(f"g{level}:"), row.cast("string"), F.lit(":"), col.cast("string")))


def weighted_sum(terms: Iterable[tuple[Column, float]]) -> Column:
    """Left-to-right sum of weight * term, in the given order."""
    total = None
    for term, weight in terms:
        part = F.lit(weight) * term
        total = part if total is None else total + part
    return total


def round_half_up(c: ColumnLike, digits: int) -> Column:
    """Round to ``digits`` decimals, half-up, through a wider decimal first.

    Rounding in two steps (to digits+4, then to digits) removes binary noise
    so that exact ties round the same way in every engine.  A value that is
    clearly not near a tie needs no decimal: its nearest whole multiple is the
    same, and that multiple divided by the power of ten the same double.
    """
    value, scale = _col(c).cast("double"), float(10**digits)
    wide = _col(c).try_cast(f"decimal(28,{digits + 4})")
    scaled = value * F.lit(scale)
    clear = (F.abs(scaled) < F.lit(float(2**38))) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > F.lit(0.001))
    return F.when(clear, F.floor(scaled + F.lit(0.5)) / F.lit(scale)).otherwise(F.round(wide, digits).cast("double"))


def normalize_column_name(name: str) -> str:
    """Snake-case a header (P1): runs of characters other than ASCII letters
    and digits become one ``_``; leading/trailing ``_`` are dropped."""
    return "_".join(re.findall(r"[a-z0-9]+", name.strip().lower()))


def normalize_column_names(names: Iterable[str]) -> list[str]:
    """Normalise a header; raise when two names collide."""
    names = list(names)
    out = [normalize_column_name(n) for n in names]
    seen: dict[str, str] = {}
    for original, new in zip(names, out):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {original!r} both normalise to {new!r}")
        seen[new] = original
    return out
