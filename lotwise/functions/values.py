"""Scalar functions on text and numbers, and row predicates.

Null stays null throughout: text made of a missing value is missing, never the
word for it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -------------------------------------------------------------------


def with_suffix(c: Column | str, suffix: str) -> Column:
    return F.concat(_col(c), F.lit(suffix))


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "[^0-9]", "")


def last_part(c: Column | str, separator: str = "|") -> Column:
    """Text after the last separator; ``'1900|1950|'`` gives ``''``."""
    return F.element_at(F.split(_col(c), f"\\Q{separator}\\E", -1), -1)


def title_case(c: Column | str) -> Column:
    return F.initcap(_col(c))


def to_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def find_all(c: Column | str, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(group))


def first_digits(c: Column | str) -> Column:
    """The first run of digits as a number; null where there is none."""
    return F.regexp_extract(_col(c), "[0-9]+", 0).try_cast("bigint")


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/", -1), -1)


def folder_name(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), "^(.*)/[^/]*$", 1)


def extension(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), r"\.", -1), -1)


def joined_text(separator: str, *columns: Column | str) -> Column:
    return F.concat_ws(separator, *[_col(c) for c in columns])


def count_with_percent(n: Column, total: Column) -> Column:
    """``'12 (3%)'``, percent rounded half to even; empty where both are zero."""
    percent = F.bround(F.try_divide(n.cast("double"), total.cast("double")) * 100)
    text = F.format_string("%d (%d%%)", n, percent.cast("bigint"))
    return replace_value(text, "0 (0%)", "")


def replace_value(c: Column | str, old: str, new: str) -> Column:
    """Replace a cell that is ``old`` as a whole."""
    return F.when(_col(c) == old, F.lit(new)).otherwise(_col(c))


def first_item(c: Column | str) -> Column:
    return F.try_element_at(_col(c), F.lit(1))


def last_item(c: Column | str) -> Column:
    return F.try_element_at(_col(c), F.lit(-1))


# --- numbers ----------------------------------------------------------------


def to_number(c: Column | str) -> Column:
    """Number, or null for junk. Java's ``1d`` / ``1f`` suffixes are junk here."""
    text = _col(c).cast("string")
    value = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def to_number_strict(c: Column | str) -> Column:
    """Number; junk fails the job (ANSI cast)."""
    return _col(c).cast("double")


def to_integer_strict(c: Column | str) -> Column:
    return _col(c).cast("bigint")


def id_text(c: Column | str) -> Column:
    """A numeric id as canonical text: ``'007'`` is ``'7'``, junk is null."""
    text = F.trim(_col(c).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint").cast("string"))
    return F.coalesce(whole, to_number(text).cast("string"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; null where the denominator is zero (not infinity, not an error)."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def fallback(*columns: Column | str) -> Column:
    return F.coalesce(*[_col(c) for c in columns])


def value_where(condition: Column, value, otherwise: Column | str) -> Column:
    """``value`` on rows that meet the condition, the old value elsewhere."""
    return F.when(condition, F.lit(value)).otherwise(_col(otherwise))


# --- housing type -----------------------------------------------------------

# Land-use class prefixes, the lot-size limit in acres, type codes.
SINGLE_FAMILY_PREFIXES = ("51", "501", "502", "503", "504", "505")
ATTACHED_PREFIXES = ("52", "53", "54", "55")
MULTI_FAMILY_PREFIXES = ("401", "402", "403")
LARGE_LOT_ACRES = 0.75
LARGE_LOT, SMALL_LOT, ATTACHED, MULTI_FAMILY = "SF-LL", "SF-SL", "SF-A", "MF"


def housing_type(acres: Column | str, land_use: Column | str) -> Column:
    """Housing type of a parcel; null for other classes and for unknown lot size."""
    size = to_number_strict(acres)
    single = has_prefix(land_use, SINGLE_FAMILY_PREFIXES)
    return (
        F.when(single & (size > LARGE_LOT_ACRES), LARGE_LOT)
        .when(single & (size <= LARGE_LOT_ACRES), SMALL_LOT)
        .when(has_prefix(land_use, ATTACHED_PREFIXES), ATTACHED)
        .when(has_prefix(land_use, MULTI_FAMILY_PREFIXES), MULTI_FAMILY)
    )


# --- predicates -------------------------------------------------------------


def has_prefix(c: Column | str, prefixes: tuple[str, ...]) -> Column:
    """True if the text starts with any prefix; false, not null, for missing text."""
    text = _col(c).cast("string")
    return F.coalesce(reduce(or_, [text.startswith(p) for p in prefixes]), F.lit(False))


def differs(c: Column | str, value) -> Column:
    """Inequality that keeps missing values."""
    return ~_col(c).eqNullSafe(F.lit(value))
