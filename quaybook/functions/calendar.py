"""Month-name and reference-year date expressions (pure integer arithmetic)."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaybook.config import DAYS_IN_MONTH, MONTH_NAMES, REFERENCE_YEAR

# Day-of-year of the day before the 1st of each month (0 for January).
_DAYS_BEFORE = (0,) + tuple(accumulate(DAYS_IN_MONTH))[:-1]


def _sql(v) -> str:
    return "'" + v + "'" if isinstance(v, str) else str(v)


def _lookup(key: Column, pairs) -> Column:
    """Lookup in a literal map; NULL for keys not in it (and for NULL)."""
    entries = ", ".join(f"{_sql(k)}, {_sql(v)}" for k, v in pairs)
    return F.try_element_at(F.expr(f"map({entries})"), key)


def month_number(month_name: Column) -> Column:
    """Exact (title case) month name -> 1..12, else NULL."""
    return _lookup(month_name, ((m, i) for i, m in enumerate(MONTH_NAMES, 1)))


def month_number_loose(month_name: Column) -> Column:
    """Month name in any case and padding -> 1..12, else NULL."""
    key = F.lower(F.regexp_replace(month_name, r"^\s+|\s+$", ""))
    return _lookup(key, ((m.lower(), i) for i, m in enumerate(MONTH_NAMES, 1)))


def days_in_month(month_num: Column) -> Column:
    """Days in the month of the reference year; NULL for a NULL month."""
    return _lookup(month_num, ((i, d) for i, d in enumerate(DAYS_IN_MONTH, 1)))


def day_of_reference_year(month_num: Column, day: Column) -> Column:
    """1-based day of the reference year, NULL when the day does not exist."""
    days_before = _lookup(month_num, ((i, b) for i, b in enumerate(_DAYS_BEFORE, 1)))
    valid = (day >= 1) & (day <= days_in_month(month_num))
    return F.when(valid, days_before + day)


def reference_date(month_name: Column, day: Column) -> Column:
    """(month name, day) -> date in the reference year; NULL for a bad month
    or a day the month does not have. Integer arithmetic, so no ANSI error."""
    doy = day_of_reference_year(month_number(month_name), day)
    return F.date_add(F.lit(f"{REFERENCE_YEAR}-01-01").cast("date"),
                      (doy - 1).cast("int"))
