"""Column expressions: tolerant casts, date parts, names, delivery tiers.

The parsing helpers answer NULL for a bad value and leave ANSI mode on, so a later null filter
drops the row and the job goes on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (largest distance in km, charge); beyond the last tier the order is collected.
DELIVERY_TIERS = ((15, 50), (30, 100))
PICKUP_CHARGE = 0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def as_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def as_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def as_boolean(c: Column | str) -> Column:
    return _col(c).try_cast("boolean")


def money(c: Column | str, precision: int = 18) -> Column:
    """Exact cents, so that sums do not depend on the order rows arrive in."""
    return _col(c).cast(f"decimal({precision},2)")


def precise(c: Column | str) -> Column:
    """A double as an exact decimal of six digits after the point, so that sums do not depend on the order rows
    arrive in. NULL for what does not fit (cleaned orders hold no such sum)."""
    return _col(c).try_cast("decimal(28,6)")


def clean_text(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def parse_day(c: Column | str, pattern: str) -> Column:
    return F.try_to_date(_col(c), pattern)


def parse_instant(c: Column | str) -> Column:
    return F.try_to_timestamp(_col(c))


def year_month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


def months_before(as_of: dt.date, months: int) -> Column:
    """First day inside a look-back of whole months; the day is clamped to the month's end."""
    return F.add_months(F.lit(as_of), -months)


def full_name(first: Column | str, last: Column | str) -> Column:
    """NULL when either part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def delivery_charge(distance_km: Column | str) -> Column:
    distance = _col(distance_km)
    charge = None
    for limit, price in DELIVERY_TIERS:
        step = distance <= limit
        charge = F.when(step, price) if charge is None else charge.when(step, price)
    return charge.otherwise(PICKUP_CHARGE)
