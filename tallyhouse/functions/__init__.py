"""Column-level helpers shared by the operators."""

from tallyhouse.functions.columns import (
    as_boolean,
    as_double,
    as_int,
    as_long,
    clean_text,
    days_between,
    delivery_charge,
    full_name,
    money,
    months_before,
    parse_day,
    parse_instant,
    precise,
    year_month,
)

__all__ = [
    "as_boolean",
    "as_double",
    "as_int",
    "as_long",
    "clean_text",
    "days_between",
    "delivery_charge",
    "full_name",
    "money",
    "months_before",
    "parse_day",
    "parse_instant",
    "precise",
    "year_month",
]
