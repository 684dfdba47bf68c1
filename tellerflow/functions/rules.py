"""Column rules used by cleaning. All are built-in expressions that stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """Day/month/year text to a date; text that is no such date becomes NULL."""
    return F.try_to_date(c, "d/M/yyyy")


def parse_money(c: Column) -> Column:
    """Keep digits and dots, read the rest as a 32-bit float; NULL if that fails.

    The sign and an exponent mark are lost: "-5" is 5.0 and "1e3" is 13.0.
    """
    return F.regexp_replace(c, "[^0-9.]", "").try_cast("float")


def _category(c: Column, first: tuple[list[str], str], second: tuple[list[str], str]) -> Column:
    text = F.upper(c)
    return (
        F.when(text.isin(first[0]), first[1])
        .when(text.isin(second[0]), second[1])
        .otherwise("Unknown")
    )


def yes_no(c: Column) -> Column:
    return _category(c, (["Y", "YES"], "Yes"), (["N", "NO"], "No"))


def gender(c: Column) -> Column:
    return _category(c, (["M", "MALE"], "Male"), (["F", "FEMALE"], "Female"))


def strip_chars(c: Column, chars: str) -> Column:
    """Remove every occurrence of each of ``chars``, by plain text search."""
    for char in chars:
        c = F.replace(c, F.lit(char), F.lit(""))
    return c


def round_half_up(c: Column) -> Column:
    """Nearest integer, halves towards plus infinity, also below zero."""
    return F.floor(c + F.lit(0.5)).cast("int")
