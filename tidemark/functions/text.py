"""Blankness, trimming and delimited-line rendering as codegen'd expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The characters that count as white space in a field.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """The value without leading and trailing white space of any kind."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def is_blank(column: Column) -> Column:
    """True for null, empty, and white-space-only values."""
    return column.isNull() | (strip(column) == "")


def field(column: Column, separator: str) -> Column:
    """One delimited field, quoted only when it needs to be."""
    special = (
        column.contains(separator)
        | column.contains('"')
        | column.contains("\n")
        | column.contains("\r")
    )
    quoted = F.concat(
        F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"')
    )
    return F.when(special, quoted).otherwise(column)


def line(columns: list[Column], separator: str) -> Column:
    """A delimited line from text columns, without the line end."""
    return F.concat_ws(separator, *[field(column, separator) for column in columns])


def odd_quotes(column: Column) -> Column:
    """True when a physical line holds an odd number of quote characters.

    A record that goes on over a line end must leave a quote open, so a file
    without such lines can be read line by line and split anywhere.
    """
    quotes = F.length(column) - F.length(F.replace(column, F.lit('"'), F.lit("")))
    return column.contains('"') & (quotes % 2 == 1)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)
