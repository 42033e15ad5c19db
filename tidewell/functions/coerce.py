"""Turning CSV and XML text into typed JSON values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number grammar and the words with a meaning in CSV cells.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TRUE_WORDS = ("true", "yes")
FALSE_WORDS = ("false", "no")
NULL_WORDS = ("", "null", "none")


LONGEST_WORD = 5


def _may_be_number(text: Column) -> Column:
    """Whether the first character can begin a number: most texts end here, before any pattern is tried."""
    return F.ascii(text).between(ord("+"), ord("9"))


def _finite_double(text: Column) -> Column:
    number = F.when(text.rlike(FLOAT_TEXT), text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _integer(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def _short(text: Column, value: Column) -> Column:
    """``value`` for texts that are short enough to be one of the words."""
    return F.when(F.length(text) <= LONGEST_WORD, value)


def quote_json(text: Column) -> Column:
    """A string column as JSON string literals."""
    wrapped = F.to_json(F.array(text))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def csv_value_json(text: Column) -> Column:
    """A CSV cell as JSON text: integer, float, boolean, null, else string."""
    lower = F.lower(text)
    number = F.coalesce(_integer(text).cast("string"), _finite_double(text).cast("string"))
    word = F.when(lower.isin(*TRUE_WORDS), F.lit("true")).when(lower.isin(*FALSE_WORDS), F.lit("false")).when(lower.isin(*NULL_WORDS), F.lit("null"))
    return F.coalesce(F.when(_may_be_number(text), number), _short(text, word), quote_json(text))


def _number_type(text: Column) -> Column:
    known = F.when(_integer(text).isNotNull(), F.lit("integer")).when(_finite_double(text).isNotNull(), F.lit("number"))
    return F.when(_may_be_number(text), known)


def csv_value_type(text: Column) -> Column:
    """The JSON type a CSV cell is read as."""
    lower = F.lower(text)
    word = F.when(lower.isin(*TRUE_WORDS, *FALSE_WORDS), F.lit("boolean")).when(lower.isin(*NULL_WORDS), F.lit("null"))
    return F.coalesce(_number_type(text), _short(text, word), F.lit("string"))


def xml_text_type(text: Column) -> Column:
    """The JSON type XML text is read as: no words for null, yes or no."""
    word = F.when(F.lower(text).isin("true", "false"), F.lit("boolean"))
    return F.coalesce(_number_type(text), _short(text, word), F.lit("string"))
