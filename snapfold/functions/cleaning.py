"""Column expressions that clean dirty text. All stay in the JVM and none raises under ANSI mode."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "missing" in numeric source columns (exact, case-sensitive).
NULL_TOKENS = ("NULL", "", " ", "NaN")

# A cast that fails inside try_cast() raises and catches an exception, some thirty times the price of a
# good one, so texts of the wrong shape are sorted out before. A cast ignores blanks at both ends.
_BLANK = r"[\s\x00-\x1f\x7f]*"
_NUMBER = rf"^{_BLANK}[+-]?[0-9]+([.][0-9]*)?{_BLANK}$"
_FRACTION = rf"^{_BLANK}[+-]?[.][0-9]*{_BLANK}$"
_NUMBER_START = rf"^{_BLANK}[+-]?([0-9.]|(?i:inf|nan))"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_value(c: Column, tokens: Sequence[str]) -> Column:
    # isin() on a typed column would cast the tokens to its type and fail, hence the string.
    return ~F.coalesce(c.cast("string").isin(*tokens), F.lit(False))


def _unless_token(c: Column, tokens: Sequence[str], value: Column) -> Column:
    return F.when(_is_value(c, tokens), value) if tokens else value


def null_tokens(c: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null where the text is one of ``tokens``, the value itself otherwise."""
    c = _column(c)
    return F.when(_is_value(c, tokens), c)


def text_to_double(c: Column) -> Column:
    """``try_cast`` of a text to double that is also quick where the text is no number."""
    return F.when(c.rlike(_NUMBER_START), c.try_cast("double"))


def safe_double(c: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Double value of a text; null for a token or anything that is no number."""
    c = _column(c)
    # A token that is no number gives null as it is, and need not be looked for.
    numeric = [t for t in tokens if re.match(_NUMBER_START, t)]
    return _unless_token(c, numeric, text_to_double(c.cast("string")))


def safe_int(c: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Integer value of a text; a decimal fraction is cut off, overflow and non-numbers give null.

    Exponents are not taken: ``1e3`` is no integer text.
    """
    c = _column(c)
    text = c.cast("string")
    numeric = [t for t in tokens if re.match(_NUMBER, t) or re.match(_FRACTION, t)]
    # try_cast('12.9' as int) is null, so it gets what is before the point.
    value = F.when(text.rlike(_NUMBER), F.substring_index(text, ".", 1).try_cast("int"))
    return _unless_token(c, numeric, value.when(text.rlike(_FRACTION), F.lit(0)))


def lenient_date(c: Column | str) -> Column:
    """Date of an ISO date or timestamp text, null for any other text."""
    return _column(c).try_cast("date")


def strip_modifier(c: Column | str) -> Column:
    """Base rating of texts such as ``89+3`` or ``62-1``: all before the first sign, as a double."""
    text = _column(c).cast("string")
    base = F.substring_index(F.substring_index(text, "+", 1), "-", 1)
    return text_to_double(base)
