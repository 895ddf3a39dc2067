"""Tolerant scalar expressions.

External text is dirty and Spark runs with ANSI mode on, so each function here
answers null for a value it cannot read instead of failing the job. All of them
are built-in expressions and stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPACT_DAY = "yyyyMMdd"
FEED_STAMP = "dd/MM/yyyy H:mm"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- strings ---------------------------------------------------------------

def norm(col) -> Column:
    """Trimmed lower-case form used to compare names."""
    return F.trim(F.lower(_c(col)))


def shout(col) -> Column:
    """Trimmed upper-case form used for display labels."""
    return F.trim(F.upper(_c(col)))


def token(col, sep: str, i: int) -> Column:
    """The i-th piece (from 0) of a text split on a literal separator; null when absent."""
    return F.get(F.split(_c(col), "\\Q" + sep + "\\E"), F.lit(i))


def pad_time(col) -> Column:
    """``7:05`` becomes ``07:05``; other lengths pass through."""
    col = _c(col)
    return F.when(F.length(col) == 4, F.concat(F.lit("0"), col)).otherwise(col)


def strip(col, pattern: str) -> Column:
    return F.regexp_replace(_c(col), pattern, "")


def join_text(sep: str, col) -> Column:
    return F.concat_ws(sep, _c(col))


def words(col) -> Column:
    """Whitespace tokens, blanks dropped."""
    return F.filter(F.split(F.trim(_c(col)), "\\s+"), lambda w: w != "")


# ---- numbers ---------------------------------------------------------------

def clean_double(col) -> Column:
    """``45,000`` to 45000.0; unreadable text to null."""
    return F.replace(_c(col), F.lit(","), F.lit("")).try_cast("double")


def clean_int(col) -> Column:
    return _c(col).try_cast("int")


def unless_sentinel(col, sentinel: float = -9999) -> Column:
    """The feeds write -9999 for a missing quantity."""
    return F.nullif(_c(col), F.lit(float(sentinel)))


def round_half_up(col, digits: int = 0) -> Column:
    return F.round(_c(col), digits)


def round_half_even(col, digits: int = 0) -> Column:
    return F.bround(_c(col), digits)


def safe_div(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def row_sum(*cols) -> Column:
    """Row-wise sum that skips nulls."""
    return reduce(lambda x, y: x + y, [F.coalesce(_c(c), F.lit(0)) for c in cols])


# ---- conditions ------------------------------------------------------------

def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def first_known(*cols, default=None) -> Column:
    picks = [_c(c) for c in cols]
    if default is not None:
        picks.append(F.lit(default))
    return F.coalesce(*picks)


# ---- dates -----------------------------------------------------------------

def parse_date(col, fmt: str = COMPACT_DAY) -> Column:
    return F.try_to_timestamp(_c(col).cast("string"), F.lit(fmt)).cast("date")


def fmt_date(col, fmt: str = COMPACT_DAY) -> Column:
    return F.date_format(_c(col), fmt)


def weekday(col) -> Column:
    """Mon to Sun; the name of a date, without a formatter for stamps."""
    return F.dayname(_c(col))


def days_between(end, start) -> Column:
    return F.datediff(_c(end), _c(start))


def plus_days(col, n) -> Column:
    return F.date_add(_c(col), _c(n).cast("int") if not isinstance(n, int) else n)


def month_key(col) -> Column:
    """yyyyMM as an int."""
    col = _c(col)
    return (F.year(col) * 100 + F.month(col)).cast("int")


def day_key(col) -> Column:
    """yyyyMMdd as an int."""
    col = _c(col)
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def days(start, end) -> Column:
    """Every day from start to end, both included; null when the range runs backwards."""
    start, end = _c(start), _c(end)
    return F.when(start <= end, F.sequence(start, end))


def date_part(col) -> Column:
    return F.try_to_timestamp(_c(col)).cast("date")


def time_part(col) -> Column:
    return F.date_format(F.try_to_timestamp(_c(col)), "HH:mm:ss")


def created_text(col) -> Column:
    """``05/01/2023 7:05`` to ``2023-01-05 07:05``."""
    return F.date_format(F.try_to_timestamp(_c(col), F.lit(FEED_STAMP)), "yyyy-MM-dd HH:mm")
