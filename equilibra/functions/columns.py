"""Scalar column functions used by every product.

Each one is a built-in Spark expression. Text becomes a number or a date only
through ``try_cast`` / ``try_to_date``: Spark 4 runs ANSI by default, where a
plain cast of ``''`` or ``'garbage'`` fails the whole job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: patterns --------------------------------------------------
PATIENT_PATTERN = r"Patient/(.*)$"
START_TIME_PATTERN = r"\d\d:\d\d:\d\d\+\d\d:\d\d"
SAMPLE_BRACKETS = r"(^\[\[\[)|(\]\]\]$)"
SAMPLE_SEPARATOR = " "
# Every float has a digit, or ends (before white space) as NaN, Inf and Infinity do.
MAYBE_FLOAT = r"[0-9]|[nNfFyY][\x00-\x20]*$"
# The same for a whole token between single spaces.
# Found in a text without brackets unless all its tokens are decimals such as 12, -3.5 or .5, which are floats.
ODD_TOKENS = r"[^0-9. \-]|\A\z|\A | \z|  |[^ ]-|-(?![0-9.])|\.[0-9]*\.|(?<![0-9])\.(?![0-9])"
FLOAT_TOKEN = r"(?<![^ ])[^ ]*(?:[0-9][^ ]*|[nNfFyY][\x00-\x1F]*(?![^ ]))"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def patient_id(reference: Column | str) -> Column:
    """Everything after the first ``Patient/`` (greedy); ``''`` if absent."""
    return F.regexp_extract(_c(reference), PATIENT_PATTERN, 1)


def session_date(effective: Column | str) -> Column:
    """Calendar date written before the ``T`` (the offset is not applied);
    null when the text is not a date."""
    return F.try_to_date(_c(effective))


def iso_week(date: Column | str) -> Column:
    """ISO-8601 week number, without the year (2021-01-01 is week 53)."""
    return F.weekofyear(_c(date))


#: The ISO year that a week belongs to: 2021-01-01 lies in week 53 of 2020.
WEEK_YEAR = "Week_year"


def iso_year(date: Column | str) -> Column:
    """The year of a date's ISO-8601 week."""
    return F.extract(F.lit("YEAROFWEEK"), _c(date))


def week_keys(with_year: bool) -> list[str]:
    """The key columns of a week: without the year, as defined, or with it."""
    return [WEEK_YEAR, "Week"] if with_year else ["Week"]


def add_week_year(df: DataFrame, with_year: bool = True) -> DataFrame:
    """Adds the week's year, if it is asked for, to rows with a ``Date``."""
    return df.withColumn(WEEK_YEAR, iso_year("Date")) if with_year else df


def start_time(effective: Column | str) -> Column:
    """``hh:mm:ss+hh:mm`` as written; ``''`` for ``Z``, negative offsets or
    fractional seconds."""
    return F.regexp_extract(_c(effective), START_TIME_PATTERN, 0)


def sample_tokens(text: Column | str) -> Column:
    """Split a ``[[[v1 v2 ...]]]`` sample text on single spaces.

    Only the outer brackets are removed; a double space yields an empty token.
    """
    return F.split(_stripped(text), SAMPLE_SEPARATOR)


def _stripped(text: Column | str) -> Column:
    """A sample text without its outer brackets; the pattern is only needed for texts that lack some."""
    whole = _c(text).startswith("[[[") & _c(text).endswith("]]]")
    return F.when(whole, _c(text).substr(F.lit(4), F.length(text) - 6)).otherwise(F.regexp_replace(_c(text), SAMPLE_BRACKETS, ""))


def odd_tokens(text: Column | str) -> Column:
    """Whether a sample text may hold a token that is no float; false: all its tokens are floats."""
    return _stripped(text).rlike(ODD_TOKENS)


def parse_float(token: Column | str) -> Column:
    """A sample token as float; null when it is not a number.

    Tokens that can be no number never reach the cast, where each would cost a Java
    exception with its stack, many times the price of a number.
    """
    return F.when(_c(token).rlike(MAYBE_FLOAT), _c(token)).try_cast("float")


def sample_floats(text: Column | str) -> Column:
    """The floats of a sample text without regard to their places: the tokens that can be no
    number are left out, others that are none are null.

    One pass of a pattern and a cast of the whole array, both of them compiled; a lambda
    per token is interpreted.
    """
    return F.regexp_extract_all(_stripped(text), F.lit(FLOAT_TOKEN), 0).try_cast("array<float>")


def sample_values(text: Column | str) -> Column:
    """The tokens of a sample text as floats, each in its place; null where one is no number.

    Both branches give the same; the cast of a whole array is compiled, but would throw for odd tokens.
    """
    tokens = sample_tokens(text)
    return F.when(odd_tokens(text), F.transform(tokens, parse_float)).otherwise(tokens.try_cast("array<float>"))


def flag_text(flag: Column | str) -> Column:
    """``Yes`` for true; ``No`` for false and for null."""
    return F.when(_c(flag) == F.lit(True), F.lit("Yes")).otherwise(F.lit("No"))
