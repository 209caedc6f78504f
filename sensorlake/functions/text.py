"""Columns that read sensor text: tokens, numbers and ids."""

from pyspark.sql import functions as F

_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"
_INTEGER = r"^[+-]?\d+$"


def tokens(line):
    """Whitespace separated tokens of a line."""
    return F.regexp_extract_all(line, F.lit(r"\S+"), F.lit(0))


def with_tokens(df, into="_t", line="line"):
    """Add the tokens of each line.

    The one-element generator is a fence: without it the optimizer would copy the
    tokenising into every expression that takes a token.
    """
    return df.select("*", F.explode(F.array(tokens(F.col(line)))).alias(into))


def number(token, null_marks=()):
    """A double, or null for a null mark, a NaN or anything that is no number.

    The pattern keeps out spellings only the JVM accepts, such as ``1d`` and ``0x1p3``.
    """
    if null_marks:
        token = F.when(~token.isin(*null_marks), token)
    return F.when(token.rlike(_NUMBER), token).try_cast("double")


def whole_number(token):
    """A bigint from plain integer text only."""
    return F.when(token.rlike(_INTEGER), token).try_cast("bigint")


def truncated_id(value):
    """An int from a double, cut towards zero; null beyond the int range."""
    return F.when(~F.isnan(value), value).try_cast("int")


def guarded_id(value, low, high):
    """The id when it lies in the inclusive range, else null."""
    return truncated_id(F.when(value.between(low, high), value))
