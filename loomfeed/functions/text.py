"""Cleaning and shaping of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What counts as white space, and the characters removed from free text.
WHITESPACE = " \t\n\u000B\f\r"
UNPRINTABLE = "[\\u0000-\\u001F|\\u00A0-\\u00FF\\uFFF0-\\uFFFF]"
# Files lose a run of tabs that a space follows, together with the space; history loses all tabs.
FILE, HISTORY = "file", "history"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean(value: Column | str, target: str = FILE) -> Column:
    """Strip white space at both ends and remove tabs as ``target`` wants it."""
    trimmed = F.btrim(as_column(value), F.lit(WHITESPACE))
    if target == HISTORY:
        return F.replace(trimmed, F.lit("\t"), F.lit(""))
    # Starting only at the first tab of a run keeps long runs linear.
    return F.regexp_replace(trimmed, "(?<!\t)\t++ ", "")


def clean_strings(df: DataFrame, target: str = FILE) -> DataFrame:
    """Clean every string column in one projection; other types pass through."""
    return df.select(
        *[
            clean(F.col(field.name), target).alias(field.name)
            if isinstance(field.dataType, StringType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def strip_nonprintable(value: Column | str) -> Column:
    """Drop control characters, ``|``, Latin-1 upper half and specials; NULL stays NULL."""
    return F.regexp_replace(as_column(value), UNPRINTABLE, "")


def quote_if_needed(value: Column | str) -> Column:
    """Wrap a value that holds ``"`` in quotes, writing inner quotes as ``\\"``."""
    value = as_column(value)
    escaped = F.replace(value, F.lit('"'), F.lit('\\"'))
    return F.when(value.contains('"'), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(value)


def truncate(value: Column | str, length: int) -> Column:
    return F.substring(F.trim(as_column(value)), 1, length)


def null_if_longer(value: Column | str, length: int, trim: bool = True) -> Column:
    value = as_column(value).cast("string")
    value = F.trim(value) if trim else value
    return F.when(F.length(value) <= length, value)


def default_if_blank(value: Column | str, default: str) -> Column:
    value = as_column(value)
    return F.when(value.isNull() | (F.trim(value) == ""), F.lit(default)).otherwise(value)


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(as_column(value)), F.lit(""))


def lookup_key(value: Column | str) -> Column:
    """Upper case without spaces, as used when attribute names are compared."""
    return F.upper(F.replace(as_column(value), F.lit(" "), F.lit("")))


def full_name(
    last: Column | str, first: Column | str, middle: Column | str, trailing_space: bool
) -> Column:
    """``LAST,FIRST MIDDLE``; without a middle name the trailing space depends on the model."""
    stem = F.concat(as_column(last), F.lit(","), as_column(first))
    middle = as_column(middle)
    short = F.concat(stem, F.lit(" ")) if trailing_space else stem
    return F.when(middle.isNull(), short).otherwise(F.concat(stem, F.lit(" "), middle))
