"""Lenient and strict conversions from raw text to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.schemas import MISSING_TOKENS

# A number between optional white space. Spark's own cast also takes Java suffixes
# ("12d"), which are not numbers here. Testing first also keeps bad text away from
# the cast, where it would cost an exception per row.
_NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
_ISO_MONTH = r"^\d{4}-\d{2}$"

# --- fixed values: every character that counts as white space -------------------
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Drop leading and trailing white space of every kind, not only blanks."""
    return F.btrim(_col(c).cast("string"), F.lit(_BLANKS))


def missing_to_null(c: Column | str) -> Column:
    """NULL for the fixed missing-value tokens, the text otherwise."""
    return F.when(~_col(c).isin(*MISSING_TOKENS), _col(c))


def nulls_for_tokens(df: DataFrame) -> DataFrame:
    """Apply :func:`missing_to_null` to every text column."""
    return df.select(*[
        missing_to_null(name).alias(name) if kind == "string" else F.col(name)
        for name, kind in df.dtypes
    ])


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def lenient_double(c: Column | str) -> Column:
    """A number, or NULL when the text is not one (NaN counts as not one)."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def is_number(c: Column | str) -> Column:
    return _col(c).cast("string").rlike(_NUMBER)


def is_whole_number(c: Column | str) -> Column:
    return _col(c).cast("string").rlike(_WHOLE)


def lenient_long(c: Column | str) -> Column:
    """Parse leniently, then cut the fraction off; whole numbers stay exact."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_WHOLE), text.try_cast("long")).otherwise(lenient_double(text).cast("long"))


def strict_long(c: Column | str) -> Column:
    """A whole number; missing or unreadable text fails the query."""
    value = lenient_long(c)
    message = F.concat(F.lit("not a whole number: "), F.coalesce(_col(c).cast("string"), F.lit("NULL")))
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(message).cast("long"))


def iso_date(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text as a date; any other text is NULL."""
    return F.when(_col(c).rlike(_ISO_DAY), _col(c).try_cast("date"))


def formatted_date(c: Column | str, pattern: str) -> Column:
    """A date in another known format."""
    return F.try_to_date(_col(c), pattern)


def month_start(c: Column | str) -> Column:
    """``yyyy-MM`` text as the first day of that month."""
    return F.when(_col(c).rlike(_ISO_MONTH), F.concat(_col(c), F.lit("-01")).try_cast("date"))


def month_text_to_date(c: Column | str) -> Column:
    """Append a day to month text and parse it strictly."""
    return F.to_date(F.concat(_col(c), F.lit("-01")))


def iso_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def month_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def standardise(c: Column | str, spellings: Mapping[str, str]) -> Column:
    """Look the stripped text up in a fixed table; unknown spellings are NULL."""
    pairs = [F.lit(part) for entry in spellings.items() for part in entry]
    return F.try_element_at(F.create_map(*pairs), strip(c))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])
