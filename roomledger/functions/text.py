"""Column expressions that turn the raw text fields of an export into typed values.

Every cast that may meet bad text is a ``try_cast``, so the expressions give null
where a value cannot be read and never fail under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers and patterns of the export format.
NOT_AVAILABLE = "N/A"
CURRENCY_SIGN = "$"
THOUSANDS_SIGN = ","
FALSE_FLAG = "f"
TRUE_FLAG = "t"
LIST_PUNCTUATION = "'[]"
LISTING_TEXT_NOISE = r'(\r|<br/>|""|")'
COMMENT_NOISE = r'(\r|<br\s*/?>|""|")'
MONEY_TYPE = "decimal(18,2)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_price(text: Column | str, thousands: bool = False) -> Column:
    """``$123.45`` as money.

    By default only the currency sign is removed, so ``$1,234.00`` is unreadable and
    gives null; ``thousands=True`` also removes the thousands sign.
    """
    dropped = CURRENCY_SIGN + (THOUSANDS_SIGN if thousands else "")
    return F.translate(_column(text), dropped, "").try_cast(MONEY_TYPE)


def parse_flag(text: Column | str, keep_unknown: bool = False) -> Column:
    """``t``/``f`` as boolean.

    By default ``f`` is false and everything else, null included, is true;
    ``keep_unknown=True`` gives null for anything that is neither.
    """
    flag = F.trim(_column(text))
    if keep_unknown:
        return F.when(flag == FALSE_FLAG, False).when(flag == TRUE_FLAG, True)
    return F.when(flag == FALSE_FLAG, False).otherwise(True)


def parse_percent(text: Column | str) -> Column:
    """``95%`` as 95; a fraction is cut off, bad text is null."""
    return parse_whole_number(F.regexp_replace(_column(text), "%", "")).try_cast("int")


def parse_whole_number(text: Column | str) -> Column:
    """Text to long, cutting off a fraction; bad text is null."""
    return _column(text).try_cast("decimal(38,6)").try_cast("bigint")


def parse_list(text: Column | str) -> Column:
    """``['a', 'b']`` as an array, elements untrimmed; ``[]`` gives one empty element."""
    return F.split(F.trim(F.translate(_column(text), LIST_PUNCTUATION, "")), ",")


def parse_list_strict(text: Column | str) -> Column:
    """``['a', 'b']`` or ``["a", "b"]`` as an array of trimmed, non-empty elements.

    Double-quoted lists are read as JSON, so an element may hold a comma.
    """
    raw = _column(text)
    plain = F.transform(parse_list(raw), lambda item: F.trim(F.translate(item, '"', "")))
    quoted = F.when(raw.contains('"'), F.from_json(raw, "array<string>"))
    return F.filter(F.coalesce(quoted, plain), lambda item: item != "")


def nth_part(text: Column | str, position: int) -> Column:
    """Trimmed element of a comma-separated text (1 is the first); null if absent."""
    return F.trim(F.try_element_at(F.split(_column(text), ","), F.lit(position)))


def na_to_null(text: Column | str) -> Column:
    return F.nullif(_column(text), F.lit(NOT_AVAILABLE))


def clean_text(text: Column | str) -> Column:
    """Listing prose without carriage returns, breaks and quotes."""
    return F.trim(F.regexp_replace(_column(text), LISTING_TEXT_NOISE, " "))


def clean_comment(text: Column | str) -> Column:
    """Review prose as one line with single blanks."""
    without_noise = F.regexp_replace(_column(text), COMMENT_NOISE, " ")
    return F.trim(F.regexp_replace(without_noise, r"\s+", " "))


def list_size(items: Column | str, null_size: int | None = -1) -> Column:
    """Number of elements; a null list counts as ``null_size``."""
    size = F.size(_column(items))
    missing = _column(items).isNull()
    return F.when(missing, F.lit(null_size).cast("int")).otherwise(size)
