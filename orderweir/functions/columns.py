"""Money, time, text and key expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(column: Column) -> Column:
    """Exact amount with two places; text that is no number becomes null instead of failing."""
    return column.try_cast(MONEY)


def money_or_zero(column: Column) -> Column:
    """Projections read a missing amount as 0.00."""
    return F.coalesce(money(column), F.lit(0).cast(MONEY))


def round_cents(column: Column) -> Column:
    """Half-up rounding to cents, done on decimals."""
    return F.round(column, 2).cast(MONEY)


def plain_text(column: Column) -> Column:
    """A decimal as plain digits, never in exponent form."""
    return column.cast("string")


def full_name(first: Column, last: Column) -> Column:
    """Both parts with a blank; a missing part shows as the word null, as the event model does."""
    return F.format_string("%s %s", first, last)


def email_of(name: Column) -> Column:
    return F.concat(F.lower(name), F.lit("@example.com"))


def prefixed(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def parse_iso(column: Column) -> Column:
    """ISO-8601 text with an offset to a UTC timestamp; unreadable text becomes null."""
    return column.try_cast("timestamp").cast("timestamp_ntz")


def iso_text(column: Column) -> Column:
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))


def epoch_ms(column: Column) -> Column:
    return F.unix_millis(column.cast("timestamp"))


def from_epoch_ms(column: Column) -> Column:
    return F.timestamp_millis(column).cast("timestamp_ntz")


def has_key(column: Column) -> Column:
    """True for a usable merge key: present and not empty."""
    return column.isNotNull() & (column != F.lit(""))


def array_size(column: Column) -> Column:
    """Number of elements; a missing array counts as empty."""
    return F.coalesce(F.array_size(column), F.lit(0))


def parsed_once(df: DataFrame, parsed: Column, name: str, keep: list[str]) -> DataFrame:
    """Kept columns and one expensive column that later filters must not compute again.

    Filters on the fields of a parsed record would be moved below the projection
    and parse every record a second time. They are not moved below an explode.
    """
    return df.select(*keep, F.explode(F.array(parsed)).alias(name))
