"""Value rules for messy profile fields, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starwise.config import WORD_BITS, WORDS

# Texts that count as "yes".
TRUE_WORDS = ("true", "1", "yes")
DEFAULT_PRICE = 2


def list_count(text: Column) -> Column:
    """Parts of a comma list; NULL, '' and 'None' hold none."""
    empty = text.isNull() | text.isin("", "None")
    return F.when(empty, 0).otherwise(F.size(F.split(text, ","))).cast("bigint")


def safe_log1p(value: Column) -> Column:
    """log(1 + x), and 0 for anything that is no number or is negative."""
    number = value.try_cast("double")
    return F.when(number >= 0, F.log1p(number)).otherwise(0.0)


def flag(value: Column) -> Column:
    """1 for a yes in any case and with any padding, else 0."""
    said = F.lower(F.trim(value))
    return F.coalesce(said.isin(*TRUE_WORDS), F.lit(False)).cast("int")


def price(value: Column) -> Column:
    """Whole-number price level, 2 where it is missing or unreadable."""
    return F.coalesce(value.try_cast("int"), F.lit(DEFAULT_PRICE))


def finite(value: Column) -> Column:
    """NaN and infinities become 0."""
    infinite = F.abs(value) == float("inf")
    return F.when(F.isnan(value) | infinite, 0.0).otherwise(value)


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def _md5_number(text: Column, start: int) -> Column:
    """60 bits of the MD5: the 15 hex digits from ``start``."""
    return F.conv(F.substring(F.md5(text), start, 15), 16, 10).cast("bigint")


def id_words(key: Column, is_integer: bool) -> list[Column]:
    """The 64 bits of an id as words of 22 bits, lowest first.

    Integers are taken as they are, so no two of them are folded into one; texts by 60 bits of
    their MD5.
    """
    number = key.cast("bigint") if is_integer else _md5_number(key, 1)
    mask = F.lit((1 << WORD_BITS) - 1)
    return [F.shiftrightunsigned(number, WORD_BITS * k).bitwiseAND(mask) for k in range(WORDS)]


def pair_hash(*keys: Column, start: int = 1) -> Column:
    """Uniform integer in [0, 2**60) of a composite key; the same on every run and cluster.

    ``start`` 1 and 17 take different digits of the MD5 and so are independent of each other.
    """
    return _md5_number(F.concat_ws("-", *[key.cast("string") for key in keys]), start)
