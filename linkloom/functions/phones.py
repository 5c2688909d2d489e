"""Free-text phone fields as sets of canonical national numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A number in scientific notation; the other expressions of this module are fixed too (fixed values).
SCIENTIFIC = r"^\s*[0-9]+(\.[0-9]+)?[Ee][+-]?[0-9]+\s*$"
MIN_DIGITS, MAX_DIGITS, SPLIT_MIN = 7, 12, 7


def sci_digits(c: Column) -> Column:
    """The integer that scientific notation stands for, as digits; null for other text."""
    return F.when(c.rlike(SCIENTIFIC), F.format_string("%.0f", F.trim(c).try_cast("double")))


def pieces(c: Column, split_min: int = SPLIT_MIN) -> Column:
    """What of an entry may be a number of its own.

    A long integer in scientific notation held two numbers, of which only the first nine digits are exact. White space
    parts numbers only where every chunk has split_min digits.
    """
    sci = sci_digits(c)

    def apart(p: Column) -> Column:
        chunks = F.filter(F.split(p, r"\s+"), lambda x: x != "")
        return F.when((F.size(chunks) > 1) & F.forall(chunks, lambda x: F.length(F.regexp_replace(x, "[^0-9]", "")) >= split_min), chunks).otherwise(F.array(p))

    plain = F.filter(F.transform(F.split(c, "[,/;+]"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")
    own = F.flatten(F.transform(plain, apart))
    return F.when(c.isNull(), F.array().cast("array<string>")).when(F.length(sci) > 15, F.array(F.substring(sci, 1, 9))).when(sci.isNotNull(), F.array(sci)).otherwise(own)


def canonical(p: Column, low: int = MIN_DIGITS, high: int = MAX_DIGITS) -> Column:
    """Digits without country and trunk prefix; null if too short, too long or one digit repeated."""
    d = F.regexp_replace(p, r"(?<=[0-9])\s*[Oo](?=\s*[0-9])", "0")
    d = F.regexp_replace(d, "[^0-9]", "")
    d = F.regexp_replace(d, r"^0{0,2}243(?=[0-9]{9}$)", "")
    d = F.regexp_replace(d, r"^0(?=[0-9]{9}$)", "")
    return F.when(F.length(d).between(low, high) & ~d.rlike(r"^([0-9])\1*$"), d)


def phone_set(c: Column, low: int = MIN_DIGITS, high: int = MAX_DIGITS, split_min: int = SPLIT_MIN) -> Column:
    c = c.cast("string")
    return F.array_distinct(F.filter(F.transform(pieces(c, split_min), lambda p: canonical(p, low, high)), lambda p: p.isNotNull()))


def widest(df: DataFrame, raw: str) -> int:
    """The most numbers that an entry holds, 1 at least."""
    return max(1, df.agg(F.max(F.size(phone_set(F.col(raw))))).head()[0] or 0)


def clean_phone(df: DataFrame, raw: str, n: int | None = None) -> DataFrame:
    """df with phone_1 to phone_n; n: as many as the widest entry has, unless given."""
    return df.select("*", *phone_columns(F.col(raw), n or widest(df, raw)))


def phone_columns(c: Column, n: int) -> list[Column]:
    """phone_1 to phone_n."""
    return [F.get(phone_set(c), F.lit(i)).alias(f"phone_{i + 1}") for i in range(n)]
