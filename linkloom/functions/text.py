"""Free text to canonical upper-case ASCII, names to tokens; all as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Where characters stand that Latin-ASCII folding may change: Latin letters, phonetic ones, punctuation and signs, wide forms.
FOLDED = ((0xA0, 0x2B0), (0x1D00, 0x1DC0), (0x1E00, 0x1F00), (0x2000, 0x2300), (0x2460, 0x2500), (0x2C60, 0x2C80), (0x3000, 0x3040), (0xFB00, 0xFB07), (0xFF00, 0xFFF0))
_folds: dict[str, str] = {}


def fold_table() -> dict[str, str]:
    """Each character that Latin-ASCII folding changes, and what it becomes; from the ICU library that Spark ships with."""
    if not _folds:
        icu = SparkSession.active()._jvm.com.ibm.icu.text.Transliterator.getInstance("Latin-ASCII")
        chars = [chr(c) for a, b in FOLDED for c in range(a, b) if unicodedata.category(chr(c)) not in ("Zl", "Zp", "Cn")]
        got = icu.transliterate("\n".join(chars)).split("\n")
        _folds.update((c, x) for c, x in zip(chars, got, strict=True) if x != c)
    return _folds


def fix_utf8(c: Column) -> Column:
    """Bytes that are no UTF-8 are read as Latin-1."""
    return F.when(F.is_valid_utf8(c), c).otherwise(F.decode(c.cast("binary"), "ISO-8859-1"))


def ascii_fold(c: Column) -> Column:
    """Each character beyond ASCII that a text holds is replaced at all its places at once; a text holds few different ones."""
    known = F.str_to_map(F.lit("\x02".join(f"{x}\x01{y}" for x, y in fold_table().items())), F.lit("\x02"), F.lit("\x01"))  # one literal, folded when planned
    there = F.array_distinct(F.regexp_extract_all(c, F.lit(r"[^\x00-\x7F]"), F.lit(0)))
    return F.when(~c.rlike(r"[^\x00-\x7F]"), c).otherwise(F.aggregate(there, c, lambda x, y: F.replace(x, y, F.coalesce(F.element_at(known, y), y))))


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def std_text(c: Column) -> Column:
    """Upper-case letters and digits with single spaces between; null if nothing is left."""
    c = F.upper(ascii_fold(fix_utf8(c.cast("string"))))
    return null_if_blank(F.trim(F.regexp_replace(c, "[^A-Z0-9]+", " ")))


std_name = std_text


def split_words(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda t: t != "")


def name_tokens(c: Column) -> Column:
    """Tokens of a name in order, repeated ones kept; empty for null."""
    return split_words(std_name(c))


def is_initial(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.length(t) == 1)


def null_if_empty(a: Column) -> Column:
    return F.when(F.size(a) > 0, a)


def full_tokens(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= 2)


def name_key(tokens: Column) -> Column:
    return null_if_blank(F.array_join(F.array_sort(full_tokens(tokens)), " "))


def in_range(c: Column, low: int = 0, high: int = 110) -> Column:
    return F.when(c.between(low, high), c)


def in_domain(c: Column, values: tuple[str, ...] = ("Male", "Female")) -> Column:
    return F.when(c.isin(*values), c)


def first_filled(*cs: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in cs])


def collapse(values: Column, sep: str = "; ") -> Column:
    """Of an array: null if all are null, the one value if all agree, else all that are not null, joined."""
    own = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(own) == 0, None).when(F.size(F.array_distinct(own)) == 1, F.get(own, F.lit(0))).otherwise(F.array_join(own, sep))


def signif(c: Column, digits: int) -> Column:
    """Rounded to that many significant digits; 0 stays 0."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, c).otherwise(F.rint(c * scale) / scale)
