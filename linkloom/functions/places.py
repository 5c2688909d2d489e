"""Village names as order-free token sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import null_if_blank, split_words, std_text

#: Words for kinds of places and French function words (fixed values).
ADM4_TYPE_WORDS = ("Q", "QUARTIER", "CARTIER", "QTIER", "CEL", "CELL", "CELLULE", "AV", "AVENUE", "RUE", "BLOC", "VIL", "VILLAGE", "LOC", "LOCALITE", "COMMUNE", "COM", "GROUPEMENT", "GRPT", "DE", "DU", "DES", "LA", "LE", "ET", "AU", "PRES", "VERS")
#: House numbers, and kilometre posts with the mark before or behind (fixed values).
HOUSE = r"\b(N|NO|NR|NUM|NUMERO) ?[0-9]+\b"
POST_BEFORE = r"\bPK ?([0-9]+)( ?KM)?\b"
POST_BEHIND = r"\b([0-9]+) ?KM\b"


def adm4_tokens(c: Column) -> Column:
    """House numbers go, kilometre posts are one token each, then distinct words of two letters or more."""
    c = F.coalesce(std_text(c), F.lit(""))
    c = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, HOUSE, " "), POST_BEFORE, "PK$1"), POST_BEHIND, "PK$1")
    return F.array_distinct(F.filter(split_words(c), lambda t: (F.length(t) >= 2) & ~t.isin(*ADM4_TYPE_WORDS)))


def adm4_std(c: Column) -> Column:
    return null_if_blank(F.array_join(adm4_tokens(c), " "))
