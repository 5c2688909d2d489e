"""Jaro, Jaro-Winkler without boost threshold, token-set similarity and one-edit tests, as column expressions.

Similarities of tokens are Arrow functions over whole batches (kernels.py): written with higher-order functions they are
interpreted for each pair, some hundred times slower. All else is built-in functions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linkloom.functions import kernels


@F.arrow_udf(DoubleType())
def _jaro(a: pa.Array, b: pa.Array) -> pa.Array:
    tokens, (x, y) = kernels.numbered(a, b)
    return pa.array(tokens.jaro(x, y))


@F.arrow_udf(DoubleType())
def _jaro_winkler(a: pa.Array, b: pa.Array) -> pa.Array:
    tokens, (x, y) = kernels.numbered(a, b)
    return pa.array(tokens.jaro_winkler(x, y))


@F.arrow_udf(DoubleType())
def _token_sim(a: pa.Array, b: pa.Array) -> pa.Array:
    tokens, (x, y) = kernels.numbered(a, b)
    return pa.array(tokens.similarity(x, y))


@F.arrow_udf(DoubleType())
def _name_sim(a: pa.Array, b: pa.Array) -> pa.Array:
    return kernels.name_similarity(a, b)


def known(a: Column, b: Column, value: Column) -> Column:
    """value, or null where a side is."""
    return F.when(a.isNotNull() & b.isNotNull(), value)


def jaro(a: Column, b: Column) -> Column:
    """Transpositions are counted in whole pairs. Empty against anything: 0."""
    return known(a, b, _jaro(a, b))


def jaro_winkler(a: Column, b: Column) -> Column:
    return known(a, b, _jaro_winkler(a, b))


def token_sim(a: Column, b: Column) -> Column:
    """Equal tokens 1; an initial against a token that begins with it at least 0.95."""
    return known(a, b, _token_sim(a, b))


def name_sim(a: Column, b: Column) -> Column:
    """For each token its best match on the other side, averaged, both ways, averaged; null if a side is empty."""
    return _name_sim(a, b)


def shared_bits(tokens_l: Column, bits_l: Column, tokens_r: Column) -> Column:
    """Summed surprisal of the tokens on both sides; 0 where there are none."""
    common = F.array_intersect(tokens_l, tokens_r)
    total = F.aggregate(common, F.lit(0.0), lambda s, t: s + F.get(bits_l, F.array_position(tokens_l, t).cast("int") - 1))
    return F.when(F.arrays_overlap(tokens_l, tokens_r), total).otherwise(F.lit(0.0))  # most pairs share none, and the test is compiled


def one_edit(a: Column, b: Column) -> Column:
    """One character put in, left out or changed, or two neighbours swapped."""
    swapped = F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: F.concat(F.substr(a, F.lit(1), i - 1), F.substr(a, i + 1, F.lit(1)), F.substr(a, i, F.lit(1)), F.substr(a, i + 2, F.length(a))) == b)
    return (F.levenshtein(a, b) == 1) | ((F.length(a) == F.length(b)) & (a != b) & swapped)


def any_one_edit(a: Column, b: Column) -> Column:
    return F.exists(a, lambda x: F.exists(b, lambda y: one_edit(x, y)))
