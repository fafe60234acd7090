"""Set similarities and guarded arithmetic as column expressions; sizes of words and n-grams in common by Arrow."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_div(a: Column, b: Column) -> Column:
    """0.0 where the denominator is not positive."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0.0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1))).otherwise(F.lit(0.0))


def jaccard_of(common: Column, a: Column, b: Column) -> Column:
    """jaccard() of two sets by their sizes."""
    union = a + b - common
    return F.when(union > 0, common / F.greatest(union, F.lit(1))).otherwise(F.lit(0.0))


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def subset(common: Column, a: Column, b: Column) -> Column:
    """Either of two sets, given by their sizes, is within the other; the empty set is within all."""
    return flag((common == a) | (common == b))


def levenshtein_norm(a: Column, b: Column) -> Column:
    """1 - distance / longer length; -1 when either is empty."""
    longer = F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.when((a == "") | (b == ""), F.lit(-1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays in double precision; null when either is null or zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda i, j: i.cast("double") * j.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


@lru_cache(8192)
def text_sets(text: str, *sizes: int) -> tuple[frozenset[str], ...]:
    """The words of a text, and its n-grams of some sizes as functions.text.char_ngrams() has them."""
    p = f" {text} "
    return frozenset(t for t in text.split(" ") if t), *(frozenset(p[i : i + n] for i in range(len(p) - n + 1)) if len(text) >= n else frozenset() for n in sizes)


def _sizes(a: pd.Series, b: pd.Series, *grams: int) -> pd.DataFrame:
    names = ["words", *(f"char{n}" for n in grams)]
    out = np.full((len(a), 3 * len(names)), -1, np.int32)
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x is not None and y is not None:
            out[k] = [n for s, t in zip(text_sets(x, *grams), text_sets(y, *grams), strict=True) for n in (len(s & t), len(s), len(t))]
    found = pd.DataFrame(out, columns=[f"{side}_{n}" for n in names for side in "nlr"])
    return found.astype("Int32").mask(found < 0) if (out < 0).any() else found


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(f"{side}_{n}", T.IntegerType()) for n in names for side in "nlr"])


@F.pandas_udf(_struct("words", "char3", "char4"))
def name_sizes(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Sizes of the sets of two names (l_*, r_*) and of what they have in common (n_*); null where a name is."""
    return _sizes(a, b, 3, 4)


@F.pandas_udf(_struct("words", "char3"))
def address_sizes(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return _sizes(a, b, 3)
