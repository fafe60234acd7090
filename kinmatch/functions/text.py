"""Unicode-safe text normalisation as column expressions.

Patterns name their classes (letters, numbers, white space), since `\\w`, `\\s` and `trim` mean ASCII in the JVM.
Missing text is the empty string throughout.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FULL, Profile

SPACE = r"[\s\p{Z}]"
WORD = r"[\p{L}\p{N}_]+"


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    """Canonical composition; text that is composed already comes back as it is."""
    return x.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def fold_accents(x: pd.Series) -> pd.Series:
    """Drops accents, and with them every letter that has no ASCII form."""
    return x.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFD", t).encode("ascii", "ignore").decode())


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"{SPACE}+", " "))


def tokens(c: Column) -> Column:
    """Words between single blanks; none for an empty text."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def expand(words: Column, abbreviations: dict[str, str]) -> Column:
    """Whole words replaced by what they stand for, joined by blanks."""
    known = F.create_map(*(F.lit(x) for pair in abbreviations.items() for x in pair))
    return F.array_join(F.transform(words, lambda t: F.coalesce(F.try_element_at(known, t), t)), " ")


def normalize(c: Column, abbreviations: dict[str, str], unicode: bool = False) -> Column:
    """Ampersands spelled, lower case, punctuation to blanks, blanks collapsed, abbreviations expanded.

    unicode: compose first. That is the one step outside the JVM; ASCII text doesn't need it.
    """
    c = nfc(c) if unicode else c
    c = F.lower(F.regexp_replace(c, rf"{SPACE}*&{SPACE}*", " and "))
    return expand(tokens(collapse(F.regexp_replace(c, r"[^\p{L}\p{N}_\s\-]", " "))), abbreviations)


def normalize_name(c: Column, profile: Profile = FULL, unicode: bool = False) -> Column:
    return normalize(c, profile.names, unicode)


def normalize_address(c: Column, profile: Profile = FULL, unicode: bool = False) -> Column:
    return normalize(c, profile.addresses, unicode)


def _runs(c: Column, pattern: str) -> Column:
    return F.filter(F.regexp_extract_all(c, F.lit(WORD), F.lit(0)), lambda t: t.rlike(pattern))


def postal_code(c: Column) -> Column:
    """First word of five or six digits, else empty."""
    return F.coalesce(F.get(_runs(c, r"^\p{Nd}{5,6}$"), F.lit(0)), F.lit(""))


def address_numbers(c: Column) -> Column:
    """All words of digits, in order, repeats kept."""
    return _runs(c, r"^\p{Nd}+$")


def char_ngrams(c: Column, n: int, padded: bool = True) -> Column:
    """Distinct n-grams of the text with a blank on either side; none for a text shorter than n."""
    p = F.concat(F.lit(" "), c, F.lit(" ")) if padded else c
    grams = F.transform(F.sequence(F.lit(1), F.length(p) - (n - 1)), lambda i: F.substring(p, i, n))
    return F.when(F.length(c) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def sorted_tokens(c: Column) -> Column:
    """Words in code point order, repeats kept."""
    return F.array_join(F.sort_array(tokens(c)), " ")


def country_norm(c: Column) -> Column:
    return strip(F.lower(c))


def preprocess(source: DataFrame, profile: Profile = FULL, unicode: bool = True, phonetics: bool = True) -> DataFrame:
    """The source columns with 20 derived ones; the source columns stay as they are."""
    from .phonetic import double_metaphone

    df = source.select("*", normalize_name(F.col("business_name"), profile, unicode).alias("name_clean"), normalize_address(F.col("business_address"), profile, unicode).alias("address_clean"))
    name, address = F.col("name_clean"), F.col("address_clean")
    fold = fold_accents if unicode else (lambda c: F.regexp_replace(c, r"[^\x00-\x7F]", ""))
    df = df.select(
        "*",
        fold(name).alias("name_folded"),
        tokens(name).alias("name_tokens"),
        sorted_tokens(name).alias("name_sorted"),
        F.substring(sorted_tokens(name), 1, profile.prefix_length).alias("name_prefix4"),
        *(char_ngrams(name, n).alias(f"name_char{n}") for n in (2, 3, 4)),
        F.coalesce(F.soundex(F.get(tokens(name), F.lit(0))), F.lit("")).alias("name_soundex"),
        fold(address).alias("address_folded"),
        tokens(address).alias("address_tokens"),
        sorted_tokens(address).alias("address_sorted"),
        char_ngrams(address, 3).alias("address_char3"),
        address_numbers(F.col("business_address")).alias("address_numbers"),
        postal_code(F.col("business_address")).alias("postal_code"),
        country_norm(F.col("country")).alias("country_norm"),
        F.concat(name, F.lit(" [SEP] "), address).alias("embedding_text"),
    )
    if phonetics:
        df = df.withColumn("_dm", double_metaphone(F.coalesce(F.get("name_tokens", F.lit(0)), F.lit(""))))
        df = df.select("*", F.col("_dm.primary").alias("name_dbl_meta_primary"), F.col("_dm.secondary").alias("name_dbl_meta_secondary")).drop("_dm")
    return df
