"""MinHash LSH collisions on character n-grams, banded and joined on band hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def text_of() -> Column:
    return strip(F.concat(F.col("name_clean"), F.lit(" "), F.col("address_clean")))


def shingles(c: Column, n: int) -> Column:
    """Distinct n-grams without padding."""
    grams = F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, n))
    return F.when(F.length(c) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def signature(c: Column, permutations: int, n: int) -> Column:
    """Minimum of a seeded 64-bit hash over the n-grams of a text, for every seed; null for a text shorter than n.

    Each n-gram is hashed once and then mixed with every seed. One Arrow call: an n-gram that is an expression makes the
    text anew for each of them.
    """
    seeds = np.random.default_rng(128).integers(0, 1 << 64, permutations, np.uint64)

    def mix(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(29))

    def least(t: str | None) -> np.ndarray | None:
        if t is None or len(t) < n:
            return None
        points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        h = np.zeros(len(t) - n + 1, np.uint64)
        for i in range(n):
            h = mix((h ^ points[i : i + len(h)]) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(1))
        return mix((np.unique(h)[:, None] ^ seeds) * np.uint64(0xFF51AFD7ED558CCD)).min(0).view(np.int64)

    @F.pandas_udf("array<long>")
    def minima(x: pd.Series) -> pd.Series:
        return x.map(least)

    return minima(c)


def bands(df: DataFrame, permutations: int, bands: int, n: int) -> DataFrame:
    """(entity_id, band, hash); records without an n-gram have none, so blank records don't collide."""
    rows = permutations // bands
    df = df.select("entity_id", signature(text_of(), permutations, n).alias("sig")).where("sig IS NOT NULL")
    each = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(b, F.slice("sig", b * rows + 1, rows)))
    return df.select("entity_id", F.posexplode(each).alias("band", "hash"))


def collisions(s1: DataFrame, pool: DataFrame, permutations: int = 128, n_bands: int = 32, n: int = 3) -> DataFrame:
    """Pairs (s1_id, cand_id) that agree on a band. 32 bands of 4 rows pass a similarity of about 0.42 half the time."""
    left = bands(s1, permutations, n_bands, n).withColumnRenamed("entity_id", "s1_id")
    right = bands(pool, permutations, n_bands, n).withColumnRenamed("entity_id", "cand_id")
    return left.join(right, ["band", "hash"]).select("s1_id", "cand_id").distinct()


