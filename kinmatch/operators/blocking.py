"""Candidate generation: every pass is an equi-join of S1 and the pool that yields (s1_id, cand_id).

Inputs are preprocessed tables. Where a pass caps its blocks, the cap is on the pool's rows of a key, counted
first, so that no large block ever meets the join. Keys are deduplicated within the join by its nature; no pass
compares rows without a shared key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FULL, Profile
from . import lsh, tfidf


def pool_of(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """UNION ALL of the noisy sources."""
    return s2.unionByName(s3)


def keyed_join(s1: DataFrame, pool: DataFrame, keys: dict[str, Column], cap: int | None = None) -> DataFrame:
    """Pairs that agree on all keys, none of them empty; keys of more than `cap` pool rows drop out."""
    left = s1.select(F.col("entity_id").alias("s1_id"), *(k.alias(n) for n, k in keys.items()))
    right = pool.select(F.col("entity_id").alias("cand_id"), *(k.alias(n) for n, k in keys.items()))
    full = reduce(lambda a, b: a & b, (F.col(n) != "" for n in keys if n != "country"), F.lit(True))
    left, right = left.where(full), right.where(full)
    if cap is not None:
        small = right.groupBy(*keys).count().where(F.col("count") <= cap).drop("count")
        left = left.join(small, list(keys))
    return left.join(right, list(keys)).select("s1_id", "cand_id").distinct()


def exact_name(s1: DataFrame, pool: DataFrame) -> DataFrame:
    return keyed_join(s1, pool, {"name": F.col("name_clean")})


def postal(s1: DataFrame, pool: DataFrame, cap: int = 500) -> DataFrame:
    return keyed_join(s1, pool, {"country": F.col("country_norm"), "postal": F.col("postal_code")}, cap)


def postal_narrow(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Also the first word of the name agrees; not capped."""
    first = F.coalesce(F.get(F.split("name_clean", " "), F.lit(0)), F.lit(""))
    return keyed_join(s1, pool, {"country": F.col("country_norm"), "postal": F.col("postal_code"), "first": first})


def phonetic(s1: DataFrame, pool: DataFrame, cap: int = 500) -> DataFrame:
    return keyed_join(s1, pool, {"country": F.col("country_norm"), "sound": F.col("name_dbl_meta_primary")}, cap)


def prefix(s1: DataFrame, pool: DataFrame, cap: int = 500) -> DataFrame:
    return keyed_join(s1, pool, {"country": F.col("country_norm"), "prefix": F.col("name_prefix4")}, cap)


def house_number(s1: DataFrame, pool: DataFrame, cap: int = 500) -> DataFrame:
    """Country and the smallest number of the address agree."""
    return keyed_join(s1, pool, {"country": F.col("country_norm"), "number": F.coalesce(F.array_min("address_numbers"), F.lit(""))}, cap)


def postal_prefix(s1: DataFrame, pool: DataFrame, cap: int = 500) -> DataFrame:
    """Country and the first three digits of the postal code agree."""
    return keyed_join(s1, pool, {"country": F.col("country_norm"), "pin": F.substring("postal_code", 1, 3)}, cap)


def repeats(df: DataFrame) -> bool:
    """Whether several rows share an id."""
    return bool(df.groupBy("entity_id").count().where("count > 1").take(1))


def keyed_pairs(s1: DataFrame, pool: DataFrame, columns: list[str], postal_cap: int = 500, prefix_cap: int = 500) -> DataFrame:
    """All pairs of the passes on exact name, postal code (both forms) and prefix, each once, with columns l_* and r_* of its records.

    Which passes find a pair (a_exact, d_postal, g_prefix) is read off its two records, so a pair leaves the first join that
    finds it and pairs are never shuffled to be made distinct. Ids must be unique on either side: see repeats().
    """
    first = F.coalesce(F.get(F.split("name_clean", " "), F.lit(0)), F.lit(""))
    keys = {"n": F.col("name_clean"), "c": F.col("country_norm"), "p": F.col("postal_code"), "f": first, "x": F.col("name_prefix4")}

    def side(df: DataFrame, name: str, tag: str) -> DataFrame:
        return df.select(F.col("entity_id").alias(name), *(F.col(c).alias(f"{tag}_{c}") for c in columns), *(k.alias(f"_{tag}{n}") for n, k in keys.items())).persist()

    left, right = side(s1, "s1_id", "l"), side(pool, "cand_id", "r")

    def small(key: str, cap: int) -> DataFrame:
        counts = right.where(F.col(f"_r{key}") != "").groupBy(F.col("_rc").alias("_lc"), F.col(f"_r{key}").alias(f"_l{key}")).count()
        return counts.where(F.col("count") <= cap).select("_lc", f"_l{key}", F.lit(True).alias(f"_small_{key}"))

    def agree(*names: str) -> Column:
        return reduce(lambda a, b: a & b, (F.col(f"_l{n}") == F.col(f"_r{n}") for n in names)) & reduce(lambda a, b: a & b, (F.col(f"_l{n}") != "" for n in names if n != "c"))

    no = F.lit(False)
    left = left.join(small("p", postal_cap), ["_lc", "_lp"], "left").join(small("x", prefix_cap), ["_lc", "_lx"], "left")
    exact = F.coalesce(agree("n"), no)
    broad = F.coalesce(F.col("_small_p") & agree("c", "p"), no) | F.coalesce(agree("c", "p", "f"), no)
    begun = F.coalesce(F.col("_small_x") & agree("c", "x"), no)
    found = [
        left.join(right, agree("n")),
        left.where("_small_p").join(right, agree("c", "p") & ~exact),
        left.where("_small_p IS NULL").join(right, agree("c", "p", "f") & ~exact),
        left.where("_small_x").join(right, agree("c", "x") & ~exact & ~broad),
    ]
    kept = ["s1_id", "cand_id", *(f"{tag}_{c}" for tag in "lr" for c in columns)]
    return reduce(DataFrame.union, (f.select(*kept, exact.alias("a_exact"), broad.alias("d_postal"), begun.alias("g_prefix")) for f in found))


def passes(s1: DataFrame, pool: DataFrame, profile: Profile = FULL) -> list[DataFrame]:
    """The profile's passes as (s1_id, cand_id, pass, score, rank)."""
    docs = [d.select("entity_id", F.col("name_clean").alias("text")) for d in (s1, pool)]

    def broad() -> DataFrame:
        found = postal(s1, pool, profile.postal_cap)
        return found.union(postal_narrow(s1, pool)).distinct() if profile.narrow_postal else found

    makers = {
        "A_exact": lambda: exact_name(s1, pool),
        "B_char_tfidf": lambda: tfidf.top_k(*docs, analyzer="char_wb", ngrams=profile.char_ngrams, k=profile.top_k),
        "C_token_tfidf": lambda: tfidf.top_k(*docs, analyzer="word", ngrams=profile.token_ngrams, k=profile.top_k),
        "D_postal": broad,
        "E_phonetic": lambda: phonetic(s1, pool, profile.phonetic_cap),
        "F_minhash": lambda: lsh.collisions(s1, pool, profile.permutations, profile.bands, profile.shingle),
        "G_prefix": lambda: prefix(s1, pool, profile.prefix_cap),
    }
    return [tagged(makers[p](), p) for p in profile.passes]


def tagged(pairs: DataFrame, name: str) -> DataFrame:
    score = F.col("score") if "score" in pairs.columns else F.lit(None)
    rank = F.col("rank") if "rank" in pairs.columns else F.lit(None)
    return pairs.select("s1_id", "cand_id", F.lit(name).alias("pass"), score.cast("double").alias("score"), rank.cast("int").alias("rank"))


def union_candidates(found: list[DataFrame], cap: int | None = 500) -> DataFrame:
    """One row for each pair with its passes and retrieval scores; at most `cap` pairs an S1 id, by passes hit.

    Ties in the cap go to the smaller candidate id.
    """
    every = reduce(DataFrame.unionByName, found)

    def of(name: str, column: str, miss: object) -> Column:
        return F.coalesce(F.max(F.when(F.col("pass") == name, F.col(column))), F.lit(miss)).alias(f"{name}_{column}")

    merged = every.groupBy("s1_id", "cand_id").agg(
        F.countDistinct("pass").cast("int").alias("passes_hit"),
        F.array_join(F.sort_array(F.collect_set("pass")), ",").alias("pass_names"),
        of("B_char_tfidf", "score", -1.0), of("C_token_tfidf", "score", -1.0), of("B_char_tfidf", "rank", -1), of("C_token_tfidf", "rank", -1),
    )
    return merged if cap is None else capped(merged, cap)


def capped(merged: DataFrame, cap: int) -> DataFrame:
    w = Window.partitionBy("s1_id").orderBy(F.desc("passes_hit"), "cand_id")
    return merged.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).drop("_n")


def run(s1: DataFrame, s2: DataFrame, s3: DataFrame, profile: Profile = FULL) -> DataFrame:
    """All passes of the profile, united and capped."""
    return union_candidates(passes(s1, pool_of(s2, s3), profile), profile.candidate_cap)
