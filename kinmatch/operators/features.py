"""Pairwise features as one projection over the candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.fuzzy import address_ratios, name_ratios
from ..functions.text import tokens

#: Columns of either record that features look at.
RECORD = ("business_name", "name_clean", "address_clean", "postal_code", "address_numbers", "country_norm", "name_dbl_meta_primary", "name_dbl_meta_secondary")
#: Not inputs of the model.
LEARNED = ("label", "weight", "held")
EXCLUDED = ("s1_id", "cand_id", "pass_names", "passes_hit", *LEARNED)


def pairs(candidates: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates with both records as columns l_* and r_*; pairs with an unknown id drop out."""
    known = [c for c in RECORD if c in s1.columns]
    left = s1.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"l_{c}") for c in known))
    right = pool.select(F.col("entity_id").alias("cand_id"), *(F.col(c).alias(f"r_{c}") for c in known))
    return candidates.join(left, "s1_id").join(right, "cand_id")


def skipped(candidates: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """How many pairs have an id that is in no table."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.lit(1).alias("l")).distinct()
    b = pool.select(F.col("entity_id").alias("cand_id"), F.lit(1).alias("r")).distinct()
    both = candidates.join(a, "s1_id", "left").join(b, "cand_id", "left")
    return both.agg(F.count_if(F.col("l").isNull()).alias("unknown_s1"), F.count_if(F.col("r").isNull()).alias("unknown_pool"))


def _both(name: str) -> tuple[Column, Column]:
    return F.col(f"l_{name}"), F.col(f"r_{name}")


def _sets(name: str, kind: str) -> tuple[Column, Column, Column]:
    """Sizes of what the sets of either record have in common, and of both."""
    return tuple(F.col(f"_{name}_sizes")[f"{s}_{kind}"] for s in "nlr")


def _common(prefix: str, n: Column, a: Column, b: Column) -> dict[str, Column]:
    return {f"{prefix}_common_token_count": n, f"{prefix}_common_token_ratio": n / F.greatest(a, b, F.lit(1))}


def name_features() -> dict[str, Column]:
    """Without the fuzzy ratios, which come from one UDF."""
    (raw1, raw2), (n1, n2), words = _both("business_name"), _both("name_clean"), _sets("name", "words")
    first1, first2 = (F.get(tokens(c), F.lit(0)) for c in (n1, n2))
    return {
        "name_exact_raw": S.flag(F.lower(raw1) == F.lower(raw2)),
        "name_exact_clean": S.flag(n1 == n2),
        "name_jaccard_word": S.jaccard_of(*words),
        "name_jaccard_char3": S.jaccard_of(*_sets("name", "char3")),
        "name_jaccard_char4": S.jaccard_of(*_sets("name", "char4")),
        "name_levenshtein_norm": S.levenshtein_norm(n1, n2),
        **_common("name", *words),
        "name_length_ratio": S.length_ratio(n1, n2),
        "name_len_s1": F.length(n1),
        "name_len_s23": F.length(n2),
        "name_first_token_match": S.flag(first1 == first2),
        "name_is_subset": S.subset(*words),
    }


def address_features() -> dict[str, Column]:
    (a1, a2), (p1, p2), (d1, d2), words = _both("address_clean"), _both("postal_code"), _both("address_numbers"), _sets("address", "words")
    here, there = p1 != "", p2 != ""
    return {
        "address_exact": S.flag((a1 == a2) & (a1 != "")),
        "address_jaccard_word": S.jaccard_of(*words),
        "address_jaccard_char3": S.jaccard_of(*_sets("address", "char3")),
        "address_levenshtein_norm": S.levenshtein_norm(a1, a2),
        **_common("address", *words),
        "address_length_ratio": S.length_ratio(a1, a2),
        "postal_exact": S.flag(here & (p1 == p2)),
        "postal_prefix3_match": S.flag(here & there & (F.length(p1) >= 3) & (F.length(p2) >= 3) & (F.substring(p1, 1, 3) == F.substring(p2, 1, 3))),
        "both_have_postal": S.flag(here & there),
        "one_has_postal": S.flag(here != there),
        "address_number_overlap": S.jaccard(d1, d2),
        "house_number_exact": S.flag(F.array_min(d1) == F.array_min(d2)),
    }


def fuzzy_features() -> dict[str, Column]:
    """The feature named after Jaro-Winkler is the weighted ratio; the true one is name_jw."""
    n, a = F.col("_name"), F.col("_address")
    return {
        "name_jaro_winkler": n["wratio"], "name_ratio": n["ratio"], "name_partial_ratio": n["partial_ratio"],
        "name_token_sort_ratio": n["token_sort_ratio"], "name_token_set_ratio": n["token_set_ratio"], "name_jw": n["jaro_winkler"],
        "address_token_sort_ratio": a["token_sort_ratio"], "address_token_set_ratio": a["token_set_ratio"],
    }


def phonetic_features() -> dict[str, Column]:
    (p1, p2), (s1, s2) = _both("name_dbl_meta_primary"), _both("name_dbl_meta_secondary")
    primary, secondary = S.flag((p1 != "") & (p1 == p2)), S.flag((s1 != "") & (s1 == s2))
    return {"phonetic_primary_match": primary, "phonetic_secondary_match": secondary, "phonetic_any_match": F.greatest(primary, secondary)}


def retrieval_features() -> dict[str, Column]:
    """A score or rank of 0 counts as missing, as -1 does."""
    def seen(c: str, miss: object) -> Column:
        return F.coalesce(F.nullif(F.col(c), F.lit(0)), F.lit(miss))

    bs, br, cs, cr = seen("B_char_tfidf_score", -1.0), seen("B_char_tfidf_rank", -1), seen("C_token_tfidf_score", -1.0), seen("C_token_tfidf_rank", -1)
    positive = lambda c: F.when(c > 0, c)
    return {
        "B_char_score": bs, "B_char_rank": br, "C_token_score": cs, "C_token_rank": cr,
        "best_retrieval_rank": F.coalesce(F.least(positive(br), positive(cr)), F.lit(-1)),
        "best_retrieval_score": F.coalesce(F.greatest(positive(bs), positive(cs)), F.lit(-1.0)),
    }


def metadata_features() -> dict[str, Column]:
    (c1, c2), (n1, n2), (a1, a2) = _both("country_norm"), _both("name_clean"), _both("address_clean")
    out = {"country_equal": S.flag((c1 == c2) & (c1 != "")), "source_is_s2": S.flag(F.col("cand_id").startswith("S2-")), "source_is_s3": S.flag(F.col("cand_id").startswith("S3-"))}
    return out | {"name_missing_s1": S.flag(n1 == ""), "name_missing_s23": S.flag(n2 == ""), "addr_missing_s1": S.flag(a1 == ""), "addr_missing_s23": S.flag(a2 == "")}


def interaction_features(fuzzy: bool = True) -> dict[str, Column]:
    """Of features that are columns by now."""
    name, address = F.col("name_jaccard_word"), F.col("address_jaccard_word")
    out = {
        "high_name_and_exact_postal": S.flag((name > 0.7) & (F.col("postal_exact") == 1)),
        "high_name_and_high_address": S.flag((name > 0.6) & (address > 0.6)),
        "high_name_low_address": S.flag((name > 0.6) & (address < 0.3)),
        "low_name_high_address": S.flag((name < 0.3) & (address > 0.6)),
        "exact_name_disagree_addr": S.flag((F.col("name_exact_clean") == 1) & (address < 0.2)),
    }
    if fuzzy:
        out["phonetic_and_fuzzy_agree"] = S.flag((F.col("phonetic_any_match") == 1) & (F.col("name_token_set_ratio") > 0.7))
    return out


def labelled(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidates with a label: 1 where the pair is one of the true pairs (s1_id, true_id), else 0."""
    true = truth.where("true_id IS NOT NULL").select("s1_id", F.col("true_id").alias("cand_id"), F.lit(1).alias("_true")).distinct()
    return candidates.join(true, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("_true", F.lit(0))).drop("_true")


def build(candidates: DataFrame, s1: DataFrame, pool: DataFrame, truth: DataFrame | None = None, fuzzy: bool = True) -> DataFrame:
    """Feature matrix of the candidates, with a label where the true pairs (s1_id, true_id) are given.

    fuzzy: the ratios and phonetic features too, which need phonetic codes. Words and n-grams are compared in Arrow.
    Columns of learn.learning_rows() stay.
    """
    candidates = candidates if truth is None else labelled(candidates, truth)
    kept = [c for c in LEARNED if c in candidates.columns]
    df = pairs(candidates, s1, pool)
    df = df.withColumn("_name_sizes", S.name_sizes("l_name_clean", "r_name_clean")).withColumn("_address_sizes", S.address_sizes("l_address_clean", "r_address_clean"))
    columns = name_features() | address_features() | retrieval_features() | metadata_features()
    if fuzzy:
        df = df.withColumn("_name", name_ratios("l_name_clean", "r_name_clean")).withColumn("_address", address_ratios("l_address_clean", "r_address_clean"))
        columns |= fuzzy_features() | phonetic_features()
    df = df.select("s1_id", "cand_id", "passes_hit", "pass_names", *(c.alias(n) for n, c in columns.items()), *kept)
    return df.select(*(c for c in df.columns if c not in kept), *(c.alias(n) for n, c in interaction_features(fuzzy).items()), *kept)


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in EXCLUDED and c != "name_jw"]


def _words(c: str) -> Column:
    return F.array_distinct(tokens(F.col(f"{c}_clean")))


def word_sets() -> dict[str, Column]:
    """Columns of a record that word_scores() looks at besides its texts and its postal code: 64-bit hashes of its words."""
    return {f"{c}_words": F.transform(_words(c), lambda w: F.xxhash64(w)) for c in ("name", "address")}


def words_collide(records: DataFrame) -> bool:
    """Whether two different words of the records have one hash, so that word_sets() can't stand for the words."""
    words = records.select(F.explode(F.concat(*(F.coalesce(_words(c), F.array().cast("array<string>")) for c in ("name", "address")))).alias("word"))
    return bool(words.distinct().groupBy(F.xxhash64("word")).count().where("count > 1").take(1))


def word_scores(pairs: DataFrame) -> DataFrame:
    """Pairs with rule_score() as score, from word_sets() of either record, without the other features.

    Sizes are columns before they are looked at, so that words are compared once.
    """
    def known(c: str) -> Column:
        w1, w2 = _both(f"{c}_words")
        return w1.isNotNull() & w2.isNotNull()

    def sizes(c: str) -> dict[str, Column]:
        (t1, t2), (w1, w2) = _both(f"{c}_clean"), _both(f"{c}_words")
        return {f"_{c}_n": F.when(t1 == t2, F.size(w1)).when(known(c), F.size(F.array_intersect(w1, w2)))}

    def overlap(c: str) -> Column:
        w1, w2 = _both(f"{c}_words")
        return S.jaccard_of(F.col(f"_{c}_n"), F.when(known(c), F.size(w1)), F.when(known(c), F.size(w2)))

    p1, p2 = _both("postal_code")
    score = 0.5 * overlap("name") + 0.3 * overlap("address") + 0.2 * S.flag((p1 != "") & (p1 == p2))
    return pairs.withColumns(sizes("name") | sizes("address")).withColumn("score", score).drop("_name_n", "_address_n")


def rule_score() -> Column:
    """A deterministic scorer, where no model is wanted."""
    return 0.5 * F.col("name_jaccard_word") + 0.3 * F.col("address_jaccard_word") + 0.2 * F.col("postal_exact")
