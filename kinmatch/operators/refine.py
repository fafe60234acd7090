"""What may follow a first model: calibration, ensembles, rule overrides, ablation and text variants. All optional."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import decide, evaluate


def platt(held: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores through a logistic curve that is fitted on held-out (score, label)."""
    vector = VectorAssembler(inputCols=["score"], outputCol="features")
    model = LogisticRegression(labelCol="label").fit(vector.transform(held))
    p = F.element_at(vector_to_array("probability"), 2)
    return model.transform(vector.transform(scores)).select("s1_id", "cand_id", p.alias("score"))


def isotonic(held: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores through a rising step curve that is fitted on held-out (score, label)."""
    model = IsotonicRegression(featuresCol="score", labelCol="label").fit(held.select("score", F.col("label").cast("double").alias("label")))
    return model.transform(scores).select("s1_id", "cand_id", F.col("prediction").alias("score"))


def blend(scores: list[DataFrame], weights: list[float]) -> DataFrame:
    """Weighted mean of several scorers; a pair that a scorer lacks counts 0 there."""
    parts = [s.select("s1_id", "cand_id", (F.col("score") * w / sum(weights)).alias("score")) for s, w in zip(scores, weights, strict=True)]
    return reduce(DataFrame.unionByName, parts).groupBy("s1_id", "cand_id").agg(F.sum("score").alias("score"))


def best_blend(scores: list[DataFrame], truth: DataFrame, grid: list[list[float]], threshold: float = 0.5) -> tuple[list[float], float]:
    """The weights of a small grid with the largest macro F0.5; the first of equal ones."""
    found = [(evaluate.macro_f05(decide.apply_threshold(blend(scores, w), threshold), truth).first()["macro_f05"], w) for w in grid]
    best = max(f for f, _ in found)
    return next(w for f, w in found if f == best), best


def override(matrix: DataFrame, scores: DataFrame, rules: list[tuple[Column, float]]) -> DataFrame:
    """Scores that the first fitting rule over the features sets; others stay."""
    set_ = reduce(lambda rest, rule: F.when(rule[0], F.lit(rule[1])).otherwise(rest), reversed(rules), F.lit(None).cast("double"))
    ruled = matrix.select("s1_id", "cand_id", set_.alias("_set"))
    return scores.join(ruled, ["s1_id", "cand_id"], "left").select("s1_id", "cand_id", F.coalesce("_set", "score").alias("score"))


def ablation(matrix: DataFrame, groups: dict[str, list[str]], measure: Callable[[DataFrame], float]) -> list[tuple[str, float]]:
    """What a measure of the whole matrix says, and of the matrix without each group of features."""
    return [("all", measure(matrix)), *((name, measure(matrix.drop(*columns))) for name, columns in groups.items())]


def drop_repeats(words: Column) -> Column:
    """Words without those that equal the one before."""
    return F.filter(words, lambda w, i: (i == 0) | (w != F.coalesce(F.get(words, F.greatest(i - 1, F.lit(0))), F.lit(""))))


def drop_stop_words(words: Column, stop: list[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(stop))


def subset_and_postal() -> Column:
    """The extra interaction of the lite profile, over feature columns."""
    return ((F.col("name_is_subset") == 1) & (F.col("postal_exact") == 1)).cast("int")


def missed_report(missed: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Missed true pairs with both names, and which blocking keys disagree."""
    left = s1.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"l_{c}") for c in ("name_clean", "postal_code", "name_prefix4", "country_norm")))
    right = pool.select(F.col("entity_id").alias("cand_id"), *(F.col(c).alias(f"r_{c}") for c in ("name_clean", "postal_code", "name_prefix4", "country_norm")))
    both = missed.join(left, "s1_id").join(right, "cand_id")
    differs = lambda c: F.when(F.col(f"l_{c}") != F.col(f"r_{c}"), c)
    reasons = F.array_join(F.array_compact(F.array(*map(differs, ("name_clean", "postal_code", "name_prefix4", "country_norm")))), ",")
    return both.select("s1_id", "cand_id", F.col("l_name_clean").alias("s1_name"), F.col("r_name_clean").alias("cand_name"), reasons.alias("differs"))
