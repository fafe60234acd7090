from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kinmatch.operators import refine


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(f"S1-{i}", f"S2-{i}", i / 40, int(i > 20)) for i in range(41)]
    return spark.createDataFrame(rows, "s1_id string, cand_id string, score double, label int")


@pytest.mark.parametrize("curve", [refine.platt, refine.isotonic])
def test_calibration_rises(scored, curve):
    out = [r["score"] for r in curve(scored, scored).orderBy(F.regexp_extract("s1_id", r"(\d+)", 1).cast("int")).collect()]
    assert out == sorted(out) and out[0] < 0.5 < out[-1]


def test_blend(scored):
    other = scored.withColumn("score", F.lit(1.0))
    r = {x["s1_id"]: x["score"] for x in refine.blend([scored, other], [3.0, 1.0]).collect()}
    assert r["S1-0"] == pytest.approx(0.25) and r["S1-40"] == pytest.approx(1.0)


def test_best_blend_takes_the_first_of_equals(scored):
    truth = scored.select("s1_id", F.when(F.col("label") == 1, F.col("cand_id")).alias("true_id"))
    weights, best = refine.best_blend([scored, scored], truth, [[1.0, 0.0], [0.0, 1.0]])
    assert weights == [1.0, 0.0] and best > 0.9


def test_override(scored):
    out = refine.override(scored, scored, [(F.col("score") > 0.9, 0.0), (F.col("score") > 0.5, 1.0)])
    r = {x["s1_id"]: x["score"] for x in out.collect()}
    assert (r["S1-40"], r["S1-30"], r["S1-4"]) == (0.0, 1.0, 0.1)


def test_ablation(scored):
    assert refine.ablation(scored, {"score": ["score"]}, lambda m: float(len(m.columns))) == [("all", 4.0), ("score", 3.0)]


def test_words(spark):
    df = spark.createDataFrame([(["a", "a", "b", "a", "the"],)], "w array<string>")
    assert df.select(refine.drop_repeats(F.col("w"))).first()[0] == ["a", "b", "a", "the"]
    assert df.select(refine.drop_stop_words(F.col("w"), ["the"])).first()[0] == ["a", "a", "b", "a"]


def test_sweep_counts_scores_beside_every_threshold(spark):
    from kinmatch.operators import evaluate

    steps = evaluate.grid()
    scores = [0.0, 1.0, -1.0, 2.0, None, *(t + d for t in steps for d in (0, 1e-12, -1e-12, 0.005))]
    df = spark.createDataFrame([(str(i), "c", v) for i, v in enumerate(scores)], "s1_id string, cand_id string, score double")
    truth = spark.createDataFrame([("0", "c")], "s1_id string, true_id string")
    got = {r["threshold"]: r["n_predictions"] for r in evaluate.threshold_sweep(df, truth).collect()}
    assert got == {round(t, 4): sum(v is not None and v >= t for v in scores) for t in steps}
