"""Orchestration: profile, train, predict, or all of them; also a command line."""

from __future__ import annotations

import argparse
import hashlib
import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FULL, LITE, Profile
from ..functions.text import preprocess
from ..operators import blocking, decide, evaluate, features, learn, profile
from ..sources import tables


def report(spark: SparkSession, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame) -> dict:
    """The profile of the inputs as one nested dictionary; every part is a small aggregate."""
    named = {"s1": s1, "s2": s2, "s3": s3}
    rows = lambda df: [r.asDict() for r in df.collect()]
    return {
        "rows": rows(profile.row_counts(named | {"truth": truth})), "matches": rows(profile.match_summary(truth))[0], "distribution": rows(profile.match_distribution(truth, 20)),
        "countries": rows(profile.country_distribution(named)), "mix": rows(profile.source_mix(truth))[0], "blank": rows(profile.blank_rates(s1)), "duplicates": rows(profile.duplicates(named)), "lengths": rows(profile.text_lengths(s1)),
    }


def artefacts(work: str, options: Profile) -> str:
    """The folder of a profile's tables and models: another profile never finds them."""
    return f"{work}/{hashlib.md5(json.dumps(asdict(options), sort_keys=True).encode()).hexdigest()[:12]}"


def prepare(spark: SparkSession, folder: str, split: str, work: str, options: Profile) -> list[DataFrame]:
    """The three sources of a split, preprocessed once and kept in the profile's folder."""
    work, out = artefacts(work, options), []
    for k in (1, 2, 3):
        path = f"{folder}/{split}_source{k}.tsv"
        out.append(tables.cached(spark, f"{work}/{split}_source{k}.parquet", lambda p=path, k=k: preprocess(tables.read_source(spark, p, f"source {k}"), options)))
    return out


def train(spark: SparkSession, folder: str, work: str, options: Profile = FULL) -> tuple[learn.Trained, float, dict]:
    """Blocking, features, model and threshold; artefacts go to the profile's folder and are found there again."""
    s1, s2, s3 = prepare(spark, folder, "train", work, options)
    work = artefacts(work, options)
    truth = tables.ground_truth_pairs(tables.read_ground_truth(spark, f"{folder}/train_ground_truth.tsv"))
    candidates = tables.cached(spark, f"{work}/train_candidates.parquet", lambda: blocking.run(s1, s2, s3, options))
    recall = evaluate.blocking_recall(candidates, truth).first().asDict()
    tables.write_csv(evaluate.missed_pairs(candidates, truth), f"{work}/missed_true_pairs")
    pool = blocking.pool_of(s2, s3)
    matrix = tables.cached(spark, f"{work}/train_features.parquet", lambda: features.build(candidates, s1, pool, truth))
    split = tables.cached(spark, f"{work}/split.parquet", lambda: learn.entity_split(s1.select(F.col("entity_id").alias("s1_id")), options.train_share, options.validation_share, options.seed))
    part = lambda name: split.where(F.col("split") == name)
    model = learn.train(matrix, part("train"), part("validation"), options.negatives_per_positive, seed=options.seed)
    held = truth.join(part("validation"), "s1_id", "left_semi")
    scores = model.score(matrix.join(part("validation"), "s1_id", "left_semi"))
    best = evaluate.best_threshold(evaluate.threshold_sweep(scores, held, *options.thresholds)).first().asDict()
    test = part("test")
    final = decide.apply_threshold(model.score(matrix.join(test, "s1_id", "left_semi")), best["threshold"])
    tested = evaluate.macro_f05(final, truth.join(test, "s1_id", "left_semi")).first().asDict()
    model.save(f"{work}/model")
    meta = {"features": model.columns, "threshold": best["threshold"], "validation": best, "test": tested, "blocking": recall, "importance": model.importance(), "profile": asdict(options)}
    tables.save_json(meta, f"{work}/experiment.json")
    return model, best["threshold"], meta


def predict(spark: SparkSession, folder: str, work: str, out: str, model: learn.Trained, threshold: float, options: Profile = FULL, by_country: dict[str, float] | None = None, fallback: float | None = None, single: bool = False) -> DataFrame:
    """Match lists and candidate lists of the test split as TSV; returns the findings of the integrity checks."""
    s1, s2, s3 = prepare(spark, folder, "test", work, options)
    work = artefacts(work, options)
    pool, ids = blocking.pool_of(s2, s3), s1.select(F.col("entity_id").alias("s1_id"))
    candidates = tables.cached(spark, f"{work}/test_candidates.parquet", lambda: blocking.run(s1, s2, s3, options))
    matrix = tables.cached(spark, f"{work}/test_features.parquet", lambda: features.build(candidates, s1, pool))
    countries = s1.select(F.col("entity_id").alias("s1_id"), "country_norm")
    chosen = decide.apply_threshold(model.score(matrix), threshold, countries, by_country, fallback)
    lists = tables.match_lists(ids, decide.autofix(chosen, pool, candidates))
    tables.write_lists(lists, f"{out}/matching_results", single)
    tables.write_lists(tables.match_lists(ids, candidates, "candidate_entity_ids"), f"{out}/candidate_pairs", single)
    return decide.integrity(lists, s1, pool, candidates)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--mode", choices=("eda", "train", "predict", "full"), required=True)
    parser.add_argument("--data", required=True, help="folder of the TSV files")
    parser.add_argument("--work", required=True, help="folder of artefacts")
    parser.add_argument("--out", help="folder of results; the work folder by default")
    parser.add_argument("--threshold", type=float, help="instead of the one found in training")
    parser.add_argument("--single-file", action="store_true", help="each result as one file")
    parser.add_argument("--profile", choices=("full", "lite"), default="full")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("kinmatch").getOrCreate()
    options = LITE if a.profile == "lite" else FULL
    if a.mode in ("eda", "train", "full"):
        s1, s2, s3 = (tables.read_source(spark, f"{a.data}/train_source{k}.tsv") for k in (1, 2, 3))
        found = report(spark, s1, s2, s3, tables.read_ground_truth(spark, f"{a.data}/train_ground_truth.tsv"))
        tables.save_json(found, f"{a.work}/eda_report.json")
        print(json.dumps(found, indent=2, ensure_ascii=False))
    model, threshold = None, a.threshold
    if a.mode in ("train", "full"):
        model, best, _ = train(spark, a.data, a.work, options)
        threshold = best if threshold is None else threshold
    if a.mode in ("predict", "full"):
        model = model or learn.Trained.load(f"{artefacts(a.work, options)}/model")
        if threshold is None:
            threshold = tables.load_json(f"{artefacts(a.work, options)}/experiment.json")["threshold"]
        predict(spark, a.data, a.work, a.out or a.work, model, threshold, options, single=a.single_file).show(50, False)


if __name__ == "__main__":
    main()
