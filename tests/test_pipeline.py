from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kinmatch.config import FULL, LITE
from kinmatch.functions.text import preprocess
from kinmatch.operators import blocking, decide, evaluate, features, learn, lsh, tfidf
from kinmatch.plans import catalog, pipeline
from kinmatch.sources import tables as T
from kinmatch.streaming import linkage

TRUTH = [("S1-001", "S2-010"), ("S1-001", "S3-020"), ("S1-002", None)]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, cand_id string")


def truth(spark, rows=TRUTH):
    return spark.createDataFrame(rows, "s1_id string, true_id string")


def test_golden_metric(spark):
    r = evaluate.macro_f05(pairs(spark, [("S1-001", "S2-010")]), truth(spark)).first()
    assert r["macro_f05"] == pytest.approx(0.9166666, abs=1e-4)
    assert (r["n_entities"], r["n_singletons"], r["n_multi"]) == (2, 1, 1)


@pytest.mark.parametrize(("rows", "true", "want"), [([], [("a", None)], 1.0), ([("a", "x")], [("a", None)], 0.0), ([], [("a", "x")], 0.0), ([("a", "x")], [("a", "x"), ("a", "y")], 0.8333), ([("a", "x"), ("a", "z")], [("a", "x")], 0.5556)])
def test_entity_f05(spark, rows, true, want):
    got = evaluate.entity_f05(pairs(spark, rows), truth(spark, true)).first()["f05"]
    assert got == pytest.approx(want, abs=1e-4)


def test_empty_recall(spark):
    assert evaluate.blocking_recall(pairs(spark, []), truth(spark, [("a", None)])).first()["blocking_recall"] == 1.0


def test_sweep_ties_take_the_lowest(spark):
    scores = pairs(spark, [("S1-001", "S2-010")]).withColumn("score", F.lit(0.5))
    best = evaluate.best_threshold(evaluate.threshold_sweep(scores, truth(spark))).first()
    assert best["threshold"] == 0.05


def test_sources_round_trip(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Foo ""Bar"" Inc"\t \tUS\nS2-2\tNA\t\t India\n', encoding="utf-8")
    rows = {r["entity_id"]: r for r in T.read_source(spark, str(p)).collect()}
    assert rows["S1-1"]["business_name"] == 'Foo "Bar" Inc'
    assert rows["S1-1"]["business_address"] == ""
    assert rows["S2-2"]["business_name"] == "NA"
    (tmp_path / "bad.tsv").write_text("a\tb\n1\t2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="missing columns"):
        T.read_source(spark, str(tmp_path / "bad.tsv"))


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Foo\nBar"\tx\tUS\nS2-2\t"a ""b"""\ty\tUS\n', encoding="utf-8")
    rows = {r["entity_id"]: r["business_name"] for r in T.read_source(spark, str(p)).collect()}
    assert rows == {"S1-1": "Foo\nBar", "S2-2": 'a "b"'}


def test_cache_is_a_profiles_own_and_whole(spark, tmp_path):
    full, lite = pipeline.artefacts(str(tmp_path), FULL), pipeline.artefacts(str(tmp_path), LITE)
    assert T.cached(spark, f"{full}/t", lambda: spark.range(3)).count() == 3
    assert T.cached(spark, f"{lite}/t", lambda: spark.range(5)).count() == 5
    assert T.cached(spark, f"{full}/t", lambda: spark.range(7)).count() == 3
    (tmp_path / full / "t" / "_SUCCESS").unlink()
    assert T.cached(spark, f"{full}/t", lambda: spark.range(7)).count() == 7


def test_lists_round_trip(spark, tmp_path):
    ids = spark.createDataFrame([("S1-2",), ("S1-1",)], "s1_id string")
    lists = T.match_lists(ids, pairs(spark, [("S1-1", "S3-1"), ("S1-1", "S2-9"), ("S1-1", "S2-9")]))
    T.write_lists(lists, str(tmp_path / "out"), single=True)
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9,S3-1\nS1-2\t\n"
    T.write_lists(lists, str(tmp_path / "parts"))
    parts = [x for f in sorted((tmp_path / "parts").glob("part-*.csv")) for x in f.read_text().splitlines()[1:]]
    assert parts == text.splitlines()[1:]
    back = T.ground_truth_pairs(T.read_ground_truth(spark, str(tmp_path / "out")))
    assert {tuple(r) for r in back.collect()} == {("S1-1", "S2-9"), ("S1-1", "S3-1"), ("S1-2", None)}


def test_ledger(spark, tmp_path):
    log = str(tmp_path / "ledger")
    assert T.list_submissions(spark, log).count() == 0
    T.save_snapshot(spark, [], str(tmp_path), "one", {"macro_f05": 0.9}, 0.5, log)
    T.log_submission(spark, log, "two", {}, 0.4)
    assert {r["submission_id"] for r in T.list_submissions(spark, log).collect()} == {"one", "two"}
    assert T.load_json(tmp_path / "one/local_metrics.json")["threshold"] == 0.5


def test_cap_drops_large_blocks_only(spark):
    rows = [(f"S2-{i}", "n", "a 12345", "US") for i in range(4)] + [("S1-1", "n", "b 12345", "US"), ("S1-2", "n", "b 54321", "US"), ("S2-9", "n", "c 54321", "US")]
    df = preprocess(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"), unicode=False, phonetics=False)
    s1, pool = df.where("entity_id LIKE 'S1-%'"), df.where("entity_id LIKE 'S2-%'")
    assert blocking.postal(s1, pool, cap=3).collect() == [("S1-2", "S2-9")]
    assert blocking.postal(s1, pool, cap=4).count() == 5


def test_preprocess_keeps_rows_and_raw(spark):
    rows = [("S1-1", "", "", ""), ("S1-2", "École & Fils", "1 rue", "France")]
    src = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    out = preprocess(src)
    assert {tuple(r[:4]) for r in out.collect()} == set(rows)
    assert len(out.columns) == 4 + 20
    twice = preprocess(src)
    assert out.exceptAll(twice).count() == 0


def test_lsh_recall(spark, tables):
    s1, pool = catalog.sides(spark, tables)
    grams = lambda d: {r["entity_id"]: set(r["sh"]) for r in d.select("entity_id", lsh.shingles(lsh.text_of(), 3).alias("sh")).collect()}
    a, b = grams(s1), grams(pool)
    near = {(i, j) for i, x in a.items() for j, y in b.items() if x and len(x & y) / len(x | y) >= 0.7}
    found = {tuple(r) for r in lsh.collisions(s1, pool).collect()}
    assert near and len(near & found) / len(near) > 0.95


def test_hashed_collisions_are_a_search(spark, tables):
    """The stated query set of S1 against the whole pool."""
    got = {r["s1_id"] for r in catalog.QUERIES["pass_f_minhash"](spark, tables).select("s1_id").distinct().collect()}
    assert got == {r["entity_id"] for r in catalog.sides(spark, tables)[0].select("entity_id").collect() if int(r["entity_id"][3:]) % 100 == 0}


def test_blank_records_do_not_collide(spark):
    df = spark.createDataFrame([("S1-1", "", ""), ("S2-1", "", "")], "entity_id string, name_clean string, address_clean string")
    assert lsh.collisions(df.limit(1), df).count() == 0


def test_char_terms_of_short_words(spark):
    got = {(r["term"], r["tf"]) for r in tfidf.terms(spark.createDataFrame([("a",)], "text string"), "char_wb", (2, 5)).collect()}
    assert got == {(" a", 1), ("a ", 1), (" a ", 1)}


def test_max_df_only_drops_common_terms(spark):
    docs = spark.createDataFrame([(f"S2-{i}", f"common word{i}") for i in range(10)], "entity_id string, text string")
    q = docs.limit(1)
    assert tfidf.top_k(q, docs, "word", (1, 1), 50).count() == 10
    assert tfidf.top_k(q, docs, "word", (1, 1), 50, max_df=0.5).count() == 1


def test_feature_count(spark, tables):
    s1, pool = catalog.sides(spark, tables, phonetics=True)
    m = features.build(catalog._candidates(s1, pool), s1, pool, catalog.truth(spark, tables))
    assert len([c for c in m.columns if c not in ("s1_id", "cand_id", "label", "pass_names", "name_jw")]) == 56
    assert len(features.feature_columns(m)) == 55


def test_split_is_exact_and_stable(spark):
    ids = spark.range(101).select(F.concat(F.lit("S1-"), "id").alias("s1_id"))
    counts = {r["split"]: r["count"] for r in learn.entity_split(ids).groupBy("split").count().collect()}
    assert counts == {"train": 70, "validation": 15, "test": 16}
    assert learn.entity_split(ids).exceptAll(learn.entity_split(ids)).count() == 0


def test_integrity_passes_on_sound_lists(spark):
    s1 = spark.createDataFrame([("S1-1",)], "entity_id string")
    pool = spark.createDataFrame([("S2-1",)], "entity_id string")
    found = pairs(spark, [("S1-1", "S2-1")])
    lists = T.match_lists(s1.select(F.col("entity_id").alias("s1_id")), found)
    assert decide.integrity(lists, s1, pool, found).count() == 0


def test_whole_pipeline(spark, tables, tmp_path):
    """Raw TSV to match lists and back."""
    e = catalog.entities(spark, tables).drop("same")
    for split in ("train", "test"):
        for k in (1, 2, 3):
            rows = e.where(F.col("entity_id").startswith(f"S{k}-")).toPandas()
            rows.to_csv(tmp_path / f"{split}_source{k}.tsv", sep="\t", index=False)
    catalog.truth_lists(spark, tables).toPandas().to_csv(tmp_path / "train_ground_truth.tsv", sep="\t", index=False)
    work = str(tmp_path / "work")
    model, threshold, meta = pipeline.train(spark, str(tmp_path), work, LITE)
    assert 0 < threshold < 1 and len(meta["features"]) == 55
    again = learn.Trained.load(f"{pipeline.artefacts(work, LITE)}/model")
    findings = pipeline.predict(spark, str(tmp_path), work, str(tmp_path / "out"), again, threshold, LITE)
    assert findings.count() == 0
    assert T.read_ground_truth(spark, str(tmp_path / "out/matching_results")).count() == e.where("entity_id LIKE 'S1-%'").count()


def test_stream_finds_what_the_batch_finds(spark, tables, tmp_path):
    s1, pool = catalog.sides(spark, tables, phonetics=True)
    s1.write.parquet(str(tmp_path / "in"))
    index = linkage.index(pool).persist()
    stream = spark.readStream.schema(s1.schema).parquet(str(tmp_path / "in"))
    q = linkage.candidates(stream, index).writeStream.format("memory").queryName("found").start()
    q.processAllAvailable()
    q.stop()
    got = {tuple(r) for r in spark.table("found").where("pass = 'A_exact'").select("s1_id", "cand_id").collect()}
    assert got == {tuple(r) for r in blocking.exact_name(s1, pool).collect()}
