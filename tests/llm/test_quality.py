from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.llm import queries, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def agree(df):
    texts = Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    want = Counter((d, *plain(t)) for d, t in texts.elements())
    rows = quality.judge(df).collect()
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows) == want
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_edge_cases(spark, edge, none):
    agree(edge)
    assert quality.judge(none).count() == 0


def test_windows(spark):
    w = "a b c d e f g h".split()
    texts = [" ".join(w * 2), " ".join(w + ["x"] + w), " ".join(["q"] * 50), " ".join(w[:7] * 2), "\x0b".join(w * 3), " ".join(w + w[:3] + ["z"] * 9), "\n".join(["same line here"] * 4 + [" ", " "])]
    agree(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_supplied_documents(spark, tables):
    agree(spark.read.parquet(f"{tables}/documents.parquet"))


def test_no_python_on_the_main_path(spark, tables):
    plan = quality.counts(spark.read.parquet(f"{tables}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_labels(spark, tables):
    """Clean documents stay, junk goes."""
    folder = tables.replace("sf0.001", "sf0.01")
    judged = queries.op10_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("n_words >= 20")
    r = judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {x["quality"]: x["kept"] for x in r}
    assert kept[1] >= 0.99 and kept[0] <= 0.05


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.text("012", min_size=9, max_size=9), st.integers(1, 1000), max_size=20))
def test_em_is_bounded(patterns):
    share, accuracy, posterior = quality.fit(patterns)
    assert 0.5 <= share <= 0.98
    assert all(0 <= p <= 1 for p in posterior.values())
    assert all(g[1] <= b[1] + 1e-12 for g, b in zip(accuracy["good"], accuracy["bad"], strict=True))


def test_em_separates_planted_classes():
    patterns = {"222222222": 900, "220222222": 30, "111112222": 50, "121111111": 40}
    _, _, p = quality.fit(patterns)
    assert p["222222222"] > 0.9 and p["220222222"] > 0.9 and p["111112222"] < 0.1 and p["121111111"] < 0.1
