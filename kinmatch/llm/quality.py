"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Everything that touches a text or a row is a built-in DataFrame function. The driver sees counts of vote
patterns only, at most 3 ** len(RULES) of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Words in a window whose repetition counts.
WINDOW = 8
#: Words in a block within which distinct ones are counted, so that a text's length doesn't change their share.
BLOCK = 200
#: A whole word of letters, with or without marks behind it.
PLAIN = r"(?<![^\x20\x09-\x0D])\p{L}+[.,;:!?]*(?![^\x20\x09-\x0D])"


def counts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id and what the rules look at.

    n_repeat_words counts the words that lie in a window of `window` words that stands in the text twice or more.
    Windows are compared by 64-bit hashes within their text; they are sorted, never paired.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(common.WORD)))
    plain = lambda marks: F.length("text") - F.length(F.translate("text", marks, ""))
    df = docs.select("doc_id", text.alias("text"))
    df = df.select("doc_id", "text", F.regexp_extract_all("text", F.lit(common.WORD), F.lit(0)).alias("words"), lines.alias("lines"))
    n = F.size("words")
    grams = F.when(n >= window, F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.xxhash64(F.slice("words", i, window)))).otherwise(F.array().cast("array<long>"))
    df = df.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        plain("#*$%&|<>").cast("long").alias("n_symbols"),
        plain("!").cast("long").alias("n_marks"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.aggregate(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int")), F.lit(0), lambda a, i: a + F.size(F.array_distinct(F.slice("words", i * BLOCK + 1, BLOCK)))).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(PLAIN)).cast("long").alias("n_plain"),
        grams.alias("grams"),
    )
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    df = df.withColumn("sorted", F.when(twice, F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("grams")
    same = lambda i, j: F.get("sorted", i)["h"] == F.get("sorted", j)["h"]
    seen = F.transform("sorted", lambda s, k: F.when(F.coalesce(same(k, k + 1), F.lit(False)) | F.coalesce((k > 0) & same(k, F.greatest(k - 1, F.lit(0))), F.lit(False)), s["i"]))
    df = df.withColumn("at", F.sort_array(F.array_compact(seen))).drop("sorted")
    gaps = F.transform("at", lambda p, k: F.least(F.lit(window), F.coalesce(F.get("at", k + 1) - p, F.lit(window))))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, g: a + g), F.lit(0)).cast("long")).drop("at")


def _vote(bad: Column, good: Column) -> Column:
    """2 votes for quality, 1 against, 0 abstains; an undefined comparison abstains."""
    return F.when(bad, 1).when(good, 2).otherwise(0)


def rules() -> dict[str, Column]:
    """Fixed rules on the counts; ratios are products, so that nothing is divided by zero."""
    c = F.col
    return {
        "symbols": _vote(c("n_symbols") * 10 > c("n_words") * 2, c("n_symbols") * 100 <= c("n_words") * 2),
        "windows": _vote(c("n_repeat_words") * 100 > c("n_words") * 30, c("n_repeat_words") * 100 <= c("n_words") * 10),
        "lines": _vote(c("n_dup_lines") * 100 > c("n_lines") * 40, (c("n_dup_lines") * 100 <= c("n_lines") * 10) & (c("n_lines") > 1)),
        "capitals": _vote(c("n_capitals") * 100 > c("n_letters") * 40, c("n_capitals") * 100 <= c("n_letters") * 15),
        "marks": _vote(c("n_marks") * 100 > c("n_words") * 30, c("n_marks") * 100 <= c("n_words") * 5),
        "variety": _vote(c("n_distinct") * 100 < c("n_words") * 25, (c("n_distinct") * 100 >= c("n_words") * 45) & (c("n_words") >= 20)),
        "letters": _vote(c("n_letters") * 100 < c("word_chars") * 80, c("n_letters") * 100 >= c("word_chars") * 90),
        "plain": _vote(c("n_plain") * 100 < c("n_words") * 55, c("n_plain") * 100 >= c("n_words") * 85),
        "length": _vote((c("word_chars") < c("n_words") * 2) | (c("word_chars") > c("n_words") * 20), (c("word_chars") >= c("n_words") * 3) & (c("word_chars") <= c("n_words") * 12)),
    }


#: What is imagined before any document is seen: P(vote | class) for abstain, against and for, and how many
#: documents of a class that is worth as a share of all.
PRIOR = {"good": (0.15, 0.005, 0.845), "bad": (0.10, 0.35, 0.55)}
PRIOR_SHARE = 0.2


def fit(patterns: dict[str, int], rounds: int = 60) -> tuple[float, dict[str, list[tuple[float, ...]]], dict[str, float]]:
    """EM over counted vote patterns: (share of quality, accuracies of each rule, posterior of each pattern).

    A rule's accuracies are its vote probabilities in either class; votes are independent given the class. They
    start from PRIOR, which also smooths every step, and a rule never votes against good documents more often
    than against bad ones, which keeps the meaning of the classes. The share of quality is at least a half.
    """
    n_rules = max((len(p) for p in patterns), default=0)
    total = sum(patterns.values())
    share, accuracy = 0.9, {k: [v] * n_rules for k, v in PRIOR.items()}
    posterior: dict[str, float] = {}
    weight = max(20.0, PRIOR_SHARE * total)
    for _ in range(rounds):
        for p in patterns:
            good, bad = math.log(share), math.log(1 - share)
            for j, v in enumerate(p):
                good += math.log(accuracy["good"][j][int(v)])
                bad += math.log(accuracy["bad"][j][int(v)])
            posterior[p] = 1 / (1 + math.exp(max(-700.0, min(700.0, bad - good))))
        seen = {k: [[weight * x for x in v] for _ in range(n_rules)] for k, v in PRIOR.items()}
        for p, m in patterns.items():
            for j, v in enumerate(p):
                seen["good"][j][int(v)] += m * posterior[p]
                seen["bad"][j][int(v)] += m * (1 - posterior[p])
        accuracy = {k: [tuple(x / sum(v) for x in v) for v in seen[k]] for k in seen}
        for j in range(n_rules):
            if accuracy["good"][j][1] > accuracy["bad"][j][1]:
                accuracy["good"][j] = accuracy["bad"][j] = tuple((x + y) / 2 for x, y in zip(accuracy["good"][j], accuracy["bad"][j], strict=True))
        if total:
            share = min(0.98, max(0.5, sum(posterior[p] * m for p, m in patterns.items()) / total))
    return share, accuracy, posterior


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Quality verdict of every document (doc_id, text).

    Returns the counts, base_failed (under 20 words, or more than 30 % of them in repeated windows), the votes,
    posterior and kept: posterior at least `threshold` and base not failed. A null or empty text counts nothing
    and fails; repeated rows are judged each; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    votes = F.concat(*(v.cast("string") for v in rules().values()))
    found = common.scratch(counts(common.only(docs, "doc_id", "text")).withColumn("votes", votes), "quality")
    patterns = {r["votes"]: r["count"] for r in found.groupBy("votes").count().collect()}  # at most 3 ** len(rules())
    _, _, posterior = fit(patterns)
    rows = ", ".join(f"('{p}', {x!r}D)" for p, x in sorted(posterior.items())) or "('', 0.5D)"
    known = spark.sql(f"SELECT * FROM VALUES {rows} AS t(votes, posterior)")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    out = found.join(F.broadcast(known), "votes", "left").withColumn("base_failed", failed)
    return out.withColumn("kept", ~failed & (F.col("posterior") >= threshold))
