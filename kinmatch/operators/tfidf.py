"""TF-IDF and BM25 retrieval as a join on terms; the best k pool records of every query.

Texts are deduplicated on both sides before terms meet: equal names cost one row each, and ids come back after
the ranking. Frequencies still count every pool record. TF-IDF meets in blocks: each task has the texts of one block of
either side, multiplies their weights over the terms in common, and hands on the best of every query text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WORD

#: Texts of a side in one block of the search.
BLOCK = 512
#: More than rounding to nine decimals can move two scores apart.
SLACK = 2e-9


def terms(docs: DataFrame, analyzer: str, ngrams: tuple[int, int]) -> DataFrame:
    """(text, term, tf) of distinct texts.

    char_wb: n-grams of every word with a blank on either side, a word no longer than n once and no larger n.
    word: runs of two or more word characters, and their n-grams joined by blanks.
    """
    low, high = ngrams
    words = F.lower("text")
    if analyzer == "char_wb":
        padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
        df = docs.select("text", F.explode(F.split(words, r"\s+")).alias("w")).where("w <> ''").select("text", padded.alias("p"))
        df = df.select("text", "p", F.explode(F.sequence(F.least(F.lit(low), F.length("p")), F.least(F.lit(high), F.length("p")))).alias("n"))
        grams = F.transform(F.sequence(F.lit(1), F.length("p") - F.col("n") + 1), lambda i: F.substring(F.col("p"), i, F.col("n")))
        df = df.select("text", F.explode(grams).alias("term"))
    elif analyzer == "word":
        runs = F.filter(F.regexp_extract_all(words, F.lit(WORD), F.lit(0)), lambda t: F.length(t) >= 2)
        df = docs.select("text", runs.alias("w"))

        def joined(n: int) -> Column:
            grams = F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.array_join(F.slice("w", i, n), " "))
            return F.when(F.size("w") >= n, grams).otherwise(F.array().cast("array<string>"))

        df = df.select("text", F.explode(F.concat(*map(joined, range(low, high + 1)))).alias("term"))
    else:
        raise ValueError(f"no analyzer {analyzer}")
    return df.groupBy("text", "term").agg(F.count("*").alias("tf"))


@dataclass
class Index:
    """A fitted pool: its distinct texts with the number of records, idf of its terms, and weights of its texts."""

    texts: DataFrame
    idf: DataFrame
    weights: DataFrame
    analyzer: str
    ngrams: tuple[int, int]

    def weigh(self, docs: DataFrame) -> DataFrame:
        """(text, term, w): weights of other texts, terms outside the vocabulary dropped before they are scaled."""
        return _scaled(terms(docs.select("text").distinct(), self.analyzer, self.ngrams).join(self.idf, "term"))


def _scaled(df: DataFrame) -> DataFrame:
    w = (1 + F.log(F.col("tf").cast("double"))) * F.col("idf")
    df = df.select("text", "term", w.alias("w"))
    norm = df.groupBy("text").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return df.join(norm, "text").select("text", "term", (F.col("w") / F.col("norm")).alias("w"))


def fit(pool: DataFrame, analyzer: str, ngrams: tuple[int, int], max_df: float = 1.0) -> Index:
    """max_df below 1 leaves out terms of a larger share of the pool: the way to bound the join on common terms."""
    texts = pool.groupBy("text").agg(F.count("*").alias("records"))
    found = terms(texts.select("text"), analyzer, ngrams)
    total = pool.agg(F.count("*").alias("total"))
    df = found.join(texts, "text").groupBy("term").agg(F.sum("records").alias("df")).crossJoin(F.broadcast(total))  # one row
    if max_df < 1:
        df = df.where(F.col("df") <= F.col("total") * max_df)
    idf = df.select("term", (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf"))
    return Index(texts, idf, _scaled(found.join(idf, "term")), analyzer, ngrams)


def _ranked(scores: DataFrame, queries: DataFrame, pool: DataFrame, k: int) -> DataFrame:
    """From (text, cand, score) of texts to the best k records of each query record.

    The best k texts, ties by their smallest record, hold the best k records.
    """
    first = pool.groupBy("text").agg(F.min("entity_id").alias("first")).withColumnRenamed("text", "cand")
    by_text = Window.partitionBy("text").orderBy(F.desc("score"), "first")
    best = scores.withColumn("score", F.round("score", 9)).join(first, "cand").withColumn("_n", F.row_number().over(by_text)).where(F.col("_n") <= k)
    records = best.select("text", "cand", "score").join(pool.select(F.col("text").alias("cand"), F.col("entity_id").alias("cand_id")), "cand")
    order = Window.partitionBy("text").orderBy(F.desc("score"), "cand_id")
    top = records.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return queries.select("text", F.col("entity_id").alias("s1_id")).join(top, "text").select("s1_id", "cand_id", "score", "rank")


def _dense(texts: pa.Table, codes: np.ndarray, of: np.ndarray, width: int) -> np.ndarray:
    """[texts, terms in common]: weights at the terms that both sides of a block have."""
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(texts["w"]).to_numpy())
    out = np.zeros((len(texts), width))
    keep = of[codes] >= 0
    out[rows[keep], of[codes[keep]]] = pc.list_flatten(texts["w"]).to_numpy()[keep]
    return out


def search(index: Index, queries: DataFrame, pool: DataFrame, k: int) -> DataFrame:
    def packed(weights: DataFrame, query: bool) -> DataFrame:
        each = weights.groupBy("text").agg(F.collect_list(F.struct("term", "w")).alias("x"))
        return each.select("text", F.col("x.term").alias("term"), F.col("x.w").alias("w"), F.lit(query).alias("query"))

    def meet(x: pa.Table) -> pa.Table:
        sides = [x.filter(pc.equal(x["query"], side)).combine_chunks() for side in (True, False)]
        terms = [pc.list_flatten(t["term"]).combine_chunks() for t in sides]
        known = pc.unique(pa.concat_arrays(terms))
        codes = [pc.index_in(t, known).to_numpy(zero_copy_only=False) for t in terms]
        both = np.intersect1d(*codes)
        text, cand, score = [], [], []
        if len(both):
            of = np.full(len(known), -1)
            of[both] = np.arange(len(both))
            q, d = (_dense(t, c, of, len(both)) for t, c in zip(sides, codes, strict=True))
            dots = q @ d.T
            n = dots.shape[1]
            least = np.partition(dots, n - k, axis=1)[:, n - k, None] - SLACK if n > k else -1.0
            i, j = ((dots > 0) & (dots >= least)).nonzero()
            text, cand, score = sides[0]["text"].take(pa.array(i)), sides[1]["text"].take(pa.array(j)), dots[i, j]
        return pa.table({"text": pa.chunked_array(text, pa.string()), "cand": pa.chunked_array(cand, pa.string()), "score": pa.array(score, pa.float64())})

    asked, texts = queries.select("text").distinct(), index.texts
    nq, nd = (max(1, -(-df.count() // BLOCK)) for df in (asked, texts))
    block = lambda n: F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = packed(index.weigh(queries), True).select("*", block(nq).alias("qb"), all_of(nd).alias("db"))
    right = packed(index.weights, False).select("*", all_of(nq).alias("qb"), block(nd).alias("db"))
    scores = left.unionByName(right).repartition(nq * nd, "qb", "db").groupBy("qb", "db").applyInArrow(meet, "text string, cand string, score double")
    return _ranked(scores, queries, pool, k)


def top_k(queries: DataFrame, pool: DataFrame, analyzer: str, ngrams: tuple[int, int], k: int = 50, max_df: float = 1.0) -> DataFrame:
    """(s1_id, cand_id, score, rank): cosine of sublinear TF-IDF vectors (entity_id, text), fitted on the pool."""
    return search(fit(pool, analyzer, ngrams, max_df), queries, pool, k)


def bm25(queries: DataFrame, pool: DataFrame, k: int = 50, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(s1_id, cand_id, score, rank) by BM25 over words."""
    index = fit(pool, "word", (1, 1))
    found = terms(index.texts.select("text"), "word", (1, 1))
    length = found.groupBy("text").agg(F.sum("tf").alias("len"))
    stats = length.join(index.texts, "text").agg((F.sum(F.col("len") * F.col("records")) / F.sum("records")).alias("mean"))
    df = found.join(index.texts, "text").groupBy("term").agg(F.sum("records").alias("df"))
    total = pool.agg(F.count("*").alias("total"))
    idf = F.log(1 + (F.col("total") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf: Column = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    weights = found.join(length, "text").join(df, "term").crossJoin(F.broadcast(stats)).crossJoin(F.broadcast(total)).select(F.col("text").alias("cand"), "term", (idf * tf).alias("w"))
    asked = terms(queries.select("text").distinct(), "word", (1, 1)).select("text", "term")
    scores = asked.join(weights, "term").groupBy("text", "cand").agg(F.sum("w").alias("score"))
    return _ranked(scores, queries, pool, k)
