"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

_WORDS = re.compile(common.WORD)


def apportion(weights: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Sainte-Laguë: seats go to the highest quotients weight / (2 * own seats + 1), none beyond `most`.

    A divisor is bisected until the rounded shares just stay below the seats; the last ones go one by one.
    Ties go to the first.
    """
    weights, most = np.asarray(weights, float), np.where(np.asarray(weights, float) > 0, most, 0).astype(np.int64)
    seats = int(min(seats, most.sum()))
    share = lambda d: np.minimum(most, np.floor(np.minimum(weights / d, 1e15) + 0.5).astype(np.int64))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)
    low, high = 0.0, 2 * weights.max() + 1.0  # at high nobody has a seat
    for _ in range(200):
        d = (low + high) / 2
        if d in (low, high):
            break
        low, high = (low, d) if share(d).sum() <= seats else (d, high)
    got = share(high)
    heap = [(-w / (2 * s + 1), i) for i, (w, s, m) in enumerate(zip(weights, got, most, strict=True)) if s < m]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def fill(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """Shares of the total by weight, none above most * size; an excess goes to the others by weight."""
    caps = most * sizes.astype(float)
    target, open_ = np.zeros(len(sizes)), caps > 0
    left = float(total)
    while open_.any():
        share = left * weights / weights[open_].sum()
        over = open_ & (share > caps)
        if not over.any():
            target[open_] = share[open_]
            break
        target[over] = caps[over]
        left -= caps[over].sum()
        open_ &= ~over
    return target


def spread(words: np.ndarray, seats: int, block: int, most: int, together: int = 4096) -> np.ndarray:
    """Quotas of shards in two levels: the seats go to runs of `together` shards first, then within each run."""
    n = -(-words // block)
    if len(words) <= together:
        return apportion(words, seats, most * n)
    cuts = np.arange(0, len(words), together)
    runs = apportion(np.add.reduceat(words, cuts), seats, most * np.add.reduceat(n, cuts))
    return np.concatenate([apportion(words[a : a + together], int(s), most * n[a : a + together]) for a, s in zip(cuts, runs, strict=True)])


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, shard_words: int = 1 << 18, largest_block: int = 64, seed: int = 9) -> DataFrame:
    """How many words of each document a mix of the sources takes, and which.

    Sources in code point order, null last, have the weights in turn. Together they give `share` times all
    words; a target stops at `most` times its source. Blocks hold equally many words: a 64th of the smallest
    source that has any, at most `largest_block`. Seats are apportioned to sources, then over a source's shards
    (documents dealt by a seeded hash, about `shard_words` words each), so that a shard knows its integer quota
    before any block is chosen. A shard's documents stand in seeded order; its quota is whole rounds of all
    blocks and then a run of blocks from a seeded start.

    Returns the columns doc_id, source, size, source_size, target, taken, text_hash, rounds (times that the whole
    document is taken) and parts (start, end: runs of its words that are taken once more). A null or empty text has
    size 0 and nothing is taken; a null source is a source of its own; repeated rows count each; an empty table
    gives no rows; extra columns are ignored. The table of sources and one source's table of shards, three numbers
    each, fit a task.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)).cast("long")
    sizes = common.scratch(docs.select(F.col("doc_id"), F.col("source"), words.alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))

    def sources(x: pd.DataFrame) -> pd.DataFrame:
        x = x.assign(null=x["source"].isna()).sort_values(["null", "source"], key=lambda c: c if c.name == "null" else c.map(lambda s: s.encode() if isinstance(s, str) else b""), ignore_index=True)
        size = x["source_size"].to_numpy(np.int64)
        w = np.asarray([weights[i % len(weights)] for i in range(len(x))], float)
        x["target"] = fill(size, w, share * size.sum(), most)
        block = int(np.clip(size[size > 0].min(initial=largest_block * 64) // 64, 1, largest_block))
        x["block"] = block
        x["shards"] = np.maximum(1, -(-size // shard_words))
        x["sid"] = np.arange(len(x))
        # a shard's last block may be short: there may be up to one more block for each shard
        x["seats"] = apportion(x["target"].to_numpy(), round(share * size.sum() / block), most * (-(-size // block) + x["shards"].to_numpy()))
        return x[["sid", "source", "source_size", "target", "block", "shards", "seats"]]

    per_source = common.scratch(totals.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(sources, "sid long, source string, source_size long, target double, block long, shards long, seats long"), "sources")
    order = F.xxhash64("doc_id", F.lit(seed))
    dealt = sizes.join(per_source, sizes["source"].eqNullSafe(per_source["source"])).select(sizes["doc_id"], sizes["source"], "size", "text_hash", "source_size", "target", "sid", "block", "seats", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed + 1)), F.col("shards")).alias("shard"), order.alias("at"))
    shards = dealt.groupBy("sid", "shard").agg(F.sum("size").alias("words"), F.first("block").alias("block"), F.first("seats").alias("seats"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))

    def quotas(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("shard", ignore_index=True)
        words, block = x["words"].to_numpy(np.int64), int(x["block"].iloc[0])
        n = -(-words // block)
        full = x["target"].iloc[0] >= most * x["source_size"].iloc[0]
        x["quota"] = most * n if full else spread(words, int(x["seats"].iloc[0]), block, most)
        x["blocks"] = n
        return x[["sid", "shard", "blocks", "quota"]]

    quota = common.scratch(shards.groupBy("sid").applyInPandas(quotas, "sid long, shard long, blocks long, quota long"), "quotas")
    w = Window.partitionBy("sid", "shard").orderBy("at", F.col("doc_id"), "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("start", F.coalesce(F.sum("size").over(w), F.lit(0))).join(quota, ["sid", "shard"])
    blocks = F.greatest("blocks", F.lit(1))
    run, first = F.col("quota") % blocks, F.pmod(F.xxhash64("sid", "shard", F.lit(seed + 2)), blocks)

    def part(a: Column, z: Column) -> Column:
        """The document's words in blocks a to z of its shard."""
        inside = lambda x: F.greatest(F.lit(0), F.least(F.col("size"), x * F.col("block") - F.col("start"))).cast("long")
        return F.struct(inside(a).alias("start"), inside(z).alias("end"))

    parts = F.filter(F.array(part(first, F.least(first + run, F.col("blocks"))), part(F.lit(0), first + run - F.col("blocks"))), lambda p: p["end"] > p["start"])
    placed = placed.withColumn("rounds", F.floor(F.col("quota") / blocks).cast("long")).withColumn("parts", parts)
    taken = F.col("rounds") * F.col("size") + F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["end"] - p["start"])
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "text_hash", "rounds", "parts")


def remix(docs: DataFrame, **how: object) -> DataFrame:
    """apply() of mix(), which keeps what the result reads alone."""
    with common.dropping(docs.sparkSession) as keep:
        return _applied(docs, mix(docs, **how), keep)


def apply(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Documents as the mix takes them: whole rounds repeat the row, a part of a round has the words of its blocks.

    A document of which nothing is taken goes. Columns stay, whatever their names; n_chars, where there is one,
    follows the text. Rows that repeat a doc_id and its text come from one of them, as often as all of them are taken.
    """
    return _applied(docs, mixed, lambda table: table)


def _applied(docs: DataFrame, mixed: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    doc, text, own, takes = (common.unused(docs.columns, x) for x in ("doc", "hash", "own", "takes"))
    # rows of one doc_id and text stand together in a shard: all but a few of them are taken in whole rounds
    each = mixed.where("taken > 0").groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(text))
    each = each.agg(F.struct(F.sum("rounds").alias("rounds"), F.flatten(F.collect_list(F.when(F.size("parts") > 0, F.col("parts")))).alias("parts"), F.count("*").alias("rows")).alias(takes))
    each = keep(common.scratch(each, "takes"))
    both = docs.withColumn(own, F.xxhash64("text")).join(each, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(text)))
    if each.where(F.col(takes)["rows"] > 1).take(1):
        many = F.col(takes)["rows"] > 1
        both = both.where(~many).unionAll(both.where(many).dropDuplicates([doc, text]))
    both = both.select(*(F.col(f"`{c}`") for c in docs.columns), takes)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for b in batches:
            rows, texts = [], []
            for i, (t, take) in enumerate(zip(b.column(at), b.column(b.num_columns - 1), strict=True)):
                t, take = t.as_py() or "", take.as_py()
                texts += [t] * take["rounds"]
                if take["parts"]:
                    found = [m.span() for m in _WORDS.finditer(t)]
                    texts += [t[found[p["start"]][0] if p["start"] else 0 : found[p["end"] - 1][1]] for p in take["parts"]]
                rows += [i] * (len(texts) - len(rows))
            columns = b.take(pa.array(rows, pa.int64())).columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            if chars >= 0:
                columns[chars] = pa.array(list(map(len, texts)), pa.int64()).cast(columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1])

    common.small_batches(docs.sparkSession)
    return both.mapInArrow(run, docs.schema)
