"""Exact search for nearest vectors by cosine, queries against all rows in blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are broadcast at once.
BLOCK = 4096


def _matrix(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def top_k(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, other_id, cos, rank): the k nearest other rows of every query; both sides are (vec_id, embedding).

    A block of queries goes to every task, which keeps its own k best of each; those alone are merged. Ties, to nine
    decimals, go by the smaller id. Rows without an id or a vector take no part; a zero vector has cosine 0.
    """
    rows, queries = (x.where("vec_id IS NOT NULL AND embedding IS NOT NULL") for x in (rows, queries))
    blocks = max(1, -(-queries.count() // BLOCK))
    found = []
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        sent = rows.sparkSession.sparkContext.broadcast(([r["vec_id"] for r in block], [r["embedding"] for r in block]))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, vectors = np.array(sent.value[0], np.int64), sent.value[1]
            if not len(ids):
                return
            q = _matrix(vectors)
            best: list[list[tuple[float, int, float]]] = [[] for _ in ids]
            for batch in batches:
                own = batch.column(0).to_numpy()
                if not len(own):
                    continue
                x = _matrix(batch.column(1).to_pylist())
                for i, cos in enumerate(q @ x.T):
                    rounded = np.round(cos, 9)
                    rounded[own == ids[i]] = -2
                    # at least the k best with all that tie with the last
                    at = np.flatnonzero(rounded >= np.partition(rounded, -k)[-k]) if len(own) > k else np.arange(len(own))
                    best[i] = sorted(best[i] + [(-rounded[j], int(own[j]), cos[j]) for j in at if rounded[j] > -2])[:k]
            out = [(int(i), o, float(c)) for i, b in zip(ids, best, strict=True) for _, o, c in b]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["vec_id", "other_id", "cos"])

        found.append(rows.select("vec_id", "embedding").mapInArrow(search, "vec_id long, other_id long, cos double"))
    w = Window.partitionBy("vec_id").orderBy(F.desc(F.round("cos", 9)), "other_id")
    return reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
