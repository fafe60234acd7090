from __future__ import annotations

import numpy as np

from kinmatch.operators import nearest
from kinmatch.plans import catalog


def test_all_rows_are_searched(spark, tables, monkeypatch):
    """Against brute force over all rows, with one and with several blocks of queries."""
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = set()
    for a, r in enumerate(rows):
        if r["vec_id"] % 100 == 0:
            order = sorted((-round(float(c), 9), o["vec_id"]) for c, o in zip(x @ x[a], rows, strict=True) if o["vec_id"] != r["vec_id"])
            want |= {(r["vec_id"], o, k + 1) for k, (_, o) in enumerate(order[:5])}
    for block in (4096, 2):
        monkeypatch.setattr(nearest, "BLOCK", block)
        got = catalog.QUERIES["embedding_cosine_topk"](spark, tables).collect()
        assert {(r["vec_id"], r["other_id"], r["rank"]) for r in got} == want
