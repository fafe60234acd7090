from __future__ import annotations

import math
import re
from collections import Counter

from kinmatch.operators import tfidf


def plain(queries, pool, k):
    """Best k records of every query, by word unigrams, straight from the definition."""
    bag = lambda t: Counter(w for w in re.findall(r"\w+", t) if len(w) > 1)
    df = Counter(w for _, t in pool for w in bag(t))
    idf = {w: math.log((1 + len(pool)) / (1 + n)) + 1 for w, n in df.items()}

    def weights(t):
        w = {x: (1 + math.log(n)) * idf[x] for x, n in bag(t).items() if x in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        return {x: v / norm for x, v in w.items()}

    out = set()
    for q, text in queries:
        a = weights(text)
        found = [(round(sum(v * b[x] for x, v in a.items() if x in b), 9), c) for c, t in pool for b in [weights(t)] if a.keys() & b.keys()]
        out |= {(q, c, s, n + 1) for n, (s, c) in enumerate(sorted(found, key=lambda x: (-x[0], x[1]))[:k])}
    return out


def test_blocks_of_texts_lose_no_neighbour(spark, monkeypatch):
    """Many blocks on either side, equal scores, equal texts, and queries without a known word."""
    monkeypatch.setattr(tfidf, "BLOCK", 7)
    words = ["hot", "cold", "bolt", "ring", "plate", "blue", "steel"]
    pool = [(f"p{i:03}", f"{words[i % 7]} {words[i * 3 % 5]} {words[i // 9 % 7]} n{i % 11:02}") for i in range(90)]
    queries = [(f"q{i}", f"{words[i % 7]} {words[i % 5]} n{i % 13:02}") for i in range(30)] + [("q98", "unheard"), ("q99", "")]
    q, p = (spark.createDataFrame(x, "entity_id string, text string") for x in (queries, pool))
    got = {(r["s1_id"], r["cand_id"], r["score"], r["rank"]) for r in tfidf.top_k(q, p, "word", (1, 1), 6).collect()}
    assert {(a, b, n) for a, b, _, n in got} == {(a, b, n) for a, b, _, n in plain(queries, pool, 6)}
    assert {round(s, 8) for *_, s, _ in got} <= {round(s, 8) for *_, s, _ in plain(queries, pool, 6)}
