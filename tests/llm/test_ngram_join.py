from __future__ import annotations

import random
import re

import pytest
from brute import components, prose

from kinmatch.llm import ngram_join


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(zip(*[w[i:] for i in range(k)], strict=False)) if len(w) >= k else {tuple(w)} if w else set()


def plain(docs, k, percent):
    sets = {d: shingle_set(t, k) for d, t in docs if d is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    c = components(ids, links)
    return {d: (len(sets[d]), c[d]) for d in ids}


def agree(df, k, percent):
    docs = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = plain(docs, k, percent)
    rows = ngram_join.join(df, k, percent).collect()
    assert len(rows) == len(docs)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    return want


def test_edge_cases(edge, none):
    agree(edge, 3, 90)
    assert ngram_join.join(none).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_near_copies(spark, k, percent):
    """Groups of copies with ever more words changed, a chain among them, and a large group round one text."""
    rows = []
    for g in range(6):
        words = prose(g, 80 + 40 * g).split()
        for c in range(12):
            w = list(words)
            for j in range(c // 3):
                w[(17 * j + 5 * c) % len(w)] = f"new{g}-{c}-{j}"
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    chain = prose(50, 90).split()
    for c in range(15):
        chain[3 * c] = f"step{c}"
        rows.append((2000 + c, " ".join(chain)))
    base = prose(70, 100).split()
    for c in range(60):
        w = list(base)
        for j in range(1 + c % 3):
            w[(31 * c + 13 * j) % 100] = f"u{c}-{j}"
        rows.append((3000 + c, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = agree(df, k, percent)
    assert sum(c != d for d, (_, c) in want.items()) > 20


def near_misses(groups: int, each: int, seed: int = 5) -> list[tuple[int, str]]:
    """Variants of one text that mostly stay just below the threshold to each other, some of them nested in groups
    that share part of their changes."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for g in range(groups):
        shared = list(base)
        for _ in range(g % 4):
            shared[rng.randrange(120)] = f"g{g}-{rng.randrange(3)}"
        for c in range(each):
            w = list(shared)
            for _ in range(rng.choice((1, 2, 2, 3))):
                w[rng.randrange(120)] = f"v{rng.randrange(30)}"
            rows.append((len(rows) * 13 % 10_007, " ".join(w)))
    return rows


@pytest.mark.parametrize(("k", "percent", "more"), [(3, 90, {}), (5, 80, {}), (3, 96, {"small_bucket": 2, "large_bucket": 2}), (3, 95, {"levels": 0}), (3, 96, {"levels": 1, "small_bucket": 3, "large_bucket": 3})])
def test_a_large_group_just_below_the_threshold(spark, k, percent, more):
    rows = near_misses(12, 50)
    want = plain(rows, k, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), k, percent, **more).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 1 or percent < 95


def test_differences_from_a_hub_leave_few_pairs(spark):
    """600 texts round one, none linked with another: the pairs that are looked at stay far below all of them."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(900)}" for _ in range(100)]
    rows = []
    for c in range(600):
        w = list(base)
        for at in rng.sample(range(100), 3):
            w[at] = f"own{c}-{at}"
        rows.append((c, " ".join(w)))
    seen = []
    real = ngram_join._suffix_filtered
    ngram_join._suffix_filtered = lambda pairs, bins: (seen.append(pairs.count()), real(pairs, bins))[1]
    try:
        out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    finally:
        ngram_join._suffix_filtered = real
    assert {r["doc_id"]: r["component_id"] for r in out} == {d: c for d, (_, c) in plain(rows, 3, 90).items()}
    assert sum(seen) < 600 * 20


def test_supplied_documents(spark, tables):
    agree(spark.read.parquet(f"{tables}/documents.parquet"), 3, 90)
