from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinmatch.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, rows, tolerance=0.02):
    """Targets by the rule, taken words near them."""
    sizes = defaultdict(int)
    for d in docs:
        sizes[d["source"]] += size(d["text"])
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = dict(zip(names, [(3, 1, 2)[i % 3] for i in range(len(names))], strict=True))
    total, target, open_ = 1.5 * sum(sizes.values()), {}, {s for s in names if sizes[s]}
    while open_:
        share = {s: total * weights[s] / sum(weights[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in over} if over else share
        total -= sum(2 * sizes[s] for s in over)
        open_ = open_ - over if over else set()
    taken = defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target.get(r["source"], 0.0))
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target.get(s, 0)) <= max(2, tolerance * target.get(s, 0)), s


def test_edge_cases(spark, edge, none):
    rows = mixing.mix(edge).collect()
    check(edge.collect(), rows)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(edge.repartition(3)).collect()))
    assert mixing.mix(none).count() == 0
    assert mixing.mix(edge.where("text IS NULL")).first()["taken"] == 0


def test_supplied_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    check(docs.collect(), mixing.mix(docs).collect())
    check(docs.collect(), mixing.mix(docs, shard_words=5000).collect())


def test_apply_takes_what_the_mix_says(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    mixed = mixing.mix(docs)
    words = defaultdict(int)
    for r in mixing.apply(docs, mixed).collect():
        words[r["doc_id"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert dict(words) == {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}


def test_apply_emits_the_chosen_blocks(spark, tables):
    """Brute force: a shard's words in order, cut into blocks; its rounds and its run of blocks come out word by word."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    mixed = mixing.mix(docs, shard_words=20_000)
    texts = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") for r in docs.collect()}
    want, got = Counter(), Counter()
    for r in mixed.collect():
        want.update({(r["doc_id"], w): n * r["rounds"] for w, n in Counter(texts[r["doc_id"]]).items()})
        for p in r["parts"]:
            want.update((r["doc_id"], w) for w in texts[r["doc_id"]][p["start"] : p["end"]])
    for r in mixing.apply(docs, mixed).collect():
        got.update((r["doc_id"], w) for w in re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert got == +want
    assert any(p["start"] > 0 for r in mixed.collect() for p in r["parts"])


def test_any_column_names_and_repeated_rows(spark):
    rows = [(1, "a b c d e f g h", "x")] * 5 + [(1, "other text of that id", "x"), (None, "null id here", "x"), (None, "null id here", "x"), (2, "z " * 40, None), (3, None, "x")]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, text string, source string, _taken int, takes int, own int, hash int")
    mixed = mixing.mix(df)
    out = mixing.apply(df, mixed)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"]] += size(r["text"])
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r["doc_id"]] += r["taken"]
    assert dict(words) == {d: n for d, n in taken.items() if n}


def test_two_levels_give_all_seats():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 300, 1000)
    quota = mixing.spread(words, 3000, 10, 2, together=64)
    assert quota.sum() == 3000 and (quota <= 2 * -(-words // 10)).all()
    assert np.abs(quota - 3000 * words / words.sum()).max() < 3


def greedy(weights, seats, most):
    got = [0] * len(weights)
    for _ in range(min(seats, sum(m for w, m in zip(weights, most, strict=True) if w > 0))):
        i = max((i for i in range(len(weights)) if got[i] < most[i] and weights[i] > 0), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 40)), min_size=1, max_size=8), st.integers(0, 60))
def test_apportionment_is_the_greedy_one(parties, seats):
    w, m = [float(p[0]) for p in parties], [p[1] for p in parties]
    got = mixing.apportion(np.asarray(w), seats, np.asarray(m)).tolist()
    want = greedy(w, seats, m)
    assert sum(got) == sum(want)
    # equal but for ties of quotients
    assert sorted(w[i] / (2 * k - 1) for i, k in enumerate(got) if k) == pytest.approx(sorted(w[i] / (2 * k - 1) for i, k in enumerate(want) if k))


def test_published_example():
    """53, 24 and 23 thousand votes for seven seats give 3, 2, 2."""
    assert mixing.apportion(np.asarray([53.0, 24.0, 23.0]), 7, np.full(3, 99)).tolist() == [3, 2, 2]
