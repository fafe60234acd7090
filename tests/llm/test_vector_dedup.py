from __future__ import annotations

import numpy as np
from brute import components

from kinmatch.llm import vector_dedup


def plain(rows, least=0.9):
    good = {i: np.asarray(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    x = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids])
    near = x @ x.T >= least
    links = [(ids[a], ids[b]) for a in range(len(ids)) for b in range(a) if near[a, b]]
    c = components(ids, links)
    return {i: (int(near[k].sum()) - 1, c[i]) for k, i in enumerate(ids)}


def test_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(20):
        centre = rng.standard_normal(8)
        for _ in range(1 + g):
            rows.append((len(rows) * 3 % 1009, [float(np.float32(x)) for x in centre + 0.08 * rng.standard_normal(8)]))
    rows += [(5000 + i, rows[0][1]) for i in range(5)] + [(6000, [2 * x for x in rows[0][1]])]
    rows += [(7000, None), (7001, [0.0] * 8), (7002, [1.0] * 7), (7003, [float("nan")] + [1.0] * 7), (7004, [float("inf")] * 8), (7005, [None] + [1.0] * 7), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, component string, weight int")
    want = plain(rows)
    got = vector_dedup.dedup(df).collect()
    assert len(got) == len(rows)
    right = 0
    for r in got:
        if r["vec_id"] in want:
            n, c = want[r["vec_id"]]
            assert r["n_links"] <= n
            right += (r["n_links"], r["component_id"]) == (n, c)
            assert r["kept"] == (r["vec_id"] == r["component_id"])
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)
    assert right >= 0.95 * len(want)
    assert vector_dedup.dedup(df.limit(0)).count() == 0


def test_large_group_is_counted_whole(spark):
    """More vectors than a block: links beyond every window are counted."""
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.01 * rng.standard_normal(16)).tolist()) for i in range(vector_dedup.BLOCK + 300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_dedup.dedup(df, passes=2).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(len(rows) - 1, 0)}


def test_keys_keep_neighbours_together():
    maps = vector_dedup.rotations(8, 2, 1)
    assert np.allclose(maps[0] @ maps[0].T, np.eye(8))
    x = np.random.default_rng(2).standard_normal((4, 8))
    assert vector_dedup.sort_keys(x, maps) == vector_dedup.sort_keys(3 * x, maps)


def topic_pairs(pairs, cosine, dim=64, seed=11):
    """Isolated pairs, all round one topic (mutual cosine about 0.5): rows 2i and 2i + 1 lie at `cosine`."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    a = unit(unit(rng.standard_normal(dim)) + unit(rng.standard_normal((pairs, dim))))
    b = rng.standard_normal((pairs, dim))
    b = unit(b - np.einsum("ij,ij->i", a, b)[:, None] * a)
    return np.stack([a, cosine * a + np.sqrt(1 - cosine**2) * b], 1).reshape(-1, dim)


def test_no_isolated_pair_of_a_hot_topic_is_lost(spark):
    x = topic_pairs(1500, 0.905)
    df = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["component_id"] for r in vector_dedup.dedup(df).collect()}
    assert all(got[i] == got[i + 1] == i for i in range(0, len(x), 2))


def test_hashed_runs_are_compared_whole(spark):
    """Runs of several blocks, as large tables have them; pairs at the threshold are found as often as stated."""
    x = topic_pairs(4000, 0.901)
    df = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec long, embedding array<float>")
    p = vector_dedup.chance(64, 0.9)
    passes = int(np.ceil(np.log(0.001) / np.log(1 - p)))
    got = {(r["u"], r["v"]) for r in vector_dedup._runs(df, 64, 0.9, 1, passes).collect()}
    assert got <= {(i, i + 1) for i in range(0, len(x), 2)} and len(got) >= 0.995 * 4000


def test_comparisons_do_not_follow_the_number_of_rows(spark, monkeypatch):
    """The same keys and passes for ten rows and for more than were once compared whole."""
    seen = []
    none = lambda c, *a: spark.createDataFrame([], "u long, v long")
    monkeypatch.setattr(vector_dedup, "_passes", none)
    monkeypatch.setattr(vector_dedup, "_runs", lambda c, dim, least, hashes, passes: seen.append((hashes, passes)) or none(c))
    for n in (10, 20_000):
        x = np.random.default_rng(n).standard_normal((n, 64)).astype(np.float32)
        vector_dedup.dedup(spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<float>"))
    assert seen[0] == seen[1]


def test_short_and_long_runs_by_brute_force(spark):
    """One hash a key and all rows as one run give the links of all pairs, in short runs, long ones and blocks."""
    rng = np.random.default_rng(8)
    x = np.concatenate([np.repeat(rng.standard_normal((30, 4)), 1 + np.arange(30), 0) + 0.02 * rng.standard_normal((465, 4)), rng.standard_normal((800, 4))]).astype(np.float32)
    df = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec long, embedding array<float>")
    unit = vector_dedup.units(x.astype(float))
    near = unit @ unit.T >= 0.99
    keys = [vector_dedup.sort_keys(unit, vector_dedup.rotations(4, 1, 9000 + p)) for p in range(2)]
    same = np.any([[[a == b for b in k] for a in k] for k in keys], 0)
    for hashes, passes, links in ((0, 1, near), (1, 2, near & same)):
        got = [(r["u"], r["v"]) for r in vector_dedup._runs(df, 4, 0.99, hashes, passes).collect()]
        assert components(range(len(x)), got) == components(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.tril(links, -1)), strict=True)])
