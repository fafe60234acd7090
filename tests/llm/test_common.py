from __future__ import annotations

import random

import pyarrow as pa
from brute import components

from kinmatch.llm import common


def agree(spark, links):
    ids = sorted({x for p in links for x in p})
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["component"] for r in common.components(df).collect()}
    want = components(ids, links)
    assert {k: v for k, v in want.items() if k in got} == got
    # a node that is missing has no link to another
    assert all(want[i] == i for i in ids if i not in got)


def test_components(spark):
    r = random.Random(1)
    agree(spark, [(r.randrange(300), r.randrange(300)) for _ in range(220)])
    agree(spark, [(i, i + 1) for i in range(60)])
    agree(spark, [(500, i) for i in range(80)] + [(-3, -3), (-7, 4)])
    assert common.components(common.empty(spark, "u long, v long")).count() == 0


def test_bits_lose_no_id(spark):
    df = spark.createDataFrame([(i, "x") for i in [*range(0, 500, 3), None]], "doc_id long, text string")
    ids = df.where("doc_id % 2 = 0").select("doc_id")
    maybe, rest = common.by_bits(df, "doc_id", common.id_bits(ids, "doc_id"))
    assert ids.join(maybe, "doc_id", "left_anti").count() == 0
    assert maybe.count() + rest.count() == df.count()
    assert rest.join(ids, "doc_id").count() == 0


def test_counted(spark):
    df = spark.createDataFrame([(i % 7,) for i in range(100)], "k long").repartition(3)
    got = common.counted(df, lambda b: iter([b["k"].to_numpy().astype("uint64")]), 1024)
    assert got[:8].tolist() == [15, 15, 14, 14, 14, 14, 14, 0] and got.sum() == 100


def test_one_cache_at_a_time():
    a = common.held("a", list)
    assert common.held("a", list) is a
    common.held("b", list)
    assert common.held("a", list) is not a
    common.release("a")
    assert "a" in common._HELD
    common.release()
    assert not common._HELD


def test_null_ids_hash():
    assert len(common.mixed(pa.array([1, None, -5], pa.int64()))) == 3
