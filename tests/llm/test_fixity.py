from __future__ import annotations

import hashlib

from kinmatch.llm import fixity

PAGES = "page_id long, url string, html string, file string, node int"


def pages(spark):
    rows = [(i, f"http://a/{i}" if i % 3 else None, "x" * (i % 50) + "é" if i % 4 else None, "f", 1) for i in range(0, 3000, 7)] + [(None, "u", "h", None, None), (7, "http://a/7", "again", None, None)]
    return spark.createDataFrame(rows, PAGES)


def found(rows):
    return {(r["record"], r["state"]) for r in rows}


def test_planted_damage_is_found(spark):
    a = fixity.records(pages(spark))
    rows = fixity.audit(a, fixity.damaged(a)).collect()
    ids = {r["record"] for r in a.collect()}
    want = {(i, "changed") for i in ids if i % 97 == 0} | {(i, "missing") for i in ids if i % 97 in (1, 2, 3)} | {(-i - 1, "extra") for i in ids if i % 97 == 2} | {(i, "extra") for i in ids if i % 97 == 3}
    assert found(rows) == want and len(rows) == len(want)
    # a record in a wrong file is found in both
    for i in (i for i in ids if i % 97 == 3):
        assert {(r["file"], r["state"]) for r in rows if r["record"] == i} == {(i // 1000, "missing"), (i // 1000 + 1, "extra")}


def test_descent_looks_only_below_what_differs(spark):
    from pyspark.sql import functions as F

    a = spark.range(20_000).select(F.floor(F.col("id") / 100).alias("file"), F.col("id").alias("record"), F.col("id").cast("string").alias("payload"))
    rows = fixity.audit(a, a.withColumn("payload", F.when(F.col("record") == 777, "x").otherwise(F.col("payload")))).collect()
    assert found(rows) == {(777, "changed")} and rows[0]["nodes_compared"] < 200


def test_offsets(spark):
    a = fixity.records(pages(spark))
    at, want = {}, {}
    for r in sorted(a.collect(), key=lambda r: r["record"]):
        want.setdefault(r["record"], at.get(r["file"], 0))
        at[r["file"]] = at.get(r["file"], 0) + len(r["payload"].encode())
    for r in fixity.audit(a, fixity.damaged(a)).collect():
        assert r["left_offset"] == (want.get(r["record"]) if r["state"] != "extra" else None)


def test_equal_replicas(spark):
    a = fixity.records(pages(spark))
    assert fixity.audit(a, a.repartition(3)).count() == 0


def test_empty(spark):
    a = fixity.records(pages(spark))
    none = a.limit(0)
    assert fixity.audit(none, none).count() == 0
    assert {r["state"] for r in fixity.audit(a, none).collect()} == {"missing"}
    assert {r["state"] for r in fixity.audit(none, a).collect()} == {"extra"}


def test_one_byte(spark):
    from pyspark.sql import functions as F

    a = fixity.records(pages(spark))
    b = a.withColumn("payload", F.when(F.col("record") == 1400, F.concat("payload", F.lit("!"))).otherwise(F.col("payload")))
    rows = fixity.audit(a, b).collect()
    assert found(rows) == {(1400, "changed")}
    payload = a.where("record = 1400").first()["payload"]
    assert rows[0]["left_hash"] == hashlib.sha256(payload.encode()).hexdigest()


def slow_root(rows, fanout, high):
    """The root by the definition: (file, record) leaves, ranges of records, files, ranges of files."""
    level = {(f, r): (len(p.encode()), hashlib.sha256(p.encode()).hexdigest()) for f, r, p in rows}
    for k in range(high[0] + high[1] + 1):
        up = {}
        for (f, n), x in sorted(level.items()):
            up.setdefault((f, n // fanout) if k < high[0] else (f, 0) if k == high[0] else (f // fanout, 0), []).append((f, n, *x))
        level = {}
        for key, kids in up.items():
            at, parts = 0, []
            for f, n, length, h in kids:
                parts.append(f"{f}:{n}:{at}:{length}:{h}")
                at += length
            level[key] = at, hashlib.sha256(",".join(parts).encode()).hexdigest()
    return level


def test_tree_by_brute_force(spark):
    a = fixity.records(pages(spark)).where("record <> 7")
    top = fixity.tree(a, 4, (6, 1))[-1].collect()
    want = slow_root([(r["file"], r["record"], r["payload"]) for r in a.collect()], 4, (6, 1))
    assert {(r["file"], r["node"]): (r["length"], r["hash"]) for r in top} == want


def test_root_depends_on_order_and_content(spark):
    a = fixity.records(pages(spark))
    roots = [fixity.tree(x, high=(3, 1))[-1].select("hash").collect() for x in (a, a.repartition(5), a.where("record <> 14"))]
    assert roots[0] == roots[1] != roots[2]
