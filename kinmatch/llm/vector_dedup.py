"""Embedding near-dedup by sorted projection passes over cross-polytope hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Vectors in one block of the exact count inside a component, and inside a run of equal keys.
BLOCK = 1024
#: Chance that whole runs bring together two vectors that lie just at the threshold.
RECALL = 0.999
#: Hashes of a key whose runs are compared whole, and the most passes that they may need.
RUN_HASHES, MOST_PASSES = 2, 64
#: Passes over whole runs in one job.
TOGETHER = 4
#: Runs of up to so many rows are compared together, longer ones one by one.
SHORT = 32


def rotations(dim: int, hashes: int, seed: int) -> np.ndarray:
    """Random orthogonal maps [hashes, dim, dim], the same wherever they are made."""
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(hashes)])


def sort_keys(unit: np.ndarray, maps: np.ndarray) -> list[bytes]:
    """Concatenated hashes of unit vectors: for each map the axis that lies closest, with its sign."""
    joined = np.stack([axes(unit, m).astype(">u2") for m in maps], 1)
    return [r.tobytes() for r in joined]


def axes(unit: np.ndarray, m: np.ndarray) -> np.ndarray:
    """One hash of unit vectors: twice the number of the closest axis, plus its sign."""
    y = unit @ m
    axis = np.abs(y).argmax(1)
    return axis * 2 + (y[np.arange(len(y)), axis] > 0)


def as_matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _passes(classes: DataFrame, dim: int, hashes: int, window: int, least: float, passes: int) -> DataFrame:
    """Pairs (u, v) of all passes: rows sorted by a pass's keys, each compared with the `window` rows before it.

    Sorting is by ranges, so a hot key is cut between tasks; the ends of every range come out as rows around a
    border (edge, at, vector), and the two sides of each border are compared afterwards.
    """
    swept = [_sweep(classes, dim, rotations(dim, hashes, 8000 + p), window, least).withColumn("pass", F.lit(p)) for p in range(passes)]
    swept = common.scratch(reduce(DataFrame.unionAll, swept), "passes")

    def meet(x: pa.Table) -> pa.Table:
        """Rows around one border: the last of the range before (at < 0) and the first of the range after."""
        x = x.sort_by("at")
        ids, vectors, at = x["u"].to_numpy(), units(np.stack([np.asarray(e, float) for e in x["embedding"].to_pylist()])), x["at"].to_numpy()
        u, v = _neighbours(ids, vectors, int((at < 0).sum()), window, least)
        after = set(ids[at >= 0].tolist())
        both = [(a, b) for a, b in zip(u, v, strict=True) if not (a in after and b in after)]
        return pa.table({"u": pa.array([a for a, _ in both], pa.int64()), "v": pa.array([b for _, b in both], pa.int64())})

    borders = swept.where("edge IS NOT NULL").select("pass", "edge", "u", "at", "embedding").groupBy("pass", "edge").applyInArrow(meet, "u long, v long")
    return swept.where("edge IS NULL").select("u", "v").unionAll(borders)


def _neighbours(ids: np.ndarray, x: np.ndarray, fresh: int, window: int, least: float) -> tuple[list[int], list[int]]:
    """Linked pairs of rows at most `window` apart of which the later is at `fresh` or after."""
    u, v = [], []
    for d in range(1, min(window, len(ids) - 1) + 1):
        at = np.arange(max(d, fresh), len(ids))
        hit = at[np.einsum("ij,ij->i", x[at], x[at - d]) >= least]
        u += ids[hit - d].tolist()
        v += ids[hit].tolist()
    return u, v


def _sweep(classes: DataFrame, dim: int, maps: np.ndarray, window: int, least: float) -> DataFrame:
    """One pass: linked pairs (u, v) within each range, and the ends of the ranges (u, edge, at, embedding)."""

    def keyed(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            if len(b["vec"]):
                yield {**b, "key": sort_keys(units(as_matrix(b["embedding"], dim)), maps)}

    def sweep(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids, x = np.zeros(0, np.int64), np.zeros((0, dim))
        head: list[tuple[int, list[float]]] = []
        for b in batches:
            new = as_matrix(b["embedding"], dim)
            own = b["vec"].to_numpy()
            if len(head) < window:
                head += [(i, e.tolist()) for i, e in zip(own.tolist(), new, strict=True)][: window - len(head)]
            fresh = len(ids)
            ids, x = np.concatenate([ids, own]), np.concatenate([x, units(new)])
            u, v = _neighbours(ids, x, fresh, window, least)
            yield {"u": u, "v": v, "edge": [None] * len(u), "at": [None] * len(u), "embedding": [None] * len(u)}
            ids, x = ids[-window:], x[-window:]
        tail = list(zip(ids.tolist(), x.tolist(), strict=True))
        rows = [(part, i, k, e) for k, (i, e) in enumerate(head)] + [(part + 1, i, k - len(tail), e) for k, (i, e) in enumerate(tail)]
        yield {"u": [r[1] for r in rows], "v": [None] * len(rows), "edge": [r[0] for r in rows], "at": [r[2] for r in rows], "embedding": [r[3] for r in rows]}

    sorted_ = common.map_batches(classes, keyed, "vec long, embedding array<float>, key binary").repartitionByRange("key", "vec").sortWithinPartitions("key", "vec")
    return common.map_batches(sorted_, sweep, "u long, v long, edge long, at long, embedding array<double>")


def _dealt(rows: DataFrame, group: str, many: int) -> DataFrame:
    """Deals the rows of a group into its `blocks` by a hash; every two blocks (a, b) meet in a unit of their own.

    Groups of one block share `many` units. Adds block, a, b, small and unit.
    """
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec", F.lit(3)), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    small = F.col("blocks") == 1
    unit = F.when(small, F.pmod(F.xxhash64(group, F.lit(5)), F.lit(many))).otherwise(F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other")))
    return dealt.select("*", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), small.alias("small"), unit.alias("unit"))


def chance(dim: int, least: float) -> float:
    """Low estimate of the share of pairs at cosine `least` that one hash keeps together."""
    rng = np.random.default_rng(7)
    hits, n, maps = 0, 2000, rotations(dim, 4, 7)
    for m in maps:
        a, b = units(rng.standard_normal((n, dim))), rng.standard_normal((n, dim))
        if dim > 1:
            b = units(b - np.einsum("ij,ij->i", a, b)[:, None] * a)
        near = least * a + np.sqrt(max(0.0, 1 - least * least)) * b
        hits += sum(x == y for x, y in zip(sort_keys(a, m[None]), sort_keys(near, m[None]), strict=True))
    p = hits / (n * len(maps))
    return max(0.0, p - 3 * float(np.sqrt(p * (1 - p) / (n * len(maps)))))


def plan_runs(dim: int, least: float) -> tuple[int, int]:
    """(hashes of a key, passes) of the whole-run comparison that reaches RECALL.

    Both follow the dimension and the threshold alone, never the rows, so that two vectors are linked or not by the
    same comparisons in a table of any size. Keys are shorter where RUN_HASHES would need more than MOST_PASSES
    passes; where one hash does too, no key is left and every two rows are compared, once.
    """
    p = chance(dim, least)
    for k in range(RUN_HASHES, 0, -1):
        q = p**k
        if q > 0:
            passes = 1 if q >= RECALL else int(np.ceil(np.log(1 - RECALL) / np.log1p(-q)))
            if passes <= MOST_PASSES:
                return k, passes
    return 0, 1


def _runs(classes: DataFrame, dim: int, least: float, hashes: int, passes: int) -> DataFrame:
    """Pairs (u, v) that join all linked rows of every run of equal keys, each run compared in full.

    Runs longer than a block are compared block by block. A task gives at most one pair for each of its rows: the
    row and the smallest one that its links reach there, so a large group never comes out as all its pairs.
    """
    out, total = [], classes.count()
    for first in range(0, passes, TOGETHER):
        these = [(p, rotations(dim, hashes, 9000 + p) if hashes else None) for p in range(first, min(passes, first + TOGETHER))]

        def keyed(batches: Iterator[dict], whole: bool, these: list = these) -> Iterator[dict]:
            for b in batches:
                if len(b["vec"]):
                    x = units(as_matrix(b["embedding"], dim)) if hashes else None
                    for p, maps in these:
                        # equal codes of different keys only make a run longer
                        run = np.full(len(b["vec"]), p, np.uint64)
                        if hashes:
                            for m in maps:
                                run = run * np.uint64(0x9E3779B97F4A7C15) + axes(x, m).astype(np.uint64) + np.uint64(1)
                        run = pa.array(run.view(np.int64))
                        yield {**b, "run": run} if whole else {"run": run}

        count = common.map_batches(classes, lambda b, f=keyed: f(b, False), "run long").groupBy("run").count()
        long = count.where(F.col("count") > BLOCK).select("run", F.ceil(F.col("count") / BLOCK).cast("long").alias("blocks"))
        long = common.scratch(long.coalesce(1) if hashes == 0 else long, "runs")
        rows = common.map_batches(classes, lambda b, f=keyed: f(b, True), "vec long, embedding array<float>, run long")
        rows = rows.join(long, "run", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
        many = max(1, total * len(these) // (2 * BLOCK))
        dealt = _dealt(rows, "run", many).select("vec", "embedding", "run", "block", "a", "b", "small", "unit")

        def join(x: pa.Table) -> pa.Table:
            run, a, b = (x[c].to_numpy() for c in ("run", "a", "b"))
            at = np.lexsort((b, a, run))
            run, a, b, ids, side = (c[at] for c in (run, a, b, x["vec"].to_numpy(), x["block"].to_numpy()))
            m = units(as_matrix(x["embedding"].combine_chunks(), dim)[at])
            starts = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            sizes = np.diff(np.r_[starts, len(at)])
            low = _lowest(ids, *_close_short(m, starts, sizes, np.where(a != b, side, -1), least))
            for s, n in zip(starts[sizes > SHORT], sizes[sizes > SHORT], strict=True):
                i, j = _close(m[s : s + n], side[s : s + n] if a[s] != b[s] else None, least)
                low[s : s + n] = _lowest(ids[s : s + n], i, j)
            return pa.table({"u": low[low != ids], "v": ids[low != ids]})

        out.append(common.scratch(dealt.groupBy("small", "unit").applyInArrow(join, "u long, v long"), "joined"))
    return reduce(DataFrame.unionAll, out)


def _close_short(m: np.ndarray, starts: np.ndarray, sizes: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i > j) of linked rows within the runs of up to SHORT rows; rows of one side >= 0 don't meet."""
    place = np.arange(len(m)) - np.repeat(starts, sizes)
    place[np.repeat(sizes > SHORT, sizes)] = 0
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, int(place.max(initial=0)) + 1):
        at = np.flatnonzero(place >= d)
        at = at[(side[at] != side[at - d]) | (side[at] < 0)]
        at = at[np.einsum("ij,ij->i", m[at], m[at - d]) >= least]
        i.append(at)
        j.append(at - d)
    return np.concatenate(i), np.concatenate(j)


def _close(m: np.ndarray, side: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i > j) of linked rows; with sides, only of rows of different sides."""
    i, j = [], []
    for at in range(0, len(m), 512):
        end = min(len(m), at + 512)
        close = np.tril(m[at:end] @ m[:end].T >= least, at - 1)
        if side is not None:
            close &= side[at:end, None] != side[:end]
        r, c = close.nonzero()
        i.append(r + at)
        j.append(c)
    return np.concatenate(i), np.concatenate(j)


def _lowest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches over the links (i, j)."""
    low = ids.copy()
    while len(i):
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        if (new == low).all():
            break
        low = new
    return low


def _links(members: DataFrame, least: float) -> DataFrame:
    """(vec, near): weight of the other classes of its component that lie at `least` or closer.

    Members are (vec, embedding, weight, component). A component's vectors are dealt into blocks by a hash and
    every two blocks meet once in a task of their own; small components share tasks. No pair leaves a task.
    """
    size = members.groupBy("component").agg(F.count("*").alias("size"))
    size = common.scratch(size.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("long")), "sizes")
    many = max(1, (size.agg(F.sum("size")).first()[0] or 0) // (8 * BLOCK))
    dealt = _dealt(members.join(size, "component"), "component", many).select("vec", "embedding", "weight", "component", "block", "a", "b", "small", "unit")

    def count(x: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, a, b), g in x.groupby(["component", "a", "b"], sort=False):
            m = units(np.stack(g["embedding"].to_numpy()).astype(np.float64))
            w, side = g["weight"].to_numpy(np.int64), g["block"].to_numpy()
            near = np.zeros(len(g), np.int64)
            for at in range(0, len(g), 512):
                close = m[at : at + 512] @ m.T >= least
                if a != b:
                    close &= side[at : at + 512, None] != side
                else:
                    close[np.arange(len(close)), np.arange(at, at + len(close))] = False
                near[at : at + 512] = close @ w
            out.append(pd.DataFrame({"vec": g["vec"].to_numpy(), "near": near}))
        return pd.concat(out)

    return dealt.groupBy("small", "unit").applyInPandas(count, "vec long, near long").groupBy("vec").agg(F.sum("near").alias("near"))


def dedup(vectors: DataFrame, least: float = 0.9, passes: int = 8, hashes: int = 3, window: int = 24, dim: int | None = None) -> DataFrame:
    """Near-duplicate groups of vectors (vec_id, embedding) by cosine in double precision.

    Equal vectors are a class first. In every pass the classes are sorted by concatenated random hashes and
    compared with their neighbours. Further passes compare every run of equal keys in full. Their key length and
    number follow the dimension and the threshold: a pair at `least` is brought together with a chance of RECALL,
    whatever the number of rows or their topics, small tables included. Links of all passes together give
    components. The links of a vector are then counted exactly within its component, block by block.

    Returns one row per vector: vec_id, n_links, component_id, kept. Vectors that are null, zero, of another
    length than `dim` (by default the most frequent one) or hold null or non-finite components link with nothing;
    a null vec_id too. Repeated rows count as vectors of their own; an empty table gives no rows; extra columns
    are ignored.
    """
    vectors = common.only(vectors, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<float>"))
    if dim is None:
        row = vectors.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
        dim = row["d"] if row else 0
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    sound = F.coalesce((F.size("embedding") == dim) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    named = vectors.withColumn("sound", sound)
    good = named.where("sound")
    # -0.0 becomes 0.0, so that equal vectors are equal arrays
    good = good.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")))
    classes = common.scratch(good.groupBy("embedding").agg(F.min("vec_id").alias("vec"), F.count("*").alias("weight")).select("vec", "embedding", "weight"), "classes")
    if dim:
        pairs = _passes(classes.select("vec", "embedding"), dim, hashes, window, least, passes)
        pairs = pairs.unionAll(_runs(classes.select("vec", "embedding"), dim, least, *plan_runs(dim, least)))
        component = common.scratch(common.components(pairs.distinct()), "component")
    else:
        component = common.empty(vectors.sparkSession, "node long, component long")
    members = classes.join(component.withColumnRenamed("node", "vec"), "vec")
    near = common.scratch(_links(members, least), "near")
    label = classes.join(component.withColumnRenamed("node", "vec"), "vec", "left").join(near, "vec", "left")
    label = common.scratch(label.select("embedding", "weight", F.coalesce("component", "vec").alias("component"), F.coalesce("near", F.lit(0)).alias("near")), "labels")
    out = good.select("vec_id", "embedding").join(label, "embedding").select("vec_id", (F.col("near") + F.col("weight") - 1).cast("long").alias("n_links"), F.col("component").alias("component_id"))
    rest = named.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionAll(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
