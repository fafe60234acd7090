"""Shared pieces: scratch tables, bounded broadcasts, Arrow batches and connected components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code points that separate words in every contract: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables; any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session, or a local one of our own where none is set (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        folder = tempfile.mkdtemp(prefix="kinmatch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


#: Rows of small scratch tables that a file holds at most, where an upper bound of the rows is known.
ROWS_A_FILE = 500_000


def scratch(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Cuts the lineage: writes a table to the shared folder and reads it back.

    rows: an upper bound of the rows, where one is known, so that a small table isn't written as many tiny files.
    A lost executor costs nothing that was written; drop_scratch() removes the application's tables.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if open_ := getattr(_MADE, "open", None):
        open_[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


_MADE = threading.local()


@contextlib.contextmanager
def dropping(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Drops the scratch tables that are made within, but those given to keep(): the ones that a result still reads."""
    _MADE.open = [*getattr(_MADE, "open", []), []]
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._scratch)
        return df

    try:
        yield keep
    finally:
        made = _MADE.open.pop()
        for path in made:
            if path not in kept:
                _delete(spark, path)
        if _MADE.open:
            _MADE.open[-1].extend(p for p in made if p in kept)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Removes every scratch table of this application."""
    _delete(spark, scratch_root(spark))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; further columns, whatever they are called, can't clash with ours."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def unused(columns: list[str], name: str) -> str:
    """The name, made longer until no column has it, in upper or lower case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, f: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]], schema: str, keeps: str | None = None) -> DataFrame:
    """mapInArrow over column dicts: f gets Arrow arrays and gives them or lists.

    keeps: what a worker may still hold from earlier tasks, see held().
    """
    to = pa_schema(df.sparkSession, schema)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(keeps)
        for out in f({n: c for n, c in zip(b.schema.names, b.columns, strict=True)} for b in batches):
            yield pa.RecordBatch.from_arrays([x if isinstance(x := out[k.name], pa.Array) else pa.array(x, type=k.type) for k in to], schema=to)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bounds Arrow batches by bytes for the session, so that long texts don't add up to large ones."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema))


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What a worker keeps between tasks, one thing at a time: another operator's cache goes first."""
    if name not in _HELD:
        release(name)
        _HELD[name] = make()
    return _HELD[name]


def release(keeps: str | None = None) -> None:
    """Gives a worker's memory back, but for what is named: its caches, and what allocators hold for later."""
    if _HELD and keeps not in _HELD:
        _HELD.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every libc has it
        ctypes.CDLL(None).malloc_trim(0)


def counted(df: DataFrame, keys: Callable[[dict], Iterator[np.ndarray]], size: int, bits: bool = False) -> np.ndarray:
    """How many keys fall on each of `size` counters (bits: whether any does), as uint32 or as packed bits.

    Every task sums its own table and hands it on in slices; a slice is summed by one task. The driver gets the
    table alone, of a size that doesn't depend on the input.
    """
    slices = 256
    step = size // slices

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        table = np.zeros(size, bool if bits else np.uint32)
        for b in batches:
            for k in keys(b):
                at = (k & np.uint64(size - 1)).astype(np.int64)
                if bits:
                    table[at] = True
                else:
                    np.add.at(table, at, 1)
        cut = [table[i * step : (i + 1) * step] for i in range(slices)]
        yield {"slice": list(range(slices)), "counts": [(np.packbits(c) if bits else c).tobytes() for c in cut]}

    def add(x: pa.Table) -> pa.Table:
        total = np.zeros(step // 8 if bits else step, np.uint8 if bits else np.uint64)
        for c in x["counts"]:
            if bits:
                total |= np.frombuffer(c.as_buffer(), np.uint8)
            else:
                total += np.frombuffer(c.as_buffer(), np.uint32)
        if not bits:
            total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        return pa.table({"slice": x["slice"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    parts = map_batches(df, run, "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    kind = np.uint8 if bits else np.uint32
    out = np.zeros(size // 8 if bits else size, kind)
    for r in parts:
        part = np.frombuffer(r["counts"], kind)
        out[r["slice"] * len(part) : (r["slice"] + 1) * len(part)] = part
    return out


#: Bits of the tables that say which ids a step touches; more rows pass a table when it fills up.
ID_BITS = 1 << 22


def mixed(ids: pa.Array) -> np.ndarray:
    """64-bit hashes of ids; a null counts as 0."""
    h = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def id_bits(ids: DataFrame, column: str) -> Broadcast:
    """A bit table of the ids in a column, of a fixed size."""

    def keys(b: dict) -> Iterator[np.ndarray]:
        yield mixed(b[column])

    return ids.sparkSession.sparkContext.broadcast(counted(ids.select(column), keys, ID_BITS, bits=True))


def bit_of(table: np.ndarray, ids: pa.Array) -> np.ndarray:
    at = (mixed(ids) & np.uint64(ID_BITS - 1)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def by_bits(df: DataFrame, column: str, bits: Broadcast) -> tuple[DataFrame, DataFrame]:
    """(rows that a bit table lets through, all other rows): only the former need a join on the ids behind it."""
    small_batches(df.sparkSession)

    def side(through: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            for b in batches:
                yield b.filter(pa.array(bit_of(bits.value, b.column(b.schema.get_field_index(column))) == through))

        return run

    return df.mapInArrow(side(True), df.schema), df.mapInArrow(side(False), df.schema)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over edges (u, v), for every node of an edge.

    Alternates large-star and small-star steps; every step is an aggregation of minima joined back to the
    edges, so that no neighbourhood is ever gathered. Both join sides come from written tables: each has an
    exchange of its own, and adaptive execution can split a hot node.
    """
    with dropping(edges.sparkSession) as keep:
        cur = scratch(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
        n = cur.count()
        for _ in range(max_rounds):
            # large-star: neighbours larger than u move to the smallest of u and its neighbours
            both = cur.select("u", "v").unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = scratch(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least", 2 * n)
            large = cur.select(F.col("v").alias("k"), F.col("u").alias("w")).join(least.withColumnRenamed("u", "k"), "k").select(F.col("w").alias("u"), F.col("m").alias("v"))
            large = scratch(large.where("u <> v").distinct(), "large", n)
            # small-star: u and its smaller neighbours move to the smallest of them
            least = scratch(large.groupBy("u").agg(F.min("v").alias("m")), "least", n)
            small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            new = scratch(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges", 2 * n)
            before, n = n, new.count()
            same = n == before and not new.exceptAll(cur).take(1)
            cur = new
            if same:
                break
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        keep(cur)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema))
