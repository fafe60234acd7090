"""Content-defined line chunks, grown over equal neighbours: passages that repeat anywhere in the corpus are removed."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Odd multiplier of the rolling hash, its inverse modulo 2 ** 64, and a multiplier that mixes it.
ROLL = 0x9E3779B97F4A7C15
BACK = np.uint64(pow(ROLL, -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Blank and \t \n \v \f \r: a line of these alone holds no word.
BLANKS = " \t\n\x0b\x0c\r"
WORDS = re.compile(common.WORD)


def chunks(hashes: np.ndarray, width: int, spread: int, most: int, seed: int = 0) -> list[int]:
    """Ends (exclusive) of the chunks of lines, each of two lines or more where there are two.

    A polynomial hash rolls over the hashes of the last `width` lines; a line ends a chunk where it is 0 modulo
    `spread`, unless the chunk would have one line, and a chunk never has more than `most` lines. Borders depend
    on the lines near them, so an inserted line moves none behind the next border that both texts take. Another
    seed gives other borders.
    """
    roll, n = hashes.copy(), len(hashes)
    for j in range(1, min(width, n)):
        roll[j:] += hashes[:-j] * np.uint64(pow(ROLL, j, 1 << 64))
    hits = ((roll * (MIX * np.uint64(2 * seed + 1))) >> np.uint64(40)) % np.uint64(spread) == 0
    out, start = [], 0
    for end in (np.flatnonzero(hits) + 1).tolist():
        while end - start > most:
            start += most
            out.append(start)
        if end - start > 1:
            out.append(end)
            start = end
    while n - start >= most:
        start += most
        out.append(start)
    if start < n:
        if n - start == 1 and out:
            out[-1] = n
        else:
            out.append(n)
    return out


def codes_of(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A code for each run of lines [start, end): the polynomial hash of its lines' hashes, mixed."""
    n = len(hashes)
    power = np.concatenate([np.ones(1, np.uint64), np.full(n, ROLL, np.uint64).cumprod(dtype=np.uint64)])
    back = np.concatenate([np.ones(1, np.uint64), np.full(n, BACK, np.uint64).cumprod(dtype=np.uint64)])
    total = np.concatenate([np.zeros(1, np.uint64), (hashes * power[:n]).cumsum(dtype=np.uint64)])
    h = (total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * MIX
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def line_hashes(lines: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))


def cut(lines: list[str], hashes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first line, end line, code of the run's lines) of all spans of a text by which repeats are found.

    Those are all chunkings' chunks with two lines that hold a word; every line that holds a word up to the next one
    that does, so that borders never depend on lines outside a passage and a match grows over all equal neighbours;
    and single lines of more than `alone` words.
    """
    full = np.fromiter((bool(x) and (x[0] > " " or bool(x.strip(BLANKS))) for x in lines), bool, len(lines))
    words = np.concatenate([np.zeros(1, np.int64), full.cumsum()])
    at = np.flatnonzero(full)
    alone = [i for i in at.tolist() if _above(lines[i], shape.alone)]
    starts, ends = [at[:-1], np.asarray(alone, np.int64)], [at[1:] + 1, np.asarray(alone, np.int64) + 1]
    for seed in range(shape.chunkings):
        z = np.asarray(chunks(hashes, shape.width, shape.spread, shape.most, seed), np.int64)
        a = np.concatenate([np.zeros(1, np.int64), z[:-1]])
        keep = words[z] - words[a] > 1
        starts.append(a[keep])
        ends.append(z[keep])
    both = np.unique(np.concatenate(starts) * (len(lines) + 1) + np.concatenate(ends))
    starts, ends = both // (len(lines) + 1), both % (len(lines) + 1)
    return starts, ends, codes_of(hashes, starts, ends)


def _above(line: str, words: int) -> bool:
    """Whether a line has more words than that; its length and few blanks tell that it hasn't."""
    return len(line) > 2 * words and sum(map(line.count, BLANKS)) >= words and len(WORDS.findall(line)) > words


@dataclass(frozen=True)
class Shape:
    """How lines are cut: see chunks() and cut()."""

    width: int = 2
    spread: int = 2
    most: int = 12
    chunkings: int = 3
    #: Words above which a single line is a span of its own.
    alone: int = 50


def _each(batches: Iterator[dict], shape: Shape) -> Iterator[tuple]:
    """(doc_id, text hash, lines, their hashes, spans) of the texts that have more than one line."""
    for b in batches:
        many = np.flatnonzero(pc.fill_null(pc.match_substring(b["text"], "\n"), False).to_numpy(zero_copy_only=False))
        for i in many.tolist():
            lines = b["text"][i].as_py().split("\n")
            hashes = line_hashes(lines)
            spans = cut(lines, hashes, shape)
            if len(spans[0]):
                yield b["doc_id"][i].as_py(), b["hash"][i].as_py(), lines, hashes, spans


def _keys(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.int64).view(np.uint64) >> np.uint64(7)


def _collected(rows: Iterator[tuple], names: tuple[str, ...], size: int = 4096) -> Iterator[dict[str, list]]:
    while part := list(itertools.islice(rows, size)):
        yield dict(zip(names, map(list, zip(*part, strict=True)), strict=True))


#: Bits of the table of repeated codes; more codes pass it when it fills up, and no result depends on it.
BITS = 1 << 22


def repeated(docs: DataFrame, shape: Shape) -> DataFrame:
    """(doc_id, hash, line, end) of the spans of documents (doc_id, hash, text) that have an earlier place.

    Codes are counted first. Spans whose code repeats are then written with the hashes of their lines, beside the
    bytes of these lines. Bytes are compared line by line: a hash that two different lines share takes its spans out,
    and so does a code that two different runs of lines share, so that afterwards equal codes are equal bytes. Places
    are ordered by doc_id (null first), hash of the text and line.
    """
    spark = docs.sparkSession

    def codes(batches: Iterator[dict]) -> Iterator[dict]:
        for _, _, _, _, spans in _each(batches, shape):
            yield {"code": pa.array(spans[2])}

    again = common.scratch(common.map_batches(docs, _merged(codes), "code long").groupBy("code").count().where("count > 1").select("code"), "codes")

    def keys(b: dict) -> Iterator[np.ndarray]:
        yield _keys(b["code"].to_numpy())

    bits = spark.sparkContext.broadcast(common.counted(again, keys, BITS, bits=True))

    def places(batches: Iterator[dict]) -> Iterator[dict]:
        def rows() -> Iterator[tuple]:
            seen: set[int] = set()  # a line's bytes go out once for every so many lines
            for doc, text, lines, hashes, (starts, ends, codes) in _each(batches, shape):
                at = (_keys(codes) & np.uint64(BITS - 1)).astype(np.int64)
                signed = hashes.view(np.int64)
                for i in np.flatnonzero(bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).tolist():
                    a, z = int(starts[i]), int(ends[i])
                    yield int(codes[i]), doc, text, a, z, hashes[a:z].tobytes(), False
                    for j, h in enumerate(signed[a:z].tolist(), a):
                        if h not in seen:
                            if len(seen) > 100_000:
                                seen.clear()
                            seen.add(h)
                            yield h, None, None, None, None, lines[j].encode(), True

        yield from _collected(rows(), ("code", "doc_id", "hash", "line", "end", "lines", "bytes"), 1024)

    found = common.scratch(common.map_batches(docs, places, "code long, doc_id long, hash long, line int, end int, lines binary, bytes boolean"), "places")
    lines = found.where("bytes").select("code", "lines").distinct().groupBy("code").count().where("count > 1")
    shared = np.asarray([r["code"] for r in lines.select("code").collect()], np.int64).view(np.uint64)
    spans = found.where("NOT bytes").drop("bytes")
    if len(shared):

        def sound(batches: Iterator[dict]) -> Iterator[dict]:
            for b in batches:
                keep = pa.array([not np.isin(np.frombuffer(x.as_py(), np.uint64), shared).any() for x in b["lines"]], pa.bool_())
                yield {n: c.filter(keep) for n, c in b.items()}

        spans = common.map_batches(spans, sound, "code long, doc_id long, hash long, line int, end int, lines binary")
    same = spans.groupBy("code", "lines").agg(F.count("*").alias("places"), F.min(F.struct("doc_id", "hash", "line")).alias("first"))
    one = same.groupBy("code").agg(F.count("*").alias("texts"), F.sum("places").alias("places"), F.min("first").alias("first"))
    one = common.scratch(one.where("texts = 1 AND places > 1").select("code", "first"), "repeated")
    later = spans.drop("lines").join(one, "code").where("NOT (struct(doc_id, hash, line) <=> first)")
    return later.select("doc_id", "hash", "line", "end")


def _merged(f: Callable, rows: int = 65_536) -> Callable:
    """The same columns in larger batches."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held, n = [], 0
        for b in f(batches):
            held.append(b["code"])
            n += len(b["code"])
            if n >= rows:
                yield {"code": pa.concat_arrays(held)}
                held, n = [], 0
        if held:
            yield {"code": pa.concat_arrays(held)}

    return run


def dedup(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Removes multi-line passages and long lines that repeat across the corpus, but for the first place of each.

    First is the smallest doc_id, and there the first line; texts that share a doc_id are told apart by a hash of the
    text. Lines are removed towards smaller places alone, so some place keeps every line. All columns of the
    documents stay, text without the removed lines; two more are added: lines_removed and lines_kept. A null text
    stays null and counts no line; a row with a null doc_id keeps all its lines. Columns of the input with the added
    names are replaced, others may have any name. Equal rows lose and keep the same. An empty table gives no rows.
    """
    docs = docs.drop("lines_removed", "lines_kept")
    doc, text, gone = (common.unused(docs.columns, x) for x in ("doc", "hash", "gone"))
    with common.dropping(docs.sparkSession) as keep:
        later = repeated(docs.select("doc_id", F.xxhash64("text").alias("hash"), "text"), shape)
        # at most one entry for each span of a document
        lists = later.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(doc), F.col("hash").alias(text)).agg(F.collect_set(F.struct("line", "end")).alias(gone))
        lists = keep(common.scratch(lists, "gone"))
    # only documents that may lose lines meet the lists; the others pass as they are
    maybe, rest = common.by_bits(docs, "doc_id", common.id_bits(lists, doc))
    maybe = maybe.withColumn(common.unused([*docs.columns, doc, text, gone], "own"), F.xxhash64("text"))
    # merged whatever its size, so that no task runs two Python workers at once
    joined = maybe.join(lists.hint("merge"), (F.col("doc_id") == F.col(doc)) & (F.col(maybe.columns[-1]) == F.col(text)), "left").select(*(F.col(f"`{c}`") for c in docs.columns), gone)
    whole = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    rest = rest.select("*", F.lit(0).cast("long").alias("lines_removed"), whole.alias("lines_kept"))
    schema = docs.select("*", F.lit(0).cast("long").alias("lines_removed"), F.lit(0).cast("long").alias("lines_kept")).schema
    at = docs.columns.index("text")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for b in batches:
            texts, removed, stay = [], [], []
            for t, spans in zip(b.column(at), b.column(b.num_columns - 1), strict=True):
                t, spans = t.as_py(), spans.as_py()
                lines = t.split("\n") if t is not None else []
                n = len(lines)
                if spans:
                    out = {i for g in spans for i in range(g["line"], g["end"])}
                    lines = [x for i, x in enumerate(lines) if i not in out]
                texts.append("\n".join(lines) if t is not None else None)
                removed.append(n - len(lines))
                stay.append(len(lines))
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64()), pa.array(stay, pa.int64())], names=[*b.schema.names[:-1], "lines_removed", "lines_kept"])

    common.small_batches(docs.sparkSession)
    return joined.mapInArrow(drop, schema).unionByName(rest)
