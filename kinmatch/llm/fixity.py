"""WARC fixity audit: Merkle trees over records and their ordered offset ranges, compared from the roots down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


def records(pages: DataFrame, per_file: int = 1000) -> DataFrame:
    """WARC layout of pages (page_id, url, html): (file, record, offset, length, payload).

    A file holds the pages of `per_file` consecutive ids, a record each; a record's number is its page_id and
    files are ranges of it, so replicas agree on the place of every record whatever is damaged. The payload is
    the response record: header lines, a blank line, the body.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col("url"), F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    payload = F.concat(head, body, F.lit("\r\n\r\n"))
    return pages.where("page_id IS NOT NULL").select(F.floor(F.col("page_id") / per_file).cast("long").alias("file"), F.col("page_id").cast("long").alias("record"), payload.alias("payload"))


def leaves(replica: DataFrame) -> DataFrame:
    """(file, record, hash, length): SHA-256 of every record; copies of one record are hashed together in order."""
    one = replica.select("file", "record", F.sha2(F.col("payload").cast("binary"), 256).alias("hash"), F.octet_length("payload").cast("long").alias("length"))
    many = one.groupBy("file", "record").agg(F.sort_array(F.collect_list("hash")).alias("all"), F.sum("length").alias("length"))
    return many.select("file", "record", F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(F.sha2(F.concat_ws("", "all").cast("binary"), 256)).alias("hash"), "length")


def _parent(level: DataFrame) -> DataFrame:
    """(file, node, hash, length) one level up.

    A node covers the byte range of its children, at most a fan-out of them: it hashes, in order, each child's
    number, the offset at which the child starts within the range, its length and its hash.
    """
    kids = F.sort_array(F.collect_list(F.struct("child_file", "child", "length", "hash")))
    start = lambda kids, i: F.aggregate(F.slice(kids, 1, i), F.lit(0).cast("long"), lambda s, k: s + k["length"])
    up = level.select(F.col("up_file").alias("file"), F.col("up_node").alias("node"), F.col("file").alias("child_file"), F.col("node").alias("child"), "length", "hash")
    up = up.groupBy("file", "node").agg(kids.alias("kids"), F.sum("length").alias("length"))
    text = F.array_join(F.transform("kids", lambda k, i: F.concat_ws(":", k["child_file"], k["child"], start(F.col("kids"), i), k["length"], k["hash"])), ",")
    return up.select("file", "node", F.sha2(text.cast("binary"), 256).alias("hash"), "length")


def heights(replicas: list[DataFrame], fanout: int) -> tuple[int, int]:
    """(levels above the records of a file, levels above the files) that trees of all the replicas need."""
    most = [r.agg(F.max(F.abs("record")), F.max(F.abs("file"))).first() for r in replicas]
    return tuple(max(height(m[i] or 0, fanout) for m in most) for i in range(2))


def tree(replica: DataFrame, fanout: int = 16, high: tuple[int, int] | None = None) -> list[DataFrame]:
    """Levels of the tree, leaves first: (file, node, up_file, up_node, hash, length).

    In a file, a node covers an aligned range of record numbers, up to the file's root. Above, a node covers an aligned
    range of files. The last level is the root, and a second one where there are negative files.

    Only the leaves read payloads. They are written once and the levels above come from them.
    """
    within, above = high or heights([replica], fanout)
    up = lambda c: F.floor(F.col(c) / fanout).cast("long")
    level = leaves(replica).select("file", F.col("record").alias("node"), "hash", "length")
    out = []
    for k in range(within + above + 2):
        if k < within:
            parent = F.col("file"), up("node")
        elif k == within:  # all nodes of a file, one for each sign, under its root
            parent = F.col("file"), F.lit(0).cast("long")
        else:
            parent = up("file"), F.lit(0).cast("long")
        out.append(common.scratch(level.select("file", "node", parent[0].alias("up_file"), parent[1].alias("up_node"), "hash", "length"), "level"))
        level = _parent(out[-1])
    return out


def height(largest: int, fanout: int) -> int:
    """Levels above the leaves until every number up to `largest`, of one sign, is below one node."""
    n = 1
    while fanout**n <= largest:
        n += 1
    return n


def audit(left: DataFrame, right: DataFrame, fanout: int = 16) -> DataFrame:
    """Records in which two replicas (file, record, payload) differ.

    Both trees are built with the same ranges. Roots are compared first; a level is joined only below nodes that
    differ one level up, so equal ranges are never looked into again.

    Returns one row per differing record: file, record, state (changed, missing or extra, as the right replica
    is), left_hash, right_hash, left_offset and right_offset (of the record in its file, null where it is absent)
    and nodes_compared (over all levels). A record that stands in another file is missing in one and extra in the
    other. Equal or empty replicas give no rows. Rows of one record are one leaf. Extra columns are ignored; rows
    without a file or a record number can't be placed and are left out.
    """
    left, right = (r.where("file IS NOT NULL AND record IS NOT NULL").select("file", "record", "payload") for r in (left, right))
    high = heights([left, right], fanout)
    a, b = tree(left, fanout, high), tree(right, fanout, high)
    suspects, compared = None, 0
    for x, y in zip(reversed(a), reversed(b), strict=True):
        x, y = (s.select("file", "node", "up_file", "up_node", F.col("hash").alias(f"{n}_hash")) for n, s in (("left", x), ("right", y)))
        if suspects is not None:
            parents = suspects.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            x, y = (s.join(parents, ["up_file", "up_node"], "left_semi") for s in (x, y))
        both = common.scratch(x.drop("up_file", "up_node").join(y.drop("up_file", "up_node"), ["file", "node"], "full_outer"), "compared")
        compared += both.count()
        suspects = both.where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))
    state = F.when(F.col("right_hash").isNull(), "missing").when(F.col("left_hash").isNull(), "extra").otherwise("changed")
    found = suspects.select("file", F.col("node").alias("record"), state.alias("state"), "left_hash", "right_hash")
    for side, leaf in (("left", a[0]), ("right", b[0])):
        found = _offsets(found, leaf, side)
    return found.select("file", "record", "state", "left_hash", "right_hash", "left_offset", "right_offset", F.lit(compared).cast("long").alias("nodes_compared"))


def _offsets(found: DataFrame, leaf: DataFrame, side: str) -> DataFrame:
    """Adds the offset of the records found: the lengths of what stands before them in their file."""
    w = Window.partitionBy("file").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    own = leaf.select("file", F.col("node").alias("record"), "length").join(found.select("file").distinct(), "file", "left_semi")
    placed = own.select("file", "record", F.coalesce(F.sum("length").over(w), F.lit(0)).alias(f"{side}_offset"))
    return found.join(placed, ["file", "record"], "left")


def damaged(replica: DataFrame, every: int = 97) -> DataFrame:
    """A replica with known damage, by the record number: bytes changed, records lost, at a wrong number, in a wrong file."""
    kind: Column = F.pmod(F.col("record"), F.lit(every))
    body = F.when(kind == 0, F.concat(F.lit("#"), F.expr("substr(payload, 2)"))).otherwise(F.col("payload"))
    stay = replica.withColumn("kind", kind).where("kind <> 1")
    record = F.when(F.col("kind") == 2, -F.col("record") - 1).otherwise(F.col("record"))
    return stay.select(F.when(F.col("kind") == 3, F.col("file") + 1).otherwise(F.col("file")).alias("file"), record.alias("record"), body.alias("payload"))
