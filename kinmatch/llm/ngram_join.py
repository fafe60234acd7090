"""N-gram Jaccard join: rare-first prefix filter with length, positional and suffix filters.

Documents with equal shingle sets form a class first, so that copies cost nothing. Classes meet where they share
a prefix shingle. A large bucket is never paired with itself: its classes meet one of them, the hub, and are then
known by what tells them from the hub. Two sets s and t that link but don't both link with the hub h share an
element of the differences s ^ h and t ^ h: were those disjoint, s & h and t & h would be no smaller and s | h and
t | h no larger than s & t and s | t. So the same rare-first prefix filter on the differences splits the bucket
again, without losing a link, until buckets are small or hold one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Counters of the shingle frequency table, a bound on what is broadcast (4 bytes each). Only the order of
#: rarity depends on them, never a result.
COUNTERS = 1 << 20
#: Bins of the suffix filter.
BINS = 128

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


HASHES = "word hashes"


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C[4]
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; A-Z in lower case, words between ASCII white space.

    A text of fewer words is one shingle; one without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = common.held(HASHES, WordHashes)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < k:
        digest = hashlib.blake2b(b"\x20".join(words), digest_size=8, person=b"short%d" % k).digest()
        return np.frombuffer(digest, "<u8").copy()
    n = len(h) - k + 1
    s = np.zeros(n, np.uint64)
    for i in range(k):
        s = (s ^ (s >> np.uint64(31))) * _C[i % 8] + h[i : i + n]
    return np.unique(_mix(s))


def _batched(x: pa.Array, size: int = 64) -> Iterator:
    for at in range(0, len(x), size):
        yield from x[at : at + size].to_pylist()


def counted_shingles(docs: DataFrame, k: int) -> Broadcast:
    """The table of rarity: how many shingles of all documents fall on each counter."""

    def keys(b: dict) -> Iterator[np.ndarray]:
        some: list[np.ndarray] = []
        for t in _batched(b["text"]):
            some.append(shingles(t, k))
            if sum(map(len, some[-1:])) > 100_000 or len(some) >= 256:
                yield np.concatenate(some)
                some = []
        if some:
            yield np.concatenate(some)

    return docs.sparkSession.sparkContext.broadcast(common.counted(docs, keys, COUNTERS))


def rarity_of(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[(s & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.int64)


def rarest(s: np.ndarray, keep: int, rarity: np.ndarray) -> np.ndarray:
    """The `keep` rarest of distinct elements, by rarity and then by hash."""
    if keep >= len(s):
        return s[np.lexsort((s, rarity))]
    first = np.flatnonzero(rarity <= np.partition(rarity, keep - 1)[keep - 1])
    return s[first[np.lexsort((s[first], rarity[first]))][:keep]]


def signatures(docs: DataFrame, k: int, percent: int, rarity: Broadcast) -> DataFrame:
    """(doc_id, n, centre, d1, d2, prefix, bins): set size, how frequent its shingles are on average, 128-bit digest of
    the set, its rarest shingles in order, and how many of its shingles fall on each bin."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        table = rarity.value
        for b in batches:
            n, centre, d1, d2, prefix, bins = [], [], [], [], [], []
            for t in _batched(b["text"]):
                s = shingles(t, k)
                a, z = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8").tolist()
                size = len(s)
                n.append(size)
                often = rarity_of(s, table)
                centre.append(float(np.log2(np.maximum(often, 1)).mean()) if size else 0.0)
                d1.append(a)
                d2.append(z)
                prefix.append(rarest(s, size - -(-percent * size // 100) + 1 if size else 0, often).view(np.int64))
                bins.append(np.minimum(np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=BINS), 32767).astype(np.int16))
            yield {"doc_id": b["doc_id"], "n": n, "centre": centre, "d1": d1, "d2": d2, "prefix": prefix, "bins": bins}

    return common.map_batches(docs, run, "doc_id long, n int, centre float, d1 long, d2 long, prefix array<long>, bins array<smallint>", keeps=HASHES)


def _overlap(percent: int, a: str, b: str) -> Column:
    """Least intersection of sets of sizes a and b that reaches the similarity."""
    return F.ceil(F.lit(percent) * (F.col(a) + F.col(b)) / F.lit(100 + percent))


def _by_length(pairs: DataFrame, percent: int, apart: Column | None = None) -> DataFrame:
    """Length filter on (doc, n, other, other_n), and what tells them apart at least; distinct (doc, other, need)."""
    need = _overlap(percent, "n", "other_n")
    pairs = pairs.where((F.col("doc") != F.col("other")) & (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent))
    pairs = pairs if apart is None else pairs.where(apart <= F.col("n") + F.col("other_n") - 2 * need)
    return pairs.select(F.least("doc", "other").alias("doc"), F.greatest("doc", "other").alias("other"), need.cast("int").alias("need")).distinct()


def _positional(pairs: DataFrame, percent: int) -> DataFrame:
    """Length and positional filters on (doc, n, pos, size, short, other, ...) that share an element.

    Sizes are of the sets, or of their differences from one hub, in which pos is a place. The shared element may be
    taken as the first one that both have: all before it tells them apart, and the smaller has it in its short prefix.
    """
    smaller = (F.col("size") < F.col("other_size")) | ((F.col("size") == F.col("other_size")) & (F.col("doc") < F.col("other")))
    left = lambda o: F.col(f"{o}size") - F.col(f"{o}pos")
    apart = F.abs(left("") - left("other_")) + F.col("pos") + F.col("other_pos")
    return _by_length(pairs.where(F.when(smaller, F.col("short")).otherwise(F.col("other_short"))), percent, apart)


def _suffix_filtered(pairs: DataFrame, bins: DataFrame) -> DataFrame:
    """Suffix filter: the counts of the bins differ at most as much as sets that meet in `need` may."""
    a = bins.select(F.col("doc"), F.col("n").alias("na"), F.col("bins").alias("ba"))
    b = bins.select(F.col("doc").alias("other"), F.col("n").alias("nb"), F.col("bins").alias("bb"))
    differ = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    both = pairs.join(a, "doc").join(b, "other")
    return both.where(F.col("na") + F.col("nb") - differ >= 2 * F.col("need")).select("doc", "other", "need")


def _sets(docs: DataFrame, ids: DataFrame, k: int, name: str) -> DataFrame:
    """(name, name_set) of the documents that a bit table of the ids lets through, made from the texts again."""

    bits = common.id_bits(ids, "id")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:  # 64 sets at a time: long texts have large ones
            take = pa.array(np.sort(np.unique(b["doc_id"].to_numpy(), return_index=True)[1]))
            take = take.filter(pa.array(common.bit_of(bits.value, b["doc_id"].take(take))))
            for i in range(0, len(take), 64):
                part = take[i : i + 64]
                yield {name: b["doc_id"].take(part), f"{name}_set": [shingles(t, k).view(np.int64) for t in b["text"].take(part).to_pylist()]}

    return common.map_batches(docs, run, f"{name} long, {name}_set array<long>", keeps=HASHES)


def _verified(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Of the pairs (doc, other, need), the links (u, v): those whose sets meet in `need` shingles at least."""
    others = _sets(docs, pairs.select(F.col("other").alias("id")).distinct(), k, "other")
    own = _sets(docs, pairs.select(F.col("doc").alias("id")).distinct(), k, "doc")
    both = pairs.join(others, "other").join(own, "doc")
    links = both.where(F.size(F.array_intersect("doc_set", "other_set")) >= F.col("need"))
    return links.select(F.least("doc", "other").alias("u"), F.greatest("doc", "other").alias("v"))


def most_apart(n: int, percent: int) -> int:
    """In how many elements a set of n may differ at most from one that it links with."""
    return (n + 100 * n // percent) * (100 - percent) // (100 + percent)


def _differences(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc, hub, n, size, linked, prefix) of the pairs (doc, hub): size and rarest elements of doc ^ hub, in order.

    Rarity is within the differences from one hub, by counters of a table of fixed size. Of a set that links with the
    hub about half of its difference is enough: those that don't link with the hub differ from it in more, so that
    at most x = (size - 1 + most(doc, other) - most(hub, other)) / 2 of the set's elements tell it from such another.
    """
    hubs = _sets(docs, pairs.select(F.col("hub").alias("id")).distinct(), k, "hub")
    own = _sets(docs, pairs.select(F.col("doc").alias("id")).distinct(), k, "doc")

    def subtract(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("n", "linked", "keep", "apart")}
            sets = lambda c, b=b: (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in b[c])
            for s, h in zip(sets("doc_set"), sets("hub_set"), strict=True):
                apart = np.setxor1d(s, h, assume_unique=True)
                both = (len(s) + len(h) - len(apart)) // 2
                linked = 100 * both >= percent * (len(s) + len(h) - both)
                keep = most_apart(len(s), percent)
                if linked:  # the two largest differences are rounded, which makes up to 2 of them
                    keep = min(keep, max(0, len(apart) + 1 + (len(s) - len(h)) * (100 - percent) // (100 + percent) + 1) // 2)
                out["n"].append(len(s))
                out["linked"].append(linked)
                out["keep"].append(keep + 1)
                out["apart"].append(apart.view(np.int64))
            yield {"doc": b["doc"], "hub": b["hub"], **out}

    # merged whatever their size, so that no task runs two Python workers at once
    both = pairs.join(hubs.hint("merge"), "hub").join(own.hint("merge"), "doc").select("doc", "hub", "doc_set", "hub_set")
    apart = common.scratch(common.map_batches(both, subtract, "doc long, hub long, n int, linked boolean, keep int, apart array<long>", keeps=HASHES), "apart")

    def elements(b: dict) -> Iterator[np.ndarray]:
        hub = _mix(b["hub"].to_numpy().view(np.uint64) * _C[0])
        yield _mix(b["apart"].flatten().to_numpy().view(np.uint64) ^ np.repeat(hub, pc.list_value_length(b["apart"]).to_numpy()))

    shared = docs.sparkSession.sparkContext.broadcast(common.counted(apart, elements, COUNTERS))

    def order(batches: Iterator[dict]) -> Iterator[dict]:
        table = shared.value
        for b in batches:
            often = rarity_of(next(elements(b)), table)
            size = pc.list_value_length(b["apart"]).to_numpy()
            ends = np.cumsum(size)
            all_ = b["apart"].flatten().to_numpy().view(np.uint64)
            prefix = [rarest(all_[z - m : z], n, often[z - m : z]).view(np.int64) for n, m, z in zip(b["keep"].to_pylist(), size.tolist(), ends.tolist(), strict=True)]
            yield {**b, "size": pa.array(size, pa.int32()), "prefix": prefix}

    return common.map_batches(apart, order, "doc long, hub long, n int, size int, linked boolean, prefix array<long>", keeps=HASHES)


def without_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Documents without those that aren't the smallest of their component; rows with a null doc_id stay.

    Columns stay, whatever their names; rows that repeat a doc_id stay or go together.
    """
    with common.dropping(docs.sparkSession) as keep:
        groups, name = join(docs, k, percent), common.unused(docs.columns, "gone")
        gone = keep(common.scratch(groups.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct(), "copies"))
    maybe, rest = common.by_bits(docs, "doc_id", common.id_bits(gone, name))
    return maybe.join(gone, F.col("doc_id") == F.col(name), "left_anti").unionByName(rest)


def join(docs: DataFrame, k: int = 5, percent: int = 80, small_bucket: int = 8, large_bucket: int = 32, levels: int = 6, hubs: int = 16) -> DataFrame:
    """Groups of documents (doc_id, text) that links of Jaccard similarity `percent` / 100 or more connect.

    Of two sets that link, the smaller has their rarest common element in a short prefix. Buckets with up to
    `small_bucket` classes of short prefix compare these with all. Classes of larger ones meet their bucket's hub and
    then `hubs` others, again while that joins many to the bucket's main component. Where up to `large_bucket` classes
    are left outside it, or have it in a short prefix, these are compared with all. Else the bucket goes by the
    differences from its hub, `levels` times over; should any be left then, they are compared whole.

    Returns one row per document: doc_id, n_shingles (set size) and component_id (smallest doc_id that links
    reach). A document without words, or with a null text, is linked with nothing; so is one with a null doc_id,
    whose component is null. Rows that repeat a doc_id should repeat its text. Equal sets are linked. An empty
    table gives no rows; extra columns are ignored.
    """
    with common.dropping(docs.sparkSession) as keep:
        return _joined(common.only(docs, "doc_id", "text"), k, percent, small_bucket, large_bucket, levels, hubs, keep)


def _joined(docs: DataFrame, k: int, percent: int, small_bucket: int, large_bucket: int, levels: int, hubs: int, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    rarity = counted_shingles(docs, k)
    with common.dropping(docs.sparkSession) as hold:
        every = common.scratch(signatures(docs, k, percent, rarity), "signatures")
        named = every.where("doc_id IS NOT NULL AND n > 0")
        sig = hold(keep(common.scratch(every.select("doc_id", "n", "d1", "d2"), "digests")))
        classes = hold(common.scratch(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("centre").alias("centre"), F.first("prefix").alias("prefix"), F.first("bins").alias("bins")), "classes"))
    bins = classes.select("doc", "n", "bins")
    known = docs.where("doc_id IS NOT NULL")
    component = common.empty(docs.sparkSession, "node long, component long")

    def shared(index: DataFrame) -> tuple[DataFrame, int]:
        """The rows of (key, doc, n, pos, short, ...) whose key can make a pair, and how many."""
        many = index.groupBy("key").agg(F.count("*").alias("rows"), F.count_if("short").alias("shorts")).where("rows > 1 AND shorts > 0").drop("rows")
        out = common.scratch(index.join(many, "key"), "shared")
        return out, out.count()

    def labelled(rows: DataFrame, key: str) -> DataFrame:
        """Rows whose key has several components, with their own, the key's main one and how many rows stand outside."""
        node = F.when(F.col("linked"), F.col("hub")).otherwise(F.col("doc")) if "linked" in rows.columns else F.col("doc")
        rows = rows.withColumn("node", node).join(component, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
        rows = common.scratch(rows, "labelled", n)
        per = rows.groupBy(key, "component").agg(F.count("*").alias("c")).groupBy(key)
        per = per.agg(F.sum("c").alias("all"), F.max(F.struct("c", "component")).alias("most")).where("most.c < all")
        return rows.join(per.select(key, F.col("most.component").alias("main"), (F.col("all") - F.col("most.c")).alias("outside")), key)

    def compare(pairs: DataFrame, more: DataFrame | None = None) -> None:
        """Joins components by the links among the pairs, and by more links."""
        nonlocal component
        pairs = common.scratch(pairs.dropDuplicates(["doc", "other"]), "met")
        if pairs.take(1):  # only the bins of these classes meet them
            touched = common.id_bits(pairs.select(F.explode(F.array("doc", "other")).alias("id")), "id")
            pairs = common.scratch(_suffix_filtered(pairs, common.by_bits(bins, "doc", touched)[0]), "pairs")
        found = [_verified(pairs, known, k)] if pairs.take(1) else []
        found += [] if more is None else [more]
        if not found or not (links := common.scratch(reduce(DataFrame.unionAll, found).distinct(), "links")).take(1):
            return
        old = component.select(F.col("node").alias("u"), F.col("component").alias("v"))
        component = common.scratch(common.components(links.unionAll(old)), "component", 2 * (links.count() + old.count()))

    def whole(rows: DataFrame) -> DataFrame:
        """Pairs within buckets: of the classes of short prefix or of those outside, the fewer, with all."""
        other = rows.select("key", *(F.col(c).alias(o) for c, o in (("doc", "other"), *((m, f"other_{m}") for m in ("n", "size", "pos", "short", "linked", "component")))))
        few = rows.where(F.when(F.col("shorts") <= F.col("outside"), F.col("short")).otherwise(F.col("component") != F.col("main")))
        pairs = few.join(other, "key").where("NOT (linked AND other_linked) AND component <> other_component")
        return _positional(pairs, percent)

    def to_hub(rows: DataFrame, level: int) -> DataFrame:
        """(doc, hub, n, centre): each class with the hub of every bucket it is in, the hub with itself.

        The hub is the class of the most frequent shingles, which is the likeliest to be close to the others.
        """
        rows = rows.drop("hub").join(classes.select("doc", "centre"), "doc")
        hub = rows.groupBy("key").agg(F.max_by("doc", F.struct("centre", F.xxhash64("doc", F.lit(level)))).alias("hub"))
        return common.scratch(rows.join(hub, "key").select("doc", "hub", "n", "centre").distinct(), "to-hub", n)

    def meet_hubs(groups: DataFrame, level: int) -> None:
        """Outside classes of a hub's group meet some of the group, while that joins a third of them each time."""
        before, at = None, 0
        while True:
            rows = labelled(groups, "hub")
            out = common.scratch(rows.where("component <> main"), "outside", n)
            left = out.count()
            if not left or (before is not None and 3 * left > 2 * before):
                return
            slot = F.pmod(F.xxhash64("doc", F.lit(level), F.lit(at)), F.lit(hubs))
            some = rows.groupBy("hub", slot.alias("slot")).agg(F.max(F.struct("centre", F.xxhash64("doc", F.lit(level), F.lit(-at - 1)).alias("at"), F.col("doc").alias("other"), F.col("n").alias("other_n"), F.col("component").alias("other_component"))).alias("one"))
            some = common.scratch(some.select("hub", "one.*"), "some", n)
            compare(_by_length(out.join(some, "hub").where("component <> other_component"), percent))
            before, at = left, at + 1

    short = F.col("pos") <= F.col("n") - F.ceil(F.col("n") * 2 * percent / F.lit(100 + percent))
    rows, n = shared(classes.select("doc", "n", F.posexplode("prefix").alias("pos", "key")).withColumn("short", short))
    rows = rows.withColumns({"hub": F.col("doc"), "size": F.col("n"), "linked": F.lit(False), "component": F.col("doc"), "main": F.lit(None).cast("long"), "outside": F.col("shorts")})
    large = rows.where(F.col("shorts") > small_bucket)
    groups = to_hub(large, 0)
    hub_sizes = groups.where("doc = hub").select("hub", F.col("hub").alias("other"), F.col("n").alias("other_n")).distinct()
    compare(whole(rows.where(F.col("shorts") <= small_bucket)).unionAll(_by_length(groups.where("doc <> hub").join(hub_sizes, "hub"), percent)))
    meet_hubs(groups, 0)
    for level in range(1, levels + 2):
        # a link between two members of a bucket of one component can't change anything
        large = common.scratch(labelled(large.drop("component", "main", "outside"), "key"), "large", n)
        few = (F.least("shorts", "outside") <= large_bucket) | F.lit(level > levels)
        compare(whole(large.where(few)))
        large = large.where(~few)
        if not large.take(1):
            break
        groups = to_hub(large, level)
        apart = common.scratch(_differences(groups.where("doc <> hub").select("doc", "hub"), known, k, percent), "differences")
        most = F.floor((F.col("n") + F.floor(F.col("n") * 100 / percent)) * (100 - percent) / F.lit(100 + percent))
        index = apart.select("doc", "hub", "n", "size", "linked", F.posexplode("prefix").alias("pos", "token"))
        large, n = shared(index.select("doc", "hub", "n", "size", "pos", F.xxhash64("hub", "token").alias("key"), "linked", (F.col("pos") <= F.floor(most / 2)).alias("short")))
        compare(common.empty(docs.sparkSession, "doc long, other long, need int"), apart.where("linked").select(F.least("doc", "hub").alias("u"), F.greatest("doc", "hub").alias("v")))
    label = classes.select("d1", "d2", "doc").join(component.withColumnRenamed("node", "doc"), "doc", "left")
    label = keep(common.scratch(label.select("d1", "d2", F.coalesce("component", "doc").alias("component")), "labels"))
    out = sig.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "d1", "d2").join(label, ["d1", "d2"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return out.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))

