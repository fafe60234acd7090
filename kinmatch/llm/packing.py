"""Packing token streams into training windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: str.split() also cuts at these four, which the tokenizer's white space does not hold.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: ASCII marks that are cut off a word's end before it is looked up.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"


def byte_letters(text: str) -> str:
    """The printable letters that stand for a text's bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return "".join(chr(b) if b in plain else chr(256 + rest.index(b)) for b in text.encode())


class WordIds(dict):
    """Little-endian uint32 ids of white-space delimited words, made on first use.

    The tokenizer's pre-tokens never hold white space, so a text's ids are its words' ids in order. A word of
    letters with punctuation behind it is the letters' ids and the punctuation's. Holds at most `bound` words
    and starts anew beyond.
    """

    def __init__(self, path: str, bound: int = 1_000_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.bound = Tokenizer.from_file(path), bound
        # their strings within a word are ordinary text; texts that hold one are sent whole through `exact`
        self.tokenizer.encode_special_tokens = True
        self.exact = Tokenizer.from_file(path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        # the same merges for words of letters alone, which need no normaliser and no pattern
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer, self.merges.pre_tokenizer = None, WhitespaceSplit()
        self.alphabet = {i: byte_letters(chr(i)) for i in range(128, 0x180)}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a pre-token
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.letters: dict[str, bytes] = {}

    def spelled(self, words: list[str]) -> None:
        """Words of letters are one pre-token each: one text of many costs less than many texts."""
        for at in range(0, len(words), 512):
            part = words[at : at + 512]
            text = " ".join(part).translate(self.alphabet)
            ids = np.asarray(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            raw, ends = ids.tobytes(), (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            for w, a, z in zip(part, [0, *ends], ends, strict=False):
                self.letters[w] = raw[a:z]
            if len(ends) != len(part):
                raise ValueError("the tokenizer cut a run of letters")

    def learn(self, words: set[str]) -> None:
        """Makes the ids of new lower-case words."""
        if len(self) + len(words) > self.bound:
            self.clear()
            self.letters.clear()
        known, cut, other = self.letters, [], []
        for w in words:
            head = w.rstrip(PUNCTUATION)
            if head.isalpha() and (head.isascii() or max(head) < "\u0180"):
                cut.append((w, head, w[len(head) :]))
            else:
                other.append(w)
        self.spelled([h for h in {h for _, h, _ in cut} if h not in known])
        tails = [t for t in {t for _, _, t in cut} if t not in known]
        for w, e in zip(tails, self.tokenizer.encode_batch_fast(tails, add_special_tokens=False), strict=True):
            known[w] = np.asarray(e.ids, "<u4").tobytes()
        for w, h, t in cut:
            self[w] = known[h] + known[t]
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self[w] = np.asarray(e.ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of texts. Lower case first makes words meet; only a final sigma depends on what stands around."""
        get, out, waiting, new = self.get, [], [], set()
        for i, t in enumerate(texts):
            if "\u03a3" in t or any(s in t for s in _SEPARATORS) or any(s in t for s in self.special):
                out.append(self.whole(t))
                continue
            words = t.lower().split()
            ids = list(map(get, words))
            missed = [w for w, x in zip(words, ids, strict=True) if x is None]
            if missed:
                new.update(missed)
                waiting.append((i, words, ids))
                out.append(b"")
            else:
                out.append(b"".join(ids))
        if new:
            self.learn(new)
            for i, words, ids in waiting:
                out[i] = b"".join([self[w] if x is None else x for w, x in zip(words, ids, strict=True)])
        return out

    def whole(self, text: str) -> bytes:
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def words_of(path: str, bound: int = 1_000_000) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return common.held(f"word ids {path} {bound}", lambda: WordIds(path, bound))


def token_pieces(docs: DataFrame, tokenizer: str, window: int, tail: int, end_id: int, words: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, place): whole windows of each document, then its rest in two.

    The last 1/tail of the rest is cut off: many small pieces let the differencing even out the large ones,
    while a document stays nearly whole. A null or empty text has the end id alone. Places number a task's pieces.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        ids_of = words_of(tokenizer, words)
        end = np.asarray([end_id], "<u4").tobytes()
        place = TaskContext.get().partitionId() << 40
        for b in batches:
            ids = b["doc_id"].to_pylist()
            texts = b["text"]
            for at in range(0, len(ids), 256):
                out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
                part = [t or "" for t in texts[at : at + 256].to_pylist()]
                for doc, raw in zip(ids[at : at + 256], ids_of.of(part), strict=True):
                    raw += end
                    n = len(raw) // 4
                    full = n // window
                    cuts = [i * window for i in range(full + 1)]
                    if rest := n - full * window:
                        cuts += [n - rest // tail] * (rest >= tail) + [n]
                    for a, z in zip(cuts, cuts[1:], strict=False):
                        out["doc_id"].append(doc)
                        out["start"].append(a)
                        out["length"].append(z - a)
                        out["ids_crc32"].append(zlib.crc32(raw[4 * a : 4 * z]))
                        out["doc_tokens"].append(n)
                out["place"] = list(range(place, place + len(out["start"])))
                place += len(out["start"])
                yield out

    return common.map_batches(common.only(docs, "doc_id", "text"), run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long", keeps=f"word ids {tokenizer} {words}")


def _merge(a: tuple, b: tuple, k: int) -> tuple:
    """Adds two partial partitions, the fullest part of one to the emptiest of the other.

    A partition is (sums, nodes), sums descending, without its empty parts; nodes point into the merge tree.
    """
    (sa, na), (sb, nb) = a, b
    meet = len(sa) + len(sb) - k  # parts that are filled on both sides
    if meet <= 0:
        s, n, joined = np.concatenate([sa, sb]), np.concatenate([na, nb]), None
    else:
        i, j = len(sa) - meet, len(sb) - meet
        joined = (na[i:], nb[j:][::-1])
        s = np.concatenate([sa[:i], sb[:j], sa[i:] + sb[j:][::-1]])
        n = np.concatenate([na[:i], nb[:j], np.full(meet, -1)])
    return s, n, joined


def difference(lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: (part of each item, sum of each part) over k parts.

    The two partial partitions with the largest spread are merged until one is left, so that their imbalances
    cancel. The merge tree keeps who went where.
    """
    n = len(lengths)
    if k == 1 or n == 0:
        return np.zeros(n, int), np.asarray([lengths.sum()])
    left: list[int] = [-1] * n
    right: list[int] = [-1] * n
    heap = [(-int(x), i) for i, x in enumerate(lengths)]
    states: dict[int, tuple] = {i: (np.asarray([x], np.int64), np.asarray([i])) for i, x in enumerate(lengths)}
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        (_, i), (_, j) = heapq.heappop(heap), heapq.heappop(heap)
        s, nodes, joined = _merge(states.pop(i), states.pop(j), k)
        if joined is not None:
            at = len(left)
            left.extend(joined[0].tolist())
            right.extend(joined[1].tolist())
            nodes[len(nodes) - len(joined[0]) :] = np.arange(at, at + len(joined[0]))
        order = np.argsort(-s, kind="stable")
        s, nodes = s[order], nodes[order]
        low = int(s[-1]) if len(s) == k else 0
        states[serial] = (s - low, nodes)
        heapq.heappush(heap, (-(int(s[0]) - low), serial))
        serial += 1
    nodes = states[heap[0][1]][1]
    part = np.zeros(n, int)
    for p, root in enumerate(nodes.tolist()):
        stack = [root]
        while stack:
            x = stack.pop()
            if left[x] < 0:
                part[x] = p
            else:
                stack += (left[x], right[x])
    return part, np.bincount(part, weights=lengths, minlength=k).astype(np.int64)


def windows(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item: as few as the total needs, one more whenever a window would exceed capacity."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        part, sums = difference(lengths, k)
        if sums.max(initial=0) <= capacity:
            return part
        k += 1


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = 2048, tail: int = 16, group_windows: int = 128, end_id: int = 1, words: int = 1_000_000) -> DataFrame:
    """Packs documents (doc_id, text) into sequences of at most `window` ids.

    Whole windows of a document are sequences of their own; pieces of the rests are dealt by a hash of their
    place into groups worth about `group_windows` windows, and each group is partitioned by
    Karmarkar-Karp differencing. Groups hold a bounded number of ids, however long or repeated a document is. A
    worker keeps the ids of `words` words at most, which trades memory for time.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null and empty
    texts have the end id alone; a repeated row is packed again; an empty table gives no rows; extra columns are
    ignored.
    """
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces = common.scratch(token_pieces(docs, tokenizer, window, tail, end_id, words), "pieces")
    whole = F.col("length") == window
    n_whole, rest = pieces.agg(F.count_if(whole), F.coalesce(F.sum(F.when(~whole, F.col("length"))), F.lit(0))).first()
    n_rest = max(1, -(-rest // (window * group_windows)))
    n_full = max(1, -(-n_whole // 8192))
    key = F.xxhash64("place", F.lit(2))
    group = F.when(whole, F.pmod(key, F.lit(n_full)) * 2 + 1).otherwise(F.pmod(key, F.lit(n_rest)) * 2)

    def run(x: pa.Table) -> pa.Table:
        x = x.sort_by([(n, "ascending") for n in ("doc_id", "start", "length", "ids_crc32")])
        g = x["group"][0].as_py()
        lengths = x["length"].to_numpy()
        part = np.arange(len(x)) if g % 2 else windows(lengths, window)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.searchsorted(part[order], part[order])
        offset = np.empty(len(x), np.int64)
        offset[order] = (ends - lengths[order]) - (ends - lengths[order])[first]
        return x.drop_columns("group").append_column("sequence_id", pa.array((g << 24) + part)).append_column("offset", pa.array(offset))

    return pieces.withColumn("group", group).drop("place").groupBy("group").applyInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
