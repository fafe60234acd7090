"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

LETTERS = re.compile(r"[^\W\d_]+")
#: Letters of words up to which a plain forward pass keeps within double precision; longer ones take it in logarithms.
PLAIN_LETTERS = 32
#: Letters of words that go through a forward pass together.
CELLS = 1 << 18
_MULTIPLIER = 1_000_003


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, of any length."""
    return LETTERS.findall((text or "").lower())


def batches_of(words: list[str]) -> Iterator[list[str]]:
    """Words, shortest first, in batches of bounded size; plain and long ones never share one."""
    words, at = sorted(words, key=lambda w: (len(w), w)), 0
    while at < len(words):
        end = at + 1
        while end < len(words) and (end + 1 - at) * len(words[end]) <= CELLS and (len(words[end]) <= PLAIN_LETTERS) == (len(words[at]) <= PLAIN_LETTERS):
            end += 1
        yield words[at:end]
        at = end


class Pieces:
    """The vocabulary as a sorted table of hashed pieces; ids of all substrings of many words at once.

    Pieces at a word's start and inside a word differ. Every character is a piece: unknown ones share an id for
    each position.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        pieces = sorted(p for p in names if LETTERS.fullmatch(p.removeprefix("▁")))
        self.longest = max((len(p.removeprefix("▁")) for p in pieces), default=1)
        self.n = len(pieces) + 2  # the last two: an unknown character at a word's start, and inside
        keys = np.asarray([self._key(p.removeprefix("▁"), p[0] == "▁") for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order.astype(np.int64)

    @staticmethod
    def _key(piece: str, start: bool) -> np.uint64:
        h = 1 if start else 2
        for c in piece:
            h = (h * _MULTIPLIER + ord(c)) % 2**64
        return np.uint64(h)

    def substrings(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids): ids[w, end, n - 1] of the piece of n characters that ends there, -1 for none."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max())
        chars = np.zeros((len(words), width), np.uint64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        chars[np.arange(width) < lengths[:, None]] = flat
        ids = np.full((len(words), width, min(width, self.longest)), -1, np.int32)
        for a in range(width):
            h = np.full(len(words), 1 if a == 0 else 2, np.uint64)
            for n in range(1, min(self.longest, width - a) + 1):
                h = h * np.uint64(_MULTIPLIER) + chars[:, a + n - 1]
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                found = np.where(self.keys[at] == h, self.ids[at], self.n - 2 + (a > 0) if n == 1 else -1)
                ids[:, a + n - 1, n - 1] = np.where(a + n <= lengths, found, -1)
        return lengths, ids


def forward(lengths: np.ndarray, ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """alpha[w, i, l]: summed probability of all segmentations of the first i characters under language l."""
    alpha = np.zeros((len(ids), ids.shape[1] + 1, p.shape[1]))
    alpha[:, 0] = 1.0
    p = np.vstack([p, np.zeros(p.shape[1])])  # id -1
    for end in range(ids.shape[1]):
        for n in range(1, min(ids.shape[2], end + 1) + 1):
            alpha[:, end + 1] += alpha[:, end + 1 - n] * p[ids[:, end, n - 1]]
    return alpha


def forward_log(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Logarithm of forward()'s table, for words of any length; meaningless beyond a word's end."""
    out = np.full((len(ids), ids.shape[1] + 1, p.shape[1]), -np.inf)
    out[:, 0] = 0.0
    p = np.vstack([p, np.zeros(p.shape[1])])  # id -1
    for end in range(ids.shape[1]):
        k = min(ids.shape[2], end + 1)
        before = out[:, end - k + 1 : end + 1][:, ::-1]
        total = np.einsum("wnl,wnl->wl", p[ids[:, end, :k]], np.exp(np.minimum(before - out[:, end, None], 600.0)))
        out[:, end + 1] = out[:, end] + np.log(np.maximum(total, 1e-300))
    return out


def expected_long(ids: np.ndarray, counts: np.ndarray, p: np.ndarray) -> np.ndarray:
    """expected() for one word of any length, given by its ids [end, n - 1] and counts [language]."""
    q = np.log(np.maximum(np.vstack([p, np.zeros(p.shape[1])]), 1e-300))
    alpha, width = forward_log(ids[None], p)[0], len(ids)
    beta = np.full_like(alpha, -np.inf)
    beta[width] = 0.0
    out = np.zeros((len(p) + 1, p.shape[1]))
    for start in range(width - 1, -1, -1):
        n = np.arange(1, min(ids.shape[1], width - start) + 1)
        n = n[ids[start + n - 1, n - 1] >= 0]
        i = ids[start + n - 1, n - 1]
        through = q[i] + beta[start + n]
        top = through.max(0)
        beta[start] = top + np.log(np.exp(through - top).sum(0))
        np.add.at(out, i, counts * np.exp(alpha[start] + through - alpha[width]))
    return out[:-1]


def expected(lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language] over all segmentations of words that stand counts[w, l] times."""
    alpha = forward(lengths, ids, p)
    rows = np.arange(len(ids))
    total = alpha[rows, lengths]
    beta = np.zeros_like(alpha)
    beta[rows, lengths] = counts / np.maximum(total, 1e-300)
    q = np.vstack([p, np.zeros(p.shape[1])])
    out = np.zeros_like(q)
    for end in range(ids.shape[1] - 1, -1, -1):
        for n in range(1, min(ids.shape[2], end + 1) + 1):
            i = ids[:, end, n - 1]
            through = q[i] * beta[:, end + 1]
            np.add.at(out, i, alpha[:, end + 1 - n] * through)
            beta[:, end + 1 - n] += through
    return out[:-1]


class Model:
    """Languages, their log priors and piece probabilities. Scores words with a bounded cache."""

    def __init__(self, languages: list[str], prior: np.ndarray, p: np.ndarray, path: str):
        self.languages, self.prior, self.p, self.path = languages, prior, p, path

    def start(self, bound: int = 250_000) -> Model:
        self.pieces, self.bound = Pieces(self.path), bound
        self.known: dict[str, int] = {}
        self.letters = 0
        self.scores = np.zeros((bound + 1, len(self.languages)))
        return self

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        self.letters += sum(map(len, new))
        if len(self.known) + len(new) > self.bound or self.letters > 32 * self.bound:
            self.known.clear()
            self.letters = sum(map(len, words))
            new = list(words)
            if len(new) > self.bound:
                self.bound = len(new)
                self.scores = np.zeros((self.bound + 1, len(self.languages)))
        for part in batches_of(new):
            lengths, ids = self.pieces.substrings(part)
            rows = np.arange(len(part))
            first = len(self.known)
            if len(part[-1]) <= PLAIN_LETTERS:
                score = np.log(np.maximum(forward(lengths, ids, self.p)[rows, lengths], 1e-300))
            else:
                score = forward_log(ids, self.p)[rows, lengths]
            self.scores[first : first + len(part)] = score
            self.known.update(zip(part, range(first, first + len(part)), strict=True))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """(language, posterior); und and 0 where there is no letter. Ties go to the first language."""
        lists = [words_of(t) for t in texts]
        words = set().union(*lists)
        if not words or not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        self.learn(words)
        get = self.known.__getitem__
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        index = np.fromiter((i for x in lists for i in map(get, x)), np.int64, int(sizes.sum()))
        full = np.flatnonzero(sizes)
        total = np.add.reduceat(self.scores[index], np.cumsum(sizes)[full] - sizes[full]) + self.prior
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        for k, b, s in zip(full.tolist(), best.tolist(), score.tolist(), strict=True):
            names[k], scores[k] = self.languages[b], s
        return names, scores


def train(labelled: DataFrame, docs_per_language: int = 600, longest: int = 20_000, rounds: int = 3, vocabulary: str | None = None) -> Model:
    """Fits piece probabilities by EM on a bounded sample of labelled rows (doc_id, text, lang).

    The sample is taken by a hash of doc_id: about `docs_per_language` texts of each language, of up to `longest`
    characters; priors come from all rows. The driver gets the sample's distinct words with their counts, which
    these parameters and the number of languages bound.
    """
    path = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)), path)
    share = F.lit(0.0)
    for k in languages:
        share = F.when(F.col("lang") == k, F.lit(min(1.0, docs_per_language / sizes[k]))).otherwise(share)
    taken = labelled.where((F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30)) & (F.length("text") <= longest))
    words = taken.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counted = words.groupBy("lang", "word").count().toPandas()
    prior = np.asarray([sizes[k] for k in languages], float)
    pieces = Pieces(path)
    p = np.full((pieces.n, len(languages)), 1.0 / pieces.n)
    if len(counted):
        rows: dict[str, np.ndarray] = {}
        column = {k: i for i, k in enumerate(languages)}
        for lang, word, n in zip(counted["lang"], counted["word"], counted["count"], strict=True):
            for w in words_of(word):
                rows.setdefault(w, np.zeros(len(languages)))[column[lang]] += n
        for _ in range(rounds):
            total = np.full_like(p, 0.02)  # an imagined share of an occurrence for each piece
            for part in batches_of(list(rows)):
                lengths, ids = pieces.substrings(part)
                if len(part[-1]) <= PLAIN_LETTERS:
                    total += expected(lengths, ids, np.stack([rows[w] for w in part]), p)
                else:
                    for w, n, i in zip(part, lengths.tolist(), ids, strict=True):
                        total += expected_long(i[:n], rows[w], p)
            p = total / total.sum(0)
    return Model(languages, np.log(prior / prior.sum()), p, path)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score (posterior) to documents with a column text; all columns stay.

    und and 0 where the text is null or has no letter, or nothing was learned. Every run of letters of the whole
    text counts. Columns lang_pred and score of the input are replaced. Repeated rows get the same prediction.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    keep = docs.drop("lang_pred", "score")
    schema = T.StructType([*keep.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        common.release()
        m = shared.value if hasattr(shared.value, "known") else shared.value.start()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                names, scores = m.predict(part.column(part.schema.get_field_index("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    common.small_batches(spark)
    return keep.mapInArrow(run, schema)
