from __future__ import annotations

import itertools
import math
from fractions import Fraction

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from kinmatch.llm import language, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every_segmentation(word, pieces, p):
    """Probability of a word by listing all ways to cut it."""
    known = dict(zip(pieces.keys.tolist(), pieces.ids.tolist(), strict=True))
    total = 0.0
    for cuts in itertools.product((False, True), repeat=len(word) - 1):
        parts, a = [], 0
        for i, c in enumerate((*cuts, True), 1):
            if c:
                parts.append((a, word[a:i]))
                a = i
        product = 1.0
        for at, part in parts:
            i = known.get(int(pieces._key(part, at == 0)))
            if i is None:
                i = pieces.n - 2 + (at > 0) if len(part) == 1 else None
            product *= p[i] if i is not None else 0.0
        total += product
    return total


def test_forward_sums_all_segmentations():
    pieces = language.Pieces(PATH)
    p = np.random.default_rng(1).random((pieces.n, 2))
    p /= p.sum(0)
    words = ["a", "the", "thing", "straße", "école", "日本", "xqzj", "internat"]
    lengths, ids = pieces.substrings(words)
    alpha = language.forward(lengths, ids, p)
    for i, w in enumerate(words):
        for k in range(2):
            assert math.isclose(alpha[i, len(w), k], every_segmentation(w, pieces, p[:, k]), rel_tol=1e-9)


def test_expected_counts_add_up():
    """EM's counts cover each word's letters exactly once."""
    pieces = language.Pieces(PATH)
    p = np.full((pieces.n, 1), 1 / pieces.n)
    lengths, ids = pieces.substrings(["thing", "other"])
    size = np.zeros(pieces.n)
    got = language.expected(lengths, ids, np.ones((2, 1)), p)[:, 0]
    for w in range(2):
        for end in range(ids.shape[1]):
            for n in range(ids.shape[2]):
                if ids[w, end, n] >= 0:
                    size[ids[w, end, n]] = n + 1
    assert math.isclose((got * size).sum(), 10, rel_tol=1e-9)


def test_held_out_accuracy(spark, tables):
    folder = tables.replace("sf0.001", "sf0.01")
    out = queries.op7_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert r[0] >= 0.97 and 0 <= r[1] <= r[2] <= 1


def test_edge_cases(spark, edge, none):
    model = language.train(edge)
    got = {r["doc_id"]: r for r in language.identify(edge, model).collect()}
    assert language.identify(edge, model).count() == edge.count()
    assert language.identify(edge, model).columns == [*edge.columns, "lang_pred", "score"]
    for d in (0, 1, 2, 13):
        assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0.0)
    assert got[11]["lang_pred"] == "en"
    nothing = language.train(none)
    assert {r["lang_pred"] for r in language.identify(edge, nothing).collect()} == {"und"}
    assert language.identify(none, model).count() == 0


def test_words_of_any_length_sum_all_segmentations():
    """The pass in logarithms equals the plain one, a plain recursion in fractions for a long run, and EM's counts."""
    pieces = language.Pieces(PATH)
    assert pieces.longest > 6
    p = np.random.default_rng(2).random((pieces.n, 2))
    p /= p.sum(0)
    lengths, ids = pieces.substrings(["internationalisation"[:14], "a"])
    assert np.allclose(language.forward_log(ids, p)[0, 14], np.log(language.forward(lengths, ids, p)[0, 14]))
    assert math.isclose(math.exp(language.forward_log(ids, p)[0, 14, 0]), every_segmentation("internationalisation"[:14], pieces, p[:, 0]), rel_tol=1e-9)
    got = language.expected_long(ids[0][:14], np.ones(2), p)
    assert np.allclose(got, language.expected(lengths[:1], ids[:1], np.ones((1, 2)), p))
    word = ("strasseninformation" * 11)[:200]
    lengths, ids = pieces.substrings([word])
    alpha = [Fraction(1)]
    for end in range(200):
        alpha.append(sum((alpha[end + 1 - n] * Fraction(float(p[ids[0, end, n - 1], 0])) for n in range(1, min(pieces.longest, end + 1) + 1) if ids[0, end, n - 1] >= 0), Fraction(0)))
    want = math.log(alpha[200].numerator) - math.log(alpha[200].denominator)
    assert math.isclose(language.forward_log(ids, p)[0, 200, 0], want, rel_tol=1e-9)


def test_long_words_are_whole():
    assert "".join(language.words_of("x" * 100)) == "x" * 100
