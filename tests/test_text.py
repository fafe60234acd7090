from __future__ import annotations

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinmatch.functions import fuzzy, phonetic, similarity, text
from kinmatch.functions.similarity import cosine, jaccard, levenshtein_norm


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("value", "want"),
    [("Tata  Steel & Co.", "tata steel and company"), ("", ""), ("   ", ""), ("Société", "société"), ("x-y", "x-y"), ("ACME CORP, Pvt. Ltd", "acme corporation private limited"), ("a & b", "a and b"), ("हिन्दी_x", "हिन्दी_x".replace("ि", " ").replace("्", " ").replace("ी", " ").strip())],
)
def test_normalize_name(spark, value, want):
    assert one(spark, lambda c: text.normalize_name(c, unicode=True), value) == " ".join(want.split())


def test_normalize_is_idempotent(spark):
    for v in ("Tata  Steel & Co.", "Société Générale", "A.B.C. Intl"):
        first = one(spark, text.normalize_name, v)
        assert one(spark, text.normalize_name, first) == first


def test_normalize_composes(spark):
    assert one(spark, lambda c: text.normalize_name(c, unicode=True), "Café") == "café"


def test_address(spark):
    assert one(spark, text.normalize_address, "12, MG Rd.") == "12 mg road"


@pytest.mark.parametrize(("value", "want"), [("12 x 560001", "560001"), ("1234567", ""), ("é12345", ""), ("", ""), ("12345 654321", "12345")])
def test_postal_code(spark, value, want):
    assert one(spark, text.postal_code, value) == want


def test_address_numbers(spark):
    assert one(spark, text.address_numbers, "12 a 7 12 b4") == ["12", "7", "12"]


def test_char_ngrams(spark):
    assert sorted(one(spark, lambda c: text.char_ngrams(c, 3), "acme")) == [" ac", "acm", "cme", "me "]
    assert one(spark, lambda c: text.char_ngrams(c, 3), "ab") == []


def test_sorted_tokens(spark):
    assert one(spark, text.sorted_tokens, "state bank of india") == one(spark, text.sorted_tokens, "bank of india state")


def test_fold(spark):
    assert one(spark, text.fold_accents, "Société हि") == "Societe "


def test_similarities(spark):
    df = spark.createDataFrame([(["a", "b"], ["b"], "abc", "abd", [1.0, 0.0], [1.0, 1.0])], "a array<string>, b array<string>, s string, t string, u array<double>, v array<double>")
    r = df.select(jaccard(F.col("a"), F.col("b")), levenshtein_norm(F.col("s"), F.col("t")), cosine(F.col("u"), F.col("v")), jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))).first()
    assert r[0] == 0.5
    assert r[1] == pytest.approx(2 / 3)
    assert r[2] == pytest.approx(2**-0.5)
    assert r[3] == 0.0


def test_ratios():
    assert fuzzy.ratio("this is a test", "this is a test!") == pytest.approx(96.551724)
    assert fuzzy.partial_ratio("this is a test", "this is a test!") == 100
    assert fuzzy.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert fuzzy.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert fuzzy.token_set_ratio("", "a") == 0
    assert fuzzy.weighted_ratio("", "") == 0
    assert fuzzy.jaro_winkler("martha", "marhta") == pytest.approx(0.96111, abs=1e-5)
    assert fuzzy.jaro_winkler("dwayne", "duane") == pytest.approx(0.84)


def test_lcs_is_symmetric():
    for a, b in (("abcbdab", "bdcaba"), ("", "x"), ("é日本", "日é本")):
        assert fuzzy.lcs(a, b) == fuzzy.lcs(b, a)
    assert fuzzy.lcs("abcbdab", "bdcaba") == 4


def test_phonetic():
    assert phonetic.encode("smith") == ("SM0", "XMT")
    assert phonetic.encode("schmidt") == ("XMT", "SMT")
    assert phonetic.encode("") == ("", "")
    assert phonetic.encode(None) == ("", "")
    assert phonetic.encode("日本") == ("", "")
    assert phonetic.encode("knight")[0] == phonetic.encode("night")[0]


def test_ratios_side_by_side():
    """Pairs compared side by side have the values of the plain functions, in half of their time or less."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 8))) for _ in range(30)] + ["é日本", "\U0001f600x", "\x85", "", "-"]
    texts = ["", " ", "a", "b", "ab", "ab ab", "x" * 70, "ab" * 40 + " x", "\x85 ", "日" * 3] + [" ".join(rng.choices(words, k=rng.randint(1, 7))) for _ in range(3000)]
    a, b = rng.choices(texts, k=4000), rng.choices(texts, k=4000)
    a, b = a + texts[:10] * 10, b + [t for t in texts[:10] for _ in range(10)]
    began = time.perf_counter()
    names, addresses = fuzzy._all(pd.Series(a), pd.Series(b), tuple(fuzzy.NAME)), fuzzy._all(pd.Series(a), pd.Series(b), fuzzy.ADDRESS)
    between = time.perf_counter()
    plain = lambda f, x, y: (f(x, y) / (1 if f is fuzzy.jaro_winkler else 100)) if x and y else -1.0
    for n, f in (fuzzy.NAME | {"jaro_winkler": fuzzy.jaro_winkler}).items():
        assert names[n].tolist() == [plain(f, x, y) for x, y in zip(a, b, strict=True)]
        assert n not in fuzzy.ADDRESS or addresses[n].tolist() == names[n].tolist()
    assert between - began < (time.perf_counter() - between) / 2


def test_sizes_of_sets():
    a, b = pd.Series(["ab cd", "x", None, "", "日本 日本"]), pd.Series(["cd ab ab", "xy", "x", "", "日本"])
    got = similarity._sizes(a, b, 3)
    assert got.columns.tolist() == ["n_words", "l_words", "r_words", "n_char3", "l_char3", "r_char3"]
    assert [[None if pd.isna(v) else int(v) for v in r] for r in got.values] == [[2, 2, 2, 4, 5, 6], [0, 1, 1, 0, 0, 0], [None] * 6, [0] * 6, [1, 1, 1, 0, 3, 0]]
