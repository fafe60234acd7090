from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinmatch.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, window=2048):
    """Every id in one piece, windows gapless and within capacity."""
    t = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for doc, text in docs:
        ids = np.asarray([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want[doc].append(ids)
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        ids = want[doc][0]
        assert sum(p["length"] for p in pieces) == sum(map(len, want[doc]))
        covered = np.zeros(len(ids), int)
        for p in pieces:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(part.tobytes())
            covered[p["start"] : p["start"] + p["length"]] += 1
        assert (covered == len(want[doc])).all()
    for spans in by_window.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= window


def test_edge_cases(spark, edge, none):
    check(packing.pack(edge).collect(), [(r["doc_id"], r["text"]) for r in edge.collect()])
    check(packing.pack(edge, window=64).collect(), [(r["doc_id"], r["text"]) for r in edge.collect()], 64)
    assert packing.pack(none).count() == 0


def test_supplied_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = packing.pack(docs).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(r["length"] for r in rows) > 0.95 * 2048 * len({r["sequence_id"] for r in rows})


@pytest.mark.parametrize("text", ["don't we'll x's", "ÀÉ İstanbul ΣΑΣ ſK ß", "éa ́x", "a1b2 3.14", "​ zero", "日本語 テスト", "emoji 😀!! a_b", "<|endoftext|> x", "a <|endoftext|> b", "a<|startoftext|>b", "<|ENDOFTEXT|>", "<| endoftext |>", "x\x1cy", "it's, 'tis 'S", "foo--bar. ..."])
def test_ids_are_the_tokenizers(text):
    words = packing.WordIds(PATH)
    plain = np.asarray(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert words.of([text, text])[1] == words.whole(text) == plain


def test_repeats_of_one_row_stay_in_bounded_groups(spark):
    df = spark.range(40_000).selectExpr("if(id % 2 = 0, 7, null) as doc_id", "'some words that repeat' as text")
    rows = packing.pack(df, window=64, group_windows=16).groupBy((F.col("sequence_id").bitwiseAND(~((1 << 24) - 1))).alias("group")).count().collect()
    assert sum(r["count"] for r in rows) >= 40_000 and max(r["count"] for r in rows) < 1000


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    words = packing.words_of(PATH)
    assert words.of([text])[0] == words.whole(text)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_windows_hold(lengths):
    part = packing.windows(np.asarray(lengths), 64)
    assert max(np.bincount(part, weights=lengths)) <= 64


def test_differencing_balances():
    rng = np.random.default_rng(0)
    _, sums = packing.difference(rng.integers(1, 500, 400), 30)
    assert sums.max() - sums.min() <= 10


def test_two_way_example():
    _, sums = packing.difference(np.asarray([8, 7, 6, 5, 4]), 2)
    assert sorted(sums) == [14, 16]  # the published difference of 2
