"""Every stage against what it must do with its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from test_line_dedup import plain as lines_plain
from test_mixing import size
from test_ngram_join import plain as join_plain
from test_packing import check as packed

from kinmatch.llm import mixing


@pytest.fixture(scope="module")
def stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], tables).persist())
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_language_keeps_clean_documents(stages):
    ids = {d for d, _ in pairs(stages[1])}
    lost = [t for d, t in pairs(stages[0]) if d not in ids]
    assert len(lost) <= 0.02 * stages[0].count()
    assert Counter(pairs(stages[1])) <= Counter(pairs(stages[0]))


def test_lines(stages):
    want = lines_plain([(d, 0, t) for d, t in pairs(stages[1])])
    got = Counter(pairs(stages[2]))
    assert got <= want
    assert all(not t.strip() for _, t in (want - got).elements())
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    component = {d: c for d, (_, c) in join_plain(pairs(stages[2]), 5, 80).items()}
    assert {d for d, _ in pairs(stages[3])} == {d for d, c in component.items() if c == d}


def test_mix(stages):
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(stages[3]).collect()}
    words = Counter()
    for d, t in pairs(stages[4]):
        words[d] += size(t)
    assert words == Counter({d: n for d, n in taken.items() if n})


def test_pack(stages):
    rows = stages[5].collect()
    whole = Counter(pairs(stages[4]))
    # rows of one document with different texts are told apart by their length alone, so check single ones
    single = {d for d in {d for d, _ in whole} if sum(n for (e, _), n in whole.items() if e == d) == 1}
    assert sum(r["length"] for r in rows) >= len(pairs(stages[4]))
    offsets = Counter()
    for r in rows:
        offsets[r["sequence_id"]] += r["length"]
    assert max(offsets.values()) <= 2048
    texts = [(d, t) for d, t in whole if d in single]
    only = {r["sequence_id"]: 0 for r in rows}
    kept = []
    for r in sorted((r for r in rows if r["doc_id"] in single), key=lambda r: (r["sequence_id"], r["offset"])):
        kept.append({**r.asDict(), "offset": only[r["sequence_id"]]})
        only[r["sequence_id"]] += r["length"]
    packed(kept, texts)


def test_run(spark, tables, stages):
    got = corpus_pipeline.run(spark, tables)
    assert got.columns == stages[5].columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, stages[5].collect()))


def test_empty(spark, stages, tables):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0
