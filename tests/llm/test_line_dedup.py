from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from brute import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.llm import line_dedup


BLANKS = " \t\n\x0b\x0c\r"


def slow_chunks(hashes, seed):
    """Borders by the definition: the last two lines' polynomial hash, for 2 to 12 lines a chunk."""
    out, start = [], 0
    for i, h in enumerate(hashes):
        roll = (h + (hashes[i - 1] * 0x9E3779B97F4A7C15 if i else 0)) % 2**64
        hit = (roll * ((2 * seed + 1) * 0xD6E8FEB86659FD93) % 2**64 >> 40) % 2 == 0
        if i + 1 - start >= 12 or (i + 1 - start > 1 and hit):
            out.append(i + 1)
            start = i + 1
    if start < len(hashes):
        out = [*out[:-1], len(hashes)] if len(hashes) - start == 1 and out else [*out, len(hashes)]
    return out


def slow_spans(text):
    lines = text.split("\n")
    if len(lines) < 2:
        return set()
    full = [i for i, x in enumerate(lines) if x.strip(BLANKS)]
    spans = {(a, z + 1) for a, z in zip(full, full[1:], strict=False)} | {(i, i + 1) for i in full if len(re.findall(r"[^\x20\x09-\x0D]+", lines[i])) > 50}
    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    for seed in range(3):
        ends = slow_chunks(hashes, seed)
        spans |= {(a, z) for a, z in zip([0, *ends], ends, strict=False) if sum(a <= i < z for i in full) > 1}
    return spans


def plain(rows):
    """Text of every row (doc_id, hash, text) after later places of each repeated run of lines are gone."""
    places = defaultdict(list)
    for d, h, t in rows:
        for a, z in slow_spans(t or ""):
            places["\n".join(t.split("\n")[a:z])].append((d is not None, d or 0, h, a))
    out = []
    for d, h, t in rows:
        if t is None:
            out.append((d, None))
            continue
        lines, gone = t.split("\n"), set()
        for a, z in slow_spans(t):
            found = places["\n".join(lines[a:z])]
            if d is not None and len(found) > 1 and min(found) != (True, d, h, a):
                gone.update(range(a, z))
        out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return Counter(out)


def agree(df):
    rows = [tuple(r) for r in df.select("doc_id", F.xxhash64("text"), "text").collect()]
    got = line_dedup.dedup(df)
    assert got.columns == [*(c for c in df.columns if c not in ("lines_removed", "lines_kept")), "lines_removed", "lines_kept"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == plain(rows)


def test_edge_cases(edge, none):
    agree(edge)
    assert line_dedup.dedup(none).count() == 0


def test_repeated_ids_and_any_column_names(spark):
    """Two texts of one doc_id, null ids, equal rows, and columns that are named like ours."""
    six = "\n".join(prose(300 + i, 9) for i in range(6))
    other = "\n".join(prose(400 + i, 9) for i in range(6))
    rows = [(1, six), (2, f"{six}\n{prose(7, 9)}"), (2, other), (None, six), (None, six), (3, other), (3, other), (4, None), (4, "")]
    df = spark.createDataFrame([(d, t, 1, 2, 3, 4, 5, 6, 7) for d, t in rows], "doc_id long, text string, gone int, gone_id int, hash int, doc int, code int, own int, lines_kept int")
    agree(df)
    texts = {(r["doc_id"], r["text"]) for r in line_dedup.dedup(df).collect()}
    assert (2, other) in texts and (None, six) in texts


def test_shared_passages(spark):
    passage = "\n".join(prose(100 + i, 12) for i in range(8))
    rows = []
    for i in range(40):
        own = [prose(1000 + 10 * i + j, 9) for j in range(5)]
        rows.append((i, "\n".join([*own[:2], passage, *own[2:]]) if i % 2 else "\n".join(own)))
    rows += [(100, rows[1][1]), (101, passage + "\n" + passage), (102, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    agree(df)
    kept = defaultdict(int)
    for r in line_dedup.dedup(df).collect():
        for line in (r["text"] or "").split("\n"):
            kept[line] += 1
    # most lines of the passage stand once now, and every clean line stays
    assert sum(kept[x] < 8 for x in passage.split("\n")) >= 5
    assert all(kept[x] >= 1 for x in rows[0][1].split("\n"))


def test_supplied_documents(spark, tables):
    agree(spark.read.parquet(f"{tables}/documents.parquet"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=60))
def test_chunks_cover_all_lines(lines):
    ends = line_dedup.chunks(line_dedup.line_hashes(lines), 2, 2, 12)
    sizes = [z - a for a, z in zip([0, *ends], ends, strict=False)]
    assert ends == slow_chunks([xxhash.xxh64_intdigest(x) for x in lines], 0)
    assert sum(sizes) == len(lines) and (len(lines) == 1 or min(sizes) >= 2) and max(sizes) <= 13


def test_borders_return_after_a_shift():
    lines = line_dedup.line_hashes([prose(i, 6) for i in range(200)])
    a = line_dedup.chunks(lines, 2, 2, 12)
    b = line_dedup.chunks(np.concatenate([lines[:1] + np.uint64(7), lines]), 2, 2, 12)
    assert len({x + 1 for x in a} & set(b)) > 0.8 * len(a)


def test_short_passages_and_long_lines_go_whole(spark):
    """Passages of one to four lines, between lines that no other document has, lose every line but at one place."""
    rows, want = [], {}
    for k in range(60):
        n = 1 + k % 4
        passage = [prose(5000 + 10 * k + j, 60 if n == 1 else 30) for j in range(n)]
        if n > 2:
            passage.insert(1, "")
        for side in range(2):
            before, after = ([prose(90_000 + 100 * k + 10 * side + j, 9) for j in range(m, m + 3)] for m in (0, 5))
            rows.append((2 * k + side, "\n".join([*before, *passage, *after])))
            want[2 * k + side] = "\n".join([*before, *(passage if side == 0 else []), *after])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(df).collect()} == want
