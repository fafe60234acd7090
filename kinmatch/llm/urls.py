"""URL filtering: rules first; else unigram Viterbi word segmentation and multinomial naive Bayes."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Longest dictionary word that Viterbi tries.
LONGEST = 20
#: Words that stand for a class before anything is learned, each worth SEED_COUNT sightings: a prior that any learned
#: word outweighs.
SEEDS = {
    "block": ("casino", "bet", "bets", "betting", "poker", "slots", "jackpot", "pills", "pharmacy", "viagra", "cheap", "spam", "farm", "ads", "ad", "track", "tracker", "click", "xxx", "x", "porn", "sex", "adult", "nude", "escort", "dating", "loan", "loans", "payday", "replica", "torrent", "warez", "crack", "malware", "phish", "scam", "win", "winner", "prize"),
    "allow": ("news", "blog", "wiki", "docs", "doc", "help", "forum", "article", "articles", "post", "posts", "library", "school", "university", "science", "history", "research", "journal", "museum", "guide", "learn", "book", "books", "health", "travel", "recipe", "www", "en", "html", "page", "org", "edu", "gov"),
}
SEED_COUNT = 1
#: A run of digits of any length is one token.
NUMBER = "0"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty where there is no `://`."""
    url = F.coalesce(url, F.lit(""))
    part = lambda k: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k)
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain, and its path as a prefix.

    Rules are (verdict, host + path); null where none fits.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Splits concatenated letters into dictionary words by unigram Viterbi.

    The dictionary is the whole words of a fixed public vocabulary; their ids grow with rarity, so that a word's
    probability is taken as 1 / (rank + 100), normalised. A letter outside costs twice what the rarest
    word does, so that words are found wherever they fit; letters left over stand alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(path).get_vocab()
        ranks = {w[:-4]: i for w, i in vocabulary.items() if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha() and w.islower() and len(w) > 5}
        total = sum(1 / (i + 100) for i in ranks.values())
        self.cost = {w: math.log((i + 100) * total) for w, i in ranks.items()}
        self.unknown = 2.0 * max(self.cost.values())
        self.split = lru_cache(maxsize=100_000)(self._split)

    def _split(self, run: str) -> tuple[str, ...]:
        best, last = [0.0], [0]
        for end in range(1, len(run) + 1):
            cost, at = best[end - 1] + self.unknown, end - 1
            for a in range(max(0, end - LONGEST), end):
                if (c := self.cost.get(run[a:end])) is not None and best[a] + c < cost:
                    cost, at = best[a] + c, a
            best.append(cost)
            last.append(at)
        out, end = [], len(run)
        while end:
            out.append(run[last[end] : end])
            end = last[end]
        return tuple(reversed(out))

    def tokens(self, host: str, path: str) -> list[str]:
        """Tokens of host and path, which are marked apart; letters are segmented, digits are one token."""
        found = []
        for mark, text in (("h:", host), ("p:", path.lower())):
            for run in re.findall(r"[^\W\d_]+|\d+", text):
                found += [mark + NUMBER] if run[0].isdigit() else [mark + w for w in (self.split(run) if len(run) <= 64 else self._split(run))]
        return found


def segmenter(path: str) -> Segmenter:
    return common.held(f"segmenter {path}", lambda: Segmenter(path))


def weights(counted: dict[str, tuple[int, int]], urls: tuple[int, int]) -> tuple[float, dict[str, float]]:
    """Naive Bayes as log odds of block: (of the classes, of each token), Laplace-smoothed, seeds included."""
    counts = {t: [float(a), float(b)] for t, (a, b) in counted.items()}
    for k, words in enumerate((SEEDS["allow"], SEEDS["block"])):
        for w in words:
            for mark in ("h:", "p:"):
                counts.setdefault(mark + w, [0.0, 0.0])[k] += SEED_COUNT
    allow, block = (sum(c[k] for c in counts.values()) + len(counts) for k in (0, 1))
    prior = math.log((urls[1] + 1) / (urls[0] + 1))
    return prior, {t: math.log((c[1] + 1) / block) - math.log((c[0] + 1) / allow) for t, c in counts.items()}


def judge(pages: DataFrame, rules: list[tuple[str, str]], vocabulary: str | None = None) -> DataFrame:
    """Verdict on the url of every page (page_id, url).

    A rule that fits decides. Else host and path are segmented and scored by naive Bayes, which learns from all
    urls that a rule decides and from seed words; a score above 0 blocks. Token counts have at most one row for
    each dictionary word or single letter, so the model is bounded.

    Returns page_id, host, path, rule, verdict, score (log odds of block, null where a rule decided) and tokens.
    A null url or one without `://` has an empty host and path and the verdict of the classes alone; repeated
    rows are judged each; an empty table gives no rows; extra columns are ignored.
    """
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    host, rest = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), rest.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    split = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("decided"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        words = segmenter(path)
        for b in batches:
            yield {**b, "tokens": [words.tokens(h, p) for h, p in zip(b["host"].to_pylist(), b["path"].to_pylist(), strict=True)]}

    schema = "page_id long, host string, path string, rule string, decided string"
    cut = common.scratch(common.map_batches(split, run, f"{schema}, tokens array<string>"), "urls")
    blocked = F.count_if(F.col("decided") == "block")
    labelled = cut.where(F.col("decided").isNotNull())
    urls = labelled.agg(F.count("*") - blocked, blocked).first()
    each = labelled.select("decided", F.explode("tokens").alias("token")).groupBy("token").agg((F.count("*") - blocked).alias("a"), blocked.alias("b"))
    prior, odds = weights({r["token"]: (r["a"], r["b"]) for r in each.collect()}, tuple(urls))
    shared = cut.sparkSession.sparkContext.broadcast(odds)

    def score(batches: Iterator[dict]) -> Iterator[dict]:
        known = shared.value
        for b in batches:
            scores = [None if d is not None else prior + sum(known.get(t, 0.0) for t in x) for d, x in zip(b["decided"].to_pylist(), b["tokens"].to_pylist(), strict=True)]
            verdicts = [d or ("block" if s > 0 else "allow") for d, s in zip(b["decided"].to_pylist(), scores, strict=True)]
            yield {k: v for k, v in b.items() if k != "decided"} | {"verdict": verdicts, "score": scores}

    return common.map_batches(cut, score, "page_id long, host string, path string, rule string, verdict string, score double, tokens array<string>")
