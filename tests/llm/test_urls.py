from __future__ import annotations

import re

from kinmatch.llm import urls
from kinmatch.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://a.com", "http://a.com/x://y", "ftp://example.com/en/a", "http://www.example.com/en/", "http://badexample.com/en/", "http://x.net/es/9", "http://x.net/de/9", "x://é.org/π#f", "http://cheap-pills.example.org/en/1", "http://user:pw@h.org:80?q", "http://" + "ab" * 5000 + ".org/" + "z9" * 5000, "http://a\nb.net/fr/"]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = (None, None)
    for verdict, rule in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def test_edge_cases(spark):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://a.com/", None, None), (4, URLS[4], "x", "y")], "page_id long, url string, host string, tokens string")
    got = {r["page_id"]: r for r in urls.judge(df, URL_RULES).collect()}
    assert urls.judge(df, URL_RULES).count() == len(URLS) + 2
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0), URL_RULES).count() == 0


def test_supplied_pages(spark, tables):
    df = spark.read.parquet(f"{tables}/pages.parquet")
    for r in urls.judge(df, URL_RULES).join(df, "page_id").collect():
        host, path, rule, verdict = plain(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict in (None, r["verdict"])


def test_segmentation():
    import public_tokenizers

    s = urls.segmenter(public_tokenizers.path("word_bpe_49k.json"))
    assert s.split("cheapflights") == ("cheap", "flights")
    assert s.split("onlinecasinogames") == ("online", "casino", "games")
    assert "".join(s.split("qzxjkvw")) == "qzxjkvw"


def test_learned_words_block():
    prior, odds = urls.weights({"h:casino": (0, 50), "h:library": (50, 0)}, (50, 50))
    assert odds["h:casino"] + prior > 0 > odds["h:library"] + prior
