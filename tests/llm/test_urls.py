"""URL rules and the Markov models against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from genoweave.llm import url_filter as U

ODD = [
    None, "", "no scheme", "://", "http://", "https://X.ORG", "https://x.org/", "http://A.Example.ORG/en/1?x#y", "http://example.org/en/2", "http://example.org/es/q", "http://badexample.org/es/q",
    "http://a.com/fr/1", "http://a.com/fr", "http://a.com/de/5.html", "http://com/fr/", "ftp://a/b://c/d", "http://h?q=/fr/", "http://ÄÖ.com/fr/é\n2", "http://a.net/en/1", "http://a.net/en/1",
]


def plain(url: str | None) -> tuple:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules_and_models(spark):
    urls = ODD + [f"http://{h}.{d}/{lang}/{i}" for i in range(60) for h, d, lang in (("good" + "ab"[i % 2], "org", "en"), ("spam" + "xy"[i % 2], "com", "de"), ("fine", "com", "fr"), ("spamx", "net", "en"), ("gooda", "net", "en"))]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string").withColumns({"ruling": F.lit("x"), "w": F.lit(1), "_id": F.lit(2), "gain": F.lit(3)}).repartition(4)
    found = {r.page_id: r for r in U.judge(df).collect()}
    assert len(found) == len(urls)
    held = {r.page_id: r.h for r in df.selectExpr("page_id", "pmod(xxhash64(url), 10) = 0 AS h").collect()}
    fold = lambda u: re.sub(r"[^a-z0./\-_?=&]", "*", re.sub("[0-9]", "0", re.sub(r"^.*?://", "", u or "", count=1, flags=re.S).translate({i: i + 32 for i in range(65, 91)})))
    counts = {"allow": Counter(), "block": Counter()}
    for i, u in enumerate(urls):
        host, path, rule, ruling = plain(u)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        if ruling:
            assert found[i].verdict == ruling
            if not held[i]:
                s = "^^^" + fold(u)
                counts[ruling].update(s[j - k + 1 : j + 1] for j in range(3, len(s)) for k in range(1, 5))

    def probability(c: Counter, w: str) -> float:
        p = 1 / 36
        for k in range(1, 5):
            g = w[-k:]
            after = {x: n for x, n in c.items() if len(x) == k and x[:-1] == g[:-1]}
            if after:
                p = (after.get(g, 0) + len(after) * p) / (sum(after.values()) + len(after))
        return p

    for i, u in list(enumerate(urls))[:26]:
        s = "^^^" + fold(u)
        gains = [math.log(probability(counts["allow"], s[j - 3 : j + 1]) / probability(counts["block"], s[j - 3 : j + 1])) for j in range(3, len(s))]
        assert found[i].score is None if not gains else abs(found[i].score - sum(gains) / len(gains)) < 1e-9
    by_url = {r.url: r for r in found.values()}
    assert by_url["http://spamx.net/en/3"].score < by_url["http://gooda.net/en/4"].score and by_url["http://gooda.net/en/4"].verdict == by_url[None].verdict == "allow"
    free = [r for r in found.values() if r.rule is None and r.score is not None]
    assert max([r.score for r in free if r.verdict == "block"], default=-9) < min(r.score for r in free if r.verdict == "allow")
    assert U.judge(df.limit(0)).count() == 0
    assert {r.verdict for r in U.judge(df, rules=()).collect()} == {"allow"}
