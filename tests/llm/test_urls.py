"""Url filter against the same models in plain Python."""

import math
import re
import zlib
from collections import Counter, defaultdict

from fleetlife.llm import urls

RULES = urls.RULES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def plain_rule(host, path):
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


class Model:
    def __init__(self, texts, order):
        self.order, self.counts = order, defaultdict(Counter)
        for text in texts:
            text = "\2" * order + text + "\3"
            for i in range(order, len(text)):
                for k in range(order + 1):
                    self.counts[text[i - k : i]][text[i]] += 1

    def p(self, context, char):
        low = self.p(context[1:], char) if context else 1 / 256
        own = self.counts.get(context)
        return (own[char] + len(own) * low) / (sum(own.values()) + len(own)) if own else low

    def log(self, text):
        text = "\2" * self.order + text + "\3"
        return sum(math.log(self.p(text[i - self.order : i], text[i])) for i in range(self.order, len(text)))


def test_equals_plain_models(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    odd = [(-1, None), (-2, "no host"), (-3, "HTTP://WWW.Example.COM/en/x?y"), (-4, "a://com"), (-5, "://"), (-6, "x://net/es/#q"), (-7, "x://Ünet/es/"), (-8, "http://a/\nb://c"), (-8, "http://a/\nb://c")]
    pages = table.union(spark.createDataFrame(odd, table.schema)).selectExpr("url", "page_id", "1 as host", "'t' as text", "2 as rule")
    got = urls.url_filter(pages).collect()
    rows = [(r.page_id, r.url) for r in pages.collect()]
    assert len(got) == len(rows)
    kinds = {"allow": [], "block": []}
    for _, url in rows:
        text = "".join(plain_parts(url))
        verdict = plain_rule(*plain_parts(url))[1]
        if verdict and zlib.crc32(text.encode()) % 5:
            kinds[verdict].append(text)
    allow, block = (Model(kinds[k], urls.ORDER) for k in ("allow", "block"))
    url_of = dict(rows)
    for r in got:
        host, path = plain_parts(url_of[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict:
            assert r.verdict == verdict and r.score is None
        else:
            text = host + path
            assert abs(r.score - (allow.log(text) - block.log(text)) / (len(text) + 1)) < 1e-9
            assert r.verdict == ("allow" if r.score >= r.threshold else "block")


def test_whole_urls_are_judged(spark):
    rows = [(i, f"x://a.com/p{i}?good=yes") for i in range(20)] + [(100 + i, f"x://a.net/es/p{i}?bad=spam") for i in range(20)]
    asked = [(200, "x://b.org/p?good=yes"), (201, "x://b.org/p?bad=spam"), (202, "good=yes"), (203, "bad=spam"), (204, None)]
    pages = spark.createDataFrame(rows + asked, "page_id long, url string")
    got = {r.page_id: r for r in urls.url_filter(pages, whole=True).collect()}
    assert got[200].score > got[201].score and got[202].score > got[203].score
    assert (got[200].host, got[200].path, got[202].host) == ("b.org", "/p", "")
    kinds = {"allow": [], "block": []}
    for _, url in rows:
        if zlib.crc32(url.encode()) % 5:
            kinds[plain_rule(*plain_parts(url))[1]].append(url)
    allow, block = (Model(kinds[k], urls.ORDER) for k in ("allow", "block"))
    for page_id, url in asked:
        text = url or ""
        assert abs(got[page_id].score - (allow.log(text) - block.log(text)) / (len(text) + 1)) < 1e-9


def test_threshold_separates(spark):
    rows = [(0.5 + i / 100, "allow") for i in range(10)] + [(-0.5 - i / 100, "block") for i in range(5)]
    least = urls.threshold(spark.createDataFrame(rows, "score double, verdict string"))
    assert -0.5 < least <= 0.5
    assert urls.threshold(spark.createDataFrame(rows[:10], "score double, verdict string")) == 0


def test_nothing_decided_and_nothing_there(spark):
    pages = spark.createDataFrame([(1, "x://org/a"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urls.url_filter(pages).collect()} == {"allow"}
    assert urls.url_filter(pages.limit(0)).collect() == []
