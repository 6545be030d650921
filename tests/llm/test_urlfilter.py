import random
import re

from dimweave.llm import urlfilter
from dimweave.llm.queries import URL_RULES


def brute(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), v, h + p) for v, h, p in rules if m and (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, verdict, rule = max(fits, default=(0, "allow", None))
    return host, path, rule, verdict


def run(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    return [tuple(r)[1:] for r in sorted(urlfilter.filter_urls(df, urlfilter.rule_table(spark, rules)).collect())]


def test_urls_and_rules(spark):
    rng = random.Random(2)
    hosts = ["net", "a.net", "x.example.net", "Example.NET", "example.com", "w.example.com", "org", "b.org", "notexample.com", "exampleXnet", "a..net", "", "u@e.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/x", "/fr/", "/fr", "//", "/EN/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{p}{t}" for h in hosts for p in paths for t in ("", "?q=/de/", "#x")]
    urls += [None, "", "example.net/en/", "http:/x.net/", "://", "a://b://c.net/", "http://x.net/\n/en/", urls[0], urls[0]]
    for rules in (URL_RULES, [*URL_RULES, ("block", "b.org", "/f"), ("allow", "b.org", "/f"), ("block", "example.net", "/en/1")], [("block", "", "/")]):
        assert run(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_no_rules_and_no_rows(spark):
    assert run(spark, ["http://a.net/"], []) == [("a.net", "/", None, "allow")]
    assert run(spark, [], URL_RULES) == []


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "http://a.net/"), (1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    got = urlfilter.filter_urls(df, urlfilter.rule_table(spark, URL_RULES)).collect()
    assert sorted((str(r.page_id), r.verdict) for r in got) == [("1", "block"), ("1", "block"), ("None", "block")]
