"""URL rules: the token index against running every expression."""

import random
import re

from tablero.llm.queries import HOST_RULES, PATTERN_RULES
from tablero.llm.urls import Rule, host_rule, index, judge

RULES = [host_rule(v, p) for v, p in HOST_RULES] + [Rule(p) for p in PATTERN_RULES] + [Rule("||ok.net/a*b/"), Rule("/x*/y/", "allow")]


def brute(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [r for r in RULES if r.exact and (lambda h, p: (host == h or host.endswith("." + h)) and path.startswith("/" + p))(*r.name.split("/", 1))]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    blocked = any(re.search(r.regex, host + path) for r in RULES if not r.exact and r.verdict == "block")
    return host, path, None, "block" if blocked else "allow"


def fixture():
    rng = random.Random(8)
    urls = [None, "", "no scheme", "://", "http://", "x://a://b/", "http://EXAMPLE.com/en/1", "http://notexample.com/en/", "http://com/", "http://com",
            "http://a.net/es/?q", "https://a.net/es", "http://É.Com/x", "http://org/http://b.net/es/", "http://spam-a.org/x", "http://b.spam-a.org",
            "http://org/spam-x/", "http://ok.net/a1/b/", "http://ok.net/aab/", "u://h/ads/", "u://h/ads", "http://example.com:80/en/", "a\nb://www.example.com/en/"]
    labels = ["www", "example", "com", "net", "org", "spam-a", "ads", "EN", "xcom", "track"]
    parts = ["en", "es", "fr", "ads", "login", "a?b", "c#d", "search", "tag", ""]
    urls += ["http://" + ".".join(rng.choices(labels, k=rng.randrange(1, 5))) + rng.choice(["", "/"]) + "/".join(rng.choices(parts, k=rng.randrange(4)))
             for _ in range(400)]
    return urls + ["http://www.example.com/en/" + "x/" * 20000]


def test_against_every_rule(spark):
    urls = fixture()
    pages = spark.createDataFrame([(i, u, "clash", 3) for i, u in enumerate(urls + urls[:9])], "page_id long, url string, rule string, tokens int")
    out = judge(pages, RULES)
    assert out.columns == ["page_id", "url", "tokens", "host", "path", "rule", "verdict", "n_tried"]
    rows = out.collect()
    assert len(rows) == len(urls) + 9
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url), r.url
    assert sum(r.n_tried for r in rows) < len(rows) * len(RULES) / 4


def test_rarest_token_and_empty_tables(spark):
    pages = spark.createDataFrame([("example.com/en/",), ("example.com/",), ("x.com/",)], "a string")
    assert index(pages, [host_rule("block", "example.com/en/"), host_rule("allow", "com/")]) == {"en": [0], "com": [1]}
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge(none, RULES).count() == 0
    assert [r.verdict for r in judge(spark.createDataFrame([("a://b",)], "url string"), []).collect()] == ["allow"]


def test_rules_in_parts(spark, monkeypatch):
    import tablero.llm.urls as urls
    monkeypatch.setattr(urls, "MOST_RULES", 3)
    pages = spark.createDataFrame([(u,) for u in fixture()], "url string")
    assert all((r.host, r.path, r.rule, r.verdict) == brute(r.url) for r in judge(pages, RULES).collect())


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([("a://b",)], "url string")
    assert "Python" not in judge(pages, RULES)._jdf.queryExecution().executedPlan().toString()
