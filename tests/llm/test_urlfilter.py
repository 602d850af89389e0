import random
import re

import pytest

from lakework.llm import urlfilter
from tests.llm.conftest import as_rows, with_clashes


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in rules:
        if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, False, ""), (len(h + p), v == "block", h + p, v))
    return host, path, best[2] if best else None, best[3] if best else default


URLS = [
    None, "", "no scheme/en/", "http://", "http://example.com", "http://example.com/en/", "HTTP://WWW.Example.COM/en/x?q#f", "http://www.example.com/en", "https://a.b.example.com/en/?x", "http://notexample.com/en/1",
    "http://com/", "http://x.com?y=/en/", "ftp://y.net/es/1#z", "http://net/fr/", "http://net/FR/", "http://a.net/esx", "://x.com/", "http://a://b.com/", "http://ÀB.com/é", "http://..com/", "http://x.com/en\n/y", "http://user@example.com:80/en/", "http://" + "a." * 3000 + "example.com/en/",
]


def test_registered_rules_equal_brute_force(spark):
    rng = random.Random(2)
    urls = URLS + ["http://" + rng.choice(("", "www.", "m.")) + rng.choice(("example", "a.example", "q")) + rng.choice((".com", ".net", ".org")) + rng.choice(("", "/", "/en/", "/es/", "/fr/x", "/en/?a")) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, urlfilter.rule_table(spark)).collect()}
    assert got == {i: brute(u, urlfilter.RULES) for i, u in enumerate(urls)}


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_any_rules_equal_brute_force(spark, broadcast):
    rng = random.Random(7)
    label = lambda: rng.choice("abc")
    rules = [(".".join(label() for _ in range(rng.randint(1, 3))), "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 3))), rng.choice(("allow", "block"))) for _ in range(40)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values()) + [("", "/", "block"), (None, "/", "block"), ("a", None, "block")]
    urls = ["h://" + ".".join(label() for _ in range(rng.randint(1, 4))) + "/" + "".join(rng.choice("xy/?#") for _ in range(rng.randint(0, 6))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = urlfilter.judge(df, urlfilter.rule_table(spark, rules), default="none", max_broadcast_rules=broadcast)
    got = {r.page_id: (r.host, r.path, r.verdict, r.rule and len(r.rule)) for r in found.collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute(u, rules, "none")
        assert got[i] == (host, path, verdict, rule and len(rule))


def test_edges(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] * 2, "page_id bigint, url string")
    assert urlfilter.judge(df.limit(0), urlfilter.rule_table(spark)).count() == 0
    out = urlfilter.judge(df, urlfilter.rule_table(spark))
    assert out.count() == 2 * len(URLS)
    assert urlfilter.judge(df, urlfilter.rule_table(spark).limit(0)).where("rule is not null").count() == 0
    wide = urlfilter.judge(with_clashes(df), urlfilter.rule_table(spark))
    assert as_rows(wide.select("page_id", "_host", "_path", "_rule", "_verdict")) == as_rows(out.select("page_id", "host", "path", "rule", "verdict"))


@pytest.mark.parametrize("few", [0, 20_000])
def test_one_url_on_nine_tenths_of_the_pages(spark, few):
    urls = ["http://www.example.com/en/" if i % 10 else None if i % 20 else f"http://{i}.net/es/" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(8)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, urlfilter.rule_table(spark), max_broadcast_urls=few).collect()}
    assert got == {i: brute(u, urlfilter.RULES) for i, u in enumerate(urls)}


def test_sides_over_the_bound_are_not_broadcast(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://{i}.net/es/") for i in range(400)], "page_id bigint, url string")
    df.write.parquet(str(tmp_path / "pages"))
    plan = lambda **few: urlfilter.judge(spark.read.parquet(str(tmp_path / "pages")), urlfilter.rule_table(spark), **few)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    merged = plan(max_broadcast_urls=0)
    assert "SortMergeJoin" in merged and "BroadcastHashJoin" not in merged
