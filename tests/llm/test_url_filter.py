import random

import pytest

from airpanel.llm.queries import URL_RULES
from airpanel.llm.url_filter import judge_urls

SCHEMA = "page_id long, url string, host string, path string, rule string"


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:cut], rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (r[1].count("."), len(r[2]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else default


URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "https://A.Example.ORG/es/x?y#z", "http://example.org/en/173",
    "http://example.org/en/", "http://notexample.org/es/", "http://x.com/fr", "http://x.com/fr/", "http://x.com/de/a/b", "http://x.com:80/de/",
    "a://b://c.com/de/", "http://example.org?x=/es/", "http://é.COM/de/É", "http://.com/de/", "ftp://com/de/\nnext", "http://x.net/",
]


@pytest.mark.parametrize("limit", [100, 1])
def test_verdicts_of_trie_and_join(spark, limit):
    rnd = random.Random(3)
    hosts, parts = ["com", "a.com", "b.a.com", "org", "x.org"], ["", "/", "/a", "/a/", "/a/b", "/ab/", "/a/b/c", "/ab"]
    rules = list({(rnd.choice(["allow", "block"]), rnd.choice(hosts), rnd.choice(parts)) for _ in range(30)}) + URL_RULES
    urls = URLS + [f"http://{rnd.choice(hosts + ['q.b.a.com', 'zcom'])}{rnd.choice(parts)}{rnd.choice(parts)}" for _ in range(200)]
    df = spark.createDataFrame([(i, u, "clash", "clash", "clash") for i, u in enumerate(urls)], SCHEMA).repartition(3)
    got = judge_urls(df, rules, keep=["page_id"], max_rules=limit).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: brute(u, rules) for i, u in enumerate(urls)}
    assert len(got) == len(urls)


def test_rules_from_a_table_repeated_rows_and_empty_input(spark):
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    df = spark.createDataFrame([(None, "http://a.org/"), (None, "http://a.org/")], "page_id long, url string")
    for limit in (10, 2):
        got = judge_urls(df, rules, keep=["page_id"], max_rules=limit).collect()
        assert [tuple(r) for r in got] == [(None, "a.org", "/", "org/", "allow")] * 2
        assert judge_urls(df.limit(0), rules, max_rules=limit).collect() == []
