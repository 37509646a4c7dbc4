import random

import numpy as np

from lectern.llm.url_filter import Cascade, build_cascade, judge, _pairs
from pyspark.sql import functions as F

URLS = [
    (0, "https://a.example.org/es/1"), (1, "https://EXAMPLE.org/en/12?x#y"), (2, "https://x.org/es/1"),
    (3, "http://b.com/de/"), (4, "http://b.com/fr/x"), (5, "http://b.com/it/"), (6, "http://com/de/1"),
    (7, None), (8, "no scheme"), (9, "://"), (10, "http://org"), (11, "http://org?/"), (12, "http://org/"),
    (13, "http://xexample.org/es/"), (14, "http://a.com:80/de/"), (15, "x://y://org/"), (16, "http://a.org\n/x"),
    (17, "http://" + "a." * 2000 + "example.org/es/" + "x" * 50_000), (17, "http://org/"),
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:end], rest[end:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
        path = tail[:stop]
    fit = [(len(h + p), h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


def test_like_brute_force(spark):
    from lectern.llm.url_filter import RULES

    urls = spark.createDataFrame([(i, u, "h") for i, u in URLS], "page_id long, url string, host string")
    out = judge(urls)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = sorted((tuple(r) for r in out.drop("page_id").collect()), key=str)
    assert got == sorted(((u, *brute(u, RULES)) for _, u in URLS), key=str)


def test_defined_cases(spark):
    none = spark.createDataFrame([], "url string")
    assert judge(none).count() == 0
    one = spark.createDataFrame([("http://a.org/x",)], "url string")
    assert judge(one, []).first()["verdict"] == "allow"
    both = judge(one, [("allow", "org", "/"), ("block", "org", "/")]).first()
    assert (both["rule"], both["verdict"]) == ("org/", "block")


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(2)
    universe = [f"k{rng.getrandbits(40)}" for _ in range(30_000)]
    listed = universe[:3000] + [f"absent{i}" for i in range(500)]
    keys = spark.createDataFrame([(k,) for k in universe], "key string")
    cascade = build_cascade(keys, len(universe), listed)
    pairs = _pairs(keys)
    assert (cascade.holds(pairs) == np.isin(np.array(universe), np.array(listed))).all()
    assert len(cascade.levels) > 1 and cascade.size() < 3 * len(listed)
    assert not Cascade([]).holds(pairs).any()
