import random

import pytest
from pyspark.sql import functions as F

from inkfold.llm import urlfilter as u
from inkfold.llm.queries import RULES
from tests.llm.helpers import rows

URLS = [
    None, "", "no scheme/net/", "http://", "://x.net/", "HTTP://A.Example.NET/en/x?q#f", "https://example.net/EN/", "https://notexample.net/en/", "ftp://example.com/de/x",
    "http://example.com/deep", "http://example.org/fr/", "http://example.org?x=/fr/", "http://net", "http://net/", "http://x.org/fr/1", "http://a://b/c", "http://x\n.net/\ny", "http://É.net/é",
    "http://www.shop.example/item.html", "http://m.shop.example/item", "https://shop.example/item/?a=1", "http://shop.example/other", "http://" + "a" * 20_000 + ".net/" + "b" * 20_000,
]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def key(host, path):
    for start in ("www.", "m."):
        if host.startswith(start):
            host = host[len(start) :]
            break
    for end in ("/", ".html"):
        if path.endswith(end):
            path = path[: -len(end)]
            break
    return host + path


def judged(i, url, listed, rules=RULES):
    host, path = parsed(url)
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fitting, key=lambda r: len(r.name), default=None)
    hit = key(host, path) in listed and key(host, path) != ""
    return i, host, path, rule.name if rule else None, hit, rule.verdict if rule else "block" if hit else "allow"


def frame(spark, urls):
    return spark.createDataFrame([(i, x, "x", "y", "z") for i, x in enumerate(urls)], "page_id LONG, url STRING, host STRING, key STRING, id STRING")


@pytest.mark.parametrize("most", [400_000, 0])
def test_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(u, "BROADCAST_BLOCKS", most)
    listed = ["shop.example/item", "shop.example/item", None, "", "never.example/"]
    got = rows(u.judge(frame(spark, URLS + URLS[:6]), spark.createDataFrame([(x,) for x in listed], "url STRING"), RULES))
    assert got == sorted((judged(i, x, listed) for i, x in enumerate(URLS + URLS[:6])), key=repr)


def test_every_listed_url_passes_the_filter(spark):
    rng = random.Random(2)
    urls = [f"http://h{rng.randrange(50)}.example/p{i}" for i in range(1500)]
    listed = [key(*parsed(x)) for x in urls[::3]]
    got = rows(u.judge(frame(spark, urls), spark.createDataFrame([(x,) for x in listed], "url STRING"), []))
    assert got == sorted((judged(i, x, set(listed), []) for i, x in enumerate(urls)), key=repr)


def test_empty_tables(spark):
    pages, listed = frame(spark, URLS), spark.createDataFrame([], "url STRING")
    assert u.judge(pages.where("false"), listed, RULES).collect() == []
    assert rows(u.judge(pages, listed, RULES)) == sorted((judged(i, x, ()) for i, x in enumerate(URLS)), key=repr)


def test_no_python_in_the_plan(spark, plan_of):
    plan = plan_of(u.judge(frame(spark, URLS), spark.createDataFrame([("a/b",)], "url STRING"), RULES), "simple")
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_no_task_holds_a_popular_url(spark, monkeypatch):
    """A third of the rows have one listed URL, a third none at all; many rows are alike. Both joins by shuffle."""
    monkeypatch.setattr(u, "BROADCAST_BLOCKS", 0)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        urls = ["http://hot.example/listed", None, "http://cold{}.example/x"]
        pages = [(i % 50, urls[i % 3] and urls[i % 3].format(i)) for i in range(3000)]
        listed = ["hot.example/listed", "cold2.example/x", *(f"never{i}.example/" for i in range(2000))]
        kept = []
        frames = type(spark.range(1))
        real = frames.join
        monkeypatch.setattr(frames, "join", lambda self, other, on, how: kept.append((self, on)) or real(self, other, on, how))
        made = u.judge(spark.createDataFrame(pages, "page_id LONG, url STRING"), spark.createDataFrame([(x,) for x in listed], "url STRING"), RULES)
        assert rows(made) == sorted((judged(i, x, listed) for i, x in pages), key=repr)
        assert [on for _, on in kept] == ["block", "probe"]
        for side, on in kept:
            assert max(r["count"] for r in side.repartition(8, on).groupBy(F.spark_partition_id()).count().collect()) < 3000 / 8 * 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
