"""Rules against a plain reading of them; the trees on held-out URLs."""
import random
import re

import pytest
from pyspark.sql import functions as F

from threadscope.llm import url_filter as U

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
PAGES = "page_id long, url string, host string, x int"


def plain(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES for h, p in [U.split_rule(r)] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


def test_rules(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG/es/1?x=1", "http://example.org/en/12", "http://org",
            "http://org/", "https://xorg/", "http://é.COM/de/", "http://a.com/de", "http://a.com/fr/x#y", "http://a.com?u=://org/",
            "x://a\nb.org/\n", "http://a.org://b/", "http://user@a.com:80/fr/", "http://İ.org/"] + [
            f"http://h{i}.com/{'de' if i % 2 else 'fr'}/{i}" for i in range(40)]
    df = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)] + [(None, "http://a.org/", None, None)], PAGES)
    got = U.filter_urls(df, "url", RULES, trees=2).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule) == plain(r.url)
        assert r.verdict == RULES[r.rule] if r.rule else r.verdict in ("allow", "block")
        assert (r.blocked_score is None) == (r.rule is not None)


def test_trees_learn(spark):
    """Hosts that no rule names, but whose URLs look like those that rules block."""
    rng = random.Random(2)
    rows, label = [], {}
    for i in range(1500):
        bad = rng.random() < 0.4
        tail = "".join(rng.choice("0123456789") for _ in range(12)) if bad else rng.choice(["about", "news", "team"])
        named = i % 3
        host = ("bad.com" if bad else "good.org") if named else f"h{i}.net"
        label[i] = bad
        rows.append((i, f"http://{host}/{'de' if bad and named else 'x'}/{tail}", None, 0))
    got = U.filter_urls(spark.createDataFrame(rows, PAGES), "url", {"org/": "allow", "com/de/": "block"}).filter("rule is null")
    right = [(r.verdict == "block") == label[r.page_id] for r in got.collect()]
    assert len(right) == 500 and sum(right) / 500 > 0.95


@pytest.mark.parametrize("urls,verdict", [([], None), (["http://x.net/"], "allow"), (["http://a.com/de/", "http://x.net/"], "block")])
def test_few_labels(spark, urls, verdict):
    df = spark.createDataFrame([(i, u, None, 0) for i, u in enumerate(urls)], PAGES)
    assert {r.verdict for r in U.filter_urls(df, "url", RULES).collect()} == ({verdict} if verdict else set())


def test_entropy_and_no_python(spark):
    df = spark.createDataFrame([("aabb", 1.0), ("", 0.0), ("aaaa", 0.0), ("abcd", 2.0), ("é☃é☃", 1.0)], "t string, e double")
    assert all(abs(r[0] - r[1]) < 1e-9 for r in df.select(U.entropy(F.col("t")), "e").collect())
    pages = spark.createDataFrame([(i, f"http://h.com/{'de' if i % 2 else 'fr'}/{i}", None, 0) for i in range(20)], PAGES)
    plan = U.filter_urls(pages, "url", RULES, trees=1)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rare_label_and_hot_url(spark):
    """3 blocked URLs among thousands, and one URL that a third of all rows repeat: both are fitted on, within the bound."""
    rows = [(i, f"http://h{i}.org/a/{i}", None, 0) for i in range(4000)]
    rows += [(i, "http://hot.org/hot", None, 0) for i in range(4000, 6000)]
    rows += [(6000 + i, f"http://bad.com/de/{i}?" + "&".join("x=%20" * 9), None, 0) for i in range(3)]
    rows += [(7000, "http://c.net/a/1", None, 0), (7001, "http://bad.net/de/7?" + "&".join("x=%20" * 9), None, 0)]
    seen = []
    fit = U.GBTClassifier.fit

    def watched(self, examples):
        seen.append(examples.agg(F.count("*").alias("n"), F.sum(F.col("label") * F.col("_weight")).alias("blocked"),
                                 F.max("_weight").alias("top"), F.sum("_weight").alias("all")).first())
        return fit(self, examples)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(U.GBTClassifier, "fit", watched)
        got = U.filter_urls(spark.createDataFrame(rows, PAGES), "url", RULES, max_examples=200, trees=3).collect()
    assert len(got) == len(rows)
    assert 100 < seen[0].n <= 200 and seen[0].blocked == 3 and seen[0].top == 2000
    assert 4500 < seen[0].all < 7500  # about the 6003 ruled rows
    assert {r.page_id: r.verdict for r in got if r.rule is None} == {7000: "allow", 7001: "block"}
