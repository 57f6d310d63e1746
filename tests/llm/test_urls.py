import random
import re

import pytest

from hexwatch.llm import urls
from hexwatch.llm.queries import QUERIES


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in urls.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best


def check(rows, key="url"):
    for r in rows:
        host, path, best = brute(r[key])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1]), r[key]
        assert r["verdict"] == (best[0] if best else ("block" if r["score"] >= 0.5 else "allow"))


def test_query(spark, sf):
    rows = QUERIES["op9_url_filter"](spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url"), "page_id").collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    check(rows)


def test_rules_and_odd_urls(spark):
    odd = [
        None, "", "no scheme", "http://", "://x", "HTTP://A.Org/p", "http://org", "http://org/", "http://Éxample.ORG/es/1", "http://example.org/es/", "http://example.org/en/12", "http://notexample.org/en/1",
        "http://a.example.org/en/2?x=://y.com/de/", "http://com/de/", "http://xcom/de/", "http://a.com/fr/#f", "a://b://c/d", "http://x.com\n/de/q", "http://user@h.com:80/de/a b", "http://" + "l" * 5000 + ".com/" + "p" * 5000,
    ]
    pages = spark.createDataFrame([(u, "own") for u in odd], "url string, score string")
    out = urls.judged(pages, urls.fit(urls.labelled_urls(spark)))
    assert out.columns == ["url", "host", "path", "rule", "verdict", "score"]
    check(out.collect())
    assert urls.judged(pages.limit(0), urls.fit(urls.labelled_urls(spark))).count() == 0


def test_model_carries_over_to_new_names(spark):
    bad = ["http://super-casino.example.net/en/1", "https://m.pills-cheap.example.net/x", "http://free-warez.example.net/", "https://poker-bets.example.net/fr/2"]
    good = ["http://poetry-club.example.net/en/1", "https://m.science-school.example.net/x", "http://village-news.example.net/", "https://gardening-books.example.net/fr/2"]
    rows = urls.judged(spark.createDataFrame([(u,) for u in bad + good], "url string"), urls.fit(urls.labelled_urls(spark))).collect()
    assert [r["verdict"] for r in rows] == ["block"] * 4 + ["allow"] * 4


#: None of these hosts is in the labelled table.
ORDINARY = (
    "https://www.postgresql.org/docs/16/index.html https://scikit-learn.org/stable/user_guide.html https://rust-lang.org/learn https://www.heise.de/news/1 "
    "https://news.ycombinator.com/item?id=1 https://en.wiktionary.org/wiki/word https://www.lefigaro.fr/culture/2 https://www.rtve.es/noticias/3 "
    "https://pubmed.ncbi.nlm.nih.gov/12/ https://www.stanford.edu/academics https://www.nationalgeographic.com/animals https://www.ikea.com/de/kitchen "
    "https://www.ryanair.com/flights https://www.deutschlandfunk.de/musik https://ubuntu.com/download/server https://www.loc.gov/collections https://www.unicef.org/children"
).split()
UNWANTED = (
    "https://bet365.com/ https://pornhub.com/ https://1xbet.ru/line https://www.casinoroyale.club/slots https://best-poker-bonus.info/play https://adserver.tracker.biz/click "
    "https://cheapviagra.shop/pills https://warez-bb.org/forum https://torrentgalaxy.to/torrents https://spinslots.xyz/jackpot https://www.freeporn.tv/ "
    "https://onlinebetting.me/live https://quickloans.biz/payday https://adultcams.net/ https://banner.adclicks.ru/a"
).split()


def test_model_carries_over_to_other_sites(spark):
    rows = urls.judged(spark.createDataFrame([(u,) for u in ORDINARY + UNWANTED], "url string"), urls.fit(urls.labelled_urls(spark)), rules=[]).collect()
    blocked = {r["url"] for r in rows if r["verdict"] == "block"}
    assert len(blocked & set(ORDINARY)) <= 2, blocked & set(ORDINARY)
    # Measured: 11 of 15 found. Names that share no letters with the table's are not.
    assert len(set(UNWANTED) & blocked) >= 10, set(UNWANTED) - blocked


@pytest.mark.parametrize("count", [3, 2500])
def test_joined_rules_are_the_compiled_ones(spark, monkeypatch, count):
    rng = random.Random(count)
    label = lambda: rng.choice(["a", "b", "c", "com", "x-y"])
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 5)))
    path = lambda: "/".join(rng.choice(["", "p", "q", "p1"]) for _ in range(rng.randrange(3)))
    rules = [(rng.choice(["allow", "block"]), f"{host()}/{path()}") for _ in range(count)]
    seen = [f"http://{host()}/{path()}" for _ in range(150)] + [None, "", "http://", "http://.a/p", "http://b./q", "http://a..b/"]
    pages, model = spark.createDataFrame([(u,) for u in seen], "url string"), urls.fit(urls.labelled_urls(spark))
    monkeypatch.setattr(urls, "MAX_COMPILED_RULES", 0)
    rows = urls.judged(pages, model, rules).collect()
    assert len(rows) == len(seen)
    for r in rows:
        own, tail, best = r["host"], r["path"], None
        for kind, rule in rules:
            name, _, start = rule.partition("/")
            if (own == name or own.endswith("." + name)) and tail.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
                best = kind, rule
        assert r["rule"] == (best and best[1]) and (best is None or r["verdict"] == best[0])
    assert any(r["rule"] for r in rows)
