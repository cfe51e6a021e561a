"""URL rules: host rules by hand, mined rules against all token sets."""

import random
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from odpanel.llm import url_rules

PAGES = "page_id long, url string, html string, host string, rule string, tokens string, bad int"
LABELS = "doc_id long, quality int, toxic int, page_id string"

URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET/en/x",
        "http://example.net/EN/x", "http://example.net/en", "http://net/", "http://a.net",
        "http://a.net/?q=1", "http://example.com/de/a/b.c.html#x", "http://badexample.com/de/",
        "http://x.org/fr/?a=b&&a=c#", "http://example.net.org/fr/1", "http://x.org?u=http://y.net/",
        "http://a..b/x//y/", "ftp://h:80/p#q?z", "http://ÄÖ.example.com/DE/é?k", "x://" + "s/" * 5000,
        "http://u@h.net/\n/de", "http://h#/fr/"]


def page_rows(n=900):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        host = rng.choice(["a.shop.io", "b.shop.io", "c.news.io", "m.casino.biz"])
        rows.append((i, f"http://{host}/{rng.choice(['en', 'de'])}/{rng.choice('pqr')}{i % 40}"
                     + rng.choice(["", "?ref=1", "?a=1&b=2", "#top"])))
    rows += [(n + i, u) for i, u in enumerate(URLS)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (3, "http://m.casino.biz/en/zz")]
    return [(*r, "h", "x", "x", "x", 1) for r in rows]


def label_rows(pages):
    rng = random.Random(6)
    out = []
    for r in pages:
        url = r[1] or ""
        bad = ("casino" in url or ("b.shop" in url and "ref=1" in url and "/de/" in url)) \
            and rng.random() < 0.9 or rng.random() < 0.05
        if rng.random() < 0.7:
            out.append((r[0], 0 if bad and rng.random() < 0.5 else 1, int(bad), "x"))
    return out + [(None, 0, 1, "x"), (1, None, None, "x"), (2, 0, 1, "x"), (2, 1, 0, "x")]


def test_equals_sql_on_planted_labels(spark):
    pages, labels = page_rows(), None
    labels = label_rows(pages)
    got = url_rules.filter_urls(
        spark.createDataFrame(pages, PAGES),
        url_rules.page_labels(spark.createDataFrame(labels, LABELS))).toPandas()
    con = duckdb.connect()
    p = spark.createDataFrame(pages, PAGES).toPandas()  # noqa: F841 - read by name
    lab = spark.createDataFrame(labels, LABELS).toPandas()  # noqa: F841
    con.execute("CREATE VIEW pages AS SELECT page_id::BIGINT AS page_id, url, html FROM p")
    con.execute("CREATE VIEW labels AS SELECT doc_id::BIGINT AS doc_id, quality::INT AS quality, "
                "toxic::INT AS toxic FROM lab")
    want = con.execute(url_rules.oracle()).fetchall()
    rows = [tuple(None if v != v or v is None else v for v in r)
            for r in got.itertuples(index=False, name=None)]
    rows = [(None if r[0] is None else int(r[0]), *r[1:]) for r in rows]
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
    verdicts = {(r[1], r[4]) for r in rows if r[3] is None and r[1]}
    assert ("m.casino.biz", "block") in verdicts and ("c.news.io", "allow") in verdicts
    assert {("b.shop.io", "block"), ("b.shop.io", "allow")} <= verdicts


def test_host_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: r for r in url_rules.filter_urls(df, none).collect()}

    def expect(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        stop = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        return low, rest[end:stop] if stop > end else ""

    for i, url in enumerate(URLS):
        host, path = expect(url)
        fit = [r for r in url_rules.HOST_RULES
               if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.host + r.path), default=None)
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].rule == (best and best.host + best.path)
        assert got[i].verdict == (best.action if best else "allow")


def test_mined_rules_are_the_least_sets(spark):
    rng = random.Random(8)
    rows = [(sorted({f"k{k}={rng.randint(0, 2)}" for k in range(5)}), rng.random() < 0.4)
            for _ in range(300)]
    df = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    got = {tuple(r.rule): (r.bad_n, r.n, r.token) for r in url_rules.mine_rules(
        df, 0.01, 3, 0.6).collect()}
    count = {}
    for items, bad in rows:
        for k in (1, 2, 3):
            for c in combinations(items, k):
                n, b = count.get(c, (0, 0))
                count[c] = (n + 1, b + bad)
    kept = {c: (b, n) for c, (n, b) in count.items() if b >= 3 and b / n >= 0.6}
    least = {c: v for c, v in kept.items()
             if not any(s in kept for k in range(1, len(c)) for s in combinations(c, k))}
    assert least and {c: v[:2] for c, v in got.items()} == least
    for c, v in got.items():
        assert v[2] == min(c, key=lambda t: (count[(t,)][0], t))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "http://a.b/c")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    assert len(url_rules.filter_urls(df, labels).collect()) == len(rows)


def test_one_url_many_times_and_no_python_worker(spark):
    """A URL of many segments on a third of all rows: twelve tokens at most."""
    long = "http://x.y.z/" + "/".join(f"s{i}" for i in range(60)) + "?a=1&b=2"
    df = spark.createDataFrame([(i, long if i % 3 else f"http://h{i}.io/{i}") for i in range(600)],
                               "page_id long, url string")
    labels = spark.createDataFrame([(i, bool(i % 3)) for i in range(600)],
                                   "page_id long, bad boolean")
    out = url_rules.filter_urls(df, labels)
    assert out.filter("verdict = 'block'").count() == 400
    assert df.select(F.max(F.size(url_rules.tokens(F.col("url"))))).first()[0] <= 12
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
