import pytest
from pyspark.sql import functions as F

from demandloom.llm import hosts
from demandloom.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, rule string, n int, k int, mean double"


def frame(spark, *urls):
    return spark.createDataFrame([(i, u, None, "h", "r", 1, 2, 3.0) for i, u in enumerate(urls)], SCHEMA)


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("https://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/"),
        ("http://example.org/en/123", "example.org", "/en/123", "example.org/en/1"),
        ("http://example.org/en/23", "example.org", "/en/23", "org/"),
        ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/"), ("http://x.com/de/", "x.com", "/de/", "com/de/"),
        ("http://x.com/en", "x.com", "/en", None), ("http://org?x", "org", "", None), ("http://borg/", "borg", "/", None),
        ("//no/scheme", "", "", None), ("", "", "", None), (None, "", "", None), ("a://b://c/d", "b:", "//c/d", None),
        ("x://ÄB.Com/fr/\nq", "Äb.com", "/fr/\nq", "com/fr/"), ("://example.org", "example.org", "", None),
        ("q#://example.org/es/", "example.org", "/es/", "example.org/es/"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule):
    row = hosts.judge(frame(spark, url), URL_RULES).first()
    assert (row.host, row.path, row.rule) == (host, path, rule)
    if rule:
        assert row.verdict == {r.text: r.verdict for r in URL_RULES}[rule]


@pytest.mark.parametrize(
    "host, domain, suffix",
    [
        ("a.b.example.com", "example.com", "com"), ("www.x.co.uk", "x.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
        ("localhost", "localhost", "localhost"), ("h.example.net:8080", "example.net", "net"), ("", "", ""),
    ],
)
def test_levels(spark, host, domain, suffix):
    df = spark.createDataFrame([(host,)], "h string")
    assert df.select(hosts.domain_of(F.col("h")), hosts.suffix_of(F.col("h"))).first() == (domain, suffix)


def test_shrinkage(spark):
    """A host without outcomes takes its domain's rate; few outcomes move a host less than many."""
    rows = [(f"bad{i}.evil.com", "evil.com", "com", 20, 20) for i in range(5)]
    rows += [(f"h{i}.good.com", "good.com", "com", 20, 0) for i in range(5)]
    rows += [("new.evil.com", "evil.com", "com", 0, 0), ("new.good.com", "good.com", "com", 0, 0)]
    rows += [("few.good.com", "good.com", "com", 2, 2), ("many.good.com", "good.com", "com", 60, 60)]
    df = spark.createDataFrame(rows, "host string, domain string, suffix string, n long, k long")
    got = {r.host: r for r in hosts.reputations(df).collect()}
    assert len(got) == len(rows)
    assert got["new.evil.com"].mean > 0.8 > 0.5 > got["new.good.com"].mean
    assert got["new.good.com"].mean < got["few.good.com"].mean < got["many.good.com"].mean
    assert all(0 < r.mean < 1 and r.bound < r.mean for r in got.values())


def test_verdicts_of_unruled_pages(spark):
    urls = [f"http://bad.example.com/de/{i}" for i in range(40)] + ["http://bad.example.com/en/1"]
    urls += [f"http://ok.other.com/fr/{i}" for i in range(40)] + ["http://ok.other.com/en/1", "http://new.net/", None]
    rows = {r.page_id: r.verdict for r in hosts.judge(frame(spark, *urls), URL_RULES).collect()}
    assert (rows[40], rows[81], rows[82], rows[83]) == ("block", "allow", "allow", "allow")


def test_odd_tables(spark):
    assert hosts.judge(frame(spark).limit(0), URL_RULES).count() == 0
    same = frame(spark, "http://x.org/").select("page_id", "url")
    assert hosts.judge(same.union(same), URL_RULES).count() == 2
    assert hosts.judge(frame(spark, None, ""), URL_RULES).where("verdict = 'allow'").count() == 2


def level(spark, rows):
    return spark.createDataFrame(rows, "host string, domain string, suffix string, n long, k long")


def test_one_page_does_not_judge_others(spark):
    """A single label is too little to block any other host, nor its own."""
    urls = ["http://a.com/de/x", "http://b.com/en/", "http://c.net/en/", "http://a.com/en/"]
    rows = {r.page_id: r for r in hosts.judge(frame(spark, *urls), URL_RULES).collect()}
    assert [rows[k].verdict for k in range(4)] == ["block", "allow", "allow", "allow"]
    assert all(0 <= rows[k].block_bound < 0.5 for k in (1, 2, 3))


def test_long_tail_takes_the_prior(spark):
    """Hosts of one labelled page each are not judged by that page."""
    rows = [(f"h{i}.com", f"h{i}.com", "com", 1, i % 2) for i in range(40)]
    got = {r.host: r for r in hosts.reputations(level(spark, rows)).collect()}
    assert all(0.4 < r.mean < 0.6 and r.bound < 0.5 for r in got.values())
    rows = [(f"h{i}.com", f"h{i}.com", "com", 1, 1) for i in range(40)]
    rows += [("new.com", "new.com", "com", 0, 0), ("far.net", "far.net", "net", 0, 0)]
    got = {r.host: r for r in hosts.reputations(level(spark, rows)).collect()}
    assert got["h1.com"].bound > 0.5 and got["new.com"].bound > 0.5  # forty pages stand behind it


def plain_reputations(rows):
    """The levels in plain loops: means, and the pages behind them."""
    total_n, total_k = sum(r[3] for r in rows), sum(r[4] for r in rows)

    def weight(members):
        over = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m, _ in members)
        most = sum(n * (n - 1) * m * (1 - m) for n, _, m, _ in members)
        rho = over / most if most else hosts.RHO[0]
        return 1 / min(max(rho, hosts.RHO[0]), hosts.RHO[1]) - 1

    above = {"": ((total_k + 0.5) / (total_n + 1), total_n + 1)}
    for at, up in ((2, None), (1, 2), (0, 1)):
        sums = {}
        for r in rows:
            n, k, _ = sums.get(r[at], (0, 0, None))
            sums[r[at]] = (n + r[3], k + r[4], "" if up is None else r[up])
        members = {x: (n, k, *above[u]) for x, (n, k, u) in sums.items()}
        w = weight(members.values())
        above = {x: ((k + w * m) / (n + w), n + min(w, known - n)) for x, (n, k, m, known) in members.items()}
    return above


def test_equals_plain_loops(spark):
    import random

    rng = random.Random(4)
    rows = []
    for d in range(30):
        rate = rng.random()
        for h in range(rng.randrange(1, 6)):
            n = rng.choice([0, 1, 2, 9, 40])
            rows.append((f"h{h}.d{d}.x", f"d{d}.x", ["com", "net", "org"][d % 3], n, sum(rng.random() < rate for _ in range(n))))
    want = plain_reputations(rows)
    for r in hosts.reputations(level(spark, rows)).collect():
        mean, pages = want[r.host]
        assert r.mean == pytest.approx(mean)
        assert r.bound == pytest.approx(max(0.0, mean - hosts.Z * (mean * (1 - mean) / (pages + 1)) ** 0.5))
