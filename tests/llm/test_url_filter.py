"""URL rules and link propagation against plain Python and the SQL."""

import random

import duckdb
import pytest

from fulcrum.llm import url_filter as U
from fulcrum.llm.oracle import OP6

HOSTS = ["a.example.org", "example.org", "b.example.com", "example.com", "org", "xorg", "d.net", "spam.net", "FR.Com", "lone.net"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def rule_of(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def make(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule int").repartition(3)


def random_pages(seed, n=150):
    rng = random.Random(seed)
    paths = ["/", "/fr/1", "/de/2", "/es/x", "/en/12", "/en/2", "", "/fr", "/a b"]

    def url():
        return rng.choice(["http://", "HTTPS://"]) + rng.choice(HOSTS) + rng.choice(paths) + rng.choice(["", "?q=/de/", "#t"])

    def html():
        tags = [f'<a class=x href="{url()}">', f"<A HREF='//{rng.choice(HOSTS)}/p'>", '<a href="/own/page">', "<p href=http://no.net/>"]
        return "<html>" + "".join(rng.choice(tags) for _ in range(rng.randint(0, 6)))

    rows = [(i, url(), html(), "h", 1) for i in range(n)]
    return rows + [(n, None, html(), "h", 1), (n + 1, "", None, "h", 1), (n + 2, "no scheme", html(), "h", 1),
                   (None, "http://org/", None, "h", 1), rows[0], (n + 3, "x://", "", "h", 1), (n + 4, "a://b://c/d", "", "h", 1),
                   (n + 5, "http://é.ORG/ß?x\ny", "", "h", 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_sql_and_plain_rules(spark, scratch, seed):
    rows = random_pages(seed)
    got = U.filter_urls(make(spark, rows), scratch).select("page_id", "host", "path", "rule", "verdict").toPandas()
    pages = make(spark, rows).select("page_id", "url", "html").toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("pages", pages)
    want = con.execute(OP6).fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    mine = [tuple(None if x != x else x for x in r) for r in got[["page_id", "host", "path", "rule", "verdict"]].itertuples(index=False)]
    mine = [(None if r[0] is None else int(r[0]), *r[1:]) for r in mine]
    want = [(None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in want]
    assert sorted(mine, key=key) == sorted(want, key=key)
    by_id = {r[0]: r for r in rows}
    for page, host, path, rule, verdict in mine:
        assert (host, path) == split(by_id[page][1])
        want_rule = rule_of(host, path)
        assert rule == (want_rule and want_rule.host + want_rule.path)
        if want_rule:
            assert verdict == want_rule.verdict
    assert {r[4] for r in mine if r[3] is None} == {"allow", "block"}


def test_ranks_follow_links(spark, scratch):
    links = spark.createDataFrame([("good", "near", 3), ("near", "far", 1), ("farm", "bad", 2), ("farm2", "farm", 1)],
                                  "src string, dst string, n long")
    seeds = spark.createDataFrame([("good", 5, 0), ("bad", 0, 2), ("alone", 0, 0)], "host string, allowed long, blocked long")
    r = {x.host: x for x in U.host_ranks(links, seeds, scratch).collect()}
    assert r["good"].trust > r["near"].trust > r["far"].trust > 0 and r["bad"].distrust > r["farm"].distrust > r["farm2"].distrust > 0
    assert r["far"].distrust == 0 and r["farm"].trust == 0
    assert sum(x.trust for x in r.values()) == pytest.approx(1) and sum(x.distrust for x in r.values()) == pytest.approx(1)


def test_empty_table(spark, scratch):
    assert U.filter_urls(make(spark, []), scratch).count() == 0


def test_a_neighbourhood_is_judged_alike_in_a_large_crawl(spark, scratch):
    """Three links of 1/50 from one blocked page of 10^8; and 30 links in a row from another."""
    fan = [("h1", "bad", 1), ("h2", "h1", 1), ("h3", "h2", 1)] + [(f"h{i}", f"x{i}n{j}", 1) for i in (1, 2, 3) for j in range(49)]
    row = [(f"r{i + 1}", f"r{i}", 1) for i in range(30)]
    links = spark.createDataFrame(fan + row, "src string, dst string, n long")
    for others in (1, 10 ** 8):
        seeds = spark.createDataFrame([("bad", 0, 1), ("r0", 0, 1), ("big", others, others)], "host string, allowed long, blocked long")
        r = {x.host: x for x in U.host_ranks(links, seeds, scratch).collect()}
        assert r["h3"].distrust / r["bad"].distrust == pytest.approx(0.85 ** 3, rel=1e-9)
        assert r["r30"].distrust / r["r0"].distrust == pytest.approx(0.85 ** 30, rel=1e-9)
        assert r["h3"].trust == 0 and sum(x.distrust for x in r.values()) == pytest.approx(1)


def test_cycles_settle_and_the_safety_stop_is_told(spark, scratch):
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", 3, 0)], "host string, allowed long, blocked long")
    r = {x.host: x.trust for x in U.host_ranks(links, seeds, scratch).collect()}
    assert r["a"] == pytest.approx(1 / 1.85, rel=1e-5) and r["b"] == pytest.approx(0.85 / 1.85, rel=1e-5)
    with pytest.warns(UserWarning, match="after 3 steps"):
        U.host_ranks(links, seeds, scratch, most_steps=3)
