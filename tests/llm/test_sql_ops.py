"""op5, op9: against DuckDB and on hostile rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import DATA
from tests.oracle import differ
from weftline.llm import chat_format, queries, url_reputation


def test_op5_query(spark):
    assert differ(spark, queries.op5_url_reputation, queries.ORACLE["op5_url_reputation"], DATA) == ""


def test_op5_rows(spark):
    urls = [None, "", "nonsense", "http://", "HTTP://WWW.Example.NET/en/x?y", "http://example.net/enx", "https://a.example.com/de/#", "http://x.org/fr/a", "http://xorg/fr/",
            "http://net/", "http://a.net", "http://bad.site.test/1", "http://bad.site.test/2", "http://10.0.0.1/", "http://h?q=/en/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(11, 0, 0), (11, 1, 0), (12, 1, 1), (None, 0, 0), (7, None, None), (99, 0, 0), *[(i, 1, 0) for i in (0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 13, 14)]], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judge(pages, labels).collect()}
    assert len(got) == len(urls) + 1
    assert got[None] == got[0] == got[1] == ("", "", None, "allow")
    assert got[4] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5][2:] == ("net/", "block") and got[6] == ("a.example.com", "/de/", "example.com/de/", "block")
    assert got[7][2:] == ("org/fr/", "allow") and got[8][2] is None and got[9][2] == "net/" and got[10][1:3] == ("", None)
    assert got[14] == ("h", "", None, "allow")
    alone = {r.page_id: r.verdict for r in url_reputation.judge(pages, labels.filter("quality = 0"), limit=0.5).collect()}
    assert alone[11] == "block"  # all that is known is bad
    none = url_reputation.judge(pages, labels.limit(0)).collect()
    assert len(none) == len(urls) + 1 and {r.verdict for r in none if r.rule is None} == {"allow"}
    assert url_reputation.judge(pages.limit(0), labels).count() == 0


def test_reputation_blocks_bad_hosts_and_shrinks_small_ones(spark):
    rows = [("bad.a.test", 1)] * 60 + [("good.b.test", 0)] * 300 + [("one.b.test", 1)] + [("other.a.test", 1)] * 40 + [("new.b.test", None)] * 3
    rep = {r.host: r.over for r in url_reputation.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert rep["bad.a.test"] > 0.99 and rep["other.a.test"] > 0.99 and rep["good.b.test"] < 0.01
    assert rep["new.b.test"] < rep["one.b.test"] < rep["other.a.test"]


def test_reputation_decides_both_ways(spark):
    """On the small tables some pages without a rule are blocked by their hosts' reputation and some are not."""
    got = queries.op5_url_reputation(spark, DATA).filter("rule IS NULL").groupBy("verdict").count().collect()
    assert {r.verdict for r in got} == {"allow", "block"}


@pytest.mark.parametrize(("a", "b", "limit"), [(2.0, 3.0, 0.5), (0.3, 1.7, 0.2), (500.0, 520.0, 0.47), (1e6, 4e6, 0.2001), (30.0, 100.0, 0.9), (1e-6, 2.0, 0.5), (40.0, 0.5, 0.999)])
def test_posterior_probability(spark, a, b, limit):
    """Against counting: draws from the beta distribution."""
    got = spark.range(1).select(F.lit(a).alias("a"), F.lit(b).alias("b")).select(F.expr(url_reputation._over("a", "b", limit)).alias("p")).first().p
    assert abs(got - (np.random.default_rng(3).beta(a, b, 400_000) > limit).mean()) < 0.004


def test_levels(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.y.co.uk": ("y.co.uk", "co.uk"), "y.co.uk": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "www.ab.de": ("ab.de", "de"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "": ("", ""), "h": ("h", "h")}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    assert {r.h: (r.d, r.s) for r in df.select("h", url_reputation.levels(F.col("h"))[0].alias("d"), url_reputation.levels(F.col("h"))[1].alias("s")).collect()} == hosts
    sql = "WITH l AS" + url_reputation.ORACLE.split("l AS", 1)[1].split("pooled AS")[0].rstrip().rstrip(",").replace("FROM h)", "FROM (SELECT *, 0.0 AS n, 0.0 AS bad FROM h))")
    con = duckdb.connect()
    con.execute("CREATE TABLE h AS SELECT unnest(?) AS host", [list(hosts)])
    assert {h: (d, s) for h, d, s in con.execute(sql + " SELECT host, domain, suffix FROM hosts").fetchall()} == hosts


def test_op9_query(spark):
    assert differ(spark, queries.op9_chat_format, queries.ORACLE["op9_chat_format"], DATA) == ""


def collapse(rows):
    """Brute force."""
    convs = {}
    for c, t, r, x in {(c, t, r or "", x or "") for c, t, r, x in rows}:
        convs.setdefault(c, []).append((t is None, t or 0, r, x))
    turns = {c: tuple((r, x) for _, _, r, x in sorted(v)) for c, v in convs.items()}
    first = {}
    for c in sorted(turns, key=lambda c: (c is None, c or 0)):
        first.setdefault(turns[c], c)
    return sorted((c is None, c or 0, len(v), "".join(f"<|{r}|>\n{x}\n" for r, x in v)) for v, c in first.items() if not any(w != v and w[: len(v)] == v for w in first))


def test_op9_rows(spark):
    a = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", None)]
    rows = [(c, t, *a[t]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 3)) for t in range(n)]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (None, 0, "user", "lost"), (6, None, None, None), (6, 7, "user", "x"), (7, 0, "user", "tie b"), (7, 0, "user", "tie a"), (7, 0, "user", "tie a")]
    rows += [(8, t, "user", f"turn {t % 9}") for t in range(50)] + [(9, t, "user", f"turn {t % 9}") for t in range(40)]
    df = spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, part string")
    for block in (4, 256):
        got = {}
        for r in chat_format.format_chats(df, block).collect():
            got.setdefault((r.conv_id is None, r.conv_id or 0, r.n_turns), {})[r.part] = r.text
        assert sorted((*k, "".join(v[p] for p in sorted(v))) for k, v in got.items()) == collapse(rows)
    assert chat_format.format_chats(df.limit(0)).count() == 0
