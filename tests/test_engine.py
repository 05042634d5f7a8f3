"""The factor engine: the algebra against pandas on a gappy panel, queries against DuckDB, operators on hand-made cases."""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.oracle import DATA, TABLES, connect, differ
from weftline.functions import codes
from weftline.functions.factors import UNUSED, catalogue
from weftline.operators import crosssec, filters, portfolio, regress, store
from weftline.plans import daily as whole
from weftline.plans import expr as X
from weftline.plans import panel_queries, registry
from weftline.plans.queries import expression_query, with_places
from weftline.sources import calendar as cal
from weftline.sources.panel import dense, panel, panel_sql
from weftline.streaming import daily

SMALL = DATA.replace("sf0.01", "sf0.001")


@pytest.fixture(scope="module")
def gappy(spark):
    """60 dates x 5 codes, one code missing on some dates, ties, a constant code; pandas frames of the variables."""
    rng = np.random.default_rng(191)
    days = pd.bdate_range("2024-01-02", periods=60)
    rows = []
    for k in range(5):
        price = np.round(10 + np.cumsum(rng.normal(0, 0.3, 60)), 1) if k < 4 else np.full(60, 7.0)
        for i, d in enumerate(days):
            if not (k == 1 and i in (5, 6, 20)) and not (k == 2 and i == 59):
                rows.append((d.date(), k, float(price[i]), float(price[i] + 0.2), float(price[i] - 0.1), float(price[i] + 0.1), float(rng.integers(1, 9)), float(rng.integers(100, 900))))
    bars = spark.createDataFrame(rows, "date date, code long, open double, high double, low double, close double, volume double, amount double")
    p = dense(bars).cache()
    pdf = p.toPandas()
    return p, lambda c: pdf.pivot(index="date", columns="code", values=c)


def frame(df, col):
    return df.toPandas().pivot(index="date", columns="code", values=col)


def test_algebra_equals_pandas(gappy):
    p, wide = gappy
    c, v = wide("close"), wide("volume")
    x, y = X.var("close"), X.var("volume")
    share = lambda w: np.mean(w <= w[-1])
    pop = lambda n: (c * v).where(c.notna() & v.notna()).rolling(n).mean() - c.where(v.notna()).rolling(n).mean() * v.where(c.notna()).rolling(n).mean()
    weights = np.arange(1, 7)
    want = {
        "lag": (X.lag(x, 3), c.shift(3)), "delta": (X.delta(x, 2), c - c.shift(2)), "mean": (X.mean(x, 6), c.rolling(6).mean()), "std": (X.std(x, 6), c.rolling(6).std()),
        "var": (X.variance(y, 4), v.rolling(4).var()), "top": (X.highest(x, 5), c.rolling(5).max()), "ema": (X.ema(x, 7, 2), c.ewm(alpha=2 / 7, adjust=False).mean()),
        "wma": (X.decay(x, 6), c.rolling(6).apply(lambda w: (w * weights).sum() / weights.sum(), raw=True)), "tsr": (X.tsrank(y, 8), v.rolling(8).apply(share, raw=True)),
        "hd": (X.high_day(y, 7), v.rolling(7).apply(lambda w: 6 - np.argmax(w), raw=True)), "ld": (X.low_day(y, 7), v.rolling(7).apply(lambda w: 6 - np.argmin(w), raw=True)),
        "rank": (X.rank(x), c.rank(axis=1, pct=True)), "cov": (X.cov(x, y, 5), pop(5)), "slope": (X.slope(x, 6), c.rolling(6).apply(lambda w: np.polyfit(np.arange(6), w, 1)[0], raw=True)),
        "corr": (X.corr(x, y, 6), c.where(v.notna()).rolling(6).corr(v.where(c.notna()))), "count": (X.count(x > X.lag(x), 4), (c > c.shift()).astype(float).rolling(4).sum()),
        "sumif": (X.sum_if(y, 4, x > X.lag(x)), v.where(c > c.shift(), 0).rolling(4).sum()), "prod": (X.product(x / X.lag(x), 4), (c / c.shift()).rolling(4).apply(np.prod, raw=True)),
        "nested": (X.rank(X.mean(X.rank(X.delta(y)), 3)), v.diff().rank(axis=1, pct=True).rolling(3).mean().astype("float32").rank(axis=1, pct=True)),
    }
    got = X.evaluate(p, {k: e for k, (e, _) in want.items()}).cache()
    for k, (_, w) in want.items():
        g = frame(got, k).astype(float)
        w = w.astype(float).replace([np.inf, -np.inf], np.nan)
        if k == "corr":
            w = w.where(c.rolling(6).std() > 1e-9).where(v.rolling(6).std() > 1e-9)
        pd.testing.assert_frame_equal(g, w, check_names=False, check_freq=False, check_index_type=False, check_column_type=False, rtol=1e-6, atol=2e-6, obj=k)


def test_no_look_ahead(gappy):
    p, _ = gappy
    some = {f"f{k}": e for k, e in catalogue().items() if k in (5, 22, 61, 119, 138)}
    cut = dt.date(2024, 2, 20)
    last = lambda df: sorted(map(tuple, df.filter(F.col("date") == cut).collect()), key=str)
    assert last(X.evaluate(p, some)) == last(X.evaluate(p.filter(F.col("date") <= cut), some))


def test_catalogue_is_complete():
    f = catalogue()
    assert len(f) == 183 and set(range(1, 192)) - set(f) == set(UNUSED)
    plan = X.Plan({"f92": f[92]})
    assert plan.warm_up(f[92]) == 180 + 12 + 4 + 14
    assert len(X.Plan({f"f{k}": e for k, e in f.items()}).stages) < 40


@pytest.mark.parametrize("name", [n for n in registry.ORACLE if n.startswith("factors")])
def test_factors_equal_sql(spark, name):
    assert differ(spark, registry.QUERIES[name], registry.ORACLE[name], SMALL) == ""


@pytest.fixture(scope="module")
def flat(tmp_path_factory):
    """Tables where prices hardly move, so that correlations of two of their sums are little but rounding: 6,000 rows of lineitem."""
    path = tmp_path_factory.mktemp("flat")
    for t in TABLES:
        if t != "lineitem":
            (path / f"{t}.parquet").symlink_to(f"{SMALL}/{t}.parquet")
    rng = np.random.default_rng(113)
    n, q = np.arange(6000), rng.integers(1, 50, 6000).astype(float)
    rows = pd.DataFrame({"l_orderkey": n, "l_partkey": n, "l_suppkey": n % 20, "l_linenumber": 1, "l_quantity": q, "l_extendedprice": q * (1000 + rng.integers(0, 60, 6000) / 100), "day": n // 80 * 7})  # noqa: F841
    duckdb.sql(f"COPY (SELECT * EXCLUDE (day), TIMESTAMP '1995-01-02' + to_days(day::INT) AS l_shipdate FROM rows) TO '{path}/lineitem.parquet'")
    return str(path)


def test_rounding_equals_sql(spark, flat):
    query, sql = expression_query({"f113": catalogue()[113]})
    assert differ(spark, query, sql, flat) == ""


def test_sums_in_blocks_equal_sql(spark, flat):
    """To the last digit, before a fold and after."""
    c, v = X.var("close"), X.var("volume")
    out = {"s": X.total(c, 20), "m": X.mean(c * v, 18), "d": X.decay(c, 20), "long": X.total(X.mean(c, 5), 60), "after": X.total(X.ema(c, 13, 2) * 0 + c, 20)}
    got = lambda df: [tuple(r) for r in df.orderBy("date", "code").select(*out).collect()]
    with_recursive = f"WITH RECURSIVE {', '.join([*panel_sql(), *X.sql(out, 'panel')])}"
    want = connect(flat).execute(f"{with_recursive} SELECT {', '.join(out)} FROM result ORDER BY date, code").fetchall()
    p = panel(spark, flat)
    assert got(X.evaluate(p, out)) != want
    placed, places = with_places(spark, flat, p, 1)
    assert got(X.evaluate(placed, out, places)) == want


@pytest.mark.parametrize("name", list(panel_queries.ORACLE))
def test_queries_equal_sql(spark, name):
    assert differ(spark, panel_queries.QUERIES[name], panel_queries.ORACLE[name], SMALL) == ""


def test_calendar(spark):
    days = ["2024-09-26", "2024-09-27", "2024-09-30", "2024-10-08", "2024-10-09"]
    c = cal.calendar(spark.createDataFrame([(d,) for d in days], "date string"))
    ask = spark.createDataFrame([("2024-09-30",), ("2024-10-03",), ("2024-09-25",)], "date string")
    to = lambda n: {r.date: str(r.shifted) for r in cal.shift(ask, c, n).collect()}
    assert to(1) == {"2024-09-30": "2024-10-08", "2024-10-03": "2024-10-08", "2024-09-25": "None"}
    assert to(-2)["2024-09-30"] == "2024-09-26" and to(0)["2024-10-03"] == "2024-09-30"
    assert {r.date: str(r.floor_date) for r in cal.floor_dates(ask, c).collect()}["2024-09-25"] == "2024-09-26"
    assert cal.weekdays(spark, "2024-01-01", "2024-01-07").count() == 5


def test_codes(spark):
    df = spark.createDataFrame([("SHSE.600000",), ("600000SH",), ("000001",), ("600519",), ("x",), (None,), ("900901.SH",)], "c string")
    got = [(r[0], r[1], r[2]) for r in df.select(codes.market_code(F.col("c")), codes.vendor_code(F.col("c")), codes.is_a_share(F.col("c"))).collect()]
    assert [g[0] for g in got] == ["600000.SH", "600000.SH", "000001.SZ", "600519.SH", None, None, "900901.SH"]
    assert got[2][1] == "SZSE.000001" and got[0][2] and not got[6][2] and not got[5][2]
    assert spark.range(1).select(codes.plain_name(F.lit("　电子（Ａ）-b "))).first()[0] == "电子_A_B"


def test_tradability(spark):
    rows = [("A", 11.0, 10.0, 100.0, None, None, 11.0, None, "a"), ("B", 10.5, 10.0, 0.0, None, None, None, None, "b"), ("C", 9.52, 10.0, 5.0, None, None, None, None, "*ST c"),
            ("D", 10.1, 10.0, 5.0, 1, None, None, None, "d"), ("E", None, 10.0, 5.0, None, None, None, None, "e"), ("X", 10.5, 10.0, 1000.0, None, None, None, None, None)]
    df = spark.createDataFrame([(dt.date(2024, 1, 2), *r) for r in rows], "date date, code string, close double, preclose double, volume double, paused int, is_st boolean, high_limit double, low_limit double, name string")
    assert [r.code for r in filters.tradable(df).collect()] == ["X"]
    asked = spark.createDataFrame([(dt.date(2024, 1, 2), "X"), (dt.date(2024, 1, 2), "Z")], "date date, code string")
    assert {r.code: (r.missing, r.keep) for r in filters.trade_mask(df, asked).collect()} == {"X": (False, True), "Z": (True, False)}


def test_store(spark, tmp_path):
    old = spark.createDataFrame([("01-01", 10), ("01-02", 20)], "date string, v int")
    new = spark.createDataFrame([("01-02", 21), ("01-03", 30)], "date string, v int")
    assert sorted(map(tuple, store.upsert_rolloff(old, new, ["date"], 2).collect())) == [("01-02", 21), ("01-03", 30)]
    path = str(tmp_path / "m.json")
    assert store.manifest_rows(path)["last_processed"] is None
    store.save_manifest(path, {"last_processed": "2024-01-02"})
    assert store.manifest_rows(path)["last_processed"] == "2024-01-02"
    open(path, "w").write("{broken")
    assert store.manifest_rows(path)["version"] == 1


def test_stream_into_store(spark, tmp_path):
    src, out, point = (str(tmp_path / x) for x in ("src", "out", "point"))
    put = lambda rows: spark.createDataFrame(rows, "date string, v int").coalesce(1).write.mode("append").parquet(src)
    go = lambda: daily.rolling_store(spark.readStream.schema("date string, v int").parquet(src), out, point, ["date"], 2).awaitTermination()
    put([("01-01", 10), ("01-02", 20)])
    go()
    put([("01-02", 21), ("01-03", 30)])
    go()
    assert sorted(map(tuple, daily.read_store(spark, out).select("date", "v").collect())) == [("01-02", 21), ("01-03", 30)]


def test_numerics(spark):
    rng = np.random.default_rng(20250814)
    x = rng.normal(size=(500, 4))
    y = x @ [1, -2, 0.5, 3] + 0.7 + rng.normal(size=500)
    coef, constant, info = regress.ridge_fit(x, y, 1e-10)
    ols = np.linalg.lstsq(np.column_stack([x, np.ones(500)]), y, rcond=None)[0]
    assert np.abs(np.append(coef, constant) - ols).max() < 5e-6 and info["n"] == 500 and 0.8 < info["r2"] < 1
    x[3, 1] = np.nan
    assert regress.ridge_fit(x, y)[2]["n"] == 499 and regress.ridge_fit(x[:0], y[:0])[2]["n"] == 0
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(rng.normal(0, 3, 600))], "g int, v double")
    for r in crosssec.zscore(df, ["v"], ["g"]).groupBy("g").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect():
        assert abs(r.m) < 1e-10 and abs(r.s - 1) < 1e-10
    fit = spark.createDataFrame([(1, 1.0, 1.0, 2.0), (1, 3.0, 3.0, 1.0)], "g int, y double, f double, w double")
    assert crosssec.weighted_r2(fit, "y", "f", "w", ["g"]).first().r2 == 1.0 and abs(crosssec.weighted_mean(fit, "y", "w", ["g"]).first()["mean"] - 5 / 3) < 1e-12


def test_orthogonalize(spark):
    rng = np.random.default_rng(42)
    d = pd.DataFrame({"date": dt.date(2024, 3, 5), "code": [f"c{i:02d}" for i in range(60)], "size": rng.normal(size=60), "bp": rng.normal(size=60), "ind": ["A", "B", "C"] * 20})
    d["f1"], d["f2"], d["f7"] = d["size"] * 2 + rng.normal(size=60), rng.normal(size=60), np.nan
    r = regress.orthogonalize(spark.createDataFrame(d), ["f1", "f2", "f7"], ["size", "bp"], "ind").toPandas()
    assert len(r) == 180 and r[r.factor_id == "f7"].residual.isna().all()
    one = r[r.factor_id == "f1"].set_index("code").residual.astype(float).reindex(d.code).to_numpy()
    assert abs(one.mean()) < 1e-6 and abs(np.corrcoef(one, d["size"])[0, 1]) < 0.05 and all(abs(one[d.ind == k].mean()) < 1e-6 for k in "ABC")


def test_neutral_weights_hold_a_few_rows_and_reach_the_optimum():
    """6,000 codes within 40 MB (the whole program as a matrix takes 4 GB); the weights of a small one are those of the whole program."""
    import tracemalloc

    rng = np.random.default_rng(5)
    n = 6000
    expo = np.column_stack([rng.normal(size=n), *[(np.arange(n) % 5 == k).astype(float) for k in range(5)]])
    tracemalloc.start()
    w = portfolio.neutral_weights(rng.normal(size=n), expo, np.full(n, 1 / n), np.zeros(n))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and np.allclose(expo.T @ w, expo.mean(axis=0), atol=1e-8) and abs(w.sum() - 1) < 1e-8 and w.min() > -1e-9 and w.max() < 0.06 + 1e-9
    n = 40
    alpha, held, expo, bench = rng.normal(size=n), rng.dirichlet(np.ones(n)), expo[:n], np.full(n, 1 / n)
    w = portfolio.neutral_weights(alpha, expo, bench, held)
    eye, zero, rows = np.eye(n), np.zeros((n, n)), np.vstack([np.ones(n), expo.T])
    a = np.block([[rows, np.zeros((len(rows), 4 * n))], [eye, zero, eye, zero, zero], [eye, -eye, zero, eye, zero], [-eye, -eye, zero, zero, eye]])
    x = portfolio.linear_program(np.concatenate([-alpha, np.full(n, 0.0015), np.zeros(3 * n)]), a, np.concatenate([[1.0], expo.T @ bench, np.full(n, 0.06), held, -held]))
    assert np.allclose(w, x[:n], atol=1e-4)
    assert np.allclose(portfolio.neutral_weights(np.ones(1), np.ones((1, 1)), np.ones(1), np.zeros(1), max_weight=1.0), 1, atol=1e-8)
    assert portfolio.bounded_program(np.ones(2), np.ones((2, 2)), np.array([1.0, 2.0]), np.ones(2)) is None


def test_linear_program():
    x = portfolio.linear_program(np.array([-1.0, -2.0, 0, 0]), np.array([[1.0, 1, 1, 0], [1, 3, 0, 1]]), np.array([4.0, 6.0]))
    assert np.allclose(x, [3, 1, 0, 0], atol=1e-5)
    rng = np.random.default_rng(0)
    n = 60
    expo = np.column_stack([rng.normal(size=(n, 3)), np.eye(10)[np.arange(n) % 10]])
    bench = np.full(n, 1 / n)
    w = portfolio.neutral_weights(rng.normal(size=n), expo, bench, np.zeros(n))
    assert abs(w.sum() - 1) < 1e-6 and w.min() > -1e-7 and w.max() < 0.06 + 1e-6 and np.abs(expo.T @ (w - bench)).max() < 1e-6


def test_weights_and_orders(spark):
    d = dt.date(2024, 1, 2)
    a = spark.createDataFrame([(d, f"c{i}", float(i - 3)) for i in range(8)] + [(d, "n", None)], "date date, code string, alpha double")
    w = {r.code: r.weight for r in portfolio.top_k(a, 4, 0.3).collect()}
    assert set(w) == {"c7", "c6", "c5"} and abs(sum(w.values()) - 0.9) < 1e-9 or abs(sum(w.values()) - 1) < 1e-9
    t = spark.createDataFrame([(d, "a", 0.5), (d, "b", 0.3), (d, "c", 0.2)], "date date, code string, weight double")
    p = spark.createDataFrame([(d, "a", 0.495), (d, "c", 0.4), (d, "z", 0.1)], "date date, code string, weight double")
    assert sorted((r.code, r.side) for r in portfolio.orders(t, p).collect()) == [("b", "BUY"), ("c", "SELL"), ("z", "SELL")]


def test_daily_run(spark):
    o = panel_queries.QUERIES["daily_run"](spark, DATA)
    assert o.columns == ["date", "code", "target_weight", "side"] and o.count() > 100
    assert whole.run


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
