"""Vendor tables, positions carried through dates, incremental runs, fit metrics and style groups on hand-made cases."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from weftline.operators import portfolio, regress, store, styles
from weftline.plans import daily
from weftline.plans import expr as X
from weftline.sources import calendar as cal
from weftline.sources import vendor


def d(k, month=1):
    return dt.date(2024, month, k)


def test_columns_dates_numbers(spark):
    df = vendor.resolve(spark.createDataFrame([(1.0, 2.0, "x")], "Vol double, MONEY double, other string"))
    assert df.columns == ["volume", "amount", "other"]
    dates = {"2024-01-31": d(31), "2024/1/5 10:00": d(5), "20240131": d(31), "202401311530": d(31), "1706659200": d(31), "1706659200000": d(31), "x": None, "": None, None: None, "20241399": None}
    got = spark.createDataFrame([(k,) for k in dates], "s string").select("s", vendor.parse_date(F.col("s")).alias("v")).collect()
    assert {r.s: r.v for r in got} == dates
    numbers = {"1,234.5": 1234.5, " 7 ": 7.0, "12.5%": 0.125, "inf": None, "x": None, None: None}
    got = spark.createDataFrame([(k,) for k in numbers], "s string").select("s", vendor.number(F.col("s"), True).alias("v")).collect()
    assert {r.s: r.v for r in got} == numbers
    names = spark.createDataFrame([("a/F_202401021530.csv", "申万2021"), ("b_20240102153001.csv", "gics L1"), ("none.csv", None), ("x", "csi ")], "f string, s string")
    got = [(r.a and r.a.second, r.b) for r in names.select(vendor.file_stamp(F.col("f")).alias("a"), vendor.taxonomy(F.col("s")).alias("b")).collect()]
    assert got == [(0, "SW"), (1, "GICS"), (None, "SW"), (None, "CSI")]


def test_snapshot_and_anchors(spark):
    a = spark.createDataFrame([(d(2), "A", 1.0, None), (d(2), "B", 2.0, 5.0)], "date date, code string, pe double, pb double")
    b = spark.createDataFrame([(d(2), "A", 7.0, 9.0), (d(2), "C", 8.0, 9.5)], "date date, code string, pb double, cash double")
    assert sorted((r.code, r.pe, r.pb, r.cash) for r in vendor.snapshot(a, b).collect()) == [("A", 1.0, 7.0, 9.0), ("B", 2.0, 5.0, None), ("C", None, 8.0, 9.5)]
    c = cal.calendar(spark.createDataFrame([(str(x.date()),) for x in pd.bdate_range("2024-01-01", periods=60)], "date string"))
    snaps = spark.createDataFrame([(d(3), "A"), (d(12), "A")], "date date, code string")
    days = spark.createDataFrame([(d(12),), (d(1, 2),), (d(5),)], "date date")
    assert {r.date: r.anchor for r in vendor.stepped_anchor(days, snaps, c).collect()} == {d(12): d(12), d(1, 2): d(3), d(5): None}
    assert vendor.all_calendars(c, snaps).count() == 60
    gaps = spark.createDataFrame([("a", d(1), None), ("a", d(2), 1.0), ("a", d(3), None), ("b", d(3), None)], "code string, date date, v double")
    assert [r.v for r in vendor.carried(gaps, ["v"]).orderBy("code", "date").collect()] == [None, 1.0, 1.0, None]


def test_preprocess_and_text(spark, tmp_path):
    bars = spark.createDataFrame([(d(k), c, 1.0) for k in (2, 3) for c in "AB"] + [(d(3), "Z", 1.0)], "date date, code string, close double")
    members = spark.createDataFrame([(d(2), "A"), (d(2), "B"), (d(3), "C")], "date date, code string")
    for _ in range(2):
        got = vendor.preprocess(bars, members, d(2), d(3), str(tmp_path / "p")).collect()
        assert [tuple(r) for r in got] == [(d(3), 3, 2, 4)]
    vendor.write_text(members, "code", str(tmp_path / "t"))
    assert sorted(r.value for r in vendor.read_text(spark, str(tmp_path / "t")).collect()) == ["A", "B", "C"] and vendor.read_text(spark, str(tmp_path / "no")).count() == 0


def test_as_of_forms_no_pairs(spark):
    rng = np.random.default_rng(4)
    days = pd.DataFrame({"date": [d(int(k)) for k in rng.integers(1, 29, 60)], "code": rng.choice(list("abc"), 60)}).drop_duplicates()
    facts = pd.DataFrame({"code": rng.choice(list("abd"), 40), "eff": [d(int(k)) for k in rng.integers(1, 29, 40)], "v": rng.integers(0, 99, 40)})
    df = store.as_of(spark.createDataFrame(days), spark.createDataFrame(facts), "code", "eff", ["v"], 2)
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    for r in df.collect():
        known = facts[(facts.code == r.code) & (facts.eff <= r.date - dt.timedelta(days=2))].sort_values(["eff", "v"])
        assert (r.eff, r.v) == ((known.eff.iloc[-1], known.v.iloc[-1]) if len(known) else (None, None))


def test_positions_stick_within_the_band(spark):
    t = [(d(1), "a", 0.5), (d(1), "b", 0.5), (d(2), "a", 0.505), (d(2), "b", 0.495), (d(3), "a", 0.511), (d(3), "c", 0.489)]
    held = portfolio.positions(spark.createDataFrame(t, "date date, code string, weight double"), 0.01)
    got = {(r.date, r.code): r.weight for r in held.collect()}
    assert got == {(d(1), "a"): 0.5, (d(1), "b"): 0.5, (d(2), "a"): 0.5, (d(2), "b"): 0.5, (d(3), "a"): 0.511, (d(3), "b"): 0.0, (d(3), "c"): 0.489}
    sides = sorted((r.date, r.code, r.side) for r in portfolio.position_orders(held).collect())
    assert sides == [(d(1), "a", "BUY"), (d(1), "b", "BUY"), (d(3), "a", "BUY"), (d(3), "b", "SELL"), (d(3), "c", "BUY")]
    before = spark.createDataFrame([("b", 0.499), ("z", 0.2)], "code string, weight double")
    first = {r.code: (r.weight, r.before) for r in portfolio.positions(spark.createDataFrame(t[:2], "date date, code string, weight double"), 0.01, before).collect()}
    assert first == {"a": (0.5, 0.0), "b": (0.499, 0.499), "z": (0.0, 0.2)}
    c = cal.calendar(spark.createDataFrame([(str(x.date()),) for x in pd.bdate_range("2024-01-01", periods=10)], "date string"))
    assert [r.date.day for r in portfolio.rebalance_days(c, 4).orderBy("date").collect()] == [1, 5, 11]
    assert [r.date.day for r in portfolio.rebalance_days(c, 4, "2024-01-04").orderBy("date").collect()] == [10]


def panel_of(spark, days):
    rng = np.random.default_rng(11)
    dates = pd.bdate_range("2024-01-01", periods=40)
    rows = [(x.date(), f"c{k:02d}", i + 1, float(10 + k + rng.normal()), float(rng.integers(10, 99)), float(rng.integers(100, 999)), f"i{k % 3}", 10.0, 0) for i, x in enumerate(dates) for k in range(30)]
    return spark.createDataFrame(rows, "date date, code string, ord int, close double, volume double, amount double, industry string, preclose double, paused int").filter(F.col("ord") <= days)


def test_resume_goes_on_from_the_manifest(spark, tmp_path):
    factors, options = {"f14": X.delta(X.var("close"), 5), "f0": X.var("no_such_column")}, {"lookback": 6, "top": 5, "max_weight": 0.4}
    factors = {"f14": factors["f14"], "f2": X.rank(X.var("volume"))}
    parts, once = str(tmp_path / "a"), str(tmp_path / "b")
    assert daily.resume(panel_of(spark, 30), factors, parts, **options) is not None
    assert daily.resume(panel_of(spark, 30), factors, parts, **options) is None
    assert daily.resume(panel_of(spark, 36), factors, parts, **options) is not None
    daily.resume(panel_of(spark, 36), factors, once, **options)
    for name in ("alphas", "positions", "orders"):
        a, b = (spark.read.parquet(f"{x}/{name}").toPandas().sort_values(["date", "code"], ignore_index=True) for x in (parts, once))
        pd.testing.assert_frame_equal(a, b[a.columns], obj=name)
        assert len(a)


def test_missing_variables_are_null(spark):
    got = X.evaluate(panel_of(spark, 3), {"a": X.var("no_such_column") + 1, "b": X.var("close")}).agg(F.count("a"), F.count("b")).first()
    assert tuple(got) == (0, 90)


def test_fit_metrics(spark):
    rng = np.random.default_rng(42)
    p = pd.DataFrame({"date": d(5), "code": [f"c{i:02d}" for i in range(60)], "size": rng.normal(size=60), "ind": ["A", "B", "C"] * 20})
    p["f1"], p["f2"], p["f3"] = p["size"] * 2 + rng.normal(size=60), np.nan, np.where(np.arange(60) < 6, rng.normal(size=60), np.nan)
    df = spark.createDataFrame(p)
    m = {r.factor_id: r for r in regress.orthogonalize_metrics(df, ["f1", "f2", "f3"], ["size"], "ind").collect()}
    assert (m["f2"].n, m["f2"].fail, m["f2"].reason) == (0, 1, "all-NaN") and (m["f3"].n, m["f3"].reason) == (6, "insufficient N")
    res = [r.residual for r in regress.orthogonalize(df, ["f1"], ["size"], "ind").collect()]
    assert m["f1"].n == 60 and m["f1"].p == 3 and abs(m["f1"].rmse - np.sqrt(np.mean(np.square(res)))) < 1e-12 and 0.6 < m["f1"].r2 < 1


def test_style_groups(spark):
    cfg = styles.style_config('{"groups": [{"group": "mom", "members": ["rstr", "none"]}, {"name": "val", "factors": ["bp", "ep"], "post_standardize": false}], "weights": {"val": {"bp": 0.25, "ep": 0.75}}}')
    assert cfg == {"mom": (["rstr", "none"], {}, True), "val": (["bp", "ep"], {"bp": 0.25, "ep": 0.75}, False)} and styles.style_config("[]") == {}
    rng = np.random.default_rng(1)
    p = pd.DataFrame({"date": d(2), "code": [f"c{k}" for k in range(50)], "rstr": rng.normal(size=50), "bp": rng.normal(size=50), "ep": rng.normal(size=50)})
    got = styles.style_exposures(spark.createDataFrame(p), cfg).toPandas().set_index("code").reindex(p.code)
    z = lambda x: (lambda c: (c - c.mean()) / c.std(ddof=0))(x.clip(*x.quantile([0.01, 0.99])))
    z2 = lambda x: (x - x.mean()) / x.std(ddof=0)
    assert np.allclose(got.mom, z2(z(p.rstr))) and np.allclose(got.val, 0.25 * z(p.bp) + 0.75 * z(p.ep))
    shares = spark.createDataFrame([("c1", d(1), 100.0, 50.0), ("c1", d(2), 999.0, 999.0)], "code string, effective date, total_shares double, float_shares double")
    r = styles.hydrate(spark.createDataFrame([(d(2), "c1", 3.0), (d(2), "c2", 4.0)], "date date, code string, close double"), shares).orderBy("code").collect()
    assert (r[0].market_cap, r[0].float_shares, r[1].market_cap) == (300.0, 50.0, None)
    f = styles.fundamental_styles(spark.createDataFrame([(d(2), "a", 3.0, 100.0, 60.0)], "date date, code string, close double, total_shares double, total_equity double")).first()
    assert abs(f.btop - 0.2) < 1e-12 and abs(f.lncap - np.log(300)) < 1e-12 and f.ep_ttm is None


def test_price_styles_equal_plain_weights(spark):
    """beta, hsigma, dastd, rstr and turnover of one code's last row, from their definitions."""
    rng = np.random.default_rng(3)
    n, dates = 90, pd.bdate_range("2023-01-02", periods=90)
    close = 10 * np.exp(np.cumsum(rng.normal(0, 0.02, (n, 4)), axis=0))
    vol = rng.integers(100, 900, (n, 4)).astype(float)
    rows = [(dates[i].date(), f"c{k}", i + 1, float(close[i, k]), None if i == 80 and k == 0 else float(vol[i, k]), 1000.0) for i in range(n) for k in range(4)]
    p = spark.createDataFrame(rows, "date date, code string, ord int, close double, volume double, float_shares double")
    got = styles.price_styles(p, 60, 60, 80, 5, 20).filter(F.col("date") == dates[-1].date()).filter("code = 'c0'").first()
    r, m = close[1:, 0] / close[:-1, 0] - 1, (lambda x: x[1:] / x[:-1] - 1)(close.mean(axis=1))
    w = np.array(styles.ema_weights(60, 60.0))
    y, x = r[-60:], m[-60:]
    my, mx = w @ y, w @ x
    beta = (w @ (x * y) - mx * my) / (w @ (x * x) - mx * mx)
    rest = y - my - beta * (x - mx)
    v = np.array(styles.ema_weights(60, 40.0))
    logs = np.log1p(r)[-80:-5]
    u = np.exp(-np.log(2) / 120 * np.arange(len(logs))[::-1])
    vol[80, 0] = vol[79, 0]
    want = {"beta": beta, "hsigma": np.sqrt(w @ rest**2), "dastd": np.sqrt(v @ y**2 - (v @ y) ** 2), "rstr": (u @ logs) / u.sum(), "stom": vol[-21:, 0].sum() / 1000, "stoq": vol[-63:, 0].sum() / 1000}
    for k, x in want.items():
        assert abs(got[k] - x) < 1e-9 * max(1, abs(x)), k
    assert got.stoa is None
