"""Factors against plain pandas on wide frames, written from the published formulas and not from the algebra."""

import numpy as np
import pandas as pd
import pytest

from weftline.functions.factors import catalogue
from weftline.plans import expr as X
from weftline.sources.panel import dense


@pytest.fixture(scope="module")
def market(spark):
    """300 dates x 6 codes with gaps; the panel and a dict of wide frames."""
    rng = np.random.default_rng(7)
    days = pd.bdate_range("2023-01-02", periods=300)
    rows = []
    for k in range(6):
        close = np.round(20 * np.exp(np.cumsum(rng.normal(0, 0.02, 300))), 2)
        for i, d in enumerate(days):
            if k == 1 and i in (9, 10, 70) or k == 2 and i < 25:
                continue
            c = float(close[i])
            o = round(c * (1 + rng.normal(0, 0.01)), 2)
            hi, lo = round(max(o, c) * 1.01, 2), round(min(o, c) * 0.99, 2)
            v = float(rng.integers(100, 9999))
            rows.append((d.date(), k, o, hi, lo, c, v, round(v * (hi + lo) / 2, 2)))
    p = dense(spark.createDataFrame(rows, "date date, code long, open double, high double, low double, close double, volume double, amount double")).cache()
    pdf = p.toPandas()
    return p, {x: pdf.pivot(index="date", columns="code", values=x).astype(float) for x in ("open", "high", "low", "close", "volume", "amount", "vwap", "bench_open", "bench_close")}


def plain(w):
    """number: frame. where(cond, a, b): a missing comparison is false."""
    o, h, lo, c, v, a, vw, bo, bc = (w[x] for x in ("open", "high", "low", "close", "volume", "amount", "vwap", "bench_open", "bench_close"))
    frame = lambda x: pd.DataFrame(x, index=c.index, columns=c.columns)
    where = lambda cond, a, b: frame(np.where(cond, a, b))
    total = lambda x, n: x.rolling(n, min_periods=n).sum()
    mean = lambda x, n: x.rolling(n, min_periods=n).mean()
    sd = lambda x, n: x.rolling(n, min_periods=n).std()
    top = lambda x, n: x.rolling(n, min_periods=n).max()
    least = lambda x, n: x.rolling(n, min_periods=n).min()
    ema = lambda x, n, m: x.ewm(alpha=m / n, adjust=False).mean()
    rank = lambda x: x.astype("float32").rank(axis=1, pct=True)
    c1, h1, l1, o1 = c.shift(), h.shift(), lo.shift(), o.shift()
    dc, ret = c - c1, c / c1 - 1
    positive = lambda x: where(x > 0, x, 0.0)

    def beta149():
        out = frame(np.nan)
        falls = bc < bc.shift()
        bench = bc / bc.shift() - 1
        for k in c.columns:
            for i in range(251, len(c)):
                y, x, f = ret[k].iloc[i - 251 : i + 1], bench[k].iloc[i - 251 : i + 1], falls[k].iloc[i - 251 : i + 1]
                if y.notna().all() and x.notna().all():
                    y, x = y[f].to_numpy(), x[f].to_numpy()
                    out.loc[c.index[i], k] = np.mean((x - x.mean()) * (y - y.mean())) / np.var(x, ddof=1)
        return out

    rs = 100 * ema(positive(dc), 12, 1) / ema(dc.abs(), 12, 1)
    x13 = ema(c, 13, 2)
    log3 = ema(ema(ema(np.log(c), 13, 2), 13, 2), 13, 2)
    up14, r20 = positive(h - h1), ret - mean(ret, 20)
    return {
        2: -(((c - lo) - (h - c)) / (h - lo)).diff(), 6: -rank(np.sign((0.85 * o + 0.15 * h).diff(4))), 14: c - c.shift(5), 15: o / c1 - 1, 18: c / c.shift(5), 20: 100 * (c / c.shift(6) - 1),
        24: ema(c - c.shift(5), 5, 1), 29: (c / c.shift(6) - 1) * v, 31: 100 * (c / mean(c, 12) - 1), 34: mean(c, 12) / c, 46: (mean(c, 3) + mean(c, 6) + mean(c, 12) + mean(c, 24)) / (4 * c),
        47: ema(100 * (top(h, 6) - c) / (top(h, 6) - least(lo, 6)), 9, 1), 53: 100 * total((c > c1).astype(float), 12) / 12, 65: mean(c, 6) / c, 66: 100 * (c / mean(c, 6) - 1),
        70: sd(a, 6), 71: 100 * (c / mean(c, 24) - 1), 78: ((h + lo + c) / 3 - mean((h + lo + c) / 3, 12)) / (0.015 * mean((c - mean((h + lo + c) / 3, 12)).abs(), 12)), 80: 100 * (v / v.shift(5) - 1),
        81: ema(v, 21, 2), 88: 100 * (c / c.shift(20) - 1), 89: 2 * (ema(c, 13, 2) - ema(c, 27, 2) - ema(ema(c, 13, 2) - ema(c, 27, 2), 10, 2)), 95: sd(a, 20), 97: sd(v, 10), 100: sd(v, 20),
        102: 100 * ema(positive(v.diff()), 6, 1) / ema(v.diff().abs(), 6, 1), 106: c - c.shift(20), 110: 100 * total(positive(h - c1), 20) / total(positive(c1 - lo), 20),
        112: 100 * (total(positive(dc), 12) - total(positive(-dc), 12)) / (total(positive(dc), 12) + total(positive(-dc), 12)), 118: 100 * total(h - o, 20) / total(o - lo, 20), 126: (c + h + lo) / 3,
        132: mean(a, 20), 134: (c / c.shift(12) - 1) * v, 135: ema((c / c.shift(20)).shift(), 20, 1), 144: total(where(c < c1, (c / c1 - 1).abs() / a, 0.0), 20) / total((c < c1).astype(float), 20), 149: beta149(),
        150: (c + h + lo) / 3 * v, 151: ema(c - c.shift(20), 20, 1), 153: (mean(c, 3) + mean(c, 6) + mean(c, 12) + mean(c, 24)) / 4, 158: ((h - ema(c, 15, 2)) - (lo - ema(c, 15, 2))) / c,
        162: (rs - least(rs, 12)) / (top(rs, 12) - least(rs, 12)), 166: -(19**1.5) / (19 * 18) * total((ret - mean(ret, 20)) ** 3, 20) / total((ret - mean(ret, 20)) ** 2, 20) ** 1.5, 167: total(positive(dc), 12), 173: 3 * x13 - 2 * ema(x13, 13, 2) + log3,
        168: -v / mean(v, 20), 171: -((lo - c) * o**5) / ((c - h) * c**5), 178: (c - c1) / c1 * v, 188: 100 * (h - lo - ema(h - lo, 11, 2)) / ema(h - lo, 11, 2), 189: mean((c - mean(c, 6)).abs(), 6),
    }


def test_factors_equal_pandas(market):
    p, wide = market
    want = plain(wide)
    got = X.evaluate(p, {f"f{k}": catalogue()[k] for k in want}).toPandas()
    for k, w in want.items():
        w = w.replace([np.inf, -np.inf], np.nan)
        g = got.pivot(index="date", columns="code", values=f"f{k}").astype(float)
        assert w.notna().sum().sum() > 20, k
        pd.testing.assert_frame_equal(g, w, check_names=False, check_freq=False, check_index_type=False, check_column_type=False, rtol=1e-6, atol=1e-12 if k == 144 else 1e-7, obj=f"f{k}")


def test_beta(market):
    p, wide = market
    x, y = wide["close"], wide["volume"]
    w = ((x * y).rolling(6).mean() - x.rolling(6).mean() * y.rolling(6).mean()) / x.rolling(6).var()
    g = X.evaluate(p, {"b": X.beta(X.var("volume"), X.var("close"), 6)}).toPandas().pivot(index="date", columns="code", values="b").astype(float)
    pd.testing.assert_frame_equal(g, w, check_names=False, check_freq=False, check_index_type=False, check_column_type=False, rtol=1e-6)
