"""Style sub-factors from prices, as window expressions with exponential weights."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import crosssec
from weftline.operators.store import as_of


def ema_weights(n: int, half_life: float) -> list[float]:
    """Oldest first, summing to 1."""
    w = [math.exp(-math.log(2) / half_life * (n - 1 - t)) for t in range(n)]
    return [x / sum(w) for x in w]


def _weighted(x: Column, half_life: float) -> Column:
    """x times a weight that halves every half_life rows; relative to the row's place, so a window's ratio of sums needs no list."""
    return x * F.exp(F.lit(math.log(2) / half_life) * (F.col("ord") % F.lit(1_000_000)))


def price_styles(panel: DataFrame, beta_n: int = 250, vol_n: int = 250, mom_n: int = 500, skip: int = 21, least: int = 120) -> DataFrame:
    """panel: date, code, ord, close, volume (dense). date, code, beta, hsigma, dastd, rstr, stom, stoq, stoa.

    beta and hsigma: weighted regression (half-life 60) of returns on the equal-weighted market, rows with a missing return
    passed over; dastd: weighted deviation (half-life 40); rstr: weighted log returns from mom_n to `skip` rows back
    (half-life 120); sto*: where the panel has float_shares, the turnover (last known volume by float shares) summed over 21, 63,
    252 rows, else the logarithm of the volume's sums, from `least` rows on."""
    w = Window.partitionBy("code").orderBy("date")
    by_date = Window.partitionBy("date")
    shares = "float_shares" in panel.columns
    if shares:
        held = F.last("volume", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        panel = panel.withColumn("volume", F.try_divide(held, F.when(F.col("float_shares") > 0, F.col("float_shares"))))
    d = panel.select("date", "code", "ord", "close", "volume", F.avg("close").over(by_date).alias("market"))
    ret = lambda c: F.try_divide(F.col(c), F.lag(c).over(w)) - 1
    d = d.select("date", "code", "ord", "volume", ret("close").alias("y"), ret("market").alias("m"))
    back = lambda n: w.rowsBetween(-(n - 1), 0)
    seen = F.col("y").isNotNull() & F.col("m").isNotNull()
    total = lambda x, h, win: F.sum(F.when(seen, _weighted(x, h))).over(win)
    one, y, m = F.lit(1.0), F.col("y"), F.col("m")
    b = back(beta_n)
    d = d.withColumns({"s1": total(one, 60, b), "sm": total(m, 60, b), "sy": total(y, 60, b), "smm": total(m * m, 60, b), "smy": total(m * y, 60, b), "syy": total(y * y, 60, b), "seen_n": F.count(F.when(seen, 1)).over(b),
                       "v1": total(one, 40, back(vol_n)), "vy": total(y, 40, back(vol_n)), "vyy": total(y * y, 40, back(vol_n)),
                       "rstr_num": F.sum(F.when(y > -1, _weighted(F.log1p("y"), 120))).over(w.rowsBetween(-(mom_n - 1), -skip)), "rstr_den": F.sum(_weighted(one, 120)).over(w.rowsBetween(-(mom_n - 1), -skip)),
                       **{f"sum_{n}": F.sum("volume").over(back(n)) for n in (21, 63, 252)}, "vol_n": F.count("volume").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    mean_m, mean_y = F.col("sm") / F.col("s1"), F.col("sy") / F.col("s1")
    var_m = F.col("smm") / F.col("s1") - mean_m * mean_m
    beta = F.try_divide(F.col("smy") / F.col("s1") - mean_m * mean_y, F.when(var_m > 1e-15, var_m))
    rest = F.col("syy") / F.col("s1") - mean_y * mean_y - beta * beta * var_m
    ready = F.col("seen_n") >= least
    vol = F.col("vyy") / F.col("v1") - F.pow(F.col("vy") / F.col("v1"), F.lit(2))
    sto = lambda n: F.when(F.col("vol_n") >= max(least, n if shares else 0), F.col(f"sum_{n}") if shares else F.ln(F.when(F.col(f"sum_{n}") > 0, F.col(f"sum_{n}"))))
    return d.select("date", "code", F.when(ready, beta).alias("beta"), F.when(ready, F.sqrt(F.greatest(rest, F.lit(0.0)))).alias("hsigma"), F.when(ready, F.sqrt(F.greatest(vol, F.lit(0.0)))).alias("dastd"),
                    F.when(ready, F.col("rstr_num") / F.col("rstr_den")).alias("rstr"), sto(21).alias("stom"), sto(63).alias("stoq"), sto(252).alias("stoa"))


def fundamental_styles(df: DataFrame) -> DataFrame:
    """Ratios from a fundamentals snapshot, with fallbacks for capital and book value; columns that are missing count as NULL."""
    have = set(df.columns)
    c = lambda n: F.col(n) if n in have else F.lit(None).cast("double")
    cap = F.coalesce(c("market_cap"), c("close") * c("total_shares"))
    float_cap = F.coalesce(c("float_mktcap"), c("close") * c("float_shares"))
    book = F.coalesce(c("total_equity"), F.try_divide(cap, c("pb")))
    ln = lambda x: F.ln(F.when(x > 0, x))
    out = {
        "lncap": ln(F.coalesce(float_cap, cap)), "btop": F.try_divide(book, cap), "ep_ttm": F.try_divide(c("net_profit_ttm"), cap), "sp_ttm": F.try_divide(c("revenue_ttm"), cap),
        "cf_yield": F.try_divide(c("oper_cf_ttm"), cap), "leverage": F.try_divide(c("total_assets"), c("total_equity")), "mlev": F.try_divide(c("long_debt"), cap),
        "dtoa": F.try_divide(c("total_debt"), c("total_assets")), "blev": F.try_divide(c("long_debt"), c("total_equity")),
        "growth_rev_yoy": c("growth_rev_yoy"), "growth_np_yoy": c("growth_np_yoy"), "roe_ttm": c("roe_ttm"), "roa_ttm": c("roa_ttm"),
    }
    return df.select(*[k for k in ("date", "code") if k in have], *[v.alias(k) for k, v in out.items()])


def style_config(text: str) -> dict[str, tuple[list[str], dict[str, float], bool]]:
    """group: (members, weights, standardized after). JSON (so also YAML's flow form): {"groups": .., "weights": ..}; groups as a map or a
    list of {group or name, members or factors, post_standardize}, weights as a map or a list of {group or name, weights}. What is of
    another form counts as empty."""
    data = json.loads(text)
    groups, weights = (data.get(k) or {} for k in ("groups", "weights")) if isinstance(data, dict) else ({}, {})
    named = lambda x: x.get("group") or x.get("name")
    if isinstance(groups, list):
        groups = {named(g) or f"group_{k}": g for k, g in enumerate(groups) if isinstance(g, dict)}
    if isinstance(weights, list):
        weights = {named(w): w.get("weights") or {} for w in weights if isinstance(w, dict) and named(w)}
    out = {}
    for name, g in groups.items():
        g = {"members": g} if isinstance(g, list) else g
        if isinstance(g, dict):
            w = weights.get(name)
            out[str(name)] = (list(g.get("members") or g.get("factors") or []), {str(k): float(v) for k, v in (w if isinstance(w, dict) else {}).items()}, bool(g.get("post_standardize", True)))
    return out


def style_exposures(df: DataFrame, groups: dict[str, tuple[list[str], dict[str, float], bool]]) -> DataFrame:
    """df: date, code and sub-factors. date, code and a column for each group: members are winsorized and standardized by date, put
    together by their weights (evenly over those that are there where none are given), and standardized again. A member that df
    lacks counts as NULL."""
    names = sorted({m for members, _, _ in groups.values() for m in members})
    d = df.select("date", "code", *[F.col(m).cast("double").alias(m) if m in df.columns else F.lit(None).cast("double").alias(m) for m in names])
    d = crosssec.standardize(d, names, ["date"])
    after = []
    for name, (members, weights, again) in groups.items():
        given = {m: weights.get(m, 0.0) for m in members} if weights else dict.fromkeys(members)
        d = crosssec.group_mean(d, given, f"group_{name}") if members else d.withColumn(f"group_{name}", F.lit(None).cast("double"))
        after += [f"group_{name}"] * again
    d = crosssec.zscore(d, after, ["date"])
    return d.select("date", "code", *[F.col(f"group_{name}").alias(name) for name in groups])


def hydrate(df: DataFrame, shares: DataFrame | None = None, balance: DataFrame | None = None, lag_days: int = 1) -> DataFrame:
    """df: date, code, close. Adds the last known share counts (code, effective, total_shares, float_shares) and balance-sheet items
    (code, published, ...) of at least lag_days before the date, and market_cap from the close where it isn't given."""
    for facts, at in ((shares, "effective"), (balance, "published")):
        if facts is not None:
            rest = [c for c in facts.columns if c not in ("code", at)]
            found = as_of(df.select("date", "code").distinct(), facts, "code", at, rest, lag_days).drop(at)
            df = df.join(found.select("date", "code", *[c for c in rest if c not in df.columns]), ["date", "code"], "left")
    if "total_shares" in df.columns and "market_cap" not in df.columns:
        df = df.withColumn("market_cap", F.col("close") * F.col("total_shares"))
    return df
