"""Weights and orders from alphas."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(alphas: DataFrame, k: int, max_weight: float = 1.0) -> DataFrame:
    """date, code, weight: the k best alphas of each date (at most 1 / max_weight of them), weighted by max(alpha, 0), or evenly
    where none is over 0; capped at max_weight, what the cap frees shared out evenly once."""
    k = min(k, math.floor(1 / max_weight + 1e-9)) if max_weight < 1 else k
    order = Window.partitionBy("date").orderBy(F.col("alpha").desc(), F.col("code"))
    by = Window.partitionBy("date")
    best = alphas.filter("alpha IS NOT NULL").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    score = F.greatest("alpha", F.lit(0.0))
    raw = best.withColumn("n", F.count(F.lit(1)).over(by)).withColumn("total", F.sum(score).over(by))
    raw = raw.withColumn("weight", F.when(F.col("total") > 0, score / F.when(F.col("total") > 0, F.col("total"))).otherwise(1 / F.col("n")))
    cut = raw.withColumn("weight", F.least("weight", F.lit(max(max_weight, 0.0)))).withColumn("free", 1 - F.sum("weight").over(by))
    room = F.when(F.col("weight") < max_weight, max_weight - F.col("weight")).otherwise(0.0)
    cut = cut.withColumn("room", room).withColumn("rooms", F.sum("room").over(by))
    return cut.select("date", "code", (F.col("weight") + F.when(F.col("rooms") > 0, F.col("room") * F.least(F.lit(1.0), F.col("free") / F.when(F.col("rooms") > 0, F.col("rooms")))).otherwise(0.0)).alias("weight"))


def positions(targets: DataFrame, band: float = 0.01, start: DataFrame | None = None) -> DataFrame:
    """date, code, weight, before: what is held after each rebalance and what was before it. A change under `band` isn't made, so a
    position stays until the target has moved away from it by that much; a code without target is sold. start: code, weight, held
    before the first date. Codes don't depend on each other, so each is carried through the dates (a calendar, so few) on its own."""
    dates = targets.select("date").distinct()
    began = targets.select("code").distinct()
    if start is not None:
        began = began.unionAll(start.select("code")).distinct()
        began = began.join(start.select("code", F.col("weight").alias("held")), "code", "left")
    else:
        began = began.withColumn("held", F.lit(0.0))
    code = dict(targets.dtypes)["code"]
    grid = began.crossJoin(dates).join(targets.select("date", "code", F.col("weight").alias("target")), ["date", "code"], "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        held = float(pdf.held.fillna(0.0).iloc[0])
        out = []
        for target in pdf.target.to_numpy(float):
            wanted = 0.0 if np.isnan(target) else target
            before, held = held, (held if not np.isnan(target) and abs(wanted - held) < band else wanted)
            out.append((held, before))
        return pdf[["date", "code"]].assign(weight=[x for x, _ in out], before=[x for _, x in out])

    done = grid.select("date", "code", "target", "held").groupBy("code").applyInPandas(run, f"date date, code {code}, weight double, before double")
    return done.filter("weight <> 0 OR before <> 0")


def position_orders(held: DataFrame) -> DataFrame:
    """date, code, target_weight, side of positions()."""
    change = F.col("weight") - F.col("before")
    side = F.when(change > 1e-10, "BUY").when(change < -1e-10, "SELL")
    return held.select("date", "code", F.col("weight").alias("target_weight"), side.alias("side")).filter("side IS NOT NULL")


def rebalance_days(cal: DataFrame, gap: int, last=None) -> DataFrame:
    """date of the days on which to rebalance: the first one, then each `gap` trading days on; last: the last one already made."""
    days = cal.select("date", "ord")
    if last is None:
        base = days.agg(F.min("ord").alias("base"))
        return days.crossJoin(base).filter((F.col("ord") - F.col("base")) % gap == 0).select("date")
    base = days.filter(F.col("date") <= F.lit(last).cast("date")).agg(F.max("ord").alias("base"))
    return days.crossJoin(base).filter((F.col("ord") > F.col("base")) & ((F.col("ord") - F.col("base")) % gap == 0)).select("date")


def orders(target: DataFrame, previous: DataFrame, band: float = 0.01) -> DataFrame:
    """date, code, target_weight, side (BUY, SELL): changes of at least `band`; what is held and no longer wanted is sold.
    target: date, code, weight; previous: the same, the weights held into that date."""
    t = target.select("date", "code", F.col("weight").alias("w"))
    p = previous.select("date", "code", F.col("weight").alias("p"))
    both = t.join(p, ["date", "code"], "full_outer").select("date", "code", F.coalesce("w", F.lit(0.0)).alias("w"), F.coalesce("p", F.lit(0.0)).alias("p"))
    change = F.col("w") - F.col("p")
    side = F.when(F.abs(change) < band, "HOLD").when(change > 1e-10, "BUY").when(change < -1e-10, "SELL").otherwise("HOLD")
    return both.select("date", "code", F.col("w").alias("target_weight"), side.alias("side")).filter("side <> 'HOLD'")


def linear_program(c: np.ndarray, a: np.ndarray, b: np.ndarray, tol: float = 1e-8, steps: int = 100) -> np.ndarray | None:
    """min c'x, a x = b, x >= 0 by a primal-dual interior point with predictor and corrector; None where it does not settle."""
    m, n = a.shape
    # Rows that depend on others are left out.
    q, r = np.linalg.qr(a.T)
    keep = np.abs(np.diag(r)) > 1e-10 * max(1.0, np.abs(r).max())
    a, b = a[keep], b[keep]
    gram = a @ a.T
    x = a.T @ np.linalg.solve(gram, b)
    y = np.linalg.solve(gram, a @ c)
    s = c - a.T @ y
    x, s = x + max(-1.5 * x.min(), 0), s + max(-1.5 * s.min(), 0)
    xs = max(x @ s, 1e-6)
    x, s = x + 0.5 * xs / max(s.sum(), 1e-6) + 1e-6, s + 0.5 * xs / max(x.sum(), 1e-6) + 1e-6
    for _ in range(steps):
        rp, rd, mu = b - a @ x, c - a.T @ y - s, x @ s / n
        if np.linalg.norm(rp) < tol * (1 + np.linalg.norm(b)) and np.linalg.norm(rd) < tol * (1 + np.linalg.norm(c)) and mu < tol:
            return x
        d = x / s
        left = (a * d) @ a.T + 1e-13 * np.eye(len(b))

        def solve(rc):
            dy = np.linalg.solve(left, rp + a @ (d * rd - rc / s))  # noqa: B023
            ds = rd - a.T @ dy  # noqa: B023
            return (rc - x * ds) / s, dy, ds  # noqa: B023

        def reach(v, dv):
            down = dv < 0
            return min(1.0, 0.99 * float(np.min(-v[down] / dv[down]))) if down.any() else 1.0

        dx, dy, ds = solve(-x * s)
        near = (x + reach(x, dx) * dx) @ (s + reach(s, ds) * ds) / n
        dx, dy, ds = solve((near / mu) ** 3 * mu - x * s - dx * ds)
        ax, az = reach(x, dx), reach(s, ds)
        x, y, s = x + ax * dx, y + az * dy, s + az * ds
        if not np.isfinite(x).all():
            return None
    return None


def bounded_program(c: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, tol: float = 1e-9, steps: int = 100) -> np.ndarray | None:
    """min c'x, a x = b, 0 <= x <= most (over 0) by a primal-dual interior point with predictor and corrector; None where it does not
    settle. a has few rows; only they and some vectors are held, so memory and a step's time are in proportion to the columns."""
    r = np.linalg.qr(a.T, mode="r")
    keep = np.flatnonzero(np.abs(np.diag(r)) > 1e-10 * max(1.0, np.abs(r).max()))  # rows that depend on others are left out
    if np.linalg.norm(np.linalg.lstsq(a[keep].T, a.T, rcond=None)[0].T @ b[keep] - b) > 1e-6 * (1 + np.linalg.norm(b)):
        return None  # they contradict each other
    a, b = a[keep], b[keep]

    def solver(d: np.ndarray):
        """f to y, where a diag(d) a' y = f. By QR of the root: near the solution few columns are free, and the product would be singular."""
        root = (a * np.sqrt(d)).T
        scale = 1 / np.maximum(np.linalg.norm(root, axis=0), 1e-150)
        r = np.linalg.qr(np.vstack([root * scale, 1e-12 * np.eye(len(b))]), mode="r")
        return lambda f: scale * np.linalg.solve(r, np.linalg.solve(r.T, scale * f))

    x, v, y = most / 2, most / 2, solver(np.ones(len(c)))(a @ c)
    left = c - a.T @ y
    least = 0.1 * (1 + np.abs(left).max())
    z, w = np.maximum(left, 0) + least, np.maximum(-left, 0) + least  # duals of x >= 0 and of x <= most
    for _ in range(steps):
        rp, rd, mu = b - a @ x, c - a.T @ y - z + w, (x @ z + v @ w) / (2 * len(c))
        if np.linalg.norm(rp) < tol * (1 + np.linalg.norm(b)) and np.linalg.norm(rd) < tol * (1 + np.linalg.norm(c)) and x @ z + v @ w < tol * (1 + abs(c @ x)):
            return x
        d = 1 / (z / x + w / v)
        inverse = solver(d)

        def step(xz, vw):
            g = rd - xz / x + vw / v  # noqa: B023
            dy = inverse(rp + a @ (d * g))  # noqa: B023
            dx = d * (a.T @ dy - g)  # noqa: B023
            return dx, dy, (xz - z * dx) / x, (vw + w * dx) / v  # noqa: B023

        def reach(*pairs):
            return min([1.0, *(0.99 * float(np.min(-p[q < 0] / q[q < 0])) for p, q in pairs if (q < 0).any())])

        dx, dy, dz, dw = step(-x * z, -v * w)
        ax, az = reach((x, dx), (v, -dx)), reach((z, dz), (w, dw))
        near = ((x + ax * dx) @ (z + az * dz) + (v - ax * dx) @ (w + az * dw)) / (2 * len(c))
        aim = (near / mu) ** 3 * mu
        dx, dy, dz, dw = step(aim - x * z - dx * dz, aim - v * w + dx * dw)
        ax, az = reach((x, dx), (v, -dx)), reach((z, dz), (w, dw))
        x, v, y, z, w = x + ax * dx, v - ax * dx, y + az * dy, z + az * dz, w + az * dw
        if not (np.isfinite(x).all() and np.isfinite(z).all() and np.isfinite(w).all()):
            return None
    return None


def neutral_weights(alpha: np.ndarray, exposures: np.ndarray, bench: np.ndarray, previous: np.ndarray, cost: float = 0.003, max_weight: float = 0.06) -> np.ndarray | None:
    """Long-only weights: most alpha less trading cost, sum 1, the benchmark's exposures, at most max_weight each. As trading costs, no code
    is both bought and sold, so the program is over what is bought and what is sold of each, within bounds, and its few rows."""
    n = len(alpha)
    rows = np.vstack([np.ones(n), exposures.T])
    base = np.clip(previous, 0, max_weight)  # what can't be held is sold first
    total = np.concatenate([[1.0], exposures.T @ bench]) - rows @ base
    more, less = np.flatnonzero(base < max_weight), np.flatnonzero(base > 0)
    c = np.concatenate([cost / 2 - alpha[more], cost / 2 + alpha[less]])
    x = bounded_program(c, np.hstack([rows[:, more], -rows[:, less]]), total, np.concatenate([max_weight - base[more], base[less]]))
    if x is None:
        return None
    w = base.copy()
    w[more] += x[: len(more)]
    w[less] -= x[len(more) :]
    return w


def benchmark_neutral(data: DataFrame, styles: list[str], industry: str | None, top: int = 50, cost: float = 0.003, max_weight: float = 0.06) -> DataFrame:
    """data: date, code, alpha, bench, previous, styles, industry. date, code, weight, method (lp, or topk where the program has no solution)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["alpha", *styles]).reset_index(drop=True)
        if pdf.empty:
            return pd.DataFrame({"date": [], "code": [], "weight": [], "method": []})
        x = pdf[styles].to_numpy(float)
        if industry:
            x = np.column_stack([x, pd.get_dummies(pdf[industry].fillna("OTHER")).to_numpy(float)])
        bench = pdf.bench.fillna(0).to_numpy(float)
        bench = bench / bench.sum() if bench.sum() > 0 else np.full(len(pdf), 1 / len(pdf))
        w = neutral_weights(pdf.alpha.to_numpy(float), x, bench, pdf.previous.fillna(0).to_numpy(float), cost, max(max_weight, 1 / len(pdf)))
        method = "lp"
        if w is None:
            method, w = "topk", np.zeros(len(pdf))
            w[np.argsort(-pdf.alpha.to_numpy(float), kind="stable")[: min(top, len(pdf))]] = 1 / min(top, len(pdf))
        return pdf[["date", "code"]].assign(weight=w, method=method)

    need = ["date", "code", "alpha", "bench", "previous", *styles, *([industry] if industry else [])]
    return data.select(*need).groupBy("date").applyInPandas(run, f"date date, code {dict(data.dtypes)['code']}, weight double, method string")
