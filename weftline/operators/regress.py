"""Per-date regressions: one design matrix a date, many right-hand sides, solved by numpy inside a grouped map.

A date's cross-section is bounded by the universe (hundreds to thousands of codes), so a group fits a task; dates are the
unit of parallel work.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ridge_fit(x: np.ndarray, y: np.ndarray, alpha: float = 0.0, weights: np.ndarray | None = None, intercept: bool = True) -> tuple[np.ndarray, float, dict]:
    """Coefficients, intercept, {n, p, rank, r2}. Rows with a missing value are left out; the intercept bears no penalty."""
    x, y = np.asarray(x, dtype=float), np.asarray(y, dtype=float)
    w = np.ones(len(y)) if weights is None else np.asarray(weights, dtype=float)
    ok = np.isfinite(x).all(axis=1) & np.isfinite(y) & np.isfinite(w) & (w >= 0)
    x, y, w = x[ok], y[ok], w[ok]
    p = x.shape[1]
    if not len(y):
        return np.full(p, np.nan), np.nan, {"n": 0, "p": p, "rank": 0, "r2": np.nan}
    full = np.column_stack([x, np.ones(len(y))]) if intercept else x
    root = np.sqrt(w)[:, None]
    a, b = full * root, y * root[:, 0]
    gram = a.T @ a + alpha * np.diag([1.0] * p + [0.0] * intercept)
    rank = int(np.linalg.matrix_rank(gram))
    beta = np.linalg.solve(gram, a.T @ b) if rank == len(gram) else np.linalg.lstsq(gram, a.T @ b, rcond=1e-12)[0]
    fit = full @ beta
    middle = np.average(y, weights=w) if w.sum() > 0 else 0.0
    total = float((w * (y - middle) ** 2).sum())
    r2 = 1 - float((w * (y - fit) ** 2).sum()) / total if total > 0 else np.nan
    return beta[:p], float(beta[p]) if intercept else 0.0, {"n": len(y), "p": p, "rank": rank, "r2": r2}


def forward_return(panel: DataFrame, f: int = 2) -> DataFrame:
    """date, code, forward: ln(close in f trading rows / close), on a dense panel."""
    w = Window.partitionBy("code").orderBy("date")
    later = F.lead("close", f).over(w)
    return panel.select("date", "code", F.when((later > 0) & (F.col("close") > 0), F.ln(later) - F.ln("close")).alias("forward"))


def _dummies(names: pd.Series) -> np.ndarray:
    """One column for each industry that occurs, the first one (the intercept's) left out."""
    kinds = sorted(names.fillna("OTHER").unique())
    return np.column_stack([(names.fillna("OTHER") == k).to_numpy(float) for k in kinds[1:]]) if len(kinds) > 1 else np.zeros((len(names), 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Winsorized (1 %) and standardized columns."""
    with np.errstate(all="ignore"):
        out = np.array(x, dtype=float)
        for k in range(out.shape[1]):
            col = out[:, k]
            if np.isfinite(col).any():
                col = np.clip(col, *np.nanquantile(col, [0.01, 0.99]))
                s = np.nanstd(col)
                out[:, k] = (col - np.nanmean(col)) / s if s > 0 else 0.0
    return out


def _residuals(pdf: pd.DataFrame, factors: list[str], styles: list[str], industry: str | None, alpha: float) -> tuple[np.ndarray, np.ndarray, list[int], int]:
    """Of one date: scaled factors, their residuals, rows used for each factor (whether or not they were enough), columns p."""
    x = _scaled(pdf[styles].to_numpy(float))
    if industry:
        x = np.column_stack([x, _dummies(pdf[industry])])
    full = np.column_stack([x, np.ones(len(pdf))])
    y = _scaled(pdf[factors].to_numpy(float))
    ok_x, out, used = np.isfinite(x).all(axis=1), np.full(y.shape, np.nan), [0] * y.shape[1]
    patterns: dict[bytes, list[int]] = {}
    for k in range(y.shape[1]):
        patterns.setdefault((ok_x & np.isfinite(y[:, k])).tobytes(), []).append(k)
    for mask, ks in patterns.items():
        rows = np.frombuffer(mask, dtype=bool)
        for k in ks:
            used[k] = int(rows.sum())
        if rows.sum() < x.shape[1] + 5:
            continue
        a = full[rows]
        gram = a.T @ a + alpha * np.diag([1.0] * x.shape[1] + [0.0])
        beta = np.linalg.lstsq(gram, a.T @ y[np.ix_(rows, ks)], rcond=1e-12)[0]
        out[np.ix_(rows, ks)] = y[np.ix_(rows, ks)] - a @ beta
    return y, out, used, x.shape[1]


def orthogonalize(exposures: DataFrame, factors: list[str], styles: list[str], industry: str | None = None, alpha: float = 1e-6) -> DataFrame:
    """date, code, factor_id, residual: each standardized factor less its ridge fit on the standardized styles and the industries.

    A factor without enough rows (N < p + 5 after rows with missing values are left out) gives NULL residuals. Factors with
    the same rows missing share one factorization."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _residuals(pdf, factors, styles, industry, alpha)[1]
        long = pd.DataFrame(out, columns=factors).assign(date=pdf.date.to_numpy(), code=pdf.code.to_numpy()).melt(["date", "code"], var_name="factor_id", value_name="residual")
        return long[["date", "code", "factor_id", "residual"]].replace({np.nan: None}).astype({"residual": "float64"})

    need = ["date", "code", *factors, *styles, *([industry] if industry else [])]
    code = dict(exposures.dtypes)["code"]
    return exposures.select(*need).groupBy("date").applyInPandas(run, f"date date, code {code}, factor_id string, residual double")


def orthogonalize_metrics(exposures: DataFrame, factors: list[str], styles: list[str], industry: str | None = None, alpha: float = 1e-6) -> DataFrame:
    """date, factor_id, n, p, ridge_alpha, r2, rmse, fail, reason (all-NaN, insufficient N or NULL): how the fits of orthogonalize() went."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y, out, used, p = _residuals(pdf, factors, styles, industry, alpha)
        rows = []
        for k, name in enumerate(factors):
            r, r2, rmse = out[:, k], None, None
            reason = None if np.isfinite(r).any() else "insufficient N" if np.isfinite(y[:, k]).any() else "all-NaN"
            if reason is None:
                ok = np.isfinite(r)
                sse, sst = float((r[ok] ** 2).sum()), float(((y[ok, k] - y[ok, k].mean()) ** 2).sum())
                r2, rmse = (1 - sse / sst if sst > 0 else None), float(np.sqrt(sse / ok.sum()))
            rows.append((pdf.date.iloc[0], name, 0 if reason == "all-NaN" else used[k], p, alpha, r2, rmse, int(reason is not None), reason))
        done = pd.DataFrame(rows, columns=["date", "factor_id", "n", "p", "ridge_alpha", "r2", "rmse", "fail", "reason"])
        return done.astype({"r2": "float64", "rmse": "float64"})

    need = ["date", "code", *factors, *styles, *([industry] if industry else [])]
    return exposures.select(*need).groupBy("date").applyInPandas(run, "date date, factor_id string, n long, p long, ridge_alpha double, r2 double, rmse double, fail int, reason string")


def factor_returns(data: DataFrame, y: str, factors: list[str], styles: list[str] | None = None, industry: str | None = None, alpha: float = 0.0) -> DataFrame:
    """date, factor_id, beta, n, p, r2, rmse: a regression a date of y on the factors (and styles and industries). N < p + 5: NULL."""
    styles = styles or []

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[factors + styles].to_numpy(float)
        if industry:
            x = np.column_stack([x, _dummies(pdf[industry])])
        target = pdf[y].to_numpy(float)
        ok = np.isfinite(x).all(axis=1) & np.isfinite(target)
        beta, r2, rmse, n, p = np.full(len(factors), np.nan), np.nan, np.nan, int(ok.sum()), x.shape[1]
        if n >= p + 5:
            coef, constant, info = ridge_fit(x[ok], target[ok], alpha)
            beta, r2 = coef[: len(factors)], info["r2"]
            rmse = float(np.sqrt(((target[ok] - x[ok] @ coef - constant) ** 2).sum() / max(1, n - p)))
        out = pd.DataFrame({"date": pdf.date.iloc[0], "factor_id": factors, "beta": beta, "n": n, "p": p, "r2": r2, "rmse": rmse})
        return out.replace({np.nan: None}).astype({"beta": "float64", "r2": "float64", "rmse": "float64"})

    need = ["date", y, *factors, *styles, *([industry] if industry else [])]
    return data.select(*need).groupBy("date").applyInPandas(run, "date date, factor_id string, beta double, n long, p long, r2 double, rmse double")


def slope_by_date(data: DataFrame, y: str, x: str) -> DataFrame:
    """The one-factor case without Python: date, beta, intercept, n from moments."""
    d = data.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    s = d.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.avg(F.col(x) * F.col(y)).alias("mxy"), F.avg(F.col(x) * F.col(x)).alias("mxx"))
    var = F.col("mxx") - F.col("mx") * F.col("mx")
    beta = F.when((F.col("n") >= 6) & (var > 1e-12 * F.col("mxx")), (F.col("mxy") - F.col("mx") * F.col("my")) / var)
    return s.select("date", beta.alias("beta"), (F.col("my") - beta * F.col("mx")).alias("intercept"), "n")


def trailing_mean(returns: DataFrame, lookback: int = 252) -> DataFrame:
    """returns: date, factor_id, beta. Adds mu: the mean of the last `lookback` returns up to the date, missing ones passed over."""
    w = Window.partitionBy("factor_id").orderBy("date").rowsBetween(-(lookback - 1), 0)
    return returns.withColumn("mu", F.avg("beta").over(w))


def alpha(residuals: DataFrame, mu: DataFrame) -> DataFrame:
    """residuals: date, code, factor_id, residual; mu: date, factor_id, mu. date, code, alpha: the sum of residual x mu, missing
    ones passed over, NULL where all are missing."""
    return residuals.join(mu.select("date", "factor_id", "mu"), ["date", "factor_id"], "left").groupBy("date", "code").agg(F.sum(F.col("residual") * F.col("mu")).alias("alpha"))
