"""Cross-sectional operators: by date, or by date and group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def winsorize(df: DataFrame, cols: list[str], by: list[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Clips each column to its exact quantiles within `by`; NULL stays NULL."""
    w = Window.partitionBy(*by)
    clip = lambda c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.percentile(c, lower).over(w)), F.percentile(c, upper).over(w)))
    return df.select(*[clip(c).alias(c) if c in cols else c for c in df.columns])


def zscore(df: DataFrame, cols: list[str], by: list[str], clip: float | None = None) -> DataFrame:
    """(x - mean) / population deviation within `by`; NULL where the deviation is zero."""
    w = Window.partitionBy(*by)

    def z(c: str) -> Column:
        x = F.try_divide(F.col(c) - F.avg(c).over(w), F.stddev_pop(c).over(w))
        return x if clip is None else F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(-clip)), F.lit(clip)))

    return df.select(*[z(c).alias(c) if c in cols else c for c in df.columns])


def standardize(df: DataFrame, cols: list[str], by: list[str], lower: float = 0.01, upper: float = 0.99, clip: float | None = None) -> DataFrame:
    return zscore(winsorize(df, cols, by, lower, upper), cols, by, clip)


def weighted_mean(df: DataFrame, y: str, weight: str, by: list[str]) -> DataFrame:
    some = F.col(y).isNotNull() & (F.col(weight) > 0)
    return df.filter(some).groupBy(*by).agg(F.try_divide(F.sum(F.col(y) * F.col(weight)), F.sum(weight)).alias("mean"))


def weighted_r2(df: DataFrame, y: str, fitted: str, weight: str, by: list[str]) -> DataFrame:
    """1 - SSE / SST, both weighted, SST about the weighted mean."""
    d = df.filter(F.col(y).isNotNull() & F.col(fitted).isNotNull() & (F.col(weight) > 0))
    w, yy = F.col(weight), F.col(y)
    s = d.groupBy(*by).agg(F.sum(w).alias("w"), F.sum(w * yy).alias("wy"), F.sum(w * yy * yy).alias("wyy"), F.sum(w * (yy - F.col(fitted)) * (yy - F.col(fitted))).alias("sse"))
    return s.select(*by, (1 - F.try_divide(F.col("sse"), F.col("wyy") - F.col("wy") * F.col("wy") / F.col("w"))).alias("r2"))


def group_mean(df: DataFrame, members: dict[str, float | None], name: str) -> DataFrame:
    """A style group: the mean of its members that have values, or with weights given the weighted sum (NULL where a member is)."""
    weights = list(members.values())
    if all(x is None for x in weights):
        total = sum((F.coalesce(c, F.lit(0.0)) for c in members), F.lit(0.0))
        return df.withColumn(name, F.try_divide(total, sum((F.col(c).isNotNull().cast("int") for c in members), F.lit(0))))
    return df.withColumn(name, sum((F.col(c) * (x or 0.0) for c, x in members.items()), F.lit(0.0)))


def coverage(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """Rows, codes and the share of values that are there."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("code").alias("n_codes"), *[F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}_share") for c in cols])
