"""Membership, industries and benchmark weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.codes import industry_column
from weftline.operators.store import as_of, latest


def rolling_union(members: DataFrame, start: str, end: str) -> DataFrame:
    """members: date, code. The distinct codes of a window."""
    return members.filter(F.col("date").between(start, end)).select("code").distinct()


def ever_seen(members: DataFrame) -> DataFrame:
    return members.groupBy("code").agg(F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))


def anchored(days: DataFrame, members: DataFrame, max_age: int = 252) -> DataFrame:
    """date, code: of each day the members of the last snapshot on or before it that is at most max_age calendar days old.

    Snapshot dates become intervals on the small calendar side; the members follow by an equi-join."""
    w = Window.orderBy("anchor")
    snaps = members.select(F.col("date").alias("anchor")).distinct().withColumn("until_date", F.lead("anchor").over(w))
    last = F.least(F.coalesce(F.date_sub("until_date", 1), F.date_add("anchor", max_age)), F.date_add("anchor", max_age))
    spans = snaps.select("anchor", F.explode(F.sequence("anchor", last)).alias("date"))
    return days.select("date").distinct().join(spans, "date").join(members.withColumnRenamed("date", "anchor"), "anchor").select("date", "code")


def industries(days: DataFrame, constituents: DataFrame, order: list[str]) -> DataFrame:
    """days: date, code; constituents: code, effective, industry and ordering columns. date, code, industry (OTHER where there is none)."""
    found = as_of(days, constituents, "code", "effective", order)
    return found.select("date", "code", F.coalesce("industry", F.lit("OTHER")).alias("industry"))


def dummies(df: DataFrame, names: list[str], standard: str = "SW", level: int = 1) -> DataFrame:
    """date, code and a 0/1 column for each name, by an explicit list (so no job to find the names)."""
    out = [F.coalesce(F.col("industry") == n, F.lit(False)).cast("int").alias(n) for n in names]
    named = df.sparkSession.range(1).select(*[industry_column(F.lit(standard), F.lit(level), F.lit(n)).alias(f"c{k}") for k, n in enumerate(names)]).first() if names else []
    return df.select("date", "code", *[o.alias(c) for o, c in zip(out, named, strict=True)])


def month_weights(caps: DataFrame, float_cap: Column, cap: Column) -> DataFrame:
    """caps: date, code. month, code, weight from each month's first day: float capital, else capital, else even; the sum is 1."""
    month = F.trunc("date", "month")
    first = caps.withColumn("month", month).withColumn("first_day", F.min("date").over(Window.partitionBy(month))).filter("date = first_day")
    by = Window.partitionBy("month")
    x = first.select("month", "code", float_cap.alias("f"), cap.alias("c"))
    value = F.when(F.sum("f").over(by) > 0, F.coalesce("f", F.lit(0.0))).when(F.sum("c").over(by) > 0, F.coalesce("c", F.lit(0.0))).otherwise(1.0)
    x = x.withColumn("v", value)
    return x.select("month", "code", (F.col("v") / F.sum("v").over(by)).alias("weight"))


def latest_positions(positions: DataFrame) -> DataFrame:
    """The rows of the last date."""
    return positions.join(positions.agg(F.max("date").alias("date")), "date", "left_semi")


__all__ = ["anchored", "dummies", "ever_seen", "industries", "latest", "latest_positions", "month_weights", "rolling_union"]
