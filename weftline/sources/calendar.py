"""Trading calendar: dates with their ordinal; all shifts are joins on the ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def calendar(dates: DataFrame, col: str = "date") -> DataFrame:
    """date, ord (from 1), next_date. Distinct dates are few, so one ordered window over them is cheap at any scale."""
    w = Window.orderBy("date")
    d = dates.select(F.to_date(col).alias("date")).filter("date IS NOT NULL").distinct()
    return d.select("date", F.row_number().over(w).alias("ord"), F.lead("date").over(w).alias("next_date"))


def weekdays(spark, start: str, end: str) -> DataFrame:
    """The fallback calendar: Monday to Friday."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("date"))
    return calendar(days.filter(F.dayofweek("date").between(2, 6)))


def floor_dates(df: DataFrame, cal: DataFrame, col: str = "date", clip: bool = True) -> DataFrame:
    """Adds floor_date and ord: the last trading day on or before df's date; before the first one: the first (clip) or NULL.

    The calendar becomes one row for each calendar day, so the as-of join is an equi-join on the date; dates after its last day are
    told apart by that one day."""
    ends = cal.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.max("ord").alias("last_ord"))
    spans = cal.filter("next_date IS NOT NULL").select(F.col("date").alias("floor_date"), "ord", F.explode(F.sequence("date", F.date_sub("next_date", 1))).alias("any_date"))
    asked = F.to_date(df[col])
    out = df.join(spans, asked == spans.any_date, "left").drop("any_date").crossJoin(F.broadcast(ends))  # ends: one row
    asked = F.to_date(F.col(col))
    after, before = asked >= F.col("last_date"), (asked < F.col("first_date")) & F.lit(clip)
    out = out.withColumn("ord", F.when(after, F.col("last_ord")).when(before, F.lit(1)).otherwise(F.col("ord")))
    out = out.withColumn("floor_date", F.when(after, F.col("last_date")).when(before, F.col("first_date")).otherwise(F.col("floor_date")))
    return out.drop("first_date", "last_date", "last_ord")


def shift(df: DataFrame, cal: DataFrame, n: int, col: str = "date") -> DataFrame:
    """Adds shifted: n trading days from the floor of df's date, NULL outside the calendar. n = -1 is the day before, 1 the day after."""
    at = floor_dates(df, cal, col, clip=False)
    to = cal.select(F.col("date").alias("shifted"), (F.col("ord") - n).alias("ord_to"))
    return at.join(to, at.ord == to.ord_to, "left").drop("ord_to", "floor_date", "ord")


def is_trading_day(df: DataFrame, cal: DataFrame, col: str = "date") -> DataFrame:
    d = cal.select(F.col("date").alias("cal_date"))
    return df.join(d, F.to_date(df[col]) == d.cal_date, "left").withColumn("trading", F.col("cal_date").isNotNull()).drop("cal_date")


def last_n(cal: DataFrame, until: Column, n: int) -> DataFrame:
    """The last n trading days on or before a date."""
    return cal.filter(F.col("date") <= until).orderBy(F.col("date").desc()).limit(n)
