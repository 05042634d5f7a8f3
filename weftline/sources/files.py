"""CSV and Parquet files of daily bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.store import latest
from weftline.sources.calendar import floor_dates

BARS = "date date, code string, open double, high double, low double, close double, volume double, amount double, preclose double, paused int, high_limit double, low_limit double"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_csv(spark: SparkSession, path: str, schema: str = BARS) -> DataFrame:
    """A CSV file or folder with a header; a missing or empty one gives no rows, a bad cell gives NULL."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def write_bars(bars: DataFrame, path: str) -> None:
    """Parquet by month, months that occur in bars are replaced."""
    bars = bars.withColumn("month", F.date_format("date", "yyyy-MM"))
    bars.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def vendor_bars(raw: DataFrame) -> DataFrame:
    """Vendor rows (code, date, open .. amount) with preclose and paused; limits NULL where there are none. Infinities become NULL."""
    from pyspark.sql import Window

    w = Window.partitionBy("code").orderBy("date")
    number = lambda c: F.when(F.abs(F.col(c)) < 1e300, F.col(c))
    have = set(raw.columns)
    out = raw.select("date", "code", *[number(c).alias(c) for c in ("open", "high", "low", "close", "volume", "amount")], *[(F.col(c) if c in have else F.lit(None).cast("double")).alias(c) for c in ("high_limit", "low_limit")])
    return out.withColumn("preclose", F.lag("close").over(w)).withColumn("paused", (F.coalesce("volume", F.lit(0.0)) <= 0).cast("int"))


def panel_from_bars(bars: DataFrame, cal: DataFrame, start: str, end: str, order: str = "close") -> DataFrame:
    """bars with dates floored to the calendar, clipped to the window; of rows with one date and code the last raw date stays."""
    # Flooring moves a date back, at most over the days up to the next trading day: rows outside that can be pruned on the raw date.
    edge = cal.agg(F.min("date").alias("first"), F.max(F.when(F.col("date") <= F.lit(end).cast("date"), F.coalesce("next_date", F.lit("9999-12-31").cast("date")))).alias("after")).first()
    near = bars if edge.first is None or str(edge.first) >= str(start) else bars.filter(F.col("date") >= F.lit(start).cast("date"))
    near = near if edge.after is None else near.filter(F.col("date") < F.lit(edge.after))
    at = floor_dates(near, cal).withColumn("raw_date", F.col("date")).withColumn("date", F.col("floor_date")).drop("floor_date", "ord")
    return latest(at.filter(F.col("date").between(start, end)), ["date", "code"], ["raw_date", order]).drop("raw_date")
