"""Panels (date, code, prices and volumes) from the star-schema tables, made dense over the dates that occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (code, bucket of the date)
PANELS = {"dense": ("l_suppkey % 20", "week"), "sparse": ("l_suppkey", "week"), "month": ("l_suppkey", "month")}

_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def bars_sql(kind: str, lineitem: str, first: str, last: str) -> str:
    """A row for each code and bucket that occurs; first, last: SQL of the open and close within a group."""
    code, bucket = PANELS[kind]
    return f"""SELECT CAST(date_trunc('{bucket}', l_shipdate) AS DATE) AS date, CAST({code} AS BIGINT) AS code,
  {first} AS open, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low, {last} AS close,
  sum(l_quantity) AS volume, floor(sum(l_extendedprice) * 100 + 0.5) / 100 AS amount
FROM {lineitem} WHERE l_quantity > 0 AND l_shipdate IS NOT NULL GROUP BY 1, 2"""


_DENSE = """SELECT date, code, ord, open, high, low, close, volume, amount, amount / nullif(volume, 0) AS vwap,
  floor(avg(open) OVER (PARTITION BY date) * 1e6 + 0.5) / 1e6 AS bench_open, floor(avg(close) OVER (PARTITION BY date) * 1e6 + 0.5) / 1e6 AS bench_close
FROM (SELECT d.date, d.ord, k.code FROM (SELECT date, row_number() OVER (ORDER BY date) AS ord FROM (SELECT DISTINCT date FROM {bars})) d CROSS JOIN (SELECT DISTINCT code FROM {bars}) k) LEFT JOIN {bars} USING (date, code)"""


def bars(spark: SparkSession, sf_dir: str, kind: str = "dense") -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    at = f"struct({_ORDER})"
    price = "l_extendedprice / l_quantity"
    return spark.sql(bars_sql(kind, "{lineitem}", f"min_by({price}, {at})", f"max_by({price}, {at})"), lineitem=lineitem)


def dense(bars: DataFrame) -> DataFrame:
    """bars on the grid of all dates and codes (dates: a calendar, so few), with vwap and the benchmark (mean of the codes)."""
    return bars.sparkSession.sql(_DENSE, bars=bars)


def panel(spark: SparkSession, sf_dir: str, kind: str = "dense") -> DataFrame:
    return dense(bars(spark, sf_dir, kind))


def panel_sql(kind: str = "dense") -> list[str]:
    """Common table expressions for DuckDB; the last one is `panel`."""
    price = "l_extendedprice / l_quantity"
    pick = lambda way: f"arg_{way}({price}, row({_ORDER}))"
    return [f"bars AS MATERIALIZED ({bars_sql(kind, 'lineitem', pick('min'), pick('max'))})", f"panel AS MATERIALIZED ({_DENSE.format(bars='bars')})"]
