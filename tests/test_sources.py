"""Files, vendor rows, and universe operators on hand-made cases."""

import datetime as dt

from pyspark.sql import functions as F

from weftline.operators import universe
from weftline.sources import calendar as cal
from weftline.sources import files


def test_csv_and_bars(spark, tmp_path):
    assert files.read_csv(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "a.csv").write_text("date,code,open\n2024-01-02,X,1.5\n2024-01-03,X,bad\n")
    got = files.read_csv(spark, str(tmp_path / "a.csv"), "date date, code string, open double").collect()
    assert [(r.code, r.open) for r in got] == [("X", 1.5), ("X", None)]
    rows = [("X", dt.date(2024, 1, d), 1.0, 2.0, 0.5, float(d), v, 10.0) for d, v in ((2, 5.0), (3, 0.0), (6, 7.0), (7, float("inf")))]
    raw = spark.createDataFrame(rows, "code string, date date, open double, high double, low double, close double, volume double, amount double")
    bars = files.vendor_bars(raw)
    assert [(r.preclose, r.paused, r.volume) for r in bars.orderBy("date").collect()] == [(None, 0, 5.0), (2.0, 1, 0.0), (3.0, 0, 7.0), (6.0, 1, None)]
    c = cal.calendar(spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2024-01-08",)], "date string"))
    p = files.panel_from_bars(bars, c, "2024-01-02", "2024-01-05").orderBy("date").collect()
    assert [(str(r.date), r.close) for r in p] == [("2024-01-02", 2.0), ("2024-01-03", 7.0)]
    files.write_bars(bars, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).filter(F.col("month") == "2024-01").count() == 4


def test_universe(spark):
    d = lambda x: dt.date(2024, 1, x)
    m = spark.createDataFrame([(d(1), "a"), (d(1), "b"), (d(10), "a")], "date date, code string")
    days = spark.createDataFrame([(d(x),) for x in (1, 9, 12, 25)], "date date")
    got = sorted((r.date.day, r.code) for r in universe.anchored(days, m, 8).collect())
    assert got == [(1, "a"), (1, "b"), (9, "a"), (9, "b"), (12, "a")]
    assert {r.code: r.last_seen.day for r in universe.ever_seen(m).collect()} == {"a": 10, "b": 1}
    assert universe.rolling_union(m, "2024-01-05", "2024-01-31").count() == 1 and universe.latest_positions(m).count() == 1
    w = universe.month_weights(spark.createDataFrame([(d(2), "a", None, 3.0), (d(2), "b", None, 1.0), (d(3), "b", 9.0, 9.0)], "date date, code string, f double, c double"), F.col("f"), F.col("c"))
    assert {r.code: r.weight for r in w.collect()} == {"a": 0.75, "b": 0.25}


def test_bars_over_a_long_holiday_and_after_the_calendar(spark):
    c = cal.calendar(spark.createDataFrame([("2024-02-08",), ("2024-02-19",), ("2024-02-20",)], "date string"))
    bars = spark.createDataFrame([(dt.date(2024, 2, d), "X", float(d)) for d in (1, 8, 17, 19, 20)] + [(dt.date(2044, 1, 1), "X", 44.0)], "date date, code string, close double")
    got = {str(r.date): r.close for r in files.panel_from_bars(bars, c, "2024-02-08", "2024-02-12").collect()}
    assert got == {"2024-02-08": 17.0}
    late = {str(r.date): str(r.floor_date) for r in cal.floor_dates(bars, c, clip=False).collect()}
    assert late["2044-01-01"] == "2024-02-20" and late["2024-02-01"] == "None" and late["2024-02-17"] == "2024-02-08"
    assert files.panel_from_bars(bars, c, "2024-02-20", "2050-01-01").count() == 1
