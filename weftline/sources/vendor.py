"""Vendor tables: columns under other names, snapshots in several parts, membership and text files, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators.store import as_of, upsert_rolloff

# Names under which a column may come.
ALIASES = {
    "volume": ["volume", "vol", "volumn"], "amount": ["amount", "money"], "preclose": ["preclose", "prev_close", "pre_close"],
    "open": ["open"], "high": ["high"], "low": ["low"], "close": ["close"], "vwap": ["vwap"], "paused": ["paused"], "date": ["date"], "code": ["code", "stock_code"],
}
INDUSTRY_ALIASES = {
    "code": ["code", "stock_code"], "standard": ["standard_name"], "industry": ["industry_name"], "level": ["industry_level"],
    "effective": ["effective_date", "into_date"], "updated": ["updatetime", "update_time"], "stamp": ["tmstamp", "timestamp"], "status": ["use_status"],
}


def resolve(df: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Columns known under another name or in other letters get their plain name; the first alias that is there counts."""
    have = {c.lower(): c for c in reversed(df.columns)}
    names = {name: next((have[x] for x in known if x in have), None) for name, known in (aliases or ALIASES).items()}
    taken = {old: new for new, old in names.items() if old is not None}
    return df.select(*[F.col(f"`{c}`").alias(taken.get(c, c)) for c in df.columns if c in taken or c not in names])


def parse_date(c: Column) -> Column:
    """A date from 2024-01-31, 2024/1/31, 20240131 with or without a time, or seconds or milliseconds since 1970; else NULL."""
    s = F.trim(c.cast("string"))
    digits = s.rlike(r"^\d+$")
    number = F.when(digits, s.cast("decimal(20,0)").cast("double"))
    plain = F.when(digits & F.length(s).isin(8, 12, 14), F.try_to_timestamp(F.substring(s, 1, 8), F.lit("yyyyMMdd")).cast("date"))
    since = F.when(digits & (F.length(s) == 13), F.timestamp_millis(number.cast("long")).cast("date")).when(digits & F.length(s).isin(9, 10), F.timestamp_seconds(number).cast("date"))
    split = F.regexp_replace(F.regexp_extract(s, r"^(\d{4}[-/.]\d{1,2}[-/.]\d{1,2})", 1), "[/.]", "-")
    return F.coalesce(plain, since, F.try_to_timestamp(F.when(split != "", split), F.lit("yyyy-M-d")).cast("date"))


def number(c: Column, percent: bool = False) -> Column:
    """A finite number from text with blanks and thousands' commas, or NULL; percent: "12.5%" is 0.125."""
    s = F.regexp_replace(F.trim(c.cast("string")), ",", "")
    share = s.endswith("%")
    x = F.regexp_replace(s, "%$", "").try_cast("double")
    x = F.when(F.abs(x) < 1e300, x)
    return F.when(share, x / 100 if percent else F.lit(None).cast("double")).otherwise(x)


def file_stamp(name: Column) -> Column:
    """The time in a file's name (12 or 14 digits), or NULL."""
    s = F.regexp_extract(name, r"(\d{14}|\d{12})[^/]*$", 1)
    return F.when(F.length(s) == 14, F.try_to_timestamp(s, F.lit("yyyyMMddHHmmss"))).when(F.length(s) == 12, F.try_to_timestamp(s, F.lit("yyyyMMddHHmm")))


def taxonomy(c: Column) -> Column:
    """SW for names of that standard in either script (or none), GICS, else the name in capitals."""
    s = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(s.rlike("申万|申銀萬國|申银万国|申萬|申銀") | (s == ""), F.lit("SW")).when(s.contains("GICS"), F.lit("GICS")).otherwise(s)


def constituents(df: DataFrame) -> DataFrame:
    """code, standard, level, industry, effective and what orders rows of one day, from a vendor's table under any names."""
    d = resolve(df, INDUSTRY_ALIASES)
    return d.withColumn("standard", taxonomy(F.col("standard"))).withColumn("effective", parse_date(F.col("effective")))


def snapshot(*parts: DataFrame) -> DataFrame:
    """Parts with (date, code) and own columns as one row for each date and code of any part; of a column in several the first value that is there."""

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        same = [c for c in b.columns if c in a.columns and c not in ("date", "code")]
        b = b.withColumnsRenamed({c: f"other_{c}" for c in same})
        both = a.join(b, ["date", "code"], "full_outer")
        return both.withColumns({c: F.coalesce(c, f"other_{c}") for c in same}).drop(*[f"other_{c}" for c in same]) if same else both

    return reduce(join, parts)


def point_in_time(days: DataFrame, reports: DataFrame, order: list[str], lag_days: int = 0) -> DataFrame:
    """days: date, code; reports: code, published, .... The last report published by then."""
    return as_of(days, reports, "code", "published", order, lag_days)


def stepped_anchor(days: DataFrame, snapshots: DataFrame, cal: DataFrame, steps: tuple[int, ...] = (0, 21, 42, 63, 84, 126, 189, 252)) -> DataFrame:
    """days: date; snapshots: date (of membership); cal: date, ord. date, anchor: the first of the days that lie so many trading days
    before a date and have a snapshot; NULL where none has. The calendar is small, so all steps are looked up at once."""
    have = snapshots.select(F.col("date").alias("anchor")).distinct().join(cal.select(F.col("date").alias("anchor"), F.col("ord").alias("at")), "anchor")
    asked = days.select("date").distinct().join(cal.select("date", "ord"), "date", "left").withColumn("step", F.explode(F.array(*[F.lit(k) for k in steps])))
    found = asked.join(have, F.col("ord") - F.col("step") == F.col("at"), "left")
    return found.groupBy("date").agg(F.min_by("anchor", F.when(F.col("anchor").isNotNull(), F.col("step"))).alias("anchor"))


def all_calendars(*calendars: DataFrame) -> DataFrame:
    """The distinct dates of several calendars."""
    return reduce(lambda a, b: a.unionAll(b), [c.select(F.to_date("date").alias("date")) for c in calendars]).distinct()


def carried(df: DataFrame, cols: list[str], by: str = "code", order: str = "date") -> DataFrame:
    """Missing values as the last one before them, within a code."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def coverage_row(panel: DataFrame, universe: DataFrame, start, end) -> DataFrame:
    """date (the end), codes_total, codes_in_panel, rows: of the window's panel against the universe's codes."""
    here = panel.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    found = here.agg(F.count_distinct("code").alias("codes_in_panel"), F.count(F.lit(1)).alias("rows"))
    total = universe.select("code").distinct().agg(F.count(F.lit(1)).alias("codes_total"))
    return total.crossJoin(found).select(F.lit(end).cast("date").alias("date"), "codes_total", "codes_in_panel", "rows")  # one row each


def preprocess(bars: DataFrame, members: DataFrame, start, end, folder: str, warm_up: int = 252, keep_last: int = 252) -> DataFrame:
    """Bars of the codes that were members at any time from warm_up days before the start, written by month, and the coverage row put
    into the rolling table beside them. Returns that table."""
    from weftline.sources.files import exists, write_bars

    first = F.date_sub(F.lit(start).cast("date"), warm_up)
    codes = members.filter(F.col("date").between(first, F.lit(end).cast("date"))).select("code").distinct()
    kept = bars.filter(F.col("date").between(first, F.lit(end).cast("date"))).join(codes, "code", "left_semi")
    write_bars(kept, f"{folder}/bars")
    spark, path = bars.sparkSession, f"{folder}/coverage"
    row = coverage_row(spark.read.parquet(f"{folder}/bars"), codes, start, end)
    old = spark.read.parquet(path) if exists(spark, path) else row.limit(0)
    rows = spark.createDataFrame(upsert_rolloff(old, row, ["date"], keep_last).collect(), row.schema)  # keep_last rows at most
    rows.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """value: the lines of a file or folder; none where it is missing."""
    from weftline.sources.files import exists

    return spark.read.text(path) if exists(spark, path) else spark.createDataFrame([], "value string")
