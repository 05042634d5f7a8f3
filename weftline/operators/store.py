"""Keyed stores that new rows override and that keep the last keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert_rolloff(old: DataFrame, new: DataFrame, key: list[str], keep_last: int, roll: str | None = None, order: list[str] | None = None) -> DataFrame:
    """old and new by the union of their columns; new rows override on `key`, of several new ones the last by `order`; only the last `keep_last` values of `roll`
    (default: the first key column), in falling order, stay. The values to keep are found on the distinct ones."""
    roll = roll or key[0]
    both = old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(F.col("is_new").desc(), *[F.col(c).desc() for c in order or []])
    one = both.withColumn("nth_row", F.row_number().over(w)).filter("nth_row = 1").drop("nth_row", "is_new")
    last = one.select(roll).distinct().orderBy(F.col(roll).desc()).limit(keep_last)
    return one.join(last, roll, "left_semi")


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by an explicit order."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*[c for c in df.columns if c not in key]), F.struct(*order)).alias("last_row")).select(*key, "last_row.*")


def as_of(days: DataFrame, facts: DataFrame, key: str, effective: str, order: list[str], lag_days: int = 0) -> DataFrame:
    """days: (date, key) rows asked for. Adds the columns of the last fact with effective <= date - lag_days, for all dates at once.

    Days and facts are put in one order by key and date, and each day takes the last fact before it: one shuffle by key, work in
    proportion to days plus facts, and no pair of a day and a fact is ever formed."""
    facts = latest(facts, [key, effective], order)
    kept = [c for c in facts.columns if c != key]
    fact = F.struct(*[F.col(c) for c in kept])
    day = F.struct(*[F.col(c) for c in days.columns])
    kind, day_kind = facts.select(fact).schema[0].dataType, days.select(day).schema[0].dataType
    at = facts.select(F.col(key).alias("k"), F.col(effective).cast("date").alias("at"), F.lit(0).alias("asked"), F.lit(None).cast(day_kind).alias("day"), fact.alias("fact"))
    at = at.unionAll(days.select(F.col(key).alias("k"), F.date_sub("date", lag_days).alias("at"), F.lit(1).alias("asked"), day.alias("day"), F.lit(None).cast(kind).alias("fact")))
    w = Window.partitionBy("k").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    found = at.filter("k IS NOT NULL OR asked = 1").withColumn("fact", F.when(F.col("k").isNotNull(), F.last("fact", ignorenulls=True).over(w))).filter("asked = 1")
    return found.select("day.*", *[F.col("fact")[c].alias(c) for c in kept])


def manifest_rows(path: str) -> dict:
    """The run manifest on the driver; a damaged file counts as none and is set aside."""
    import json
    import os

    base = {"version": 1, "last_processed": None, "last_rebalance": None}
    if not os.path.exists(path):
        return base
    try:
        with open(path, encoding="utf-8") as f:
            return base | json.load(f)
    except (ValueError, TypeError):
        os.replace(path, f"{path}.damaged")
        return base


def save_manifest(path: str, manifest: dict) -> None:
    import json
    import os

    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(manifest, f, indent=1, default=str)
    os.replace(f"{path}.tmp", path)
