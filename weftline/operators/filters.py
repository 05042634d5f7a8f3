"""Tradability of a panel's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the previous close up to which a price may move, for ordinary and for ST instruments; price tick; tolerance of a touch.
LIMIT, ST_LIMIT, TICK, TOUCH = 0.098, 0.048, 0.01, 1e-4
_OPTIONAL = {"open": "double", "high": "double", "low": "double", "close": "double", "volume": "double", "preclose": "double", "paused": "int", "high_limit": "double", "low_limit": "double", "name": "string", "is_st": "boolean"}


def trade_mask(panel: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """date, code, missing, paused, up_limit, down_limit, keep. codes: the (date, code) rows asked for (default: the panel's)."""
    have = set(panel.columns)
    price_columns = [c for c in ("open", "high", "low", "close") if c in have]
    p = panel.select("date", "code", *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in _OPTIONAL.items()], F.lit(True).alias("there"))
    if codes is not None:
        p = codes.select("date", "code").join(p, ["date", "code"], "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    missing = F.col("there").isNull()
    any_null = F.lit(False)
    for c in price_columns:
        any_null = any_null | F.col(c).isNull()
    paused = no(F.col("paused") == 1) | (F.coalesce("volume", F.lit(0.0)) == 0) | any_null
    st = F.coalesce("is_st", no(F.upper("name").rlike("ST|ＳＴ")))
    share = F.when(st, ST_LIMIT).otherwise(LIMIT)
    tick = lambda x: F.bround(x / TICK) * TICK
    top, bottom = F.coalesce("high_limit", tick(F.col("preclose") * (1 + share))), F.coalesce("low_limit", tick(F.col("preclose") * (1 - share)))
    up, down = no(F.col("close") >= top - TOUCH), no(F.col("close") <= bottom + TOUCH)
    mask = p.select("date", "code", missing.alias("missing"), (~missing & paused).alias("paused"), up.alias("up_limit"), down.alias("down_limit"))
    return mask.withColumn("keep", ~(F.col("missing") | F.col("paused") | F.col("up_limit") | F.col("down_limit")))


def tradable(panel: DataFrame) -> DataFrame:
    """The rows of the panel that can be traded."""
    keep = trade_mask(panel).filter("keep").select("date", "code").distinct()
    return panel.join(keep, ["date", "code"], "left_semi")
