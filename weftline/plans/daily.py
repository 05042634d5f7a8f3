"""The daily run as one declared plan over all dates: nothing later than a date reaches its alpha."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import crosssec, filters, portfolio, regress, store
from weftline.plans import expr as X


@dataclass
class Run:
    residuals: DataFrame
    returns: DataFrame
    alphas: DataFrame
    weights: DataFrame
    positions: DataFrame
    orders: DataFrame

    def save(self, folder: str) -> None:
        """Each part as Parquet by date under the folder; dates that occur are replaced, so a day that is run again gives the same files."""
        for name in ("residuals", "returns", "alphas", "weights", "positions", "orders"):
            getattr(self, name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{folder}/{name}")


def run(panel: DataFrame, factors: dict[str, X.E], horizon: int = 2, lookback: int = 252, top: int = 10, max_weight: float = 0.1, band: float = 0.01, only_tradable: bool = True, every: int = 1, held: DataFrame | None = None, last_rebalance=None) -> Run:
    """panel: dense, with date, code, ord, the variables of the factors, amount and industry.

    every: trading days from one rebalance to the next; held: code, weight before the first one; last_rebalance: its date.
    Returns of a date's factors are known `horizon` dates later, so a date's mean takes returns up to that many dates before."""
    names = list(factors)
    exposures = X.evaluate(panel, factors)
    size = panel.select("date", "code", "industry", F.ln(F.when(F.col("amount") > 0, F.col("amount"))).alias("size"))
    data = exposures.join(size, ["date", "code"])
    if only_tradable:
        data = data.join(filters.trade_mask(panel).filter("NOT missing AND NOT paused").select("date", "code"), ["date", "code"], "left_semi")
    residuals = regress.orthogonalize(data, names, ["size"], "industry")
    wide = residuals.groupBy("date", "code").pivot("factor_id", names).agg(F.first("residual"))
    forward = regress.forward_return(panel, horizon)
    target = crosssec.standardize(wide, names, ["date"]).join(size, ["date", "code"]).join(forward, ["date", "code"])
    returns = regress.factor_returns(target, "forward", names, ["size"], "industry", 1e-6)
    mu = regress.trailing_mean(returns, lookback)
    known = Window.partitionBy("factor_id").orderBy("date")
    mu = mu.withColumn("mu", F.lag("mu", horizon).over(known))
    alphas = regress.alpha(residuals, mu)
    weights = portfolio.top_k(alphas, top, max_weight)
    if every > 1 or last_rebalance is not None:
        weights = weights.join(portfolio.rebalance_days(panel.select("date", "ord").distinct(), every, last_rebalance), "date", "left_semi")
    positions = portfolio.positions(weights, band, held)
    return Run(residuals, returns, alphas, weights, positions, portfolio.position_orders(positions))


def resume(panel: DataFrame, factors: dict[str, X.E], folder: str, **options) -> Run | None:
    """The incremental run: only dates after the manifest's last are written, positions are carried on from those saved, and the
    manifest moves on when all parts are there. None where there is no new date."""
    from weftline.operators import universe
    from weftline.sources.files import exists

    spark, path = panel.sparkSession, f"{folder}/manifest.json"
    manifest = store.manifest_rows(path)
    last = panel.agg(F.max("date").alias("last")).first().last
    if last is None or manifest["last_processed"] and str(last) <= manifest["last_processed"]:
        return None
    old = f"{folder}/positions"
    held = universe.latest_positions(spark.read.parquet(old)).select("code", "weight") if exists(spark, old) else None
    done = run(panel, factors, held=held, last_rebalance=manifest["last_rebalance"], **options)
    if manifest["last_processed"]:
        new = F.col("date") > F.lit(manifest["last_processed"]).cast("date")
        weights = done.weights.filter(new)
        held_now = portfolio.positions(weights, options.get("band", 0.01), held)
        done = Run(done.residuals.filter(new), done.returns.filter(new), done.alphas.filter(new), weights, held_now, portfolio.position_orders(held_now))
    done.save(folder)
    rebalanced = spark.read.parquet(f"{folder}/weights").agg(F.max("date").alias("last")).first().last
    store.save_manifest(path, manifest | {"last_processed": str(last), "last_rebalance": None if rebalanced is None else str(rebalanced)})
    return done
