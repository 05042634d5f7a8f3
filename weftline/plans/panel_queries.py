"""Queries of the panel operators over the star-schema tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import codes
from weftline.operators import crosssec, filters, portfolio, regress, store, styles, universe
from weftline.plans import expr as X
from weftline.plans.queries import expression_query, shown
from weftline.sources import calendar as cal
from weftline.sources.panel import panel, panel_sql
from weftline.streaming import daily

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.expr(f"{shown(c)} AS {c}") if c in cols else c for c in df.columns])


def with_panel(kind: str, body: str) -> str:
    return f"WITH {', '.join(panel_sql(kind))} {body}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _algebra() -> dict[str, X.E]:
    c, v, h, lo, vw = (X.var(x) for x in ("close", "volume", "high", "low", "vwap"))
    return {
        "delay": X.lag(c, 3), "delta": X.delta(c, 2), "sum_": X.total(v, 5), "mean_": X.mean(c, 6), "std_": X.std(c, 6), "var_": X.variance(v, 4), "tsmax": X.highest(h, 5), "tsmin": X.lowest(lo, 5),
        "sma": X.ema(c, 7, 2), "wma": X.decay(c, 6), "count_": X.count(c > X.lag(c), 6), "sumif": X.sum_if(v, 6, c > X.lag(c)), "prod": X.product(c / X.lag(c), 4), "highday": X.high_day(h, 10),
        "lowday": X.low_day(lo, 10), "tsrank": X.tsrank(v, 8), "corr_": X.corr(c, v, 6), "corr0": X.corr(v, v * 0 + 1, 5, 0.0), "cov_": X.cov(h, v, 5), "slope": X.slope(c, 6), "xrank": X.rank(c),
        "filter_": X.filtered(c, v > 20), "sign_": X.sign0(X.delta(c)), "log_": X.log(v), "min_": X.low(c, vw), "max_": X.high(c, vw), "if_": X.iff(c > vw, 1.0, -1.0), "cumprod": X.cumulative_product(X.iff(c > X.lag(c), 1.01, 1.0)), "ratio": c / (v - v),
    }


QUERIES["ops_algebra_sparse"], ORACLE["ops_algebra_sparse"] = expression_query(_algebra(), "sparse")
_BARS = {n: X.var(n) for n in ("open", "high", "low", "close", "volume", "amount", "vwap", "bench_open", "bench_close")}
QUERIES["panel_sparse"], ORACLE["panel_sparse"] = expression_query(_BARS, "sparse")
QUERIES["panel_month"], ORACLE["panel_month"] = expression_query(_BARS, "month")

_CAL = """cal AS MATERIALIZED (SELECT date, row_number() OVER (ORDER BY date) AS ord FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)),
o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, (SELECT max(ord) FROM cal WHERE cal.date <= CAST(o_orderdate AS DATE)) AS ord FROM orders)"""


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar(read(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("date")))


@query(f"WITH {_CAL} SELECT o_orderkey, o.date, c.date AS floor_date, c.ord FROM o JOIN cal c ON c.ord = coalesce(o.ord, 1)")
def calendar_floor(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return cal.floor_dates(o, _calendar(spark, sf_dir)).select("o_orderkey", "date", "floor_date", F.col("ord").cast("long").alias("ord"))


@query(f"WITH {_CAL} SELECT o_orderkey, a.date AS next_two, b.date AS prev_two FROM o LEFT JOIN cal a ON a.ord = o.ord + 2 LEFT JOIN cal b ON b.ord = o.ord - 2")
def calendar_shift(spark, sf_dir):
    c = _calendar(spark, sf_dir)
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    two = cal.shift(cal.shift(o, c, 2).withColumnRenamed("shifted", "next_two"), c, -2)
    return two.select("o_orderkey", "next_two", F.col("shifted").alias("prev_two"))


@query(f"WITH {_CAL} SELECT o.date, c.date IS NOT NULL AS trading, count(*) AS n FROM o LEFT JOIN cal c ON c.date = o.date GROUP BY 1, 2")
def calendar_is_trading(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    return cal.is_trading_day(o, _calendar(spark, sf_dir)).groupBy("date", "trading").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_CAL} SELECT date, ord FROM cal WHERE date <= DATE '1998-01-01' ORDER BY date DESC LIMIT 20")
def calendar_last_n(spark, sf_dir):
    return cal.last_n(_calendar(spark, sf_dir), F.to_date(F.lit("1998-01-01")), 20).select("date", F.col("ord").cast("long").alias("ord"))


_PRE = "lag(close) OVER (PARTITION BY code ORDER BY date)"


@query(with_panel("sparse", f""", p AS (SELECT date, code, open, high, low, close, volume, {_PRE} AS preclose, code % 9 = 0 AS st FROM panel),
m AS (SELECT *, coalesce(volume, 0) = 0 OR open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL AS paused, CASE WHEN st THEN 0.048 ELSE 0.098 END::DOUBLE AS s FROM p)
SELECT date, code, false AS missing, paused, coalesce(close >= round_even(preclose * (1 + s) / 0.01::DOUBLE, 0) * 0.01::DOUBLE - 1e-4, false) AS up_limit,
  coalesce(close <= round_even(preclose * (1 - s) / 0.01::DOUBLE, 0) * 0.01::DOUBLE + 1e-4, false) AS down_limit, NOT (paused OR up_limit OR down_limit) AS keep FROM m"""))  # fmt: skip
def tradability_mask(spark, sf_dir):
    p = panel(spark, sf_dir, "sparse")
    w = Window.partitionBy("code").orderBy("date")
    return filters.trade_mask(p.select("date", "code", "open", "high", "low", "close", "volume", F.lag("close").over(w).alias("preclose"), (F.col("code") % 9 == 0).alias("is_st")))


_EXPO = "e AS (SELECT date, code, code % 5 AS grp, ln(amount) AS size, close / vwap - 1 AS value, volume FROM panel WHERE amount > 0)"


def _exposures(spark, sf_dir, kind="month"):
    p = panel(spark, sf_dir, kind).filter("amount > 0")
    return p.select("date", "code", (F.col("code") % 5).alias("grp"), F.ln("amount").alias("size"), (F.col("close") / F.col("vwap") - 1).alias("value"), "volume")


def _std_sql(cols: list[str], by: str) -> str:
    q = ", ".join(f"least(greatest({c}, quantile_cont({c}, 0.01) OVER (PARTITION BY {by})), quantile_cont({c}, 0.99) OVER (PARTITION BY {by})) AS {c}" for c in cols)
    z = ", ".join(f"({c} - avg({c}) OVER (PARTITION BY {by})) / nullif(stddev_pop({c}) OVER (PARTITION BY {by}), 0) AS {c}" for c in cols)
    return f"w AS (SELECT date, code, grp, {q} FROM e), z AS (SELECT date, code, grp, {z} FROM w)"


@query(with_panel("month", f", {_EXPO}, {_std_sql(['size', 'value'], 'date')} SELECT date, code, {shown('size')} AS size, {shown('value')} AS value FROM z"))
def standardize_by_date(spark, sf_dir):
    e = _exposures(spark, sf_dir).select("date", "code", "size", "value")
    return rounded(crosssec.standardize(e, ["size", "value"], ["date"]), "size", "value")


@query(with_panel("month", f", {_EXPO}, {_std_sql(['size', 'value'], 'date, grp')} SELECT date, code, grp, {shown('size')} AS size, {shown('value')} AS value FROM z"))
def standardize_by_group(spark, sf_dir):
    e = _exposures(spark, sf_dir).select("date", "code", "grp", "size", "value")
    return rounded(crosssec.standardize(e, ["size", "value"], ["date", "grp"]), "size", "value")


@query(with_panel("month", f", {_EXPO} SELECT date, {shown('sum(size * volume) / sum(volume)')} AS mean FROM e GROUP BY 1"))
def weighted_mean_by_date(spark, sf_dir):
    return rounded(crosssec.weighted_mean(_exposures(spark, sf_dir), "size", "volume", ["date"]), "mean")


@query(with_panel("sparse", "SELECT date, count(*) AS n_rows, count(DISTINCT code) AS n_codes, floor(avg((close IS NOT NULL)::INT::DOUBLE) * 1e6 + 0.5) / 1e6 AS close_share FROM panel GROUP BY 1"))
def coverage_by_date(spark, sf_dir):
    c = crosssec.coverage(panel(spark, sf_dir, "sparse"), ["close"], ["date"])
    return c.withColumn("close_share", F.floor(F.col("close_share") * 1e6 + 0.5) / 1e6)


@query("SELECT l_suppkey AS code, min(CAST(l_shipdate AS DATE)) AS first_seen, max(CAST(l_shipdate AS DATE)) AS last_seen FROM lineitem GROUP BY 1")
def universe_ever_seen(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("code"), F.to_date("l_shipdate").alias("date"))
    return li.groupBy("code").agg(F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))


@query("SELECT DISTINCT l_suppkey AS code FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-01-10'")
def universe_rolling_union(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").filter("l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '1995-01-11'")
    return li.select(F.col("l_suppkey").alias("code")).distinct()


@query("""WITH d AS (SELECT DISTINCT date_trunc('month', l_shipdate)::DATE AS date, l_suppkey % 50 AS code FROM lineitem),
f AS (SELECT l_suppkey % 50 AS code, CAST(l_shipdate AS DATE) AS eff, max(row(l_orderkey, l_linenumber, l_partkey)) AS m FROM lineitem GROUP BY 1, 2)
SELECT d.date, d.code, f.eff, (f.m).col0 AS l_orderkey FROM d ASOF LEFT JOIN f ON d.code = f.code AND d.date >= f.eff + INTERVAL 5 DAY""".replace("row(l_orderkey, l_linenumber, l_partkey)", "{'col0': l_orderkey, 'b': l_linenumber, 'c': l_partkey}"))
def as_of_with_lag(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("code"), F.to_date("l_shipdate").alias("eff"), "l_orderkey", "l_linenumber", "l_partkey")
    days = li.select(F.trunc("eff", "month").alias("date"), "code").distinct()
    return store.as_of(days, li, "code", "eff", ["l_orderkey", "l_linenumber", "l_partkey"], 5).select("date", "code", "eff", "l_orderkey")


_SUMS = "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_returnflag AS flag, count(*) AS n{} FROM lineitem WHERE l_shipdate {} DATE '1996-01-01' GROUP BY 1, 2"


@query(f"""WITH a AS ({_SUMS.format('', '<')}), b AS ({_SUMS.format(', max(l_quantity) AS top', '>=')} UNION ALL SELECT date, flag, -1, NULL FROM a WHERE date >= DATE '1995-06-01'),
u AS (SELECT date, flag, n, NULL AS top, 0 AS new FROM a UNION ALL SELECT date, flag, n, top, 1 FROM b),
r AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY date, flag ORDER BY new DESC) = 1)
SELECT date, flag, n, top FROM r QUALIFY dense_rank() OVER (ORDER BY date DESC) <= 40""")
def upsert_rolloff(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(F.to_date(F.date_trunc("month", "l_shipdate")).alias("date"), F.col("l_returnflag").alias("flag"), "l_quantity", "l_shipdate")
    cut = F.to_timestamp(F.lit("1996-01-01"))
    a = li.filter(F.col("l_shipdate") < cut).groupBy("date", "flag").agg(F.count(F.lit(1)).alias("n"))
    b = li.filter(F.col("l_shipdate") >= cut).groupBy("date", "flag").agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("top"))
    fix = a.filter("date >= DATE '1995-06-01'").select("date", "flag", F.lit(-1).cast("long").alias("n"), F.lit(None).cast("double").alias("top"))
    return store.upsert_rolloff(a, b.unionByName(fix), ["date", "flag"], 40).select("date", "flag", "n", "top")


_FWD = ", f AS (SELECT date, code, ln(lead(close, 2) OVER (PARTITION BY code ORDER BY date)) - ln(close) AS forward, ln(amount) AS size, volume FROM panel)"


@query(with_panel("month", f"{_FWD} SELECT date, code, {shown('forward')} AS forward FROM f"))
def forward_return(spark, sf_dir):
    return rounded(regress.forward_return(panel(spark, sf_dir, "month")), "forward")


_REG = """, s AS (SELECT date, count(*) AS n, avg(size) AS mx, avg(forward) AS my, avg(size * forward) AS mxy, avg(size * size) AS mxx FROM f WHERE size IS NOT NULL AND forward IS NOT NULL GROUP BY 1),
b AS (SELECT date, n, mx, my, CASE WHEN n >= 6 AND mxx - mx * mx > 1e-12 * mxx THEN (mxy - mx * my) / (mxx - mx * mx) END AS beta FROM s)"""


def _regression_data(spark, sf_dir):
    p = panel(spark, sf_dir, "month")
    return regress.forward_return(p).join(p.select("date", "code", F.ln("amount").alias("size"), "volume"), ["date", "code"])


@query(with_panel("month", f"{_FWD}{_REG} SELECT date, {shown('beta')} AS beta, {shown('my - beta * mx')} AS intercept, n FROM b"))
def regression_slope(spark, sf_dir):
    return rounded(regress.slope_by_date(_regression_data(spark, sf_dir), "forward", "size"), "beta", "intercept")


@query(with_panel("month", f"{_FWD}{_REG} SELECT date, 'size' AS factor_id, {shown('beta')} AS beta, n FROM b"))
def factor_return_one(spark, sf_dir):
    """The grouped map with one factor: the same slopes, by numpy."""
    d = _regression_data(spark, sf_dir).filter("size IS NOT NULL AND forward IS NOT NULL")
    return rounded(regress.factor_returns(d, "forward", ["size"]).select("date", "factor_id", "beta", "n"), "beta")


@query()
def factor_returns_full(spark, sf_dir):
    e = crosssec.standardize(_exposures(spark, sf_dir), ["size", "value", "volume"], ["date"])
    d = e.join(regress.forward_return(panel(spark, sf_dir, "month")), ["date", "code"])
    return regress.factor_returns(d.withColumn("ind", F.col("grp").cast("string")), "forward", ["value", "volume"], ["size"], "ind", 1e-6)


@query()
def orthogonalize(spark, sf_dir):
    e = _exposures(spark, sf_dir).withColumn("ind", F.col("grp").cast("string"))
    return regress.orthogonalize(e, ["value", "volume"], ["size"], "ind")


@query(with_panel("month", f"""{_FWD}{_REG}, m AS (SELECT date, avg(beta) OVER (ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS mu FROM b)
SELECT f.date, f.code, {shown('size * mu')} AS alpha FROM f LEFT JOIN m USING (date) WHERE size IS NOT NULL"""))
def trailing_mean_alpha(spark, sf_dir):
    d = _regression_data(spark, sf_dir)
    b = regress.slope_by_date(d, "forward", "size").withColumn("factor_id", F.lit("size"))
    x = d.filter("size IS NOT NULL").select("date", "code", F.lit("size").alias("factor_id"), F.col("size").alias("residual"))
    return rounded(regress.alpha(x, regress.trailing_mean(b, 12)), "alpha")


_ALPHA = "a AS (SELECT date, code, close / vwap - 1 AS alpha FROM panel WHERE close IS NOT NULL)"
_TOPK = f"""{_ALPHA}, k AS (SELECT *, greatest(alpha, 0) AS s FROM a QUALIFY row_number() OVER (PARTITION BY date ORDER BY alpha DESC, code) <= 10),
r AS (SELECT date, code, CASE WHEN sum(s) OVER d > 0 THEN s / sum(s) OVER d ELSE 1.0 / count(*) OVER d END AS w FROM k WINDOW d AS (PARTITION BY date)),
c AS (SELECT date, code, least(w, 0.1) AS w, 1 - sum(least(w, 0.1)) OVER (PARTITION BY date) AS free, CASE WHEN w < 0.1 THEN 0.1 - w ELSE 0 END AS room FROM r),
t AS (SELECT date, code, w + CASE WHEN sum(room) OVER (PARTITION BY date) > 0 THEN room * least(1.0, free / sum(room) OVER (PARTITION BY date)) ELSE 0 END AS weight FROM c)"""


def _weights(spark, sf_dir):
    a = panel(spark, sf_dir, "month").filter("close IS NOT NULL").select("date", "code", (F.col("close") / F.col("vwap") - 1).alias("alpha"))
    return portfolio.top_k(a, 10, 0.1)


@query(with_panel("month", f", {_TOPK} SELECT date, code, {shown('weight')} AS weight FROM t"))
def top_k_weights(spark, sf_dir):
    return rounded(_weights(spark, sf_dir), "weight")


@query(with_panel("month", f""", {_TOPK}, n AS (SELECT date, lead(date) OVER (ORDER BY date) AS nd FROM (SELECT DISTINCT date FROM t)),
p AS (SELECT n.nd AS date, code, weight AS p FROM t JOIN n USING (date) WHERE n.nd IS NOT NULL),
b AS (SELECT date, code, coalesce(weight, 0) AS w, coalesce(p, 0) AS p FROM t FULL JOIN p USING (date, code))
SELECT date, code, {shown('w')} AS target_weight, CASE WHEN w > p THEN 'BUY' ELSE 'SELL' END AS side FROM b WHERE abs(w - p) >= 0.01"""))
def orders_with_band(spark, sf_dir):
    t = _weights(spark, sf_dir)
    days = t.select("date").distinct().withColumn("nd", F.lead("date").over(Window.orderBy("date")))
    held = t.join(days, "date").filter("nd IS NOT NULL").select(F.col("nd").alias("date"), "code", "weight")
    return rounded(portfolio.orders(t, held), "target_weight")


@query()
def benchmark_neutral_lp(spark, sf_dir):
    e = crosssec.standardize(_exposures(spark, sf_dir), ["size", "value"], ["date"])
    d = e.select("date", "code", F.col("value").alias("alpha"), F.lit(1.0).alias("bench"), F.lit(0.0).alias("previous"), "size", F.col("grp").cast("string").alias("ind"))
    return portfolio.benchmark_neutral(d, ["size"], "ind")


@query()
def daily_run(spark, sf_dir):
    """The whole run, all dates at once: exposures, residuals, factor returns, alphas, weights, orders."""
    from weftline.plans.daily import run

    p = panel(spark, sf_dir, "month").withColumn("industry", (F.col("code") % 5).cast("string"))
    return run(p, {"f14": X.delta(X.var("close"), 5), "f31": 100 * (X.var("close") / X.mean(X.var("close"), 12) - 1), "f2": X.rank(X.var("volume"))}, lookback=12).orders


@query()
def price_styles(spark, sf_dir):
    return styles.price_styles(panel(spark, sf_dir, "dense"))


@query("""SELECT c_custkey, lpad((c_custkey * 37 % 1000000)::VARCHAR, 6, '0') || CASE WHEN lpad((c_custkey * 37 % 1000000)::VARCHAR, 6, '0')[1] = '6' THEN '.SH' ELSE '.SZ' END AS market,
  (CASE WHEN lpad((c_custkey * 37 % 1000000)::VARCHAR, 6, '0')[1] = '6' THEN 'SHSE.' ELSE 'SZSE.' END) || lpad((c_custkey * 37 % 1000000)::VARCHAR, 6, '0') AS vendor,
  NOT (lpad((c_custkey * 37 % 1000000)::VARCHAR, 6, '0')[1:3] IN ('900', '200')) AS a_share, upper(trim(regexp_replace(c_name, '[^0-9A-Za-z]+', '_', 'g'), '_')) AS plain FROM customer""")
def code_forms(spark, sf_dir):
    six = F.lpad((F.col("c_custkey") * 37 % 1000000).cast("string"), 6, "0")
    return read(spark, sf_dir, "customer").select("c_custkey", codes.market_code(six).alias("market"), codes.vendor_code(six).alias("vendor"), codes.is_a_share(six).alias("a_share"), codes.plain_name(F.col("c_name")).alias("plain"))


@query("SELECT s_suppkey AS code, r_name AS industry, 'IND_TPC_L1__' || upper(regexp_replace(r_name, '[^0-9A-Za-z]+', '_', 'g')) AS col FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def industry_columns(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return s.select(F.col("s_suppkey").alias("code"), F.col("r_name").alias("industry"), codes.industry_column(F.lit("TPC"), F.lit(1), F.col("r_name")).alias("col"))


@query("SELECT c_custkey, coalesce(n, 0) AS n_orders, n IS NULL AS never FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def left_completion(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return read(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.col("n").isNull().alias("never"))


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_shipdate IS NOT NULL)")
def days_to_fill(spark, sf_dir):
    """The anti-join of the incremental back-fill."""
    o = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return o.join(read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")), "date", "left_anti")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, floor(sum(value) * 1e3 + 0.5000003) / 1e3 AS value FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    return daily.tumbling(read(spark, sf_dir, "events")).withColumn("value", F.floor(F.col("value") * 1e3 + 0.5000003) / 1e3)


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf_dir):
    return daily.sessions(read(spark, sf_dir, "events")).select("user_id", "start", "n")


_MEMBERS = "m AS (SELECT DISTINCT date_trunc('month', l_shipdate)::DATE AS date, l_suppkey AS code FROM lineitem WHERE month(l_shipdate) % 3 = 1)"


@query(f"""WITH {_MEMBERS}, s AS (SELECT DISTINCT date AS anchor FROM m), d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
a AS (SELECT d.date, s.anchor FROM d ASOF JOIN s ON d.date >= s.anchor) SELECT a.date, count(*) AS n, sum(code) AS codes FROM a JOIN m ON m.date = a.anchor WHERE a.date - a.anchor <= 60 GROUP BY 1""")
def membership_anchor(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").filter(F.month("l_shipdate") % 3 == 1)
    m = li.select(F.to_date(F.date_trunc("month", "l_shipdate")).alias("date"), F.col("l_suppkey").alias("code")).distinct()
    days = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    return universe.anchored(days, m, 60).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("code").alias("codes"))


@query(with_panel("sparse", f""", f AS (SELECT *, date_trunc('month', date)::DATE AS month, min(date) OVER (PARTITION BY date_trunc('month', date)) AS d FROM panel),
v AS (SELECT month, code, CASE WHEN sum(amount) OVER (PARTITION BY month) > 0 THEN coalesce(amount, 0) ELSE 1 END AS v FROM f WHERE date = d)
SELECT month, code, {shown('1000 * v / sum(v) OVER (PARTITION BY month)')} AS weight FROM v"""))
def index_weights_monthly(spark, sf_dir):
    w = universe.month_weights(panel(spark, sf_dir, "sparse"), F.col("amount"), F.col("volume"))
    return rounded(w.withColumn("weight", 1000 * F.col("weight")), "weight")


@query("""WITH p AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, l_suppkey AS code FROM lineitem)
SELECT date, code, (r_name = 'ASIA')::INT AS "IND_TPC_L1__ASIA", (r_name = 'EUROPE')::INT AS "IND_TPC_L1__EUROPE" FROM p JOIN supplier ON code = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def industry_dummies(spark, sf_dir):
    names = industry_columns(spark, sf_dir).select("code", "industry", F.to_date(F.lit("1990-01-01")).alias("effective"))
    days = read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("code")).distinct()
    return universe.dummies(universe.industries(days, names, ["industry"]), ["ASIA", "EUROPE"], "TPC")
