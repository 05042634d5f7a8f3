"""URL filters: explicit rules, then empirical-Bayes host reputation (DataFrame operations only).

Labelled page outcomes (bad or not) are shrunk through beta-binomial priors: the pooled rate is the prior of a suffix,
the suffix's rate that of its registered domains, the domain's rate that of its hosts. How strongly each level pulls is
estimated from the data by the method of moments. A host's posterior is a beta distribution; the host is blocked when the
lower bound of its bad share, at the credibility CREDIBLE, is over the limit. That is asked the other way round, which needs no
inverse: whether the share lies over the limit with that probability. The limit is the pooled rate (a host is blocked when it is
credibly worse than the labelled pages as a whole) unless a share is given. CREDIBLE is a matter of costs: at 2/3 a bad host let
through counts twice a good one blocked.

The probability is an integral over the logit of the share, from the limit outwards on both sides by Simpson's rule; there the
density has one peak and falls off at least exponentially, so STEPS steps a side are enough at any weight.

The registered domain is the label before the suffix and the suffix; the suffix is the last label, or the last two where these
are a country's second level (co.uk).

Defined results: a null url or one without "://" has host and path ""; a page without label counts for no outcome; a
label without page is ignored; of repeated labels of a page the worst holds; without any label all hosts have one posterior, the
prior, which is over the pooled rate with less than that probability, so nothing is blocked by reputation. Other columns of the
inputs are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import ascii_lower, drop_written, written

#: (verdict, host, path), a rule fits its host and all subdomains.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Probability with which a blocked host's bad share is over the limit.
CREDIBLE = 2 / 3
#: Steps of the integral, a side.
STEPS = 200
# Labels that stand before a country's own to form a suffix.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "mil", "ne", "net", "nom", "or", "org", "sch")
#: Range of the prior weights that the method of moments may give.
LEAST, MOST = 2.0, 1000.0
#: A host's table row is repeated so often, and its pages are dealt to as many tasks.
SALT = 16


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return ascii_lower(host), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):  # a longer one overrides
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix; an address in digits, or a host that is a suffix alone, is both itself."""
    numeric = host.rlike(r"^[0-9.:]*$")
    two = host.rlike(rf"(^|\.)({'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$")
    domain = F.when(numeric, host).when(two, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    suffix = F.when(numeric, host).when(two, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))
    return domain, suffix


def _over(a: str, b: str, limit: float, steps: int = STEPS) -> str:
    """SQL (Spark's) of the probability that a beta(a, b) variable is over the limit."""
    peak, width = f"ln({a} / {b})", f"sqrt(1 / {a} + 1 / {b})"
    low, high = f"({peak} - 10 * {width} - 30 / {a})", f"({peak} + 10 * {width} + 30 / {b})"  # nothing lies beyond
    at = f"greatest(least({math.log(limit / (1 - limit))!r}D, {high}), {low})"
    soft = lambda u: f"(greatest({u}, 0D) + ln(1 + exp(-abs({u}))))"

    def side(step: str) -> str:
        u = f"(e.at + i * {step})"
        density = f"exp(e.a * ({u} - e.peak) - (e.a + e.b) * ({soft(u)} - {soft('e.peak')}))"
        return f"abs({step}) * aggregate(sequence(0, {steps}), 0D, (s, i) -> s + (CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {density})"

    one = f"struct({a} AS a, {b} AS b, {peak} AS peak, {at} AS at, ({high} - {at}) / {steps} AS up, ({low} - {at}) / {steps} AS down)"
    sums = f"transform(array({one}), e -> struct({side('e.up')} AS over, {side('e.down')} AS under))[0]"
    return f"transform(array({sums}), e -> e.over / (e.over + e.under))[0]"


def _weight(counts: DataFrame, mean: str) -> DataFrame:
    """One row w: the prior weight by the method of moments over children with n outcomes, bad ones, and the parent's mean."""
    p = F.col("bad") / F.col("n")
    s = counts.filter("n > 0").agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").cast("double").alias("t"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("t2"),
        F.sum(F.col("n") * (p - F.col(mean)) * (p - F.col(mean))).alias("s"),
        F.avg(F.col(mean) * (1 - F.col(mean))).alias("v"),
    )
    free = F.col("t") - F.col("t2") / F.col("t")
    between = (F.col("s") - (F.col("k") - 1) * F.col("v")) / free
    w = F.when((F.col("k") > 1) & (free > 0) & (between > 0), F.col("v") / F.when(between > 0, between) - 1).otherwise(F.lit(MOST))
    return s.select(F.least(F.greatest(F.coalesce(w, F.lit(MOST)), F.lit(LEAST)), F.lit(MOST)).alias("w"))


def host_reputation(outcomes: DataFrame, limit: float | None = None) -> DataFrame:
    """outcomes: host, bad (0, 1 or null where there is no label), any number of rows a host.
    Returns host, n, bad, over: the probability that the host's share of bad pages is over the limit (None: the pooled rate)."""
    counts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = levels(F.col("host"))
    kept: list[str] = []
    hosts = written(counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts", kept)
    total = lambda *by: hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    pooled = total().select(((F.coalesce("bad", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 2.0)).alias("m"))
    scalar = lambda df: float(df.first()[0])  # noqa: E731  one number, whatever the input's size
    m = scalar(pooled)
    suffixes = total("suffix").withColumn("m", F.lit(m))
    w = scalar(_weight(suffixes, "m"))
    suffixes = suffixes.select("suffix", ((F.col("bad") + w * F.col("m")) / (F.col("n") + w)).alias("ms"))
    domains = total("domain", "suffix").join(suffixes, "suffix")
    w = scalar(_weight(domains, "ms"))
    domains = domains.select("domain", "suffix", ((F.col("bad") + w * F.col("ms")) / (F.col("n") + w)).alias("md"))
    judged = hosts.join(domains, ["domain", "suffix"])
    w = scalar(_weight(judged, "md"))
    judged = judged.select("host", "n", "bad", (F.col("bad") + w * F.col("md")).alias("a"), (F.col("n") - F.col("bad") + w * (1 - F.col("md"))).alias("b"))
    posteriors = written(judged.select("a", "b").distinct(), "posteriors")  # few: hosts without labels share their domain's
    over = posteriors.select("a", "b", F.expr(_over("a", "b", m if limit is None else limit)).alias("over"))
    done = written(judged.join(over, ["a", "b"]).select("host", "n", "bad", "over"), "reputation")
    drop_written(outcomes.sparkSession, kept)
    return done


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float | None = None, credible: float = CREDIBLE) -> DataFrame:
    """pages: page_id, url; labels: doc_id (a page_id), quality, toxic. Returns page_id, host, path, rule, verdict.

    Hosts that are blocked are fewer than hosts; pages of a hot host are split by Spark where the merge join meets them."""
    host, path = url_parts(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    marks = labels.filter(known & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.when((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1), 1).otherwise(0)).alias("bad")
    )
    outcomes = p.select("page_id", "host").join(marks, "page_id", "left").select("host", "bad")
    blocked = host_reputation(outcomes, limit).filter(F.round("over", 9) > credible).select(F.col("host").alias("bad_host"))
    salts = F.array(*[F.lit(k) for k in range(SALT)])
    blocked = blocked.withColumn("salt", F.explode(salts))
    salted = p.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALT)).cast("int"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    by_reputation = F.when(F.col("bad_host").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (
        salted.join(blocked, (salted.host == blocked.bad_host) & (salted.salt == blocked.salt), "left")
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_reputation).alias("verdict"))
    )


ORACLE = f"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
marks AS (
  SELECT doc_id AS page_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1),
h AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad FROM q LEFT JOIN marks USING (page_id) GROUP BY 1),
l AS (
  SELECT *, string_split(host, '.') AS w, regexp_matches(host, '^[0-9.:]*$') AS num,
         regexp_matches(host, '(^|\\.)({'|'.join(SECOND_LEVEL)})\\.[a-z][a-z]$')::INT AS two FROM h),
hosts AS (
  SELECT host, n, bad, CASE WHEN num OR len(w) < 2 + two THEN host ELSE array_to_string(w[len(w) - 1 - two:], '.') END AS domain,
         CASE WHEN num THEN host ELSE array_to_string(w[len(w) - two:], '.') END AS suffix FROM l),
pooled AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM hosts, pooled GROUP BY 1),
ws AS (SELECT count(*) AS k, sum(n) AS t, sum(n * n) AS t2, sum(n * (bad / n - m) ** 2) AS s, avg(m * (1 - m)) AS v FROM s0 WHERE n > 0),
kw AS (SELECT least(greatest(coalesce(CASE WHEN k > 1 AND t - t2 / t > 0 AND (s - (k - 1) * v) / (t - t2 / t) > 0
         THEN v / ((s - (k - 1) * v) / (t - t2 / t)) - 1 ELSE {MOST} END, {MOST}), {LEAST}), {MOST}) AS w FROM ws),
s1 AS (SELECT suffix, (bad + w * m) / (n + w) AS ms FROM s0, kw),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(ms) AS m FROM hosts JOIN s1 USING (suffix) GROUP BY 1, 2),
wd AS (SELECT count(*) AS k, sum(n) AS t, sum(n * n) AS t2, sum(n * (bad / n - m) ** 2) AS s, avg(m * (1 - m)) AS v FROM d0 WHERE n > 0),
kd AS (SELECT least(greatest(coalesce(CASE WHEN k > 1 AND t - t2 / t > 0 AND (s - (k - 1) * v) / (t - t2 / t) > 0
         THEN v / ((s - (k - 1) * v) / (t - t2 / t)) - 1 ELSE {MOST} END, {MOST}), {LEAST}), {MOST}) AS w FROM wd),
d1 AS (SELECT domain, suffix, (bad + w * m) / (n + w) AS md FROM d0, kd),
h0 AS (SELECT host, n, bad, md AS m FROM hosts JOIN d1 USING (domain, suffix)),
wh AS (SELECT count(*) AS k, sum(n) AS t, sum(n * n) AS t2, sum(n * (bad / n - m) ** 2) AS s, avg(m * (1 - m)) AS v FROM h0 WHERE n > 0),
kh AS (SELECT least(greatest(coalesce(CASE WHEN k > 1 AND t - t2 / t > 0 AND (s - (k - 1) * v) / (t - t2 / t) > 0
         THEN v / ((s - (k - 1) * v) / (t - t2 / t)) - 1 ELSE {MOST} END, {MOST}), {LEAST}), {MOST}) AS w FROM wh),
h1 AS (SELECT DISTINCT bad + w * m AS a, n - bad + w * (1 - m) AS b FROM h0, kh),
h2 AS (SELECT a, b, ln(a / b) AS peak, ln(m / (1 - m)) AS edge, (abs(ln(a / b) - ln(m / (1 - m))) + 12 * sqrt(1 / a + 1 / b) + 30 / least(a, b)) / 4000 AS step FROM h1, pooled),
h3 AS (SELECT a, b, peak, k >= 0 AS up, edge + (k + 0.5) * step AS u FROM h2, range(-4000, 4000) AS t(k)),
h4 AS (SELECT a, b, up, exp(a * (u - peak) - (a + b) * (greatest(u, 0) + ln(1 + exp(-abs(u))) - greatest(peak, 0) - ln(1 + exp(-abs(peak))))) AS g FROM h3),
h5 AS (SELECT a, b, sum(CASE WHEN up THEN g ELSE 0 END) / sum(g) AS above FROM h4 GROUP BY 1, 2),
rep AS (SELECT host, above FROM h0, kh, h5 WHERE h5.a = bad + w * m AND h5.b = n - bad + w * (1 - m)),
r AS (
  SELECT q.*, above, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM q LEFT JOIN rep USING (host))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN coalesce(above, 0) > {CREDIBLE!r} THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
