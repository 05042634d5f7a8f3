"""Quality rules: fixed rules, then robust multivariate outliers (DataFrame operations and SQL only).

Each document has a vector of transformed statistics, rounded to integers so that all sums are exact. For each language and
source (the language alone, then all documents, where there are fewer than LEAST) the minimum-covariance-determinant
estimate is sought by concentration steps from two starts, the plain moments and the coordinatewise medians and quartiles:
a step orders documents by Mahalanobis distance, keeps the closest part ALPHA (by exact counts in fine distance bins), and
takes mean and covariance of these; the start with the smaller determinant wins. A document is rejected when its squared
distance, scaled so that the ALPHA quantile is that of a chi-squared law, is over LIMIT.

The SQL of op7_robust_quality estimates the language, and the corpus, from the documents that fall back to it alone. With whole,
as in keep() and the pipeline, they are estimated from all documents of the language, and all of the corpus; a document is still
judged once, by its own group.

A step is one aggregation by (group, start, bin), partial sums first, so a hot group is split by Spark's map side; what is
joined back is one row for each group. Determinants stay over zero by FLOOR, the least standard deviations.

Defined results: a null text has no words; null lang and source are a group value of their own; no documents, no rows;
repeated rows are judged again; other columns are ignored by features(), and kept untouched by keep().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import written

#: Fixed rules: words at least, percent of words in repeated 3-word windows at most.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Share of documents in the covered part; its chi-squared quantile with five degrees of freedom; scaled squared distance at most.
ALPHA, CHI2_ALPHA, LIMIT = 0.75, 6.6257, 150.0
#: Documents of a group of its own at least; concentration steps; bins a doubling of the squared distance.
LEAST, STEPS, BINS = 200, 3, 12
#: Transformed statistics and their least standard deviations, in thousandths.
STATS = ("x_len", "x_word", "x_sym", "x_rep", "x_caps")
FLOOR = (300, 60, 20, 30, 60)

_WS = r"[\x20\x09-\x0D]+"


def _repeat_words(words: Column) -> Column:
    """Words within 3-word windows that stand twice or more in the text."""
    n = F.size(words) - 2
    windows = F.transform(F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c")), lambda x: F.xxhash64(x))

    def covered(s: Column) -> Column:
        """s: (hash, place) in order; each repeated window adds the words before the next repeated window, three at most."""
        again = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
        return F.transform(F.array(F.sort_array(F.transform(again, lambda x: x["i"]))), lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))[0]

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), F.transform(F.array(placed), covered)[0]).otherwise(0)

    # An array of one, so that what is used more than once is computed once.
    return F.when(n > 1, F.transform(F.array(windows), count)[0]).otherwise(0)


def features(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_caps, the carried columns, base_failed."""
    t = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"), *carry)
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    t = t.select("*", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WS, -1)).alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c: c.cast("long")
    t = t.select(
        "doc_id", "lang", "source", long(F.size("words")).alias("n_words"), long(F.length(F.array_join("words", ""))).alias("word_chars"),
        long(F.regexp_count("text", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a)))[0]).alias("n_dup_lines"),
        long(_repeat_words(F.col("words"))).alias("n_repeat_words"), long(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_caps"), *carry,
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return t.withColumn("base_failed", failed)


# The steps below are SQL that Spark and DuckDB both read; each name is a view or a common table expression.
def _int(x: str) -> str:
    return f"CAST(floor(1000 * ({x}) + 0.5) AS BIGINT)"


#: Language and source as group values: null is one of its own.
_OWN = "CASE WHEN lang IS NULL THEN '' ELSE concat('=', lang) END AS {}, CASE WHEN source IS NULL THEN '' ELSE concat('=', source) END AS {}"


def _vector_sql(source: str) -> str:
    one = lambda x: f"CAST({x} AS DOUBLE)"
    stats = {
        "x_len": f"ln(1 + {one('n_words')})",
        "x_word": f"ln(1 + {one('word_chars')} / greatest(n_words, 1))",
        "x_sym": f"{one('n_symbols')} / greatest(word_chars, 1)",
        "x_rep": f"{one('n_repeat_words')} / greatest(n_words, 1)",
        "x_caps": f"{one('n_caps')} / greatest(word_chars, 1)",
    }
    return f"SELECT row_key, {_OWN.format('lang', 'source')}, {', '.join(f'{_int(v)} AS {k}' for k, v in stats.items())} FROM {source}"


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(STATS)) for j in range(i + 1)]


def _moments_sql(x: str = "") -> str:
    """Sums of the vector and of its products."""
    return ", ".join([f"sum({x}{s}) AS m{i}" for i, s in enumerate(STATS)] + [f"sum({x}{STATS[i]} * {x}{STATS[j]}) AS q{i}{j}" for i, j in _pairs()])


def _estimate_sql(source: str, keys: str) -> str:
    """From n, m*, q* (columns) to centre c*, the Cholesky factor l** of the covariance, and the logarithm of its determinant."""
    d = len(STATS)
    cov = ", ".join(f"(q{i}{j} - m{i} * (m{j} / n)) / n" + (f" + {FLOOR[i] ** 2}" if i == j else "") + f" AS s{i}{j}" for i, j in _pairs())
    sql = f"(SELECT {keys}, n, {', '.join(f'm{i} / n AS c{i}' for i in range(d))}, {cov} FROM (SELECT {keys}, CAST(n AS DOUBLE) AS n, {', '.join(f'CAST(m{i} AS DOUBLE) AS m{i}' for i in range(d))}, {', '.join(f'CAST(q{i}{j} AS DOUBLE) AS q{i}{j}' for i, j in _pairs())} FROM {source}))"
    for j in range(d):  # a column of the factor after the other
        inner = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        sql = f"(SELECT *, sqrt(greatest(s{j}{j}{inner}, {0.25 * FLOOR[j] ** 2})) AS l{j}{j} FROM {sql})"
        below = [f"(s{i}{j}{''.join(f' - l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, d)]
        if below:
            sql = f"(SELECT *, {', '.join(below)} FROM {sql})"
    factor = ", ".join([f"c{i}" for i in range(d)] + [f"l{i}{j}" for i, j in _pairs()])
    return f"SELECT {keys}, {factor}, {' + '.join(f'ln(l{i}{i})' for i in range(d))} AS logdet FROM {sql}"


def _distance_sql(source: str, keys: str) -> str:
    """keys and d2: the squared distance, by forward substitution."""
    sql = source
    for i, s in enumerate(STATS):
        sql = f"(SELECT *, ({s} - c{i}{''.join(f' - l{i}{k} * y{k}' for k in range(i))}) / l{i}{i} AS y{i} FROM {sql})"
    return f"SELECT {keys}, {' + '.join(f'y{i} * y{i}' for i in range(len(STATS)))} AS d2 FROM {sql}"


def _bin(d2: str = "d2") -> str:
    return f"CAST(floor({BINS} * ln({d2} + 0.001) / ln(2.0)) AS INT)"


def _plan(grouped: str = "grouped", whole: bool = False) -> list[tuple[str, str]]:
    """Named steps from `stat` (row_key, lang, source, x_*) to `verdict` (row_key, far); whole: without `verdict`, as rows are in several groups."""
    x = ", ".join(f"g.{s}" for s in STATS)
    params = ", ".join([f"p.c{i}" for i in range(len(STATS))] + [f"p.l{i}{j}" for i, j in _pairs()])
    steps = [
        ("sizes", "SELECT lang, source, count(*) AS n FROM stat GROUP BY lang, source"),
        ("langs", "SELECT lang, sum(n) AS n FROM sizes GROUP BY lang"),
        ("named", f"SELECT s.lang, s.source, CASE WHEN s.n >= {LEAST} THEN concat('s:', length(s.lang), ':', s.lang, s.source) WHEN l.n >= {LEAST} THEN concat('l:', s.lang) ELSE 'all' END AS grp FROM sizes s JOIN langs l ON s.lang = l.lang"),
        (grouped, f"SELECT g.row_key, n.grp, {x} FROM stat g JOIN named n ON g.lang = n.lang AND g.source = n.source"),
        ("plain", f"SELECT grp, 0 AS start, count(*) AS n, {_moments_sql()} FROM {grouped} GROUP BY grp"),
        ("p_plain", _estimate_sql("plain", "grp, start")),
        ("middle", f"SELECT grp, {', '.join(f'QUANTILE({s}, 0.5) AS c{i}, QUANTILE({s}, 0.75) - QUANTILE({s}, 0.25) AS w{i}' for i, s in enumerate(STATS))} FROM {grouped} GROUP BY grp"),
        ("p_middle", f"SELECT grp, 1 AS start, {', '.join(f'c{i}' for i in range(len(STATS)))}, {', '.join(f'sqrt(w{i} * w{i} / 1.8198 + {FLOOR[i] ** 2})' if i == j else 'CAST(0 AS DOUBLE)' for i, j in _pairs())}, CAST(0 AS DOUBLE) AS logdet FROM middle"),
        ("p0", "SELECT * FROM p_plain UNION ALL SELECT * FROM p_middle"),
    ]
    if whole:  # the groups some rows fall back to take all rows of the language, and of the corpus
        at = [name for name, _ in steps].index(grouped)
        steps[at] = (grouped, steps[at][1].replace("JOIN named n", "JOIN dealt n"))
        steps.insert(at, ("dealt", "SELECT lang, source, grp FROM named UNION SELECT s.lang, s.source, n.grp FROM sizes s JOIN named n ON n.grp = concat('l:', s.lang) UNION SELECT s.lang, s.source, n.grp FROM sizes s JOIN named n ON n.grp = 'all'"))
    for k in range(STEPS):
        steps += [
            (f"d{k}", _distance_sql(f"(SELECT g.row_key, g.grp, p.start, {x}, {params} FROM {grouped} g JOIN p{k} p ON g.grp = p.grp)", f"grp, start, {', '.join(STATS)}")),
            (f"b{k}", f"SELECT grp, start, bin, count(*) AS n, {_moments_sql()} FROM (SELECT *, {_bin()} AS bin FROM d{k}) GROUP BY grp, start, bin"),
            (f"r{k}", f"SELECT *, coalesce(sum(n) OVER (PARTITION BY grp, start ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY grp, start) AS total FROM b{k}"),
            (f"k{k}", f"SELECT grp, start, sum(n) AS n, max(bin) AS bin, {', '.join([f'sum(m{i}) AS m{i}' for i in range(len(STATS))] + [f'sum(q{i}{j}) AS q{i}{j}' for i, j in _pairs()])} FROM r{k} WHERE before < {ALPHA} * total GROUP BY grp, start"),
            (f"p{k + 1}", _estimate_sql(f"k{k}", "grp, start")),
        ]
    steps += [
        ("choice", f"SELECT grp, min(CASE WHEN r = 1 THEN start END) AS start FROM (SELECT grp, start, row_number() OVER (PARTITION BY grp ORDER BY floor(logdet * 1000000), start) AS r FROM p{STEPS}) GROUP BY grp"),
        ("best", f"SELECT p.* FROM p{STEPS} p JOIN choice c ON p.grp = c.grp AND p.start = c.start"),
        ("dist", _distance_sql(f"(SELECT g.row_key, g.grp, {x}, {params} FROM {grouped} g JOIN best p ON g.grp = p.grp)", "row_key, grp")),
        ("hist", f"SELECT grp, {_bin()} AS bin, count(*) AS n FROM dist GROUP BY grp, {_bin()}"),
        ("cum", "SELECT *, coalesce(sum(n) OVER (PARTITION BY grp ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY grp) AS total FROM hist"),
        ("scale", f"SELECT grp, exp(ln(2.0) * (max(bin) + 1) / {BINS}) AS q FROM cum WHERE before < {ALPHA} * total GROUP BY grp"),
        ("verdict", f"SELECT d.row_key, d.d2 / s.q * {CHI2_ALPHA} > {LIMIT} AS far FROM dist d JOIN scale s ON d.grp = s.grp"),
    ]
    return steps[:-1] if whole else steps


def _as_parameter(sql: str, name: str) -> str:
    """The table name as a parameter of spark.sql."""
    for word in ("FROM", "JOIN"):
        for end in (" ", ")"):
            sql = (sql + " ").replace(f"{word} {name}{end}", f"{word} {{{name}}}{end}").removesuffix(" ")
    return sql


def _run(sql: str, made: dict[str, DataFrame]) -> DataFrame:
    used = {k: v for k, v in made.items() if _as_parameter(sql, k) != sql}
    for k in used:
        sql = _as_parameter(sql, k)
    return next(iter(used.values())).sparkSession.sql(sql, **used)


def estimates(stat: DataFrame, whole: bool = False) -> dict[str, DataFrame]:
    """stat: row_key, lang, source and the columns of STATS (integers).
    Returns named (lang, source, grp), best (grp, centre, factor) and scale (grp, q), one row for each group, as written tables."""
    made, keep = {"stat": stat}, {"named", "grouped", "best", "scale", *(f"p{k}" for k in range(STEPS + 1))}
    for name, sql in _plan(whole=whole):
        if name not in ("dist", "verdict"):
            made[name] = _run(sql.replace("QUANTILE(", "percentile("), made)
        elif name == "dist":
            made[name] = _run(sql, made)
        if name in keep:
            made[name] = written(made[name], f"mcd-{name}")
    return {k: made[k] for k in ("named", "best", "scale")}


def judge(docs: DataFrame, *carry: str, whole: bool = False) -> DataFrame:
    """whole: fall back to estimates from all documents of the language, then of the corpus. Returns
    doc_id, lang, source, the statistics, base_failed, kept, and the columns of docs to be carried along."""
    f = features(docs, *carry)
    own = f.columns
    f = written(f, "quality")
    stat = _run(_vector_sql("feats"), {"feats": f.withColumn("row_key", F.lit(0))})
    made = estimates(stat, whole)
    x = _run(_vector_sql("feats").replace("SELECT row_key", "SELECT *, 0 AS row_key").replace(_OWN.format("lang", "source"), _OWN.format("g_lang", "g_source")), {"feats": f})
    params = {c: made["best"][c] for c in made["best"].columns if c not in ("grp", "start", "logdet")}
    named = made["named"].select(F.col("lang").alias("n_lang"), F.col("source").alias("n_source"), "grp").join(made["best"].select("grp", *params), "grp").join(made["scale"], "grp")
    joined = x.join(named, (x.g_lang == named.n_lang) & (x.g_source == named.n_source), "left")
    y: list[Column] = []
    for i, s in enumerate(STATS):
        part = F.col(s) - F.col(f"c{i}")
        for k in range(i):
            part = part - F.col(f"l{i}{k}") * y[k]
        joined = joined.withColumn(f"y{i}", part / F.col(f"l{i}{i}"))
        y.append(F.col(f"y{i}"))
    d2 = sum((v * v for v in y[1:]), y[0] * y[0])
    far = d2 / F.col("q") * CHI2_ALPHA > LIMIT
    return joined.select(*own, (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, all columns as they were."""
    packed = docs.select("doc_id", "lang", "source", "text", F.struct(*[docs[c] for c in docs.columns]).alias("whole_row"))
    return judge(packed, "whole_row", whole=True).filter("kept").select("whole_row.*")


def digests(docs: DataFrame, whole: bool = False) -> DataFrame:
    return judge(docs, whole=whole).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WS_RE = r"[\x20\x09-\x0D]+"
_FEATURES_SQL = f"""
  w AS (SELECT doc_id AS row_key, doc_id, lang, source, coalesce(text, '') AS text,
          list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS_RE}'), lambda x: x <> '') AS words,
          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
  win AS (SELECT row_key, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t FROM (SELECT row_key, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
  rep AS (SELECT row_key, i FROM win SEMI JOIN (SELECT row_key, t FROM win GROUP BY ALL HAVING count(*) > 1) d ON win.row_key = d.row_key AND win.t = d.t),
  cov AS (SELECT row_key, count(DISTINCT p) AS n FROM (SELECT row_key, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
  feats AS (SELECT w.row_key, doc_id, lang, source, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', ''))::BIGINT AS word_chars_,
          length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
          coalesce(cov.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_caps, coalesce(word_chars_, 0) AS word_chars
        FROM w LEFT JOIN cov ON w.row_key = cov.row_key)"""


def oracle() -> str:
    steps = ",\n  ".join(f"{name} AS ({sql.replace('QUANTILE(', 'quantile_cont(')})" for name, sql in _plan())
    return f"""WITH {_FEATURES_SQL},
  stat AS ({_vector_sql("feats")}),
  {steps}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND NOT coalesce(far, false) AS kept
FROM feats LEFT JOIN verdict ON feats.row_key = verdict.row_key"""


ORACLE = oracle()
