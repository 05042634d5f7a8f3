"""Secret scans: fixed patterns, and two character Markov models (DataFrame operations only).

One pass over the texts takes the matches of the patterns (base spans) and candidate tokens with their places; the places come
from the lengths of what stands between matches. From a bounded sample of labelled strings, the patterns' secrets (random)
and the other tokens of the same documents (ordinary), two first-order models over 63 characters and one for all others
are trained: the random model is mixed with equal chances, the ordinary model backs off to single characters. A candidate is
a secret when the log-likelihood ratio of its transitions is over LEAST_TOTAL and, a transition, over LEAST_MEAN, and it
overlaps no base span. The models are one table of 4096 integers (thousandths of a nat), whatever the corpus.

Defined results: a null text is ""; a document without match has n_* 0 and empty spans; with no labelled strings no span is
added; repeated rows are scanned again; other columns are ignored by scan() and kept untouched by masked().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import written

# The patterns, in the order of their kinds. Groups: the secret's own characters.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{12,})"  # a greedy run of 16 characters or more; a shorter run holds no longer one
HEX = r"([0-9a-f]{32,})"
KINDS = ("assign", "access", "hex", "markov")
LEAST_ASSIGN = 8

CANDIDATE = r"([A-Za-z0-9+/_=-]{16,})"
TOKEN = r"([A-Za-z0-9+/_=-]{8,})"
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"
#: Documents in the labelled sample (expected number); share of equal chances in the random model; pull of single characters.
LEARN_DOCS, EVEN, PULL, LITTLE = 2000, 0.2, 5.0, 0.05
LEAST_TOTAL, LEAST_MEAN = 20_000, 700
MASK = "[SECRET]"

_SPAN = "array<struct<start:int,kind:int,end:int,secret:string>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 1, least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches whose group has so many characters."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))
        secret = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            a = acc["at"] + F.length(x["between"])
            b = a + F.length(x["m"])
            span = F.struct(a.alias("start"), F.lit(kind).alias("kind"), b.alias("end"), x["secret"].alias("secret"))
            out = F.when(F.length(x["secret"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
            return F.struct(b.alias("at"), out.cast(_SPAN).alias("out"))

        zipped = F.arrays_zip(between.alias("between"), m.alias("m"), secret.alias("secret"))
        return F.when(F.size(m) > 0, F.aggregate(zipped, start, step)["out"]).otherwise(F.array().cast(_SPAN))

    return F.transform(F.array(whole), placed)[0]  # the matches are found once


def _found(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, base (spans), cands (spans), plain (ordinary tokens of documents with base spans), and the carried columns."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *carry)
    text = F.col("text")
    base = F.concat(_spans(text, ASSIGN, 0, 2, LEAST_ASSIGN), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    t = t.select("*", F.array_sort(base).alias("base"), _spans(text, CANDIDATE, 3).alias("cands"))
    rest = text
    for p in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, p, " ")
    plain = F.when(F.size("base") > 0, F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(1))).otherwise(F.array().cast("array<string>"))
    return t.select("doc_id", "base", "cands", plain.alias("plain"), *carry)


def train(found: DataFrame, learn_docs: int = LEARN_DOCS) -> list[int] | None:
    """The table of log-likelihood ratios (64 x 64, by SYMBOLS and one for all others), or None without labelled strings."""
    labelled = found.filter(F.size("base") > 0)
    n = labelled.count()
    if not n:
        return None
    share = min(1.0, learn_docs / n)
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", "base"), F.lit(1 << 30)) < int(share * (1 << 30)))
    words = sample.select(F.lit(1).alias("random"), F.explode("base.secret").alias("w")).unionAll(sample.select(F.lit(0), F.explode("plain")))
    at = lambda p: F.instr(F.lit(SYMBOLS), F.substring(F.col("w"), p, F.lit(1)))
    pairs = words.filter(F.length("w") > 1).select("random", "w", F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("p"))
    counts = pairs.groupBy("random", at(F.col("p")).alias("a"), at(F.col("p") + 1).alias("b")).count().collect()  # 8192 rows at most
    c = [[[0.0] * 64 for _ in range(64)] for _ in range(2)]
    for r in counts:
        c[r.random][r.a][r.b] = float(r["count"])
    table = []
    single = [[sum(c[k][a][b] for a in range(64)) for b in range(64)] for k in range(2)]
    chance = [[(x + LITTLE) / (sum(single[k]) + 64 * LITTLE) for x in single[k]] for k in range(2)]
    for a in range(64):
        rows = [sum(c[k][a]) for k in range(2)]
        for b in range(64):
            ordinary, random = ((c[k][a][b] + PULL * chance[k][b]) / (rows[k] + PULL) for k in range(2))
            table.append(math.floor(1000 * math.log(((1 - EVEN) * random + EVEN / 64) / ordinary) + 0.5))
    return table


def _scored(token: Column, table: list[int]) -> Column:
    """Sum of the table over the token's transitions; a token all in capitals is read as small letters."""
    token = F.when(token.rlike("^[A-Z_+/=-]*$"), F.lower(token)).otherwise(token)
    llr = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    at = lambda p: F.instr(F.lit(SYMBOLS), F.substring(token, p, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0), lambda acc, p: acc + F.get(llr, at(p) * 64 + at(p + 1)))


def scan(docs: DataFrame, *carry: str, learn_docs: int = LEARN_DOCS) -> DataFrame:
    """doc_id, base and spans (arrays of start, kind, end, secret; code points, end exclusive), and the carried columns."""
    found = written(_found(docs, *carry), "secrets")
    table = train(found, learn_docs)
    more = F.array().cast(_SPAN)
    if table is not None:
        def added(c: Column) -> Column:
            clear = ~F.exists("base", lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
            score = lambda s: (s >= LEAST_TOTAL) & (s >= LEAST_MEAN * (F.length(c["secret"]) - 1))
            return clear & F.exists(F.array(_scored(c["secret"], table)), score)

        more = F.filter("cands", added)
    return found.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"), *carry)


def _shown(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(_shown("base"), 256).alias("base_sha256"), _shown("spans").alias("spans")
    )


def masked(docs: DataFrame) -> DataFrame:
    """All rows of docs; each secret of the text (what spans cover, as one where they overlap) reads MASK, n_chars follows, all else as it was."""
    packed = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("whole_row"))
    found = scan(packed, "whole_row")
    text = F.col("whole_row")["text"]

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    clean = F.transform(F.array(done), lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))[0]
    new = F.when(F.size("spans") > 0, clean).otherwise(text)
    found = found.select("whole_row", "spans", new.alias("new_text"))
    size = F.when(F.size("spans") > 0, F.length("new_text")).otherwise(F.col("whole_row")["n_chars"]) if "n_chars" in docs.columns else None
    changed = {"text": F.col("new_text"), "n_chars": size}
    return found.select(*[(changed[c] if c in changed else F.col("whole_row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
