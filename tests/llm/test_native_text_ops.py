"""op4, op7: against plain Python and DuckDB, and on hostile rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import DATA, TEXTS, docs
from tests.oracle import differ
from weftline.llm import queries, robust_quality, secret_scan

WS = "[\x20\x09-\x0d]+"


def statistics(text):
    text = text or ""
    words = [w for w in re.split(WS, text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_op7_query(spark):
    assert differ(spark, queries.op7_robust_quality, queries.ORACLE["op7_robust_quality"], DATA) == ""


def test_op7_statistics(spark):
    texts = [*TEXTS, "a b c a b c a b c d", "x y z " * 30, "p q r s p q r t q r s", "## $$ %% <a> | &\nq\nq\n \n \nq"]
    df = docs(spark, texts)
    got = robust_quality.judge(df).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1:])
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], key=key) == sorted([(r.doc_id, *statistics(r.text)) for r in df.collect()], key=key)
    assert all(not r.kept for r in got if r.base_failed)
    assert robust_quality.judge(df.limit(0)).count() == 0
    stay = robust_quality.keep(df)
    assert stay.columns == df.columns and stay.count() == sum(r.kept for r in got)


def test_op7_small_sources_fall_back_to_the_whole_language_and_corpus(spark):
    rng = np.random.default_rng(5)
    text = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(n))
    rows = [(i, text(int(rng.integers(80, 300))), "en", "big") for i in range(260)]
    junk = " ".join("#*$%&|<>"[k % 8] * 3 + str(k) for k in range(120))
    rows += [(1000, text(150), "en", "rare"), (1001, junk, "en", "rare"), (1002, text(150), None, None), (1003, junk, None, None), (1004, text(150), "xx", "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in robust_quality.judge(df, whole=True).collect()}
    assert len(got) == len(rows) and not got[1001] and not got[1003] and got[1000] and got[1002] and got[1004] and sum(got.values()) >= 255
    stay = robust_quality.keep(df)
    assert stay.columns == df.columns and {r.doc_id for r in stay.collect()} == {d for d, k in got.items() if k}
    alone = {r.doc_id: r.kept for r in robust_quality.judge(df).collect()}  # as the SQL has it
    assert alone[1001] and alone[1003]


def test_op7_rejects_outliers_and_keeps_the_rest(spark):
    base = "the of and ererly thhat tionble inges stedou ouhath onnd reean esha".split()
    texts = [" ".join(base[(i * 7 + j * (1 + i % 5)) % 12] + str((i * j) % 97) for j in range(60 + i % 200)) for i in range(400)]
    odd = [" ".join(f"###{j}%%%$$$" for j in range(100)), " ".join(f"w{j}|" + "|" * 12 for j in range(80))]
    df = spark.createDataFrame([(i, t, "en", f"s{i % 2}") for i, t in enumerate(texts + odd)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in robust_quality.judge(df).collect()}
    assert not got[400].kept and not got[401].kept and not got[400].base_failed and not got[401].base_failed
    assert sum(r.kept or r.base_failed for r in got.values()) >= 399


def base_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), m[2]))
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def shown(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b, *_ in spans)


def brute_force(texts, learn=True):
    """All spans by the same models, counted plainly; every labelled document is in the sample."""
    counts = [Counter(), Counter()]
    sym = lambda ch: secret_scan.SYMBOLS.find(ch) + 1
    for t in texts:
        base = base_spans(t)
        if base:
            rest = re.sub("|".join(["(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"]), " ", t)
            rest = re.sub("[0-9a-f]{32,}", " ", re.sub("AKIA[A-Z0-9]{12,}", " ", rest))
            for k, words in ((1, [s for *_, s in base]), (0, re.findall(secret_scan.TOKEN, rest))):
                for w in words:
                    counts[k].update((sym(x), sym(y)) for x, y in zip(w, w[1:], strict=False))
    rows = [Counter(), Counter()]
    cols = [Counter(), Counter()]
    for k in range(2):
        for (a, b), n in counts[k].items():
            rows[k][a] += n
            cols[k][b] += n
    total = [sum(c.values()) for c in counts]

    def ratio(a, b):
        p = [(counts[k][a, b] + 5 * (cols[k][b] + 0.05) / (total[k] + 64 * 0.05)) / (rows[k][a] + 5) for k in range(2)]
        return math.floor(1000 * math.log((0.8 * p[1] + 0.2 / 64) / p[0]) + 0.5)

    out = []
    for t in texts:
        base = base_spans(t)
        more = []
        for m in re.finditer(secret_scan.CANDIDATE, t or "") if any(total) else ():
            low = m[0].lower() if re.fullmatch("[A-Z_+/=-]*", m[0]) else m[0]
            score = sum(ratio(sym(x), sym(y)) for x, y in zip(low, low[1:], strict=False))
            clear = not any(a < m.end() and m.start() < b for a, _, b, _ in base)
            if clear and score >= secret_scan.LEAST_TOTAL and score >= secret_scan.LEAST_MEAN * (len(m[0]) - 1):
                more.append((m.start(), 3, m.end(), m[0]))
        out.append((shown(base), shown(sorted(base + more))))
    return out


SECRETS = [
    'say password=hunter2hunter2 and Token : "abc" then API_KEY=\'0123456789abcdef\' end', "secret=token=abcdefgh12 secret:x", "token: key secret=abcdefgh", "password=token:abcdefgh",
    "AKIA1234567890AB AKIA123 xAKIAAKIAAKIAAKIA00", "é🎉 0123456789abcdef0123456789abcdef0 f" + "0a" * 20, "ſecret=abcdefghij toKen=abcdefghij", "x9Kq2LmZ7vB4tR8wY1pN6sD3 ordinary_identifier_name_here ththtionblenessesandmore",
    "password=" + "a" * 300, "", None,
]


def test_op4_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op4_secret_scan(spark, DATA).collect()}
    assert set(got) == set(texts)
    for (d, t), (base, spans) in zip(texts.items(), brute_force(list(texts.values())), strict=True):
        want = base_spans(t)
        r = got[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, *_ in want) for kind in range(3)]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans == spans
    assert any(r.n_assign for r in got.values())


def test_op4_rows(spark):
    texts = SECRETS + TEXTS
    df = docs(spark, texts)
    got = {r.doc_id: r for r in secret_scan.digests(df).collect()}
    for i, (base, spans) in enumerate(brute_force([r.text for r in df.collect()])[: len(texts)]):
        assert (got[i].base_sha256, got[i].spans) == (hashlib.sha256(base.encode()).hexdigest(), spans), texts[i]
    assert all("markov" not in got[i].spans for i in range(7))
    clear = docs(spark, ["nothing here", None, "x9Kq2LmZ7vB4tR8wY1pN6sD3", "", "a", "b", "c"])
    assert {r.spans for r in secret_scan.digests(clear).collect()} == {""}
    assert secret_scan.digests(df.limit(0)).count() == 0


def test_op4_masks_secrets_only(spark):
    df = docs(spark, SECRETS + TEXTS)
    out = secret_scan.masked(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    for r in df.collect():
        if not base_spans(r.text) and r.doc_id != 7:
            assert got[r.doc_id] == r.text
    assert got[0] == "say [SECRET] and Token : \"abc\" then [SECRET]' end" and "AKIA1234567890AB" not in got[4] and got[5].startswith("é🎉 [SECRET] f[SECRET]") is False
    assert got[8] == "[SECRET]"


@pytest.mark.parametrize("bad", ["x9Kq2LmZ7vB4tR8wY1pN6sD3"])
def test_op4_learns_from_labels(spark, bad):
    rows = [f"the ordinary_words and identifiers stand here password={bad[i:]}{i}Zq81 thhationble" for i in range(12)]
    df = docs(spark, [*rows, f"unlabelled {bad[::-1]} stands alone"])
    assert "markov" in {r.doc_id: r.spans for r in secret_scan.digests(df).collect()}[12]


def test_op7_group_names_are_unambiguous(spark):
    """Null and empty languages, and names that look alike when joined, are groups of their own."""
    f = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), (None, ""), ("", None)], "lang string, source string")
    own = robust_quality._OWN.format("g_lang", "g_source")
    got = f.selectExpr(*own.split(", CASE")[:1], "CASE" + own.split(", CASE")[1]).selectExpr("concat('s:', length(g_lang), ':', g_lang, g_source) AS g").collect()
    assert len({r.g for r in got}) == 4
