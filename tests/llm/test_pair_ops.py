"""op3, op8: against DuckDB and brute force, and on hostile rows."""

import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.data import DATA, TEXTS, WORDS, docs
from tests.oracle import differ
from weftline.llm import grid, line_dedup, ngram_join, queries

WS = "[\x20\x09-\x0d]+"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_word_hashes():
    texts = [x.encode() for x in ("The the  THE\tcafé\x0bCAFÉ café", "", " ", "a b", "b a", "x" * 3000)]
    h, d = grid.words(texts)
    words = [(i, w) for i, t in enumerate(texts) for w in t.lower().split()]
    assert d.tolist() == [i for i, _ in words]
    assert len(set(zip(h.tolist(), [w for _, w in words], strict=True))) == len({w for _, w in words}) == len(set(h.tolist()))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abé", min_size=1, max_size=7), st.text(alphabet="abé", min_size=1, max_size=7))
def test_neighbourhood_is_exact(a, b):
    owner, kind, key = line_dedup.neighbourhood([a, b])
    of = lambda who, k: set(key[(owner == who) & (kind == k)].tolist())
    met = bool(of(0, 0) & of(1, 1) or of(0, 1) & of(1, 0) or of(0, 2) & of(1, 2) or of(0, 0) & of(1, 0))
    assert met == (distance(a, b) <= 1)
    _, halves = line_dedup.line_keys([a, b])
    if distance(a, b) <= 1:
        assert set(halves[0].tolist()) & set(halves[1].tolist())


def dropped(rows):
    """Brute force: (row, place) -> near, over rows (doc_id, text) in any order."""
    lines = []
    for doc, text in rows:
        for k, x in enumerate((text or "").split("\n")):
            x = x.strip(" \t\n\x0b\x0c\r")
            if len([w for w in re.split(WS, x) if w]) >= 5:
                lines.append(((doc is None, doc or 0, k), (doc, k), x))
    out = {}
    for place, key, x in lines:
        earlier = [y for p, _, y in lines if p < place]
        if x in earlier:
            out[key] = False
        elif any(abs(len(x) - len(y)) < 2 and distance(x, y) < 2 for y in earlier):
            out[key] = True
    return out


LINES = ["the of and onnd ererly thhat", "the of and onnd ererly thhaat", "the of and onnd ererly that", "the of and onnd erErly thhat", "a short one", "a short one", "the of and onnd ererly thhat zz"]


def test_op3_rows(spark):
    texts = ["\n".join(LINES), LINES[2] + "  \nother words are standing here now\n" + LINES[0], None, "", "x\n" + LINES[1] + "é", LINES[0], *TEXTS, LINES[0][1:], "q" + LINES[0], LINES[6] + "\n\n" + "ünïcode wörds äre ïn thïs lïne", "ünicode wörds äre ïn thïs lïne"]
    df = docs(spark, texts).dropDuplicates(["doc_id", "text"])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = dropped(rows)
    got = {r.doc_id: r for r in line_dedup.report(df).collect()}
    assert len(got) == len(rows)
    for doc, _ in rows:
        for near, shown in ((False, got[doc].exact_lines), (True, got[doc].near_lines)):
            assert shown == ",".join(str(k) for (d, k), n in sorted(want.items(), key=lambda x: x[0][1]) if d == doc and n == near), (doc, near)
    stay = line_dedup.kept(df)
    assert stay.columns == df.columns
    left = {r.doc_id: r for r in stay.collect()}
    for doc, text in rows:
        gone = {k for d, k in want if d == doc}
        rest = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        if gone and not rest.strip():
            assert doc not in left
        else:
            assert left[doc].text == rest and (not gone or left[doc].n_chars == len(rest))
    assert line_dedup.report(df.limit(0)).count() == 0 and line_dedup.kept(df.limit(0)).count() == 0
    twice = docs(spark, [LINES[0], "b"])
    assert line_dedup.report(twice.unionAll(twice)).count() == 2 * twice.count()


def dropped_scaled(rows, per):
    """Brute force: all equal lines, and near ones of five words or more within an edit for each per characters."""
    lines = [((doc is None, doc or 0, k), (doc, k), x.strip(" \t\n\x0b\x0c\r")) for doc, text in rows for k, x in enumerate((text or "").split("\n"))]
    lines = [(p, key, x, len([w for w in re.split(WS, x) if w]) >= 5) for p, key, x in lines if x]
    out = {}
    for place, key, x, long in lines:
        earlier = [(y, far) for p, _, y, far in lines if p < place]
        if any(x == y for y, _ in earlier):
            out[key] = False
        elif long and any(far and distance(x, y) <= max(1, min(len(x), len(y)) // per) for y, far in earlier if abs(len(x) - len(y)) <= len(x) // per + 1):
            out[key] = True
    return out


def test_op3_scaled_rows(spark):
    rng = np.random.default_rng(3)
    texts = ["Short line\nno\nthe of and onnd ererly", "no\nShort line\n\n \nthe of nd onnd ererly", "a short onx\na short one"]
    for n in (8, 14, 24):
        base = " ".join(WORDS[k] + str(k % 7) for k in rng.integers(0, 10, n))
        texts.append(base)
        for edits in (1, 2, 3, 4, 5, 6, 8, 10):
            x = list(base)
            for at in rng.choice(len(base) - 12, edits, replace=False):
                x[at] = ("", "#", x[at] + "+")[rng.integers(0, 3)]
            texts.append("".join(x))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for per in (12, 20, 64):
        want = dropped_scaled(list(enumerate(texts)), per)
        got = {r.doc_id: r for r in line_dedup.report(df, per=per, exact_words=1).collect()}
        for doc in range(len(texts)):
            for near, shown in ((False, got[doc].exact_lines), (True, got[doc].near_lines)):
                assert shown == ",".join(str(k) for (d, k), n in sorted(want.items()) if d == doc and n == near), (per, doc, near)
    assert want[1, 0] is False and want[1, 1] is False and (2, 1) not in want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=40, max_size=90), min_size=1, max_size=4), st.integers(0, 9999), st.integers(5, 20))
def test_grams_meet_within_the_bound(lines, seed, per):
    rng, x = np.random.default_rng(seed), lines[-1]
    y = list(x)
    for at in rng.choice(len(x), line_dedup.bound(len(x) - len(x) // per, per), replace=False):
        y[at] = ("", "c", y[at] + "c")[rng.integers(0, 3)]
    y = "".join(y)
    k = line_dedup.bound(min(len(x), len(y)), per)
    if k < 2 or distance(x, y) > k:
        return
    owner, at, key = line_dedup.grams([*lines, y], per)
    a, b = ({(p, h) for o, p, h in zip(owner.tolist(), at.tolist(), key.tolist(), strict=True) if o == i} for i in (len(lines) - 1, len(lines)))
    assert any(h == g and abs(p - q) <= k for p, h in a for q, g in b)


def test_op3_query(spark):
    assert differ(spark, queries.op3_line_dedup, queries.ORACLE["op3_line_dedup"], DATA) == ""


def gram_set(text):
    words = [w for w in re.split(WS, low(text)) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def linked(rows):
    """Brute force: doc_id -> (class_id, n_links)."""
    sets = [(d, gram_set(t)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(sets)
    by_gram = defaultdict(set)
    for i, (_, s) in enumerate(sets):
        for g in s:
            by_gram[g].add(i)
    for i, (_, s) in enumerate(sets):
        for j in {j for g in s for j in by_gram[g] if j > i}:
            t = sets[j][1]
            n = len(s & t)
            if n >= 0.8 * (len(s) + len(t) - n):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted((d is None, d or 0, least.get(find(i)) if s or d is not None else None, n) for (i, (d, s)), n in zip(enumerate(sets), links, strict=True))


def shown(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.class_id, r.n_links) for r in df.collect())


def near_copies(n, words=120, seed=0):
    rng = np.random.default_rng(seed)
    base = [WORDS[k] + str(k % 7) for k in rng.integers(0, 10, words)]
    out = []
    for _ in range(n):
        x = list(base)
        for k in rng.integers(0, words, rng.integers(0, 4)):
            x[k] = f"new{rng.integers(0, 9)}"
        out.append(" ".join(x))
    return out


def test_bands_meet_recall():
    bands, rows = ngram_join.choose_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 256
    assert ngram_join.choose_bands(0.5, 0.99, 64)[1] >= 1


def test_op8_rows(spark):
    texts = TEXTS + near_copies(60) + ["alone but with five words"] * 3 + ["Alone BUT with\nfive  words"] + near_copies(5, 30, 1)
    df = docs(spark, texts)
    want = linked([(r.doc_id, r.text) for r in df.collect()])
    assert shown(ngram_join.link(df)) == want
    assert shown(ngram_join.link(df, block_nodes=7)) == want  # a group over many block pairs
    stay = ngram_join.representatives(df)
    assert stay.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stay.collect()) == sorted((late, d) for late, d, c, _ in want if late or d == c)
    assert ngram_join.link(df.limit(0)).count() == 0
    assert ngram_join.link(docs(spark, [None, "", "a", "b", "c", " "])).count() == 8


def test_op8_nameless_rows_and_equal_ids(spark):
    """Rows without doc_id are linked like others, also where nothing else has their text; one doc_id may stand for several texts."""
    a, b, c = near_copies(3, 200, 3)
    rows = [(1, a), (None, b), (None, b), (None, c), (2, c), (2, "of other words " * 20), (3, c), (3, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert shown(ngram_join.link(df)) == linked(rows)
    assert shown(ngram_join.link(df.filter("doc_id IS NULL"))) == linked([r for r in rows if r[0] is None])
    many = near_copies(400, 90, 5)
    df = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string").repartition(5)
    assert shown(ngram_join.link(df, block_nodes=50)) == linked(list(enumerate(many)))


def test_op8_recall_of_few_bands(spark):
    """With bands for a low recall what is found is a part of the links, and at least the share asked for."""
    rows = [(k, t) for seed in range(40) for k, t in zip(range(seed * 3, seed * 3 + 3), near_copies(3, 60, seed), strict=True)]
    want = sum(n for _, _, _, n in linked(rows))
    got = sum(n for _, _, _, n in shown(ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.9)))
    assert 0.9 * want <= got <= want


def test_op8_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert shown(queries.op8_ngram_join(spark, DATA)) == linked(rows)
