"""The pipeline against the brute-force versions of its stages, one after the other."""

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.data import SMALL
from tests.llm.test_native_text_ops import base_spans, brute_force
from tests.llm.test_pack import check
from tests.llm.test_pair_ops import dropped, linked
from weftline.llm import robust_quality


def masked(text, spans):
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    secret = F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit(" password=0123456789abcdef01 end"))).otherwise(F.col("text"))
    data = str(tmp_path)
    docs.withColumn("text", secret).write.parquet(f"{data}/documents.parquet")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{data}/documents.parquet/*.parquet')")
    want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({robust_quality.ORACLE}) WHERE kept").fetchall()}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, data).write.parquet(str(tmp_path / name))
        docs = frames[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
    got = {r.doc_id: r.text for r in frames["quality_rules"].collect()}
    assert got == {d: texts[d] for d in want}
    gone = dropped(sorted(got.items()))
    rest = {}
    for d, t in got.items():
        left = [x for k, x in enumerate(t.split("\n")) if (d, k) not in gone]
        if "".join(left).strip() or not any(g[0] == d for g in gone):
            rest[d] = "\n".join(left)
    got = {r.doc_id: r.text for r in frames["line_dedup"].collect()}
    assert got == rest
    stay = {d for _, d, c, _ in linked(sorted(got.items())) if c == d}
    got = {r.doc_id: r.text for r in frames["ngram_jaccard"].collect()}
    assert set(got) == stay
    shown = dict(zip(got, (s for _, s in brute_force(list(got.values()))), strict=True))
    clean = {d: masked(t, [tuple(map(int, s.split(":")[1:])) for s in shown[d].split(",") if s]) for d, t in got.items()}
    got = {r.doc_id: r.text for r in frames["secret_scan"].collect()}
    assert got == clean and any("[SECRET]" in t for t in got.values()) and not any(base_spans(t) for t in got.values())
    check(frames["packing"].collect(), got)
    again = corpus_pipeline.run(spark, data).collect()
    check(again, got)


def test_run_on_hostile_rows(spark, tmp_path):
    """Null ids, texts and sources, empty and very long texts, repeated rows, near copies, and columns named as results are."""
    words = [" ".join(f"w{(7 * i + k * (k % (i + 2))) % 900}" for k in range(80)) + "." for i in range(40)]
    rows = [(i, w, "en", f"s{i % 3}", len(w), "kept", 1) for i, w in enumerate(words)]
    rows += [(100, None, "en", "s0", None, "x", 1), (101, "", None, None, 0, "x", 1), (102, "word " * 40_000, "en", "s1", 200_000, "x", 1), (103, "\n" * 500, "de", "s1", 500, "x", 1)]
    rows += [rows[3], rows[3], (None, words[5], "en", "s2", 1, "x", 1), (None, None, None, None, None, None, None), (200, words[6] + " tail", "en", "s0", 1, "x", 1)]
    rows += [(201, words[7] + " token=abcdefgh12345678", "en", "s0", 1, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, length int")
    df.write.parquet(f"{tmp_path}/a/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    ids = [r.doc_id for r in got if r.start == 0]
    assert 100 not in ids and 102 not in ids and 200 not in ids and len(ids) > 20  # null, repeated words, near copy of 6
    assert 6 in ids and set(ids) <= set(range(40)) | {None, 201}
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    df.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
