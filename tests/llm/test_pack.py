"""op10: ids against the tokenizers library, packing against its own rules."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.data import DATA, TEXTS, docs
from weftline.llm import mixture_pack as M
from weftline.llm import queries

TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
TOK.no_truncation()
TOK.no_padding()
PATH = P.path("byte_bpe_50k.json")


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_library():
    enc = M.encoder(PATH)
    for t in TEXTS * 2:
        assert np.frombuffer(enc.encode(t or ""), enc.dtype).tolist() == ids_of(t), t


def test_vocabulary_is_the_files():
    enc = M.encoder(PATH)
    assert M.PATTERN == P.PATTERN and enc.special == {"<|endoftext|>": 50256} and enc.enc.n_vocab == 50256 and enc.dtype == "<u2"
    with pytest.raises(ValueError):
        M.ByteBPE(P.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sTéÀ×ÿßñ \n\t\xa0\x1c\x85　<|>1.,²_\0", max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "a", "The", "\n", "it's"]), max_size=12).map("".join))
def test_ids_equal_library_on_any_text(text):
    enc = M.encoder(PATH)
    assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == ids_of(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=9), st.data())
def test_schedule_places_every_token_once(supply, data):
    targets = data.draw(st.none() | st.lists(st.integers(0, 50), min_size=len(supply), max_size=len(supply)))
    phases = M.schedule(supply, targets, 256)
    cutter = M.Cutter(phases, 256, 64)
    seen = np.zeros(sum(supply), dtype=int)
    for j, n in enumerate(supply):
        x = 0
        while x < n:
            part = min(n - x, data.draw(st.integers(1, 700)))
            for pos, length in cutter.runs(j, x, part):
                assert pos // 64 == (pos + length - 1) // 64
                seen[pos : pos + length] += 1
            x += part
    assert (seen == 1).all()


def test_windows_hold_target_shares_and_carry_deficits():
    supply, targets, window = [50_000, 20_000, 9_000, 333], [5, 3, 1, 1], 1000
    phases = M.schedule(supply, targets, window)
    first = phases[0]
    for k in range(1, first.count + 1):
        for j, w in enumerate(targets):
            assert abs(first.given(j, k, window) - k * window * w / 10) < len(targets)
    assert first.count == 3 and [p.weights for p in phases if p.quotas is None][1][3] == 0
    even = M.schedule(supply, None, window)
    assert sum(p.count for p in even) == -(-sum(supply) // window)


def test_tree_places_every_token_once_and_in_shares():
    for count, own, limit in ((40, 7, 8), (300, 3, 8), (5, 5, 8), (12, 0, 3)):
        supply = [2000 + 37 * k for k in range(count)]
        tree, window = M.Tree(supply, own, None, 4096, 64, limit), 4096
        seen, held = np.zeros(sum(supply), dtype=int), np.zeros((count, -(-sum(supply) // window)), dtype=int)
        for j, n in enumerate(supply):
            for x in range(0, n, 700):
                for pos, length in tree.runs(j, x, min(700, n - x)):
                    assert pos // 64 == (pos + length - 1) // 64
                    seen[pos : pos + length] += 1
                    held[j, pos // window] += length
        assert (seen == 1).all()
        if count == 40:  # each of 33 sources that share a queue has its share of each stretch of windows
            for a in range(0, held.shape[1] - 8, 4):
                want = 8 * window * np.array(supply) / sum(supply)
                assert (np.abs(held[:, a : a + 8].sum(axis=1) - want) <= want / 4 + 8).all()


def test_op10_targets_outside_the_largest(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_QUEUES", 4)
    rows = [(i, f"s{i % 9}", "some words to be packed " * (3 if i % 9 == 8 else 30)) for i in range(180)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = M.pack(df, PATH, targets={"s8": 1, "s0": 1}, with_ids=False, window=128, sequence=64).collect()
    assert sum(r.length for r in got if r.source == "s8" and r.sequence_id < 2) == 64


def check(rows, texts):
    """rows: pieces; texts: {doc_id: text}."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for d, text in texts.items():
        ids = np.array([*ids_of(text), 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    full = []
    for s in sorted(by_seq):
        at = 0
        for r in sorted(by_seq[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        full.append(at)
    assert sorted(by_seq) == list(range(len(by_seq))) and all(x == 1024 for x in full[:-1]) and 0 < full[-1] <= 1024


def test_op10_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op10_mixture_pack(spark, DATA).collect()
    assert {r.doc_id for r in rows} == set(texts)
    check(rows, texts)


def test_op10_windows_hold_the_tempered_shares(spark):
    """From the pieces alone: in every window as long as no source has run dry, each source has its share to within a token a source."""
    rows = queries.op10_mixture_pack(spark, DATA).collect()
    total, held, last = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in rows:
        w = r.sequence_id // 64
        total[r.source] += r.length
        held[w][r.source] += r.length
        last[r.source] = max(last[r.source], w)
    weights = {s: n**queries.TEMPER for s, n in total.items()}
    whole = min(last.values())
    assert whole >= 3 and max(total.values()) / sum(total.values()) > 1.1 * max(weights.values()) / sum(weights.values())
    for w in range(whole):
        for s, x in weights.items():
            assert abs(held[w][s] - 64 * 1024 * x / sum(weights.values())) <= len(weights) + 1, (w, s)


def test_op10_hostile_rows(spark):
    df = docs(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = M.pack(df, PATH)
    rows = got.collect()
    check(rows, {r.doc_id: r.text for r in df.collect()})
    assert all(len(r.ids) == 4 * r.length for r in rows)
    twice = M.pack(docs(spark), PATH, targets={"s1": 1}, with_ids=False).collect()
    assert sum(r.length for r in twice) == sum(len(ids_of(r.text)) + 1 for r in docs(spark).collect())
    assert M.pack(df.limit(0), PATH).count() == 0
