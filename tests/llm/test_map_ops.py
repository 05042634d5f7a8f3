"""op2, op6: against the tokenizers library, round trips and plain decoders."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.data import DATA, TEXTS, docs
from weftline.llm import chunk_bpe, queries, telephony

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def want(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, dtype="<u4").tobytes(), tok.decode(ids, skip_special_tokens=False).encode()


def test_chunks_equal_whole_encoding(tok):
    for mean in (4, 64, 512):
        enc = chunk_bpe.ChunkEncoder(PATH, mean)
        for t in TEXTS * 2:
            assert enc.encode((t or "").encode()) == want(tok, t), t
        assert enc.repaired and enc.encoded and enc.reused
        if mean > 4:  # a long text is cut into chunks, and no join needed more than a word
            assert not enc.widened


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZzßéÈñö×÷ÿŸd't.,!-%&1", min_size=1, max_size=14))
def test_words_by_units_equal_the_library(word):
    enc = chunk_bpe.encoder(PATH, 4)
    assert enc.units
    enc.words = {"": b""}
    assert enc.ids_of([word])[0] == want(enc.tok, word)[0]


def test_joins_widen_until_they_agree(tok):
    """Chunks whose stored ids are wrong at an end aren't joined there: the window grows, at last to the whole text."""
    enc = chunk_bpe.ChunkEncoder(PATH, 64)
    text = " ".join(f"some words number {i} of many" for i in range(40))
    assert enc.encode(text.encode()) == want(tok, text)
    other = list(enc.chunks)[2]
    c = enc.chunks[other]
    dict.__setitem__(enc.chunks, other, c._replace(ids=c.ids[:-4] + b"\0\0\0\0"))
    assert enc.encode(text.encode()) == want(tok, text) and enc.widened


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n", max_size=30), st.integers(1, 5))
def test_words_at_an_end(text, n):
    words = text.replace("\n", " ").split()
    assert chunk_bpe.words_at(text, n, True).split() == words[max(0, len(words) - n) :] and text.endswith(chunk_bpe.words_at(text, n, True))
    assert chunk_bpe.words_at(text, n, False).split() == words[:n] and text.startswith(chunk_bpe.words_at(text, n, False))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sTé́ \n\t <|>1.ﬁΣ", max_size=80))
def test_chunks_equal_whole_encoding_of_any_text(text):
    tok = chunk_bpe.encoder(PATH, 4).tok
    assert chunk_bpe.encoder(PATH, 4).encode(text.encode()) == want(tok, text)


def test_cuts_depend_on_content_only():
    rng = np.random.default_rng(1)
    data = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    a, b = chunk_bpe.cuts(data, 64), chunk_bpe.cuts(b"prefix--" + data, 64)
    assert {x + 8 for x in a if x > 16} <= set(b) and 150 < len(a) < 600


def test_store_is_bounded():
    s = chunk_bpe.Store(10)
    for i in range(1000):
        s.add(i, i)
    assert len(s) + len(s.old) <= 20 and s[999] == 999 and s[3] is None


def test_op2_query_equals_library(spark, tok):
    rows = {r.doc_id: r for r in queries.op2_chunk_bpe(spark, DATA).collect()}
    texts = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for d in texts:
        ids, shown = want(tok, d.text)
        assert (rows[d.doc_id].n_tokens, rows[d.doc_id].ids_sha256, rows[d.doc_id].decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown).hexdigest())


def test_op2_hostile_rows(spark, tok):
    df = docs(spark)
    got = chunk_bpe.encode(df, PATH)
    assert sorted((r.ids, r.decoded.encode()) for r in map(lambda r: r, got.collect())) == sorted(want(tok, r.text) for r in df.select("text").collect())
    assert chunk_bpe.encode(df.limit(0), PATH).count() == 0
    both = got.join(chunk_bpe.decode(got, PATH).withColumnRenamed("decoded", "again"), "doc_id").collect()
    assert all(r.decoded == r.again for r in both)


def expand_mulaw(code):
    code = ~code & 0xFF
    sign, exponent, mantissa = code & 0x80, (code >> 4) & 7, code & 15
    size = ((mantissa * 2 + 33) << (exponent + 2)) - 132
    return -size if sign else size


def expand_alaw(code):
    code ^= 0x55
    sign, exponent, mantissa = code & 0x80, (code >> 4) & 7, code & 15
    size = (mantissa * 2 + 1) << 3 if exponent == 0 else (mantissa * 2 + 33) << (exponent + 2)
    return size if sign else -size


def plain_adpcm(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(telephony.IMA_STEPS[index])
            diff = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value + (-diff if code & 8 else diff)))
            index = max(0, min(88, index + int(telephony.IMA_MOVES[code])))
            out.append(value)
    return out


def test_tables_and_adpcm():
    assert telephony.mulaw_table().tolist() == [expand_mulaw(c) for c in range(256)]
    assert telephony.alaw_table().tolist() == [expand_alaw(c) for c in range(256)]
    blocks = np.random.default_rng(0).integers(0, 256, (40, 64), dtype=np.uint8)
    assert telephony.adpcm_decode(blocks).tolist() == [plain_adpcm(bytes(b)) for b in blocks]
    wave = (8000 * np.sin(np.arange(121 * 6) / 9)).astype(np.int16).reshape(6, 121)
    back = telephony.adpcm_decode(telephony.adpcm_encode(wave))
    assert back.shape == wave.shape and np.abs(back[:, 20:].astype(int) - wave[:, 20:]).mean() < 300


def test_resample_and_wav():
    x = np.arange(0, 8000, 10, dtype=np.int16)
    y = telephony.resample(x, 8000, 16000)
    assert len(y) == 1600 and y[::2].tolist() == x.tolist() and telephony.resample(x, 8000, 8000).tolist() == x.tolist()
    file = telephony.wav(bytes(range(256)), telephony.MULAW, 8000, 8)
    assert bytes(telephony.wav_data(file)[2]) == bytes(range(256))
    rate, pcm = telephony.decode(telephony.to_pcm(file))
    assert rate == 16000 and len(pcm) == 512 and pcm[::2].tolist() == telephony.mulaw_table().tolist()


def test_op6_hostile_rows(spark):
    df = docs(spark)
    got = telephony.store_texts(df).collect()
    plain = sorted(map(payload, [r.text for r in df.collect()]))
    assert sorted((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == plain
    by = {}
    for r in got:
        assert by.setdefault((r.n_bytes, r.payload_sha256), (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
    back = [telephony.decode_text(r.media, r.n_bytes) for r in telephony.media(df).collect()]
    assert sorted(back) == sorted(r.text or "" for r in df.collect())
    assert telephony.store_texts(df.limit(0)).count() == 0


def payload(text):
    raw = (text or "").encode()
    full = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
    return len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])


def test_op6_query(spark):
    got = queries.op6_telephony(spark, DATA).collect()
    want_rows = [(r.doc_id, *payload(r.text)) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == sorted(want_rows)
