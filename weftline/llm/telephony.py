"""Media columns: telephony audio.

mu-law and A-law bytes are expanded by lookup tables, IMA ADPCM blocks are decoded by numpy with all blocks of a batch side
by side (one step per sample of a block, not per block), and PCM is resampled by linear interpolation and stored as WAV.

`store_texts` is the lossless column store used by the query: a text's UTF-8 bytes, filled up with zero bytes to a positive
multiple of 64, become the 8-bit samples of a mu-law WAV file; the file is parsed again, and what it holds is digested and
decoded for the features.

Defined results: a null text is "" (64 zero samples); other columns are ignored; repeated rows give repeated results; a
text of any length is one file, worked on in slices of bounded size together with its neighbours.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the IMA ADPCM format: quantiser steps and step-index changes by code.
IMA_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143,
    157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552,
    1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487,
    12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], dtype=np.int32)
IMA_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8, -1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int32)

#: Bytes of a payload's unit, which is one ADPCM block too.
UNIT = 64
#: WAV format tags.
PCM, ALAW, MULAW = 1, 6, 7
#: Payload bytes decoded at once.
SLICE = 1 << 20


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code & 0x70) >> 4)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, mantissa = (code & 0x70) >> 4, (code & 0x0F) << 4
    size = np.where(exponent == 0, mantissa + 8, (mantissa + 0x108) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


_MULAW, _ALAW = mulaw_table(), alaw_table()


def adpcm_decode(blocks: np.ndarray) -> np.ndarray:
    """blocks: uint8, one row a block (int16 predictor, step index, a reserved byte, two codes a byte, low one first).
    Returns int16 samples, one row a block: the predictor and one for each code."""
    n, width = blocks.shape
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.int32)
    data = np.ascontiguousarray(blocks[:, 4:].T)
    codes = np.stack([data & 15, data >> 4], axis=1).reshape(2 * (width - 4), n)
    out = np.empty((1 + len(codes), n), dtype=np.int16)
    out[0] = value
    for k, code in enumerate(codes, 1):
        step = IMA_STEPS[index]
        change = step >> 3
        change += np.where(code & 4, step, 0)
        change += np.where(code & 2, step >> 1, 0)
        change += np.where(code & 1, step >> 2, 0)
        value += np.where(code & 8, -change, change)
        np.clip(value, -32768, 32767, out=value)
        index += IMA_MOVES[code]
        np.clip(index, 0, 88, out=index)
        out[k] = value
    return out.T


def adpcm_encode(samples: np.ndarray) -> np.ndarray:
    """int16 samples, one row a block, to blocks (the first sample is the predictor, step index 0)."""
    n, width = samples.shape
    value, index = samples[:, 0].astype(np.int32), np.zeros(n, dtype=np.int32)
    codes = np.zeros((width - 1, n), dtype=np.uint8)
    for k in range(1, width):
        step = IMA_STEPS[index]
        gap = samples[:, k].astype(np.int32) - value
        code = np.minimum((np.abs(gap) << 2) // step, 7)
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(value + np.where(gap < 0, -change, change), -32768, 32767)
        code = code + 8 * (gap < 0)
        index = np.clip(index + IMA_MOVES[code], 0, 88)
        codes[k - 1] = code
    out = np.zeros((n, 4 + (width - 1) // 2), dtype=np.uint8)
    out[:, :2] = samples[:, :1].astype("<i2").view(np.uint8).reshape(n, 2)
    out[:, 4:] = (codes[0::2] | codes[1::2] << 4).T
    return out


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation of int16 samples, in integers."""
    n = len(pcm) * to // rate
    at = np.arange(n, dtype=np.int64) * rate
    low, part = at // to, at % to
    high = np.minimum(low + 1, len(pcm) - 1)
    return ((pcm[low].astype(np.int64) * (to - part) + pcm[high].astype(np.int64) * part) // to).astype(np.int16)


def wav(data: bytes, tag: int, rate: int, bits: int) -> bytes:
    """A mono WAV file."""
    width = bits // 8
    fmt = struct.pack("<HHIIHHH", tag, 1, rate, rate * width, width, bits, 0)
    fact = struct.pack("<4sII", b"fact", 4, len(data) // width)
    body = b"WAVE" + struct.pack("<4sI", b"fmt ", len(fmt)) + fmt + fact + struct.pack("<4sI", b"data", len(data)) + data
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def wav_data(file: bytes) -> tuple[int, int, memoryview]:
    """Format tag, rate and sample bytes of a WAV file."""
    view = memoryview(file)
    if view[:4] != b"RIFF" or view[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, tag, rate = 12, 0, 0
    while at < len(view):
        name, size = struct.unpack_from("<4sI", view, at)
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", view, at + 8)
        elif name == b"data":
            return tag, rate, view[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no samples")


def decode(file: bytes) -> tuple[int, np.ndarray]:
    """Rate and int16 samples of a mu-law, A-law or 16-bit PCM file."""
    tag, rate, data = wav_data(file)
    if tag == PCM:
        return rate, np.frombuffer(data, dtype="<i2")
    return rate, {MULAW: _MULAW, ALAW: _ALAW}[tag][np.frombuffer(data, dtype=np.uint8)]


def to_pcm(file: bytes, rate: int = 16000) -> bytes:
    """The file as resampled 16-bit PCM."""
    own, samples = decode(file)
    return wav(resample(samples, own, rate).astype("<i2").tobytes(), PCM, rate, 16)


def _features(payloads: list[memoryview]) -> list[str]:
    """Of each payload: peak, energy and zero crossings as mu-law; energy as A-law; energy and final values as ADPCM blocks; a checksum of the resampled PCM."""
    flat = np.frombuffer(b"".join(payloads), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in payloads])
    starts = ends - [len(p) for p in payloads]
    mu, a = _MULAW[flat].astype(np.int64), _ALAW[flat].astype(np.int64)
    peak = np.maximum.reduceat(np.abs(mu), starts)
    mu2, a2 = np.add.reduceat(mu * mu, starts), np.add.reduceat(a * a, starts)
    sign = mu < 0
    cross = np.empty(len(flat), dtype=np.int64)
    cross[0], cross[1:] = 0, sign[1:] != sign[:-1]
    cross[starts] = 0
    crossings = np.add.reduceat(cross, starts)
    ima = adpcm_decode(flat.reshape(-1, UNIT)).astype(np.int64)
    blocks = starts // UNIT
    ima2, last = np.add.reduceat((ima * ima).sum(axis=1), blocks), np.add.reduceat(ima[:, -1], blocks)
    out = []
    for k, (s, e) in enumerate(zip(starts, ends, strict=True)):
        pcm = resample(mu[s:e].astype(np.int16), 8000, 16000)
        out.append(f"mulaw:{peak[k]}:{mu2[k]}:{crossings[k]};alaw:{a2[k]};adpcm:{ima2[k]}:{last[k]};pcm16k:{len(pcm)}:{zlib.crc32(pcm.astype('<i2').tobytes())}")
    return out


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
                    ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def encode_text(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text without filling, and its mu-law file."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    payload = raw + bytes(-len(raw) % UNIT or (0 if raw else UNIT))
    return len(raw), wav(payload, MULAW, 8000, 8)


def decode_text(file: bytes, n_bytes: int) -> str:
    return bytes(wav_data(file)[2][:n_bytes]).decode("utf-8", "surrogatepass")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held, files = [], 0, []
        ids = batch.column(0).to_pylist()

        def flush():
            data = [wav_data(f)[2] for _, _, f in files]
            for (doc, n, f), d, feature in zip(files, data, _features(data), strict=True):
                rows.append((doc, n, len(d), hashlib.sha256(d).hexdigest(), zlib.crc32(d[-UNIT:]), len(f), hashlib.sha256(f).hexdigest(), feature))
            files.clear()

        for k, doc in enumerate(ids):
            files.append((doc, *encode_text(batch.column(1)[k].as_py())))
            held += len(files[-1][2])
            if held >= SLICE:
                flush()
                held = 0
        if files:
            flush()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def store_texts(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. Digests of the stored and reread media of each row."""
    types = {pa.int64(): "long", pa.string(): "string"}
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_digests, ", ".join(f"{f.name} {types[f.type]}" for f in SCHEMA))


def media(docs: DataFrame, rate: int = 16000) -> DataFrame:
    """The files themselves: doc_id, n_bytes, media (mu-law WAV), pcm (resampled WAV)."""

    def files(batches):
        for b in batches:
            made = [encode_text(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_bytes": pa.array([n for n, _ in made], pa.int64()), "media": [f for _, f in made], "pcm": pa.array([to_pcm(f, rate) for _, f in made], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(files, "doc_id long, n_bytes long, media binary, pcm binary")
