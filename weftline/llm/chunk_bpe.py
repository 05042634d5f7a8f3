"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 16 bytes cuts each text where the hash's low bits are zero, so equal passages give equal
chunks wherever they stand. A chunk is encoded when a worker first meets it, between its first and its last separator (a space
or a line feed), and reused where it comes again, in the same or another document. At a join of two chunks the text from the
last whole word of the one to the first whole word of the other is encoded again, and the ids of these two words must be those
that the chunks have; where they aren't, the window is widened by more words on both sides until they agree, and at last to the
whole text. A chunk without a whole word between separators belongs to the join, which reaches over it. A chunk that is encoded
gets the ids of its words from a bounded store of words, as the tokenizer treats each apart; the joins check just that.

The chunk store of a worker is bounded (bytes); what falls out is encoded again when it comes again. Chunks are not shared over
the cluster: README gives the share of repeated chunks and what finding them by a shuffle costs.

Defined results: a null text is ""; repeated rows give repeated results; texts of any length are cut into chunks; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One cut in so many bytes on average; bytes of a worker's chunk store; words of its word store; bytes of text worked on at once.
MEAN_CHUNK, STORE_BYTES, STORE_WORDS, SLICE = 1024, 48 << 20, 500_000, 2 << 20
# Steps of a tokenizer for which a word of letters is one unit of the model, apart from punctuation after it.
UNITS = {
    "normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
#: A word of letters with punctuation after it (no apostrophe, which some units hold); a word of letters that NFC leaves as they are.
_ENDED = re.compile(r"([A-Za-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")
_LETTERS = re.compile(r"[A-Za-zß-öø-ÿ]+")
#: The byte-level alphabet: printable Latin-1 stands for itself, the other bytes, in order, for U+0100 and on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in _PRINTED)}
#: The byte of each letter of that alphabet.
LETTER_BYTES = {chr(ALPHABET.get(b, b)): b for b in range(256)}
_rng = np.random.Generator(np.random.PCG64(20))
_GEAR = _rng.integers(0, 1 << 32, 256, dtype=np.uint32)


class Store(dict):
    """A bounded store of two generations: what isn't used while one fills up falls out."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held, self.old = limit, 0, {}

    def add(self, key, value, size: int = 1) -> None:
        if self.held + size > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        self.held += size

    def __missing__(self, key):
        return self.old.get(key)


def cuts(data: bytes, mean: int = MEAN_CHUNK) -> list[int]:
    """Ends of the chunks of UTF-8 text: where the rolling hash of 16 bytes has low bits zero, moved up to the end of a character."""
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for k in (1, 2, 4, 8):  # doubles the width of the hash's window
        h[k:] += h[:-k] << np.uint32(k)
    at = np.flatnonzero((h >> np.uint32(8)) & np.uint32(mean - 1) == 0) + 1
    out = []
    for a in at.tolist():
        while a < len(data) and data[a] & 0xC0 == 0x80:
            a += 1
        out.append(a)
    if not out or out[-1] != len(data):
        out.append(len(data))
    return out


class Chunk(NamedTuple):
    """Text before the first separator; after it up to the last one: text, ids, decoded text; text after that."""

    head: str
    middle: str
    ids: bytes
    decoded: bytes
    tail: str


def words_at(text: str, n: int, last: bool) -> str:
    """The last (or first) n words of the text with what stands between them, up to its end (from its start)."""
    at = len(text) if last else 0
    for _ in range(n):
        if last:
            at = len(text[:at].rstrip(" \n"))
            at = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at)) + 1
        else:
            at += len(text[at:]) - len(text[at:].lstrip(" \n"))
            ends = [k for k in (text.find(" ", at), text.find("\n", at)) if k >= 0]
            at = min(ends, default=len(text))
    return text[at:] if last else text[:at]


class ChunkEncoder:
    """Ids (little-endian uint32) and decoded text of documents, as the tokenizer at path gives them without special tokens added."""

    def __init__(self, path: str, mean: int = MEAN_CHUNK):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder") is not None or spec["model"]["type"] != "BPE":
            raise ValueError("a word BPE without decoder is needed: its tokens are joined by spaces")
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.vocab = [b""] * (1 + max(vocab.values()))
        for t, i in vocab.items():
            self.vocab[i] = t.encode() + b" "
        self.mean, self.chunks, self.words = mean, Store(STORE_BYTES), {"": b""}
        steps = {k: (spec.get(k) or {}).get(many, []) for k, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))}
        self.units = {k: [x["type"] for x in v] for k, v in steps.items()} == {k: UNITS[k] for k in steps} and steps["pre_tokenizer"][0]["pattern"] == {"Regex": UNITS["pattern"]}
        self.encoded = self.reused = self.repaired = self.widened = 0

    def shown(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that begin and end at separators, from the words' ids; words that aren't known are encoded together."""
        if len(self.words) > STORE_WORDS:
            self.words = {"": b""}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        missing = set().union(*split) - self.words.keys()
        ended = {}
        if self.units:
            ended = {w: m.groups() for w in missing if (m := _ENDED.fullmatch(w))}
            missing = {*(missing - ended.keys()), *[x for pair in ended.values() for x in pair]} - self.words.keys()
        if self.units:
            letters, model = [w for w in missing if _LETTERS.fullmatch(w)], self.tok.model
            for w in letters:
                unit = w.lower() if w.isascii() else w.lower().encode().decode("latin-1").translate(ALPHABET)
                self.words[w] = array("I", [x.id for x in model.tokenize(unit)]).tobytes()
            missing -= set(letters)
        new = list(missing)
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            self.words.update(zip(part, [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(part, add_special_tokens=False)], strict=True))
        self.words.update({w: self.words[x] + self.words[y] for w, (x, y) in ended.items()})
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def split(self, data: bytes) -> list[bytes]:
        out, a = [], 0
        for b in cuts(data, self.mean):
            out.append(data[a:b])
            a = b
        return out

    def learn(self, pieces: list[bytes]) -> dict[bytes, Chunk]:
        """The chunks of the pieces; those not in the store are encoded together."""
        known: dict[bytes, Chunk] = {}
        new, parts = [], []
        for piece in dict.fromkeys(pieces):
            found = self.chunks[piece]
            if found is not None:
                known[piece] = found
                if piece not in self.chunks:
                    self.chunks.add(piece, found, 3 * len(piece) + 300)
                continue
            text = piece.decode("utf-8", "surrogatepass")
            a = min((k for k in (text.find(" "), text.find("\n")) if k >= 0), default=-1)
            z = max(text.rfind(" "), text.rfind("\n"))
            middle = text[a + 1 : z + 1] if a >= 0 else ""
            if middle.strip(" \n"):
                new.append(piece)
                parts.append((text[:a + 1], middle, text[z + 1 :]))
            else:
                known[piece] = Chunk(text, "", b"", b"", "")
        self.reused += len(pieces) - len(new)
        self.encoded += len(new)
        for piece, (head, middle, tail), ids in zip(new, parts, self.ids_of([m for _, m, _ in parts]), strict=True):
            known[piece] = made = Chunk(head, middle, ids, self.shown(array("I", ids).tolist()), tail)
            self.chunks.add(piece, made, 3 * len(piece) + 300)
        return known

    def joins(self, asked: list[tuple[Chunk | None, str, Chunk | None]]) -> list[tuple[bytes, bytes] | None]:
        """For each (chunk, open text, chunk): ids and decoded text of what lies between the chunks' middles, or None where no window agrees."""
        out: list[tuple[bytes, bytes] | None] = [None] * len(asked)
        left, n = list(range(len(asked))), 1
        while left:
            windows = [(words_at(a.middle, n, True) if a else "", words_at(b.middle, n, False) if b else "") for a, _, b in (asked[k] for k in left)]
            texts = [x + asked[k][1] + y for k, (x, y) in zip(left, windows, strict=True)]
            open_ones = []
            for k, (x, y), text, e in zip(left, windows, texts, self.tok.encode_batch(texts, add_special_tokens=False), strict=True):
                a, _, b = asked[k]
                ids, spans = e.ids, e.offsets
                i, j, size = 0, len(ids), len(text) - len(y)
                while i < j and spans[i][1] <= len(x):
                    i += 1
                while j > i and spans[j - 1][0] >= size:
                    j -= 1
                sure = (a.ids if a else b"").endswith(array("I", ids[:i]).tobytes()) and (b.ids if b else b"").startswith(array("I", ids[j:]).tobytes())
                if sure and (not a or i) and (not b or j < len(ids)):
                    out[k] = (array("I", ids[i:j]).tobytes(), self.shown(ids[i:j]))
                elif (a and x != a.middle) or (b and y != b.middle):
                    open_ones.append(k)
            self.repaired += len(left)
            self.widened += len(open_ones)
            left, n = open_ones, 4 * n
        return out

    def encode_all(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        pieces = [self.split(t) for t in texts]
        known = self.learn([p for some in pieces for p in some])
        asked: list[tuple[Chunk | None, str, Chunk | None]] = []
        plans: list[list[Chunk]] = []
        for some in pieces:
            before, open_text, plan = None, "", []
            for piece in some:
                chunk = known[piece]
                open_text += chunk.head
                if chunk.middle:
                    asked.append((before, open_text, chunk))
                    plan.append(chunk)
                    before, open_text = chunk, chunk.tail
            asked.append((before, open_text, None))
            plans.append(plan)
        made, at, out = self.joins(asked), 0, []
        for data, plan in zip(texts, plans, strict=True):
            joins = made[at : at + len(plan) + 1]
            at += len(plan) + 1
            if None in joins:  # no window agreed: the whole text
                ids = self.tok.encode(data.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
                out.append((array("I", ids).tobytes(), self.shown(ids)[:-1]))
                continue
            parts = [joins[0], *[x for c, j in zip(plan, joins[1:], strict=True) for x in ((c.ids, c.decoded), j)]]
            out.append((b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])[:-1]))
        return out

    def encode(self, data: bytes) -> tuple[bytes, bytes]:
        return self.encode_all([data])[0]


_encoders: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, mean: int = MEAN_CHUNK) -> ChunkEncoder:
    """The worker's own."""
    if (path, mean) not in _encoders:
        _encoders[path, mean] = ChunkEncoder(path, mean)
    return _encoders[path, mean]


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= SLICE:
            yield part
            part, held = [], 0
    if part:
        yield part


def _over_texts(docs: DataFrame, path: str, mean: int, row: Callable, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """doc_id and row(ids, decoded) of each text; schema and kinds: of row's values."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, mean)
        for b in batches:
            at = 0
            for part in _slices(_texts(b.column(1))):
                columns = zip(*[row(ids, decoded) for ids, decoded in enc.encode_all(part)], strict=True)
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0)[at : at + len(part)]} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})
                at += len(part)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {schema}")


def encode(docs: DataFrame, path: str, mean: int = MEAN_CHUNK) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, ids (binary, little-endian uint32), decoded (string)."""
    return _over_texts(docs, path, mean, lambda ids, decoded: (ids, decoded.decode()), "ids binary, decoded string", [pa.binary(), pa.string()])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded: doc_id, ids. Returns doc_id, decoded as the tokenizer's decode(ids, skip_special_tokens=False)."""

    def run(batches):
        enc = encoder(path)
        for b in batches:
            rows = [enc.shown(np.frombuffer(x or b"", dtype="<u4").tolist())[:-1].decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "decoded": pa.array(rows, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digests(docs: DataFrame, path: str, mean: int = MEAN_CHUNK) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encode(), taken where the ids are made."""
    row = lambda ids, decoded: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
    return _over_texts(docs, path, mean, row, "n_tokens long, ids_sha256 string, decoded_sha256 string", [pa.int64(), pa.string(), pa.string()])
