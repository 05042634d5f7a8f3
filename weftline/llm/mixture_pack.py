"""Packing controlled by a mixture: deficit round-robin over source queues.

All tokens of a source form its queue. A window holds WINDOW tokens (a whole number of sequences); in each round every queue
is owed its target share of the window, gives the whole tokens it is owed and carries the rest (its deficit, under one token)
into the next window. The tokens that rounding leaves open go to the largest queue. As the deficits are carried exactly, what
a queue has given before window k is a closed form in k, so every partition finds the windows of its own documents without
talking to others: deficits are carried across partitions as across windows. When a queue runs dry, the window is filled up
from the other queues in order of what they are owed, and a new phase begins with the shares of those left. With no targets
given, a source's share goes with a power of its tokens; with that power 1 all queues run dry together.

Two passes: tokenize once and write the ids to the shared folder; sum tokens by source and partition (that is all that is
gathered: a row for each source) and cut. Sources that targets name have a queue of their own, and the largest up to
MAX_QUEUES - 1; all others share one, which is itself filled by deficit round-robin over them (see Tree), in windows of what
the shared queue is owed in a window, so their shares are exact in these and off by less than one such share in the others.

Defined results: a null text is "", and so one id 0; a null source is a source of its own; repeated rows are packed again;
no rows give no pieces; a document longer than a window is cut; other columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.chunk_bpe import LETTER_BYTES, Store
from weftline.llm.common import written

SEQUENCE, WINDOW, MAX_QUEUES, STORE_PIECES = 1024, 64 * 1024, 256, 600_000
#: The id after each document.
END = 0
#: White space other than space and line feed: texts that hold it are cut by the pattern below.
_ODD = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The tokenizer never joins what stands before and after such a place.
_EDGE = re.compile(r"(?<=\S)(?=\s)")


# Fixed value: how a byte-level BPE's regular expression cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBPE:
    """Ids as the tokenizers library gives them for a byte-level BPE, from its file: vocabulary, added tokens, steps. The merging itself
    is done by tiktoken, at a third of the library's CPU time on words; pieces are encoded once a worker, up to a bound."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        ranks = {bytes([LETTER_BYTES[c] for c in t]): i for t, i in model["vocab"].items() if set(t) <= LETTER_BYTES.keys()}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        ranks = {t: i for t, i in ranks.items() if i not in self.special.values()}
        # A pair's rank is the id of what it merges to; where the merges are in another order the ids would differ.
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = not spec.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")) or any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in spec.get("added_tokens", []))
        if not plain or odd or merged != sorted(merged):
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed, whose ids follow its merges")
        self.enc = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        last = max([*ranks.values(), *self.special.values()])
        #: Type code of an array of ids, the same as a numpy type.
        self.code, self.dtype = ("H", "<u2") if last < 1 << 16 else ("I", "<u4")
        self.known = Store(STORE_PIECES)

    def pieces(self, text: str) -> list[str]:
        """Pieces that can be encoded apart: white space stands only at their start."""
        if "\0" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or (_ODD.search(text) is not None):
            return _EDGE.split(text)
        return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")

    def encode(self, text: str) -> bytes:
        """Little-endian ids."""
        if self.parts is not None and self.parts.search(text):
            return b"".join([array(self.code, [self.special[x]]).tobytes() if x in self.special else self.encode_plain(x) for x in self.parts.split(text)])
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        pieces = self.pieces(text)
        got = list(map(self.known.get, pieces))
        if None in got:
            known, encode = self.known, self.enc.encode_ordinary
            for k, x in enumerate(got):
                if x is None:
                    p = pieces[k]
                    x = known[p]
                    if x is None:
                        x = array(self.code, encode(p)).tobytes()
                    if p not in known:
                        known.add(p, x)
                    got[k] = x
        return b"".join(got)


_encoders: dict[str, ByteBPE] = {}


def encoder(path: str) -> ByteBPE:
    """The process's own."""
    if path not in _encoders:
        _encoders[path] = ByteBPE(path)
    return _encoders[path]


@dataclass
class Phase:
    """Windows first .. first + count - 1. Queue j has given base[j] tokens before; by weights, or just quotas for one window."""

    first: int
    count: int
    base: list[int]
    weights: list[int]
    quotas: list[int] | None = None
    filler: int = 0
    total: int = field(init=False)

    def __post_init__(self):
        self.total = sum(self.weights)

    def given(self, j: int, k: int, window: int) -> int:
        """Tokens of queue j in the phase's first k windows."""
        if self.quotas is not None:
            return self.quotas[j] * min(k, 1)
        if j != self.filler:
            return k * window * self.weights[j] // self.total
        return k * window - sum(k * window * w // self.total for i, w in enumerate(self.weights) if i != j)


def schedule(supply: list[int], targets: list[int] | None = None, window: int = WINDOW) -> list[Phase]:
    """Phases that use up all queues; targets: integer weights of the queues (None: their supply)."""
    targets = list(targets) if targets and any(targets) else list(supply)
    left, given, at, out = list(supply), [0] * len(supply), 0, []
    while sum(left) > 0:
        weights = [w if n else 0 for w, n in zip(targets, left, strict=True)]
        if not any(weights):
            weights = list(left)
        filler = max(range(len(left)), key=lambda j: (weights[j], -j))
        phase = Phase(at, 0, list(given), weights, None, filler)
        low, high = 0, sum(left) // window
        fits = lambda k: all(0 <= phase.given(j, k, window) <= left[j] for j in range(len(left)))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if fits(mid) else (low, mid - 1)
        if low:
            phase.count = low
            out.append(phase)
            for j in range(len(left)):
                n = phase.given(j, low, window)
                left[j] -= n
                given[j] += n
            at += low
        if sum(left) == 0:
            break
        # A window in which a queue runs dry: what it owes is taken from the others.
        size, quotas = min(window, sum(left)), [0] * len(left)
        owed = [low * window * w / phase.total + size * w / phase.total for w in weights]
        owed = [o - phase.given(j, low, window) for j, o in enumerate(owed)]
        for j in range(len(left)):
            quotas[j] = min(left[j], max(0, int(owed[j])))
        for j in sorted(range(len(left)), key=lambda j: (quotas[j] - owed[j], j)):
            more = min(left[j] - quotas[j], size - sum(quotas))
            quotas[j] += max(0, more)
        over = sum(quotas) - size
        for j in range(len(left)):
            cut = min(max(over, 0), quotas[j])
            quotas[j] -= cut
            over -= cut
        out.append(Phase(at, 1, list(given), weights, quotas))
        for j in range(len(left)):
            left[j] -= quotas[j]
            given[j] += quotas[j]
        at += 1
    return out


class Cutter:
    """Places tokens of queues in the packed stream."""

    def __init__(self, phases: list[Phase], window: int = WINDOW, sequence: int = SEQUENCE):
        self.phases, self.window, self.sequence = phases, window, sequence
        n = len(phases[0].base) if phases else 0
        self.starts = [[p.base[j] for p in phases] for j in range(n)]
        self.ahead: dict[tuple[int, int], list[int]] = {}

    def _ahead(self, at: int, k: int) -> list[int]:
        """Where the share of each queue begins in the phase's window k."""
        if (at, k) not in self.ahead:
            if len(self.ahead) > 4096:
                self.ahead.clear()
            p, pos, out = self.phases[at], 0, []
            for j in range(len(p.base)):
                out.append(pos)
                pos += p.given(j, k + 1, self.window) - p.given(j, k, self.window)
            self.ahead[at, k] = out
        return self.ahead[at, k]

    def runs(self, j: int, x: int, n: int) -> Iterator[tuple[int, int]]:
        """(place in the packed stream, length) of tokens x .. x + n - 1 of queue j, cut at windows' shares and sequences."""
        while n:
            at = bisect.bisect_right(self.starts[j], x) - 1
            p = self.phases[at]
            y, low, high = x - p.base[j], 0, p.count - 1
            if p.quotas is None and p.weights[j]:  # near the answer, then exactly
                guess = min(high, y * p.total // (self.window * p.weights[j]))
                slack = 2 + len(p.base) * p.total // (self.window * p.weights[j])
                low, high = max(0, guess - slack), min(high, guess + slack)
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if p.given(j, mid, self.window) <= y else (low, mid - 1)
            here = p.given(j, low, self.window)
            size = min(n, p.given(j, low + 1, self.window) - here - (y - here))
            pos = (p.first + low) * self.window + self._ahead(at, low)[j] + (y - here)
            x, n = x + size, n - size
            while size:
                part = min(size, self.sequence - pos % self.sequence)
                yield pos, part
                pos, size = pos + part, size - part


class Tree:
    """Places tokens of any number of queues: the first `own` have a queue each, the others share one (after them), dealt out
    by deficit round-robin in turn, in groups where they are more than MAX_QUEUES. targets: of all queues (None: their supply)."""

    def __init__(self, supply: list[int], own: int, targets: list[int] | None = None, window: int = WINDOW, sequence: int = SEQUENCE, limit: int = MAX_QUEUES):
        weights = list(targets or supply)
        self.own, rest, want = own, supply[own:], weights[own:]
        self.size = max(1, -(-len(rest) // limit))
        part = lambda x: [x[k : k + self.size] for k in range(0, len(rest), self.size)]
        groups, wants = part(rest), part(want)
        shared, share = sum(rest), sum(want) / max(1, sum(weights))
        more = [shared] if rest else []
        self.outer = Cutter(schedule(supply[:own] + more, weights[:own] + ([sum(want)] if rest else []), window), window, sequence)
        self.inner, self.groups = None, []
        if shared:
            inside = max(1, int(window * (share or shared / sum(supply))))
            self.inner = Cutter(schedule([sum(g) for g in groups], [sum(w) for w in wants], inside), inside, inside)
            if self.size > 1:
                for g, w in zip(groups, wants, strict=True):
                    size = max(1, int(inside * (sum(w) / max(1, sum(want)) or sum(g) / shared)))
                    self.groups.append(Tree(g, 0 if len(g) > limit else len(g), w, size, size, limit))

    def runs(self, j: int, x: int, n: int) -> Iterator[tuple[int, int]]:
        """(place, length) of tokens x .. x + n - 1 of queue j, as Cutter.runs."""
        if j < self.own:
            yield from self.outer.runs(j, x, n)
            return
        g, k = divmod(j - self.own, self.size)
        for at, size in self.groups[g].runs(k, x, n) if self.groups else [(x, n)]:
            for pos, length in self.inner.runs(g, at, size):
                yield from self.outer.runs(self.own, pos, length)


def _tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, source, part, off (tokens of the source before, in this partition), n, ids (of the encoder's type)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, seen = encoder(path), TaskContext.get().partitionId(), {}
        end = array(enc.code, [END]).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                ids, off, n = [enc.encode(t) + end if t else end for t in b.column(2).to_pylist()], [], []
                for source, x in zip(b.column(1).to_pylist(), ids, strict=True):
                    n.append(len(x) // len(end))
                    off.append(seen.get(source, 0))
                    seen[source] = off[-1] + n[-1]
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "source": b.column(1), "part": pa.array([part] * len(n), pa.int64()), "off": pa.array(off, pa.int64()), "n": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").mapInArrow(run, "doc_id long, source string, part long, off long, n long, ids binary")


def tempered(supply: list[int], temper: float) -> list[int]:
    """Integer weights in proportion to supply ** temper."""
    return list(supply) if temper == 1 else [round(1000 * n**temper) for n in supply]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids binary"


def pack(docs: DataFrame, path: str, targets: dict[str, int] | None = None, temper: float = 1.0, with_ids: bool = True, window: int = WINDOW, sequence: int = SEQUENCE) -> DataFrame:
    """docs: doc_id, source, text; path: a tokenizer's file. targets: weights of sources (others 0: they come once the others are
    used up); without targets a source's weight is its tokens to the power of temper (1: the corpus's own shares, 0: equal ones).
    Returns the pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, and with_ids the ids (little-endian uint32)."""
    dtype = encoder(path).dtype
    tokens = written(_tokenized(docs, path), "tokens")
    by_part = written(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "by-part")
    sizes = by_part.groupBy("source").agg(F.sum("n").alias("n")).collect()
    named = lambda r: targets is not None and targets.get(r.source, 0) > 0
    sizes.sort(key=lambda r: (not named(r), -r.n, r.source is not None, r.source or ""))
    own = min(len(sizes), max(MAX_QUEUES - 1, sum(map(named, sizes))))
    weights = tempered([r.n for r in sizes], temper) if targets is None else [targets.get(r.source, 0) for r in sizes]
    tree = Tree([r.n for r in sizes], own, weights, window, sequence)
    number = tokens.sparkSession.createDataFrame([(r.source, k) for k, r in enumerate(sizes)], "numbered string, queue int")
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.join(F.broadcast(number), by_part.source.eqNullSafe(number.numbered))
    bases = written(bases.select("source", "part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    bases = bases.select(F.col("source").alias("s"), F.col("part").alias("p"), "queue", "base")
    placed = tokens.join(bases, tokens.source.eqNullSafe(bases.s) & (tokens.part == bases.p)).select(
        "doc_id", "source", "queue", (F.col("base") + F.col("off")).alias("x"), "ids"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b, rows = batch.slice(at, 500), []
                for doc, source, j, x, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    ids = np.frombuffer(data, dtype=dtype).astype("<u4").tobytes()
                    n, start = len(ids) // 4, 0
                    for pos, length in tree.runs(j, x, n):
                        piece = ids[4 * start : 4 * (start + length)]
                        rows.append((doc, start, length, zlib.crc32(piece), n, pos // sequence, pos % sequence, source, piece if with_ids else None))
                        start += length
                if rows:
                    yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows, strict=True), kinds, strict=True)})

    out = placed.mapInArrow(run, PIECES)
    return out if with_ids else out.drop("ids")
