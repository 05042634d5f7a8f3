"""Line dedup by a deletion-neighbourhood join.

Lines of at least MIN_WORDS words are compared; a line is dropped when an earlier one (by doc_id, then place) is equal or
within one edit of a character (insertion, deletion or substitution). Equal lines meet on a hash. Of the lines that are left,
those that share a half with another line of a fitting length can have a neighbour at all (an edit leaves one half as it
was); of these, those that share all but one of PARTS parts; and only these emit their deletion neighbourhood as hashed keys: the line itself, the line less each character, and
the line less each character together with the place. A line equal to another one less a character is one insertion away;
lines equal but for the character at the same place are one substitution away; so the members of a key need no comparing
among each other, only their earliest. The earliest partner of each line is then verified by its edit distance.

Keys are aggregated before they are joined, so a line that stands in many documents, or many lines with one neighbour, cost
a row each, never pairs.

That is the default, which the SQL of op3_line_dedup states. Two arguments widen it: exact_words, the words of a line that is
compared for equality (1: every line that is not blank), and per, the characters for each of which a line is allowed one more edit
(a pair has the bound of its shorter line, one edit at least). Within a bound of k edits the shorter line, of n characters, has a
run of (n - k) / (k + 1) characters that stands in the other unbroken and at most k places away. The grams winnowed from both
(the least hash of each window of a run) then agree in one at least, so lines meet on grams, and pairs whose lengths and places
fit are verified by their edit distance: none within the bound is lost. Pairs are as many as lines that share a gram at a place.

Defined results: a null text has no lines; white space at a line's ends is not compared; null doc_id comes last; rows with
equal doc_id and text are dropped or kept alike; lines of fewer words always stay (under MIN_WORDS: unless they are equal and
exact_words says so); other columns stay untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm import grid
from weftline.llm.common import drop_written, written

MIN_WORDS, EDITS, PARTS = 5, 1, 16
_SPACE = " \t\n\x0b\x0c\r"
#: Characters worked on at once.
SLICE = 1 << 19
#: Of the 64 bits of a winnowed gram, those that hold its place; lines a task remembers to have cut into grams.
_PLACE_BITS, SEEN = 28, 1 << 18


def bound(n: int, per: int | None) -> int:
    """Edits allowed to a line of n characters."""
    return max(EDITS, n // per) if per else EDITS


def eligible(text: str | None, words: int = MIN_WORDS) -> list[tuple[int, str]]:
    """Places and texts of the lines that are compared."""
    out = []
    for k, line in enumerate((text or "").split("\n")):
        line = line.strip(_SPACE)
        if len(line) > 2 * words - 2 and len(line.encode().split()) >= words:
            out.append((k, line))
    return out


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixed codes of all characters, starts and ends of the lines."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(x) for x in lines], dtype=np.int64)
    return grid.mixed(codes + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1), ends - [len(x) for x in lines], ends


def _part_keys(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, parts: int) -> np.ndarray:
    """Keys of each line less one of its parts, with the parts as of its own length and as of one less: 2 * parts columns."""
    size, keys = ends - starts, []
    for less in (0, 1):
        n = size - less
        tag = n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(parts):
            before, after = n * k // parts, n - n * (k + 1) // parts
            both = grid.spans(codes, starts, starts + before) * np.uint64(0x9E3779B97F4A7C15) + grid.spans(codes, ends - after, ends)
            keys.append(grid.mixed(both + tag + np.uint64(k)))
    return np.stack(keys, axis=1)


def line_keys(lines: list[str], parts: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each line, and its keys less a part."""
    codes, starts, ends = _codes(lines)
    return grid.spans(codes, starts, ends), _part_keys(codes, starts, ends, parts)


def neighbourhood(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all variants: (index of the line, kind, key); kinds: 0 whole, 1 less a character, 2 less a character at that place."""
    codes, starts, ends = _codes(lines)
    n, size = len(codes), ends - starts
    owner = np.repeat(np.arange(len(lines)), size)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * grid.powers(grid._BASE, n), out=sums[1:])
    inverse = grid.powers(grid._INVERSE, n + 2)
    at = np.arange(n)
    s, e = starts[owner], ends[owner]
    # What follows the deleted character moves down by one place.
    rest = (sums[at] - sums[s]) * inverse[s] + (sums[e] - sums[at + 1]) * inverse[s + 1]
    less = grid.mixed(rest + (size[owner] - 1).astype(np.uint64))
    placed = grid.mixed(less + (at - s).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))
    whole = grid.spans(codes, starts, ends)
    lines_at = np.arange(len(lines))
    return np.concatenate([lines_at, owner, owner]), np.repeat(np.array([0, 1, 2], dtype=np.int8), [len(lines), n, n]), np.concatenate([whole, less, placed])


def gram_sizes(per: int) -> tuple[int, int]:
    """Characters of a gram, and grams of a window, so that a pair within its bound (of two edits or more) shares a whole window."""
    # n // per = k: the shortest such lines have k * per characters; the run grows with k.
    run = -((2 - 2 * per) // 3)
    gram = max(1, run // 2)
    return gram, run - gram + 1


def grams(lines: list[str], per: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed grams of the lines (of 2 * per characters or more): index of the line, place in it, key."""
    gram, window = gram_sizes(per)
    codes, starts, ends = _codes(lines)
    at = np.arange(len(codes) - gram + 1)
    key = grid.spans(codes, at, at + gram) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)
    least, size = key | (np.uint64((1 << _PLACE_BITS) - 1) - at.astype(np.uint64)), 1  # of equal ones the last
    while 2 * size <= window:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < window:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    inside = ends - starts - (gram + window - 1) + 1
    owner = np.repeat(np.arange(len(lines)), inside)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(inside) - inside, inside) + starts[owner]
    got = least[first]
    new = np.ones(len(got), dtype=bool)
    new[1:] = (got[1:] != got[:-1]) | (owner[1:] != owner[:-1])
    got, owner = got[new], owner[new]
    place = (np.uint64((1 << _PLACE_BITS) - 1) - (got & np.uint64((1 << _PLACE_BITS) - 1))).astype(np.int64)
    return owner, place - starts[owner], (got >> np.uint64(_PLACE_BITS)).astype(np.int64)


def _fitting(key: np.ndarray, n: np.ndarray, at: np.ndarray, h: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different lines (hashes) with one key, whose lengths and places are within the bound of the shorter one. Sorted by key, n."""
    k, live, step, out = np.maximum(EDITS, n // per), np.arange(len(key)), 0, [np.zeros((2, 0), dtype=np.int64)]
    while len(live):
        step += 1
        live = live[live + step < len(key)]
        live = live[(key[live + step] == key[live]) & (n[live + step] - n[live] <= k[live])]
        good = live[(np.abs(at[live + step] - at[live]) <= k[live]) & (h[live + step] != h[live])]
        out.append(np.sort(np.stack([h[good], h[good + step]]), axis=0))
    a, b = np.unique(np.concatenate(out, axis=1), axis=1)
    return a, b


def _pairs(docs: DataFrame, per: int) -> DataFrame:
    """a, b: hashes of lines that may be within a bound of two edits or more, each pair once. docs: text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            todo, held, last = [], 0, b.num_rows - 1
            for k, text in enumerate(b.column(0)):
                for _, line in eligible(text.as_py()):
                    if len(line) >= 2 * per and (mark := hash(line)) not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(mark)
                        todo.append(line)
                        held += len(line)
                if todo and (held >= SLICE or k == last):
                    h, n = line_keys(todo)[0].astype(np.int64), np.array([len(x) for x in todo], dtype=np.int32)
                    owner, at, key = grams(todo, per)
                    yield pa.RecordBatch.from_pydict({"key": key, "n": n[owner], "at": at.astype(np.int32), "h": h[owner]})
                    todo, held = [], 0

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            got = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if held:
                got = [np.concatenate(x) for x in zip(held, got, strict=True)]
            whole = int(np.searchsorted(got[0], got[0][-1])) if len(got[0]) else 0
            held = [x[whole:] for x in got]
            if whole:
                x, y = _fitting(*[c[:whole] for c in got], per)
                yield pa.RecordBatch.from_pydict({"a": x, "b": y})
        if held:
            x, y = _fitting(*held, per)
            yield pa.RecordBatch.from_pydict({"a": x, "b": y})

    cuts = docs.select("text").mapInArrow(cut, "key long, n int, at int, h long")
    return cuts.repartition("key").sortWithinPartitions("key", "n").mapInArrow(meet, "a long, b long").distinct()


_KEY = "doc_id long, th long, line_no int"


def _lines(docs: DataFrame, exact_words: int) -> DataFrame:
    """A row for each line that is compared: doc_id, th (hash of the text), line_no, hash, halves (none under MIN_WORDS words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ths, held, rows = b.column(0).to_pylist(), b.column(1).to_pylist(), 0, []
            for k, text in enumerate(b.column(2)):
                for no, line in eligible(text.as_py(), exact_words):
                    rows.append((ids[k], ths[k], no, line))
                    held += len(line)
                if held >= SLICE or (k == len(ids) - 1 and rows):
                    h, halves = line_keys([r[3] for r in rows])
                    halves = halves.astype(np.int64).tolist()
                    if exact_words < MIN_WORDS:
                        halves = [x if len(r[3].encode().split()) >= MIN_WORDS else [] for x, r in zip(halves, rows, strict=True)]
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "th": pa.array([r[1] for r in rows], pa.int64()), "line_no": pa.array([r[2] for r in rows], pa.int32()), "hash": h.astype(np.int64), "halves": pa.array(halves, pa.list_(pa.int64()))})
                    held, rows = 0, []

    return docs.select("doc_id", "th", "text").mapInArrow(run, f"{_KEY}, hash long, halves array<long>")


def _squeezed(df: DataFrame) -> DataFrame:
    """df with its column text compressed, as z: what is shuffled."""
    names = [c for c in df.columns if c != "text"]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField("z", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            text = b.column(b.schema.get_field_index("text")).cast(pa.binary())
            packed = pa.array([None if x is None else z.compress(x) for x in text.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in names], packed], names=[*names, "z"])

    return df.mapInArrow(run, schema)


def _marked(found: DataFrame) -> DataFrame:
    """found: doc_id, th, z, line_nos. The texts of these lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for doc, th, packed, nos in zip(*[c.to_pylist() for c in b.columns], strict=True):
                want = set(nos)
                rows += [(doc, th, no, line) for no, line in eligible(z.decompress(packed).decode()) if no in want]
            if rows:
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(("doc_id", "th", "line_no", "line"), zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)})

    return found.select("doc_id", "th", "z", "line_nos").mapInArrow(run, f"{_KEY}, line string")


def _per_lines(lines: DataFrame, schema: str, make) -> DataFrame:
    """lines: doc_id, th, line_no, line; make(lines) gives (index of the line, columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, low = b.column(3).to_pylist(), 0
            while low < len(texts):
                high, held = low, 0
                while high < len(texts) and (high == low or held + len(texts[high]) < SLICE // 8):
                    held += len(texts[high])
                    high += 1
                owner, more = make(texts[low:high])
                at = pa.array(owner + low)
                yield pa.RecordBatch.from_pydict({n: b.column(k).take(at) for k, n in enumerate(("doc_id", "th", "line_no"))} | more)
                low = high

    return lines.select("doc_id", "th", "line_no", "line").mapInArrow(run, f"{_KEY}, {schema}")


def _fine_keys(lines: list[str]):
    keys = line_keys(lines, PARTS)[1]
    return np.repeat(np.arange(len(lines)), keys.shape[1]), {"key": keys.reshape(-1).astype(np.int64)}


def _variants(lines: list[str]):
    owner, kind, key = neighbourhood(lines)
    return owner, {"kind": kind, "key": key.astype(np.int64)}


def _place(prefix: str = "") -> Column:
    """Orders lines: doc_id (null last), place, text."""
    c = lambda x: F.col(prefix + x)
    return F.struct(c("doc_id").isNull().alias("late"), c("doc_id").alias("doc_id"), c("line_no").alias("line_no"), c("th").alias("th"))


def duplicates(docs: DataFrame, per: int | None = None, exact_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th, line_no, near (false: equal), first (place of the earliest partner) of the lines to be dropped. docs: doc_id, th, text.
    per: one more edit for each so many characters (None: EDITS always), 4 at least; exact_words: words of a line that is compared for equality."""
    if per is not None and per < 4 or not 1 <= exact_words <= MIN_WORDS:
        raise ValueError("per of 4 or more, exact_words from 1 to MIN_WORDS")
    old: list[str] = []
    lines = written(_lines(docs, exact_words), "lines", old).withColumn("place", _place())
    heads = lines.groupBy("hash").agg(F.min("place").alias("place"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("n"))
    heads = written(heads, "heads", old)
    repeated = heads.filter("n > 1").select("hash", F.col("place").alias("first"))
    exact = lines.select("hash", "place").hint("merge").join(repeated, "hash").filter("place <> first").select("place", F.lit(False).alias("near"), "first")
    exact = written(exact, "exact")
    # Distinct lines that share a half with another one.
    keys = heads.select("hash", F.explode("halves").alias("half"))
    met = keys.groupBy("half").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).filter("a <> b").select("half")
    able = keys.hint("merge").join(met, "half").select("hash").distinct()
    if per:
        pairs = written(_pairs(docs, per), "pairs", old)
        able = able.union(pairs.select("a")).union(pairs.select("b")).distinct()
        of = lambda c: heads.select(F.col("hash").alias(c), F.col("place").alias(f"place_{c}"))
        pairs = pairs.join(of("a"), "a").join(of("b"), "b").select(F.greatest("place_a", "place_b").alias("place"), F.least("place_a", "place_b").alias("first"))
        pairs = written(pairs, "placed")
    chosen = heads.join(able, "hash").groupBy("place.doc_id", "place.th").agg(F.collect_set("place.line_no").alias("line_nos"))
    chosen = written(chosen, "chosen").toDF("d", "t", "line_nos")
    drop_written(docs.sparkSession, old)
    texts = _squeezed(docs.select("doc_id", "th", "text"))
    found = texts.hint("merge").join(chosen, texts.doc_id.eqNullSafe(chosen.d) & (texts.th == chosen.t))
    marked = written(_marked(found).dropDuplicates(["doc_id", "th", "line_no"]), "marked")
    every = marked.select(_place().alias("place"), "line")
    # Of these, lines that share all but a small part.
    fine = _per_lines(marked, "key long", _fine_keys).select("key", _place().alias("place"))
    close = fine.groupBy("key").agg(F.min("place").alias("low"), F.max("place").alias("top")).filter("low <> top").select("key")
    close = fine.join(close, "key").select("place").distinct()
    marked = written(marked.withColumn("place", _place()).join(close, "place").select("doc_id", "th", "line_no", "line"), "close")
    variants = written(_per_lines(marked, "kind byte, key long", _variants), "variants").withColumn("place", _place())
    first = lambda k: F.min(F.when(F.col("kind") == k, F.col("place")))
    best = variants.groupBy("key").agg(first(0).alias("m0"), first(1).alias("m1"), first(2).alias("m2"), F.max("place").alias("top"), F.min("place").alias("low"))
    best = best.filter("top <> low").drop("top", "low")
    partner = F.when(F.col("kind") == 0, F.col("m1")).when(F.col("kind") == 1, F.col("m0")).otherwise(F.col("m2"))
    near = variants.join(best, "key").withColumn("first", partner).filter("first < place").groupBy("place").agg(F.min("first").alias("first"))
    shown = marked.select(_place().alias("place"), "line")
    near = near.join(shown, "place").join(shown.toDF("first", "other"), "first").filter(F.levenshtein("line", "other", EDITS) >= 0)
    near = near.select("place", "first")
    if per:
        wide = pairs.join(every, "place").join(every.toDF("first", "other"), "first")
        allowed = F.expr(f"CAST(greatest({EDITS}, least(length(line), length(other)) div {per}) AS INT)")
        wide = wide.withColumn("allowed", allowed).filter("levenshtein(line, other, allowed) >= 0")
        near = near.union(wide.select("place", "first")).groupBy("place").agg(F.min("first").alias("first"))
    # All repeats of a line that is dropped as near are exact repeats already.
    near = near.select("place", F.lit(True).alias("near"), "first")
    return exact.unionByName(near).select("place.doc_id", "place.th", "place.line_no", "near", "first")


def dedup(docs: DataFrame, per: int | None = None, exact_words: int = MIN_WORDS) -> DataFrame:
    """A row for each of docs: whole_row (its columns but text), exact_lines and near_lines (arrays of places), text (less these lines),
    n_lines (before)."""
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    gone = duplicates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), th.alias("th"), "text"), per, exact_words).groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.when(~F.col("near"), F.col("line_no")))).alias("exact_lines"), F.sort_array(F.collect_set(F.when(F.col("near"), F.col("line_no")))).alias("near_lines")
    )
    gone = gone.toDF("gone_doc", "gone_th", "exact_lines", "near_lines")
    rest = F.struct(*[docs[c] for c in docs.columns if c != "text"])
    whole = _squeezed(docs.select(rest.alias("whole_row"), F.col("doc_id").cast("long").alias("key_doc"), th.alias("key_th"), "text"))
    joined = whole.hint("merge").join(gone, whole.key_doc.eqNullSafe(gone.gone_doc) & (whole.key_th == gone.gone_th), "left")
    joined = joined.select("whole_row", "exact_lines", "near_lines", "z")
    lists = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("exact_lines", "near_lines")]
    schema = T.StructType([joined.schema["whole_row"], *lists, T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for low in range(0, b.num_rows, 500):
                part = b.slice(low, 500)
                texts, n = [], []
                exact, near = ([x or [] for x in part.column(k).to_pylist()] for k in (1, 2))
                for e, k, packed in zip(exact, near, part.column(3).to_pylist(), strict=True):
                    text = None if packed is None else z.decompress(packed)
                    n.append(0 if text is None else text.count(b"\n") + 1)
                    if e or k:
                        drop = {*e, *k}
                        text = b"\n".join([x for i, x in enumerate(text.split(b"\n")) if i not in drop])
                    texts.append(text)
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(exact, ints), pa.array(near, ints), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["whole_row", "exact_lines", "near_lines", "text", "n_lines"])

    return joined.mapInArrow(run, schema)


def kept(docs: DataFrame, per: int | None = None, exact_words: int = MIN_WORDS) -> DataFrame:
    """The rows of docs with what is left of their texts (n_chars follows, where there is such a column); rows all of whose text was dropped go."""
    found = dedup(docs, per, exact_words)
    changed = (F.size("exact_lines") > 0) | (F.size("near_lines") > 0)
    found = found.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("text")
        own = F.col("whole_row")[c]
        return F.when(changed, F.length("text")).otherwise(own) if c == "n_chars" else own

    return found.select(*[column(c).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def report(docs: DataFrame, per: int | None = None, exact_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, exact_lines, near_lines (comma-joined places of the dropped lines), text_sha256 of what is left."""
    found = dedup(docs.select("doc_id", "text"), per, exact_words)
    shown = lambda c: F.concat_ws(",", F.col(c).cast("array<string>")).alias(c)
    return found.select(F.col("whole_row")["doc_id"].alias("doc_id"), "n_lines", shown("exact_lines"), shown("near_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLE = r"""
WITH l AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS k, unnest(s) AS raw FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
e AS (SELECT doc_id, (k - 1)::INT AS no, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
x AS (SELECT * FROM e WHERE len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= 5),
h AS (SELECT line, min((doc_id, no)) AS first FROM x GROUP BY 1),
k AS (SELECT line, first, length(line) AS n FROM h),
b AS (SELECT *, unnest(['p' || (n // 2) || left(line, n // 2), 's' || (n - n // 2) || right(line, n - n // 2), 'p' || ((n - 1) // 2) || left(line, (n - 1) // 2), 's' || (n - 1 - (n - 1) // 2) || right(line, n - 1 - (n - 1) // 2)]) AS half FROM k),
near AS (SELECT DISTINCT a.first FROM b a JOIN b c ON a.half = c.half AND c.first < a.first AND abs(a.n - c.n) <= 1 AND levenshtein(a.line, c.line) <= 1),
d AS (SELECT x.doc_id, x.no, (x.doc_id, x.no) <> h.first AS exact FROM x JOIN h USING (line) WHERE (x.doc_id, x.no) <> h.first OR (x.doc_id, x.no) IN (SELECT first FROM near)),
g AS (SELECT doc_id, list(no) AS gone, coalesce(string_agg(no::VARCHAR, ',' ORDER BY no) FILTER (exact), '') AS exact_lines, coalesce(string_agg(no::VARCHAR, ',' ORDER BY no) FILTER (NOT exact), '') AS near_lines FROM d GROUP BY 1),
r AS (SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY k), '') AS t FROM l WHERE (doc_id, k - 1) NOT IN (SELECT (doc_id, no) FROM d) GROUP BY 1)
SELECT documents.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(exact_lines, '') AS exact_lines, coalesce(near_lines, '') AS near_lines, sha256(coalesce(t, '')) AS text_sha256
FROM documents LEFT JOIN g USING (doc_id) LEFT JOIN r USING (doc_id)
"""
