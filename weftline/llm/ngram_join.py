"""N-gram Jaccard join by MinHash banding.

Texts become sets of hashed word 5-grams (a shorter text with words: its words as one). Equal sets are copies and go on as one
node. Band and row numbers are chosen for a target recall at the threshold, and nodes are shuffled on band hashes. The pairs of
a bucket are verified on their full n-gram sets; a pair that shares several bands belongs to the first of them, so it is counted
once, and a bucket whose nodes all share an earlier band has no pairs of its own and is left out before any text moves. A large
bucket is split into pairs of blocks of bounded size, and no pair is ever a row: a task returns for each node the documents it
is linked to and the least node it is connected with. These give the number of links and, joined over tasks, the classes. Work
follows the pairs that share a band, not the groups into which such pairs chain.

Defined results: a null text is ""; a text without words has no links and a class of its own; repeated rows are copies;
class_id is the least doc_id of the class (null where all are null); other columns are ignored by link(), and
representatives() keeps them untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import grid
from weftline.llm.common import components, drop_written, written

WORDS, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.9999, 256
#: Nodes and 5-grams of a block, expected numbers; bytes of text verified at once.
BLOCK_NODES, BLOCK_GRAMS, SLICE = 1024, 1_000_000, 4 << 20
#: Pairs are compared one by one up to this share of a block pair, else all at once.
SPARSE = 0.01


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, with which pairs at the threshold share a band with the recall asked for."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def gram_sets(texts: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """Sorted sets of hashed word n-grams."""
    h, doc = grid.words(texts)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    grams = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
    for k in range(n):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k]
    grams = grid.mixed(grams)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(np.frombuffer(hashlib.blake2b(h[a:b].tobytes(), digest_size=8).digest(), dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def node_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """int64, a row for each set (none empty)."""
    rng = np.random.Generator(np.random.PCG64(5))
    factors = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.zeros((bands, len(sets)), dtype=np.uint64)
    for k, f in enumerate(factors):
        low = np.minimum.reduceat(flat * f, starts)
        out[k // rows] = grid.mixed(out[k // rows] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(k // rows))
    return out.T.astype(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, node (null where there are no words), n (5-grams), bands, at (a hash of the text, to find it again)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in grid.slices(_texts(b.column(1))):
                sets = gram_sets(part)
                full = [s for s in sets if len(s)]
                found = iter(band_hashes(full, bands, rows).tolist() if full else [])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column(0)[at : at + len(part)], "node": pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                    "n": pa.array([len(s) for s in sets], pa.int64()), "bands": pa.array([next(found) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    "at": b.column(2)[at : at + len(part)],
                })

    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("at"))
    return placed.mapInArrow(run, "doc_id long, node binary, n long, bands array<long>, at long")


def _compare(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs with Jaccard similarity at the threshold or over, from exact intersection counts."""
    n = len(left)
    sizes = np.array([len(s) for s in left + right])
    grams, at = np.unique(np.concatenate(left + right), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    count = np.bincount(at, minlength=len(grams))
    keep = count[at] > 1  # what one set alone has adds nothing
    owner, at = owner[keep], at[keep]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    _, at = np.unique(at, return_inverse=True)
    common = np.zeros((n, len(right)), dtype=np.float64)
    width = 4096
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [low, low + width])
        x = np.zeros((len(sizes), width), dtype=np.float32)
        x[owner[a:b], at[a:b] - low] = 1
        common += x[:n] @ x[n:].T
    return common >= threshold * (sizes[:n, None] + sizes[None, n:] - common) - 1e-9


def _close(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (x, y) of sets have the similarity, one by one."""
    out = np.zeros(len(x), dtype=bool)
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        a, b = sets[i], sets[j]
        both = np.concatenate([a, b])
        both.sort()
        common = np.count_nonzero(both[1:] == both[:-1])
        out[k] = common >= threshold * (len(both) - common) - 1e-9
    return out


def _pairs(left: np.ndarray, right: np.ndarray, band: int, bands: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Similar pairs of one bucket, between two blocks or (left is right) within one: those that share no earlier band."""
    size = np.array([len(s) for s in sets])
    a, b = size[left][:, None], size[right][None, :]
    own = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
    if left is right:
        own = np.triu(own, 1)
    for k in range(band):
        own &= bands[left, k][:, None] != bands[right, k][None, :]
    x, y = np.nonzero(own)
    if len(x) <= max(64, SPARSE * own.size):
        x, y = left[x], right[y]
        same = _close(sets, x, y, threshold)
        return x[same], y[same]
    rows, cols = np.unique(x), np.unique(y)
    same = own[np.ix_(rows, cols)] & _compare([sets[i] for i in left[rows]], [sets[j] for j in right[cols]], threshold)
    x, y = np.nonzero(same)
    return left[rows[x]], right[cols[y]]


def _labels(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least of the places connected with each."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _verified(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Whole groups (hash, pa, pb) of rows in order: id, root and links of the nodes with links in them."""
    nodes = rows.drop_duplicates("id").sort_values("id", ignore_index=True)
    sets = [s for at, part in grid.slices([x.encode() for x in nodes.text]) for s in gram_sets(part)]
    true = [node_of(s) == k for s, k in zip(sets, nodes.node, strict=True)]  # a text found by an equal hash would not be the node's
    nodes = nodes.assign(true=true)
    bands = np.array(nodes.bands.tolist(), dtype=np.int64)
    place = np.searchsorted(nodes.id.to_numpy(), rows.id.to_numpy())
    h, a, b, block, band = (rows[c].to_numpy() for c in ("hash", "pa", "pb", "block", "band"))
    cut = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    ok = nodes.true.to_numpy()
    xs, ys = [], []
    for low, high in zip(cut.tolist(), [*cut[1:].tolist(), len(rows)], strict=True):
        at, on = place[low:high], block[low:high]
        at, on = at[ok[at]], on[ok[at]]
        left = np.unique(at[on == a[low]])
        right = left if a[low] == b[low] else np.unique(at[on == b[low]])
        if len(left) and len(right):
            x, y = _pairs(left, right, int(band[low]), bands, sets, threshold)
            xs.append(x)
            ys.append(y)
    x, y = (np.concatenate(k) if k else np.zeros(0, dtype=np.int64) for k in (xs, ys))
    copies, n = nodes.copies.to_numpy(dtype=np.float64), len(nodes)
    links = np.bincount(x, weights=copies[y], minlength=n) + np.bincount(y, weights=copies[x], minlength=n)
    linked = np.flatnonzero(links > 0)
    ids = nodes.id.to_numpy()
    return pd.DataFrame({"id": ids[linked], "root": ids[_labels(n, x, y)][linked], "links": links[linked].round().astype("int64")})


def _verify(threshold: float):
    """Over rows in order of their groups: whole groups are verified together, about SLICE bytes of text at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += sum(map(len, frame.text))
            if size >= SLICE:
                rows = pd.concat(held, ignore_index=True)
                last = rows.iloc[-1]
                open_group = (rows["hash"] == last["hash"]) & (rows.pa == last.pa) & (rows.pb == last.pb)
                if not open_group.all():
                    yield _verified(rows[~open_group].reset_index(drop=True), threshold)
                held = [rows[open_group]]
                size = sum(map(len, held[0].text))
        if held and sum(map(len, held)):
            yield _verified(pd.concat(held, ignore_index=True), threshold)

    return run


def _texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, at, text; of rows with a null doc_id one for each text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    nameless = texts.filter("doc_id IS NULL").groupBy("doc_id", "at").agg(F.min("text").alias("text"))
    return texts.filter("doc_id IS NOT NULL").unionAll(nameless)


def link(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block_nodes: int = BLOCK_NODES, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """doc_id, class_id, n_links: the other documents that share a band and have the similarity or more, copies counted."""
    n_bands, n_rows = choose_bands(threshold, recall)
    spark, done = docs.sparkSession, []
    own = written(signatures(docs, n_bands, n_rows), "signatures")
    nodes = written(
        own.filter("node is not null").groupBy("node")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("node", F.col("first.doc_id").alias("first"), F.col("first.at").alias("at"), "copies", "n", "bands")
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    # The same joins at every size: merge joins, whose hot keys Spark can split.
    keys = nodes.select("id", F.posexplode("bands").alias("band", "hash"))
    shared = keys.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least <> most").select("hash")
    seats = written(keys.hint("merge").join(shared, "hash"), "seats", done)
    full = seats.hint("merge").join(nodes.select("id", "n", "bands"), "id")
    same = F.array(*[F.min(F.get("bands", F.lit(k))) == F.max(F.get("bands", F.lit(k))) for k in range(n_bands)])
    sizes = full.groupBy("hash").agg(F.min("band").alias("of"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("grams"), same.alias("same"))
    sizes = sizes.filter(~F.exists(F.slice("same", F.lit(1), F.col("of")), lambda x: x))  # else all share an earlier band
    blocks = F.ceil(F.greatest(F.col("k") / block_nodes, F.col("grams") / block_grams)).cast("int")
    dealt = written(seats.hint("merge").join(sizes.select("hash", blocks.alias("blocks")), "hash"), "dealt", done)
    found = nodes.hint("merge").join(dealt.select("id").distinct(), "id").hint("merge").join(
        _texts_of(docs).withColumnsRenamed({"doc_id": "d", "at": "t"}), F.col("first").eqNullSafe(F.col("d")) & (F.col("at") == F.col("t"))
    ).select("id", "node", "copies", "bands", "text")
    placed = dealt.hint("merge").join(found, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("hash", "band", F.least("block", "other").alias("pa"), F.greatest("block", "other").alias("pb"), "block", "id", "node", "copies", "bands", "text")
    placed = placed.repartition("hash", "pa", "pb").sortWithinPartitions("hash", "pa", "pb")
    checked = written(placed.mapInPandas(_verify(threshold), "id long, root long, links long"), "checked", done)
    links = checked.groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    joined = nodes.select("id", "node", "first", "copies").join(classes, "id", "left").withColumn("root", F.coalesce("root", "id"))
    heads = joined.groupBy("root").agg(F.min("first").alias("class_id"))
    info = written(joined.join(heads, "root").join(links, "id", "left").select("node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    drop_written(spark, done)
    out = own.select("doc_id", "node").join(info, "node", "left")
    alone = F.col("node").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the least of its class; rows with a null doc_id stay."""
    gone = written(link(docs).filter("doc_id <> class_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
