"""Shared pieces of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space and U+0009 to U+000D: what parts words.
WS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only a local session, whose executors are its driver,
    gets a fresh one where that is unset; a cluster must name its own."""
    conf = spark.sparkContext.getConf()
    base = spark.conf.get("spark.checkpoint.dir", conf.get("spark.checkpoint.dir", "")) or ""
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='weftline-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame, name: str, keep: list[str] | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors. Its path is added to keep."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables of written() that no later job reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    paths.clear()


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, no other letter touched."""
    return F.translate(c, UPPER, UPPER.lower())


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b. Connected components as node, root (the least node), one row for each node that has an edge.

    First each node's lesser neighbours are tied to the least of them, which leaves about an edge a node however many there were.
    Labels then run to the least along edges and along labels (pointer jumping), until a round changes nothing; each round is a
    table in the shared folder. Nothing is collected but the number of changes."""
    spark, old = edges.sparkSession, []
    first = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", old)
    least = first.groupBy("a").agg(F.min("b").alias("m"))
    tied = first.hint("merge").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    rest: list[str] = []
    tied = written(tied.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "tied", rest)  # read twice below
    drop_written(spark, old)
    both = written(tied.unionAll(tied.select("b", "a")), "both", rest)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels", old)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        over = labels.select(F.col("node").alias("r"), F.col("root").alias("over"))
        moved = labels.join(near, labels.node == near.a, "left").join(over, labels.root == over.r, "left")
        best = F.least("root", "near", "over")  # nulls are passed over
        done: list[str] = []
        new = written(moved.select("node", best.alias("root"), (best < F.col("root")).alias("moved")), "labels", done)
        changed = new.filter("moved").limit(1).count()
        drop_written(spark, old)
        labels, old = new.select("node", "root"), done
        if not changed:
            drop_written(spark, rest)
            return labels
