"""What several operators share: shipping the package, streamed groups, shares of rows, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources.shared import Scratch, stored

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can
    import it wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.join(tempfile.mkdtemp(prefix="tabloom-"), "tabloom-package.zip")
    with zipfile.ZipFile(package, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "tabloom")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, root))
    context.addPyFile(package)
    _SHIPPED.add(context.applicationId)


def mapped(df: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` with this package shipped to the workers."""
    ship(df.sparkSession)
    return df.mapInPandas(function, schema)


def arrow_mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package shipped to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of consecutive rows with equal ``keys`` from a partition sorted by them.

    Rows are plain tuples; a group may span batches. One group is in memory at a time.
    """
    at: list[int] = []

    def rows():
        for batch in batches:
            at[:] = [batch.columns.get_loc(k) for k in keys]
            yield from zip(*(batch[c].tolist() for c in batch.columns), strict=True)

    for key, members in groupby(rows(), key=lambda row: tuple(row[k] for k in at)):
        yield key, list(members)


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle whose rows Python workers read in groups."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(column: str, modulus: int) -> Column:
    """CRC-32 of the value as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def nonempty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def block_pairs(rows: DataFrame, keys: list[str], node: str, block: int) -> DataFrame:
    """Deal the members of every group to blocks of about ``block`` nodes, and every row to the
    tasks that compare its block with each block of its group: columns ``i`` <= ``j`` and ``own``.

    A group within the limit is one task; a group of any size becomes many bounded ones."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    dealt = rows.join(sizes, keys).withColumn("own", F.pmod(F.xxhash64(node), "_blocks").cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.withColumn("i", F.least("own", "_other")).withColumn("j", F.greatest("own", "_other")).drop("_other", "_blocks")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: ``node``, ``component`` (its smallest node).

    ``edges`` has two long columns ``a`` and ``b``; loops and repeats are allowed. Alternates the
    large-star and small-star steps, each a grouped minimum (combined before the shuffle) joined
    back, and stores every round in the shared folder, so lineage stays short and a lost executor
    costs a re-read; of these tables two exist at most. Nothing is collected but a count and a checksum per round. Rounds grow with
    the logarithm of the largest component. Isolated nodes are not in the result.
    """
    spark = edges.sparkSession
    links = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    held, before = None, None
    while True:
        with Scratch(spark, detached=True) as own:
            links = stored(links, "links")
        # The round before is read no more.
        if held is not None:
            held.close()
        held = own
        now = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before:
            break
        before = now
        both = links.union(links.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        links = (
            large.join(low, "a")
            .select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))))
            .where("a <> b")
            .distinct()
        )
    held.release()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())


class Forest:
    """Union-find over the few nodes of one task; remembers the edges that joined two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def root(self, node: int) -> int:
        self.parent.setdefault(node, node)
        while self.parent[node] != node:
            self.parent[node] = self.parent[self.parent[node]]
            node = self.parent[node]
        return node

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((a, b))
