"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Vectors of one label are dealt to blocks; every pair of blocks is a tile. A tile multiplies the
quantised vectors, adds to each product a bound on what the quantisation of both vectors can have
changed, and recomputes in double precision only the pairs that may reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import Forest, block_pairs, components, groups, mapped
from tabloom.sources.shared import stored

THRESHOLD = 0.98
BLOCK = 1024
#: Products of so many int8 pairs sum up exactly in single precision: 1024 * 127**2 < 2**24.
EXACT_DIMS = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale and error length of every row, so that |row - scale * values| <= error."""
    scale = np.abs(unit).max(axis=1) / 127
    values = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - values * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-12) + 1e-14
    return values.astype(np.int8), scale, error


def possible(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Index pairs of unit rows whose product may reach the threshold."""
    (qx, sx, ex), (qy, sy, ey) = quantised(x), quantised(y)
    product = np.zeros((len(x), len(y)))
    for at in range(0, x.shape[1], EXACT_DIMS):
        product += qx[:, at : at + EXACT_DIMS].astype(np.float32) @ qy[:, at : at + EXACT_DIMS].astype(np.float32).T
    # x = a + e, y = b + f: x.y - a.b = x.f + e.y - e.f, and x, y have length 1.
    bound = ex[:, None] + ey[None, :] + ex[:, None] * ey[None, :] + 1e-9
    return np.argwhere(product * sx[:, None] * sy[None, :] + bound >= threshold)


def tile_links(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """For every tile: links of each vector by weight, and a forest of the links."""
    for (_, _, i, j), rows in groups(batches, ["label", "dims", "i", "j"]):
        own, nodes = np.array([r[4] for r in rows]), np.array([r[5] for r in rows], np.int64)
        weight = np.array([r[6] for r in rows], np.int64)
        raw = np.array([np.asarray(r[7], np.float64) for r in rows])
        unit = raw / np.abs(raw).max(axis=1)[:, None]
        unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        counts, forest = np.zeros(len(rows), np.int64), Forest()
        if len(left) and len(right):
            pairs = possible(unit[left], unit[right], threshold)
            pairs = pairs[pairs[:, 0] < pairs[:, 1]] if i == j else pairs
            for at in range(0, len(pairs), 50_000):
                a, b = left[pairs[at : at + 50_000, 0]], right[pairs[at : at + 50_000, 1]]
                near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                a, b = a[near], b[near]
                np.add.at(counts, a, weight[b])
                np.add.at(counts, b, weight[a])
                for p, q in zip(nodes[a].tolist(), nodes[b].tolist(), strict=True):
                    forest.join(p, q)
        out = [(int(nodes[k]), int(counts[k]), None) for k in np.flatnonzero(counts)] + [(a, 0, b) for a, b in forest.edges]
        yield pd.DataFrame(out, columns=["node", "n", "peer"]).astype({"peer": "Int64"})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine
    in double precision reaches the threshold. Equal vectors of a label are compared once and count
    as copies that link. Null vectors, vectors with null, infinite or NaN components, zero vectors
    and rows with a null id link with nothing. Other columns are left behind.
    """
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(vector, lambda v: v != 0)
    rows = vectors.select("vec_id", "label", vector.alias("embedding"), F.coalesce(sound, F.lit(False)).alias("_sound"))
    usable = F.col("_sound") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # A key of its own for every row that links with nothing: nulls never meet in the join below.
    rows = rows.select("vec_id", F.when(usable, F.col("label")).alias("label"), F.when(usable, F.col("embedding")).alias("embedding"))
    classes = rows.where("label is not null").groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("dims", F.size("embedding")), "vectors")
    tiles = block_pairs(classes, ["label", "dims"], "node", block)
    tiles = tiles.select("label", "dims", "i", "j", "own", "node", "copies", "embedding")
    tiles = tiles.repartition("label", "dims", "i", "j").sortWithinPartitions("label", "dims", "i", "j", "node")
    found = stored(mapped(tiles, lambda batches: tile_links(batches, threshold), "node long, n long, peer long"), "found")
    linked = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    grouped = components(found.where("peer is not null").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    of_class = (
        classes.select("label", "embedding", "node", "copies")
        .join(linked, "node", "left")
        .join(grouped, "node", "left")
        .select(
            "label", "embedding",
            F.coalesce("component", "node").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        )
    )
    own = F.coalesce("component_id", "vec_id")
    return rows.join(of_class, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
