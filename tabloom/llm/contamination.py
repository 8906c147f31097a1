"""Benchmark decontamination: size-partitioned MinHash containment search.

Items fall into classes by the number of their shingles, a power of two each. An item's sketch is
its bottom-k MinHash: the ``k = floor((1 - threshold) * size) + 1`` smallest shingle hashes. A text
that holds at least the threshold's share of the item misses fewer than ``k`` of its shingles, so
it holds at least one of the sketch: no match is lost. A document probes a class only if it is
large enough to hold an item of that class, and only with its own hashes below the class's largest
sketch value. Candidates are then verified on all shingles of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import mapped
from tabloom.llm.hashing import set_key, shingles

THRESHOLD = 0.8
#: Largest number of item shingles (8 bytes each) that is broadcast; larger sets are joined.
BROADCAST_SHINGLES = 4_000_000
MATCHES = "doc_id long, item_id long, containment double"


def shingle_sets(table: DataFrame, key: str) -> DataFrame:
    """``id``, ``own``, ``size`` and one row per distinct shingle of every row with words and an id.

    ``own`` tells the texts of one id apart: it is a hash of the row's shingles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
                found = shingles(text)
                if len(found):
                    own = int.from_bytes(set_key(found)[:8], "little", signed=True)
                    yield pd.DataFrame({"id": name, "own": own, "size": len(found), "shingle": found.view(np.int64)})

    rows = table.select(F.col(key).cast("long").alias("id"), "text").where("id is not null and text is not null")
    return mapped(rows, run, "id long, own long, size int, shingle long")


class Index:
    """The items' sketches by size class, and all their shingles for verification."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: float) -> None:
        self.items, self.threshold = items, threshold
        classes: dict[int, list[int]] = {}
        for k, (_, found) in enumerate(items):
            classes.setdefault(len(found).bit_length(), []).append(k)
        #: (least size of a document, sketch hashes in order, their items)
        self.classes = []
        for members in classes.values():
            keep = [int((1 - threshold) * len(items[k][1]) + 1e-9) + 1 for k in members]
            hashes = np.concatenate([items[k][1][:n] for k, n in zip(members, keep, strict=True)])
            owner = np.repeat(members, keep)
            order = np.argsort(hashes, kind="stable")
            least = threshold * min(len(items[k][1]) for k in members)
            self.classes.append((least, hashes[order], owner[order]))

    def candidates(self, found: np.ndarray) -> set[int]:
        out: set[int] = set()
        for least, sketch, owner in self.classes:
            if len(found) < least:
                continue
            probe = found[: np.searchsorted(found, sketch[-1], "right")]
            low, high = np.searchsorted(sketch, probe, "left"), np.searchsorted(sketch, probe, "right")
            for a, b in zip(low[high > low], high[high > low], strict=True):
                out.update(owner[a:b].tolist())
        return out

    def matches(self, text: str) -> list[tuple[int, float]]:
        """(item, containment) of the items that a text holds."""
        found, out = shingles(text), []
        for k in sorted(self.candidates(found)):
            item, own = self.items[k]
            at = np.minimum(np.searchsorted(found, own), len(found) - 1)
            share = float((found[at] == own).sum()) / len(own)
            if share >= self.threshold:
                out.append((item, share))
        return out


def contained_items(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, broadcast_limit: int = BROADCAST_SHINGLES) -> DataFrame:
    """``doc_id``, ``item_id``, ``containment``: the items of which a document holds at least the
    threshold's share of shingles, once per pair.

    Rows with null id, null text or no word match nothing. Repeated rows give one match; of several
    rows with one id, documents or items, each counts by itself and the best match of the pair of
    ids is kept. Texts of any length are compared whole. Other columns are left behind; empty tables give no rows. Item shingles are broadcast only if their number is
    within ``broadcast_limit``; larger benchmarks are joined on sketch shingles instead.
    """
    sets = shingle_sets(benchmark, "item_id")
    if sets.count() <= broadcast_limit:
        found = broadcast_matches(documents, sets, threshold)
    else:
        found = joined_matches(documents, sets, threshold)
    return found.groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def broadcast_matches(documents: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    rows = sets.toPandas()
    items = []
    for (item, _), own in rows.groupby(["id", "own"])["shingle"]:
        items.append((int(item), np.unique(own.to_numpy().view(np.uint64))))
    index = documents.sparkSession.sparkContext.broadcast(Index(items, threshold))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = zip(batch["doc_id"].tolist(), batch["text"].tolist(), strict=True)
            out = [(name, item, share) for name, text in pairs for item, share in index.value.matches(text)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "containment"])

    return mapped(documents.select("doc_id", "text").where("doc_id is not null and text is not null"), run, MATCHES)


def joined_matches(documents: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The same by joins: sketches find candidate pairs, all shingles verify them."""
    # Hashes are unsigned: flipping the sign bit orders them as the array version does.
    order = F.col("shingle").bitwiseXOR(F.lit(-(1 << 63)))
    item = ["item_id", "item_own"]
    items = sets.dropDuplicates(["id", "own", "shingle"])
    items = items.select(F.col("id").alias("item_id"), F.col("own").alias("item_own"), F.col("size").alias("item_size"), "shingle", order.alias("at"))
    keep = F.floor((1 - threshold) * F.col("item_size") + 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy(*item).orderBy("at"))
    sketches = items.withColumn("rank", rank).where(F.col("rank") <= keep)
    texts = shingle_sets(documents, "doc_id").select(F.col("id").alias("doc_id"), "own", F.col("size").alias("doc_size"), "shingle")
    fits = (F.col("shingle") == F.col("s_shingle")) & (F.col("doc_size") >= threshold * F.col("item_size"))
    probes = sketches.select(*item, "item_size", F.col("shingle").alias("s_shingle"))
    pairs = texts.join(probes, fits).select("doc_id", "own", *item).distinct()
    full = pairs.join(items.select(*item, "item_size", "shingle"), item)
    held = texts.select("doc_id", "own", "shingle").distinct()
    counts = full.join(held, ["doc_id", "own", "shingle"]).groupBy("doc_id", "own", *item)
    counts = counts.agg((F.count("*") / F.first("item_size")).alias("containment"))
    return counts.where(F.col("containment") >= threshold).select("doc_id", "item_id", "containment")
