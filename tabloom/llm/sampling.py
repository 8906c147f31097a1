"""Bounded, repeatable samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_share(key: str) -> Column:
    """Where the hash of a key lies among all hashes, 0 to 1.

    Of ``n`` distinct keys the ``k`` with the smallest hashes lie below ``MARGIN * (k + 25) / n``, but for a
    chance of no account; ranking only the keys below that keeps the ranking task at about
    ``MARGIN * (k + 25)`` rows whatever ``n`` is."""
    return F.xxhash64(key) / F.lit(2.0**64) + F.lit(0.5)


#: Keys that are ranked for every key that is wanted.
MARGIN = 4


def labelled_rows(documents: DataFrame, labels: DataFrame, target: str, learnable: Column, rows: int) -> DataFrame:
    """At most ``rows`` documents (``doc_id``, ``text``, ``label``): the ones with the smallest hash
    of their id among the ``labels`` rows that ``learnable`` admits.

    Only the chosen ids, whose number is bounded by ``rows``, are broadcast; the documents are
    scanned once, whole texts are kept. Rows with null label or id are left out; of several labels
    of a document the largest counts; null text is empty; of several texts of an id the smallest.
    """
    known = (
        labels.where(learnable & F.col(target).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("label"))
    )
    share = MARGIN * (rows + 25) / max(known.count(), 1)
    chosen = known.where(hash_share("doc_id") <= share).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return found.select("doc_id", "text", "label")


def collected(sample: DataFrame) -> list[tuple[str, int]]:
    """The bounded sample as (text, label) pairs in order of their ids."""
    return [(r[1], r[2]) for r in sorted(sample.collect(), key=lambda r: (r[0], r[1]))]
