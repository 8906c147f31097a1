"""Quality classifier: averaged subword embeddings with a softmax output.

Every word, pair of neighbouring words and character n-gram of a text is hashed to a row of an
embedding table. The text's vector is the mean of those rows, weighted by kind, and a softmax over
two classes gives the score. Table and output weights are learned together by stochastic gradient
descent in numpy on a bounded sample of labelled rows. Because the output is linear in the mean,
scoring needs one number per table row: the difference of the two classes' products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import mapped, nonempty, remainder
from tabloom.llm.hashing import BASE, code_points, mixed, span_hashes
from tabloom.llm.sampling import collected, labelled_rows

#: Characters of a text that are hashed at once; n-grams and words that cross a border are kept whole.
PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    dim: int = 8
    sizes: tuple[int, ...] = (2, 3, 4)
    sample_rows: int = 4000
    epochs: int = 6
    rate: float = 10.0
    seed: int = 7


def pieces(cps: np.ndarray) -> Iterator[np.ndarray]:
    """Long texts in parts that end at white space where there is one."""
    start = 0
    while start < len(cps):
        end = min(len(cps), start + PIECE)
        if end < len(cps):
            blanks = np.flatnonzero(cps[start:end] <= 32)
            end = start + int(blanks[-1]) + 1 if len(blanks) else end
        yield cps[start:end]
        start = end


def features(cps: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """Table rows by kind: words, word pairs, then one array per n-gram size.

    A pair of equal words has a row of its own, whatever the word, so repetition is visible."""
    shift = np.uint64(64 - settings.bits)
    inside = np.zeros(len(cps) + 2, bool)
    inside[1:-1] = cps > 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    words = span_hashes(cps, edges[::2], edges[1::2])
    pairs = mixed(words[:-1] * BASE + words[1:] + np.uint64(1))
    pairs[words[:-1] == words[1:]] = np.uint64(0xABCDEF0123456789)
    found = [words >> shift, pairs >> shift]
    h = cps.astype(np.uint64) + np.uint64(1)
    for n in range(2, max(settings.sizes) + 1):
        h = h[:-1] * BASE + cps[n - 1 :] if len(h) else h
        if n in settings.sizes:
            found.append((h * np.uint64(0xD6E8FEB86659FD93 + 2 * n)) >> shift)
    return found


def mean_of(table: np.ndarray, text: str, settings: Settings) -> float:
    """The kinds' mean table values, summed; 0 for a text without features."""
    sums, counts = np.zeros(2 + len(settings.sizes)), np.zeros(2 + len(settings.sizes))
    for piece in pieces(code_points(text)):
        for k, rows in enumerate(features(piece, settings)):
            sums[k] += table[rows].sum(dtype=np.float64)
            counts[k] += len(rows)
    return float((sums / np.maximum(counts, 1)).sum())


def weighted_rows(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text and their shares in its vector."""
    total = np.zeros(1 << settings.bits, np.float32)
    kinds = [features(p, settings) for p in pieces(code_points(text))]
    for parts in zip(*kinds, strict=True):
        rows = np.concatenate(parts)
        if len(rows):
            total += np.bincount(rows.astype(np.int64), minlength=len(total)).astype(np.float32) / len(rows)
    used = np.flatnonzero(total)
    return used.astype(np.int32), total[used]


def fit(rows: list[tuple[str, int]], settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Learn from (text, 0 or 1) pairs; returns the value of every table row and the offset.

    With one class only, or no rows, all texts get the share of class 1 (one half without rows).
    """
    positive = sum(y for _, y in rows)
    prior = (positive + 0.5) / (len(rows) + 1)
    if positive in (0, len(rows)):
        return np.zeros(1 << settings.bits, np.float32), float(np.log(prior / (1 - prior)))
    rng = np.random.default_rng(settings.seed)
    table = rng.uniform(-1, 1, (1 << settings.bits, settings.dim)).astype(np.float32) / settings.dim
    out, offset = np.zeros((2, settings.dim), np.float32), np.log(np.array([1 - prior, prior], np.float32))
    examples = [(*weighted_rows(text, settings), y) for text, y in rows]
    steps, done = settings.epochs * len(examples), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(examples)):
            used, share, y = examples[k]
            rate = settings.rate * (1 - done / steps)
            done += 1
            if not len(used):
                continue
            vector = share @ table[used]
            logits = out @ vector + offset
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[y] -= 1
            back = error @ out
            out -= 0.02 * rate * np.outer(error, vector)
            offset -= 0.002 * rate * error
            table[used] -= rate * share[:, None] * back
    return (table @ (out[1] - out[0])).astype(np.float32), float(offset[1] - offset[0])


def score(documents: DataFrame, values: np.ndarray, offset: float, settings: Settings = Settings()) -> DataFrame:
    """``doc_id`` and ``score``, the probability of class 1, for every row.

    Null text counts as empty and gets the score of the offset alone; repeated ids give repeated
    rows; other columns are left behind; an empty table gives an empty result."""
    context = documents.sparkSession.sparkContext
    shared = context.broadcast(values)  # 4 bytes for each of 2**bits rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            logits = [offset + mean_of(table, text, settings) for text in batch["text"]]
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits, float), -500, 500)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": scores})

    return mapped(documents.select("doc_id", nonempty(F.col("text")).alias("text")), run, "doc_id long, score double")


def quality_scores(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on rows whose CRC-32 of the id leaves a remainder other than 0 modulo 5, score all rows.

    Columns ``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from a score of 0.3). At most
    ``settings.sample_rows`` labelled rows are learned from. ``held_out`` is false for a null id."""
    learnable = remainder("doc_id", 5) != 0
    values, offset = fit(collected(labelled_rows(documents, labels, "quality", learnable, settings.sample_rows)), settings)
    scored = score(documents, values, offset, settings)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
