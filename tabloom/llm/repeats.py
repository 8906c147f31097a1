"""Removal of byte strings that repeat anywhere in the corpus, by sorted suffixes.

Every window of ``length`` bytes is named by its smallest gram hash (its anchor); equal windows
have equal anchors, so a window can repeat only where its anchor does. Anchors are counted over all
distinct texts; stretches of windows under a repeated anchor are compared by digest, and where some
stretch of an anchor occurs once, all of that anchor are dealt to shards by anchor, equal ones
once. Stretches of an anchor with too many bytes are taken apart by the anchor's offset in the
window, which equal windows share, and by the bytes that all windows of a range of offsets share;
every shard sorts the suffixes of its stretches by external induced sorting with common-prefix
values, and windows that share ``length`` bytes with a neighbour are repeats.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import mapped, partitions
from tabloom.llm.hashing import mixed, powers
from tabloom.llm.induced import repeated
from tabloom.sources.shared import stored

LENGTH = 200
#: Bytes of a gram. Long grams repeat by chance hardly ever; short ones make long stretches.
GRAM = 40
#: Bytes of text that are hashed at once.
PIECE = 1 << 20
#: Bytes of stretches in a shard, about.
SHARD = 8 << 20
#: Bytes of stretches that are dealt out together at most; an anchor with more is taken apart.
GROUP = 1 << 20
PARTS = "group binary, name binary, low int, high int, spot int, key long, start long, once boolean, piece binary"


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours."""
    run = np.minimum.accumulate if least else np.maximum.accumulate
    pick = np.minimum if least else np.maximum
    n, size = len(values), -(-len(values) // width) * width
    padded = np.full(size, values[-1], values.dtype)
    padded[:n] = values
    block = padded.reshape(-1, width)
    ahead = run(block, axis=1).ravel()
    behind = run(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchors, first window, end, and whether the anchor occurs
    more than once within reach of the run, so that the run may repeat itself."""
    found: list[tuple[np.ndarray, ...]] = []
    wide = length - gram + 1
    for at in range(0, len(data) - length + 1, PIECE):
        part = data[at : at + PIECE + length - 1]
        power, inverse = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        grams = mixed((total[gram:] - total[:-gram]) * inverse[: len(part) - gram + 1])
        low = sliding(grams, wide, True)
        starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        stops = np.append(starts[1:], len(low))
        # A gram is an anchor if some window over it has no smaller one.
        edge = np.zeros(wide - 1, np.uint64)
        over = sliding(np.concatenate([edge, low, edge]), wide, False)
        chosen = grams[grams == over]
        twice = chosen[:-1][chosen[:-1] == chosen[1:]]
        found.append((low[starts], starts + at, stops + at, np.isin(low[starts], twice)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def data_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def grams_of(data: np.ndarray, gram: int) -> np.ndarray:
    """The hash of every gram."""
    power, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    return mixed((total[gram:] - total[:-gram]) * inverse[: len(data) - gram + 1])


def taken_apart(anchor: bytes, low: int, high: int, spot: int, key: int, start: int, once: bool, piece: bytes, length: int) -> Iterator[tuple]:
    """``PARTS`` of a piece, by quarters of its range of offsets. The anchor is at ``spot``, so the
    window from ``s`` has it at offset ``spot - s``. Equal windows get the same group: anchor, range
    of offsets, and the bytes that every window with such an offset holds."""
    width = -(-(high - low) // 4)
    for a in range(low, high, width):
        b = min(high, a + width)
        first, last = max(0, spot - b + 1), min(len(piece) - length, spot - a)
        if first <= last:
            part = piece[first : last + length]
            shared = anchor + a.to_bytes(4, "big") + b.to_bytes(4, "big") + piece[spot - a : spot - b + 1 + length]
            yield hashlib.md5(shared).digest(), hashlib.md5(part).digest(), a, b, spot - first, key, start + first, once, part


def framed(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    while out := list(islice(rows, 5_000)):
        yield pd.DataFrame(out, columns=columns)


def bounded(pieces: DataFrame, length: int, gram: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Stretches (``anchor``, ``key``, ``start``, ``once``, ``piece``) as parts in groups of at most
    ``limit`` bytes (``group``, ``key``, ``start``, ``once``, ``piece``), and the windows among them
    that repeat as parts of larger groups (``key``, ``start``, ``stop``).

    Groups above the limit are taken apart until they are within it; at a single offset all
    parts of a group are equal and one stands for them, so this ends after four rounds."""
    columns = [c.split()[0] for c in PARTS.split(", ")]

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for anchor, key, start, once, piece in zip(*(batch[c] for c in ("anchor", "key", "start", "once", "piece")), strict=True):
                    piece, name = bytes(piece), int(anchor).to_bytes(8, "big", signed=True)
                    spots = np.flatnonzero(grams_of(np.frombuffer(piece, np.uint8), gram).view(np.int64) == anchor).tolist()
                    for before, spot in zip([-1, *spots[:-1]], spots, strict=True):
                        first, last = max(before + 1, spot - (length - gram)), min(len(piece) - length, spot)
                        if first <= last:
                            yield from taken_apart(name, 0, length - gram + 1, spot - first, key, start + first, once, piece[first : last + length], length)

        return framed(rows(), columns)

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for group, _, low, high, spot, key, start, once, piece in zip(*(batch[c] for c in columns), strict=True):
                    yield from taken_apart(bytes(group), low, high, spot, key, start, once, bytes(piece), length)

        return framed(rows(), columns)

    parts, place = stored(mapped(pieces, begin, PARTS), "parts", "zstd"), F.struct("key", "start")
    small, windows = [], []
    while True:
        names = parts.groupBy("group", "name").agg(
            F.min_by(F.struct("low", "high", "spot", "key", "start", "once", "piece"), place).alias("r"), F.min(place).alias("a"), F.max(place).alias("b")
        )
        same = F.col("a") == F.col("b")
        names = stored(names.select("group", "name", "r.low", "r.high", "r.spot", "r.key", "r.start", (F.col("r.once") & same).alias("once"), "r.piece", same.alias("same")), "names", "zstd")
        again = parts.where("once").select("group", "name", "key", "start", (F.octet_length("piece") - length + 1 + F.col("start")).alias("stop"))
        windows.append(again.join(names.where("not same").select("group", "name"), ["group", "name"]).select("key", "start", "stop"))
        sizes = names.groupBy("group").agg(F.sum(F.octet_length("piece")).alias("bytes"), F.count("*").alias("n"), F.max("high").alias("high"), F.min("low").alias("low"))
        # A window repeats within its group only, so a part that is alone there needs no comparison.
        sizes = stored(sizes.where("n > 1"), "sizes")
        small.append(names.join(sizes.where(F.col("bytes") <= limit).select("group"), "group").select("group", "key", "start", "once", "piece"))
        large = sizes.where(F.col("bytes") > limit).select("group")
        if large.isEmpty():
            break
        # Few: each has more bytes than the limit.
        parts = stored(mapped(names.join(F.broadcast(large), "group").select(*columns), further, PARTS), "parts", "zstd")
    return reduce(DataFrame.unionByName, small), reduce(DataFrame.unionByName, windows)


def merged(ranges: list, length: int) -> np.ndarray:
    """Windows' ranges as maximal runs of covered bytes, an array of (start, stop)."""
    spans = np.array(sorted(ranges), np.int64).reshape(-1, 2)
    spans[:, 1] += length - 1
    if not len(spans):
        return spans
    reach = np.maximum.accumulate(spans[:, 1])
    head = np.append(True, spans[1:, 0] > reach[:-1])
    last = np.append(np.flatnonzero(head)[1:] - 1, len(spans) - 1)
    return np.stack([spans[head, 0], reach[last]], axis=1)


def sorted_shard(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Repeats among one shard's stretches, for those that occur once: ``key``, ``start``, ``stop``."""
    keys, starts, sizes, single = [], [], [], []
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "text")
        with open(path, "wb") as file:
            for batch in batches:
                for key, start, once, piece in zip(batch["key"], batch["start"], batch["once"], batch["piece"], strict=True):
                    # Bytes from 2 on; 1 ends a stretch, and 0 the text.
                    file.write((np.frombuffer(piece, np.uint8).astype(np.uint16) + 2).tobytes() + b"\1\0")
                    keys.append(key), starts.append(start), sizes.append(len(piece) + 1), single.append(once)
            file.write(b"\0\0")
        if not keys:
            return
        marks = repeated(np.memmap(path, np.uint16, "r"), length, folder=folder)
    ends = np.cumsum(sizes)
    hits = np.flatnonzero(marks[:-1])
    which = np.searchsorted(ends, hits, "right")
    offset = hits - (ends - sizes)[which]
    good = np.array(single)[which] & (offset + length < np.array(sizes)[which])
    which, offset = which[good], offset[good]
    heads = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(which) else which
    lasts = np.append(heads[1:], len(which))[: len(heads)] - 1
    yield pd.DataFrame(
        {
            "key": [keys[which[k]] for k in heads],
            "start": [starts[which[k]] + int(offset[k]) for k in heads],
            "stop": [starts[which[k]] + int(offset[k]) + 1 for k in lasts],
        }
    ).astype({"start": "int64", "stop": "int64"})


def repeated_windows(documents: DataFrame, length: int, gram: int, limit: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Texts (``key``, ``text``) with windows under repeated anchors, and their repeated windows
    (``key``, ``start``, ``stop``) with respect to all distinct texts."""
    own = documents.where(F.octet_length("text") >= length).select("row", "key", "text")

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, values, twice = [], [], []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                names, _, _, selves = stretches(data_of(text), length, gram)
                unique, which, count = np.unique(names, return_inverse=True, return_counts=True)
                again = count > 1
                again[which[selves]] = True
                keys.append(key), values.append(unique.view(np.int64)), twice.append(again)
            yield pd.DataFrame({"key": keys, "anchors": values, "twice": twice})

    named = mapped(own.select("key", "text"), anchors, "key long, anchors array<long>, twice array<boolean>")
    rows = named.select("key", F.explode(F.arrays_zip("anchors", "twice")).alias("a")).select("key", F.col("a.anchors").alias("anchor"), F.col("a.twice").alias("twice"))
    rows = stored(rows, "anchors", "zstd")
    many = rows.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.max("twice").alias("twice"))
    many = many.where("low <> high or twice").select("anchor")
    wanted = rows.join(many, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    # One row stands for all copies of a text, so copies do not meet in one task.
    chosen = wanted.join(own.groupBy("key").agg(F.min("row").alias("row")), "key")
    texts = stored(own.join(chosen, ["row", "key"]).dropDuplicates(["row", "key"]).select("key", "text", "anchors"), "texts", "zstd")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, wanted in zip(batch["key"], batch["text"], batch["anchors"], strict=True):
                data = data_of(text)
                names, starts, stops, _ = stretches(data, length, gram)
                raw = data.tobytes()
                for k in np.flatnonzero(np.isin(names.view(np.int64), wanted)):
                    name = hashlib.md5(raw[starts[k] : stops[k] + length - 1]).digest()
                    out.append((int(names[k].view(np.int64)), key, int(starts[k]), int(stops[k]), name))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["anchor", "key", "start", "stop", "name"])
                    out = []
            yield pd.DataFrame(out, columns=["anchor", "key", "start", "stop", "name"])

    def lifted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, *asked in zip(*(batch[c] for c in ("key", "text", "anchor", "start", "stop", "once")), strict=True):
                raw = data_of(text).tobytes()
                out.extend((anchor, key, start, once, raw[start : stop + length - 1]) for anchor, start, stop, once in zip(*asked, strict=True))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["anchor", "key", "start", "once", "piece"])
                    out = []
            yield pd.DataFrame(out, columns=["anchor", "key", "start", "once", "piece"])

    runs = stored(mapped(texts, cut, "anchor long, key long, start long, stop long, name binary"), "runs", "zstd")
    place = F.struct("key", "start", "stop")
    distinct = runs.groupBy("anchor", "name").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    distinct = stored(distinct.select("anchor", "name", "low.*", (F.col("low") == F.col("high")).alias("once")), "distinct", "zstd")
    # Where all stretches of an anchor occur again as they are, all their windows repeat. Only beside a
    # stretch that occurs once does the order of suffixes decide, and only there bytes are dealt out.
    undecided = distinct.where("once").select("anchor").distinct()
    undecided = stored(distinct.join(undecided, "anchor").select("anchor", "key", "start", "stop", "once"), "undecided", "zstd")
    size = undecided.agg(F.coalesce(F.sum(F.col("stop") - F.col("start") + F.lit(length - 1)), F.lit(0))).first()[0]
    heavy = undecided.groupBy("anchor").agg(F.sum(F.col("stop") - F.col("start") + F.lit(length - 1)).alias("bytes"))
    heavy = stored(heavy.where(F.col("bytes") > limit).select("anchor"), "heavy")

    def bytes_of(wanted: DataFrame) -> DataFrame:
        asked = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "start", "stop", "once")).alias("asked"))
        asked = asked.select("key", "asked.anchor", "asked.start", "asked.stop", "asked.once")
        return mapped(texts.select("key", "text").join(asked, "key"), lifted, "anchor long, key long, start long, once boolean, piece binary")

    pieces, known = bytes_of(undecided), None
    if not heavy.isEmpty():
        # Few: each has more bytes than the limit.
        groups, known = bounded(bytes_of(undecided.join(F.broadcast(heavy), "anchor")), length, gram, limit)
        pieces = bytes_of(undecided.join(F.broadcast(heavy), "anchor", "left_anti"))
        pieces = pieces.unionByName(groups.select(F.xxhash64("group").alias("anchor"), "key", "start", "once", "piece"))
    shards = pieces.repartition(max(partitions(documents.sparkSession), size // SHARD), "anchor").select("key", "start", "once", "piece")
    within = mapped(shards, lambda batches: sorted_shard(batches, length), "key long, start long, stop long")
    within = within.unionByName(known) if known is not None else within
    whole = runs.join(distinct.where("not once").select("anchor", "name"), ["anchor", "name"])
    return texts, within.unionByName(whole.select("key", "start", "stop"))


def without_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = GROUP) -> DataFrame:
    """Every row of ``documents`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and
    ``kept_text`` (null for a null text): each byte that a repeated string of ``length`` bytes
    covers is removed, every occurrence included.

    Strings are judged on the input as UTF-8; matches never cross documents. Null text counts as
    empty, shorter texts keep all. Copies of a text of ``length`` bytes or more lose everything.
    ``kept_text`` replaces bytes of characters that were cut apart by U+FFFD. Rows may repeat ids or
    have none; other columns pass through, but for those named like a result. Texts are named by a 64-bit hash.
    """
    made = ("_raw", "_key", "_copies", "_removed", "_spans", "_sha", "_kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
    documents = documents.drop(*made)
    reserved = [F.xxhash64("text").alias("_key"), F.octet_length("text").cast("long").alias("n_bytes")]
    text = F.coalesce("text", F.lit(""))
    base = documents.withColumn("_raw", F.col("text")).withColumn("text", text).select("*", *reserved)
    plain = base.select(F.coalesce("doc_id", "_key").alias("row"), F.col("_key").alias("key"), "text")
    texts, windows = repeated_windows(plain, length, gram, limit)
    ranges = windows.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, found in zip(batch["key"], batch["text"], batch["ranges"], strict=True):
                data = data_of(text)
                runs = merged([(r["start"], r["stop"]) if isinstance(r, dict) else tuple(r) for r in found], length)
                keep = np.ones(len(data), bool)
                for a, b in runs:
                    keep[a:b] = False
                left = data[keep].tobytes()
                out.append((key, len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")))
            yield pd.DataFrame(out, columns=["_key", "_removed", "_spans", "_sha", "_kept"])

    cleaned = mapped(texts.select("key", "text").join(ranges, "key"), apply, "_key long, _removed long, _spans long, _sha string, _kept string")
    copies = base.groupBy("_key").agg(F.count("*").alias("_copies"))
    copied = (F.col("_copies") > 1) & (F.col("n_bytes") >= length)
    joined = base.join(copies, "_key").join(cleaned, "_key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    kept = F.when(copied, F.lit("")).otherwise(F.coalesce("_kept", "text"))
    return (
        joined.withColumn("n_removed", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("_removed", F.lit(0).cast("long"))))
        .withColumn("n_spans", F.when(copied, F.lit(1).cast("long")).otherwise(F.coalesce("_spans", F.lit(0).cast("long"))))
        .withColumn("kept_sha256", F.when(copied, F.lit(nothing)).otherwise(F.coalesce("_sha", F.sha2("text", 256))))
        .withColumn("kept_text", F.when(F.col("_raw").isNotNull(), kept))
        .withColumn("text", F.col("_raw"))
        .drop("_raw", "_key", "_copies", "_removed", "_spans", "_sha", "_kept")
    )
