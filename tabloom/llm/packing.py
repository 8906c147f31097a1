"""Bounded-space online packing of token ids into sequences of a fixed size.

Each partition keeps a fixed number of open windows. A document's full stretches become sequences
of their own; its rest goes to the window where it fits best; when it fits nowhere, the fullest
window is emitted and a new one opened. Windows still open at the end of a partition are merged
with those of its neighbours: their pieces are laid end to end and cut at the sequence size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import groups, mapped, nonempty
from tabloom.llm.tokens import encoder
from tabloom.sources.shared import stored

SIZE = 1024
OPEN = 64
#: Partitions whose left-over windows are merged together: at most GROUP * OPEN windows in a task.
GROUP = 32
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

Piece = tuple[object, int, np.ndarray, int]  # doc_id, start, ids, doc_tokens


class Windows:
    """The open windows of one partition."""

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.open: list[tuple[int, list[Piece]]] = []

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece shorter than the size into a window; the window that this closes, if any."""
        length = len(piece[2])
        fitting = [k for k, (used, _) in enumerate(self.open) if used + length <= self.size]
        closed = None
        if fitting:
            k = max(fitting, key=lambda k: self.open[k][0])
            self.open[k][1].append(piece)
            self.open[k] = (self.open[k][0] + length, self.open[k][1])
            if self.open[k][0] == self.size:
                closed = self.open.pop(k)[1]
        else:
            if len(self.open) == self.limit:
                closed = self.open.pop(max(range(self.limit), key=lambda k: self.open[k][0]))[1]
            self.open.append((length, [piece]))
        return closed


def rows_of(pieces: list[Piece], sequence: int) -> list[tuple]:
    out, offset = [], 0
    for doc_id, start, ids, total in pieces:
        out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset))
        offset += len(ids)
    return out


def laid_out(pieces: Iterator[Piece], size: int) -> Iterator[list[Piece]]:
    """Pieces end to end, cut at the size; the last sequence may be shorter."""
    row: list[Piece] = []
    room = size
    for doc_id, start, ids, total in pieces:
        while len(ids):
            row.append((doc_id, start, ids[:room], total))
            start, ids, room = start + len(row[-1][2]), ids[room:], room - len(row[-1][2])
            if not room:
                yield row
                row, room = [], size
    if row:
        yield row


def packed(documents: DataFrame, tokenizer: str, size: int = SIZE, open_windows: int = OPEN) -> DataFrame:
    """Pack every document's ids, followed by id 0, into sequences of at most ``size`` ids.

    One row per piece: ``doc_id``, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``. Null and empty texts are the
    single id 0; repeated rows are packed each; other columns are left behind; an empty table gives
    no rows. ``tokenizer`` is a file that every executor can read. Documents stay in the partitions
    of their scan, so nothing is shuffled but the left-over windows, a fixed number a partition.
    The first pass is stored, so that a lost executor cannot change which window a piece is in.
    """
    columns = PIECES + ", part int, ids binary"
    names = [c.split()[0] for c in columns.split(", ")]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        encode, windows, done = encoder(tokenizer), Windows(size, open_windows), 0
        rows: list[tuple] = []

        def emit(pieces: list[Piece]) -> None:
            nonlocal done
            rows.extend((*r, part, None) for r in rows_of(pieces, (part << 32) + done))
            done += 1

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].tolist(), encode.ids(batch["text"].tolist()), strict=True):
                ids = np.append(ids, np.uint32(0))
                total, doc_id = len(ids), None if pd.isna(doc_id) else int(doc_id)
                full = total - total % size
                for start in range(0, full, size):
                    emit([(doc_id, start, ids[start : start + size], total)])
                if total > full and (closed := windows.place((doc_id, full, ids[full:], total))):
                    emit(closed)
                if len(rows) > 20_000:
                    yield frame(rows)
                    rows = []
        for _, pieces in windows.open:
            for row, piece in zip(rows_of(pieces, (part << 32) + done), pieces, strict=True):
                rows.append((*row, part, piece[2].astype("<u4").tobytes()))
            done += 1
        yield frame(rows)
        # Workers live on: what this one knows of words is not for the next stage to carry.
        encoder.cache_clear()

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (group,), rows in groups(batches, ["bundle"]):
            pieces = ((None if pd.isna(r[1]) else int(r[1]), r[2], np.frombuffer(r[3], "<u4"), r[4]) for r in rows)
            out = []
            for k, row in enumerate(laid_out(pieces, size)):
                out.extend(rows_of(row, (1 << 62) + (int(group) << 32) + k))
            merged = pd.DataFrame(out, columns=names[:-2])
            merged["doc_id"] = merged["doc_id"].astype("Int64")
            yield merged

    first = stored(mapped(documents.select("doc_id", nonempty(F.col("text")).alias("text")), pack, columns), "packed")
    rest = first.where(F.col("ids").isNotNull()).withColumn("bundle", (F.col("part") / GROUP).cast("int"))
    rest = rest.repartition("bundle").sortWithinPartitions("bundle", "part", "sequence_id", "offset")
    merged = mapped(rest.select("bundle", "doc_id", "start", "ids", "doc_tokens"), merge, PIECES)
    return first.where(F.col("ids").isNull()).drop("part", "ids").unionByName(merged)
