"""N-gram Jaccard join with a MinHash LSH forest.

Texts with the same set of word shingles form one class, and one of them stands for it. Every
representative has a signature of MinHash values, dealt to the trees of a forest: each tree sorts the
representatives by their values of that tree, so that its prefix trie lies in the order of the rows
and those below a trie node are neighbours. Only what shares the shortest prefix with somebody is kept.

Matches are sought at full depth first, and then with prefixes shortened by one value at a time. Every
round looks at the trie nodes that join branches which were apart before. It ends as soon as the
links seen so far, by their similarities, say that the prefixes of that length miss no more than the
allowed share; so a corpus of close copies is settled at full depth and one with links at the
threshold goes down to the shortest prefix.

Below a trie node, members are compared by signature with the leaders among them, which rules out
chance neighbours and yields few edges. Connected candidates are compared by signature in blocks of
bounded size, and wherever two may be alike, exactly, on whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import Forest, arrow_mapped, block_pairs, components, groups, mapped
from tabloom.llm.hashing import mixed, set_key, shingles
from tabloom.sources.shared import stored


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9999999
    trees: int = 32
    depth: int = 6
    #: The shortest prefix; with it a pair at the threshold is missed once in twenty million times.
    least: int = 4
    #: Members of a trie node that one task compares with leaders; larger ones are salted.
    group: int = 20_000
    #: Leaders of a salted trie node that one side of a task compares.
    heads: int = 4096
    #: Representatives of a candidate component that one side of a task compares.
    block: int = 256
    #: What signatures may say below the truth: more than five deviations of 192 values at 0.8.
    margin: float = 0.15
    seed: int = 11


def signature(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over a set."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 8192):
        values = np.multiply.outer(factors, found[at : at + 8192]) + offsets[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return mixed(out)


def sketches(documents: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id``, the text's hash, the set's key (null without words) and the signature, a byte a value."""
    rng = np.random.default_rng(settings.seed)
    count = settings.trees * settings.depth
    factors = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 1 << 63, count, dtype=np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, short = [], []
            for text in batch["text"]:
                found = shingles(text, settings.words)
                keys.append(set_key(found) if len(found) else None)
                short.append((signature(found, factors, offsets) & np.uint64(255)).astype(np.uint8).tobytes() if len(found) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "mark": batch["mark"], "set_key": keys, "short": short})

    rows = documents.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return mapped(rows, run, "doc_id long, mark long, set_key binary, short binary")


def tries(reps: DataFrame, settings: Settings) -> DataFrame:
    """The sorted tries, cut into their subtries below the shortest prefix: ``tree``, ``trunk`` (that prefix), ``salt``,
    ``salts`` and ``entries``, which are the members' branch, signature and node in order. Subtries of one member
    are left out; large ones are dealt to several rows, so a row has a bounded size."""
    start = F.col("tree") * settings.depth + 1
    rows = reps.select("node", "short", F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))).alias("tree"))
    rows = rows.select("tree", F.substring("short", start, F.lit(settings.least)).alias("trunk"), "node")
    shared = rows.groupBy("tree", "trunk").agg(F.count("*").alias("n")).where("n > 1")
    members = rows.join(shared, ["tree", "trunk"]).withColumn("salts", F.ceil(F.col("n") / settings.group).cast("int"))
    members = members.withColumn("salt", F.pmod(F.xxhash64("node"), "salts").cast("int")).join(reps.select("node", "short"), "node")
    number = F.unhex(F.lpad(F.hex("node"), 16, "0"))
    entry = F.concat(F.substring("short", start, F.lit(settings.depth)), F.col("short"), number)
    return members.groupBy("tree", "trunk", "salt", "salts").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def agreement(table: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Share of equal values between the rows of two tables of signatures."""
    out = np.empty((len(table), len(own)))
    for k, row in enumerate(own):
        out[:, k] = (table == row).mean(axis=1)
    return out


def led(nodes: np.ndarray, shorts: np.ndarray, near: float, same: float) -> tuple[list[tuple[int, int, float]], list[int]]:
    """Edges of a forest over the members of one trie node, with their agreement, and its leaders.

    A member becomes a leader unless its signature agrees with some leader's in a share of at least
    ``same``; it is joined with every leader that it agrees with in at least ``near``, less the
    joins that add nothing, the most alike first."""
    forest, heads, edges = Forest(), [], []
    for k, own in enumerate(shorts):
        agree = (shorts[heads] == own).mean(axis=1) if heads else np.zeros(0)
        for at in sorted(np.flatnonzero(agree >= near), key=lambda j: -agree[j]):
            before = len(forest.edges)
            forest.join(int(nodes[k]), int(nodes[heads[at]]))
            if len(forest.edges) > before:
                edges.append((*forest.edges[-1], float(agree[at])))
        if not len(agree) or agree.max() < same:
            heads.append(k)
    return edges, [int(nodes[k]) for k in heads]


EDGES = ["a", "b", "agree", "tree", "prefix", "head"]
EDGE_TYPES = "a long, b long, agree double, tree int, prefix binary, head long"
EDGE_SCHEMA = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("agree", pa.float64()), ("tree", pa.int32()), ("prefix", pa.binary()), ("head", pa.int64())]
)


def subtries(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """Tree, salts and the members' bytes, a row each, of every row of ``tries``; nothing is copied."""
    entries = batch.column("entries")
    offsets, values = entries.offsets.to_numpy(), entries.values
    if not len(values):
        return
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8)
    for tree, salts, low, high in zip(batch.column("tree").to_pylist(), batch.column("salts").to_pylist(), offsets[:-1], offsets[1:], strict=True):
        yield tree, salts, data[ends[low] : ends[high]].reshape(high - low, -1)


def level_edges(batches: Iterator[pa.RecordBatch], depth: int, settings: Settings) -> Iterator[pa.RecordBatch]:
    """Edges below the trie nodes of one depth that join branches, and the leaders of salted ones."""
    width = settings.trees * settings.depth
    near = 1 - 2 * (1 - settings.threshold) - settings.margin
    rows: list[tuple] = []
    for batch in batches:
        for tree, salts, table in subtries(batch):
            branch, shorts = table[:, : settings.depth], table[:, settings.depth : settings.depth + width]
            nodes = np.ascontiguousarray(table[:, -8:]).view(">i8")[:, 0]
            new = np.any(branch[1:, :depth] != branch[:-1, :depth], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(table)]])
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                # Members that agree further were compared in the round before.
                joins = depth == settings.depth or bool(np.any(branch[low:high, depth] != branch[low, depth]))
                if (high - low > 1 and joins) or salts > 1:
                    edges, heads = led(nodes[low:high], shorts[low:high], near, settings.threshold)
                    rows.extend((*edge, None, None, None) for edge in edges)
                    if salts > 1:
                        rows.extend((None, None, None, tree, branch[low, :depth].tobytes(), head) for head in heads)
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_pandas(frame(rows), schema=EDGE_SCHEMA, preserve_index=False)
                    rows = []
    yield pa.RecordBatch.from_pandas(frame(rows), schema=EDGE_SCHEMA, preserve_index=False)


def frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=EDGES)
    return out.astype({"a": "Int64", "b": "Int64", "agree": "float64", "tree": "Int32", "head": "Int64"})


def head_edges(batches: Iterator[pd.DataFrame], bound: float) -> Iterator[pd.DataFrame]:
    """Edges of a forest over the leaders of two blocks of one trie node, from all pairs of signatures."""
    for (_, _, i, j), rows in groups(batches, ["tree", "prefix", "i", "j"]):
        own = np.array([r[4] for r in rows])
        shorts = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        forest, edges = Forest(), []
        for at in range(0, len(right), 64):
            agree = agreement(shorts[left], shorts[right[at : at + 64]])
            for x, y in np.argwhere(agree >= bound):
                before = len(forest.edges)
                forest.join(rows[left[x]][5], rows[right[at + y]][5])
                if len(forest.edges) > before:
                    edges.append((*forest.edges[-1], float(agree[x, y]), None, None, None))
        yield frame(edges)


def recall_of(edges: DataFrame, depth: int, settings: Settings) -> float | None:
    """The share of links that prefixes of ``depth`` values find, by the similarities of those seen:
    a link that is found with probability p stands for 1 / p links. None if there are none."""
    alike = F.greatest(F.col("agree"), F.lit(settings.threshold))
    found = F.lit(1.0) - F.pow(F.lit(1.0) - F.pow(alike, depth), settings.trees)
    seen = edges.where(F.col("agree") >= settings.threshold - settings.margin / 3)
    return seen.agg((F.count("*") / F.sum(F.lit(1.0) / found)).alias("recall")).first()["recall"]


def candidate_edges(reps: DataFrame, settings: Settings) -> DataFrame:
    """Edges ``a``, ``b`` that connect all representatives which share a prefix and look alike.

    With a distance of at most 1 - threshold to each other and to their leaders, two linked members
    of a trie node are two such steps apart from each other's leader within one salt, and the leaders
    of two salts three, which the bounds allow for, and a margin for the error of the estimate. Leaders of
    several salts are compared with one another, pair by pair, in blocks."""
    forest = stored(tries(reps, settings), "tries")
    bound = 1 - 3 * (1 - settings.threshold) - settings.margin
    edges: DataFrame | None = None
    for depth in range(settings.depth, settings.least - 1, -1):
        found = stored(arrow_mapped(forest.select("tree", "salts", "entries"), lambda batches, d=depth: level_edges(batches, d, settings), EDGE_TYPES), "edges")
        level = found.where("a is not null").select("a", "b", "agree")
        heads = block_pairs(found.where("head is not null").select("tree", "prefix", F.col("head").alias("node")), ["tree", "prefix"], "node", settings.heads)
        heads = heads.join(reps.select("node", "short"), "node").select("tree", "prefix", "i", "j", "own", "node", "short")
        heads = heads.repartition("tree", "prefix", "i", "j").sortWithinPartitions("tree", "prefix", "i", "j", "node")
        level = level.union(mapped(heads, lambda batches: head_edges(batches, bound), EDGE_TYPES).select("a", "b", "agree"))
        edges = stored(level if edges is None else edges.union(level).groupBy("a", "b").agg(F.max("agree").alias("agree")), "edges")
        recall = recall_of(edges, depth, settings)
        if recall is not None and recall >= settings.recall:
            break
    return edges.select("a", "b")


def alike(batches: Iterator[pd.DataFrame], settings: Settings) -> Iterator[pd.DataFrame]:
    """The nodes of each pair of blocks that have somebody of the other block, or of their own, that may be linked."""
    for (component, i, j), rows in groups(batches, ["component", "i", "j"]):
        own = np.array([r[3] for r in rows])
        shorts = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), -1)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        may = agreement(shorts[left], shorts[right]) >= settings.threshold - settings.margin
        if i == j:
            np.fill_diagonal(may, False)
        chosen = np.union1d(left[may.any(axis=1)], right[may.any(axis=0)])
        out = [(component, i, j, rows[k][3], rows[k][4]) for k in chosen]
        yield pd.DataFrame(out, columns=["component", "i", "j", "own", "node"])


def exact_links(sets: list[np.ndarray], threshold: float, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Whether the Jaccard similarity of sets ``rows[x]`` and ``cols[y]`` reaches the threshold."""
    sizes = np.array([len(s) for s in sets], float)
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, term, count = np.unique(everything, return_inverse=True, return_counts=True)
    shared = count[term] > 1  # shingles of one set add nothing to any intersection
    term, owner = term[shared], owner[shared]
    _, term = np.unique(term, return_inverse=True)
    order = np.argsort(term, kind="stable")
    term, owner = term[order], owner[order]
    common = np.zeros((len(rows), len(cols)))
    top = int(term[-1]) + 1 if len(term) else 0
    for at in range(0, top, 8192):
        low, high = np.searchsorted(term, [at, at + 8192])
        held = np.zeros((len(sets), min(8192, top - at)), np.float32)
        held[owner[low:high], term[low:high] - at] = 1
        common += held[rows] @ held[cols].T
    return common / (sizes[rows][:, None] + sizes[cols][None, :] - common) >= threshold


def block_links(batches: Iterator[pd.DataFrame], settings: Settings) -> Iterator[pd.DataFrame]:
    """For every pair of blocks: links of each node by weight, and a forest of the links."""
    out: list[tuple] = []
    for (_, i, j), rows in groups(batches, ["component", "i", "j"]):
        sets = [shingles(r[6], settings.words) for r in rows]
        own, weight = np.array([r[3] for r in rows]), np.array([r[5] for r in rows], np.int64)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(left) or not len(right):
            continue
        linked = exact_links(sets, settings.threshold, left, right)
        if i == j:
            np.fill_diagonal(linked, False)
            sums = [(left, linked @ weight[right])]
            linked = np.triu(linked, 1)
        else:
            sums = [(left, linked @ weight[right]), (right, weight[left] @ linked)]
        forest = Forest()
        for a, b in np.argwhere(linked):
            forest.join(rows[left[a]][4], rows[right[b]][4])
        out.extend((rows[k][4], int(n), None) for at, total in sums for k, n in zip(at, total, strict=True) if n)
        out.extend((a, 0, b) for a, b in forest.edges)
        if len(out) > 50_000:
            yield pd.DataFrame(out, columns=["node", "n", "peer"]).astype({"peer": "Int64"})
            out = []
    yield pd.DataFrame(out, columns=["node", "n", "peer"]).astype({"peer": "Int64"})


def judged(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``jaccard_join`` with ``mark``, the 64-bit hash of their text: where an id has
    several texts, each is judged by itself, and id and mark name it."""
    sketch = stored(sketches(documents, settings), "sketches")
    named = sketch.where("set_key is not null and doc_id is not null")
    classes = named.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min_by(F.struct("short", "mark"), "doc_id").alias("_s")
    )
    # Classes are numbered: an id with several texts stands for several classes.
    number = F.monotonically_increasing_id().alias("node")
    classes = stored(classes.select(number, "set_key", "rep", "copies", "_s.short", "_s.mark"), "classes")
    candidates = components(candidate_edges(classes, settings))
    blocks = block_pairs(candidates, ["component"], "node", settings.block).join(classes.select("node", "short"), "node")
    blocks = blocks.select("component", "i", "j", "own", "node", "short").repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    chosen = stored(mapped(blocks, lambda batches: alike(batches, settings), "component long, i int, j int, own int, node long"), "alike")
    texts = documents.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("mark"), "text").where("rep is not null and text is not null")
    members = chosen.select("node").distinct().join(classes.select("node", "rep", "mark", "copies"), "node").join(texts, ["rep", "mark"])
    members = members.dropDuplicates(["rep", "mark"])  # repeated rows count in copies
    pairs = chosen.join(members.select("node", "copies", "text"), "node").select("component", "i", "j", "own", "node", "copies", "text")
    pairs = pairs.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "node")
    found = stored(mapped(pairs, lambda batches: block_links(batches, settings), "node long, n long, peer long"), "found")
    linked = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("n"))
    grouped = components(found.where("peer is not null").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    lowest = grouped.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("low"))
    of_class = (
        classes.select("node", "set_key", "rep", "copies")
        .join(linked, "node", "left")
        .join(grouped.join(lowest, "component").select("node", "low"), "node", "left")
        .select(
            "set_key",
            F.coalesce("low", "rep").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        )
    )
    rows = sketch.select("doc_id", "mark", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    return rows.join(of_class, "set_key", "left").select(
        "doc_id",
        "mark",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.coalesce("class_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def jaccard_join(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``n_links``, ``kept``.

    ``n_links`` counts the other documents whose shingle sets have a Jaccard similarity of at least
    the threshold with its own, copies included; ``class_id`` is the smallest id reachable over
    links, itself included; ``kept`` marks the rows whose id is the class id. Texts of one to
    ``words - 1`` words are one shingle; null and empty texts and texts without words link with
    nothing. Rows with a null id link with nothing and have a null class. Rows that repeat an id
    with the same text count as copies; all are kept. Different texts of one id are judged each by
    itself. Texts of any length are compared whole; an empty table gives no rows. Other columns are left behind.
    """
    return judged(documents, settings).select("doc_id", "class_id", "n_links", "kept")
