"""The trie of all conversation openings, by van Emde Boas recursion.

A trie of depth D over distributed sequences would take D rounds if it were built turn by turn.
Here it takes a logarithmic number: sequences are cut at half their depth, the prefix up to the cut
is named, and the trie above the cut and the forest of tries below it, one for every named prefix,
are built by the same rule. All tries of one size are built in the same Spark job, so a round is one
grouping on the way up (what stands left of each cut) and one join on the way down (the names of the
cuts). Sums over subtrees run the other way: totals of the lower forests are grafted on the nodes
above their cuts, for larger and larger tries. Rows are narrow, texts are hashed where they are read.

A name is 128 bits of hash of the prefix; every key of a shuffle is a (sequence, block) or a node, so
one endless conversation, or one that everybody repeats, is spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import mapped, nonempty, partitions, remainder
from tabloom.sources.shared import stored

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = ["na", "nb"]
PARENT = ["pa", "pb"]
#: The name of the empty prefix.
ROOT = (0, 0)


@dataclass(frozen=True)
class Settings:
    #: Conversations of one group of ids begin like the group's first one ...
    group: int = 100
    #: ... with fewer turns than this, by the checksum of the id.
    openings: int = 6
    #: Ids that one row carries to the hashing of a node's ends.
    chunk: int = 4096
    #: Rows that may be broadcast; tables are broadcast only where this is proven to hold.
    few: int = 100_000
    #: Keys that are looked up by broadcast because each stands for more than this share of the rows.
    heavy: int = 1000


def _hash(salt: int, *columns: Column | str) -> Column:
    return F.xxhash64(F.lit(salt), *columns)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 0, two hashes of role and text, ``chars``: turns in their order.

    Turns are sorted into ranges over all conversations, numbered inside each range and shifted by
    what earlier ranges hold of the same conversation. Only conversations at the edge of a range can
    lie in several, so the shifts are at most two rows a range."""
    role, text = nonempty(F.col("role")), nonempty(F.col("text"))
    narrow = conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), _hash(1, role, text).alias("xa"), _hash(2, role, text).alias("xb"), F.char_length(text).cast("long").alias("chars")
    )
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("xa"), F.asc("xb")]
    ranges = partitions(conversations.sparkSession)
    ranged = stored(narrow.repartitionByRange(ranges, F.asc("conv_id"), *order).withColumn("range", F.spark_partition_id()), "turns")
    edges = ranged.groupBy("range").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    edges = edges.select(F.explode(F.array("low", "high")).alias("conv_id")).distinct()
    sizes = ranged.join(F.broadcast(edges), "conv_id", "left_semi").groupBy("conv_id", "range").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("conv_id", "range", F.sum("size").over(before).alias("shift"))
    place = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order)) - 1
    placed = ranged.withColumn("place", place).join(F.broadcast(shifts), ["conv_id", "range"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("shift", F.lit(0))).cast("long").alias("pos"), "xa", "xb", "chars")


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, settings: Settings) -> DataFrame:
    """``rows`` joined with the row of ``table`` that has their keys. ``weight`` counts the rows a key
    has: keys with a share above 1 / ``heavy`` of ``total``, fewer than ``heavy`` of them, are
    broadcast, so that the others' join has no large group."""
    large = F.col(weight) > max(10_000, total // settings.heavy)
    hot = F.broadcast(table.where(large).drop(weight))
    rest = rows.join(F.broadcast(table.where(large).select(*keys)), keys, "left_anti").join(table.where(~large).drop(weight), keys)
    return rows.join(hot, keys).unionByName(rest)


def rebuilt(turns: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: the first turns of the first conversation of their group of
    ids, then their own turns after as many. Returns the turns and the members ``conv_id``, ``n``
    (one more than the turns they have now, which may be none). Ids below zero are grouped towards
    zero, as SQL's remainder does."""
    taken = remainder("conv_id", settings.openings)
    base = F.col("conv_id") - F.col("conv_id") % settings.group
    heads = turns.where((base == F.col("conv_id")) & (F.col("pos") < settings.openings - 1))
    # At most a handful of turns each.
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "xa", "xb", "chars"))).alias("head"))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    known = sizes.select("conv_id", "size", base.alias("base"), taken.alias("taken")).join(heads, "base", "left")
    held = F.when(F.col("head").isNull(), 0).otherwise(F.least(F.size("head"), F.col("taken").cast("int")))
    own = F.greatest(F.col("size") - F.col("taken"), F.lit(0))
    opened = stored(known.select("conv_id", "size", held.alias("held"), (held + own + 1).alias("n"), "head"), "openings")
    first = opened.where("held > 0").select("conv_id", "n", F.inline(F.slice("head", 1, F.col("held"))))
    rest = turns.where(F.col("pos") >= taken)
    shapes = opened.select("conv_id", "size", "held", "n")
    total = opened.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rest = looked_up(rest, shapes, ["conv_id"], "size", total, settings)
    rest = rest.withColumn("pos", F.col("pos") - taken + F.col("held")).select("conv_id", "n", "pos", "xa", "xb", "chars")
    return first.unionByName(rest), opened.select("conv_id", "n")


def steps_and_ends(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's edges with repeats: for every turn the prefix before it and the prefix with it; and
    for every sequence the prefix that it ends with.

    Each sequence has one more block than turns, the end. A block of 2^k turns is cut in two. Going
    up, the hashes of halves are combined; going down, a block knows the names of the prefix before
    it and of the prefix before the next block, and the cut between its halves is named by the
    first of these and the left half's hash. Sequences take part in no more levels than they need."""
    longest = members.agg(F.max("n")).first()[0] or 1
    ends = members.select("conv_id", "n", (F.col("n") - 1).alias("b"), *[F.lit(0).cast("long").alias(x) for x in ("la", "lb")])
    leaves = turns.select("conv_id", "n", F.col("pos").alias("b"), *[_hash(salt, "pos", "xa", "xb").alias(x) for salt, x in ((3, "la"), (4, "lb"))])
    blocks, levels = leaves.unionByName(ends), []
    while 1 << len(levels) < longest:
        even = F.col("b") % 2 == 0
        level = (
            blocks.where(F.col("n") > 1 << len(levels))
            .groupBy("conv_id", "n", F.floor(F.col("b") / 2).alias("b"))
            .agg(
                *[F.bit_xor(x).alias(x) for x in ("la", "lb")],
                *[F.max(F.when(even, F.col(x))).alias(f"left_{x}") for x in ("la", "lb")],
                (F.max(F.col("b") % 2) == 1).alias("cut"),
            )
        )
        levels.append(stored(level, "blocks"))
        blocks = levels[-1].select("conv_id", "n", "b", "la", "lb")

    root = [F.lit(value).cast("long").alias(name) for value, name in zip(ROOT, ("sa", "sb"), strict=True)]
    nothing = [F.lit(None).cast("long").alias(name) for name in ("ea", "eb")]
    named = members.where("n > 1").select("conv_id", F.lit(0).cast("long").alias("b"), *root, *nothing).limit(0)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k].drop("la", "lb")
        whole = level.where(F.col("n") <= 1 << (k + 1)).select("*", *root, *nothing)
        parts = whole if k == len(levels) - 1 else whole.unionByName(level.where(F.col("n") > 1 << (k + 1)).join(named, ["conv_id", "b"]))
        middle = [_hash(salt, "sa", "sb", "left_la", "left_lb") for salt in (5, 6)]
        parts = parts.select("conv_id", "n", "b", "cut", "sa", "sb", "ea", "eb", middle[0].alias("ma"), middle[1].alias("mb"))
        left = F.struct(
            (F.col("b") * 2).alias("b"), "sa", "sb", *[F.when(F.col("cut"), F.col(m)).otherwise(F.col(e)).alias(e) for m, e in (("ma", "ea"), ("mb", "eb"))]
        )
        right = F.struct((F.col("b") * 2 + 1).alias("b"), F.col("ma").alias("sa"), F.col("mb").alias("sb"), "ea", "eb")
        named = parts.select("conv_id", "n", F.inline(F.when(F.col("cut"), F.array(left, right)).otherwise(F.array(left))))
        named = named.drop("n") if k else named
    if not levels:
        named = named.withColumn("n", F.lit(1).cast("long"))
    named = stored(named.withColumnsRenamed({"sa": "pa", "sb": "pb", "ea": "na", "eb": "nb"}), "names")

    steps = named.where(F.col("b") < F.col("n") - 1).join(turns.select("conv_id", F.col("pos").alias("b"), "chars"), ["conv_id", "b"])
    steps = steps.select("conv_id", (F.col("b") + 1).alias("depth"), *PARENT, *NODE, "chars")
    last = named.where(F.col("b") == F.col("n") - 1).select("conv_id", F.col("pa").alias("na"), F.col("pb").alias("nb"))
    turnless = members.where("n = 1").select("conv_id", *[F.lit(value).cast("long").alias(name) for value, name in zip(ROOT, NODE, strict=True)])
    return steps, last.unionByName(turnless)


def digests(ends: DataFrame, settings: Settings) -> DataFrame:
    """The SHA-256 of every node's ids in ascending order, joined by commas.

    A hash runs over its input in order, but the input can be prepared anywhere: ids are sorted into
    ranges and joined to chunks there, and one task per node only hashes the chunks, as a stream."""
    ranges = partitions(ends.sparkSession)
    order = [*NODE, "conv_id"]

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for (a, b), ids in batch.groupby(NODE, sort=False)["conv_id"]:
                ids = ids.tolist()
                for at in range(0, len(ids), settings.chunk):
                    part = ids[at : at + settings.chunk]
                    rows.append((a, b, part[0], ",".join(map(str, part))))
            yield pd.DataFrame(rows, columns=[*NODE, "first", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(batch["na"], batch["nb"], batch["ids"], strict=True):
                if (a, b) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    ranged = ends.select(*order).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    joined = mapped(ranged, chunks, "na long, nb long, first long, ids string")
    dealt = joined.repartition(ranges, *NODE).sortWithinPartitions(*NODE, "first")
    return mapped(dealt, hashed, "na long, nb long, ends_sha256 string")


def grafted(weights: DataFrame, steps: DataFrame, deepest: int, total: int, settings: Settings) -> list[DataFrame]:
    """Tables whose sums by node are the sums over the nodes' subtrees.

    ``weights`` holds each node's own ``leaves`` and ``saved``, its depth, its parent and one sequence
    through it. Tries of 2, 4, 8 ... layers are cut in half: what the lower forest under a cut node
    sums up to is added to that node and its ancestors within the upper trie, which are the steps of
    any sequence through the cut."""
    root = [F.lit(value).cast("long").alias(name) for value, name in zip(ROOT, NODE, strict=True)]
    above = [F.lit(None).cast("long").alias(name) for name in PARENT]
    sums = [F.sum(x).alias(x) for x in ("leaves", "saved")]
    tables = [weights]
    size = 2
    while size // 2 <= deepest:
        roots = reduce(DataFrame.unionByName, tables).where(F.col("depth") % size == size // 2)
        cuts = roots.groupBy(*PARENT, F.floor(F.col("depth") / size).alias("trie")).agg(F.min("conv_id").alias("conv_id"), *sums)
        cuts = stored(cuts, "cuts")
        upper = steps.where(F.col("depth") % size < size // 2).withColumn("trie", F.floor(F.col("depth") / size))
        # Every cut has a sequence of its own with half a trie of turns above it, the root aside.
        small = total // (size // 2) <= settings.few
        lower = cuts.select("conv_id", "trie", "leaves", "saved")
        added = upper.join(F.broadcast(lower) if small else lower, ["conv_id", "trie"])
        added = added.groupBy(*NODE, *PARENT, "depth").agg(F.min("conv_id").alias("conv_id"), *sums)
        top = cuts.where("trie = 0").agg(F.min("conv_id").alias("conv_id"), *sums).where("conv_id is not null")
        top = top.select(*root, *above, F.lit(0).cast("long").alias("depth"), "conv_id", "leaves", "saved")
        tables.append(stored(added.unionByName(top), "grafts"))
        size *= 2
    return tables


def prefix_trie(turns: DataFrame, members: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per distinct prefix of the sequences, the empty one included.

    ``turns`` has ``conv_id``, ``n`` (turns of the sequence and one), ``pos`` from 0 without gaps, two
    hashes ``xa`` and ``xb`` of the turn and ``chars``; ``members`` has ``conv_id`` and ``n`` of all
    sequences. Columns: ``conv_id`` (the smallest with the prefix), ``depth``, ``parent_conv_id`` (null
    for the root), ``n_convs``, ``n_children``, ``n_leaves`` (nodes without children in the subtree,
    itself included), ``saved_tokens`` (summed over the subtree: sequences but one, times the characters of
    the last turn) and ``ends_sha256`` of the ids that end there. Without members there is no node.
    """
    turns, members = stored(turns, "sequences"), stored(members, "members")
    steps, ends = steps_and_ends(turns, members)
    steps, ends = stored(steps, "steps"), stored(ends, "ends")
    nodes = steps.groupBy(*NODE, *PARENT, "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *[F.lit(value).cast("long").alias(name) for value, name in zip(ROOT, NODE, strict=True)],
        *[F.lit(None).cast("long").alias(name) for name in PARENT],
        F.lit(0).cast("long").alias("depth"),
        "conv_id",
        "n_convs",
        F.lit(0).cast("long").alias("chars"),
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("na"), F.col("pb").alias("nb")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "nodes")
    weights = nodes.select(
        *NODE,
        *PARENT,
        "depth",
        "conv_id",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    deepest, count = nodes.agg(F.coalesce(F.max("depth"), F.lit(0)), F.count("*")).first()
    total = members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tables = grafted(weights, steps, deepest, total, settings)
    subtrees = reduce(DataFrame.unionByName, [t.select(*NODE, "leaves", "saved") for t in tables]).groupBy(*NODE)
    subtrees = subtrees.agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    whole = nodes.join(subtrees, NODE).join(digests(ends, settings), NODE, "left")
    parents = nodes.where("n_children > 0").select(F.col("na").alias("pa"), F.col("nb").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = looked_up(whole.where("depth > 0").withColumnRenamed("n_children", "own"), parents, PARENT, "n_children", count, settings)
    top = whole.where("depth = 0").withColumnRenamed("n_children", "own").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return below.unionByName(top).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("own").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations.

    Turns are ordered by ``turn``, null first; equal ones by role and then by a hash of role and text,
    and repeated rows are turns of their own. Null roles and texts become empty, which are texts like
    any other; texts of any length count whole. Rows without ``conv_id`` belong to no conversation and
    are left out. An empty table has no nodes. Other columns are left behind, whatever their names.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )
    turns = stored(ordered_turns(rows), "ordered")
    return prefix_trie(*rebuilt(turns, settings), settings)
