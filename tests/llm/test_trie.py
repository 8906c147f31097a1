"""The trie of conversations against a trie built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tabloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, na string, n int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Prefix sets of the rebuilt conversations, from (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(int(c / 100) * 100, [])[:h] + turns[h:])
        ends.setdefault(whole, []).append(c)
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
            for p, m in members.items()
        ),
        key=repr,
    )


def found(spark, rows, settings=trie.Settings()):
    table = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)
    result = trie.conversation_trie(table, settings)
    assert result.columns == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=repr)


def case(seed, conversations, words, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 1000), conversations):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(words)))
    rng.shuffle(rows)
    return rows


def test_equals_plain_trie(spark):
    rows = case(1, 150, ["a", "bb", "ÿ€😀", "", None], 7) + case(2, 30, ["a", "b"], 40)
    rows += [(None, 0, "user", "no conversation"), (5000, None, None, None)]
    rows += [(c, 0, "user", "x") for c in range(2001, 2040)]  # without a base: whatever is taken away is missing
    rows += [(c, 0, "user", "x") for c in range(3000, 3040)]
    rows += [(c, t, "user", "x" * t) for c in range(-130, 0) for t in range(3)]
    assert found(spark, rows) == brute(rows)


def test_no_turns_at_all(spark):
    assert found(spark, [(None, 0, "user", "no conversation")]) == []
    rows = [(c, 0, "user", "x") for c in range(101, 140) if zlib.crc32(str(c).encode()) % 6]
    assert found(spark, rows) == brute(rows) and len(brute(rows)) == 1


def test_ties_repeats_null_turns_and_very_long_texts(spark):
    rows = [(300, None, "user", "first"), (300, 1, "user", "x" * 3_000_000), (300, 1, "assistant", "x"), (300, 2, "user", "z"), (300, 2, "user", "z")]
    rows += [(c, t, r, x) for c in range(301, 330) for _, t, r, x in rows[:5]]
    assert found(spark, rows) == brute(rows)


def test_one_endless_conversation_and_a_hot_copy(spark):
    """Most rows in one conversation, most conversations alike, every lookup on both of its paths."""
    rows = [(0, t, "user", f"{t % 3}") for t in range(150)] + [(c, t, "user", "same") for c in range(200, 500) for t in range(3)]
    settings = trie.Settings(chunk=7, few=3)
    assert found(spark, rows, settings) == brute(rows)


def test_lookup_by_broadcast_and_by_join(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("w")).withColumn("v", F.col("k") * 2)
    joined = trie.looked_up(rows, table, ["k"], "w", 40_000, trie.Settings())
    assert joined.where("v = 2 * k").count() == 40_000 and joined.columns == ["k", "id", "v"]
