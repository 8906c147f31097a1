"""Near copies, repeated strings, vectors and benchmark items against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tabloom.llm import common, contamination, forest, hashing, induced, repeats, vectors

DOCS = "doc_id long, text string, class_id string, n_bytes string, kept string"


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=4)) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "x", "y", "z") for k, t in enumerate(texts)], DOCS)


def roots(n, links):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_jaccard_join_equals_all_pairs(spark):
    rng = random.Random(3)
    base = words(rng, 80)
    texts = [None, "", "!!", "one two", "One  two!", "three"]
    for k in range(60):
        copy = list(base if k % 2 else words(rng, 60))
        for _ in range(k % 7):
            copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(9))
        texts += [" ".join(copy)] * (1 + (k % 9 == 0))
    sets = [set(hashing.shingles(t).tolist()) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    degree = Counter(x for pair in links for x in pair)
    root = roots(len(texts), links)
    for settings in (forest.Settings(), forest.Settings(block=5, group=7, heads=3)):
        found = {r["doc_id"]: (r["class_id"], r["n_links"], r["kept"]) for r in forest.jaccard_join(frame(spark, texts), settings).collect()}
        assert found == {k: (root[k], degree[k], root[k] == k) for k in range(len(texts))}


def test_prefixes_shorten_until_the_recall_is_reached(spark):
    """Close copies are settled at full depth, links at the threshold need the shortest prefix."""
    settings = forest.Settings()

    def enough(agree):
        edges = spark.createDataFrame([(1, 2, a) for a in agree], "a long, b long, agree double")
        return [d for d in (6, 5, 4) if (r := forest.recall_of(edges, d, settings)) is not None and r >= settings.recall]

    assert enough([0.99] * 50 + [0.9]) == [6, 5, 4]
    assert enough([0.99] * 50 + [0.8]) == [5, 4]
    assert enough([0.78, 0.8, 0.81]) == [4]
    assert enough([]) == enough([0.5]) == []


def signatures(texts, settings=forest.Settings()):
    rng = np.random.default_rng(settings.seed)
    n = settings.trees * settings.depth
    factors = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    return [(forest.signature(hashing.shingles(t), factors, offsets) & np.uint64(255)).astype(np.uint8).tobytes() for t in texts]


def test_texts_that_are_half_alike_are_not_compared_whole(spark):
    """A chain in which neighbours share half of their words: one component of candidates, no exact comparison."""
    rng = random.Random(13)
    stream = words(rng, 60 * 400 + 200)
    texts = [" ".join(stream[60 * k : 60 * k + 180]) for k in range(400)]
    rows = [(0, 0, 0, 0, k, short) for k, short in enumerate(signatures(texts))]
    batch = pd.DataFrame(rows, columns=["component", "i", "j", "own", "node", "short"])
    assert sum(len(out) for out in forest.alike(iter([batch]), forest.Settings())) == 0
    batch = pd.concat([batch, pd.DataFrame([(0, 0, 0, 0, 400, signatures([texts[7] + " new"])[0])], columns=batch.columns)])
    assert [r.node for out in forest.alike(iter([batch]), forest.Settings()) for r in out.itertuples()] == [7, 400]
    found = forest.jaccard_join(frame(spark, texts[:150] + [texts[7] + " new"])).where("n_links > 0").collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == [(7, 7, 1), (150, 7, 1)]


def test_links_across_salts_are_found(spark):
    """All texts below one trie node, dealt to many rows: every link is found whichever rows its ends are in."""
    rng = random.Random(14)
    base = words(rng, 150)
    texts = []
    for k in range(90):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(0, 9)):
            copy[at] = f"new{k}x{at}"
        texts.append(" ".join(copy))
    sets = [set(hashing.shingles(t).tolist()) for t in texts]
    degree = Counter(k for a in range(90) for b in range(a) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 for k in (a, b))
    found = forest.jaccard_join(frame(spark, texts), forest.Settings(group=4, heads=5, block=16)).collect()
    assert {r["doc_id"]: r["n_links"] for r in found} == {k: degree[k] for k in range(90)}


def test_long_texts_cross_the_steps_of_a_signature(spark):
    rng = random.Random(15)
    long = words(rng, 20_000)
    texts = [" ".join(long), " ".join(long[:-900]), " ".join(words(rng, 20_000))]
    assert len(hashing.shingles(texts[0])) > 8192
    found = forest.jaccard_join(frame(spark, texts)).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == [(0, 0, 1), (1, 0, 1), (2, 2, 0)]


def test_odd_rows_and_empty_tables(spark):
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    found = [(r["doc_id"], r["class_id"], r["n_links"]) for r in forest.jaccard_join(odd).collect()]
    assert Counter(found) == Counter([(None, None, 0), (1, 1, 1), (1, 1, 1), (2, 2, 0)])
    assert forest.jaccard_join(odd.where("false")).count() == 0
    assert repeats.without_repeats(odd).count() == 4
    assert repeats.without_repeats(odd.where("false")).count() == 0
    assert contamination.contained_items(odd, odd.selectExpr("doc_id as item_id", "text").where("false")).count() == 0


def test_repeated_ids_are_judged_text_by_text(spark):
    rng = random.Random(9)
    base, other = words(rng, 80), words(rng, 80)
    a, near, b = " ".join(base), " ".join(base[:-1] + ["new"]), " ".join(other)
    docs = spark.createDataFrame([(1, a), (1, a), (2, near)], "doc_id long, text string")
    found = [tuple(r) for r in forest.jaccard_join(docs).orderBy("doc_id").collect()]
    assert found == [(1, 1, 2, True), (1, 1, 2, True), (2, 1, 2, False)]
    docs = spark.createDataFrame([(0, near), (1, a), (1, b), (5, b + " more")], "doc_id long, text string")
    found = Counter((r["doc_id"], r["class_id"], r["n_links"], r["kept"]) for r in forest.jaccard_join(docs).collect())
    assert found == Counter([(0, 0, 1, True), (1, 0, 1, False), (1, 1, 1, True), (5, 1, 1, False)])
    assert sorted(tuple(r) for r in corpus_pipeline.one_of_each(spark, docs, "").collect()) == [(0, near), (1, b)]


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        yield len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()


def test_repeats_equal_brute_force(spark):
    rng = random.Random(5)
    passage = " ".join(words(rng, 60))
    texts = [None, "", "short", "é" * 300, "ab" * 400, passage, passage, "x" * 199, "y" * 200]
    texts += [" ".join(words(rng, 20)) + passage[rng.randrange(40) :] + " ".join(words(rng, 30)) for _ in range(25)]
    texts += [texts[-1] + passage + passage]
    found = repeats.without_repeats(frame(spark, texts)).orderBy("doc_id").collect()
    got = [(r["n_bytes"] or 0, r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found]
    assert got == list(brute_repeats(texts, 200))
    for r, text in zip(found, texts, strict=True):
        assert (r["kept_text"] is None) == (text is None)


def test_a_hot_anchor_is_taken_apart(spark):
    rng = random.Random(6)
    passage = " ".join(words(rng, 60))
    texts = [" ".join(words(rng, 30)) + passage + " ".join(words(rng, 30)) for _ in range(60)]
    texts += [t[: 130 + k] + " ".join(words(rng, 40)) for k, t in enumerate(texts[:20])]
    texts += [None, "ab" * 400, "x" * 900, passage[3:] + "x" * 500, passage + passage]
    found = repeats.without_repeats(frame(spark, texts), limit=2000).orderBy("doc_id").collect()
    got = [(r["n_bytes"] or 0, r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found]
    assert got == list(brute_repeats(texts, 200))
    rows = []
    for key, text in enumerate(texts[:60]):
        raw = text.encode()
        for name, a, b in zip(*repeats.stretches(np.frombuffer(raw, np.uint8), 200, 40)[:3], strict=True):
            rows.append((int(name.view(np.int64)), key, int(a), True, raw[a : b + 199]))
    pieces = spark.createDataFrame(rows, "anchor long, key long, start long, once boolean, piece binary")
    assert max(r[0] for r in pieces.groupBy("anchor").agg({"key": "count"}).select("count(key)").collect()) == 60
    groups, _ = repeats.bounded(pieces, 200, 40, 2000)
    assert max(r[0] for r in groups.selectExpr("group", "octet_length(piece) as n").groupBy("group").sum("n").select("sum(n)").collect()) <= 2000


@pytest.mark.parametrize("memory", [1 << 20, 8])
def test_induced_sorting_equals_counting(memory, tmp_path):
    rng = np.random.default_rng(1)
    for trial in range(60):
        text = rng.integers(1, int(rng.choice([2, 3, 27])), int(rng.integers(1, 250))).astype(np.uint16)
        if len(text) > 50 and trial % 2:
            text[-40:] = text[:40]
        text = np.append(text, np.uint16(0))
        for length in (1, 3, 20):
            windows = [text[k : k + length].tobytes() if k + length <= len(text) else None for k in range(len(text))]
            seen = Counter(windows)
            wanted = [w is not None and seen[w] > 1 for w in windows]
            assert induced.repeated(text, length, memory, str(tmp_path)).tolist() == wanted
    assert not list(tmp_path.iterdir())


def test_anchor_runs_cover_all_windows():
    data = np.frombuffer(b"abcab" * 100 + bytes(range(200)) * 2, np.uint8)
    names, starts, stops, _ = repeats.stretches(data, 60, 12)
    assert starts[0] == 0 and stops[-1] == len(data) - 59 and (starts[1:] == stops[:-1]).all() and len(names) == len(starts)


def test_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 16))
    rows = []
    for k in range(150):
        v = base[k % 6] + rng.normal(size=16) * (0.02, 0.09, 0.15)[k % 3]
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 2), "x"))
    rows += [(200, rows[0][1], 0, "x"), (201, rows[0][1], None, "x"), (202, None, 0, "x"), (203, [0.0] * 16, 0, "x"),
             (204, [float("nan")] * 16, 0, "x"), (205, [None, 1.0], 0, "x"), (206, [1.0, 0.0], 0, "x"), (None, rows[0][1], 0, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string")
    sound = [r for r in rows if r[0] is not None and (r[0] <= 200 or r[0] == 206)]

    def near(a, b):
        x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
        return a[2] == b[2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    links = [(a[0], b[0]) for k, a in enumerate(sound) for b in sound[:k] if near(a, b)]
    degree, root = Counter(x for p in links for x in p), roots(210, links)
    for block in (1024, 8):
        found = vectors.near_duplicates(table, block=block).where("vec_id is not null").collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {r[0]: (degree[r[0]], root[r[0]]) for r in rows if r[0] is not None}
    assert vectors.near_duplicates(table.where("false")).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(4)
    unit = rng.normal(size=(50, 1500))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    for threshold in (-0.02, 0.0, 0.03):
        sure = {tuple(p) for p in np.argwhere(unit @ unit.T >= threshold)}
        assert sure <= {tuple(p) for p in vectors.possible(unit, unit, threshold)}


def test_contained_items_both_ways(spark):
    rng = random.Random(8)
    items = [" ".join(words(rng, n)) for n in (3, 8, 20, 45, 200)]
    texts = [None, ""] + [" ".join(words(rng, 300)) for _ in range(6)]
    texts += [f"{texts[2]} {i.upper()} {texts[3]}" for i in items] + [items[3][: len(items[3]) * 9 // 10], items[3][: len(items[3]) // 2]]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(9, None), (None, "a b c")], "item_id long, text string")
    sets = [set(hashing.shingles(t).tolist()) for t in items]
    wanted = set()
    for d, t in enumerate(texts):
        own = set(hashing.shingles(t).tolist())
        wanted |= {(d, k, len(s & own) / len(s)) for k, s in enumerate(sets) if len(s & own) / len(s) >= 0.8}
    for limit in (10**6, 0):
        found = contamination.contained_items(frame(spark, texts), bench, broadcast_limit=limit).collect()
        assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_repeated_ids_of_texts_and_items_count_by_themselves(spark, limit):
    rng = random.Random(12)
    item = words(rng, 60)
    half, rest, other = " ".join(item[:30]), " ".join(item[30:]), " ".join(words(rng, 60))
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(item)), (8, other)], "item_id long, text string")

    def found(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(tuple(r) for r in contamination.contained_items(docs, bench, broadcast_limit=limit).collect())

    assert found([(1, half), (1, rest)]) == []
    assert found([(1, half), (1, " ".join(item)), (1, " ".join(item))]) == [(1, 7, 1.0), (1, 8, 1.0)]
    assert found([(2, other)]) == [(2, 8, 1.0)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_powers_and_hashes_of_long_arrays():
    power, inverse = hashing.powers(200_000)
    for k in (0, 1, 65_535, 65_536, 131_072, 199_999):
        assert int(power[k]) == pow(int(hashing.BASE), k, 1 << 64) and int(inverse[k]) == pow(int(hashing.BASE_INVERSE), k, 1 << 64)
    data = np.frombuffer(b"some words " * 20_000, np.uint8)
    hashes = hashing.span_hashes(data, np.array([0, 11 * 15_000]), np.array([4, 11 * 15_000 + 4]))
    assert hashes[0] == hashes[1]
