"""Urls, licences, tokens, packing, the pipeline, and the SQL of this folder's queries."""

from __future__ import annotations

import os
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from check_registry import connect, differences
from tabloom.llm import licences, packing, queries, tokens, urls
from tabloom.sources.shared import Scratch, shared_folder


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", ["op4_url_filter", "op11_embedding_whitening", "op13_html_extraction"])
def test_a_scratch_around_a_query_leaves_no_tables(spark, sf_dir, name):
    before = set(os.listdir(shared_folder(spark)))
    with Scratch(spark) as scratch:
        assert queries.QUERIES[name](spark, sf_dir).count() > 0 and scratch.paths
    assert set(os.listdir(shared_folder(spark))) == before


def judge(spark, addresses, rules=urls.RULES):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(addresses)], "page_id long, url string, rule string")
    table = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged(pages, table).orderBy("page_id").collect()]


def test_url_rules(spark):
    assert judge(spark, [None, "", "example.com/en/", "HTTP://A.Example.COM/en/x?q", "http://www.example.com/en/", "x://net/es/#f", "x://net", "x://anet/es/"]) == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("a.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("net", "/es/", "net/es/", "block"), ("net", "", None, "allow"), ("anet", "/es/", None, "allow"),
    ]
    assert judge(spark, ["a://b/c"], [("b", "/d", "block")]) == [("b", "/c", None, "allow")]


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key like '%7'")
    filters = urls.cascade(listed, universe)
    assert len(filters) > 1
    assert {r[0] for r in universe.where(urls.member(filters, F.col("key"))).collect()} == {r[0] for r in listed.collect()}
    assert universe.where(urls.member(urls.cascade(listed.where("false"), universe), F.col("key"))).count() == 0


def scanned(spark, texts, threshold=licences.THRESHOLD):
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)]
    found = licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string, licence string, dice int"), threshold=threshold)
    assert found.columns == ["doc_id", "licence", "dice", "start", "n_words"]
    return sorted(tuple(r) for r in found.collect())


def test_licence_notices(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "Released under the MIT License.", "x"), (3, "Text. Released  under the MIT LICENSE!\nmore", "x"),
            (4, "Released under the MIT License.", "x"), (4, "Released under the MIT License.", "x"), (5, "Released under the sun", "x"),
            (6, "license", "x"), (4, "See here: released under the MIT License.", "x")]
    found = licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string, licence string")).collect()
    assert sorted(tuple(r) for r in found) == [(3, "MIT", 1.0, 1, 5), (4, "MIT", 1.0, 0, 5)]
    assert licences.licence_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def wrapped(text, width=60):
    return "\n".join(textwrap.wrap(text, width))


def test_every_template_is_found_however_it_is_wrapped(spark):
    """Whole bodies and notices on short lines, behind comment signs, with a changed holder, in a long text."""
    texts = []
    for k, (_, wording) in enumerate(licences.TEMPLATES):
        lines = wrapped(wording).split("\n")
        texts += ["\n".join(f" * {line}" for line in lines), f"{'filler words ' * 40}\n\n{wrapped(wording, 30)}\n\n{'and more of them ' * 40}"]
    found = {}
    for doc, licence, dice, *_ in scanned(spark, texts):
        found.setdefault(doc, {})[licence] = dice
    for k, (licence, wording) in enumerate(licences.TEMPLATES):
        for doc in (2 * k, 2 * k + 1):
            assert found[doc][licence] == 1.0, (licence, wording)
            assert len(found[doc]) == 1


def test_changed_and_mixed_licence_texts(spark):
    mit = next(w for name, w in licences.TEMPLATES if name == "MIT" and len(w) > 500)
    gpl = next(w for name, w in licences.TEMPLATES if name == "GPL-3.0" and w.startswith("This program is free"))
    changed = mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "ACME CORPORATION").replace("The above copyright notice", "This copyright notice")
    torn = " ".join(mit.split()[::2])
    found = {}
    for doc, licence, dice, start, n in scanned(spark, [changed, torn, f"{gpl} {'x y z ' * 30} {mit}", mit[: len(mit) // 2], f"{'of the ' * 5000} {mit}"]):
        found.setdefault(doc, []).append((licence, dice, start, n))
    assert [f[0] for f in found[0]] == ["MIT"] and 0.9 < found[0][0][1] < 1
    assert 1 not in found and 3 not in found
    assert [f[:2] for f in found[2]] == [("GPL-3.0", 1.0), ("MIT", 1.0)]
    assert [f[:2] for f in found[4]] == [("MIT", 1.0)] and found[4][0][2] == 10_000


def test_equally_similar_licences_go_by_name(spark):
    templates = (("B", "one two three four five six"), ("A", "one two three four five six"), ("C", "seven eight nine ten"))
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    assert sorted(tuple(r) for r in licences.licence_scan(docs, templates).collect()) == [(1, "A", 1.0, 0, 6), (1, "C", 1.0, 6, 4)]


TEXTS = ["", "a", "  two  spaces\n\n new\tline ", "don't 'stop' it's", "ünïcödé 12ab34 €5 — dash", "中文 text", "x" * 3000, "a b " * 700, "<|endoftext|> x", "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext|", "don't <|endoftext|>"]


def test_ids_equal_the_tokenizer(spark, sf_dir):
    encoder, fresh = tokens.Encoder(queries.tokenizer_file()), Tokenizer.from_file(queries.tokenizer_file())
    texts = TEXTS + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for found, text in zip(encoder.ids(texts), texts, strict=True):
        assert found.tolist() == fresh.encode(text, add_special_tokens=False).ids
    assert next(iter(encoder.ids(["<|endoftext|>"]))).tolist() == [50256]


def test_long_texts_are_cut_between_words(monkeypatch):
    encoder = tokens.Encoder(queries.tokenizer_file())
    text = "some words  and\n\nlines here " * 40
    wanted = next(iter(encoder.ids([text])))
    monkeypatch.setattr(tokens, "PIECE", 50)
    assert np.array_equal(next(iter(encoder.ids([text]))), wanted)


@pytest.mark.parametrize(("open_windows", "parts"), [(64, 1), (2, 5)])
def test_packing_round_trip(spark, open_windows, parts):
    texts = [None, *TEXTS * 6]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, start string").repartition(parts)
    rows = packing.packed(docs, queries.tokenizer_file(), 256, open_windows).collect()
    encoder = tokens.Encoder(queries.tokenizer_file())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, ids in enumerate(encoder.ids([t or "" for t in texts])):
        ids, at = np.append(ids, np.uint32(0)).astype("<u4"), 0
        for r in sorted(by_doc[k], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in rows)
    assert total > 0.9 * 256 * (len(by_sequence) - 1)
    assert packing.packed(docs.where("false"), queries.tokenizer_file()).count() == 0


def test_best_fit_and_fullest():
    windows = packing.Windows(10, 2)
    ids = np.zeros(10, np.uint32)
    assert windows.place((1, 0, ids[:6], 6)) is None
    assert windows.place((2, 0, ids[:7], 7)) is None
    assert windows.place((3, 0, ids[:2], 2)) is None
    assert [u for u, _ in windows.open] == [6, 9]
    assert [p[0] for p in windows.place((4, 0, ids[:5], 5))] == [2, 3]
