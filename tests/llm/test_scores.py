"""Quality, toxicity and language: held-out accuracy, odd inputs, empty tables."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

from tabloom.llm import language, queries, quality, sampling, toxicity
from tabloom.llm.common import remainder

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string"
ROWS = [(1, None, None, None, None, 1.0, "x"), (None, "idiot", "en", "s", 5, None, None), (2, "", "en", "s", 0, 2.0, "y"),
        (3, "123 !!", "en", "s", 6, 2.0, "y"), (3, "123 !!", "en", "s", 6, 2.0, "y"), (5, "wort " * 60_000, "de", "s", 1, 0.0, "z")]


@pytest.fixture(scope="module")
def tables(spark):
    def of(name):
        return spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")

    return of


def accuracy(scores, labels, target):
    rows = scores.where("held_out").join(labels, "doc_id").select("predicted", target).collect()
    assert len(rows) > 60
    return sum(a == b for a, b in rows) / len(rows)


def test_quality_of_held_out_rows(tables):
    scores = quality.quality_scores(tables("documents"), tables("labels"))
    assert scores.count() == 1000
    assert accuracy(scores, tables("labels"), "quality") > 0.93


def test_toxicity_of_held_out_rows(tables):
    scores = toxicity.toxicity_scores(tables("documents"), tables("labels"))
    assert accuracy(scores, tables("labels"), "toxic") > 0.95


def test_language_of_held_out_rows(tables):
    found = language.language_predictions(tables("documents")).where("held_out")
    rows = found.join(tables("documents").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95


@pytest.mark.parametrize(("name", "modulus", "rest"), [("op1_quality", 5, 0), ("op5_toxicity", 3, 1), ("op8_language", 5, 0)])
def test_folds(spark, sf_dir, name, modulus, rest):
    for r in queries.QUERIES[name](spark, sf_dir).select("doc_id", "held_out", "score").collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest)
        assert 0 <= r["score"] <= 1


def test_odd_rows(spark, tables):
    odd = spark.createDataFrame(ROWS, ODD)
    labels = tables("labels")
    for scores in (quality.quality_scores(odd, labels), toxicity.toxicity_scores(odd, labels), language.language_predictions(odd)):
        assert sorted((r["doc_id"] or 0) for r in scores.collect()) == [0, 1, 2, 3, 3, 5]
        assert scores.where("doc_id is null and held_out").count() == 0
    und = {r["doc_id"] for r in language.language_predictions(odd).where("lang_pred = 'und'").collect()}
    assert und == {1, 2, 3}


def test_empty_tables(spark, tables):
    none = tables("documents").where("false")
    labels = tables("labels")
    assert quality.quality_scores(none, labels).count() == 0
    assert toxicity.toxicity_scores(none, labels.where("false")).count() == 0
    assert language.language_predictions(none).count() == 0
    assert quality.quality_scores(tables("documents"), labels.where("false")).where(F.col("score") == 0.5).count() == 1000


def test_repeated_phrases_and_rare_words_are_learned(spark):
    rng = random.Random(4)

    def some(n):
        return " ".join("".join(rng.choices("abcdeghkmnrstu", k=5)) for _ in range(n))

    toxic = [f"{some(6)} you zwurbel thing {some(6)}" for _ in range(600)] + [f"{some(6)} zwurbel {some(6)}" for _ in range(400)]
    toxic += [f"{some(6)} frobnitz {some(6)}" for _ in range(15)]
    clean = [f"{some(5)} you {some(3)} thing {some(5)}" for _ in range(3000)]
    clean += [f"{some(5)} shared words here {some(5)}" for _ in range(200)]
    sample = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in clean], "text string, label int")
    weights = toxicity.learn_weights(sample, toxicity.Settings())
    assert any(toxicity.folded("zwurbel").strip().startswith(w) for w in weights)
    assert any(toxicity.folded("frobnitz").strip().startswith(w) for w in weights)
    lexicon = toxicity.Lexicon(weights, [])
    assert sum(bool(toxicity.matches(toxicity.folded(t), lexicon)) for t in toxic) == len(toxic)
    assert sum(bool(toxicity.matches(toxicity.folded(t), lexicon)) for t in clean) < 10


def test_folding():
    assert toxicity.folded("You 1d10t, l0ser! $tupid раthetіc ｔｒａｓｈ lo\u200bser café 105") == " you idiot ioser stupid pathetic trash ioser cafe 105 "
    assert toxicity.folded("").split() == []


def test_exception_phrases_cancel_matches():
    lexicon = toxicity.Lexicon({"tras": 3.0, "trash": 5.0}, ["trash can"])
    assert toxicity.matches(toxicity.folded("a trash can"), lexicon) == []
    assert [m[2] for m in toxicity.matches(toxicity.folded("trash, trashy tray"), lexicon)] == [5.0, 5.0]


def test_repetition_is_visible_to_the_quality_features():
    settings = quality.Settings()
    pairs = quality.features(quality.code_points("be be ge ge"), settings)[1]
    assert pairs[0] == pairs[2] != pairs[1]


def test_families_are_asked_first():
    model = language.fit([("the thing and that", "en"), ("der die und das", "de"), ("le la les et une", "fr")] * 4)
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"]}
    assert model.duels == [("germanic", "romance", True), ("de", "en", False)]
    assert language.predict("der die und das", model, language.Settings())[0] == "de"


def test_language_features_keep_their_rows_and_stay_sparse():
    settings = language.Settings()
    assert settings.bits == 15
    used, share = language.frequencies("der die und das", settings)
    assert len(used) == len(share) < 60 and abs(share.sum() - 1) < 1e-5
    rows = [(f"{chr(97 + k)}{chr(97 + n)} wort", f"l{k:02}") for k in range(12) for n in range(25)] * 8
    tracemalloc.start()
    model = language.fit(rows, language.Settings(epochs=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # As a dense matrix the frequencies alone would take 4 << 15 bytes for each of 2400 texts.
    assert peak - model.table.nbytes < len(rows) * (4 << 15) / 10


def test_samples_are_the_smallest_hashes_and_bounded(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit("de").alias("lang"))
    hot = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("z"), "id").alias("text"), F.lit("de").alias("lang"))
    docs, labels = docs.union(hot), spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    wanted = [r[0] for r in labels.orderBy(F.xxhash64("doc_id")).limit(100).collect()]
    found = sampling.labelled_rows(docs, labels, "quality", F.lit(True), 100).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(wanted)
    learnable = labels.where(remainder("doc_id", 5) != 0)
    wanted = [f"t{r[0]}" for r in learnable.orderBy(F.xxhash64("doc_id")).limit(50).collect()]
    found = language.language_sample(docs, language.Settings(rows_per_language=50))
    assert sorted(t for t, _ in found) == sorted(wanted)
    everything = language.language_sample(docs, language.Settings(rows_per_language=100_000))
    assert len(everything) == learnable.count()


def test_toxicity_takes_texts_in_small_batches(spark, capsys):
    """Scoring holds no Arrow batches of texts, runs once a row, and keeps ids as they are, beside null ids as well."""
    lexicon = toxicity.Lexicon({"tras": 3.0}, ["trash can"], 2.0, -1.0)
    rows = [(2**53 + 1, "you trash"), (None, "a trash can"), (3, None), (3, "trash " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = toxicity.score(docs, lexicon)
    kept = docs.where(toxicity.scorer(spark, lexicon)(F.coalesce("text", F.lit(""))) < 0.7)
    for df in (scored, kept):
        df.explain()
        plan = capsys.readouterr().out
        assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan and plan.count("BatchEvalPython") == 1
    assert scored.schema.simpleString() == "struct<doc_id:bigint,score:double,n_matches:int>"
    expected = [1 / (1 + math.exp(1 - 2 * toxicity.density(text or "", lexicon))) for _, text in rows]
    found = scored.collect()  # in the order of the rows
    assert [(r["doc_id"], r["n_matches"]) for r in found] == [(2**53 + 1, 1), (None, 0), (3, 0), (3, 5)]
    assert [r["score"] for r in found] == pytest.approx(expected)
    assert [tuple(r) for r in kept.collect()] == [row for row, x in zip(rows, expected, strict=True) if x < 0.7]


def test_toxicity_learns_beside_texts_without_words(spark):
    """Labelled texts that are null, empty or signs alone use no word; what the others teach stays the same."""
    rng = random.Random(5)

    def some(n):
        return " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))

    texts = [f"{some(6)} zwurbel {some(6)}" for _ in range(60)] + [some(13) for _ in range(60)]
    rows = [(i, text, int(i < 60)) for i, text in enumerate(texts)]
    odd = [(200, None, 0), (201, "", 1), (202, "?! ...", 0), (203, "\u200b", 1), (204, " ", 1)]
    scores = []
    for some_rows in (rows, rows + odd):
        docs = spark.createDataFrame([r[:2] for r in some_rows], "doc_id long, text string")
        labels = spark.createDataFrame([(r[0], r[2]) for r in some_rows], "doc_id long, toxic int")
        sample = sampling.labelled_rows(docs, labels, "toxic", F.lit(True), 1000)
        assert sample.count() == len(some_rows)
        weights = toxicity.learn_weights(sample, toxicity.Settings())
        assert "zwur" in weights
        scores.append(weights)
        found = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, labels).collect()}
        assert len(found) == len(some_rows) and all(0 <= r["score"] <= 1 for r in found.values())
    assert scores[0] == scores[1]
    assert all(found[i]["n_matches"] == 0 for i in range(200, 205))
