"""Scores of fitted models recomputed in plain Python, sign by sign."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from tabloom.llm import hashing, language, quality, queries, sampling, toxicity
from tabloom.llm.common import remainder

FULL = 1 << 64
BASE = int(hashing.BASE)
ODD = ["", "a", "!!", "  two  spaces\n\n", "Ünïcödé тест 中文 \U00030000\U00030001", "x" * 3000, "be be be be", "1d10t l0ser, you 1diot!", "trash can"]


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % FULL
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % FULL
    return x ^ (x >> 31)


def gram_row(signs, bits):
    h = ord(signs[0]) + 1
    for c in signs[1:]:
        h = (h * BASE + ord(c)) % FULL
    return (h * (0xD6E8FEB86659FD93 + 2 * len(signs)) % FULL) >> (64 - bits)


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_quality(text, values, offset, settings, piece):
    sums, counts = [0.0] * (2 + len(settings.sizes)), [0] * (2 + len(settings.sizes))
    while text:
        part = text[:piece]
        if len(text) > piece:
            last = max((k for k, c in enumerate(part) if ord(c) <= 32), default=None)
            part = part if last is None else part[: last + 1]
        text = text[len(part) :]
        words = "".join(c if ord(c) > 32 else " " for c in part).split(" ")
        names = [mixed(sum((ord(c) + 1) * pow(BASE, k, FULL) for k, c in enumerate(w)) % FULL) for w in words if w]
        pairs = [0xABCDEF0123456789 if a == b else mixed((a * BASE + b + 1) % FULL) for a, b in zip(names, names[1:])]
        kinds = [[n >> (64 - settings.bits) for n in names], [n >> (64 - settings.bits) for n in pairs]]
        kinds += [[gram_row(part[k : k + n], settings.bits) for k in range(len(part) - n + 1)] for n in settings.sizes]
        for k, rows in enumerate(kinds):
            sums[k] += sum(float(values[r]) for r in rows)
            counts[k] += len(rows)
    return sigmoid(offset + sum(s / max(n, 1) for s, n in zip(sums, counts, strict=True)))


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_quality_scores(spark, sf_dir, monkeypatch, piece):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    settings = quality.Settings()
    rows = sampling.collected(sampling.labelled_rows(docs, labels, "quality", remainder("doc_id", 5) != 0, settings.sample_rows))
    values, offset = quality.fit(rows, settings)
    found = {r["doc_id"]: (r["score"], r["predicted"]) for r in queries.op1_quality(spark, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    monkeypatch.setattr(quality, "PIECE", piece)
    for doc, text in sorted(texts.items())[:60]:
        wanted = plain_quality(text, values, offset, settings, 1 << 20)
        assert found[doc] == (pytest.approx(wanted, abs=1e-6), int(wanted >= 0.3))
    for text in [*ODD, "word and word " * 20]:
        assert sigmoid(offset + quality.mean_of(values, text, settings)) == pytest.approx(plain_quality(text, values, offset, settings, piece), abs=1e-6)


def plain_language(text, model, settings):
    signs = []
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or (signs and signs[-1] != " "):
            signs.append(c)
    if not any(c != " " for c in signs):
        return "und", 0.0
    padded = " " + "".join(signs) + " "
    rows = [gram_row(padded[k : k + n], settings.bits) for n in settings.sizes for k in range(len(padded) - n + 1)]
    margins = [sum(float(model.table[r, k]) for r in rows) / len(rows) + float(b) for k, b in enumerate(model.offset)]

    def winner(names, of):
        """Who wins most duels, then by the sum of margins, then by name; with the support of the closest duel."""
        if len(names) == 1:
            return names[0], 1.0
        own = {n: [m if a == n else -m for (a, b), m in of.items() if n in (a, b)] for n in names}
        wins = {n: sum(m >= 0 if (a == n) else m < 0 for (a, b), m in of.items() if n in (a, b)) for n in names}
        best = sorted(names, key=lambda n: (-wins[n], -sum(own[n]), n))[0]
        return best, sigmoid(2 * min(own[best]))

    family, sure = winner(sorted(model.families), {d[:2]: m for d, m in zip(model.duels, margins, strict=True) if d[2]})
    members = model.families[family]
    inside = {d[:2]: m for d, m in zip(model.duels, margins, strict=True) if not d[2] and d[0] in members}
    lang, surer = winner(members, inside)
    return lang, sure * surer


def test_language_votes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    settings = language.Settings()
    model = language.fit(language.language_sample(docs, settings), settings)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in queries.op8_language(spark, sf_dir).collect()}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"])[:60]:
        wanted, sure = plain_language(r["text"] or "", model, settings)
        assert found[r["doc_id"]] == (wanted, pytest.approx(sure, abs=1e-5))
    for text in ODD:
        wanted, sure = plain_language(text, model, settings)
        assert language.predict(text, model, settings) == (wanted, pytest.approx(sure, abs=1e-5))
    # Letters of every plane are letters.
    assert language.predict("\U00030000", model, settings)[0] != "und" and language.predict("\U0001f600 1", model, settings) == ("und", 0.0)


def plain_density(text, lexicon):
    """Every word start is tried with every entry and every exception phrase, without an automaton."""
    flat = toxicity.folded(text)
    total = 0.0
    for at, sign in enumerate(flat):
        if sign != " ":
            continue
        fitting = [w for w in lexicon.weights if flat.startswith(" " + w, at)]
        if not fitting:
            continue
        entry = max(fitting, key=len)
        end = at + 1 + len(entry)
        free = any(flat.startswith(f" {p} ", k) and k + len(p) + 2 >= end for p in lexicon.exceptions for k in range(at + 1))
        total += 0.0 if free else lexicon.weights[entry]
    return math.log1p(1000 * total / max(len(flat.split()), 1))


def test_toxicity_scores(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    settings = toxicity.Settings()
    lexicon = toxicity.fit(sampling.labelled_rows(docs, labels, "toxic", remainder("doc_id", 3) != 1, settings.sample_rows), settings)
    assert lexicon.weights
    found = {r["doc_id"]: (r["score"], r["held_out"]) for r in queries.op5_toxicity(spark, sf_dir).collect()}
    for r in docs.collect():
        wanted = sigmoid(lexicon.slope * plain_density(r["text"] or "", lexicon) + lexicon.offset)
        assert found[r["doc_id"]] == (pytest.approx(wanted, abs=1e-9), zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_matches_and_exceptions_of_random_texts():
    rng = random.Random(3)
    stems = ["ab", "abc", "abcd", "ba", "bab", "cc"]
    for _ in range(200):
        words = ["".join(rng.choices("abc", k=rng.randrange(1, 6))) for _ in range(rng.randrange(0, 40))]
        lexicon = toxicity.Lexicon({s: 1.0 + len(s) for s in rng.sample(stems, 3)}, [" ".join(rng.choices(words or ["a"], k=2)) for _ in range(4)])
        text = " ".join(words)
        assert toxicity.density(text, lexicon) == pytest.approx(plain_density(text, lexicon))
    # A very long text with as many exceptions as matches takes no more than sorted intervals do.
    long = toxicity.Lexicon({"ab": 1.0}, ["ab cc"])
    assert len(toxicity.matches(toxicity.folded("ab cc ab dd " * 100_000), long)) == 100_000


def test_signs_of_the_upper_planes_are_folded():
    assert np.array_equal(toxicity.folded("a\U00030000b \U000e0100x").split(), ["a\U00030000b", "x"])
