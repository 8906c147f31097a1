"""Language identification by hierarchical discrimination.

Relative frequencies of hashed character n-grams describe a text. Linear support vector machines,
one versus one, first vote for the language family and then, inside that family, for the language.
All machines are linear in the frequencies, so scoring looks up one row per n-gram and averages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import mapped, nonempty, remainder
from tabloom.llm.hashing import BASE, code_points
from tabloom.llm.quality import pieces
from tabloom.llm.sampling import MARGIN, hash_share

#: The family of each language code; a code that is missing here is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
NO_LANGUAGE = "und"


@dataclass(frozen=True)
class Settings:
    bits: int = 15
    sizes: tuple[int, ...] = (1, 2, 3)
    rows_per_language: int = 500
    epochs: int = 12
    seed: int = 7


def ngrams(piece: np.ndarray, settings: Settings) -> np.ndarray:
    """Table rows of the n-grams of lower-cased letters; every other sign counts as one blank."""
    shift = np.uint64(64 - settings.bits)
    h, found = piece.astype(np.uint64) + np.uint64(1), []
    for n in range(1, max(settings.sizes) + 1):
        if n > 1:
            h = h[:-1] * BASE + piece[n - 1 :]
        if n in settings.sizes and len(h):
            found.append((h * np.uint64(0xD6E8FEB86659FD93 + 2 * n)) >> shift)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


_letter_table = np.zeros(0, np.uint32)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with blanks for non-letters and no double blanks."""
    global _letter_table
    if not len(_letter_table):
        _letter_table = np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint32)
    cps = _letter_table[code_points(text.lower())]
    blank = cps == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return np.concatenate([[32], cps[keep], [32]]).astype(np.uint32) if keep.any() and not blank.all() else cps[:0]


def frequencies(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text and their relative frequencies."""
    counts = np.zeros(1 << settings.bits)
    for piece in pieces(letters(text)):
        counts += np.bincount(ngrams(piece, settings).astype(np.int64), minlength=len(counts))
    used = np.flatnonzero(counts)
    return used.astype(np.int32), (counts[used] / max(counts.sum(), 1)).astype(np.float32)


def svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """A linear support vector machine for ``y`` in -1 and 1 by the averaged subgradient method on
    the hinge loss, both classes weighing the same. ``x`` holds table rows and frequencies of each
    text, so what a duel needs besides them is a few vectors. Returns weights and offset."""
    rng = np.random.default_rng(settings.seed)
    size = float(np.mean([np.sqrt(share @ share) for _, share in x]) or 1.0)
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    w, b, mean_w, mean_b, step, penalty = np.zeros(1 << settings.bits), 0.0, np.zeros(1 << settings.bits), 0.0, 0, 1e-4
    for _ in range(settings.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 16):
            k = order[at : at + 16]
            step += 1
            rate = 1 / (1 + penalty * step)
            margin = np.array([x[i][1] @ w[x[i][0]] for i in k]) / size + b
            wrong = k[y[k] * margin < 1]
            pull = (weight[wrong] * y[wrong]) / 16
            w *= 1 - rate * penalty
            for i, p in zip(wrong, pull, strict=True):
                w[x[i][0]] += (rate * p / size) * x[i][1]
            b += 0.1 * rate * pull.sum()
            mean_w += w
            mean_b += b
    return (mean_w / max(step, 1) / size).astype(np.float32), float(mean_b / max(step, 1))


@dataclass
class Model:
    """``duels``: pairs of groups; column k of ``table`` and ``offset[k]`` decide duel k. A family
    duel names families, a language duel two languages of one family."""

    families: dict[str, list[str]]
    duels: list[tuple[str, str, bool]]
    table: np.ndarray
    offset: np.ndarray


def fit(rows: list[tuple[str, str]], settings: Settings = Settings()) -> Model:
    """Learn from (text, language) pairs."""
    families: dict[str, list[str]] = {}
    for lang in sorted({lang for _, lang in rows}):
        families.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
    duels = [(a, b, True) for a, b in combinations(sorted(families), 2)]
    duels += [(a, b, False) for members in families.values() for a, b in combinations(members, 2)]
    x = [frequencies(text, settings) for text, _ in rows]
    lang = np.array([lang for _, lang in rows], object)
    family = np.array([FAMILY_OF.get(v, v) for v in lang], object)
    table, offset = np.zeros((1 << settings.bits, len(duels)), np.float32), np.zeros(len(duels))
    for k, (a, b, by_family) in enumerate(duels):
        group = family if by_family else lang
        use = np.flatnonzero((group == a) | (group == b))
        table[:, k], offset[k] = svm([x[i] for i in use], np.where(group[use] == a, 1.0, -1.0), settings)
    return Model(families, duels, table, offset)


def vote(names: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
    """The name with most duels won, then the largest sum of margins, then the first; its support."""
    if len(names) == 1:
        return names[0], 1.0
    wins, sums, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
    for (a, b), margin in margins.items():
        wins[a if margin >= 0 else b] += 1
        for name, own in ((a, margin), (b, -margin)):
            sums[name] += own
            least[name] = min(least[name], own)
    best = min(names, key=lambda n: (-wins[n], -sums[n], n))
    return best, float(1 / (1 + np.exp(-2 * np.clip(least[best], -30, 30))))


def predict(text: str, model: Model, settings: Settings) -> tuple[str, float]:
    """Language and support of one whole text; ``und`` and 0 without a letter or without a model."""
    total, count = np.zeros(len(model.duels)), 0
    signs = letters(text)
    if not len(signs) or not model.families:
        return NO_LANGUAGE, 0.0
    for piece in pieces(signs):
        rows = ngrams(piece, settings)
        used = np.bincount(rows.astype(np.int64), minlength=1 << settings.bits).astype(np.float32)
        total += used @ model.table
        count += len(rows)
    margins = total / count + model.offset
    of = {(a, b, f): m for (a, b, f), m in zip(model.duels, margins, strict=True)}
    family, sure = vote(sorted(model.families), {(a, b): m for (a, b, f), m in of.items() if f})
    members = model.families[family]
    lang, surer = vote(members, {(a, b): m for (a, b, f), m in of.items() if not f and a in members and b in members})
    return lang, sure * surer


def language_sample(documents: DataFrame, settings: Settings) -> list[tuple[str, str]]:
    """For each language the ``rows_per_language`` learnable documents with the smallest hash of
    their id (a bounded sample), of several texts of an id the smallest. Ids are counted first, and
    only those in the lowest share of hashes are ranked; texts are read for the chosen ids only."""
    known = documents.where((remainder("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = known.select("doc_id", "lang").distinct()
    # One row per language, as in the model itself.
    sizes = ids.groupBy("lang").agg(F.count("*").alias("_ids"))
    low = ids.join(F.broadcast(sizes), "lang").where(hash_share("doc_id") * F.col("_ids") <= MARGIN * (settings.rows_per_language + 25))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = low.withColumn("_n", place).where(F.col("_n") <= settings.rows_per_language).select("doc_id", "lang")
    found = known.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"])
    found = found.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    return [(r["text"], r["lang"]) for r in sorted(found.collect(), key=lambda r: (r["doc_id"], r["lang"]))]


def languages(documents: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) for every row. Null texts and texts without
    a letter are ``und`` with score 0; other columns are left behind; repeated rows stay."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 4 * 2**bits bytes per duel

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for batch in batches:
            found = [predict(text, fitted, settings) for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
            )

    return mapped(documents.select("doc_id", nonempty(F.col("text")).alias("text")), run, "doc_id long, lang_pred string, score double")


def language_predictions(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on documents with a language whose CRC-32 of the id leaves a remainder other than 0
    modulo 5; predict all. Columns ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    model = fit(language_sample(documents, settings), settings)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return languages(documents, model, settings).select("doc_id", held_out, "lang_pred", "score")
