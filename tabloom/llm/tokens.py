"""Byte-level BPE of whole texts with a published vocabulary, one encoding per distinct word.

The tokenizer splits a text into words before it merges bytes, and never merges across words. So
texts are split here with array operations, every distinct word is encoded once, and the ids are
gathered. Words are merged by the faster of the two installed libraries, with the vocabulary of the
tokenizer's own file; the ids are the same (tested). Texts with signs outside the range that the
splitting covers, or with apostrophes (which start contractions), go through the tokenizer whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from tabloom.llm.hashing import code_points, span_hashes

#: Code points that the array splitting covers, and how many are split at once.
COVERED = 0x250
PIECE = 1 << 21
KNOWN = 400_000


#: The pattern of the vocabulary's words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_sign() -> dict[str, int]:
    """The printable signs that stand for bytes in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others follow from code point 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _kinds() -> np.ndarray:
    kinds = np.full(COVERED, 3, np.uint8)  # other signs
    for c in range(COVERED):
        category = unicodedata.category(chr(c))
        if chr(c).isspace() and not 0x1C <= c <= 0x1F:
            kinds[c] = 0
        elif category[0] in "LN":
            kinds[c] = 1 if category[0] == "L" else 2
    return kinds


def word_starts(cps: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the tokenizer's words start. ``first`` marks the first sign of every text."""
    kind = kinds[cps]
    blank, changed = kind == 0, np.ones(len(cps), bool)
    changed[1:] = kind[1:] != kind[:-1]
    after_space = np.zeros(len(cps), bool)
    after_space[1:] = cps[:-1] == 32
    ends_run = np.zeros(len(cps), bool)
    ends_run[:-1] = blank[:-1] & ~blank[1:] & ~first[1:]
    return first | np.where(blank, changed | ends_run, changed & ~after_space)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per task and file, kept until it is cleared."""
    return Encoder(path)


class Encoder:
    """``ids(texts)`` gives the tokenizer's ids of every text; none are added around it. A text that
    holds one of the vocabulary's added tokens, such as an end mark, goes through the tokenizer whole."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        byte_of = _byte_of_sign()
        ranks = {bytes(byte_of[c] for c in w): k for w, k in self.tokenizer.get_vocab().items() if w not in self.added}
        self.words = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.kinds = _kinds()
        self.forget()

    def forget(self) -> None:
        # Hashes of the known words in order, and where each is in the arrays below.
        self.known = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.starts = np.zeros(1024, np.int64)
        self.sizes = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encode new words, whose hashes are in order, and append their ids to the pool."""
        encoded = [self.words._encode_single_piece(w) for w in words]
        sizes = np.array([len(e) for e in encoded], np.int64)
        flat = np.array([i for e in encoded for i in e], np.uint32)
        at = len(self.known)
        while at + len(words) > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + len(flat)] = flat
        self.starts[at : at + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at : at + len(words)] = sizes
        self.used += len(flat)
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.places = np.insert(self.places, where, np.arange(at, at + len(words)))

    def covered(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of non-empty texts that the array splitting covers."""
        joined = "".join(texts)
        cps = code_points(joined)
        ends = np.cumsum([len(t) for t in texts])
        first = np.zeros(len(cps), bool)
        first[0] = True
        first[ends[:-1]] = True
        starts = np.flatnonzero(word_starts(cps, first, self.kinds))
        stops = np.append(starts[1:], len(cps))
        hashes, where, which = np.unique(span_hashes(cps, starts, stops), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN:
            self.forget()
        near = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[near] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            self.learn(hashes[new], [joined[starts[where[k]] : stops[where[k]]] for k in new])
        place = self.places[np.searchsorted(self.known, hashes)][which]
        sizes = self.sizes[place]
        total = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.starts[place] - (total - sizes), sizes) + np.arange(total[-1])]
        words_before = np.searchsorted(starts, ends)  # words of the texts up to each one
        cuts = total[words_before - 1]
        return np.split(ids, cuts[:-1])

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """In order; a few million signs at a time."""
        batch: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > PIECE and batch:
                yield from self._batch(batch)
                batch, size = [], 0
            batch.append(text)
            size += len(text)
        yield from self._batch(batch)

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain, other = [], []
        for k, t in enumerate(texts):
            if t:
                simple = "'" not in t and (t.isascii() or max(t) < chr(COVERED)) and not any(a in t for a in self.added)
                (plain if simple else other).append(k)
        long = [k for k in plain if len(texts[k]) > PIECE]
        if long:
            plain = [k for k in plain if len(texts[k]) <= PIECE]
        for k in long:
            out[k] = np.concatenate([self.covered([p])[0] for p in parts(texts[k])])
        for chosen, encode in ((plain, self.covered), (other, self.whole)):
            if chosen:
                for k, ids in zip(chosen, encode([texts[k] for k in chosen]), strict=True):
                    out[k] = ids
        return out


def parts(text: str) -> Iterator[str]:
    """A long text cut before single spaces between two other signs, where words always end."""
    start = 0
    while len(text) - start > PIECE:
        cut = start + PIECE
        while cut > start + 1 and not (text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1 : cut + 2].isspace()):
            cut -= 1
        if cut <= start + 1 or cut + 1 >= len(text):
            break
        yield text[start:cut]
        start = cut
    yield text[start:]
