"""Reading level of documents on the scale of graded passages.

Classic formulas are computed from the lengths of sentences and words and from
syllables counted by hyphenation-style rules. Graded passages of each language
place every formula's values on their scale of bands; the level of a text is
the median of the formulas' estimates.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import to_latin, within
from .langid import MAX_PASSAGES, CrossParser

#: Words, by white space, below which a text has no level.
MIN_WORDS = 40
#: Features of this many distinct words are kept by a worker; then it forgets
#: them all and computes them anew (only speed depends on it).
KEPT_WORDS = 1_000_000

_SLAVIC = {"sl", "hr", "sr"}
_EVERY_VOWEL = re.compile("[aeiouáéíóúöüőű]")
_R_SYLLABLE = re.compile(r"(?<![aeiou])r(?![aeiou])")
_GERMAN = re.compile("ie|[ae]i|[aäe]u|[aeiouäöüy]")
_ENGLISH = re.compile("[aeiouy]+")
_ITALIAN = re.compile("[aeou][iu](?![aeou])|[iu][aeouàèéòù]|[aeiouàèéìíòóùú]")


# Consonants that begin a syllable together, before l and r, and the digraphs of the languages.
_STOPS, _TOGETHER = frozenset("bcdfgkptvčšžshz"), frozenset("ch ck ph qu sch sh th lj nj dž gy ly ny ty cs sz zs gn sp st šk šp št sv zv".split())


def _nuclei(word: str, lang: str) -> list[tuple[int, int]]:
    """Where the vowels of syllables stand."""
    if lang in _SLAVIC:
        marks = list(_EVERY_VOWEL.finditer(word)) + (list(_R_SYLLABLE.finditer(word)) if len(word) > 1 else [])
    else:
        marks = list({"hu": _EVERY_VOWEL, "de": _GERMAN, "it": _ITALIAN}.get(lang, _ENGLISH).finditer(word))
    spans = sorted(m.span() for m in marks)
    if lang == "en" and len(spans) > 1:
        # a silent e at the end, and in -ed but after t and d
        if word.endswith("e") and not word.endswith(("le", "ee")) or word.endswith("ed") and not word.endswith(("ted", "ded")):
            spans = spans[:-1]
    return spans


def divided(word: str, lang: str) -> list[str]:
    """The word's parts between which that language may hyphenate it: before
    the last consonant between two vowels, or before consonants that begin a
    syllable together. Expects lower case."""
    word = to_latin(word) if lang in _SLAVIC else word
    spans, cuts = _nuclei(word, lang), []
    for (_, end), (start, _) in zip(spans, spans[1:]):
        between = word[end:start]
        onset = min(1, len(between))
        for n in (3, 2):
            last = between[-n:]
            if len(last) == n and (last in _TOGETHER or (n == 2 and last[0] in _STOPS and last[1] in "lr")):
                onset = n
                break
        cuts.append(start - onset)
    return [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])]


def syllables(word: str, lang: str) -> int:
    """Parts of the word by hyphenation-style rules; at least one."""
    return len(divided(word, lang))


def formulas(sentences, words, letters, syll, poly, long) -> np.ndarray:
    """Rows: texts; columns: Flesch-Kincaid, Flesch (negative), fog, SMOG,
    automated index, Coleman-Liau, LIX, RIX, Gulpease (negative)."""
    s, w = np.maximum(sentences, 1), np.maximum(words, 1)
    wps, spw, cpw = w / s, syll / w, letters / w
    return np.stack([
        0.39 * wps + 11.8 * spw - 15.59,
        -(206.835 - 1.015 * wps - 84.6 * spw),
        0.4 * (wps + 100 * poly / w),
        1.043 * np.sqrt(poly * 30 / s) + 3.1291,
        4.71 * cpw + 0.5 * wps - 21.43,
        5.88 * cpw - 29.6 * s / w - 15.8,
        wps + 100 * long / w,
        long / s,
        -(89 + (300 * s - 10 * letters) / w),
    ], 1)


class Reader:
    """Measures texts; keeps the features of words seen."""

    def __init__(self, labelled: dict[str, str]):
        self.parser = CrossParser(labelled)
        self.languages = self.parser.languages
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.cores: list[str] = []
        k = len(self.languages)
        self.phrases = np.zeros((0, k), np.int16)
        self.syll = np.zeros((0, k), np.int16)
        self.flat = np.zeros((0, 3), np.int16)  # letters, ends a sentence, long

    def _learn(self, words: list[str]) -> None:
        cores = [w.lower().strip(".,;:!?()[]„“”»«\"'–—…-") for w in words]
        n = [len(c) for c in cores]
        ends = [w.rstrip("“”»«\"'")[-1:] in ".!?…" and not ("(" in w and ")" not in w) for w in words]
        flat = np.array([[a, e, a > 6] for a, e in zip(n, ends)], np.int16).reshape(-1, 3)
        self.flat = np.concatenate([self.flat, flat])
        self.cores += cores
        self.syll = np.concatenate([self.syll, np.full((len(words), len(self.languages)), -1, np.int16)])
        self.phrases = np.concatenate([self.phrases, self.parser.phrases(cores).astype(np.int16)])
        at = len(self.index)
        self.index.update((w, at + i) for i, w in enumerate(words))

    def measure(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: words, index of the main language, formulas' values over
        the paragraphs in it."""
        if len(self.index) > KEPT_WORDS:
            self.forget()
        paras = [(i, p.split()) for i, t in enumerate(texts) for p in (t or "").split("\n\n")]
        new = {w for _, p in paras for w in p} - self.index.keys()
        if new:
            self._learn(sorted(new))
        k, n = len(self.languages), len(texts)
        row = np.array([i for i, p in paras if p], np.int64)
        sizes = np.array([len(p) for _, p in paras if p], np.int64)
        if not len(row):
            return np.zeros(n, np.int64), np.zeros(n, np.int64), formulas(*[np.zeros(n)] * 6)
        get = self.index.__getitem__
        ids = np.fromiter((get(w) for _, p in paras for w in p), np.int64, int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        total = lambda m: np.add.reduceat(m[ids], starts, axis=0, dtype=np.int64)
        best = total(self.phrases).argmin(1)
        votes = np.zeros((n, k), np.int64)
        np.add.at(votes, (row, best), sizes)
        main = votes.argmax(1)
        home = best == main[row]
        lang = np.repeat(main[row], sizes)
        syll = self.syll[ids, lang]
        if (syll < 0).any():
            for x in np.unique(ids[syll < 0] * k + lang[syll < 0]).tolist():
                core = self.cores[x // k]
                self.syll[x // k, x % k] = syllables(core, self.languages[x % k]) if core else 0
            syll = self.syll[ids, lang]
        flat, poly = total(self.flat), np.add.reduceat(syll > 2, starts, dtype=np.int64)
        parts = np.stack([flat[:, 1], sizes, flat[:, 0], np.add.reduceat(syll, starts, dtype=np.int64), poly, flat[:, 2]], 1)
        sums = np.zeros((n, 6))
        np.add.at(sums, row[home], parts[home])
        return votes.sum(1), main, formulas(*sums.T)


class Scale:
    """Places formulas' values on the bands of graded passages.

    A formula takes part, in a language, if it puts at least GOOD of that
    language's passages into their band; of fewer than three such formulas the
    best three do."""

    GOOD = 0.9

    def __init__(self, passages: list[tuple[str, int, str]]):
        texts: dict[str, list[str]] = {}
        for lang, _, text in passages:
            texts.setdefault(lang, []).append(text)
        self.reader = Reader({k: " ".join(v) for k, v in texts.items()})
        _, _, values = self.reader.measure([t for _, _, t in passages])
        bands = np.array([b for _, b, _ in passages], float)
        langs = np.array([lang for lang, _, _ in passages])
        self.levels = np.array(sorted(set(bands)))
        self.points, self.used = {}, {}
        for i, lang in enumerate(self.reader.languages):
            at = langs == lang
            of = [values[at & (bands == b)] for b in self.levels]
            if any(len(x) == 0 for x in of):
                raise ValueError(f"no graded passage of every band in {lang}")
            self.points[i] = np.maximum.accumulate([np.median(x, 0) for x in of], 0)
            right = [np.mean(np.abs(e - bands[at]) < 0.5) for e in self._each(i, values[at], range(values.shape[1]))]
            ranked = np.argsort(right, kind="stable")[::-1]
            self.used[i] = sorted(f for n, f in enumerate(ranked) if n < 3 or right[f] >= self.GOOD)

    def _each(self, lang: int, values: np.ndarray, which) -> list[np.ndarray]:
        points = self.points[lang]
        return [np.interp(values[:, f], points[:, f] + np.arange(len(points)) * 1e-9, self.levels) for f in which]

    def estimate(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: words, main language, level (median of the estimates)."""
        words, main, values = self.reader.measure(texts)
        level = np.zeros(len(texts))
        for i in self.points:
            at = main == i
            if at.any():
                level[at] = np.median(self._each(i, values[at], self.used[i]), 0)
        return words, main, level


@functools.lru_cache(2)
def _scale(blob: bytes) -> Scale:
    return Scale(pickle.loads(blob))


def reading_levels(documents: DataFrame, graded: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, lang (main language), level (a number on the scale), band (the
    nearest band) of every text of at least `min_words` words; null, empty and
    shorter texts have no row. The graded passages are a bounded sample
    (MAX_PASSAGES)."""
    graded = graded.where("lang is not null and band is not null and text is not null").select("lang", "band", "text").distinct()
    rows = sorted((r["lang"], r["band"], r["text"]) for r in within(graded, MAX_PASSAGES, "graded passages"))
    blob = documents.sparkSession.sparkContext.broadcast(pickle.dumps(rows))
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scale = _scale(blob.value)
        for b in batches:
            words, main, level = scale.estimate(b["text"].tolist())
            keep = words >= min_words
            yield pd.DataFrame({
                "doc_id": b["doc_id"][keep], "lang": np.array(scale.reader.languages)[main[keep]],
                "level": level[keep], "band": np.floor(level[keep] + 0.5).astype(np.int32),
            })

    return documents.where(F.col("text").isNotNull()).select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, lang string, level double, band int"
    )
