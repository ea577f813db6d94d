"""Passages of test items inside long documents, by MinHash containment.

Documents are cut into overlapping blocks of about an item's size, in classes
by the number of shingles they hold, so that the containment of a short
passage in a long document becomes a similarity of two sets of like size. Each
block has one minimum for each of K hash functions; it is a candidate for a
passage of an item if enough minima agree for the block's size class. Phrases
usual among the items themselves take no part in the minima; where they leave a
stretch of an item few shingles, which minima would often miss, each of these
is looked up as it is. Candidates are verified by exact shingle containment
along the passage.

A block holds 36 words and begins every 8, a passage 24 words every 4, so that
a copied passage of two dozen words lies within one block.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold
from .langid import pieces

#: Words of a shingle. Passages may be altered in any few words, so that longer
#: ones would often all be broken.
SHINGLE = 3
HASHES = 32
PASSAGE, PASSAGE_STEP = 24, 4
STEP, STEPS = 8, 4
#: A shingle in more items than this is a usual phrase.
USUAL = 3
#: Items with this share of shingles in common are one item.
SAME = 0.92
#: Share of a passage's shingles that a block must be estimated to hold.
CONTAINMENT = 0.6
#: Verified: words in agreement, share of the passage's shingles from the first
#: to the last that are met, words in few items (places, figures) among them.
MIN_WORDS, MIN_SHARE, MIN_RARE = 19, 0.4, 2
#: In an item's stretches of a passage's length with fewer shingles that aren't
#: usual, these propose candidates one by one.
FEW = (PASSAGE - SHINGLE + 1) // 2
#: Items that are searched at once; more are taken in so many rounds.
ITEMS_PER_ROUND = 50_000
KEPT_WORDS = 1_000_000

_OFF = re.compile(r"[\W_]+")
_EMPTY = np.uint64(0)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_MULTIPLIERS = np.array([xxhash.xxh64_intdigest(f"m{k}") | 1 for k in range(HASHES)], np.uint64)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(SHINGLE)], np.uint64)


class Words(dict):
    """Raw word to the hash of its letters and figures; 0 if it has none."""

    def __missing__(self, raw: str) -> int:
        core = _OFF.sub("", fold(raw))
        self[raw] = h = (xxhash.xxh64_intdigest(core) or 1) if core else 0
        return h


def _shingles(words: np.ndarray) -> np.ndarray:
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64)
    n = len(words) - SHINGLE + 1
    out = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        out += words[i : n + i] * _POWERS[i]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.minimum(out, _TOP - np.uint64(1))


class Filter:
    """Fast test for membership in a small sorted set of 64-bit numbers."""

    BITS = 20

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(self.values >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> np.ndarray:
        """Positions in x (flat) whose values are in the set."""
        at = np.flatnonzero(self.bits.take((x >> np.uint64(64 - self.BITS)).astype(np.int64).ravel()))
        if not len(at) or not len(self.values):
            return at[:0]
        v = x.ravel()[at]
        near = np.minimum(np.searchsorted(self.values, v), len(self.values) - 1)
        return at[self.values[near] == v]


def _few(told: np.ndarray) -> np.ndarray:
    """Places of the shingles told, those that aren't usual, in stretches of
    a passage's length that have fewer than FEW of them."""
    n = min(PASSAGE - SHINGLE + 1, len(told))
    sums = np.concatenate([[0], np.cumsum(told)])
    poor = np.flatnonzero(sums[n:] - sums[: len(sums) - n] < FEW)
    return np.intersect1d(np.flatnonzero(told), (poor[:, None] + np.arange(n)[None, :]).ravel())


def _item_words(text: str, words: Words) -> np.ndarray:
    return np.array([h for h in map(words.__getitem__, text.split()) if h], np.uint64)


def usual(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words and shingles in more than USUAL texts. Texts that share SAME of
    their shingles count once, so that an item that stands in many suites with
    a word changed isn't taken for a usual phrase."""
    words, sets, lead = Words(), {}, {}
    for t in texts:
        w = _item_words(t, words)
        sets.setdefault(xxhash.xxh128_digest(w.tobytes()), w)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for w in sets.values():
        s = np.unique(_shingles(w))
        if not len(s):
            continue
        minima = (s[None, :] * _MULTIPLIERS[:16, None]).min(1)
        near = {lead[k, m] for k, m in enumerate(minima.tolist()) if (k, m) in lead}
        if any(len(np.intersect1d(s, kept[n][1])) >= SAME * max(len(s), len(kept[n][1])) for n in near):
            continue
        for k, m in enumerate(minima.tolist()):
            lead.setdefault((k, m), len(kept))
        kept.append((np.unique(w), s))
    out = []
    for parts in ([w for w, _ in kept], [s for _, s in kept]):
        values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)
        out.append(values[n > USUAL])
    return out[0], out[1]


class Index:
    """Minima of the passages of a bounded set of items; `common` are the
    usual words and shingles of all items."""

    def __init__(self, items: list[tuple[int, str]], common: tuple[np.ndarray, np.ndarray]):
        words = Words()
        self.words = {i: _item_words(t, words) for i, t in items}
        self.rare = {i: ~np.isin(w, common[0]) for i, w in self.words.items()}
        sets = {i: _shingles(w) for i, w in self.words.items()}
        self.usual = Filter(common[1])
        self.places = {i: _positions(s) for i, s in sets.items()}
        mins, who, few = [], [], [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        self.told, self.reach = {}, {}
        for i, s in sets.items():
            s = s.copy()
            s[self.usual.find(s)] = _TOP
            self.told[i] = s != _TOP
            single = np.unique(s[_few(self.told[i])])
            few.append((single, np.full(len(single), i, np.int64)))
            # blocks of usual phrases alone aren't candidates, but may belong to the passage
            self.reach[i] = max(PASSAGE, len(self.words[i])) if self.told[i].sum() < len(s) else PASSAGE
            for at in range(0, max(1, len(s) - (PASSAGE - SHINGLE)), PASSAGE_STEP):
                part = s[at : at + PASSAGE - SHINGLE + 1]
                part = part[part != _TOP]
                if len(part):
                    mins.append((part[None, :] * _MULTIPLIERS[:, None]).min(1))
                    who.append((i, len(np.unique(part))))
        self.size = np.array([n for _, n in who], np.int64)
        self.item = np.array([i for i, _ in who], np.int64)
        singles, of = (np.concatenate(x) for x in zip(*few))
        order = np.argsort(singles, kind="stable")
        self.few = (Filter(singles), singles[order], of[order])
        table = np.array(mins, np.uint64).reshape(-1, HASHES)
        self.by_hash = []
        for k in range(HASHES):
            order = np.argsort(table[:, k], kind="stable")
            self.by_hash.append((Filter(table[:, k]), table[order, k], order))

    def candidates(self, texts: list[np.ndarray]) -> np.ndarray:
        """Rows (text, item, first word of the block)."""
        lengths = [max(0, len(w) - SHINGLE + 1) for w in texts]
        blocks = [-(-n // STEP) + STEPS - 1 for n in lengths]
        base = np.concatenate([[0], np.cumsum(blocks)])
        flat = np.full(int(base[-1]) * STEP, _TOP, np.uint64)
        for w, n, b in zip(texts, lengths, base.tolist()):
            if n:
                flat[b * STEP : b * STEP + n] = _shingles(w)
        flat[self.usual.find(flat)] = _TOP
        off = flat == _TOP
        sizes = (~off).reshape(-1, STEP).sum(1)
        sizes = np.convolve(sizes, np.ones(STEPS, np.int64))[STEPS - 1 :]  # of the block that begins here
        found = []
        n = len(flat) // STEP
        for k in range(HASHES):
            h = flat * _MULTIPLIERS[k]
            h[off] = _TOP
            m = h.reshape(-1, STEP).min(1)
            least = m.copy()
            for s in range(1, STEPS):
                np.minimum(least[: n - s], m[s:], out=least[: n - s])
            quick, values, order = self.by_hash[k]
            at = quick.find(least)
            lo, hi = np.searchsorted(values, least[at]), np.searchsorted(values, least[at], side="right")
            count = hi - lo
            ends = np.cumsum(count)
            if len(at):
                within = np.arange(int(ends[-1])) - np.repeat(ends - count, count)
                found.append(np.repeat(at, count) * len(self.item) + order[np.repeat(lo, count) + within])
        alone = self._alone(flat, base)
        if not found:
            return np.unique(alone, axis=0)
        pairs, agree = np.unique(np.concatenate(found), return_counts=True)
        block, passage = pairs // len(self.item), pairs % len(self.item)
        # size classes: containment c of q shingles in a block of u has similarity cq / (q + u - cq)
        q, u = self.size[passage], np.maximum(1 << np.ceil(np.log2(np.maximum(sizes[block], 1))).astype(np.int64), 1)
        c = np.minimum(np.ceil(CONTAINMENT * q), u)
        need = np.maximum(2, np.floor(HASHES * c / (q + u - c) * 0.6))
        keep = (agree >= np.minimum(need, np.maximum(1, q)))
        block, item = block[keep], self.item[passage[keep]]
        text = np.searchsorted(base, block, side="right") - 1
        return np.unique(np.concatenate([np.stack([text, item, (block - base[text]) * STEP], 1), alone]), axis=0)

    def _alone(self, flat: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Rows (text, item, first word of the block) of shingles that propose candidates one by one."""
        quick, values, items = self.few
        at = quick.find(flat)
        lo, hi = np.searchsorted(values, flat[at]), np.searchsorted(values, flat[at], side="right")
        count = hi - lo
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        block, item = np.repeat(at // STEP, count), items[np.repeat(lo, count) + within]
        text = np.searchsorted(base, block, side="right") - 1
        return np.stack([text, item, (block - base[text]) * STEP], 1)

    def verify(self, words: np.ndarray, item: int, blocks: np.ndarray) -> tuple[float, int] | None:
        """(containment, words in agreement) of the best passage; None if it
        isn't one. Agreement is sought around the candidate blocks along the
        item's order, with at most 4 words more or less between. Where words in
        few items don't tell, all words must agree in a row, and half of the
        shingles must not be usual."""
        lo, hi = max(0, int(blocks.min()) - self.reach[item]), int(blocks.max()) + STEP * STEPS + self.reach[item]
        near, at, whole = self.places[item], defaultdict(set), len(self.words[item])
        # of an item shorter than a passage all words must agree
        need, share = (MIN_WORDS, MIN_SHARE) if whole >= MIN_WORDS else (max(whole, SHINGLE), 1.0)
        fewest = -(-need // SHINGLE)
        s = _shingles(words[lo:hi])
        for j, h in enumerate(s.tolist()):
            if h in near:
                for i in near[h]:
                    at[i - j].add(i)
        best = None
        for d in at:
            if len(at[d]) > need - SHINGLE:
                same = np.array(sorted(at[d]))
                for run in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1):
                    if len(run) > need - SHINGLE and 2 * self.told[item][run].sum() >= len(run):
                        best = max(best or (0.0, 0), (len(run) / (whole - SHINGLE + 1), len(run) + SHINGLE - 1))
            if sum(len(at[e]) for e in range(d - 4, d + 5) if e in at) < fewest:
                continue
            met = np.array(sorted(set().union(*(at[e] for e in range(d - 4, d + 5) if e in at))))
            # runs without a gap of more than 8 shingles
            for run in np.split(met, np.flatnonzero(np.diff(met) > 8) + 1):
                if len(run) < fewest:
                    continue
                covered = np.unique(run[:, None] + np.arange(SHINGLE)[None, :])
                span, rare = run[-1] - run[0] + 1, self.rare[item]
                told = rare[covered].sum()
                if (
                    len(covered) >= need
                    and len(run) >= share * span
                    and told >= max(MIN_RARE, 0.5 * rare[covered[0] : covered[-1] + 1].sum())
                ):
                    best = max(best or (0.0, 0), (len(run) / max(1, len(self.words[item]) - SHINGLE + 1), len(covered)))
        return best


def _positions(shingles: np.ndarray) -> dict[int, list[int]]:
    out: dict[int, list[int]] = defaultdict(list)
    for i, h in enumerate(shingles.tolist()):
        out[h].append(i)
    return out


@functools.lru_cache(2)
def _index(blob: bytes) -> Index:
    return Index(*pickle.loads(blob))


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, containment (share of the item's shingles in its
    longest passage in the document), n_words (words of it in agreement).

    All items are sought in all documents: items are the stated query set and
    go round by round to the executors, documents are read where they lie and
    nothing is shuffled. Null or empty texts on either side leak nothing; an
    item of fewer than MIN_WORDS words is found where it stands whole, one of
    fewer than SHINGLE never; repeated rows of an item count once, repeated texts of documents each by their own id.
    """
    sc = documents.sparkSession.sparkContext
    rows = items.where("text is not null").groupBy("item_id").agg(F.min("text").alias("text")).orderBy("item_id").toLocalIterator()
    rounds: list[list[tuple[int, str]]] = [[]]
    for r in rows:
        if len(rounds[-1]) == ITEMS_PER_ROUND:
            rounds.append([])
        rounds[-1].append((r["item_id"], r["text"]))
    common = usual(t for x in rounds for _, t in x)
    blobs = [sc.broadcast(pickle.dumps((x, common))) for x in rounds if x]
    kind, item_kind = dict(documents.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = f"doc_id {kind}, item_id {item_kind}, containment double, n_words int"

    def search(blob) -> Callable:
        words = Words()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = _index(blob.value)
            for b in batches:
                for part in pieces(b, "text"):
                    if len(words) > KEPT_WORDS:
                        words.clear()
                    get = words.__getitem__
                    texts = [(x := np.fromiter(map(get, t.split()), np.uint64))[x != _EMPTY] for t in part["text"]]
                    out, found = [], index.candidates(texts)
                    if len(found):
                        for same in np.split(found, np.flatnonzero((np.diff(found[:, :2], axis=0) != 0).any(1)) + 1):
                            text, item = int(same[0, 0]), int(same[0, 1])
                            if best := index.verify(texts[text], item, same[:, 2]):
                                out.append((part["doc_id"].iat[text], item, *best))
                    yield pd.DataFrame(out, columns=["doc_id", "item_id", "containment", "n_words"])

        return run

    # one pass over the documents for each round of items: a task builds one index and keeps it
    texts = documents.where("text is not null").select("doc_id", "text")
    passes = [texts.mapInPandas(search(blob), schema) for blob in blobs]
    return functools.reduce(DataFrame.unionByName, passes) if passes else texts.sparkSession.createDataFrame([], schema)
