"""Variant spellings of names, linked by weighted character n-grams.

Names and bodies are vectors of character n-grams, weighted by rarity over all
distinct spellings. Pairs above a cosine come from an exact distributed join, n
of the top-n being unbounded: every partner above the threshold is kept. Only
spellings are shuffled, once for each block they are in; their vectors are made
where they meet. Linked spellings are grouped by average linkage on these
cosines; pairs of names, which may be many more than the names, stay in the
task that links them.

Nothing about names or bodies is known beforehand. Which word of a name is the
forename, which forenames stand for each other (familiar forms) and what an
acronym stands for are learned from how they occur together in the rows.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, removed, stored

# Titles before names.
TITLES = frozenset("tov tovaris tovarisica dr mag inz ing prof gospod gospa ga dipl".split())
#: Titles that may be an initial too.
INITIAL_TITLES = frozenset("g".split())

#: n-grams are counted in so many buckets by their hash, which bounds what the
#: driver gets and broadcasts, whatever the number of names.
BUCKETS = 1 << 18
#: Share of all spellings added to the count of each n-gram of names: slips
#: make rare n-grams, which would else rule a vector.
SMOOTH = 0.02
#: Shares of the vector of a name that its last names, and the initial within
#: its forename, make up.
LAST_SHARE, INITIAL_SHARE = 0.62, 0.35
#: Least cosine of pairs that are kept, and mean cosine at which groups merge.
BODY, BODY_LINKAGE = 0.46, 0.41
NAME, NAME_LINKAGE = 0.56, 0.54
#: Least cosine at which a name without a body takes a name's body.
HOME = 0.68
#: A forename stands for another if the two meet in one body under one last
#: name in this share of the groups it stands in.
FAMILIAR_SHARE = 0.3
#: A forename in fewer spellings of whole names may be a slip of another.
RARE = 4
#: Spellings sharing an n-gram beyond which the join splits it over SALTS tasks.
HOT, SALTS = 512, 16
#: Spellings of a block that a task holds to meet all others; a block with more
#: is met in so many parts, one in each round, so that no round shuffles more.
HELD = 20_000
#: Held spellings from which a block is met spelling by spelling.
LONG = 64
#: Spellings whose vectors are made at once where names are linked, besides a
#: longer block's; pairs that are linked at once, besides a larger component's.
LOT, LINKED = 20_000, 200_000

_SPACED = re.compile(r"(?<!\S)((?:\w\s+){2,}\w)(?!\S)")


# --- names into words -------------------------------------------------------------


def _untitled(words: list[str]) -> list[str]:
    """The words of a name, hyphens taken apart, without titles. What may be an
    initial is a title only before another title or two more words of a name."""
    out, named = [], 0
    for i, w in reversed(list(enumerate(words))):
        title = w in TITLES or w in INITIAL_TITLES and (named > 1 or words[i + 1 : i + 2] and words[i + 1] in TITLES)
        if not title:
            out.append(w)
            named += w != "-"
    return [x for w in reversed(out) for x in w.replace("-", " ").split() if x not in TITLES]


def name_words(text: str) -> tuple[list[str], bool]:
    """(folded words without titles, forename first as far as a comma tells;
    whether a comma told)."""
    text = _SPACED.sub(lambda m: re.sub(r"\s+", "", m[1]), text or "")
    comma = "," in text
    parts = [re.sub(r"[^\w\s\-]", " ", fold(p)).split() for p in text.split(",")]
    return _untitled([w for p in (reversed(parts) if comma else parts) for w in p]), comma


def oriented(names: DataFrame, name: str) -> DataFrame:
    """name, first, last of the distinct names: which end is the forename.

    A comma tells, an initial is a forename; else the ends are compared by how
    often they stand first and last in all names and with how many different
    words they stand: forenames stand first, and with many.
    """

    def words(s: pd.Series) -> pd.DataFrame:
        both = [name_words(t) for t in s]
        return pd.DataFrame({"words": [w for w, _ in both], "comma": [c for _, c in both]})

    distinct = names.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    split = F.pandas_udf(words, "words array<string>, comma boolean")(F.col(name))
    df = distinct.select(name, "n", split.alias("s")).select(name, "n", "s.words", "s.comma").where("size(words) > 0")
    n = F.size("words")
    between = F.array_join(F.slice("words", 2, F.greatest(n - 2, F.lit(0))), " ")
    df = cut = stored(df.select(name, "n", "comma", F.col("words")[0].alias("a"), between.alias("between"), F.when(n > 1, F.element_at("words", -1)).alias("z")))
    ends = df.where("z is not null and length(a) > 1 and length(z) > 1")
    stood = ends.select(F.explode(F.array(
        F.struct(F.col("a").alias("w"), F.col("z").alias("with"), F.lit(1).alias("f"), F.col("n")),
        F.struct(F.col("z").alias("w"), F.col("a").alias("with"), F.lit(0).alias("f"), F.col("n")),
    )).alias("s"))
    stood = stood.groupBy("s.w", "s.with").agg(F.sum(F.col("s.f") * F.col("s.n")).alias("f"), F.sum("s.n").alias("n"))
    score = F.log((F.sum("f") + 0.5) / (F.sum("n") - F.sum("f") + 0.5)) + F.log(F.count("*") + 1)
    scores = stored(stood.groupBy("w").agg(score.alias("score")))
    df = df.drop("n").join(scores.select(F.col("w").alias("a"), F.col("score").alias("sa")), "a", "left")
    df = df.join(scores.select(F.col("w").alias("z"), F.col("score").alias("sz")), "z", "left")
    turned = ~F.col("comma") & F.col("z").isNotNull() & F.when(F.length("a") == 1, False).when(F.length("z") == 1, True).otherwise(F.coalesce(F.col("sz") > F.col("sa"), F.lit(False)))
    alone = F.col("z").isNull()
    rest = F.when(alone, F.col("a")).when(turned, F.concat_ws(" ", "a", "between")).otherwise(F.concat_ws(" ", "between", "z"))
    long = F.filter(F.split(rest, " "), lambda w: F.length(w) > 1)
    first = F.when(alone, "").when(turned, F.col("z")).otherwise(F.col("a"))
    return stored(df.select(name, first.alias("first"), F.array_join(long, " ").alias("last")), cut, scores)


# --- vectors and the cosine join ----------------------------------------------------


def grams(word: str) -> list[str]:
    """Stretches of two and three letters."""
    padded = f"^{word}$"
    return [padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1)]


def hashed(fields: list[str]) -> list[int]:
    """Buckets of the n-grams of the words of every field; fields apart."""
    return [zlib.crc32(f"{k}{g}".encode()) % BUCKETS for k, t in enumerate(fields) for w in t.split() for g in grams(w)]


def body_vector(idf: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique(np.array(hashed([text]), np.int64), return_counts=True)
    w = n * idf[at]
    return at, w / (np.sqrt((w**2).sum()) or 1)


def name_vector(idf: np.ndarray, first: str, last: str) -> tuple[np.ndarray, np.ndarray]:
    """A forename's vector is its initial and its n-grams, an initial's the
    initial alone; forename and last names have fixed shares of the whole."""
    parts = []
    if last:
        at, n = np.unique(np.array(hashed(["", last]), np.int64), return_counts=True)
        w = n * idf[at]
        parts.append((at, w / np.sqrt((w**2).sum()) * math.sqrt(LAST_SHARE if first else 1)))
    if first:
        share = 1 - LAST_SHARE if last else 1.0
        initial = zlib.crc32(f"i{first[0]}".encode()) % BUCKETS
        parts.append((np.array([initial]), np.array([math.sqrt(share * (INITIAL_SHARE if len(first) > 1 else 1))])))
        if len(first) > 1:
            at, n = np.unique(np.array(hashed([first]), np.int64), return_counts=True)
            w = n * idf[at]
            parts.append((at, w / np.sqrt((w**2).sum()) * math.sqrt(share * (1 - INITIAL_SHARE))))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0)
    at, back = np.unique(np.concatenate([a for a, _ in parts]), return_inverse=True)
    w = np.zeros(len(at))
    np.add.at(w, back, np.concatenate([x for _, x in parts]))
    return at, w / np.sqrt((w**2).sum())


def rarity(df: DataFrame, fields: list[str], smooth: float = 0.0) -> np.ndarray:
    """Weight of each of BUCKETS buckets of n-grams, counted over all rows of df."""

    def buckets(*s: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(hashed([t or "" for t in row]))) for row in zip(*s)])

    counted = df.select(F.explode(F.pandas_udf(buckets, "array<int>")(*fields)).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    rows = counted.toPandas()  # at most BUCKETS rows
    n = np.zeros(BUCKETS)
    n[rows["g"].to_numpy(np.int64)] = rows["n"]
    total = max(float(n.max()) if len(rows) else 1.0, 1.0)
    return np.log(1 + total / np.maximum(n + smooth * total, 1)).astype(np.float32)


def vectors(df: DataFrame, fields: list[str], vector, *least: float, smooth: float = 0.0) -> DataFrame:
    """Add `at` and `w`, the vector of the fields with its rarest n-grams
    first, and `k` (an array, one for each `least`), how many of these a vector
    of that cosine must share one of."""
    shared = df.sparkSession.sparkContext.broadcast(rarity(df, fields, smooth))

    def build(*s: pd.Series) -> pd.DataFrame:
        idf, out = shared.value, []
        for row in zip(*s):
            at, w = vector(idf, *[t or "" for t in row])
            order = np.lexsort((at, -idf[at]))
            at, w = at[order], w[order]
            left = 1 - np.concatenate([[0], np.cumsum(w**2)[:-1]])
            out.append((at.astype(np.int32), w.astype(np.float32), [int((left >= (x - 1e-6) ** 2).sum()) for x in least]))
        return pd.DataFrame(out, columns=["at", "w", "k"])

    made = F.pandas_udf(build, "at array<int>, w array<float>, k array<int>")(*fields)
    return df.withColumn("__v", made).select(*df.columns, "__v.at", "__v.w", "__v.k")


def _cosines(at_a: pd.Series, w_a: pd.Series, at_b: pd.Series, w_b: pd.Series) -> pd.Series:
    """Products of pairs of sparse vectors, all pairs of a batch at once."""
    if not len(at_a):
        return pd.Series([], dtype="float64")

    def flat(at, w):
        size = np.fromiter(map(len, at), np.int64, len(at))
        key = np.repeat(np.arange(len(at)), size) * BUCKETS + np.concatenate(at.to_numpy()).astype(np.int64)
        return key, np.concatenate(w.to_numpy()).astype(float)

    (ka, wa), (kb, wb) = flat(at_a, w_a), flat(at_b, w_b)
    order = np.argsort(kb)
    kb, wb = kb[order], wb[order]
    to = np.minimum(np.searchsorted(kb, ka), max(len(kb) - 1, 0))
    met = kb[to] == ka if len(kb) else np.zeros(len(ka), bool)
    return pd.Series(np.bincount(ka[met] // BUCKETS, wa[met] * wb[to[met]], len(at_a)))


def similar(left: DataFrame, right: DataFrame | None, least: float, nth: int = 0, same: bool = False) -> DataFrame:
    """a, b, cosine of all pairs of one block whose cosine is at least `least`,
    from tables (id, block, at, w, k; `nth` says which k is for `least`), an id
    being in as many blocks as it has rows; without `right`, and where both
    have the `same` ids, each pair once, a < b. N-grams in more than HOT rows
    are spread over SALTS tasks."""
    prefix = lambda df, name: df.select(F.col("id").alias(name), "block", F.explode(F.slice("at", 1, F.col("k")[nth])).alias("g"))
    a, b = prefix(left, "a"), prefix(left if right is None else right, "b")
    hot = b.groupBy("block", "g").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("block", "g", F.lit(SALTS).alias("salts"))
    salted = lambda df: df.join(hot, ["block", "g"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    a = salted(a).withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")).drop("salts")
    b = salted(b).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    pairs = a.join(b, ["block", "g", "salt"]).where("a < b" if right is None else "a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct() if same else pairs.select("a", "b").distinct()
    once = lambda df: df.select("id", "at", "w").dropDuplicates(["id"])
    va = once(left).toDF("a", "at_a", "w_a")
    vb = once(left if right is None else right).toDF("b", "at_b", "w_b")
    pairs = pairs.join(va, "a").join(vb, "b")
    cosine = F.pandas_udf(_cosines, "double")("at_a", "w_a", "at_b", "w_b")
    return pairs.select("a", "b", cosine.alias("cosine")).where(F.col("cosine") >= least)


class _Rows:
    """Spellings with their vectors, one after the other; n-grams ascend."""

    def __init__(self, table: pd.DataFrame, made: list[tuple[np.ndarray, np.ndarray]]):
        self.table, self.size = table, np.fromiter((len(at) for at, _ in made), np.int64, len(made))
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.at = np.concatenate([np.zeros(0, np.int64), *(at for at, _ in made)]).astype(np.int64)
        self.w = np.concatenate([np.zeros(0, np.float32), *(w for _, w in made)]).astype(np.float32).astype(float)

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the vectors' parts of the rows; which of the rows each is of."""
        size = self.size[rows]
        of = np.repeat(np.arange(len(rows)), size)
        return np.repeat(self.start[rows] - np.cumsum(size) + size, size) + np.arange(int(size.sum())), of

    def take(self, rows: np.ndarray) -> _Rows:
        return _Rows(self.table.iloc[rows].reset_index(drop=True), [(self.at[a:b], self.w[a:b]) for a, b in zip(self.start[rows].tolist(), self.start[rows + 1].tolist())])

    def plus(self, other: _Rows) -> _Rows:
        out = _Rows(pd.concat([self.table, other.table], ignore_index=True), [])
        out.size, out.at, out.w = np.concatenate([self.size, other.size]), np.concatenate([self.at, other.at]), np.concatenate([self.w, other.w])
        out.start = np.concatenate([[0], np.cumsum(out.size)])
        return out


def _meet(x: _Rows, a: np.ndarray, b: np.ndarray, group: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of x (of a, of b) in one group whose cosine is at least `least`, and
    the cosines. Products are summed over the n-grams that two have in common;
    a long group's by each spelling of b, the others' all at once."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(a) or not len(b):
        return out[0]
    a, b = a[np.argsort(group[a], kind="stable")], b[np.argsort(group[b], kind="stable")]
    groups, first, many = np.unique(group[a], return_index=True, return_counts=True)
    for g, i, n in zip(groups[many >= LONG].tolist(), first[many >= LONG].tolist(), many[many >= LONG].tolist()):
        own = a[i : i + n]
        p, of = x.places(own)
        order = np.argsort(x.at[p], kind="stable")
        grams, of, w = x.at[p][order], of[order], x.w[p][order]
        for j in b[np.searchsorted(group[b], g) : np.searchsorted(group[b], g, side="right")].tolist():
            at, mine = x.at[x.start[j] : x.start[j + 1]], x.w[x.start[j] : x.start[j + 1]]
            lo, hi = np.searchsorted(grams, at), np.searchsorted(grams, at, side="right")
            count = hi - lo
            where = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            cosine = np.bincount(of[where], w[where] * np.repeat(mine, count), n)
            near = np.flatnonzero((cosine >= least) & (own != j))
            out.append((own[near], np.full(len(near), j), cosine[near]))
    short = groups[many < LONG]
    a, b = a[np.isin(group[a], short)], b[np.isin(group[b], short)]
    if not len(a) or not len(b):
        return tuple(np.concatenate(c) for c in zip(*out))
    p, of = x.places(a)
    key = group[a][of] * BUCKETS + x.at[p]
    order = np.argsort(key, kind="stable")
    key, of, w = key[order], of[order], x.w[p][order]
    for some in np.array_split(b, -(-len(b) // 1024)):  # fewer than 1024 * LONG pairs
        q, to = x.places(some)
        mine = group[some][to] * BUCKETS + x.at[q]
        lo, hi = np.searchsorted(key, mine), np.searchsorted(key, mine, side="right")
        count = hi - lo
        where = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        pair, back = np.unique(of[where] * len(some) + np.repeat(to, count), return_inverse=True)
        cosine = np.bincount(back, w[where] * np.repeat(x.w[q], count), len(pair))
        i, j = a[pair // len(some)], some[pair % len(some)]
        near = (cosine >= least) & (i != j)
        out.append((i[near], j[near], cosine[near]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _nearest(found: pd.DataFrame) -> pd.DataFrame:
    """Of each a its best pair with each of the two tags nearest to it: `own`
    pairs before others, then by cosine."""
    found = found.sort_values(["a", "own", "cosine"], ascending=[True, False, False]).drop_duplicates(["a", "tag"])
    return found[found.groupby("a").cumcount() < 2]


def met(spellings: DataFrame, vector, weights: np.ndarray, least: float, at_once: int = 1, nearest: bool = False) -> DataFrame:
    """a, b, cosine, tag of all pairs of a block of which a asks and b answers
    and whose cosine is at least `least`; spellings (id, block, ask, answer,
    first, last, tag) have b's tag, `own` says that both forenames are whole. A
    pair that meets in several blocks is given for each; one that asks and
    answers on both sides may be given either way round, once or twice. With
    `nearest`, a block gives of each a the best pairs with the two nearest tags,
    which is enough to tell whether one tag is nearer to a than all others.

    Blocks stream through tasks, those that ask first; these are held, at most
    about HELD of them. Larger blocks are met in parts, `at_once` in a round."""
    spark = spellings.sparkSession
    shared = spark.sparkContext.broadcast(weights)
    rows = spellings.select(F.xxhash64("block").alias("key"), "ask", "answer", "id", "first", "last", "tag")
    asked = rows.where("ask").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HELD)
    large = [(r["key"], -(-r["n"] // HELD)) for r in asked.collect()]  # at most one of HELD spellings
    if large:
        rows = rows.join(F.broadcast(spark.createDataFrame(large, "key long, parts int")), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf = shared.value
        held = _Rows(pd.DataFrame(), [])
        best = pd.DataFrame()  # with `nearest`, of those held
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["key", "part"]].to_numpy(np.int64)
            new = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(1))])
            goes_on = len(held.table) > 0 and (held.table[["key", "part"]].iloc[0].to_numpy(np.int64) == keys[0]).all()
            if not goes_on:
                held = _Rows(pd.DataFrame(), [])
            ask, answer = batch["ask"].to_numpy(bool), batch["answer"].to_numpy(bool)
            # who can't meet anyone has no vector: groups without asking, and whole ones of one spelling or without answering
            n = int(new[-1]) + 1
            asks, answers, size = np.bincount(new, ask, n), np.bincount(new, answer, n), np.bincount(new, minlength=n)
            useful = (asks > 0) & (answers > 0) & (size > 1)
            useful[0] |= goes_on
            useful[-1] |= asks[-1] > 0
            some = np.flatnonzero(useful[new])
            part = batch.iloc[some].reset_index(drop=True)
            made = [vector(idf, f or "", z or "") for f, z in zip(part["first"], part["last"])]
            x = held.plus(_Rows(part, made)) if goes_on else _Rows(part, made)
            old = len(x.table) - len(part)
            group = np.concatenate([np.zeros(old, np.int64), new[some]])
            asks, answers = x.table["ask"].to_numpy(bool), x.table["answer"].to_numpy(bool)
            is_new = np.arange(len(group)) >= old
            found = [_meet(x, np.flatnonzero(asks), np.flatnonzero(answers & is_new), group, least)]
            if old:
                found.append(_meet(x, np.flatnonzero(asks & is_new), np.flatnonzero(answers & ~is_new), group, least))
            i, j, cosine = (np.concatenate(c) for c in zip(*found))
            held = x.take(np.flatnonzero(asks & (group == n - 1)))
            if len(i):
                ids, whole = x.table["id"].to_numpy(np.int64), x.table["first"].str.len().to_numpy() > 1
                pairs = pd.DataFrame({"a": ids[i], "b": ids[j], "cosine": cosine, "tag": x.table["tag"].to_numpy()[j], "own": whole[i] & whole[j]})
                if not nearest:
                    yield pairs
                    continue
                best = _nearest(pd.concat([best, pairs]) if len(best) else pairs)
            if len(best):
                stay = best["a"].isin(held.table["id"]).to_numpy() if len(held.table) else np.zeros(len(best), bool)
                yield best[~stay]
                best = best[stay]
        if len(best):
            yield best

    kind = dict(spellings.dtypes)["tag"]
    rounds = []
    for r in range(0, max([1, *(n for _, n in large)]), at_once):
        if large:
            these = rows.where(F.col("parts") > r).withColumn("part", F.explode(F.sequence(F.lit(r), F.least("parts", F.lit(r + at_once)) - 1)))
            these = these.withColumn("ask", F.col("ask") & (F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")) == F.col("part"))).where("ask or answer")
        else:
            these = rows.withColumn("part", F.lit(0))
        these = these.select("key", "part", "ask", "answer", "id", "first", "last", "tag").repartition("key", "part").sortWithinPartitions("key", "part", F.col("ask").desc())
        pairs = these.mapInPandas(join, f"a long, b long, cosine double, tag {kind}, own boolean")
        rounds.append(stored(pairs))
    out = rounds[0]
    for x in rounds[1:]:
        out = out.unionByName(x)
    return out if len(rounds) == 1 else stored(out, *rounds)


# --- groups ---------------------------------------------------------------------------


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of a partition as stars: each node with the least of those it is
    connected to there."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            root.setdefault(a, a)
            root.setdefault(b, b)
            p, q = find(a), find(b)
            if p != q:
                root[max(p, q)] = min(p, q)
    nodes = list(root)
    yield pd.DataFrame({"a": np.array(nodes, np.int64), "b": np.array([find(x) for x in nodes], np.int64)})


def components(edges: DataFrame) -> DataFrame:
    """id, component (the least id) of all nodes of the edges (a, b). Each
    partition first makes stars of its edges; then labels spread to neighbours
    and on to their labels until none changes."""
    stars = edges.select("a", "b").repartition("a").mapInPandas(_stars, "a long, b long")
    both = stored(stars.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b").distinct())
    labels = last = stored(both.groupBy("a").agg(F.min("b").alias("label")))
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        new = labels.join(near, "a").select("a", F.least("label", "l").alias("next"), "label")
        jump = labels.select(F.col("a").alias("next"), F.col("label").alias("far"))
        last = new = stored(new.join(jump, "next", "left").select("a", F.least("next", F.coalesce("far", "next")).alias("new"), "label"), last)
        changed = not new.where("new <> label").isEmpty()
        labels = new.select("a", F.col("new").alias("label"))
        if not changed:
            removed(both)
            return labels.select(F.col("a").alias("id"), F.col("label").alias("component"))


def average_linkage(n: int, a: np.ndarray, b: np.ndarray, s: np.ndarray, least: float) -> np.ndarray:
    """Cluster of each of n nodes: the two clusters with the highest mean
    similarity are merged while it is at least `least`. Pairs not given have
    similarity 0; only linked pairs of clusters are held."""
    sums: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, x in zip(a.tolist(), b.tolist(), s.tolist()):
        if i != j:
            sums[i][j] = sums[j][i] = max(x, sums[i].get(j, 0.0))
    size, of, alive = [1] * n, list(range(n)), set(range(n))
    heap = [(-x, i, j, 1, 1) for i in range(n) for j, x in sums[i].items() if i < j]
    heapq.heapify(heap)
    while heap:
        x, i, j, p, q = heapq.heappop(heap)
        if -x < least:
            break
        if i not in alive or j not in alive or size[i] != p or size[j] != q:
            continue
        for k, y in sums[j].items():
            if k != i:
                sums[i][k] = sums[k][i] = sums[i].get(k, 0.0) + y
                sums[k].pop(j, None)
        sums[i].pop(j, None)
        alive.discard(j)
        of[j], size[i], sums[j] = i, p + q, {}
        for k, y in sums[i].items():
            lo, hi = min(i, k), max(i, k)
            heapq.heappush(heap, (-y / (size[i] * size[k]), lo, hi, size[lo], size[hi]))
    for i in range(n):
        while of[of[i]] != of[i]:
            of[i] = of[of[i]]
    return np.array(of)


def grouped(edges: DataFrame, least: float) -> DataFrame:
    """id, group (least id) of the nodes of edges (a, b, cosine) with long
    ids, by average linkage. Connected components stream through a task
    sorted, one being held at a time."""
    edges = stored(edges)
    parts = edges.join(components(edges).withColumnRenamed("id", "a"), "a")

    def finish(x: pd.DataFrame) -> pd.DataFrame:
        ids = np.unique(np.concatenate([x["a"], x["b"]]))
        of = average_linkage(len(ids), np.searchsorted(ids, x["a"]), np.searchsorted(ids, x["b"]), x["cosine"].to_numpy(), least)
        return pd.DataFrame({"id": ids, "group": ids[of]})

    return stored(by_part(parts.select(F.col("component").alias("part"), "a", "b", "cosine"), finish, "id long, group long"), edges)


def _linked_parts(x: pd.DataFrame, vector, least: float, linkage: float) -> np.ndarray:
    """Group (a row of it) of each row of whole parts (part, first, last, rare),
    by average linkage within the part. Two whole forenames meet if they are
    equal, an initial meets all initials and whole forenames, and so does a rare
    forename the whole ones. Vectors are made a lot of blocks at a time."""
    first, last = x["first"].to_numpy(), x["last"].to_numpy()
    whole = x["first"].str.len().to_numpy() > 1
    part = np.unique(x["part"].to_numpy(np.int64), return_inverse=True)[1]
    block = np.unique(np.where(whole, x["first"], ""), return_inverse=True)[1]
    block = np.unique(part * (int(block.max()) + 1) + block, return_inverse=True)[1]
    wide = np.flatnonzero(x["rare"].to_numpy(bool) | ~whole)
    order = np.argsort(block, kind="stable")
    start = np.flatnonzero(np.diff(block[order], prepend=-1))
    lots, size = [], 0
    for i, n in zip(start.tolist(), np.diff(start, append=len(x)).tolist()):
        if not lots or size + n > LOT:
            lots.append(i)
            size = 0
        size += n
    made = lambda at: _Rows(pd.DataFrame(), [vector(first[i], last[i]) for i in at.tolist()])
    wide_rows = made(wide) if len(lots) > 1 else None
    edges = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0))]
    for at in np.split(order, lots[1:]):
        rows, all_of = made(at), np.arange(len(at))
        i, j, cosine = _meet(rows, all_of, all_of, block[at], least)
        edges.append((at[i][i < j].astype(np.int32), at[j][i < j].astype(np.int32), cosine[i < j]))
        # those that meet more than their block
        both = rows if wide_rows is None else rows.plus(wide_rows)
        of = at if wide_rows is None else np.concatenate([at, wide])
        asks = np.flatnonzero(np.isin(at, wide)) if wide_rows is None else len(at) + np.flatnonzero(np.isin(part[wide], part[at]))
        i, j, cosine = _meet(both, asks, np.flatnonzero(whole[at]), part[of], least)
        other = block[of[i]] != block[of[j]]
        edges.append((of[i][other].astype(np.int32), of[j][other].astype(np.int32), cosine[other]))
    a, b, cosine = (np.concatenate(c) for c in zip(*edges))
    group = np.arange(len(x))
    if not len(a):
        return group
    del edges, wide_rows
    # components one after the other, as no cluster reaches beyond its own
    label = np.arange(len(x))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    order = np.argsort(label[a], kind="stable")
    a, b, cosine = a[order], b[order], cosine[order]
    cuts, size, to = [], 0, np.flatnonzero(np.diff(label[a], prepend=-1))
    for i, n in zip(to.tolist(), np.diff(to, append=len(a)).tolist()):
        if size + n > LINKED and i:
            cuts.append(i)
            size = 0
        size += n
    for p, q, w in zip(np.split(a, cuts), np.split(b, cuts), np.split(cosine, cuts)):
        nodes = np.unique(np.concatenate([p, q]))
        group[nodes] = nodes[average_linkage(len(nodes), np.searchsorted(nodes, p), np.searchsorted(nodes, q), w, linkage)]
    return group


def linked_in_place(spellings: DataFrame, vector, weights: np.ndarray, least: float, linkage: float) -> DataFrame:
    """id, home, person of spellings (part, id, first, last, rare, home): those
    of a person have one. A part is met and linked by the task that holds it,
    and of its pairs none leave; small parts go together."""
    shared = spellings.sparkSession.sparkContext.broadcast(weights)

    def finish(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["part", "id"], ignore_index=True)
        ids, many = x["id"].to_numpy(np.int64), x.duplicated("part", keep=False).to_numpy()
        person = ids.copy()
        if many.any():
            idf = shared.value
            person[many] = ids[many][_linked_parts(x[many].reset_index(drop=True), lambda f, z: vector(idf, f or "", z or ""), least, linkage)]
        return pd.DataFrame({"id": ids, "home": x["home"].to_numpy(), "person": person})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            if not len(b):
                continue
            key = b["part"].to_numpy(np.int64)
            if held and (held[0]["part"].iat[0] != key[0] or key[0] != key[-1]):
                ends = int(np.argmax(np.append(key != held[0]["part"].iat[0], True)))
                yield finish(pd.concat([*held, b.iloc[:ends]], ignore_index=True))
                held, b, key = [], b.iloc[ends:], key[ends:]
            begins = len(key) - int(np.argmax(np.append(key[::-1] != key[-1], True)))
            if begins:
                yield finish(b.iloc[:begins])
            held.append(b.iloc[begins:])
        if held:
            yield finish(pd.concat(held, ignore_index=True))

    rows = spellings.select("part", "id", "first", "last", "rare", "home")
    return rows.repartition("part").sortWithinPartitions("part").mapInPandas(run, "id long, home string, person long")


def by_part(df: DataFrame, finish, schema: str) -> DataFrame:
    """The rows that `finish` makes of the rows of each `part`; parts stream
    through a task sorted, one being held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            if not len(b):
                continue
            key = b["part"].to_numpy()
            whole = np.split(np.arange(len(b)), np.flatnonzero(key[1:] != key[:-1]) + 1)
            done = []
            for at in whole:
                if held and held[0]["part"].iat[0] != key[at[0]]:
                    done.append(finish(pd.concat(held, ignore_index=True)))
                    held = []
                held.append(b.iloc[at])
            if done:
                yield pd.concat(done, ignore_index=True)
        if held:
            yield finish(pd.concat(held, ignore_index=True))

    return df.repartition("part").sortWithinPartitions("part").mapInPandas(run, schema)


# --- bodies ---------------------------------------------------------------------------


def body_words(text: Column) -> Column:
    """Folded words of a body without signs; letters parted by dots as one
    word (`K.S.D.` as ksd), a part after a comma first, brackets left off."""

    def words(s: pd.Series) -> pd.Series:
        out = []
        for t in s:
            t = re.sub(r"\([^)]*\)\s*$", "", t or "")
            t = re.sub(r"(?<!\w)(?:\w\.){2,}", lambda m: m[0].replace(".", "") + " ", t)
            parts = [re.findall(r"\w+", fold(p)) for p in t.split(",")]
            out.append(" ".join(w for p in reversed(parts) for w in p))
        return pd.Series(out, dtype=object)

    return F.pandas_udf(words, "string")(text)


def acronyms(forms: DataFrame) -> DataFrame:
    """short, full: what an acronym stands for, learned from bodies (words, n,
    bracket: an acronym given in brackets).

    An acronym is a word of two to six letters that spells the initials of the
    first words of another body, the words after it being the same; words of
    up to two letters may be passed over. Of several readings the one in most
    rows is taken. Brackets give a reading of the whole name.
    """
    w = F.split("words", " ")
    given = forms.where("bracket <> '' and words <> ''").select(F.col("bracket").alias("short"), F.col("words").alias("full"), F.col("n"))
    stands = forms.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.struct(
        F.element_at(w, i).alias("short"), F.array_join(F.slice(w, i + 1, F.size(w)), " ").alias("rest")))).alias("s"), "n")
    stands = stands.where("length(s.short) between 2 and 6").groupBy("s.short", "s.rest").agg(F.sum("n").alias("m"))
    initials = lambda x: F.array_join(F.transform(x, lambda y: F.left(y, F.lit(1))), "")
    heads = forms.where(F.size(w) >= 2).select("n", F.explode(F.transform(F.sequence(F.lit(2), F.least(F.size(w), F.lit(7))), lambda i: F.struct(
        F.slice(w, 1, i).alias("head"), F.array_join(F.slice(w, i + 1, F.size(w)), " ").alias("rest")))).alias("h"))
    heads = heads.select("n", "h.rest", F.array_join("h.head", " ").alias("full"), F.explode(F.array_distinct(F.array(
        initials(F.col("h.head")), initials(F.filter("h.head", lambda x: F.length(x) > 2))))).alias("short"))
    heads = heads.where("length(short) >= 2").groupBy("short", "rest", "full").agg(F.sum("n").alias("n"))
    read = heads.join(stands, ["short", "rest"]).select("short", "full", F.least("n", "m").alias("n"))
    votes = given.unionByName(read).where("short <> full").groupBy("short", "full").agg(F.sum("n").alias("n"))
    return votes.groupBy("short").agg(F.max_by("full", F.struct("n", "full")).alias("full"))


def once(pairs: DataFrame, *columns: str) -> DataFrame:
    """Each pair once, a < b, with its cosine."""
    rest = [c for c in columns if c not in ("a", "b")]
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine", *rest)
    return pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), *[F.min(c).alias(c) for c in rest])


def bodies(rows: DataFrame, body: str) -> DataFrame:
    """Add `org`: one key for all spellings of a body; empty for none."""
    forms = rows.where(F.col(body).isNotNull()).groupBy(F.col(body).alias("__body")).agg(F.count("*").alias("n"))
    bracket = F.lower(F.regexp_replace(F.regexp_extract("__body", r"\(([\p{Lu}.]{2,12})\)\s*$", 1), r"\.", ""))
    forms = stored(forms.select("__body", "n", body_words(F.col("__body")).alias("words"), bracket.alias("bracket")).where("words <> ''"))
    by_words = stored(forms.groupBy("words").agg(F.sum("n").alias("n"), F.max("bracket").alias("bracket")))
    short = stored(acronyms(by_words))
    # acronyms written out, word by word
    pieces = by_words.select("words", "n", F.posexplode(F.split("words", " ")).alias("i", "short")).join(short, "short", "left")
    full = pieces.groupBy("words").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", F.coalesce("full", "short").alias("w")))).alias("l"))
    full = stored(full.select("words", "n", F.array_join(F.transform("l", lambda x: x["w"]), " ").alias("full")), by_words, short)
    keys = full.groupBy("full").agg(F.sum("n").alias("n")).select(F.xxhash64("full").alias("id"), "full", "n", F.lit("").alias("block"))
    keys = stored(keys)
    asking = keys.select("id", "block", F.lit(True).alias("ask"), F.lit(True).alias("answer"), F.lit("").alias("first"), F.col("full").alias("last"), F.lit(None).cast("string").alias("tag"))
    pairs = met(asking, lambda idf, _, full: body_vector(idf, full), rarity(keys, ["full"]), BODY, SALTS)
    groups = grouped(once(pairs, "a", "b"), BODY_LINKAGE)
    removed(pairs)
    linked_in = groups
    groups = keys.select("id", "full", "n").join(groups, "id", "left").withColumn("group", F.coalesce("group", "id"))
    best = groups.groupBy("group").agg(F.max_by("full", F.struct("n", "full")).alias("org"))
    named = forms.select("__body", "words").join(full.select("words", "full"), "words").join(groups.select("full", "group"), "full").join(best, "group")
    named = stored(named.select("__body", "org"), forms, full, keys, linked_in)
    return rows.join(named, F.col(body) == F.col("__body"), "left").withColumn("org", F.coalesce("org", F.lit(""))).drop("__body")


# --- persons --------------------------------------------------------------------------


def familiar(forms: DataFrame) -> DataFrame:
    """first, formal: forenames that stand for another, learned from distinct forms
    (first, last, org, n): under one last name in one body a familiar form
    meets its formal one far more often than chance has it. Of a group each
    forename is held against the most frequent one only."""
    named = forms.where("length(first) > 1 and last <> '' and org <> ''")
    often = named.groupBy("first").agg(F.sum("n").alias("often"), F.count("*").alias("groups"))
    named = named.select("first", "last", "org").join(often, "first")
    hub = F.max(F.struct("often", "first")).over(Window.partitionBy("last", "org"))
    votes = named.withColumn("formal", hub["first"]).where("first <> formal").groupBy("first", "formal").agg(F.count("*").alias("met"), F.first("groups").alias("groups"))
    best = votes.groupBy("first").agg(F.max_by(F.struct("formal", "met", "groups"), F.struct("met", "formal")).alias("b"))
    best = best.where(F.col("b.met") >= FAMILIAR_SHARE * (F.col("b.groups") + 1)).select("first", "b.formal")
    best = stored(best)
    # a formal form may stand for a more frequent one itself
    on = best.select(F.col("first").alias("formal"), F.col("formal").alias("far"))
    return best.join(on, "formal", "left").select("first", F.coalesce("far", "formal").alias("formal"))


def parsed(rows: DataFrame, name: str, body: str) -> DataFrame:
    """rows, which are stored, without name and body, with org, first (formal
    where known), last; the rows given are removed."""
    rows = stored(bodies(rows, body).drop(body), rows)
    split = oriented(rows, name)
    both = rows.join(split.withColumnRenamed(name, "__name"), F.col(name) == F.col("__name"), "left").drop("__name", name)
    both = both.withColumn("first", F.coalesce("first", F.lit(""))).withColumn("last", F.coalesce("last", F.lit("")))
    rows = stored(both, rows, split)
    forms = stored(rows.groupBy("first", "last", "org").agg(F.count("*").alias("n")))
    formal = familiar(forms)
    removed(forms)
    return stored(rows.join(formal, "first", "left").withColumn("first", F.coalesce("formal", "first")).drop("formal"), rows)


def linked(rows: DataFrame, id: str, side: Column | None = None) -> DataFrame:
    """id, first, last, org (also where it was missing), person, of parsed
    rows; rows of different sides aren't linked."""
    side = (side if side is not None else F.lit(0)).cast("string")
    forms = rows.where("last <> ''").withColumn("__side", side).groupBy("__side", "first", "last", "org").agg(F.count("*").alias("n")).drop("n")
    forms = forms.withColumn("id", F.xxhash64("__side", "first", "last", "org")).withColumn("whole", F.length("first") > 1)
    done = forms = stored(forms)
    weights = rarity(forms, ["first", "last"], SMOOTH)
    # who can meet: two full forenames if they are equal, an initial any of its letter,
    # and so a forename met so rarely that it may be a slip
    seldom = forms.where("whole").groupBy("first").agg(F.count("*").alias("forms")).where(F.col("forms") < RARE).select("first", F.lit(True).alias("rare"))
    forms = stored(forms.join(seldom, "first", "left").withColumn("rare", F.coalesce("rare", F.lit(False))), done)
    letter = F.left("first", F.lit(1))
    initials, fulls = F.concat(letter, F.lit("|i")), F.concat(letter, F.lit("|f"))
    yes, no = F.lit(True), F.lit(False)
    in_block = lambda block, ask, answer: F.struct(block.alias("block"), ask.alias("ask"), answer.alias("answer"))
    # a form without a body: the only body in which the forms nearest to it stand
    asks = F.when(F.col("rare"), F.array(in_block(F.col("first"), yes, no), in_block(initials, yes, no), in_block(fulls, yes, no))).when(
        F.col("whole"), F.array(in_block(F.col("first"), yes, no), in_block(initials, yes, no))
    ).otherwise(F.array(in_block(initials, yes, no), in_block(fulls, yes, no)))
    answers = F.when(F.col("whole"), F.array(in_block(F.col("first"), no, yes), in_block(fulls, no, yes))).otherwise(F.array(in_block(initials, no, yes)))
    spelt = lambda df, meets, tag: df.withColumn("m", F.explode(meets)).select(
        "id", F.concat_ws("|", "__side", "m.block").alias("block"), "m.ask", "m.answer", "first", "last", tag.alias("tag"))
    homes, homeless = forms.where("org <> ''"), forms.where("org = ''")
    found = met(spelt(homeless, asks, F.lit(None).cast("string")).unionByName(spelt(homes, answers, F.col("org"))), name_vector, weights, HOME, nearest=True)
    nearest = Window.partitionBy("a")
    near = found.groupBy("a", F.col("tag").alias("home")).agg(F.max(F.struct("own", "cosine")).alias("m")).withColumn("most", F.max("m").over(nearest))
    near = near.where((F.col("m.own") == F.col("most.own")) & (F.col("m.cosine") >= F.col("most.cosine") - 0.03))
    only = near.groupBy("a").agg(F.min("home").alias("home"), F.max("home").alias("other")).where("home = other")
    forms_at = forms.join(only.select(F.col("a").alias("id"), "home"), "id", "left")
    forms = stored(forms_at.withColumn("home", F.when(F.col("org") == "", F.coalesce("home", F.lit("")))), forms, found)
    # only forms of one home and one first letter are ever paired
    place = F.xxhash64("__side", F.coalesce("home", "org"), letter)
    persons_of = stored(linked_in_place(forms.withColumn("part", place), name_vector, weights, NAME, NAME_LINKAGE), forms)
    out = rows.withColumn("__id", F.xxhash64(side, "first", "last", "org")).join(persons_of.withColumnRenamed("id", "__id"), "__id", "left")
    alone = F.xxhash64(F.lit("alone"), id)
    out = out.select(*[c for c in rows.columns if c != "org"], F.coalesce("home", "org").alias("org"), F.coalesce("person", alone).alias("person"))
    return stored(out, rows, persons_of)


def persons(rows: DataFrame, id: str, name: str, body: str) -> DataFrame:
    """id, first, last, org, person: rows of the same person share `person`.

    Same: one body and names whose cosine is high, grouped by average linkage.
    A row without body belongs to the only body in which names nearest to its
    own occur, if there is just one. Repeated rows of an id count once, rows
    without a name are persons of their own; other columns are left behind.
    """
    rows = rows.groupBy(id).agg(F.min(F.struct(name, body)).alias("r")).select(id, F.col(f"r.{name}").alias("name"), F.col(f"r.{body}").alias("body"))
    out = linked(parsed(stored(rows), "name", "body"), id)
    return out.select(id, "first", "last", "org", "person")


def same_person_pairs(people: DataFrame, id: str) -> DataFrame:
    """All pairs of ids of a person, the smaller first."""
    a = people.select(F.col(id).alias(f"{id}_a"), "person")
    b = people.select(F.col(id).alias(f"{id}_b"), "person")
    return a.join(b, "person").where(F.col(f"{id}_a") < F.col(f"{id}_b")).select(f"{id}_a", f"{id}_b")
