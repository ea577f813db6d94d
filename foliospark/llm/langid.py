"""Language of documents and of their parts by cross-parsing entropy.

Of each language, labelled text is turned into a suffix automaton. A text is
cut, against each automaton, into the longest phrases that occur in that
language's text; the language that needs the fewest phrases for the length
wins. The automata step through all texts of a batch at once: per character
there is one look-up in a transition table for each text and language.
"""

from __future__ import annotations

import functools
import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.carry import carry_last
from .common import CYRILLIC, checkpointed, to_latin, within

#: Labelled passages are a bounded sample by contract, as is their length.
MAX_PASSAGES = 20_000
MAX_CHARS_PER_LANGUAGE = 200_000
#: A part is held to be in another language than its document if that needs
#: this share fewer phrases, and at least this many fewer.
MIN_GAIN, MIN_PHRASES = 0.12, 2.5

#: Letters that are parsed without a cut.
PIECE = 1024

# The letters told apart; all else parts words.
LETTERS = " abcdefghijklmnopqrstuvwxyzčšžćđäöüßáéíóúőűàèìòù"

# Notations of the languages' labels.
LABELS = {
    "sl": "sl slv slovenian slovene slovenščina",
    "hr": "hr hrv scr croatian hrvatski",
    "sr": "sr srp scc serbian srpski српски",
    "en": "en eng english",
    "de": "de deu ger german deutsch",
    "it": "it ita italian italiano",
    "hu": "hu hun hungarian magyar",
}


def label_language(label: Column) -> Column:
    """Two letters of a label in any common notation (region, script, three
    letters, name); two letters of another language stay as they are; null for
    a missing or unknown label."""
    head = F.regexp_extract(F.lower(F.trim(label)), r"^([^-_\s]+)", 1)
    pairs = [F.lit(x) for two, names in LABELS.items() for n in names.split() for x in (n, two)]
    return F.coalesce(F.create_map(*pairs)[head], F.when(head.rlike("^[a-z]{2}$"), head))


def automaton(text: str, alphabet: int) -> np.ndarray:
    """Transitions of the suffix automaton of ids: a row of `alphabet` targets
    per state, -1 where there is none."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    table = np.full((len(nxt), alphabet), -1, np.int32)
    for s, row in enumerate(nxt):
        for c, t in row.items():
            table[s, c] = t
    return table


_LUT = np.zeros(0x461, np.uint8)
_SECOND = np.zeros(0x461, np.uint8)  # of Cyrillic letters spelled with two Latin ones
for _c in LETTERS + CYRILLIC:
    _l = to_latin(_c)
    for _x in {_c, _c.upper() if len(_c.upper()) == 1 else _c}:
        _LUT[ord(_x)] = LETTERS.index(_l[0])
        _SECOND[ord(_x)] = LETTERS.index(_l[1]) if len(_l) > 1 else 0


def _ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter ids of all texts in one row, each with single spaces between
    words and at both ends; where each begins; how long each is."""
    joined = " " + " \0 ".join(t.replace("\0", " ") if "\0" in t else t for t in texts) + " "
    points = np.minimum(np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32), 0x460)
    ids = _LUT.take(points)
    ids[points == 0] = 255
    second = _SECOND.take(points)
    if second.any():
        twice = 1 + (second > 0)
        ends = np.cumsum(twice) - 1
        ids = np.repeat(ids, twice)
        ids[ends[second > 0]] = second[second > 0]
    keep = np.ones(ids.size, bool)
    keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0)
    ids = ids[keep]
    ends = np.append(np.flatnonzero(ids == 255), ids.size)
    starts = np.concatenate([[0], ends[:-1] + 1])
    return ids, starts, ends - starts


class CrossParser:
    """Phrase counts of texts against several languages."""

    def __init__(self, labelled: dict[str, str]):
        self.languages = sorted(labelled)
        a, tables = len(LETTERS), []
        for lang in self.languages:
            t = automaton(_ids([labelled[lang]])[0].tolist(), a)
            go = np.where(t >= 0, t, 0)
            restart = np.maximum(t[0], 0)  # a new phrase begins with the character that ended the last
            step = np.where(t >= 0, go * 2, restart[None, :] * 2 + 1)
            step[0] = restart * 2 + 1  # from the root every letter begins a phrase, known or not
            tables.append(step.astype(np.int32))
        self.tables = [t.ravel() for t in tables]

    def phrases(self, texts: list[str], lanes: int = 1 << 13) -> np.ndarray:
        """Per text, one phrase count for each language. Texts of like length
        step together, one language at a time, so that its table stays cached."""
        k, a = len(self.languages), len(LETTERS)
        out = np.zeros((len(texts), k), np.int32)
        if not texts:
            return out
        ids, starts, sizes = _ids(texts)
        # a long text is cut into pieces that step side by side; a cut adds at most one phrase
        pieces = np.maximum(-(-sizes // PIECE), 1)
        whole = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(whole)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, sizes = starts[whole] + nth * PIECE, np.minimum(sizes[whole] - nth * PIECE, PIECE)
        part = np.zeros((len(whole), k), np.int32)
        order = np.argsort(-sizes, kind="stable")
        for at in range(0, len(order), lanes):
            rows = order[at : at + lanes]
            size = sizes[rows]
            if size[0] <= 64:
                steps = np.arange(int(size[0]), dtype=np.int64)[:, None]
                block = ids.take(starts[rows][None, :] + steps, mode="clip")
            else:
                wide = np.zeros((len(rows), int(size[0])), np.uint8)
                for j, (b, n) in enumerate(zip(starts[rows].tolist(), size.tolist())):
                    wide[j, :n] = ids[b : b + n]
                block = np.ascontiguousarray(wide.T)
            live = np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist()
            for lang, table in enumerate(self.tables):
                state = np.zeros(len(rows), np.int32)
                count = np.zeros(len(rows), np.int32)
                v = np.zeros(len(rows), np.int32)
                for t, n in enumerate(live):
                    s, w = state[:n], v[:n]
                    s += block[t, :n]
                    table.take(s, out=w, mode="clip")
                    np.bitwise_and(w, 1, out=s)
                    count[:n] += s
                    w >>= 1
                    np.multiply(w, a, out=s)
                part[rows, lang] = count
        np.add.at(out, whole, part)
        return out


@functools.lru_cache(2)
def _parser(blob: bytes) -> CrossParser:
    return CrossParser(pickle.loads(blob))


def labelled_texts(labelled: DataFrame) -> bytes:
    """The labelled text of each language, from rows of lang and text."""
    rows = within(labelled.where("lang is not null and text is not null").select("lang", "text").distinct(), MAX_PASSAGES, "labelled passages")
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    if not texts:
        raise ValueError("no labelled text to learn languages from")
    return pickle.dumps({k: " ".join(sampled(v)) for k, v in texts.items()})


def sampled(texts: list[str], most: int = MAX_CHARS_PER_LANGUAGE) -> list[str]:
    """Whole texts chosen by a hash of them, up to about so many characters in
    all (one at least), in their order: a bounded sample of labelled rows."""
    if sum(map(len, texts)) <= most:
        return texts
    kept, room = set(), most
    for i in sorted(range(len(texts)), key=lambda i: hashlib.md5(texts[i].encode()).digest()):
        if kept and len(texts[i]) > room:
            continue
        kept.add(i)
        room -= len(texts[i])
    return [t for i, t in enumerate(texts) if i in kept]


def _confidence(counts: np.ndarray) -> np.ndarray:
    """How much fewer phrases the best language needs than the next, 0 to 1."""
    if counts.shape[1] < 2:
        return np.ones(len(counts))
    two = np.partition(counts, 1, axis=1)[:, :2].astype(float)
    return 1 - two[:, 0] / np.maximum(two[:, 1], 1)


def another(counts: np.ndarray, main: np.ndarray) -> np.ndarray:
    """Whether the best language of each row beats the main one clearly."""
    best = counts.min(axis=-1)
    home = counts[np.arange(len(counts)), main]
    return (home - best >= MIN_PHRASES) & (best < home * (1 - MIN_GAIN))


def pieces(batch: pd.DataFrame, text: str, chars: int = 6_000_000) -> Iterator[pd.DataFrame]:
    """The batch in runs of rows of about so many characters, which keeps
    memory flat; a longer single text makes a run of its own."""
    if len(batch):
        run = (batch[text].str.len().fillna(0).cumsum() // chars).to_numpy()
        for at in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(run)) + 1):
            yield batch.iloc[at]


def document_languages(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, seg_no (-1: the document; else the paragraph, counted from 0,
    if in another language), lang, confidence, label (as delivered).

    Paragraphs are parted by empty lines. The document's language is that of
    most of its words. A null text gives no row; a text without letters gets
    a null language and confidence 0. Extra columns are ignored.
    """
    sc = documents.sparkSession.sparkContext
    blob = sc.broadcast(labelled_texts(labelled))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = _parser(blob.value)
        for b in batches:
            for part in pieces(b, "text"):
                rows, paras, nos = [], [], []
                for i, text in enumerate(part["text"]):
                    for no, para in enumerate(text.split("\n\n")):
                        rows.append(i)
                        nos.append(no)
                        paras.append(para)
                rows, nos = np.array(rows, np.int64), np.array(nos, np.int64)
                counts = p.phrases(paras)
                words = np.array([para.count(" ") + 1 if para.strip() else 0 for para in paras])
                # text of a script that none of the languages has is one phrase in each: no language
                size = np.array([len(x) for x in paras])
                words = np.where((counts.max(1, initial=0) <= 1) & (size > 8), 0, words)
                letters = words > 0
                best = counts.argmin(1)
                votes = np.zeros((len(part), len(p.languages)), np.int64)
                np.add.at(votes, (rows, best), words)
                whole = np.zeros((len(part), len(p.languages)), np.int64)
                np.add.at(whole, rows, counts)
                main = (votes * 1_000_000 - np.minimum(whole, 999_999)).argmax(1)
                sure = _confidence(whole)
                has = votes.sum(1) > 0
                other = letters & another(counts, main[rows]) & (best != main[rows])
                langs = np.array(p.languages, object)
                ids, labels = part["doc_id"].to_numpy(), part["label"].to_numpy()
                yield pd.DataFrame({
                    "doc_id": np.concatenate([ids, ids[rows[other]]]),
                    "seg_no": np.concatenate([np.full(len(part), -1), nos[other]]).astype(np.int32),
                    "lang": np.concatenate([np.where(has, langs[main], None), langs[best[other]]]),
                    "confidence": np.concatenate([np.where(has, sure, 0.0), _confidence(counts[other])]),
                    "label": np.concatenate([labels, labels[rows[other]]]),
                })

    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.where("text is not null").select("doc_id", "text", F.col("lang").alias("label"))
    return rows.mapInPandas(run, f"doc_id {kind}, seg_no int, lang string, confidence double, label string")


def with_phrases(df: DataFrame, text: str, labelled: DataFrame, name: str = "phrases") -> tuple[DataFrame, list[str]]:
    """Add the phrase counts of a text column, in the order of the languages."""
    blob = df.sparkSession.sparkContext.broadcast(data := labelled_texts(labelled))

    @F.pandas_udf("array<int>")
    def phrases(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_parser(blob.value).phrases([t or "" for t in texts])))

    return df.withColumn(name, phrases(F.col(text))), sorted(pickle.loads(data))


def line_languages(lines: DataFrame, labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, lang, confidence; lines: doc_id, page_num, line_idx,
    lang, confidence of lines whose paragraph is in another language).

    `lines` has body lines only: doc_id, page_num, line_idx, text, starts
    (whether a paragraph begins). Phrase counts are summed, never texts
    gathered: paragraph counts of lines, document counts of paragraphs.
    """
    counted, langs = with_phrases(lines.withColumn("text", F.coalesce("text", F.lit(""))), "text", labelled)
    n = len(langs)
    counted = counted.select("doc_id", "page_num", "line_idx", "starts", F.size(F.split(F.trim("text"), r"\s+")).alias("words"), *[F.col("phrases")[i].alias(f"c{i}") for i in range(n)])
    mark = F.when(F.col("starts"), F.struct("page_num", "line_idx"))
    counted = checkpointed(counted)  # the fill reads it twice, and the counts are costly
    counted = checkpointed(carry_last(counted, "doc_id", "page_num", ["line_idx"], mark, "para"))
    paras = counted.groupBy("doc_id", "para").agg(F.sum("words").alias("words"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(n)])

    counts = [F.col(f"c{i}") for i in range(n)]
    named = F.array(*[F.struct(c.alias("c"), F.lit(lang).alias("lang")) for c, lang in zip(counts, langs)])
    ranked = F.array_sort(named)
    paras = paras.withColumn("best", ranked[0]["lang"]).withColumn("least", ranked[0]["c"]).withColumn("next", ranked[1]["c"])
    votes = paras.groupBy("doc_id", "best").agg(F.sum("words").alias("words"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(n)])
    docs = votes.groupBy("doc_id").agg(
        F.max(F.struct("words", "best"))["best"].alias("main"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(n)]
    )
    two = F.array_sort(F.array(*counts))
    docs = docs.select("doc_id", "main", (1 - two[0] / F.greatest(two[1], F.lit(1))).alias("confidence"))
    home = F.coalesce(*[F.when(F.col("main") == lang, c) for c, lang in zip(counts, langs)])
    odd = paras.join(docs.select("doc_id", "main"), "doc_id").where(F.col("best") != F.col("main")).where(
        (home - F.col("least") >= MIN_PHRASES) & (F.col("least") < home * (1 - MIN_GAIN))
    )
    odd = odd.select(
        F.col("doc_id").alias("d"), F.col("para").alias("q"), F.col("best").alias("lang"),
        (1 - F.col("least") / F.greatest(F.col("next"), F.lit(1))).alias("confidence"),
    )
    found = counted.join(odd, (F.col("doc_id") == F.col("d")) & F.col("para").eqNullSafe(F.col("q"))).select(
        "doc_id", "page_num", "line_idx", "lang", "confidence"
    )
    return docs.select("doc_id", F.col("main").alias("lang"), "confidence"), found
