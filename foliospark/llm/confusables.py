"""Visually identical text in one consistent form, by confusables skeletons.

The skeleton of a text is its decomposition with every character replaced by
its prototype in a look-alike table, decomposed again; texts that look the same
have equal skeletons. Words are grouped by skeleton; the form kept is composed,
of one script, with plain spaces and nothing invisible.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

# Letters of other scripts and the Latin letters they look like.
CYRILLIC_LIKE = dict(zip("АВЕКМНОРСТУХЅІЈаеорсухѕіјԁһԛԝ", "ABEKMHOPCTYXSIJaeopcyxsijdhqw"))
GREEK_LIKE = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορικυ", "ABEZHIKMNOPTYXavopıkυ")) | {"ι": "i", "υ": "u", "γ": "y"}
LATIN_LIKE = dict(zip("ÐƉƏ", "ĐĐE")) | {"ɡ": "g", "ı": "i", "ſ": "s", "ɑ": "a"}
# Capitals and small letters of Armenian, Cherokee and Lisu and the Latin letters they look like.
OTHER_LIKE = (
    dict(zip("օոսհցզՏՕՍԼ", "onuhgqSOUL")) | dict(zip("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᏔᏃ", "ABCDEGHJKLMPRSTVWZ"))
    | dict(zip("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ"))
)
# Characters that aren't seen, and those kept though they have a plainer form.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏ ‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"
KEPT = "…‥‘’‚‛“”„‟«»‹›‐‑‒–—―′″ªº¹²³⁰⁴⁵⁶⁷⁸⁹¼½¾⅐⅑⅒⅓⅔⅕⅖⅗⅘⅙⅚⅛⅜⅝⅞№™©®°µ§"

#: Small capitals, by their names.
SMALL_CAPITALS = {
    chr(c): m[1].lower() for c in (*range(0x1D00, 0x1D80), *range(0x250, 0x2B0), *range(0xA720, 0xA800))
    if (m := re.fullmatch(r"LATIN LETTER SMALL CAPITAL ([A-Z])", unicodedata.name(chr(c), "")))
}
LATIN_LIKE |= SMALL_CAPITALS
_TO_LATIN = CYRILLIC_LIKE | GREEK_LIKE | OTHER_LIKE
_TO_CYRILLIC = {v: k for k, v in CYRILLIC_LIKE.items()}
_TO_GREEK = {v: k for k, v in GREEK_LIKE.items()}
_INVISIBLE = dict.fromkeys(map(ord, INVISIBLE))
SCRIPTS = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "LISU")
_WORD = re.compile(r"[^\W_]+")


def _script(c: str) -> str:
    name = unicodedata.name(c, "")
    return next((s for s in SCRIPTS if name.startswith(s)), "")


def skeleton(text: str) -> str:
    """Equal for texts that look the same; not meant to be read."""
    text = unicodedata.normalize("NFKD", text.translate(_INVISIBLE))
    text = "".join(_TO_LATIN.get(c, LATIN_LIKE.get(c, c)) for c in text)
    text = unicodedata.normalize("NFKD", text)
    return "".join(" " if unicodedata.category(c) == "Zs" else c for c in text)


def plain(text: str) -> str:
    """Composed, without invisible characters, typographic variants of letters
    and figures, and spaces other than the plain one; scripts as they are."""
    if text.isascii():
        return text
    text = text.translate(_INVISIBLE)
    parts = [c if c in KEPT else " " if unicodedata.category(c) == "Zs" else unicodedata.normalize("NFKC", c) for c in text]
    return unicodedata.normalize("NFC", "".join(parts))


def _one_script(word: str, context: str, latin_known: bool) -> str:
    """The word in its own script. Letters with no look-alike decide; a word
    of look-alikes alone goes with its context, if the Latin form is in use."""
    word = "".join(LATIN_LIKE.get(c, c) for c in word)
    if word.isascii():
        # a Latin look-alike standing alone in Cyrillic text; figures in Roman letters are capitals
        if context == "CYRILLIC" and word.islower() and all(c in _TO_CYRILLIC for c in word):
            return "".join(map(_TO_CYRILLIC.get, word))
        return word
    kinds = [_script(c) for c in word if c.isalpha()]
    sure = dict.fromkeys(SCRIPTS, 0)
    for c in word:
        base = unicodedata.normalize("NFD", c)[0]
        kind = _script(c)
        if kind == "LATIN" and (base != c or base not in _TO_CYRILLIC and base not in _TO_GREEK):
            sure[kind] += 1
        elif kind in SCRIPTS[1:] and base not in _TO_LATIN:
            sure[kind] += 1
    if len(set(kinds) - {""}) <= 1:
        if not kinds or kinds[0] == "LATIN" or any(sure.values()):
            return word
        if not (latin_known and context == "LATIN"):
            return word
        return "".join(_TO_LATIN.get(c, c) for c in word)
    most = max(sure, key=lambda s: (sure[s], kinds.count(s), s == context))
    if most not in ("CYRILLIC", "GREEK"):
        return "".join(_TO_LATIN.get(c, c) for c in word)
    table = _TO_CYRILLIC if most == "CYRILLIC" else _TO_GREEK
    return "".join(table.get(c, c) if _script(c) == "LATIN" else _TO_CYRILLIC.get(_TO_LATIN.get(c, c), c) if most == "CYRILLIC" and _script(c) == "GREEK" else c for c in word)


def context_script(text: str) -> str:
    """The script of most letters that have no look-alike."""
    n = dict.fromkeys((*SCRIPTS, ""), 0)
    for c in text:
        if c.isalpha() and c not in _TO_LATIN and c not in _TO_CYRILLIC:
            n[_script(c)] += 1
    best = max(n, key=n.get)
    return best if n[best] else ""


def scripts(word: str) -> set[str]:
    return {_script(c) for c in word if c.isalpha()} - {""}


def consistent(text: str, context: str = "", latin_known=lambda word: True, forms: dict[str, str] | None = None) -> str:
    """The consistent form of a text; `forms` has those of words that mix
    scripts, from the groups of equal skeleton."""
    text = plain(text)
    if text.isascii():
        return text
    around = context_script(text) or context
    return _WORD.sub(lambda m: forms[m[0]] if forms and m[0] in forms else _one_script(m[0], around, latin_known(m[0])), text)


def _told(texts: pd.Series) -> pd.Series:
    """Words with signs beyond ASCII, each with its skeleton and kind: `pure`
    (one script), `mixed`, or `doubtful` (one script, look-alikes alone)."""
    out, seen = [], {}
    for t in texts:
        rows = []
        for w in dict.fromkeys(_WORD.findall(plain(t))) if t and not t.isascii() else ():
            if w.isascii():
                continue
            if w not in seen:
                letters = [c for c in w if c.isalpha()]
                kind = "mixed" if len(scripts(w)) > 1 else "doubtful" if letters and all(c in _TO_LATIN for c in letters) else "pure"
                seen[w] = (w, skeleton(w), kind)
            rows.append(seen[w])
        out.append(rows)
    return pd.Series(out)


def runs_in_form(runs: DataFrame) -> DataFrame:
    """run_id, text, consistent, changed, one row per run_id.

    Words are grouped by equal skeleton over all runs. A word that mixes
    scripts takes the form most runs of its group have in one script (of a
    group without one, the script of its letters that have no look-alike). A
    word of look-alikes alone becomes Latin if the Latin form of its group is
    in use as often and the script around it - in the run or else on its
    page - is Latin. A null text stays null and unchanged. Repeated rows of a
    run count once; texts beyond ASCII alone are looked at by letters.
    """
    runs = runs.groupBy("run_id").agg(F.min(F.struct("doc_id", "page_num", "text")).alias("r")).select("run_id", "r.*")
    beyond = runs.where(F.coalesce(F.col("text").rlike(r"[^\x00-\x7F]"), F.lit(False)))
    script = F.pandas_udf(lambda s: pd.Series([context_script(plain(t)) if t else "" for t in s]), "string")
    told = F.pandas_udf(_told, "array<struct<word:string,skeleton:string,kind:string>>")
    df = checkpointed(beyond.withColumn("script", script("text")).withColumn("told", told("text")))

    page = df.select("doc_id", "page_num", F.col("script").alias("s")).where("s <> ''").groupBy("doc_id", "page_num", "s").agg(F.count("*").alias("n"))
    page = page.groupBy("doc_id", "page_num").agg(F.max_by("s", F.struct("n", "s")).alias("context"))
    words = df.select("run_id", F.explode("told").alias("t")).select("run_id", "t.*")
    counts = words.groupBy("word", "skeleton", "kind").agg(F.count("*").alias("n"))
    asked = counts.where("kind <> 'pure'")
    # words of letters within ASCII are their own skeletons
    plain_words = runs.select(F.explode(F.array_distinct(F.split("text", r"(?U)[^\w]+"))).alias("word")).where(F.col("word").rlike(r"^[\x00-\x7F]+$"))
    latin = plain_words.join(asked.select(F.col("skeleton").alias("word")).distinct(), "word").groupBy("word").agg(F.count("*").alias("n"))
    latin = latin.select("word", F.col("word").alias("skeleton"), "n")
    pure = counts.where("kind <> 'mixed'").select("word", "skeleton", "n").unionByName(latin)
    best = pure.groupBy("skeleton").agg(F.max_by("word", F.struct("n", "word")).alias("form"))
    mixed = asked.where("kind = 'mixed'").join(best, "skeleton").select("word", "form")
    known = asked.where("kind = 'doubtful'").join(latin.select("skeleton", F.col("n").alias("n_latin")), "skeleton").where("n_latin >= n").select("word", F.lit(None).cast("string").alias("form"))
    judged = words.where("kind <> 'pure'").join(mixed.unionByName(known), "word").groupBy("run_id").agg(F.collect_set(F.struct("word", "form")).alias("judged"))
    df = df.join(judged, "run_id", "left").join(page, ["doc_id", "page_num"], "left")

    @F.pandas_udf("string")
    def form(text: pd.Series, context: pd.Series, judged: pd.Series) -> pd.Series:
        out = []
        for t, c, j in zip(text, context, judged):
            pairs = [] if j is None else [(x["word"], x["form"]) for x in j]
            latin = {w for w, f in pairs if f is None}
            out.append(consistent(t, c or "", latin.__contains__, {w: f for w, f in pairs if f is not None}))
        return pd.Series(out, dtype=object)

    made = df.select("run_id", form("text", "context", "judged").alias("made"))
    out = runs.join(made, "run_id", "left").withColumn("consistent", F.coalesce("made", "text"))
    return out.select("run_id", "text", "consistent", (~F.col("text").eqNullSafe(F.col("consistent"))).alias("changed"))


def look_alikes(runs: DataFrame) -> DataFrame:
    """skeleton, consistent (the form in most runs), n_forms, n_runs: originals
    that look the same, by equal skeleton, of at least two different texts."""
    skeletons = F.pandas_udf(lambda s: pd.Series([None if t is None else skeleton(t) for t in s], dtype=object), "string")
    forms = runs_in_form(runs).where("text is not null").groupBy("text", "consistent").agg(F.count("*").alias("n"))
    groups = forms.withColumn("skeleton", skeletons("text")).groupBy("skeleton").agg(
        F.max_by("consistent", F.struct("n", "consistent")).alias("consistent"), F.count("*").alias("n_forms"), F.sum("n").alias("n_runs")
    )
    return groups.where("n_forms > 1")
