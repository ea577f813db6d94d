"""Speech transcripts into clean speaker turns.

Fields are taken from the lines by SQL expressions; speakers are carried
forward by windows; marked noise is removed; consecutive label sections of a
speaker are islands, and an island is a turn.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..operators.carry import carry_last
from .common import checkpointed, fold

#: Lines per block of a forward fill, and lines of text per part of a turn.
LINES = 64
PART = 4096

# Words of office and address before a name.
ROLES = frozenset(
    "predsednik predsednica predsedujoci podpredsednik podpredsednica porocevalec porocevalka minister ministrica tajnik "
    "tajnica sekretar sekretarka poslanec poslanka delegat delegatka tovaris tovarisica tov gospod gospa g ga dr mag inz "
    "ing prof predsjednik predsjednica tajnica izvjestitelj izvestilac ministar zastupnik poslanik drug gospodin gdin "
    "chairman chairwoman chair speaker president secretary rapporteur mr mrs ms sir vorsitzender vorsitzende prasident "
    "berichterstatter schriftfuhrer herr frau abgeordneter presidente relatore segretario onorevole signor signora "
    "ministro elnok eloado titkar jegyzo kepviselo ur asszony".split()
)
# Words of address, which are no office.
ADDRESS = frozenset("tovaris tovarisica tov gospod gospa g ga dr mag inz ing prof drug gospodin gdin mr mrs ms sir herr frau onorevole signor signora ur asszony".split())
#: Roles that stand for the one speaker who holds them.
CHAIR = frozenset("predsednik predsednica predsedujoci predsjednik predsjednica chairman chairwoman chair president speaker vorsitzender vorsitzende prasident presidente elnok".split())
# Phrases that fill pauses. Sounds that do are told by their
# letters: a vowel drawn out, or humming after a vowel or none.
FILLERS = ("kaj pa vem", "no ja", "ovaj")
HUMMED = r"([aeäöü])\1{1,}|[eäuö]?h?m+(?:h+m+)?|[äöu]h+m*"

TIME = r"(?:[\[<(]\s*)?\d{1,2}[:.]\d{2}(?:[:.]\d{2})?(?:[,.]\d{1,3})?(?:\s*[\]>)])?"
_LEAD = rf"^\s*(?:{TIME}\s*){{0,4}}(?:[\[<(]?\s*\d{{1,2}}:\d{{2}}(?::\d{{2}})?\s*-->\s*\S+\s*)?(?:>>\s*)?"
LABEL = _LEAD + r"(?:<v\s+([^<>]{1,80})>|(?=\p{Lu})(?:([^:<>\[\]{}]{1,80}):(?=\s|$)|(\p{Lu}[^\p{Ll}:<>\[\]{}]{1,60}?)\s[–—-](?=\s|$)))\s*"
_NOTE = r"\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|(?<!\S)\*[^*]+\*|(?<!\S)/[^/]+/|\((?!\s*(?:\p{L}{1,4}\.|\d))[^()]*\)"
_FILLER = r"(?iu)(?<![\p{L}\d])(?:" + "|".join(FILLERS) + "|" + HUMMED + r")(?![\p{L}\d])(?:\s*(?:…|\.{3})|,)?"
#: A label that names somebody, whoever it is: two to four capitalised words.
_PERSON = r"^(?:\p{Lu}[\p{L}'.\-]*\s+){1,3}\p{Lu}[\p{L}'\-]+(?:\s*\([^()]*\))*$"


def label_text(text: Column) -> Column:
    """The label at the line's beginning, without what follows; null if none."""
    either = F.concat(F.regexp_extract(text, LABEL, 1), F.regexp_extract(text, LABEL, 2), F.regexp_extract(text, LABEL, 3))
    return F.when(F.trim(either) != "", F.trim(either))


def speech(text: Column) -> Column:
    """The line without times, sounds, fillers and doubled words; the label
    must have been taken off."""
    text = F.regexp_replace(text, _NOTE, " ")
    text = F.regexp_replace(text, rf"^\s*(?:{TIME}\s+|{TIME}$)", " ")
    text = F.regexp_replace(text, _FILLER, " ")
    words = F.split(F.trim(text), r"\s+")
    pairs = F.arrays_zip(words.alias("w"), F.concat(F.array(F.lit("")), words).alias("before"))
    again = lambda p: (F.lower(p["w"]) == F.lower(p["before"])) & p["w"].rlike(r"\p{L}")
    kept = F.filter(pairs, lambda p: F.coalesce(~again(p), F.lit(False)))
    return F.array_join(F.transform(kept, lambda p: p["w"]), " ")


def _names(label: str) -> tuple[list[str], list[str]]:
    """(words of the name, keys of the offices before it)."""
    import re

    label = re.sub(r"\([^)]*\)", " ", label or "").split(",")[0]
    label = re.sub(r"(?<!\S)((?:\w\s+){2,}\w)(?!\S)", lambda m: re.sub(r"\s+", "", m[1]), label)
    words = [w for w in (x.strip(".:;,") for x in fold(label).split()) if w]
    at, offices = 0, []
    while at < len(words) and words[at] in ROLES and len(words[at]) > 1:
        offices.append("@chair" if words[at] in CHAIR else f"@{words[at]}")
        at += 1
    return words[at:], [x for x in offices if x[1:] not in ADDRESS]


@F.pandas_udf(ArrayType(StringType()))
def label_names(labels: pd.Series) -> pd.Series:
    """Words of a label's name; an office alone gives its key."""
    out = []
    for label in labels:
        words, offices = _names(label) if label else ([], [])
        out.append(words or offices[:1])
    return pd.Series(out)


@F.pandas_udf(ArrayType(StringType()))
def speaker_keys(labels: pd.Series) -> pd.Series:
    """What a speaker of the mapping may be called, most telling first."""
    out = []
    for label in labels:
        words, offices = _names(label) if label else ([], [])
        keys = [" ".join(words), " ".join(reversed(words))] if words else []
        if len(words) > 1:
            keys += [words[-1], f"{words[0][0]} {words[-1]}"]
        out.append(list(dict.fromkeys(keys + offices)))
    return pd.Series(out)


def _name(label: Column) -> Column:
    return F.array_join(label_names(label), " ")


def one_speaker(mapping: DataFrame) -> DataFrame:
    """doc_id, ord, label, speaker_ref: entries of the mapping, each with the
    ref of the lowest entry of the same speaker of the document - the same
    first name and a last name at most two letters off (in six or more)."""
    m = mapping.where("doc_id is not null and label is not null and speaker_ref is not null").groupBy("doc_id", "ord", "label").agg(F.min("speaker_ref").alias("ref"))
    m = checkpointed(m.withColumn("name", label_names("label"))).withColumn("last", F.try_element_at("name", F.lit(-1))).withColumn("first", F.try_element_at("name", F.lit(1)))
    low = m.select("doc_id", "first", F.col("last").alias("l2"), F.col("ord").alias("o2"), F.col("ref").alias("r2"), F.reverse("name").alias("turned"))
    near = (F.col("last") == F.col("l2")) | ((F.levenshtein("last", "l2", 2) >= 0) & (F.length("last") >= 6))
    pairs = m.join(low, ["doc_id", "first"]).where(near & (F.col("o2") <= F.col("ord")))
    best = pairs.groupBy("doc_id", "ord", "label").agg(F.min_by("r2", F.struct("o2", "r2")).alias("speaker_ref"))
    return m.select("doc_id", "ord", "label", "ref").join(best, ["doc_id", "ord", "label"], "left").select(
        "doc_id", "ord", "label", F.coalesce("speaker_ref", "ref").alias("speaker_ref")
    )


def _segment(size: Column, i: Column) -> tuple[Column, Column]:
    """Where the i-th third of a text of that length begins, and its length."""
    at = lambda n: F.floor(size * n / 3).cast("int")
    return at(i), at(i + 1) - at(i)


def near_keys(asked: DataFrame, known: DataFrame, most: int = 2) -> DataFrame:
    """doc_id, key, known: keys of a document at most two letters apart, of six
    letters and more. Of two such keys one third stands in both, moved by two
    places at most: an equality join on (document, third), never all pairs."""
    thirds = F.sequence(F.lit(0), F.lit(2))
    cut = lambda size, i, moved: F.substring(F.col("key"), _segment(size, i)[0] + moved + 1, _segment(size, i)[1])
    mine = F.transform(thirds, lambda i: F.struct(F.length("key").alias("size"), i.alias("i"), cut(F.length("key"), i, F.lit(0)).alias("s")))
    sizes, moves = F.sequence(F.length("key") - most, F.length("key") + most), F.sequence(F.lit(-most), F.lit(most))
    every = F.flatten(F.transform(sizes, lambda size: F.flatten(F.transform(thirds, lambda i: F.transform(
        F.filter(moves, lambda m: _segment(size, i)[0] + m >= 0), lambda m: F.struct(size.alias("size"), i.alias("i"), cut(size, i, m).alias("s")))))))
    a = asked.select("doc_id", "key", F.explode(F.array_distinct(every)).alias("p"))
    b = known.where(F.length("key") >= 4).select("doc_id", F.col("key").alias("known"), F.explode(mine).alias("p"))
    pairs = a.join(b, ["doc_id", "p"]).select("doc_id", "key", "known").distinct()
    return pairs.where((F.levenshtein("key", "known", most) >= 0) & (F.size(F.split("key", " ")) == F.size(F.split("known", " "))))


def resolved(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """labels (doc_id, line_idx, label) with speaker_ref. A label that names
    somebody who isn't in the document's mapping gets `?` and the name; other
    text before a colon is dropped."""
    speakers = one_speaker(mapping)
    keys = speakers.select("doc_id", "ord", "speaker_ref", F.posexplode(speaker_keys("label")).alias("p", "key"))
    keys = checkpointed(keys.groupBy("doc_id", "key").agg(F.min_by("speaker_ref", F.struct("ord", "p")).alias("speaker_ref")))
    named = labels.withColumn("key", _name(F.col("label"))).where("key <> ''")
    named = checkpointed(named)
    asked = named.select("doc_id", "key").distinct()
    exact = asked.join(keys, ["doc_id", "key"])
    left = asked.join(exact, ["doc_id", "key"], "left_anti").where(F.length("key") >= 6)
    near = near_keys(left, keys).join(keys.withColumnRenamed("key", "known"), ["doc_id", "known"])
    near = near.groupBy("doc_id", "key").agg(F.min_by("speaker_ref", F.struct(F.levenshtein("key", "known"), "known")).alias("speaker_ref"))
    found = named.join(exact.unionByName(near), ["doc_id", "key"], "left")
    unknown = F.when(F.col("label").rlike(_PERSON), F.concat(F.lit("?"), "key"))
    return found.select("doc_id", "line_idx", F.coalesce("speaker_ref", unknown).alias("speaker_ref")).where("speaker_ref is not null")


def lines_in_turns(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """doc_id, line_idx, text (clean), turn (line of the turn's label),
    speaker_ref of lines with speech; somebody who isn't in the mapping has
    turns of their own, with a null ref.

    Of repeated lines (doc_id, line_idx) the first received counts. Lines
    before any label belong to no turn, null and empty lines have no speech, a
    table without labels gives no rows. Order is by line_idx, whatever the
    order of arrival; note_type isn't relied on.
    """
    one = lines.where("doc_id is not null and line_idx is not null").groupBy("doc_id", "line_idx").agg(
        F.min_by("text", F.struct(F.coalesce("received_at", F.lit("9999-12-31").cast("timestamp_ntz")), F.coalesce("text", F.lit("")))).alias("text")
    )
    one = one.withColumn("text", F.coalesce("text", F.lit("")))
    one = checkpointed(one.withColumn("label", label_text(F.col("text"))))
    labels = resolved(one.where("label is not null").select("doc_id", "line_idx", "label"), mapping)
    one = one.join(labels, ["doc_id", "line_idx"], "left")
    told = F.when(F.col("speaker_ref").isNotNull(), F.regexp_replace("text", LABEL, "").alias("t")).otherwise(F.col("text"))
    told = F.when(F.col("speaker_ref").isNotNull(), F.regexp_replace(told, r"^\s*\((?:nadaljuje)\)\s*:?", "")).otherwise(told)
    one = one.select("doc_id", "line_idx", speech(told).alias("text"), "speaker_ref", F.floor(F.col("line_idx") / LINES).alias("block"))
    one = checkpointed(one)  # the fill reads it twice
    mark = F.when(F.col("speaker_ref").isNotNull(), F.struct("line_idx", "speaker_ref"))
    one = carry_last(one, "doc_id", "block", ["line_idx"], mark, "section")
    said = checkpointed(one.where("section is not null").where(F.col("text").rlike(r"[\p{L}\d]")))
    sections = said.select("doc_id", F.col("section.line_idx").alias("line_idx"), F.col("section.speaker_ref").alias("ref")).distinct()
    sections = checkpointed(sections.withColumn("block", F.floor(F.col("line_idx") / LINES)))
    sections = carry_last(sections, "doc_id", "block", ["line_idx"], F.col("ref"), "ref_before", before=True)
    sections = checkpointed(sections)
    begin = F.when(~F.col("ref").eqNullSafe(F.col("ref_before")), F.col("line_idx"))
    sections = carry_last(sections, "doc_id", "block", ["line_idx"], begin, "turn")
    sections = sections.select("doc_id", F.col("line_idx").alias("s"), "turn", F.col("ref").alias("speaker_ref"))
    said = said.select("doc_id", "line_idx", "text", F.col("section.line_idx").alias("s"))
    known = F.when(~F.col("speaker_ref").startswith("?"), F.col("speaker_ref"))
    return said.join(sections, ["doc_id", "s"]).select("doc_id", "line_idx", "text", "turn", known.alias("speaker_ref"))


def turn_starts(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """doc_id, line_idx (where the label stands), speaker_ref of every turn of
    a speaker of the mapping."""
    return lines_in_turns(lines, mapping).where("speaker_ref is not null").select("doc_id", F.col("turn").alias("line_idx"), "speaker_ref").distinct()


def turns(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """doc_id, line_idx, speaker_ref, part, text of every turn, in order. A
    turn of more than PART line numbers comes in parts."""
    said = lines_in_turns(lines, mapping).withColumn("part", F.floor((F.col("line_idx") - F.col("turn")) / PART))
    out = said.groupBy("doc_id", "turn", "speaker_ref", "part").agg(F.array_sort(F.collect_list(F.struct("line_idx", "text"))).alias("t"))
    return out.select("doc_id", F.col("turn").alias("line_idx"), "speaker_ref", "part", F.concat_ws(" ", F.transform("t", lambda t: t["text"])).alias("text"))
