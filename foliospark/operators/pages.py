"""Profiles of documents, classes of lines, and the page automaton."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_upper, squeezed

DEFAULT_SIZE = 10.0

# Words of sessions, agenda, appendix and footers, as patterns.
SEJA, SEDNICA, ZASEDANJE = r"SEJ(?:A|E|I|O|AH|AMI)?", r"S(?:JED|ED)NIC(?:A|E|I|O|U|OM|AMA)?", r"ZAS(?:JED|ED)ANJ(?:E|A|U|EM|IMA)?"
KIND = r"(?:(?:izredn\w*|redn\w*|skupn\w*|zajedni\w*)\s+)?"
SESSION = rf"(?iuU)\b\d+\.\s*{KIND}(?:{SEJA}|{SEDNICA}|{ZASEDANJE})\b"
DEBATE = rf"(?iuU)\b(?:{SEJA}|{SEDNICA})\b"
CUE = r"(?iuU)^(?:pred?sedni[kc]\w*|podpredsedni\w*|potpredsedni\w*|predsedujo\S+|predsedava\w*)\s+(?:dr\.?\s+)?\S.{0,70}:\s*"
AGENDA = r"(?iuU)^\s*\d+\.\s*(?:TOČK[AE]|TAČK[AE])\s+(?:DNEVNEGA|DNEVNOG)\s+REDA\b"
APPENDIX = r"(?uU)^PRILOG[EIA]?\b"
INDEX = r"(?iuU)^SEZNAM\s+GOVORNIKOV\b"
FOOTER = r"(?iuU)^(?:\d+\s+)?(?:st|[šs]t)\.?\s+(?:bele[žšz]k\w*|zapis\w*)\b"
ROMAN = r"^\s*[IVXLCDM]+\.?\s*$"


def half_points(size: Column) -> Column:
    """Rounded to half a point, half to even."""
    return F.bround(size * 2, 0) / 2


def weighted_mode(df: DataFrame, by: list[str], value: str, weight: Column, order: Column, name: str) -> DataFrame:
    """by..., name: the value with the highest total weight, of equal ones the
    first met. Aggregated by value first, so that a hot group is small."""
    sums = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.sum(weight).alias("__w"), F.min(order).alias("__first"))
    best = F.min_by(F.col(value), F.struct((-F.col("__w")).alias("w"), F.col("__first").alias("f")))
    return sums.groupBy(*by).agg(best.alias(name))


def document_profile(runs: DataFrame, by: str, text: str, font: str, size: str, order: Column) -> DataFrame:
    """by, body_size, space_ratio, mode, styled: the commonest size to half a
    point (10 by default), the share of blank characters, the way to read
    spaces, and whether bold or italic fonts occur."""
    invisible = F.lower(F.col(font)).rlike("invisible|ocr")
    chars = F.length(F.col(text))
    blanks = F.length(F.regexp_replace(F.col(text), "[^ ]", ""))
    sums = runs.groupBy(by).agg(
        F.coalesce(F.sum(chars), F.lit(0)).alias("n_chars"), F.coalesce(F.sum(blanks), F.lit(0)).alias("n_blanks"),
        F.coalesce(F.bool_or(invisible), F.lit(False)).alias("ocr"), F.coalesce(F.bool_or(F.lower(F.col(font)).rlike("bold|italic")), F.lit(False)).alias("fancy"),
    )
    seen = runs.where(F.length(F.trim(F.col(text))) > 0).withColumn("__half", half_points(F.col(size)))
    body = weighted_mode(seen, [by], "__half", F.length(F.trim(F.col(text))), order, "body_size")
    ratio = F.col("n_blanks") / F.greatest("n_chars", F.lit(1))
    ocr = F.col("ocr") | (F.col("n_chars") == 0)
    mode = F.when(ocr, "ocr").when(ratio < 0.05, "char-break").otherwise("char-preserve")
    return sums.join(body, by, "left").select(
        by, F.coalesce("body_size", F.lit(DEFAULT_SIZE)).alias("body_size"), ratio.alias("space_ratio"), mode.alias("mode"), (~ocr & F.col("fancy")).alias("styled")
    )


def is_body_size(size: Column, body: Column) -> Column:
    return F.coalesce(F.abs(size - body) <= 1.6, F.lit(False))


def is_centered(x: Column, x_end: Column, text: Column, size: Column, width: Column) -> Column:
    """Left and right margins alike; an unknown end is estimated by the text's length."""
    end = F.coalesce(x_end, x + F.length(text) * size * 0.48)
    return F.abs(x - (width - end)) <= F.greatest(F.lit(18.0), width * 0.06)


def artifact_kind(text: Column, y: Column, size: Column, height: Column, body: Column) -> Column:
    """Page number, running header, running footer or speaker index of a
    line; null for text."""
    short = F.length(F.trim(text)) <= 4
    top = (y > height * 0.915) & ((size <= body - 1) | short)
    bottom = (y < height * 0.085) & (size <= body - 1) & text.rlike(FOOTER)
    return F.when(text.rlike(INDEX), "speakerIndex").when(top & F.trim(text).rlike(r"^\d+$"), "pageNumber").when(top, "runningHeader").when(bottom, "runningFooter")


def head_kind(text: Column) -> Column:
    """The kind of heading a text would be."""
    text = squeezed(text)
    return (
        F.when(text.rlike(AGENDA), "agendaItem").when(text.rlike(SESSION) & text.rlike(r"^\s*\S?\s*\d"), "sessionNumber")
        .when(text.rlike(r"(?iuU)\b(?:seja|sednica|sjednica|zasedanje|zasjedanje)\b"), "session").when(text.rlike(r"(?uU)^ZBOR\b"), "chamber")
        .when(text.rlike(ROMAN), "sectionNumber").otherwise("section")
    )


def page_marks(lines: DataFrame, by: list[str], text: str) -> DataFrame:
    """by... and six marks of each page: whether any line is of that kind."""
    t = F.col(text)
    any_ = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    return lines.groupBy(*by).agg(
        any_(t.rlike(SESSION)).alias("session"), any_(t.rlike(SESSION) & t.rlike(DEBATE)).alias("debate"), any_(t.rlike(r"^\p{Lu}") & t.rlike(CUE)).alias("cue"),
        any_(t.rlike(INDEX)).alias("index"), any_(t.rlike(APPENDIX)).alias("appendix"), any_(is_upper(t) & t.rlike(AGENDA)).alias("agenda"),
    )


def page_automaton(marks: DataFrame, doc: str, page: str) -> DataFrame:
    """Add seen_session, back_matter, speaker_index, structure_active and
    heading_active to pages with their marks: a state machine over a
    document's pages in closed form, four passes of windows."""
    w = Window.partitionBy(doc).orderBy(page)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = marks.withColumn("__seen", F.bool_or("session").over(upto)).withColumn("__strong", F.col("debate") & F.col("cue"))
    back = F.when(F.col("appendix"), True).when(F.col("__strong"), False)
    df = df.withColumn("back_matter", F.coalesce(F.last(back, True).over(upto), F.lit(False)))
    was = F.lag("back_matter", 1, False).over(w)
    df = df.withColumn("__resume", F.when(was, F.col("__strong")).otherwise(F.col("debate") | (F.col("__seen") & F.col("cue"))))
    df = df.withColumn("seen_session", F.bool_or("__resume").over(upto))
    index = F.when(F.col("index"), True).when(F.col("__resume"), False)
    df = df.withColumn("speaker_index", F.coalesce(F.last(index, True).over(upto), F.lit(False)))
    active = F.col("seen_session") & ~F.col("speaker_index") & ~F.col("back_matter")
    df = df.withColumn("structure_active", active).withColumn("heading_active", active | F.col("session"))
    return df.drop("__seen", "__strong", "__resume")


def first_of_page(df: DataFrame, by: list[str], order: list[str], page: str, depth: int = 1) -> DataFrame:
    """Add `page_top`: whether any of the `depth` rows before is of another page."""
    w = Window.partitionBy(*by).orderBy(*order)
    other = F.lit(False)
    for n in range(1, depth + 1):
        other = other | F.coalesce(F.lag(page, n).over(w) != F.col(page), F.lit(True))
    return df.withColumn("page_top", other)


def artifact_notes(artifacts: DataFrame, by: list[str], kind: str, page: str, order: str, text: str) -> DataFrame:
    """by..., kind, page, text, ord: the artifacts of a page and kind as one
    note of lines, numbered in the order first met."""
    listed = F.array_sort(F.collect_list(F.struct(order, text)))
    notes = artifacts.groupBy(*by, kind, page).agg(F.array_join(F.transform(listed, lambda t: t[text]), "\n").alias(text), F.min(order).alias("__first"))
    w = Window.partitionBy(*by).orderBy(page, "__first")
    return notes.withColumn("ord", F.row_number().over(w)).drop("__first")
