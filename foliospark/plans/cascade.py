"""The general cascade of rules over lines of bound volumes, and its automaton.

Every test that needs only a line, its page and its document is a boolean
column. Rules are arbitrated in order by an automaton that streams over a
document's lines and keeps the open elements only: a rule fires where its test
holds, or where its second test holds and the open elements allow it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import layout, pages, structure

# Patterns of session words, dates, titles and other marks.
SEJA = r"SEJ(?:A|E|I|O|AH|AMI)?"
SEDNICA = r"S(?:JED|ED)NIC(?:A|E|I|O|U|OM|AMA)?"
ZASEDANJE = r"ZAS(?:JED|ED)ANJ(?:E|A|U|EM|IMA)?"
SESSION_WORD = rf"(?:{SEJA}|{SEDNICA}|{ZASEDANJE})"
NUMBERED = rf"\d+\.\s*(?:(?:izredn\w*|redn\w*|skupn\w*|zajedni\w*)\s+)?{SESSION_WORD}"
SESSION_NUM = rf"(?iuU)\b{NUMBERED}\b"
SESSION_ALONE = rf"(?iuU)^\s*{NUMBERED}\s*[.:-]?\s*$"
SESSION_CAPS = rf"(?uU)\b{SESSION_WORD}\b"
HEAD_KEYWORD = rf"(?uU)\b(?:{SESSION_WORD}|NADALJEVANJE)\b"
AGENDA_HEAD = r"(?iuU)^\s*\d+\.\s*(?:TOČK[AE]|TAČK[AE])\s+(?:DNEVNEGA|DNEVNOG)\s+REDA\b"
CHAMBER_HEAD = r"(?iuU)^(?:R\s*E\s*P\s*U\s*B\s*L\s*I\s*Š\s*K\s*I\s+)?ZBOR\b|\bZBORA\s+(?:PROIZVAJALCEV|IN\s+REPUBLIŠKEGA\s+ZBORA)\b"
ROMAN = r"(?iu)^[IVXLCDM]+\.?$"
CHAIRMAN = r"(?iuU)^(?:PREDSEDUJE|PREDSEDAVA\w*|Predsedoval\w*)"
SCRIBE = r"(?iuU)^(?:Zapisnikar|Tajnik)\w*\s*:"
CONTENTS = r"(?iuU)^(?:SADR[ŽZ]AJ|VSEBINA)\b"
DATE_LINE = r"(?iuU)^\(?\s*(?:od\s+)?\d{1,2}\.\s*\S+\s+(?:19|20)\d\d"
DATE_ALONE = r"(?iuU)^\(?\s*(?:od\s+)?\d{1,2}\.\s*\S+\s+(?:i\s+\d{1,2}\.\s*\S+\s+)?(?:19|20)\d\d\.?(?:\s*godine)?\s*\)?\.?$"
START_TIME = r"(?iuU)^(?:\w{1,3}[čc]\w{0,2}tek|Po[čc]etak)\b"
SEJA_BILA = r"(?iuU)^Seja\s+(?:je\s+)?bila\b"
APPENDIX = r"(?uU)^PRILOG[EIA]?\b"
TITLE = r"(?:pred?sedni[kc]\w*|podpredsedni\w*|potpredsedni\w*|predsedujo\S+|predsedava\w*|dr\.?|d\s+r\.?|in[žz]\.?|ing\.?|mr\.?)\b"
PROSE_WORDS = "za je pa se so bo bi o na po od do kot kao i in ter ali da".split()
GAZETTE = r"(?iuU)\b(?:uradni\s+list|ur\.?\s*(?:l|list)|prilog\w*)\b"
APPOINTED = r"(?iuU),\s*(?:in\s+)?za\s+(?:(?:pod)?predsedni\w*|[cčć]lan\w*)\b"


# --- who is a speaker --------------------------------------------------------------


def person_like(label: Column) -> Column:
    """Whether a text before a colon names a person: an office followed by a
    name, or two to eight capitalised words without words of prose."""
    label = F.trim(label)
    words = lambda c: F.filter(F.transform(F.split(c, r"\s+"), lambda w: F.regexp_replace(w, r"[^0-9A-Za-zČŠŽĆĐčšžćđ]", "")), lambda w: w != "")
    upper = lambda w: w.rlike(r"^\p{Lu}")
    one = lambda w: F.length(w) == 1
    titled = label.rlike(rf"(?iuU)^{TITLE}")
    # a list of names after the first comma is no label
    tail = F.regexp_extract(label, r",(.*)$", 1)
    listing = (F.size(F.filter(words(tail), upper)) >= 2) & ((F.regexp_count(label, F.lit(",")) >= 2) | tail.rlike(r"(?iuU)\b(?:in|ter|i)\b"))
    bare = F.trim(F.regexp_replace(label, r"\s*\([^)]*\)\s*$", ""))
    refused = C.any_of(
        label.contains(";"), label.startswith("(") & ~label.rlike(rf"(?iuU)^\(\s*{TITLE}"), label.rlike(GAZETTE), listing,
        bare.rlike(r"(?iuU)\b\d+\.\s*r\.?\b"), bare.rlike(APPOINTED),
    )
    name = F.trim(F.substring_index(bare, ",", 1))
    w = words(name)
    n = F.size(w)
    spelled = (n >= 3) & F.forall(w, one) & F.lower(F.array_join(w, "")).isin("govornik", "predsednik")
    shouted = C.is_upper(name) & (n >= 3) & ~titled
    after = words(F.regexp_replace(name, rf"(?iuU)^(?:{TITLE}\s*)+", ""))
    office = (F.size(F.filter(after, upper)) >= 2) | (F.size(F.filter(after, one)) >= 3)
    rest = F.slice(w, 2, F.greatest(n - 1, F.lit(0)))
    later = F.slice(w, 3, F.greatest(n - 2, F.lit(0)))
    plain = C.all_of(
        n.between(2, 8), upper(w[0]), (F.size(F.filter(w, one)) >= 2) | ~F.exists(later, lambda x: F.lower(x).isin(*PROSE_WORDS)),
        (n <= 4) | F.exists(w, one), F.size(F.filter(w, upper)) >= 2, F.forall(rest, lambda x: upper(x) | one(x)),
    )
    is_titled = titled & upper(name)
    return C.all_of(label.isNotNull(), ~refused, ~spelled, ~shouted, F.when(is_titled, office).otherwise(plain))


def tabular_labels(lines: DataFrame, by: list[str], id: str, y: str, x: str, width: Column, text: str) -> DataFrame:
    """Add `tabular`: a line that ends in a colon beside another line on its
    level further right, as labels in tables do."""
    label = F.col(text).rlike(r":\s*$")
    near = layout.band_semi_join(lines, by, id, y, x, width).select(*by, id, F.lit(True).alias("__beside"))
    return lines.join(near, [*by, id], "left").withColumn("tabular", C.holds(F.col("__beside") & label)).drop("__beside")


# --- measured lines ------------------------------------------------------------------


def measured(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """Lines (doc_id, page_num, line_idx, text, x, y, x_end, font_size, runs,
    page_width, page_height) with all that tests need: t (text with single
    spaces), body, styled, indent, bold, italic, tabular, centered, page marks
    and the states of the page automaton. Null geometry makes tests false."""
    page = ["doc_id", "page_num"]
    p = profiles.groupBy("doc_id").agg(F.max("body_size").alias("body"), F.max("styled").alias("styled"))
    marks = pages.page_marks(lines, page, "text")
    toc = lines.groupBy(*page).agg(F.coalesce(F.bool_or(C.squeezed(F.col("text")).rlike(CONTENTS)), F.lit(False)).alias("toc"))
    states = pages.page_automaton(marks, "doc_id", "page_num").select(*page, "back_matter", "speaker_index", "structure_active", "heading_active")
    df = lines.join(p, "doc_id", "left").join(states, page).join(toc, page)
    df = tabular_labels(df, page, "line_idx", "y", "x", F.col("page_width"), "text")
    left = F.min("x").over(Window.partitionBy(*page))
    # every run of the line that isn't blank is italic
    solid = F.filter("runs", lambda r: F.trim(r["text"]) != "")
    font = lambda r: F.lower(r["font_name"])
    return df.select(
        *[c for c in df.columns if c not in ("body", "styled", "runs")], C.squeezed(F.col("text")).alias("t"),
        F.coalesce("body", F.lit(pages.DEFAULT_SIZE)).alias("body"), F.coalesce("styled", F.lit(False)).alias("styled"),
        F.coalesce(F.col("x") - left, F.lit(0.0)).alias("indent"), C.holds(F.exists("runs", lambda r: font(r).contains("bold"))).alias("bold"),
        C.holds((F.size(solid) > 0) & F.forall(solid, lambda r: font(r).rlike("italic|oblique"))).alias("italic"),
        C.holds(pages.is_centered(F.col("x"), F.col("x_end"), F.col("text"), F.col("font_size"), F.col("page_width"))).alias("centered"),
    )


def tests() -> dict[str, Column]:
    """The tests of the cascade that need no open elements, by rule; null is
    false. They stand alone: which rule a line gets is the automaton's to say."""
    t, active = F.col("t"), F.col("structure_active")
    body_line = pages.is_body_size(F.col("font_size"), F.col("body"))
    label = F.regexp_extract(t, r"^([^:]{2,72}):", 1)
    capitals = F.length(F.regexp_replace(label, r"[^\p{Lu}]", ""))
    evidence = ~F.col("styled") | F.col("bold") | (capitals >= 5) | label.rlike(rf"(?iuU)^{TITLE}")
    parts = C.all_of(body_line, ~F.col("tabular"), label != "", person_like(label), evidence)
    name = F.trim(F.regexp_extract(t, r"^([^,(:]{5,40})\s*[,(:]", 1))
    count = F.size(F.split(name, r"\s+"))
    shouted = C.all_of(name != "", C.is_upper(name), count.between(2, 4) | ((count == 1) & (F.length(name) >= 10)))
    chairman = C.all_of(active, t.rlike(CHAIRMAN), ~parts)
    flush = C.all_of(F.col("styled"), body_line, F.col("indent") < 6, C.leading_capitals(t) >= 5, shouted, ~chairman)
    speaker = C.all_of(active, parts | flush)
    start, alone, dated = t.rlike(START_TIME), (F.length(t) <= 48) & t.rlike(DATE_ALONE), (F.length(t) <= 48) & t.rlike(DATE_LINE)
    time = C.all_of(active, start | alone | (dated & ~F.left(t, F.lit(24)).rlike(SESSION_NUM) & ((F.col("indent") > 15) | t.startswith("("))))
    upper, numbered = C.is_upper(t), t.rlike(SESSION_NUM)
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", ""))
    head = C.all_of(
        F.col("heading_active"), t != "", F.length(t) <= 100, ~t.endswith(":"), ~speaker, t.rlike(ROMAN) | (letters >= 4),
        C.any_of(
            t.rlike(AGENDA_HEAD), t.rlike(SESSION_ALONE), upper & t.rlike(SESSION_CAPS) & (F.col("centered") | (F.length(t) <= 80)),
            (F.col("font_size") >= F.col("body") + 1.8) & (upper | numbered), upper & F.col("bold") & t.rlike(HEAD_KEYWORD),
        ),
    )
    bracketed = C.all_of(body_line, F.col("indent") >= 6, t.rlike(r"^\(.{0,299}\)[ .!?]*$"))
    note = C.all_of(active, ~F.col("tabular"), t != "", C.any_of(bracketed, t.rlike(SEJA_BILA), F.col("styled") & F.col("italic") & (F.col("indent") > 20) & ~time))
    artifact = pages.artifact_kind(F.col("text"), F.col("y"), F.col("font_size"), F.col("page_height"), F.col("body")).isNotNull() | F.col("speaker_index")
    small = F.col("font_size") <= F.col("body") - 1.0
    definition = C.all_of(
        active | F.col("back_matter"), ~F.col("speaker_index"), t.rlike(r"^[^\p{L}\d]{0,8}\d{1,2}\s*[^\d\s%/].*(?:\p{L}.*){4}"), small,
        (F.col("y") / F.col("page_height")).between(0.02, 0.25),
    )
    return {
        "SOURCE_ARTIFACT": C.holds(artifact), "APPENDIX_HEAD": C.all_of(F.col("back_matter"), t.rlike(APPENDIX), F.length(t) < 30),
        "CONTENTS": C.holds(t.rlike(CONTENTS)), "CHAIRMAN": chairman, "SCRIBE": C.holds(t.rlike(SCRIBE)), "TIME": time, "HEAD": head,
        "FOOTNOTE_ENTRY": definition, "GENERIC_NOTE": note, "SPEAKER": speaker,
    }


def state_tests() -> dict[str, Column]:
    """What rules ask of a line where the open elements decide the rest."""
    active, small = F.col("structure_active"), C.holds(F.col("font_size") <= F.col("body") - 1.0)
    body_line, inset = pages.is_body_size(F.col("font_size"), F.col("body")), F.col("indent").between(6.0, 45.0)
    return {
        "UNSTRUCTURED_START": ~active, "CONTENTS": small, "CONTENTS_PAGE": small & F.col("toc"), "SPEECH_START": C.all_of(active, body_line),
        "FOOTNOTE_CONTINUATION": C.holds(F.col("y") / F.col("page_height") <= 0.25), "SEG": C.all_of(active, body_line, inset), "PARAGRAPH": C.all_of(body_line, inset),
    }


# --- the automaton -----------------------------------------------------------------------


@dataclass(frozen=True)
class StateRule:
    """A rule fires where the column `test` holds, or where the column `also`
    holds (or is None) and `state` allows it; `act` changes the open elements."""

    name: str
    test: str | None = None
    also: str | None = None
    state: Callable[[structure.Stack, dict], bool] | None = None
    act: Callable[[structure.Stack, dict], None] = lambda stack, row: None
    append: bool = True


def _into(*to: str, tag: str, again: bool = True, **attrs: str) -> Callable:
    return lambda s, r: s.pop_push(*to, tag=tag, again=again, **attrs)


def _root(stack: structure.Stack, kind: str) -> None:
    stack.pop_to("body")
    stack.push("div", type=kind)


def _speech(stack: structure.Stack) -> None:
    """Close a speaker's label, which opens the utterance, and begin a segment."""
    stack.pop_to("note", invert=True)
    stack.pop_to("u", "div")
    stack.push("seg")


def _speaker(stack: structure.Stack, row: dict) -> None:
    label, colon, speech = row["t"].partition(":")
    stack.pop_to("div")
    stack.push("note", type="speaker")
    stack.text(label + colon)
    if colon:
        if speech.strip():
            _speech(stack)
            stack.text(speech)
        else:
            stack.pop_to("note", invert=True)


def _head(stack: structure.Stack, row: dict) -> None:
    kind = row["head"]
    division = {"agendaItem": "agendaSection", "sessionNumber": "debateSection", "session": "debateSection", "chamber": "debateSection"}.get(kind, "section")
    stack.pop_to("div")
    own, filled = stack.attribute("type"), stack.has_body()
    if division == "debateSection":
        if own != division or filled:
            _root(stack, division)
    elif own != division or filled:
        if own == division:
            stack.pop()
        stack.push("div", type=division)
    stack.push("head", type=kind)


def _time(stack: structure.Stack, row: dict) -> None:
    if not stack.on_top("time", type=row["time"]):
        stack.pop_to("div")
        stack.push("p")
        stack.push("time", type=row["time"])


def _resume(stack: structure.Stack, row: dict) -> None:
    """After a note: a new segment of the utterance around it, or a paragraph."""
    stack.pop_to("note", invert=True)
    if stack.within("u"):
        stack.pop_to("u", "div")
        stack.push("seg")
    else:
        stack.pop_to("div")
        stack.push("p")


def _entry(stack: structure.Stack, row: dict) -> None:
    stack.pop_to("u", "div")
    number, rest = row["number"], row["rest"]
    stack.push("note", place="foot", n=number, page=str(row["page_num"]))
    stack.text(rest)


def _unmatched(stack: structure.Stack, row: dict) -> None:
    stack.comment("unmatched line, kept for review")
    stack.push("seg" if stack.top() == "u" else "p", type="unparsed", n=str(row["page_num"] + 1))


def _talking(stack: structure.Stack) -> bool:
    return stack.within("u") or stack.within("note", type="speaker")


def general_rules() -> list[StateRule]:
    """The cascade in its order."""
    def foot(s, r):
        return s.on_top("note", place="foot") and s.attribute("page") == str(r["page_num"])

    def aside(s, r):
        return s.on_top("note") and s.attribute("type") is None and s.attribute("place") is None

    def paragraph(s, r):
        if _talking(s):
            return False
        return s.top() != "p" or s.attribute("type") == "unparsed" or r["s_PARAGRAPH"]

    def begun(s, r):
        kind = s.nearest("div", "type")
        return kind is not None and kind not in ("frontMatter", "backMatter")

    def back(s, r):
        _root(s, "backMatter")
        s.push("p")

    def appendix(s, r):
        _root(s, "backMatter")
        s.push("head", type="appendix")

    def note(s, r):
        s.pop_to("u", "div")
        s.push("note")

    return [
        StateRule("SOURCE_ARTIFACT", "t_SOURCE_ARTIFACT", append=False),
        StateRule("APPENDIX_HEAD", "t_APPENDIX_HEAD", act=appendix),
        StateRule("UNSTRUCTURED_START", also="s_UNSTRUCTURED_START", state=begun, act=back),
        StateRule("CONTENTS", "t_CONTENTS", "s_CONTENTS", lambda s, r: r["s_CONTENTS_PAGE"] or s.on_top("note", type="contents"), _into("div", tag="note", type="contents")),
        StateRule("CHAIRMAN", "t_CHAIRMAN", act=_into("div", tag="note", type="chairman")),
        StateRule("SCRIBE", "t_SCRIBE", act=_into("div", tag="note", type="scribe")),
        StateRule("TIME", "t_TIME", act=_time),
        StateRule("HEAD", "t_HEAD", act=_head),
        StateRule("FOOTNOTE_ENTRY", "t_FOOTNOTE_ENTRY", act=_entry, append=False),
        StateRule("FOOTNOTE_CONTINUATION", also="s_FOOTNOTE_CONTINUATION", state=foot),
        StateRule("GENERIC_NOTE", "t_GENERIC_NOTE", act=note),
        StateRule("SPEAKER", "t_SPEAKER", act=_speaker, append=False),
        StateRule("SPEECH_START", also="s_SPEECH_START", state=lambda s, r: s.on_top("note", type="speaker"), act=lambda s, r: _speech(s)),
        StateRule("AFTER_FOOTNOTE", state=lambda s, r: s.on_top("note", place="foot"), act=_resume),
        StateRule("AFTER_GENERIC_NOTE", state=aside, act=_resume),
        StateRule("SEG", also="s_SEG", state=lambda s, r: _talking(s), act=lambda s, r: s.pop_push("u", "div", tag="seg", again=False)),
        StateRule("PARAGRAPH", state=paragraph, act=_into("div", tag="p", again=False)),
        StateRule("UNMATCHED_LINE", state=lambda s, r: s.top() in ("div", "u"), act=_unmatched),
    ]


def run_rules(lines: DataFrame, rules: list[StateRule], columns: list[str], doc: str = "doc_id", order: tuple[str, ...] = ("page_num", "line_idx")) -> DataFrame:
    """doc, the order columns, rule and the nodes that each line gave (array of
    structure.NODE): rules arbitrated in order over a document's lines, which
    stream through sorted; only open elements and one batch are held. A line
    no rule takes is appended to what is open, with a null rule; blank lines
    are passed over. An utterance opens when a speaker's label is closed."""
    kinds = dict(lines.dtypes)
    keep = [doc, *order, "t", *columns]
    node = structure.NODE.replace(" long", ": long").replace(" int", ": int").replace(" map", ": map").replace(" string", ": string")
    schema = ", ".join(f"{c} {kinds[c]}" for c in (doc, *order)) + f", rule string, nodes array<struct<{node}>>"
    names = [n.split()[0] for n in structure.NODE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, stack, nothing = None, None, object()
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                if stack is None or row[doc] != at:
                    at, stack = row[doc], structure.Stack("body", hooks={("note", "speaker"): _utterance})
                fired = None
                if row["t"]:
                    for r in rules:
                        held = r.test is not None and row[r.test]
                        if held or (r.state is not None and (r.also is None or row[r.also]) and r.state(stack, row)):
                            fired = r
                            break
                    if fired is not None:
                        fired.act(stack, row)
                    if fired is None or fired.append:
                        stack.text(row["t"])
                nodes = [dict(zip(names, x)) for x in stack.rows]
                stack.rows.clear()
                out.append((at, *[row[c] for c in order], fired.name if fired else None, nodes))
            yield pd.DataFrame(out, columns=[doc, *order, "rule", "nodes"])

    return lines.select(*keep).repartition(F.col(doc)).sortWithinPartitions(doc, *order).mapInPandas(run, schema)


def _utterance(stack: structure.Stack, label: str) -> None:
    stack.push("u", who=label.split(":", 1)[0].strip())


def classified(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """The general cascade over lines: see run_rules. Null texts match nothing."""
    df = measured(lines, profiles)
    flags = {f"t_{k}": v for k, v in tests().items()} | {f"s_{k}": F.coalesce(v, F.lit(False)) for k, v in state_tests().items()}
    df = df.withColumns(flags | {
        "head": pages_head_kind(F.col("t")), "time": F.when(F.col("t").rlike(START_TIME), "start").otherwise("date"),
        "number": F.regexp_extract("t", r"^[^\p{L}\d]{0,8}(\d{1,2})", 1), "rest": F.regexp_extract("t", r"^[^\p{L}\d]{0,8}\d{1,2}\s*(.*)$", 1),
    })
    return run_rules(df, general_rules(), [*flags, "head", "time", "number", "rest"])


def pages_head_kind(t: Column) -> Column:
    return (
        F.when(t.rlike(AGENDA_HEAD), "agendaItem").when(t.rlike(SESSION_NUM), "sessionNumber").when(t.rlike(SESSION_CAPS), "session")
        .when(t.rlike(CHAMBER_HEAD), "chamber").when(t.rlike(ROMAN), "sectionNumber").otherwise("section")
    )
