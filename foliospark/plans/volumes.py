"""Rule sets of single volumes with fixed coordinates.

Each set is a list of state rules (plans.cascade) over columns of measured
lines. `tests` has what a line alone decides; rules that go on while an element
is open have a second column, named `s_` and the rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import cascade
from .cascade import StateRule, _into



def _columns() -> list[Column]:
    return [F.col(c) for c in ("t", "x", "y", "font_size", "page_num", "bold", "italic")]


def _is(*tests: Column) -> Column:
    return C.all_of(*tests)


def _between(c: Column, low: float, high: float) -> Column:
    return (c > low) & (c < high)


def placed(lines: DataFrame) -> DataFrame:
    """Add what the rule sets ask of neighbours: `turn` (one of the three lines
    before is of another page), `top` (the first line of a page's body), `dx`
    and `dy` to the line before, and the page's left edge."""
    T, X, Y, _, PAGE, _, _ = _columns()
    flow = Window.partitionBy("doc_id").orderBy("page_num", "line_idx")
    page = Window.partitionBy("doc_id", "page_num")
    other = lambda n: F.coalesce(F.lag("page_num", n).over(flow) != PAGE, F.lit(False))
    body = ~(_between(Y, 724, 742) | (F.length(T) <= 2))
    first = F.min(F.when(C.holds(body), F.col("line_idx"))).over(page)
    return lines.withColumns({
        "turn": other(1) | other(2) | other(3), "top": C.holds(F.col("line_idx") == first), "left": F.min("x").over(page),
        "dx": F.abs(X - F.lag("x").over(page.orderBy("line_idx"))), "dy": F.abs(Y - F.lag("y").over(page.orderBy("line_idx"))),
    })


def republics() -> tuple[dict[str, Column], list[StateRule]]:
    """A volume read by characters in two columns."""
    T, X, Y, SIZE, PAGE, BOLD, ITALIC = _columns()
    jump = F.col("dx").isNull() | (F.col("dx") > 240) | (F.col("dy") > 230)
    inset = X.between(F.when(PAGE <= 2, 48.0).otherwise(41.0), F.lit(64.0)) | X.between(287, 303)
    tests = {
        "HEADER": F.col("turn"), "SEJA_DECLARATION": _is(_between(Y, 605, 610), BOLD), "TIME": _is(ITALIC, _between(Y, 590, 600)),
        "CHAIRMAN": _is(T.startswith("PREDSEDUJE"), ~ITALIC, X > 174), "SEJA_SECTION": _is(C.is_upper(T), _between(X, 194, 360), F.col("top")),
        "REFERENCE_ENTRY": _is((SIZE == 7.0) | _between(SIZE, 6.9, 7.0), T.rlike(r"^\d+")), "GENERIC_NOTE": _is(_between(X, 323, 457), ITALIC, T != ""),
        "SPEAKER": _is(_between(X, 0, 55) | _between(X, 271, 293), C.leading_capitals(T) >= 5),
        "SEG": _is(F.when(jump, _between(SIZE, 8.9, 10.1)).otherwise(inset & (SIZE >= 9.0) & (SIZE < 10.1))),
        "s_SEJA_DECLARATION": C.holds(BOLD), "s_TIME": C.holds(ITALIC), "s_CHAIRMAN": _is(~ITALIC, X > 174),
    }
    rules = [
        StateRule("HEADER", "HEADER", append=False),
        StateRule("SEJA_DECLARATION", "SEJA_DECLARATION", "s_SEJA_DECLARATION", lambda s, r: s.on_top("head", type="session"), _into("body", tag="head", type="session")),
        StateRule("TIME", "TIME", "s_TIME", lambda s, r: s.on_top("head", type="sessionSection"), _into("div", "body", tag="time")),
        StateRule("CHAIRMAN", "CHAIRMAN", "s_CHAIRMAN", lambda s, r: s.on_top("time") or s.on_top("note", type="chairman"), _into("div", "body", tag="note", type="chairman")),
        StateRule("SEJA_SECTION", "SEJA_SECTION", act=_into("div", "body", tag="head", type="sessionSection")),
        StateRule("REFERENCE_ENTRY", "REFERENCE_ENTRY", act=lambda s, r: s.pop_push("u", "div", "body", tag="note", again=False, place="foot", n=r["number"])),
        StateRule("GENERIC_NOTE", "GENERIC_NOTE", act=lambda s, r: (s.pop_push("u", "div", "body", tag="note", again=False), s.push("hi", rend="italic"))),
        StateRule("SPEAKER", "SPEAKER", act=_into("div", "body", tag="note", type="speaker")),
        StateRule("SEG", also="SEG", state=lambda s, r: not s.on_top("note", place="foot"), act=_into("u", "div", "body", tag="seg", again=False)),
    ]
    return tests, rules


def chamber() -> tuple[dict[str, Column], list[StateRule]]:
    """A volume read by characters in one column, spaces kept."""
    T, X, Y, SIZE, PAGE, BOLD, ITALIC = _columns()
    title = _is(X < 160, Y > 640, C.is_upper(T))
    mid = _between(X, 200, 285)
    bands = F.when(PAGE % 2 == 0, _between(X, 60, 90)).otherwise(_between(X, 75, 105))
    tests = {
        "SEJA_DATE": _is(title, T.startswith("OD ")), "SEJA_NUM": _is(title, T.contains("SEDNICA")), "SEJA_DECLARATION": title,
        "CHAIRMAN": _is(mid, T.startswith("PREDSEDAVA") | C.is_upper(T)), "TIME": _is(mid, T.startswith("Početak") | ITALIC), "CONTENTS": _is(T.startswith("SADR")),
        "GENERIC_NOTE": _is(_between(X, 140, 280), ITALIC), "SPEAKER": _is(T.endswith(":"), F.length(T) < 100, BOLD), "SEG": _is(_between(SIZE, 10.4, 11.6), bands),
        "s_CONTENTS": F.lit(True),
    }
    rules = [
        StateRule("SEJA_DATE", "SEJA_DATE", act=_into("div", "body", tag="time")),
        StateRule("SEJA_NUM", "SEJA_NUM", act=_into("div", "body", tag="head", type="sessionNumber")),
        StateRule("SEJA_DECLARATION", "SEJA_DECLARATION", act=_into("div", "body", tag="head", type="session")),
        StateRule("CHAIRMAN", "CHAIRMAN", act=_into("div", "body", tag="note", type="chairman")),
        StateRule("TIME", "TIME", act=_into("div", "body", tag="time")),
        StateRule("CONTENTS", "CONTENTS", "s_CONTENTS", lambda s, r: s.on_top("note", type="contents"), _into("div", "body", tag="note", type="contents")),
        StateRule("GENERIC_NOTE", "GENERIC_NOTE", act=lambda s, r: (s.pop_push("u", "div", "body", tag="note", again=False), s.push("hi", rend="italic"))),
        StateRule("SPEAKER", "SPEAKER", act=_into("div", "body", tag="note", type="speaker")),
        StateRule("SEG", "SEG", act=_into("u", "div", "body", tag="seg", again=False)),
    ]
    return tests, rules


def sessions_of_1957() -> tuple[dict[str, Column], list[StateRule]]:
    """A volume read by words; session pages are those with a number of a session."""
    T, X, Y, SIZE, _, _, _ = _columns()
    page = F.col("session_page")
    label = F.regexp_extract(T, r"^([^:]{2,90}):", 1)
    tests = {
        "SESSION_HEADING": _is(page, SIZE >= 11.5), "SESSION_DATE": _is(page, T.rlike(r"^\(\s*d\..*19\d\d\.?\s*\)\.?$")),
        "CHAIRMAN": _is(page, F.lower(T).startswith("predsedoval")), "SCRIBE": _is(page, T.rlike(r"(?iuU)^(?:Zapisnikar|Tajnik)\w*\s*:")),
        "START_TIME": _is(page, T.rlike(r"(?iuU)^(?:Začetek|Pričetek|Kačctek)\s+seje\b")), "GENERIC_NOTE": _is(F.col("inset"), T.startswith("(") | T.rlike(cascade.SEJA_BILA)),
        "SPEAKER": _is(label != "", cascade.person_like(label), _between(Y, 34, 590)),
        "SEG": _is(SIZE.between(8.8, 10.6), _between(Y, 34, 590), X >= F.col("left") + 14),
    }
    rules = [
        StateRule("SESSION_HEADING", "SESSION_HEADING", act=_into("body", tag="head", type="session")), StateRule("SESSION_DATE", "SESSION_DATE", act=_into("div", "body", tag="time", type="date")),
        StateRule("CHAIRMAN", "CHAIRMAN", act=_into("div", "body", tag="note", type="chairman")), StateRule("SCRIBE", "SCRIBE", act=_into("div", "body", tag="note", type="scribe")),
        StateRule("START_TIME", "START_TIME", act=_into("div", "body", tag="time", type="start")), StateRule("GENERIC_NOTE", "GENERIC_NOTE", act=_into("u", "div", "body", tag="note", again=False)),
        StateRule("SPEAKER", "SPEAKER", act=cascade._speaker, append=False), StateRule("SEG", "SEG", act=_into("u", "div", "body", tag="seg", again=False)),
    ]
    return tests, rules


def paragraphs_of_word() -> tuple[dict[str, Column], list[StateRule]]:
    """Runs of framed paragraphs (sources.readers.docx_runs) routed by the
    middle of their frame: center, or all else. The time of a session is taken
    once; a paragraph that isn't centered makes way for the next."""
    center = F.col("group") == "center"
    bold, italic = F.col("bold"), F.col("italic")
    tests = {
        "SEJA_DECLARATION": _is(center, bold), "s_TIME": _is(center, italic), "s_CHAIRMAN": C.holds(center), "SEJA_SECTION": C.holds(center),
        "REFERENCE_ENTRY": _is(~center, F.col("superscript"), F.col("run") == 0), "GENERIC_NOTE": _is(~center, F.col("alignment") == "center", italic),
        "SPEAKER": _is(~center, F.coalesce("first_line_indent", F.lit(0.0)) == 0, C.is_upper(F.left("t", F.lit(3)))),
        "SEG": _is(~center, F.coalesce("first_line_indent", F.lit(0.0)) != 0, F.col("run") == 0), "reset": C.holds(~center),
    }

    def time(s, r):
        return not s.state.get("time seen")

    def take_time(s, r):
        s.state["time seen"] = True
        s.pop_push("div", "body", tag="time")

    def reset(s, r):
        s.state["time seen"] = False
        return False

    rules = [
        StateRule("run_immediate", also="reset", state=reset),
        StateRule("SEJA_DECLARATION", "SEJA_DECLARATION", act=_into("body", tag="head", type="session")), StateRule("TIME", also="s_TIME", state=time, act=take_time),
        StateRule("CHAIRMAN", also="s_CHAIRMAN", state=lambda s, r: s.on_top("time") or s.on_top("note", type="chairman"), act=_into("div", "body", tag="note", type="chairman")),
        StateRule("SEJA_SECTION", "SEJA_SECTION", act=_into("div", "body", tag="head", type="sessionSection")),
        StateRule("REFERENCE_ENTRY", "REFERENCE_ENTRY", act=lambda s, r: s.pop_push("u", "div", "body", tag="note", again=False, place="foot", n=r["number"])),
        StateRule("GENERIC_NOTE", "GENERIC_NOTE", act=lambda s, r: (s.pop_push("u", "div", "body", tag="note", again=False), s.push("hi", rend="italic"))),
        StateRule("SPEAKER", "SPEAKER", act=_into("div", "body", tag="note", type="speaker")), StateRule("SEG", "SEG", act=_into("u", "div", "body", tag="seg", again=False)),
    ]
    return tests, rules


SETS = {"republics": republics, "chamber": chamber, "sessions_of_1957": sessions_of_1957}


def prepared(lines: DataFrame) -> DataFrame:
    """Measured lines with places, session pages and whether a line is inset."""
    T, X, _, _, _, _, _ = _columns()
    df = placed(lines)
    page = Window.partitionBy("doc_id", "page_num")
    return df.withColumns({
        "session_page": C.holds(F.bool_or(T.rlike(cascade.SESSION_NUM)).over(page)), "inset": C.holds(X >= F.col("left") + 8),
        "number": F.regexp_extract("t", r"^(\d+)", 1),
    })


def classified(lines: DataFrame, rule_set: str) -> DataFrame:
    """Lines of a volume through one of SETS: see cascade.run_rules."""
    tests, rules = SETS[rule_set]()
    df = prepared(lines).withColumns({k: F.coalesce(v, F.lit(False)) for k, v in tests.items()})
    return cascade.run_rules(df, rules, [*tests, "number"])


def classified_runs(runs: DataFrame) -> DataFrame:
    """DOCX runs through the rule set of Word, routed by their frames."""
    from .rules import aligned

    tests, rules = paragraphs_of_word()
    df = runs.where("error is null").withColumn("t", C.squeezed(F.col("text"))).withColumn("group", aligned(F.col("x"), F.col("w"))).withColumn("number", F.regexp_extract("t", r"^(\d+)", 1))
    df = df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in tests.items()})
    return cascade.run_rules(df, rules, [*tests, "number"], "path", ("para", "run"))


def test_counts(df: DataFrame, tests: dict[str, Column], by: str = "doc_id") -> DataFrame:
    """by, rule, n: on how many lines each test holds, in one pass."""
    sums = df.groupBy(by).agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in tests.items()])
    return sums.unpivot([by], list(tests), "rule", "n")
