"""Repair of text from scanned pages.

Furniture is found among the edge lines of pages. Words are counted over all
text lines; rare words are joined with frequent ones through the differences
that confusable glyphs make to an anagram hash, the corrections are ranked by
frequency; words cut by a line's end are told from words with a hyphen of their
own by how often either form stands within lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.carry import carry_last
from .common import checkpointed

# What is printed and what is read for it.
CONFUSIONS = (
    ("o", "0"), ("l", "1"), ("i", "!"), ("a", "@"), ("s", "5"), ("b", "6"), ("z", "2"), ("g", "9"), ("v", "\\/"),
    ("e", "c"), ("n", "ri"), ("l", "i"), ("d", "cl"), ("u", "ii"), ("m", "rn"), ("h", "li"), ("č", "ć"), ("š", "§"), ("ž", "£"),
    ("", "■"), ("", "*"), ("", "^"), ("", "~"), ("", "|"),
)
#: Marks that a broken line may end with.
BREAKS = "-‐‑­¬="
#: Share of the page's height at either edge in which furniture stands.
EDGE = 0.06
#: A frequent variant occurs this often, and so many times as often as the
#: rare word it corrects.
FREQUENT, RATIO = 5, 10

_WORD = r"^[\p{P}\p{S}&&[^@■§£*^~|\\\-]]+|[\p{P}\p{S}&&[^@■§£*^~|\\!]]+$"


def deduplicated(lines: DataFrame) -> DataFrame:
    """One row per (doc_id, page_num, line_idx) with text, x, y, font_size and
    page_height: of repeated rows the earliest extracted. Rows without a
    document are dropped; other columns are left behind."""
    key = ["doc_id", "page_num", "line_idx"]
    kept = ["text", "x", "y", "font_size", "page_height"]
    first = F.min_by(F.struct(*kept), F.struct(F.coalesce("extracted_at", F.lit("9999-12-31").cast("timestamp_ntz")), F.coalesce("text", F.lit(""))))
    return lines.where("doc_id is not null").groupBy(*key).agg(first.alias("r")).select(*key, "r.*")


def classified(lines: DataFrame) -> DataFrame:
    """Add `kind` - furniture, aside (headings, figures standing alone) or
    text - and `starts`, whether a paragraph begins with the line.

    An edge line is furniture if it stands apart from the page's text by more
    than one and a half lines, if its text, figures aside, stands at that edge
    of another page too, or if it is a number. Null geometry is that of text;
    blank lines are asides.
    """
    height = F.col("page_height")
    top, bottom = (height - F.col("y")) < EDGE * height, F.col("y") < EDGE * height
    edge = F.when(top, "top").when(bottom, "bottom")
    page = Window.partitionBy("doc_id", "page_num")
    inner = F.when(edge.isNull(), F.col("y"))
    df = lines.withColumn("edge", edge)
    df = df.withColumn("inner_top", F.max(inner).over(page)).withColumn("inner_bottom", F.min(inner).over(page))
    gap = F.when(F.col("edge") == "top", F.col("y") - F.col("inner_top")).when(F.col("edge") == "bottom", F.col("inner_bottom") - F.col("y"))
    masked = F.regexp_replace(F.lower(F.translate("text", "lOoISB", "110158")), r"[\d\W_]+", "#")
    df = df.withColumn("masked", F.when(F.col("edge").isNotNull(), masked))
    repeated = (
        df.where("edge is not null").groupBy("doc_id", "edge", "masked").agg(F.count_distinct("page_num").alias("pages"))
        .where("pages > 1").select("doc_id", "edge", "masked", F.lit(True).alias("again"))
    )
    # the left margin of a document's text: below it lies little but noise
    margin = df.where("edge is null and x is not null").groupBy("doc_id").agg(F.percentile_approx("x", 0.2, 1000).alias("margin"))
    df = df.join(repeated, ["doc_id", "edge", "masked"], "left").join(margin, "doc_id", "left")
    number = F.coalesce(F.col("text").rlike(r"^[\W_]*[\dlOoISB]+[\W_]*$"), F.lit(False))
    apart = F.coalesce(gap > 1.5 * F.col("font_size"), F.col("inner_top").isNull())
    furniture = F.col("edge").isNotNull() & (apart | F.coalesce("again", F.lit(False)) | number)
    far = F.coalesce(F.col("x") - F.col("margin") > 5 * F.col("font_size"), F.lit(False))
    blank = F.coalesce(F.trim("text") == "", F.lit(True))
    kind = F.when(furniture, "furniture").when(far | blank, "aside").otherwise("text")
    inset = F.coalesce(F.col("x") - F.col("margin") > 0.6 * F.col("font_size"), F.lit(False))
    return df.withColumn("kind", kind).withColumn("starts", (F.col("kind") == "aside") | inset).drop(
        "edge", "inner_top", "inner_bottom", "masked", "again", "margin"
    )


def text_lines(lines: DataFrame) -> DataFrame:
    return classified(deduplicated(lines)).where("kind = 'text'")


def with_next(text: DataFrame) -> DataFrame:
    """Add `following` and `preceding`: the text of the next text line and the
    one before, on the page or else on the nearest page that has text; and
    `next_page`, `next_line`, where the next one stands. Between pages only
    their first and last lines are ordered, one row a page."""
    page = Window.partitionBy("doc_id", "page_num").orderBy("line_idx")
    ends = text.groupBy("doc_id", "page_num").agg(
        F.min_by(F.struct("text", "line_idx"), "line_idx").alias("first"), F.max_by("text", "line_idx").alias("last")
    )
    pages = Window.partitionBy("doc_id").orderBy("page_num")
    ends = ends.select(
        "doc_id", "page_num", F.lead(F.struct(F.col("page_num").alias("p"), "first.text", "first.line_idx")).over(pages).alias("__after"), F.lag("last").over(pages).alias("__before")
    )
    df = text.withColumn("__lead", F.lead(F.struct(F.col("page_num").alias("p"), "text", "line_idx")).over(page)).withColumn("__lag", F.lag("text").over(page))
    df = df.join(ends, ["doc_id", "page_num"], "left").withColumn("__next", F.coalesce("__lead", "__after"))
    return df.select(
        *text.columns, F.col("__next.text").alias("following"), F.coalesce("__lag", "__before").alias("preceding"), F.col("__next.p").alias("next_page"), F.col("__next.line_idx").alias("next_line")
    )


def core(word: Column) -> Column:
    """A word without the punctuation around it, in lower case."""
    return F.lower(F.regexp_replace(word, _WORD, ""))


def halves(df: DataFrame) -> DataFrame:
    """Of lines ending in a mark of a break: the halves `a` and `b` of the
    word, for lines with text after the mark's line."""
    marks = "[" + BREAKS.replace("-", r"\-") + "]"
    return df.withColumn("a", F.regexp_extract("text", rf"(\S*\p{{L}}){marks}\s*$", 1)).withColumn(
        "b", F.regexp_extract(F.coalesce("following", F.lit("")), r"^\s*(\S+)", 1)
    )


def vocabulary(text: DataFrame) -> DataFrame:
    """word, n: words that stand within lines, counted over all text lines.
    The last word of a line that ends in a break's mark and the first word of
    the line after it are left out."""
    marks = "[" + BREAKS.replace("-", r"\-") + "]"
    cut = F.coalesce(F.col("preceding").rlike(rf"\p{{L}}{marks}\s*$"), F.lit(False))
    whole = F.regexp_replace("text", rf"\S*\p{{L}}{marks}\s*$", "")
    whole = F.when(cut, F.regexp_replace(whole, r"^\s*\S+", "")).otherwise(whole)
    words = text.select(F.explode(F.split(whole, r"\s+")).alias("w")).select(core(F.col("w")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def anagram(word: Column) -> Column:
    """The sum of the fifth powers of the letters' numbers: equal for anagrams."""
    letters = F.transform(F.split(word, ""), lambda c: F.pow(F.least(F.ascii(c), F.lit(800)).cast("double"), F.lit(5.0)).cast("long"))
    return F.aggregate(letters, F.lit(0).cast("long"), lambda s, x: s + x)


def _value(text: str) -> int:
    return sum(min(ord(c), 800) ** 5 for c in text)


def skeleton(word: Column) -> Column:
    """The word with every confusable reading reduced to one form."""
    for printed, read in sorted(CONFUSIONS, key=lambda p: -len(p[1])):
        word = F.replace(word, F.lit(read), F.lit(printed))
    for printed, read in (("e", "c"), ("l", "i"), ("d", "cl")):
        word = F.replace(word, F.lit(read), F.lit(printed))
    return word


def corrections(words: DataFrame) -> DataFrame:
    """word, right, n, n_right: the most frequent variant of each rare word
    that differs from it by one or two confusions.

    A rare word is looked up among the frequent words once for each difference
    of hashes that one or two of the confusions found in it make.
    """
    hashed = words.where(F.length("word") >= 2).withColumn("hash", anagram(F.col("word")))
    frequent = hashed.where(F.col("n") >= FREQUENT).where(F.col("word").rlike(r"^[\p{L}\-]{3,}$"))
    frequent = frequent.select(F.col("hash").alias("target"), F.col("word").alias("right"), F.col("n").alias("n_right"))
    known = F.array(*[
        F.struct(F.lit(read).alias("read"), F.lit(_value(printed) - _value(read)).alias("difference")) for printed, read in CONFUSIONS
    ])
    apt = F.transform(F.filter(known, lambda c: F.contains(F.col("word"), c["read"])), lambda c: c["difference"])
    two = F.flatten(F.transform("apt", lambda x: F.transform("apt", lambda y: F.struct((x + y).alias("d"), F.lit(2).alias("steps")))))
    one = F.transform("apt", lambda x: F.struct(x.alias("d"), F.lit(1).alias("steps")))
    tried = hashed.withColumn("apt", apt).withColumn("t", F.explode(F.array_distinct(F.concat(one, two))))
    tried = tried.select("word", "n", (F.col("hash") + F.col("t.d")).alias("target"), F.col("t.steps").alias("steps"))
    met = tried.join(frequent, "target").where(F.col("n_right") >= RATIO * F.col("n"))
    met = met.where(skeleton(F.col("word")) == skeleton(F.col("right"))).where(F.col("word") != F.col("right"))
    return met.groupBy("word").agg(
        F.max_by(F.struct("right", "n_right"), F.struct(-F.col("steps"), "n_right", "right")).alias("best"), F.first("n").alias("n")
    ).select("word", "best.right", "n", "best.n_right")


def misread_form(word: Column) -> Column:
    """Signs within a word that no clean word has."""
    return (
        word.rlike(r"\p{L}.*[@■^~|\\]|[@■^~|\\].*\p{L}|\p{L}[*!]\p{L}")
        | word.rlike(r"\p{Ll}I\p{Ll}")
        | (word.rlike(r"\p{L}\d|\d\p{L}") & ~word.rlike(r"^\d+[-.]?\p{L}{1,3}$|^\p{L}-?\d+$"))
    )


def torn(text: Column) -> Column:
    """Whether letters of a word stand apart."""
    return text.rlike(r"(^|\s)(\p{L}\s){3}\p{L}(?!\p{L})")


def broken(df: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, page_num, line_idx, joined: lines ending within a word that
    only the line's end divides.

    The word has a hyphen of its own if the form with it stands within lines
    more often than the form without, or if the first half stands so within
    lines, nothing stands for the form without, and a frequent word follows (as
    in a pair sharing its last part).
    """
    cut = halves(df).where("a <> '' and b <> ''").where(F.col("b").rlike(r"^\p{Ll}|^[\p{P}\p{S}\d]*\p{Ll}") | F.col("a").rlike(r"^\p{Lu}{2,}$"))
    cut = cut.withColumn("joined", core(F.concat("a", "b"))).withColumn("own", core(F.concat_ws("-", "a", "b")))
    cut = cut.withColumn("half", F.concat(core(F.col("a")), F.lit("-")))
    cut = cut.withColumn("next", core(F.col("b")))
    asked = cut.select(F.explode(F.array("joined", "own", "half", "next")).alias("word")).distinct()
    known = words_with_hyphens(df).unionByName(words).groupBy("word").agg(F.sum("n").alias("n"))
    known = asked.join(known, "word")
    for c in ("joined", "own", "half", "next"):
        cut = cut.join(known.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}")), c, "left")
    n = lambda c: F.coalesce(F.col(f"n_{c}"), F.lit(0))
    own = (n("own") > n("joined")) | ((n("half") > 0) & (n("joined") == 0) & (n("next") >= FREQUENT))
    return cut.where(~own).select("doc_id", "page_num", "line_idx", "joined", "a", "b")


def cut_forms(cut: DataFrame, words: DataFrame) -> DataFrame:
    """word, n: cut words that stand whole nowhere, as rare words."""
    forms = cut.where("joined <> ''").groupBy(F.col("joined").alias("word")).agg(F.count("*").alias("n"))
    return forms.join(words.select("word"), "word", "left_anti").select("word", F.least("n", F.lit(FREQUENT - 1)).alias("n"))


def words_with_hyphens(text: DataFrame) -> DataFrame:
    """First halves of paired words (as in `pre- and post-`), which keep their
    hyphen when standing within a line; word, n."""
    words = text.select(F.explode(F.split(F.regexp_replace("text", r"\S+\s*$", ""), r"\s+")).alias("w"))
    halves = words.where(F.col("w").rlike(r"^\p{L}+-$"))
    return halves.groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))


def tokens(df: DataFrame, cut: DataFrame) -> DataFrame:
    """doc_id, page_num, line_idx, pos, raw, word: words of text lines. A word
    cut by the line's end stands whole on both lines, with its halves."""
    line = ["doc_id", "page_num", "line_idx"]
    words = df.select(*line, F.posexplode(F.split(F.trim("text"), r"\s+")).alias("pos", "raw"))
    return words.select(*line, "pos", "raw", core(F.col("raw")).alias("word"))


def analysed(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(classified lines, text lines with neighbours, corrections, broken)."""
    marked = classified(deduplicated(lines)).select("doc_id", "page_num", "line_idx", "text", "kind", "starts")
    marked = checkpointed(marked)  # read many times below
    text = checkpointed(with_next(marked.where("kind = 'text'").select("doc_id", "page_num", "line_idx", "text", "starts")))
    words = checkpointed(vocabulary(text))
    cut = checkpointed(broken(text, words))
    return marked, text, checkpointed(corrections(words.unionByName(cut_forms(cut, words)))), cut


def defects(lines: DataFrame) -> DataFrame:
    """doc_id, page_num, line_idx, defect (furniture, hyphen, glyph), one row
    per line and defect; a null text has none but furniture."""
    line = ["doc_id", "page_num", "line_idx"]
    marked, text, right, cut = analysed(lines)
    furniture = marked.where("kind = 'furniture'").select(*line, F.lit("furniture").alias("defect"))
    hyphen = cut.select(*line, F.lit("hyphen").alias("defect"))
    words = tokens(text, cut)
    shapes = words.where(misread_form(F.col("raw"))).select(*line)
    # whole words; then both halves of cut words, each on its own line
    whole = words.join(right.select("word", "right"), "word").select(*line)
    fixed = cut.join(right.select(F.col("word").alias("joined"), "right"), "joined")
    at = F.length(F.regexp_replace("a", _WORD, ""))
    same = F.lower(F.left("joined", at)) == F.left("right", at)
    first = fixed.where(~same).select(*line)
    rest = F.substring(F.col("joined"), at + 1, F.length("joined"))
    second_bad = ~F.endswith(F.col("right"), rest)
    place = text.select(*line, "next_page", "next_line")
    second = fixed.where(second_bad).join(place, line).where("next_line is not null").select("doc_id", F.col("next_page").alias("page_num"), F.col("next_line").alias("line_idx"))
    apart = text.where(torn(F.col("text"))).select(*line)
    glyph = shapes.unionByName(whole).unionByName(first).unionByName(second).unionByName(apart).distinct()
    return furniture.unionByName(hyphen).unionByName(glyph.select(*line, F.lit("glyph").alias("defect")))


def paragraphs(lines: DataFrame, block: int = 256) -> DataFrame:
    """doc_id, page_num, line_idx (where the paragraph begins), part, text:
    continuous paragraphs with broken words joined and misread words restored.
    Asides stand alone. A paragraph over more than `block` pages comes in
    parts, so that no task gathers an unbounded text."""
    line = ["doc_id", "page_num", "line_idx"]
    marked, text, right, cut = analysed(lines)
    asides = marked.where("kind = 'aside'").select(*line, "text", "starts")
    flow = text.select(*line, "text", "starts").unionByName(asides)
    joined_letters = F.regexp_replace("text", r"(?<!\S)(\p{L})\s(?=\p{L}(\s|$|[\p{P}]))", "$1")
    clean = flow.withColumn("text", F.when(torn(F.col("text")), joined_letters).otherwise(F.col("text")))
    words = clean.select(*line, "starts", F.posexplode(F.split(F.trim("text"), r"\s+")).alias("pos", "raw"))
    words = words.withColumn("word", core(F.col("raw"))).join(right.select("word", "right"), "word", "left")
    start = F.expr("substring(raw, 1, 1)")
    cased = F.when(F.lower(start) != start, F.concat(F.upper(F.left("right", F.lit(1))), F.expr("substring(right, 2)"))).otherwise(F.col("right"))
    bare = F.regexp_replace("raw", _WORD, "")
    words = words.withColumn("raw", F.when(F.col("right").isNotNull(), F.replace(F.col("raw"), bare, cased)).otherwise(F.col("raw")))
    rows = words.groupBy(*line, "starts").agg(F.array_sort(F.collect_list(F.struct("pos", "raw"))).alias("w"))
    rows = rows.select(*line, "starts", F.concat_ws(" ", F.transform("w", lambda w: w["raw"])).alias("text"))
    marks = "[" + BREAKS.replace("-", r"\-") + "]"
    rows = rows.join(cut.select(*line, F.lit(True).alias("cut")), line, "left")
    rows = rows.withColumn("text", F.when(F.col("cut"), F.regexp_replace("text", rf"{marks}\s*$", "\u0001")).when(
        F.col("text").rlike(r"\p{L}-$"), F.concat("text", F.lit("\u0001"))).otherwise(F.col("text")))
    mark = F.when(F.col("starts"), F.struct("page_num", "line_idx"))
    rows = carry_last(rows, "doc_id", "page_num", ["line_idx"], mark, "para")
    parts = rows.withColumn("part", F.floor(F.col("page_num") / block) - F.floor(F.coalesce(F.col("para.page_num"), F.lit(0)) / block))
    out = parts.groupBy("doc_id", "para", "part").agg(F.array_sort(F.collect_list(F.struct("page_num", "line_idx", "text"))).alias("t"))
    joined = F.replace(F.concat_ws(" ", F.transform("t", lambda t: t["text"])), F.lit("\u0001 "), F.lit(""))
    return out.select("doc_id", F.coalesce("para.page_num", F.lit(0)).alias("page_num"), F.coalesce("para.line_idx", F.lit(0)).alias("line_idx"), "part", F.replace(joined, F.lit("\u0001"), F.lit("")).alias("text"))
