"""Footnote marks and definitions of lines, found and linked by windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import holds
from . import layout

LINE = ["doc_id", "page_num", "line_idx"]


def line_box(runs: Column) -> Column:
    """x0, x1, baseline, bold, italic of a line's runs: the widest extent, the y
    of the first run of the commonest size, and whether all are bold or italic."""
    solid = F.filter(runs, lambda r: F.trim(r["text"]) != "")
    sizes = F.transform(solid, lambda r: F.round(r["font_size"], 2))
    mode = F.reduce(F.array_distinct(sizes), F.struct(F.lit(0).alias("n"), F.lit(None).cast("double").alias("s")), lambda a, s: F.when(
        F.size(F.filter(sizes, lambda x: x == s)) > a["n"], F.struct(F.size(F.filter(sizes, lambda x: x == s)).alias("n"), s.alias("s"))).otherwise(a))["s"]
    base = F.filter(solid, lambda r: F.abs(r["font_size"] - mode) < 0.05)
    font = lambda r: F.lower(F.coalesce(r["font_name"], F.lit("")))
    every = lambda word: (F.size(runs) > 0) & F.forall(runs, lambda r: font(r).contains(word))
    return F.struct(F.array_min(F.transform(runs, lambda r: r["x"])).alias("x0"), F.array_max(F.transform(runs, lambda r: r["x"])).alias("x1"), F.try_element_at(base, F.lit(1))["y"].alias("baseline"), holds(every("bold")).alias("bold"), holds(every("italic")).alias("italic"))


def exploded_runs(lines: DataFrame, body: DataFrame) -> DataFrame:
    """One row per run with its place in the line (i, from 0) and the body size."""
    runs = lines.select(*LINE, "page_height", F.posexplode("runs").alias("i", "r")).select(*LINE, "page_height", "i", "r.text", F.col("r.x").alias("x"), F.col("r.y").alias("y"), "r.font_size")
    return runs.join(body, "doc_id", "left").withColumn("body", F.coalesce("body", F.lit(10.0)))


def marks(runs: DataFrame) -> DataFrame:
    """Marks: neighbouring runs of small figures (two points below the body at
    least) as one number, with i (of the first), last (of the last), raised
    (above the longest body run of letters at most two runs away, by 0.75 or a
    fifth of the difference in size), percent (a slash or percent sign beside
    it), starts (nothing but eight signs without letters before it on the line)
    and tail (letters of small runs after it)."""
    line = Window.partitionBy(*LINE).orderBy("i")
    small = holds((F.col("font_size") <= F.col("body") - 2.0) & F.trim("text").rlike(r"^\d+$"))
    df = runs.withColumn("small", small)
    near = F.collect_list(F.struct("i", "text", "y", "font_size", "body", "small")).over(line.rowsBetween(-3, 3))
    before = F.coalesce(F.array_join(F.collect_list("text").over(line.rowsBetween(Window.unboundedPreceding, -1)), ""), F.lit(""))
    after = F.coalesce(F.array_join(F.collect_list("text").over(line.rowsBetween(1, Window.unboundedFollowing)), ""), F.lit(""))
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]", ""))
    tail = F.sum(F.when(holds(F.col("font_size") <= F.col("body") - 1.0), letters).otherwise(0)).over(line.rowsBetween(1, Window.unboundedFollowing))
    df = df.withColumns({"near": near, "before": before, "after": after, "tail": F.coalesce(tail, F.lit(0))})
    df = layout.islands(df, LINE, ["i"], ["small"]).where("small")
    listed = F.array_sort(F.collect_list(F.struct("i", F.trim("text").alias("t"))))
    out = df.groupBy(*LINE, "island").agg(
        F.min("i").alias("i"), F.max("i").alias("last"), F.array_join(F.transform(listed, lambda r: r["t"]), "").alias("number"), F.min_by("y", "i").alias("y"), F.min_by("font_size", "i").alias("font_size"),
        F.min("page_height").alias("page_height"), F.min_by("near", "i").alias("left"), F.max_by("near", "i").alias("right"), F.min_by("before", "i").alias("before"), F.max_by("after", "i").alias("after"), F.max_by("tail", "i").alias("tail"),
    )
    around = F.filter(F.concat("left", "right"), lambda r: ~r["small"] & (r["i"] >= F.col("i") - 2) & (r["i"] <= F.col("last") + 2) & (F.abs(r["font_size"] - r["body"]) <= 1.6) & r["text"].rlike(r"\p{L}"))
    base = F.array_max(F.transform(around, lambda r: F.struct(F.length(r["text"]).alias("n"), (-r["i"]).alias("i"), r["y"].alias("y"), r["font_size"].alias("s"))))
    raised = holds(F.col("y") - base["y"] >= F.greatest(F.lit(0.75), (base["s"] - F.col("font_size")) * 0.2))
    percent = F.rtrim("before").rlike("[/%]$") | F.ltrim("after").rlike("^[/%]")
    lead = F.trim("before")
    starts = (F.col("i") == 0) | ((F.length(lead) > 0) & (F.length(lead) <= 8) & ~lead.rlike(r"\p{L}"))
    return out.select(*LINE, "i", "last", "number", "y", "page_height", raised.alias("raised"), percent.alias("percent"), starts.alias("starts"), "tail")


def definitions_and_references(found: DataFrame, low: float = 0.02, high: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """(definitions, references) of marks. A definition begins a line near the
    page's foot with four small letters at least after it. Its number is
    plausible up to 99; a greater one if a reference on the page has it or the
    definition before it on the page has the number before. All else that is
    raised and no percentage is a reference."""
    place = F.col("y") / F.col("page_height")
    could = holds(F.col("starts") & ~F.col("percent") & place.between(low, high) & (F.col("tail") >= 4))
    df = found.withColumn("could", could).withColumn("value", F.col("number").try_cast("long"))
    named = df.where("not could and raised and not percent").groupBy("doc_id", "page_num", "number").agg(F.lit(True).alias("named"))
    page = Window.partitionBy("doc_id", "page_num").orderBy("line_idx", "i")
    can = df.where("could").join(named, ["doc_id", "page_num", "number"], "left")
    can = can.withColumn("follows", holds(F.lag("value").over(page) == F.col("value") - 1))
    # a run of numbers each one more than the last stands or falls with its first
    can = can.withColumn("head", F.sum(F.when(F.col("follows"), 0).otherwise(1)).over(page))
    sound = holds((F.col("value") <= 99) | F.col("named"))
    so_far = F.max(F.when(sound, 1).otherwise(0)).over(Window.partitionBy("doc_id", "page_num", "head").orderBy("line_idx", "i").rowsBetween(Window.unboundedPreceding, 0))
    definitions = can.withColumn("ok", so_far == 1).where("ok").select(*LINE, "i", "last", "number")
    references = df.where("raised and not percent").join(definitions.select(*LINE, "i"), [*LINE, "i"], "left_anti").select(*LINE, "i", "last", "number")
    return definitions, references


def consumed_runs(runs: DataFrame, found: DataFrame) -> DataFrame:
    """Runs without the later ones of a mark, which its first stands for."""
    taken = found.where("last > i").select(*LINE, F.explode(F.sequence(F.col("i") + 1, F.col("last"))).alias("i"))
    return runs.join(taken, [*LINE, "i"], "left_anti")


def continuations(lines: DataFrame, definitions: DataFrame, high: float = 0.25) -> DataFrame:
    """LINE, number: lines of a page's foot after a definition, up to the next."""
    starts = definitions.groupBy(*LINE).agg(F.min_by("number", "i").alias("own"))
    page = Window.partitionBy("doc_id", "page_num").orderBy("line_idx").rowsBetween(Window.unboundedPreceding, -1)
    df = lines.join(starts, LINE, "left").withColumn("number", F.last("own", True).over(page))
    return df.where("own is null and number is not null").where(F.col("y") / F.col("page_height") <= high).select(*LINE, "number")
