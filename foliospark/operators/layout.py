"""Reading order and layout: lines, runs, spaces, columns.

Ordered operators take explicit order columns; input order means nothing. All
windows are within a document or page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .carry import carry_last, carry_sum

BREAK = "absolute"


def text_lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """id, line_idx, text: lines of a text that aren't blank; the index counts
    blank ones too."""
    rows = docs.select(id, F.posexplode(F.split(text, "\n")).alias("line_idx", "text"))
    return rows.where(F.length(F.trim("text")) > 0)


def line_groups(
    df: DataFrame, by: list[str], order: list[str], y: str, tolerance: float, downward: bool = False, multiple: float = 5.0, name: str = "line_id",
) -> DataFrame:
    """Number lines from 0: a new one where y moves by more than the tolerance;
    downward: where it falls by more, or moves by `multiple` times as much."""
    w = Window.partitionBy(*by).orderBy(*order)
    delta = F.lag(y).over(w) - F.col(y)
    new = F.abs(delta) > tolerance
    if downward:
        new = (delta > tolerance) | (F.abs(delta) > tolerance * max(1.0, multiple))
    df = df.withColumn("__new", F.coalesce(new, F.lit(False)).cast("int"))
    return df.withColumn(name, F.sum("__new").over(w)).drop("__new")


def islands(df: DataFrame, by: list[str], order: list[str], same: list[str], name: str = "island", extra: Column | None = None) -> DataFrame:
    """Number runs of equal values from 0; `extra` starts a run as well."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = F.lit(False)
    for c in same:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.row_number().over(w) == 1
    change = (changed | F.coalesce(extra, F.lit(False)) if extra is not None else changed) & ~first
    df = df.withColumn("__new", change.cast("int"))
    return df.withColumn(name, F.sum("__new").over(w)).drop("__new")


def block_islands(df: DataFrame, doc: str, block: str, order: list[str], same: list[str], name: str = "island") -> DataFrame:
    """As islands, of one key column that may hold a third of all rows: by
    blocks of rows (a number that grows with the order), never by keys."""
    now = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(same)])
    df = carry_last(df, doc, block, order, now, "__before", before=True)
    changed = F.col("__before").isNotNull() & ~F.col("__before").eqNullSafe(now)
    return carry_sum(df, doc, block, order, changed.cast("int"), name).drop("__before")


def run_groups(df: DataFrame, by: list[str], order: list[str], font: str, size: str, x: str, max_gap: float | None = None) -> DataFrame:
    """Number runs: the same font and exactly the same size, and no jump in x."""
    w = Window.partitionBy(*by).orderBy(*order)
    jump = F.abs(F.col(x) - F.lag(x).over(w)) >= max_gap if max_gap is not None else None
    return islands(df, by, order, [font, size], "run_id", jump)


def spaced(df: DataFrame, by: list[str], order: list[str], x0: str, x1: str, threshold: float) -> DataFrame:
    """Add `space_before`: whether the gap to the one before is more than the threshold."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("space_before", F.coalesce(F.col(x0) - F.lag(x1).over(w) > threshold, F.lit(False)))


def joined_text(df: DataFrame, by: list[str], order: list[str], text: str, space: Column) -> DataFrame:
    """by..., text: pieces in order, with a space before those that want one."""
    piece = F.concat(F.when(space, " ").otherwise(""), F.col(text))
    listed = F.array_sort(F.collect_list(F.struct(*order, piece.alias("piece"))))
    return df.groupBy(*by).agg(F.array_join(F.transform(listed, lambda p: p["piece"]), "").alias("text"))


def pending_space(df: DataFrame, doc: str, page: str, order: list[str], broke: Column) -> DataFrame:
    """Add `space_before` of a segment's first run: unless the segment before
    it ended at a literal space; never for a document's first."""
    df = carry_last(df, doc, page, order, F.coalesce(broke, F.lit(False)), "__broke", before=True)
    return df.withColumn("space_before", F.coalesce(~F.col("__broke"), F.lit(False))).drop("__broke")


def dehyphenated(df: DataFrame, doc: str, page: str, order: list[str], text: str, out_of_flow: Column) -> DataFrame:
    """Add `text_joined` without a hyphen at the line's end, and
    `space_before`: not after a line in the flow that ended in one, nor for a
    document's first line. Lines out of the flow neither lose a hyphen nor
    matter to what follows. Filled forward by pages, not by documents."""
    ends = F.coalesce(F.rtrim(F.col(text)).rlike("[-‐‑]$"), F.lit(False)) & ~out_of_flow
    firsts = df.groupBy(doc).agg(F.min(F.struct(page, *order)).alias("__first"))
    df = carry_last(df.join(firsts, doc, "left"), doc, page, order, F.when(~out_of_flow, ends), "__hyphen", before=True)
    first = F.struct(page, *order).eqNullSafe(F.col("__first"))
    df = df.withColumn("space_before", F.when(first, False).otherwise(~F.coalesce("__hyphen", F.lit(False))))
    return df.withColumn("text_joined", F.when(ends, F.regexp_replace(F.rtrim(F.col(text)), "[-‐‑]$", "")).otherwise(F.col(text))).drop("__hyphen", "__first")


def column_edges(df: DataFrame, by: list[str], x: str, gap: Column, support: float = 3.0, least: int = 3, part: int = 20) -> DataFrame:
    """by..., cluster, edge, n: columns of a page, parted by gaps in x; the
    edge is the least x near which, within `support` to the right, enough of
    the cluster begins, or else the least x."""
    w = Window.partitionBy(*by).orderBy(x)
    df = df.withColumn("__gap", gap)
    new = F.coalesce(F.col(x) - F.lag(x).over(w) > F.col("__gap"), F.lit(False)).cast("int")
    df = df.withColumn("__new", new).withColumn("cluster", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    c = Window.partitionBy(*by, "cluster")
    keys = ", ".join(f"`{k}`" for k in [*by, "cluster"])
    near = f"count(*) OVER (PARTITION BY {keys} ORDER BY `{x}` RANGE BETWEEN CURRENT ROW AND {float(support)}D FOLLOWING)"
    df = df.withColumn("__near", F.expr(near)).withColumn("__n", F.count("*").over(c))
    enough = F.col("__near") >= F.greatest(F.lit(least), F.floor(F.col("__n") / part))
    return df.groupBy(*by, "cluster").agg(
        F.coalesce(F.min(F.when(enough, F.col(x))), F.min(x)).alias("edge"), F.count("*").alias("n")
    )


def nearest_column(x: Column, columns: Column, slack: float = 2.0) -> Column:
    """The rightmost column at most `slack` to the right of x; x itself if none."""
    return F.coalesce(F.array_max(F.filter(columns, lambda c: c <= x + slack)), x)


def column_distance(x: Column, columns: Column) -> Column:
    """The distance to the nearest column; null without columns."""
    return F.array_min(F.transform(columns, lambda c: F.abs(x - c)))


def anchor_clusters(df: DataFrame, by: list[str], value: str, id: str, tolerance: float) -> DataFrame:
    """by..., id, anchor: values in order; one more than the tolerance from
    the first of its cluster begins a new one. A fold over each group's sorted
    values, meant for the lines of a page."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col(id).alias("id"))))
    kind = dict(df.dtypes)[id]
    start = F.expr(f"named_struct('anchor', cast(null as double), 'rows', cast(array() as array<struct<id:{kind},anchor:double>>))")

    def step(s: Column, r: Column) -> Column:
        anchor = F.when(s["anchor"].isNull() | (F.abs(r["v"] - s["anchor"]) > tolerance), r["v"]).otherwise(s["anchor"])
        return F.struct(anchor.alias("anchor"), F.concat(s["rows"], F.array(F.struct(r["id"].alias("id"), anchor.alias("anchor")))).alias("rows"))

    folded = df.where(F.col(value).isNotNull()).groupBy(*by).agg(listed.alias("__l"))
    folded = folded.select(*by, F.explode(F.aggregate("__l", start, step)["rows"]).alias("r"))
    return folded.select(*by, F.col("r.id").alias(id), F.col("r.anchor").alias("anchor"))


def merged_runs(runs: Column, size_slack: float = 0.1, base_slack: float = 0.25) -> Column:
    """Runs (array of struct text, x, y, font_name, font_size, space_before)
    with neighbours of one font and nearly one size and baseline merged into
    the group's first run; a line's first run stands alone, and nothing is
    merged below three runs."""
    first = F.slice(runs, 1, 1)
    rest = F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0)))

    def step(acc: Column, r: Column) -> Column:
        last = F.element_at(acc, -1)
        near = (
            (F.size(acc) > 1) & last["font_name"].eqNullSafe(r["font_name"])
            & (F.abs(last["font_size"] - r["font_size"]) <= size_slack) & (F.abs(last["y"] - r["y"]) <= base_slack)
        )
        text = F.concat(last["text"], F.when(r["space_before"], " ").otherwise(""), r["text"])
        joined = F.struct(text.alias("text"), *[last[c].alias(c) for c in ("x", "y", "font_name", "font_size", "space_before")])
        return F.when(F.coalesce(near, F.lit(False)), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(r)))

    return F.when(F.size(runs) < 3, runs).otherwise(F.aggregate(rest, first, step))


def previous_in_flow(df: DataFrame, doc: str, block: str, order: list[str], value: str, out_of_flow: Column, name: str = "previous") -> DataFrame:
    """Add the value of the row before that is in the flow; filled forward by
    blocks of rows (a number that grows with the order), not by documents."""
    return carry_last(df, doc, block, order, F.when(~out_of_flow, F.col(value)), name, before=True)


def take_while(df: DataFrame, by: list[str], order: list[str], stop: Column) -> DataFrame:
    """The rows before the first that stops its document: the first stop is a
    minimum, aggregated before the shuffle, so that no document is sorted.
    Rows of equal order with the first stop are past it."""
    first = df.where(F.coalesce(stop, F.lit(False))).groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.min(F.struct(*order)).alias("__stop"))
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    return df.join(first, on, "left").where(F.col("__stop").isNull() | (F.struct(*order) < F.col("__stop"))).select(*df.columns)


def page_ranges(start: Column, end: Column, workers: int) -> Column:
    """Pages [start, end) as at most `workers` runs whose sizes differ by one
    at most, each a struct of start and end."""
    n = F.greatest(end - start, F.lit(0))
    parts = F.least(F.lit(workers).cast("long"), n.cast("long"))
    cut = lambda i: start + F.floor(n / parts) * i + F.least(i, n % parts)
    runs = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: F.struct(cut(i).cast("long").alias("start"), cut(i + 1).cast("long").alias("end")))
    return F.when(parts > 0, runs).otherwise(F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"))


def in_range(page: Column, start: int, end: int | None) -> Column:
    return (page >= start) & (page < end) if end is not None else page >= start


def band_semi_join(df: DataFrame, by: list[str], id: str, y: str, x: str, width: Column, slack: float = 2.5, share: float = 0.15) -> DataFrame:
    """Rows with another row of their page on the same level, at most `slack`
    apart in y, that begins `share` of the width further right. Levels are
    bucketed, so that the join is by equality with three buckets."""
    other = df.select(*[F.col(c).alias(f"__{c}") for c in by], F.col(y).alias("__y"), F.col(x).alias("__x"), F.col(id).alias("__id"), F.floor(F.col(y) / slack).alias("__b"))
    near = df.withColumn("__w", width).withColumn("__bucket", F.explode(F.array(*[F.floor(F.col(y) / slack) + d for d in (-1, 0, 1)])))
    on = [F.col(c) == F.col(f"__{c}") for c in by] + [
        F.col("__bucket") == F.col("__b"), F.abs(F.col(y) - F.col("__y")) <= slack, F.col("__x") >= F.col(x) + share * F.col("__w"), F.col(id) != F.col("__id"),
    ]
    return near.join(other, on, "left_semi").drop("__w", "__bucket").dropDuplicates([*by, id])


def peer_semi_join(df: DataFrame, by: list[str], id: str, key: Column, x: str, slack: float) -> DataFrame:
    """Rows with another row of the same page and key, at most `slack` apart
    in x: the nearest neighbours in x decide, so that no pair is emitted."""
    w = Window.partitionBy(*by, "__key").orderBy(x, id)
    df = df.withColumn("__key", key)
    near = F.least(F.col(x) - F.lag(x).over(w), F.lead(x).over(w) - F.col(x)) <= slack
    return df.withColumn("__near", F.coalesce(near, F.lit(False))).where("__near and __key is not null").drop("__key", "__near")


def word_lines(words: DataFrame, by: list[str], order: str, top: str, size: str, tolerance: float = 3.2, least: float = 9.0) -> DataFrame:
    """by..., order, line: words in reading order gathered into lines. A word
    further than the tolerance from the line's anchor begins a line; the
    anchor is the top of the line's first word and moves with words of at
    least the given size. A fold over the words of a page."""
    kind = dict(words.dtypes)[order]
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(top).cast("double").alias("t"), F.col(size).cast("double").alias("s"))))
    start = F.expr(f"named_struct('anchor', cast(null as double), 'line', -1, 'rows', cast(array() as array<struct<o:{kind},line:int>>))")

    def step(a: Column, w: Column) -> Column:
        new = a["anchor"].isNull() | (F.abs(w["t"] - a["anchor"]) > tolerance)
        line = F.when(new, a["line"] + 1).otherwise(a["line"])
        anchor = F.when(new | (w["s"] >= least), w["t"]).otherwise(a["anchor"])
        return F.struct(anchor.alias("anchor"), line.alias("line"), F.concat(a["rows"], F.array(F.struct(w["o"].alias("o"), line.alias("line")))).alias("rows"))

    folded = words.where(F.col(top).isNotNull()).groupBy(*by).agg(listed.alias("__w"))
    return folded.select(*by, F.explode(F.aggregate("__w", start, step)["rows"]).alias("r")).select(*by, F.col("r.o").alias(order), F.col("r.line").alias("line"))


def numeric_groups(runs: DataFrame, by: list[str], order: str, text: str, small: Column) -> DataFrame:
    """by..., order (of the first run), number: neighbouring runs of small
    figures read as one number, as where a mark is split into its digits."""
    df = islands(runs.withColumn("__digit", F.coalesce(small & F.trim(F.col(text)).rlike(r"^\d+$"), F.lit(False))), by, [order], ["__digit"])
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim(F.col(text)).alias("t"))))
    groups = df.where("__digit").groupBy(*by, "island").agg(F.min(order).alias(order), F.array_join(F.transform(listed, lambda r: r["t"]), "").alias("number"))
    return groups.drop("island")
