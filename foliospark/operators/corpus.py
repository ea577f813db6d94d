"""Corpora: jobs, increments, trees of folders, totals, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("ok", "recovered", "failed", "skipped")


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in order: by a minimum, not a window, so
    that a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*key).agg(first.alias("__r")).select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def ordered_unique(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """by..., value, ord: distinct values numbered as first met."""
    firsts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.min(order).alias("__first"))
    return firsts.withColumn("ord", F.row_number().over(Window.partitionBy(*by).orderBy("__first", value))).drop("__first")


def fingerprint(*columns: Column) -> Column:
    """One hash of everything a result depends on."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]), 256)


def pending(jobs: DataFrame, done: DataFrame, key: str = "source", finished: tuple[str, ...] = ("ok", "recovered"), written: str | None = None) -> DataFrame:
    """Jobs that no finished job with the same fingerprint has done; `written`
    names a column of done that tells whether its outputs are there."""
    have = done.where(F.col("status").isin(*finished))
    have = (have.where(F.col(written)) if written else have).select(key, "fingerprint").distinct()
    return jobs.join(have, [key, "fingerprint"], "left_anti")


def stale(candidates: DataFrame, desired: DataFrame, protected: DataFrame, key: str) -> DataFrame:
    """Artifacts that are neither wanted nor protected."""
    kept = desired.select(key).unionByName(protected.select(key)).distinct()
    return candidates.join(kept, key, "left_anti")


def ancestors(path: Column, root: bool = False) -> Column:
    """All folders above and at a path, from the top; with the root as ''."""
    parts = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda p: p != "")
    n = F.size(parts)
    below = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.expr("cast(array() as array<int>)")), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return F.concat(F.array(F.lit("")), below) if root else below


def folder_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def rollup(documents: DataFrame, path: str, measures: list[str], root: bool = True) -> DataFrame:
    """folder, depth, texts and sums of measures over each folder's subtree.
    Folders are summed first, so that ancestors are spread per folder, not
    per document."""
    own = documents.groupBy(folder_of(F.col(path)).alias("own")).agg(F.count("*").alias("texts"), *[F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in measures])
    spread = own.withColumn("folder", F.explode(ancestors(F.col("own"), root)))
    sums = spread.groupBy("folder").agg(F.sum("texts").alias("texts"), *[F.sum(m).alias(m) for m in measures])
    depth = F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/")))
    return sums.withColumn("depth", depth)


def folder_tree(documents: DataFrame, path: str) -> DataFrame:
    """folder, parent, depth, n_children: every folder, also those without
    documents of their own."""
    folders = documents.select(F.explode(ancestors(folder_of(F.col(path)))).alias("folder")).distinct()
    folders = folders.withColumn("parent", folder_of(F.col("folder"))).withColumn("depth", F.size(F.split("folder", "/")))
    children = folders.groupBy(F.col("parent").alias("folder")).agg(F.count("*").alias("n_children"))
    return folders.join(children, "folder", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def manifest(items: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """by..., a count of every status (0 where none) and the total."""
    counts = [F.count_if(F.col(status) == s).alias(s) for s in STATUSES]
    return items.groupBy(*by).agg(*counts, F.count("*").alias("total"))


def includes(documents: DataFrame, owner: str, path: str, order: Column) -> DataFrame:
    """owner, n, body: the inclusions of a corpus file, ordered."""
    href = F.concat(F.lit('<xi:include href="'), F.col(path), F.lit('"/>'))
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), href.alias("h"))))
    return documents.groupBy(owner).agg(F.count("*").alias("n"), F.array_join(F.transform(listed, lambda r: r["h"]), "\n").alias("body"))


def meeting_label(labels: Column) -> Column:
    """The last label that names a term or meeting."""
    named = F.filter(labels, lambda x: F.lower(x).rlike("sklic|mandat|zasedanj|sej|sednic|sjednic|session"))
    return F.try_element_at(named, F.lit(-1))


def meeting_number(label: Column) -> Column:
    return F.nullif(F.regexp_extract(label, r"^\s*(\d+)", 1), F.lit(""))


def extent_header(totals: DataFrame, key: str, measures: dict[str, str], always: tuple[str, ...] = ("texts",)) -> DataFrame:
    """key, header: the extent of a corpus file, one measure for each column
    (unit by column); measures of nothing are left out unless always given."""
    parts = []
    for column, unit in measures.items():
        value = F.coalesce(F.col(column), F.lit(0))
        part = F.concat(F.lit(f'<measure unit="{unit}" quantity="'), value.cast("string"), F.lit('"/>'))
        parts.append(part if column in always else F.when(value != 0, part))
    body = F.array_join(F.array_compact(F.array(*parts)), "")
    return totals.select(key, F.concat(F.lit("<extent>"), body, F.lit("</extent>")).alias("header"))


def localized(df: DataFrame, key: str, tag: str, texts: Column) -> DataFrame:
    """key, xml: one element for each language of a map of texts, ordered."""
    pairs = F.array_sort(F.map_entries(texts))
    escaped = lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    one = lambda p: F.concat(F.lit(f'<{tag} xml:lang="'), p["key"], F.lit('">'), escaped(p["value"]), F.lit(f"</{tag}>"))
    return df.select(key, F.coalesce(F.array_join(F.transform(pairs, one), ""), F.lit("")).alias("xml"))
