"""Forward filling without putting a whole document into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pages per block of the middle level.
PAGES_PER_BLOCK = 256


def carry_last(
    df: DataFrame, doc: str, page: str, order: list[str], value: Column, name: str, block: int = PAGES_PER_BLOCK,
    before: bool = False,
) -> DataFrame:
    """Add `name`: the last non-null `value` at or before each row (`before`:
    only before it), by page and then `order`, within a document.

    A prefix scan on three levels - rows within a page, pages within a block,
    blocks within a document - so that no window holds more than one page, one
    block of pages, or one row per block. Rows before any value get null. Page
    numbers may be null (such rows form one page, first in order).
    """
    p, b = "__page", "__block"
    df = df.withColumn(p, F.coalesce(F.col(page), F.lit(-1))).withColumn(b, F.floor(F.col(p) / block))
    df = df.withColumn("__value", value)
    at = F.when(F.col("__value").isNotNull(), F.struct(*order, F.col("__value").alias("v")))
    pages = df.groupBy(doc, b, p).agg(F.max(at)["v"].alias("__last"))
    earlier = Window.partitionBy(doc, b).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.withColumn("__in_block", F.last("__last", True).over(earlier))
    blocks = pages.groupBy(doc, b).agg(
        F.max(F.when(F.col("__last").isNotNull(), F.struct(p, F.col("__last").alias("v"))))["v"].alias("__last")
    )
    over = Window.partitionBy(doc).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col(doc).alias("__bd"), F.col(b).alias("__bb"), F.last("__last", True).over(over).alias("__before_block"))
    carried = pages.join(blocks, F.col(doc).eqNullSafe(F.col("__bd")) & (F.col(b) == F.col("__bb")), "left").select(
        F.col(doc).alias("__d"), F.col(p).alias("__p"), F.coalesce("__in_block", "__before_block").alias("__carried")
    )
    joined = df.join(carried, F.col(doc).eqNullSafe(F.col("__d")) & (F.col(p) == F.col("__p")), "left")
    here = Window.partitionBy(doc, p).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    return joined.withColumn(name, F.coalesce(F.last("__value", True).over(here), F.col("__carried"))).drop(
        p, b, "__value", "__d", "__p", "__carried"
    )


def carry_sum(df: DataFrame, doc: str, page: str, order: list[str], value: Column, name: str, block: int = PAGES_PER_BLOCK) -> DataFrame:
    """Add `name`: the sum of `value` (null counts 0) up to and with each row,
    by page and then `order`, within a document; on three levels as carry_last."""
    p, b = "__page", "__block"
    df = df.withColumn(p, F.coalesce(F.col(page), F.lit(-1))).withColumn(b, F.floor(F.col(p) / block))
    df = df.withColumn("__value", F.coalesce(value, F.lit(0)).cast("long"))
    pages = df.groupBy(doc, b, p).agg(F.sum("__value").alias("__sum"))
    blocks = pages.groupBy(doc, b).agg(F.sum("__sum").alias("__sum"))
    over = Window.partitionBy(doc).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col(doc).alias("__bd"), F.col(b).alias("__bb"), F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    earlier = Window.partitionBy(doc, b).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.withColumn("__in_block", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    before = pages.join(blocks, F.col(doc).eqNullSafe(F.col("__bd")) & (F.col(b) == F.col("__bb")), "left").select(F.col(doc).alias("__d"), F.col(p).alias("__p"), (F.col("__in_block") + F.coalesce("__before", F.lit(0))).alias("__carried"))
    joined = df.join(before, F.col(doc).eqNullSafe(F.col("__d")) & (F.col(p) == F.col("__p")), "left")
    here = Window.partitionBy(doc, p).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn(name, F.sum("__value").over(here) + F.coalesce("__carried", F.lit(0))).drop(p, b, "__value", "__d", "__p", "__carried")
