"""Ordered rules: the first that matches wins.

Rules whose tests are columns compile to one CASE expression. Rules that act
on a stack of open elements run in the automaton of operators.structure; their
column tests are computed beforehand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.carry import carry_last

FALLBACK = "_else"


@dataclass(frozen=True)
class Rule:
    """A name, a test (a column, or FALLBACK) and what to do on a match:
    operations of the stack automaton, as (operation, arguments...)."""

    name: str
    test: Column | str
    actions: tuple[tuple, ...] = ()
    group: str | None = None


@dataclass
class RuleGroup:
    """Rules in order; names must differ. The last fallback is the one used."""

    rules: Sequence[Rule]
    guard: Callable[[Column], Column] = field(default=lambda text: F.coalesce(~text.isin("", "\n"), F.lit(False)))

    def __post_init__(self):
        names = [r.name for r in self.rules]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"rules named twice: {', '.join(twice)}")
        for r in self.rules:
            if not isinstance(r.test, Column) and r.test != FALLBACK:
                raise TypeError(f"rule {r.name}: a test is a column or {FALLBACK!r}")

    def first_match(self, text: Column, alignment: Column | None = None) -> Column:
        """The name of the first rule that holds; the fallback's, or null,
        without one. An empty text matches none. A null test is false."""
        arm, fallback = None, None
        for r in self.rules:
            if not isinstance(r.test, Column):
                fallback = r.name
                continue
            test = F.coalesce(r.test, F.lit(False))
            if r.group is not None and alignment is not None:
                test = test & (alignment == r.group)
            arm = F.when(test, r.name) if arm is None else arm.when(test, r.name)
        arm = F.lit(fallback) if arm is None else arm.otherwise(F.lit(fallback))
        return F.when(self.guard(text), arm)


def aligned(x: Column, width: Column) -> Column:
    """The group of a paragraph by the middle of its frame."""
    center = x + width / 2
    inside = lambda low, high: (center > low) & (center < high)
    return F.when(inside(4550, 6560), "center").when(inside(2500, 3660), "left").when(inside(7820, 8460), "right").otherwise("_else")


def rule_counts(df: DataFrame, by: list[str], rule: str) -> DataFrame:
    """by..., rule, n; unmatched rows count as UNMATCHED."""
    return df.groupBy(*by, F.coalesce(rule, F.lit("UNMATCHED")).alias("rule")).agg(F.count("*").alias("n"))


def carried(df: DataFrame, doc: str, block: str, order: list[str], opened: Column, name: str = "open_rule") -> DataFrame:
    """Add what is open at each row: the last thing opened, at or before it.
    Filled forward by blocks of rows (pages, say), not by documents."""
    return carry_last(df, doc, block, order, opened, name)


def samples(df: DataFrame, by: list[str], order: list[str], limit: int = 25) -> DataFrame:
    """The first rows of each group, with their number. A report of a bounded
    number per group, not a shortening of data."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("sample", F.row_number().over(w)).where(F.col("sample") <= limit)


def diagnostics(df: DataFrame, doc: str, keys: list[str]) -> DataFrame:
    """doc, key, value, n of several keys in one pass: each row is counted
    once for each key, before the shuffle."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]))
    return df.select(doc, pairs.alias("k")).groupBy(doc, "k.key", "k.value").agg(F.count("*").alias("n"))
