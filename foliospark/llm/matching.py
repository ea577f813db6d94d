"""Entities of two sources matched without keys.

Both sources are reduced to entities (distinct persons). Entities are sorted by
several composite keys; within a window sliding along each order, pairs are
compared by weighted similarities of their fields; of the pairs that may match,
the one-to-one assignment with the highest total confidence is taken.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import names
from .common import stored

#: Entities that follow an entity within the window, of either source.
WINDOW = 12
#: Sorted entities per task of the sliding window.
BUCKET = 2048
#: Weights of the fields' similarities, and the least confidence of a match.
LAST, FIRST, BODY, YEARS = 0.4, 0.25, 0.25, 0.1
LEAST = 0.72

# Ways to write a date of a register.
_YEAR = r"(\d{4})"


def year(text: Column) -> Column:
    """The year of a date in any notation; null if there is none."""
    return F.try_to_number(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), _YEAR, 1), F.lit("")), F.lit("9999")).cast("int")


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """Add `rank`, the place of each row in order, by sorting in ranges; only
    the number of rows of each range comes to the driver."""
    part = df.repartitionByRange(*order).sortWithinPartitions(*order)
    part = part.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    part = stored(part)
    sizes = {r["__part"]: r["n"] for r in part.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    total, pairs = 0, []
    for p in sorted(sizes):
        pairs += [F.lit(p), F.lit(total)]
        total += sizes[p]
    start = F.create_map(*pairs)[F.col("__part")] if pairs else F.lit(0)
    out = part.withColumn("rank", start + F.col("__at")).drop("__part", "__at")
    out.stored_in = part.stored_in
    return out


def neighbours(entities: DataFrame, keys: list[Column], window: int = WINDOW, keep: Column | None = None) -> DataFrame:
    """left, right: ids of entities of different sides (0 and 1) at most
    `window` places apart by any of the keys. With `keep`, a value of columns
    of both sides (l_, r_), also this `confidence`, and only pairs of LEAST or
    more: these are few, so that a pair is judged where it meets and nothing
    is shuffled for the others. The orders are sorted one after the other.
    Buckets of places overlap by a window, so that no window is cut and none
    gathers more than a bucket."""
    fields = entities.columns if keep is not None else ["id", "side"]
    found = []
    for key in keys:
        placed = ranked(entities.select(*fields), [key, F.col("id")])
        at = F.floor(F.col("rank") / BUCKET)
        ahead = F.when((F.col("rank") % BUCKET < window) & (at > 0), F.array(at - 1, at)).otherwise(F.array(at))
        w = Window.partitionBy("bucket").orderBy("rank").rowsBetween(1, window)
        pairs = placed.withColumn("bucket", F.explode(ahead)).withColumn("near", F.collect_list(F.struct(*fields)).over(w))
        pairs = pairs.select(F.struct(*fields).alias("one"), F.explode("near").alias("other")).where("one.side <> other.side")
        turned = F.col("one.side") == 0
        pairs = pairs.select(F.when(turned, F.col("one")).otherwise(F.col("other")).alias("l"), F.when(turned, F.col("other")).otherwise(F.col("one")).alias("r"))
        out = [F.col("l.id").alias("left"), F.col("r.id").alias("right")]
        if keep is not None:
            pairs = pairs.select(*out, *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "lr" for c in fields]).withColumn("confidence", keep)
            pairs, out = pairs.where(F.col("confidence") >= LEAST), ["left", "right", "confidence"]
        found.append(stored(pairs.select(*out).distinct(), placed))
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return stored(every.distinct(), *found)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal texts, less by each letter off; the share of common words
    counts too, as one name may have a part more."""
    off = F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    wa, wb = F.split(a, " "), F.split(b, " ")
    common = F.size(F.array_intersect(wa, wb)) / F.greatest(F.least(F.size(wa), F.size(wb)), F.lit(1))
    return F.greatest(1 - off, F.when(common >= 1, F.lit(0.95)).otherwise(0.0))


def confidence() -> Column:
    """Of a pair with columns of both sides (l_, r_): the weighted similarity
    of its fields; 0 if bodies, or life years and dates, exclude each other."""
    same_first = F.when(F.col("l_first") == F.col("r_first"), 1.0).when(
        (F.length(F.least("l_first", "r_first")) <= 1) & (F.left("l_first", F.lit(1)) == F.left("r_first", F.lit(1))), 0.6
    ).when(F.levenshtein("l_first", "r_first") <= 1, 0.8).when(F.left("l_first", F.lit(3)) == F.left("r_first", F.lit(3)), 0.6).otherwise(0.0)
    last = likeness(F.col("l_last"), F.col("r_last"))
    unknown = (F.col("l_org") == "") | (F.col("r_org") == "")
    body = F.when(unknown, 0.5).when(F.col("l_org") == F.col("r_org"), 1.0).otherwise(0.0)
    years = F.when((F.col("l_until") < F.col("r_born")) | (F.col("l_from") > F.col("r_died")), 0.0).when(
        F.col("r_born").isNull() | F.col("l_from").isNull(), 0.7
    ).otherwise(1.0)
    value = LAST * last + FIRST * same_first + BODY * body + YEARS * years
    near = (F.levenshtein("l_last", "r_last") <= 2) | (last >= 0.95)
    return F.when((same_first > 0) & near & (body > 0) & (years > 0), value).otherwise(0.0)


def assign(left: np.ndarray, right: np.ndarray, value: np.ndarray) -> dict[int, int]:
    """Left to right with the highest total of positive values of the given
    pairs, by shortest augmenting paths over these pairs alone (a left one may
    stay single at value 0)."""
    edges: dict[int, dict[int, float]] = {}
    for i, j, x in zip(left.tolist(), right.tolist(), value.tolist()):
        if x > 0:
            edges.setdefault(i, {})[j] = max(x, edges.get(i, {}).get(j, 0.0))
    top = max((x for e in edges.values() for x in e.values()), default=0.0)
    pi, pj, to, back = dict.fromkeys(edges, 0.0), {}, {}, {}
    for start in edges:
        # staying single is a right one of its own, at value 0
        best, seen, came = {}, {}, {}
        heap: list = [(0.0, 0, start)]
        goal, end = None, np.inf
        while heap:
            d, side, n = heapq.heappop(heap)
            if d >= end:
                break
            if side == 0:
                if (single := d + top - pi[n]) < end:
                    goal, end = ("single", n), single
                for j, x in edges[n].items():
                    nd = d + (top - x) - pi[n] - pj.get(j, 0.0)
                    if j not in seen and nd < best.get(j, np.inf) - 1e-12:
                        best[j], came[j] = nd, n
                        heapq.heappush(heap, (nd, 1, j))
            elif n not in seen:
                seen[n] = d
                if n not in back:
                    goal, end = ("free", n), d
                    break
                heapq.heappush(heap, (d, 0, back[n]))
        reached = {start: 0.0} | {back[j]: d for j, d in seen.items() if j in back}
        for i, d in reached.items():
            pi[i] += end - d if d < end else 0.0
        for j, d in seen.items():
            if d < end:
                pj[j] = pj.get(j, 0.0) - (end - d)
        kind, n = goal
        i = came[n] if kind == "free" else n
        j = n if kind == "free" else to.pop(i, None)
        if kind == "single" and i == start:
            continue
        if kind == "single":
            i, j = came[j], j
        while True:
            before = to.get(i)
            to[i], back[j] = j, i
            if i == start:
                break
            i, j = came[before], before
    return to


def assigned(pairs: DataFrame) -> DataFrame:
    """left, right, confidence of the best one-to-one assignment of pairs, by
    connected components of candidates (few entities share a name)."""
    edges = pairs.select(F.col("left").alias("a"), F.col("right").alias("b"))
    parts = pairs.join(names.components(edges).withColumnRenamed("id", "left").withColumnRenamed("component", "part"), "left")

    def best(part: pd.DataFrame) -> pd.DataFrame:
        if len(part) > 1:
            part = part.sort_values(["left", "right"])
            to = assign(part["left"].to_numpy(), part["right"].to_numpy(), part["confidence"].to_numpy())
            part = part[[to.get(i) == j for i, j in zip(part["left"], part["right"])]]
        return part[["left", "right", "confidence"]]

    return names.by_part(parts.where("confidence > 0"), best, "left long, right long, confidence double")


def matches(speakers: DataFrame, register: DataFrame) -> DataFrame:
    """speaker_id, binding_id, confidence: rows of both that mean one person.

    Speakers are entities by name and body (see names.persons), bindings by
    name, party and year of birth. Repeated rows of an id count once; rows
    without a name match nothing; a missing body or date neither helps nor
    excludes; a speaker's row outside the life years isn't matched.
    """
    given = F.concat_ws(" ", "given_label", "family_label")
    full = F.when(F.col("given_label").isNotNull() & F.col("family_label").isNotNull(), given).otherwise(F.coalesce("p_label", "search_name"))
    register = register.withColumn("name", full)
    none = F.lit(None).cast("int")
    rows = speakers.groupBy("speaker_id").agg(F.min("session_date").alias("at"), F.min(F.struct("lookup_name", "organization")).alias("r"))
    rows = rows.select(F.concat(F.lit("s"), F.col("speaker_id").cast("string")).alias("row"), F.col("r.lookup_name").alias("name"), F.col("r.organization").alias("body"), F.year("at").alias("at"), none.alias("born"), none.alias("died"))
    others = register.groupBy("binding_id").agg(F.min(F.struct("name", "party_label")).alias("r"), F.min(year(F.col("birth"))).alias("born"), F.max(year(F.col("death"))).alias("died"))
    others = others.select(F.concat(F.lit("b"), F.col("binding_id").cast("string")).alias("row"), F.col("r.name").alias("name"), F.col("r.party_label").alias("body"), none.alias("at"), "born", "died")
    # spellings are learned from both sources; persons are linked within each
    both = names.linked(names.parsed(stored(rows.unionByName(others)), "name", "body"), "row", F.left("row", F.lit(1)))
    keyed = both.where("last <> ''").withColumn("key", F.expr("cast(substring(row, 2) as long)"))
    people = keyed.where("row like 's%'").withColumnRenamed("key", "speaker_id").drop("row", "born", "died")
    entries = keyed.where("row like 'b%'").withColumnRenamed("key", "binding_id").drop("row", "at")
    # one year of birth for a person's entries: another is a namesake
    years = entries.groupBy("person").agg(F.min("born").alias("y0"), F.max("born").alias("y1"))
    entries = entries.join(years, "person").withColumn("born", F.coalesce("born", F.when(F.col("y0") == F.col("y1"), F.col("y0"))))
    entries = stored(entries.withColumn("entity", F.xxhash64("person", F.coalesce("born", F.lit(0)))))
    often = lambda c: F.coalesce(F.mode(F.when(F.length(c) > 1, F.col(c)), True), F.min(c))
    left = people.groupBy("person").agg(
        often("first").alias("first"), often("last").alias("last"), F.max("org").alias("org"), F.min("at").alias("from"), F.max("at").alias("until"),
    ).select(F.xxhash64(F.lit(0), "person").alias("id"), F.lit(0).alias("side"), "first", "last", "org", "from", "until", F.lit(None).cast("int").alias("born"), F.lit(None).cast("int").alias("died"), F.col("person").alias("source"))
    right = entries.groupBy("entity").agg(
        often("first").alias("first"), often("last").alias("last"), F.max("org").alias("org"), F.max("born").alias("born"), F.max("died").alias("died"),
    ).select(F.xxhash64(F.lit(1), "entity").alias("id"), F.lit(1).alias("side"), "first", "last", "org", F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("until"), "born", "died", F.col("entity").alias("source"))
    entities = stored(left.unionByName(right))
    keys = (
        F.concat_ws("|", "last", "first", "org"), F.concat_ws("|", "org", "first", "last"),
        F.concat_ws("|", "first", "last", "org"), F.concat_ws("|", "first", F.reverse("last"), "org"),
    )
    fields = entities.select("id", "side", "first", "last", "org", "from", "until", "born", "died")
    pairs = neighbours(fields, list(keys), keep=confidence())
    sources = entities.select("id", "source")
    best = assigned(pairs).join(sources.select(F.col("id").alias("left"), F.col("source").alias("person")), "left")
    best = stored(best.join(sources.select(F.col("id").alias("right"), F.col("source").alias("entity")), "right"), pairs, entities)
    found = best.select("person", "entity", "confidence").join(people.select("person", "speaker_id", "at"), "person")
    found = found.join(entries.select("entity", "binding_id", F.col("born").alias("b"), F.col("died").alias("d")), "entity")
    alive = ~F.coalesce((F.col("at") < F.col("b")) | (F.col("at") > F.col("d")), F.lit(False))
    return found.where(alive).select("speaker_id", "binding_id", "confidence")
