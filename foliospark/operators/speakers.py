"""Speakers and bodies: details, merged mappings, aliases, lists."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..functions import columns as C
from .carry import carry_last, carry_sum


def _key(text: str) -> str:
    """Letters only, folded, look-alike figures as letters: for comparison."""
    plain = unicodedata.normalize("NFKD", text.removeprefix("#").removeprefix("speaker-")).casefold()
    plain = plain.translate(str.maketrans("01|đ", "olld"))
    return "".join(c for c in plain if c.isalpha())


def comparison_key(text: Column) -> Column:
    return F.pandas_udf(lambda s: pd.Series([None if t is None else _key(t) for t in s], dtype=object), StringType())(text)


def similarity(a: Column, b: Column) -> Column:
    """Share of characters in matching blocks of two texts, by their keys."""

    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([0.0 if p is None or q is None else difflib.SequenceMatcher(None, _key(p), _key(q), False).ratio() for p, q in zip(x, y)])

    return F.pandas_udf(ratio, DoubleType())(a, b)


def details(labels: DataFrame, label: str) -> DataFrame:
    """Add forename, surname, lookup_name, role, organization of labels."""
    name = C.label_name(F.col(label))
    df = labels.withColumn("lookup_name", name).withColumn("role", C.label_role(F.col(label))).withColumn("organization", C.label_organization(F.col(label)))
    return df.withColumn("forename", C.forename(F.col("lookup_name"))).withColumn("surname", C.surname(F.col("lookup_name")))


def label_noise(label: Column) -> Column:
    """Signs in a label that names don't have."""
    return F.length(F.regexp_replace(label, r"[\p{L}\s.,()\-:']", ""))


def merged_mapping(mapping: DataFrame, ref: str, label: str, ord: Column, by: list[str] = (), similar: bool = False) -> DataFrame:
    """by..., ref, label, n: one label of each speaker - the most like the ref
    (if asked), the least noisy, with a body or office, the shortest, the
    first. Aggregated by maximum, so that a hot speaker is no burden."""
    has = C.label_organization(F.col(label)).isNotNull() | C.label_role(F.col(label)).isNotNull()
    like = similarity(F.col(ref), C.label_name(F.col(label))) if similar else F.lit(0.0)
    ranked = mapping.where(F.col(ref).isNotNull() & F.col(label).isNotNull()).withColumn("__like", like)
    score = F.struct(F.col("__like").alias("s"), (-label_noise(F.col(label))).alias("noise"), has.alias("has"), (-F.length(label)).alias("len"), (-ord).alias("ord"))
    return ranked.groupBy(*by, ref).agg(F.max_by(label, score).alias(label), F.count("*").alias("n"))


def alias_clusters(refs: DataFrame, doc: str, ref: str, ord: str, least: float = 0.9) -> DataFrame:
    """doc, ref, leader: refs of a document under the best ref that is spelled
    alike: the most frequent, then the least noisy, then the first.

    Two refs are alike if their keys are equal, or of seven letters at least,
    at most two apart in length and at least so similar. Candidates share one
    of the thirds of their keys or the keys' ends (a similarity self-join by
    equality; no pass over all refs of a document). A ref follows its best
    alike, and that one its own, so that short chains end at one leader.
    """
    kind = dict(refs.dtypes)[doc]
    counted = refs.where(F.col(ref).isNotNull()).groupBy(doc, ref).agg(F.count("*").alias("n"), F.min(ord).alias("first"))
    counted = counted.withColumn("key", comparison_key(F.col(ref)))
    rank = F.struct((-F.col("n")).alias("n"), label_noise(F.col(ref)).alias("noise"), F.col("first").alias("first"), F.col(ref).alias("ref"))
    size = F.length("key")
    part = lambda i: F.substring(F.col("key"), (F.floor(size * i / 3) + 1).cast("int"), F.floor(size / 3).cast("int"))
    marks = F.when(size < 7, F.array("key")).otherwise(F.array_distinct(F.array("key", *[part(i) for i in range(3)], F.left("key", F.lit(4)), F.right("key", F.lit(4)))))
    spread = counted.select(doc, "key", rank.alias("rank"), F.explode(marks).alias("mark"))
    other = spread.select(F.col(doc).alias("__d"), F.col("mark").alias("__m"), F.col("key").alias("other"), F.col("rank").alias("better"))
    pairs = spread.join(other, (F.col(doc) == F.col("__d")) & (F.col("mark") == F.col("__m")) & (F.col("better") < F.col("rank")))
    pairs = pairs.select(doc, "rank.ref", "key", "other", "better").distinct()
    near = (F.col("key") == F.col("other")) | ((F.length("key") >= 7) & (F.length("other") >= 7) & (F.abs(F.length("key") - F.length("other")) <= 2) & (similarity(F.col("key"), F.col("other")) >= least))
    best = pairs.where(near).groupBy(doc, "ref").agg(F.min("better")["ref"].alias("leader"))
    far = best.select(F.col(doc), F.col("ref").alias("leader"), F.col("leader").alias("far"))
    best = best.join(far, [doc, "leader"], "left").select(doc, F.col("ref").alias(ref), F.coalesce("far", "leader").alias("leader"))
    return counted.select(F.col(doc).cast(kind), ref).join(best, [doc, ref], "left").select(doc, ref, F.coalesce("leader", ref).alias("leader"))


def list_person(speakers: DataFrame, by: list[str], ref: str, label: str) -> DataFrame:
    """by..., id, name, role, organization, org_id: one entry per speaker."""
    text = F.col(label)
    return speakers.select(
        *by, F.regexp_replace(F.col(ref), "^#", "").alias("id"), C.squeezed(F.substring_index(text, ":", 1)).alias("name"),
        C.role_value(C.label_role(text)).alias("role"), C.label_organization(text).alias("organization"),
        C.org_id(C.label_organization(text)).alias("org_id"),
    )


def list_org(rows: DataFrame, organization: str, ord: Column, by: list[str] = ()) -> DataFrame:
    """by..., org_id, name: distinct bodies, each by the name first given.
    A missing body is the unknown one."""
    named = rows.withColumn("__name", F.coalesce(organization, F.lit("Unknown organization"))).withColumn("org_id", F.when(F.col(organization).isNull(), "org.UnknownOrganization").otherwise(C.org_id(F.col(organization))))
    return named.groupBy(*by, "org_id").agg(F.min_by("__name", ord).alias("name"))


def person_records(bindings: DataFrame) -> DataFrame:
    """One record per entity of a register's answers: distinct values of each
    key, dates without time, sex as M, F or U, the label most often given."""
    values = lambda c: F.array_sort(F.collect_set(c))
    sex = F.when(F.lower("sex_label").isin("moški", "male", "muški"), "M").when(F.lower("sex_label").isin("ženski", "female", "ženska"), "F").otherwise("U")
    return bindings.where("p is not null").groupBy("p").agg(
        F.max_by("p_label", F.struct(F.length("p_label"), "p_label")).alias("name"), values(F.substring_index("birth", "T", 1)).alias("births"),
        values(F.substring_index("death", "T", 1)).alias("deaths"), F.min(sex).alias("sex"), values("occ_label").alias("occupations"),
        values("citizen_label").alias("nationalities"), values(F.struct("party_label", "party")).alias("affiliations"),
        values("viaf").alias("viaf"), values("gnd").alias("gnd"), values("isni").alias("isni"), F.count("*").alias("n"),
    )


def utterances(lines: DataFrame, doc: str, block: str, order: list[str], speaker: Column) -> DataFrame:
    """Add utterance (numbered from 1; null before the first speaker) and who,
    the speaker last named; by blocks of rows, not by documents."""
    df = lines.withColumn("__s", speaker)
    df = carry_sum(df, doc, block, order, F.col("__s").isNotNull().cast("int"), "utterance")
    df = carry_last(df, doc, block, order, F.col("__s"), "who")
    return df.withColumn("utterance", F.nullif(F.col("utterance"), F.lit(0))).drop("__s")
