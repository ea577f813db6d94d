"""Mixing sources to target weights by Poisson replication.

Every document of a source is used N times, N drawn from a Poisson
distribution by inverting it at a number hashed from (seed, document). The
rate of a source is chosen so that the expected tokens of its copies are its
share of the mixture; where copies are capped, the rate is raised until the
mean of the capped distribution is that number, and a source that even the cap
cannot bring there uses every document cap times.
"""

from __future__ import annotations

import base64
import functools
import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import within

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The plan has one row per source; this many are its stated bound.
MAX_SOURCES = 10_000


@functools.cache
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = (
        r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )
    return tiktoken.Encoding("mixture", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text; null and empty texts have none. Words repeat, so a
    text is cut as the tokenizer cuts it and each piece is counted once."""
    path = os.path.join(tokenizers, vocabulary)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoder(path).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def capped_mean(rate: float, cap: int) -> float:
    """Mean of min(N, cap) for N Poisson of the given rate: cap less the mean
    shortfall, summed from logarithms, so that no rate is too large."""
    if rate <= 0 or cap <= 0:
        return 0.0
    n = np.arange(cap)
    logs = n * math.log(rate) - rate - np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, cap)))])
    return cap - float(((cap - n) * np.exp(logs)).sum())


def rate_for(mean: float, cap: int) -> float | None:
    """The rate whose capped mean is `mean`; None where the cap is reached."""
    if mean >= cap:
        return None
    low, high = 0.0, 1.0
    while capped_mean(high, cap) < mean and high < 1e9 * cap:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if capped_mean(mid, cap) < mean else (low, mid)
    return (low + high) / 2


def replication_plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, documents, tokens, wanted, rate
    (null: every document max_repeats times), reachable.

    `sized` has source and n_tokens; rows without a source take no part.
    Repeated rows of `targets` count once; a source with null share or repeats
    has none; a source without documents is unreachable unless its share is 0.
    """
    spark = sized.sparkSession
    sums = sized.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens")
    )
    got = {r["source"]: (r["documents"], r["tokens"] or 0) for r in within(sums, MAX_SOURCES, "sources")}
    total, rows = sum(t for _, t in got.values()), []
    wanted = within(targets.select("source", "target_share", "max_repeats").distinct(), MAX_SOURCES, "targets")
    for r in sorted((r for r in wanted if r["source"] is not None), key=lambda r: r["source"]):
        n, tokens = got.get(r["source"], (0, 0))
        want, cap = (r["target_share"] or 0.0) * total, r["max_repeats"] or 0
        reachable = tokens * cap >= want
        rate = rate_for(want / tokens, cap) if tokens and reachable else None
        rows.append((r["source"], r["target_share"], cap, n, tokens, want, rate, reachable))
    return spark.createDataFrame(
        rows,
        "source string, target_share double, max_repeats int, documents long, tokens long, "
        "wanted double, rate double, reachable boolean",
    )


def repeats(key: Column, rate: Column, cap: Column, seed: int = 0) -> Column:
    """Inverse of the Poisson distribution at a number hashed from seed and
    key: the first n at which the distribution's sum passes that number."""
    u = (F.xxhash64(F.lit(seed), key).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / float(1 << 52)
    # from a place below which a large rate's distribution has nothing: its probability by Stirling's series
    n0 = F.when(rate > 500, F.floor(rate - 12 * F.sqrt(rate))).otherwise(0).cast("int")
    stirling = n0 * F.log(n0.cast("double")) - n0 + 0.5 * F.log(2 * math.pi * n0) + 1 / (12.0 * n0)
    p0 = F.when(rate > 500, F.exp(n0 * F.log(rate) - rate - stirling)).otherwise(F.exp(-rate))
    start = F.struct(n0.alias("n"), p0.alias("p"), p0.alias("sum"))

    def step(s: Column, i: Column) -> Column:
        more = s["sum"] < u
        p = s["p"] * rate / (s["n"] + 1)
        return F.struct(
            F.when(more, s["n"] + 1).otherwise(s["n"]).alias("n"),
            F.when(more, p).otherwise(s["p"]).alias("p"),
            F.when(more, s["sum"] + p).otherwise(s["sum"]).alias("sum"),
        )

    drawn = F.aggregate(F.sequence(F.lit(1), F.greatest(cap - n0, F.lit(1))), start, step)["n"]
    return F.when(cap <= 0, 0).when(rate.isNull(), cap).otherwise(F.least(drawn, cap))


def mix(documents: DataFrame, plan: DataFrame, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """The mixture: all columns of documents, copy, position, in global random
    order (a range partitioning by a hash of key and copy; no single-task
    sort). Documents of sources without target take no part."""
    drawn = documents.join(F.broadcast(plan.select("source", F.col("rate"), F.col("max_repeats"))), "source")
    drawn = drawn.withColumn("repeats", repeats(F.col(key), F.col("rate"), F.col("max_repeats"), seed))
    copies = drawn.where("repeats > 0").select(
        *[c for c in documents.columns if c not in ("copy", "position")], F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy")
    )
    return copies.withColumn("position", F.xxhash64(F.lit(seed + 1), F.col(key), F.col("copy"))).orderBy("position", key, "copy")


def shares(sized: DataFrame, plan: DataFrame, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """Per source of the plan: target and actual share of the mixture's
    tokens, and how often its documents are used on average and at most."""
    drawn = sized.join(F.broadcast(plan.select("source", F.col("rate"), F.col("max_repeats"))), "source")
    drawn = drawn.withColumn("repeats", repeats(F.col(key), F.col("rate"), F.col("max_repeats"), seed))
    used = drawn.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("repeats")).alias("mixed_tokens"),
        F.avg("repeats").alias("mean_repeats"), F.max("repeats").alias("most_repeats"),
    )
    everything = Window.partitionBy(F.lit(0))  # one row per source: bounded by MAX_SOURCES
    joined = plan.join(used, "source", "left").withColumn("all_tokens", F.sum("mixed_tokens").over(everything))
    return joined.select(
        "source", "target_share", "max_repeats", "documents", "tokens", "wanted", "reachable",
        F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), "mean_repeats", "most_repeats",
        (F.coalesce("mixed_tokens", F.lit(0)) / F.nullif(F.col("all_tokens"), F.lit(0))).alias("actual_share"),
    )


def sized_documents(documents: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    return documents.select("doc_id", "source", token_count(F.col("text"), tokenizers, vocabulary).alias("n_tokens"))
