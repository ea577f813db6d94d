"""Shared helpers of the training-data operators."""

from __future__ import annotations

import unicodedata
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Serbian Cyrillic letters and their Latin spellings.
CYRILLIC = "абвгдђежзијклљмнњопрстћуфхцчџш"
LATIN = "a b v g d đ e ž z i j k l lj m n nj o p r s t ć u f h c č dž š".split()

_TO_LATIN = {ord(c): l for c, l in zip(CYRILLIC, LATIN)} | {
    ord(c.upper()): l.capitalize() for c, l in zip(CYRILLIC, LATIN)
}
_PLAIN = {ord(a): b for a, b in zip("đĐøØłŁı", "dDoOlLi")} | {ord("ß"): "ss"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to_latin(text: str) -> str:
    """Cyrillic letters as Latin ones; other text stays."""
    return text if text.isascii() else text.translate(_TO_LATIN)


def fold(text: str) -> str:
    """Lower case, Latin script, no accents, no compatibility forms."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", to_latin(text)).translate(_PLAIN)
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def _checkpoint_folder(df: DataFrame) -> str:
    """The folder the cluster names in spark.checkpoint.dir; only where that
    is unset (tests) a local one is set."""
    sc = df.sparkSession.sparkContext
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        import tempfile

        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint"))
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the checkpoint folder."""
    _checkpoint_folder(df)
    return df.checkpoint()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, *done: DataFrame) -> DataFrame:
    """As checkpointed, but in compressed columns. What the step shuffled is
    removed at once, as are the stored tables that are done: nothing that is
    still to be computed may read these."""
    spark, path = df.sparkSession, f"{_checkpoint_folder(df)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    removed(*done)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.stored_in)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def within(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a table whose size is bounded by contract; more than the
    bound is an error, never a silent cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows, which is its stated bound")
    return rows


def spread(df: DataFrame) -> DataFrame:
    """At least as many partitions as cores, for Python work on few files."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def not_blank(c) -> F.Column:
    return F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
