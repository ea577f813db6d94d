"""Jobs of a batch: discovery, names and paths, manifests, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import structure

#: Longest path written, what of it stays free, and what a title may take.
BUDGET, RESERVE, TITLE = 240, 16, 64


def ordered_jobs(jobs: DataFrame, path: str, source: str) -> DataFrame:
    """Jobs numbered in discovery order: by path without regard to case, then
    by source; a physical source counts once, as first met."""
    first = Window.partitionBy(source).orderBy(F.lower(path), path)
    df = jobs.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
    parts = df.repartitionByRange(F.lower(path), source).sortWithinPartitions(F.lower(path), source)
    return parts.withColumn("ord", F.monotonically_increasing_id())


def discovered(files: DataFrame, path: str, extensions: tuple[str, ...], excluded: list[str] = (), roots: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(documents, warnings): files by extension, outside excluded folders;
    a root without a file, and files of another kind named as roots, are warned of."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    outside = F.lit(True)
    for folder in excluded:
        outside = outside & ~contained(F.col(path), F.lit(folder))
    documents = files.where(suffix.isin(*extensions) & outside)
    named = files.sparkSession.createDataFrame([(r,) for r in roots], "root string")
    missing = named.join(files, (F.col(path) == F.col("root")) | contained(F.col(path), F.col("root")), "left_anti").select(F.concat(F.lit("missing: "), "root").alias("warning"))
    other = named.join(files.where(~suffix.isin(*extensions)), F.col(path) == F.col("root")).select(F.concat(F.lit("unsupported: "), "root").alias("warning"))
    return documents, missing.unionByName(other)


def contained(path: Column, folder: Column) -> Column:
    """Whether a path lies below a folder."""
    return path.startswith(F.concat(F.regexp_replace(folder, "/+$", ""), F.lit("/")))


def source_roots(files: DataFrame, path: str) -> DataFrame:
    """root, n: the top folders of a download that hold documents; the download
    itself ('') if documents lie loose in it."""
    top = F.when(F.col(path).contains("/"), F.substring_index(path, "/", 1)).otherwise("")
    counts = files.groupBy(top.alias("root")).agg(F.count("*").alias("n"))
    loose = counts.where("root = ''").select(F.lit(True).alias("loose")).limit(1)  # at most one row
    return counts.join(F.broadcast(loose), how="left").where("loose is null or root = ''").select("root", "n").orderBy(F.lower("root"))


def month_key(month: Column) -> Column:
    return F.replace(C.ascii_slug(month, ""), F.lit("-"), F.lit(""))


def corpus_name(prefix: Column, code: Column) -> Column:
    """prefix-CODE where both are valid; null else."""
    return F.when(C.valid_prefix(prefix) & C.valid_code(code), F.concat(prefix, F.lit("-"), F.upper(code)))


def cache_folder(path: Column) -> Column:
    """A folder's name for a menu path, with eight digits of its hash."""
    name = F.left(F.regexp_replace(F.regexp_replace(path, r"[^0-9A-Za-z_]+", "-"), "^-+|-+$", ""), F.lit(80))
    return F.concat(name, F.lit("-"), F.left(F.sha1(F.encode(path, "UTF-8")), F.lit(8)))


def outputs(root: str, group: Column, title: Column, metadata: str | None = None) -> dict[str, Column]:
    """Where a job's document, its metadata and its list of persons go: the
    metadata beside the audited corpus, or in the group's own folder."""
    base = F.concat_ws("/", F.lit(root), F.nullif(group, F.lit("")))
    audit = F.concat_ws("/", F.lit(metadata), F.nullif(group, F.lit("")), title) if metadata else F.concat_ws("/", base, F.lit("metadata"), title)
    return {"xml": F.concat_ws("/", base, F.concat(title, F.lit(".xml"))), "metadata": audit, "list": F.concat_ws("/", audit, F.lit("listPerson.xml"))}


def fitted(root: str, group: Column, title: Column, budget: int = BUDGET, reserve: int = RESERVE, least: int = TITLE) -> Column:
    """group/title such that the whole path stays within the budget: first the
    title is cut, down to `least`, then the group's parts, each cut one ending
    with digits of a hash of the whole. Names are safe for any file system."""
    group = F.array_join(F.transform(F.filter(F.split(F.coalesce(group, F.lit("")), "/"), lambda p: p != ""), lambda p: C.safe_component(p)), "/")
    title = C.safe_component(title, 1000)
    room = F.lit(budget - reserve - len(root) - 1)
    cut = lambda text, n: F.when(F.length(text) <= n, text).otherwise(F.concat(F.regexp_replace(F.left(text, (n - 9).cast("int")), "[-. ]+$", ""), F.lit("-"), F.left(F.sha1(F.encode(text, "UTF-8")), F.lit(8))))
    short = cut(title, F.greatest(room - F.length(group) - 1, F.lit(least)))
    shorter = cut(group, F.greatest(room - F.length(short) - 1, F.lit(9)))
    return F.concat_ws("/", F.nullif(F.regexp_replace(shorter, "/+$", ""), F.lit("")), short)


def unique_paths(jobs: DataFrame, order: list[str], root: str, group: Column, title: Column, name: str = "path") -> DataFrame:
    """Add paths within the budget, of which none occurs twice even without
    regard to case: as structure.unique_ids on the lower case."""
    df = jobs.withColumn("__path", fitted(root, group, title))
    df = structure.unique_ids(df, [], order, F.lower("__path"), "__id")
    tail = F.substring(F.col("__id"), F.length("__path") + 1, F.length("__id"))
    return df.withColumn(name, F.concat("__path", tail)).drop("__path", "__id")


def counted(value: Column) -> Column:
    """A counter that may be no number: 0 then."""
    return F.coalesce(value.try_cast("long"), F.lit(0).cast("long"))


def recoveries(diagnostics: DataFrame, by: list[str], n: str, exported: str) -> DataFrame:
    """by..., recovery_count: the greater of what diagnostics count and how
    many recoveries are listed."""
    return diagnostics.groupBy(*by).agg(F.greatest(F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(F.size(exported)), F.lit(0)).cast("long")).alias("recovery_count"))


def statuses(jobs: DataFrame, fingerprint: Column) -> DataFrame:
    """What is kept of every job: source, status, fingerprint, completed_at
    (UTC to the second)."""
    at = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return jobs.select("source", "status", fingerprint.alias("fingerprint"), at.alias("completed_at"))


def progress(jobs: DataFrame, order: str, name: str, status: str, seconds: str, message: str) -> DataFrame:
    """order, line: `[i/n] STATUS name (t s) - message` of every job."""
    n = jobs.agg(F.count("*").alias("__n"))
    tail = F.coalesce(F.concat(F.lit(" - "), F.nullif(F.col(message), F.lit(""))), F.lit(""))
    line = F.concat(F.format_string("[%d/%d] %s %s (%.1f s)", F.col(order), F.col("__n"), F.upper(status), F.col(name), F.col(seconds)), tail)
    return jobs.join(F.broadcast(n)).select(order, line.alias("line"))  # one row


def checkpoint_steps(n: Column) -> Column:
    """After how many documents a manifest is written anew."""
    return F.greatest(F.lit(1), F.least(F.lit(50), F.floor(n / 100))).cast("int")


def manifest_sections(manifest: DataFrame, sections: list[str], files: DataFrame, path: str) -> DataFrame:
    """path, section, ord: the XML files that sections (arrays of paths) of a
    manifest name, each once, as first met, if they exist."""
    every = None
    for i, s in enumerate(sections):
        part = manifest.select(F.lit(i).alias("__i"), F.posexplode(F.col(s)).alias("__at", path)).withColumn("section", F.lit(s))
        every = part if every is None else every.unionByName(part)
    firsts = every.where(F.lower(path).endswith(".xml")).groupBy(path).agg(F.min(F.struct("__i", "__at", "section")).alias("f"))
    kept = firsts.join(files.select(path).distinct(), path, "left_semi").select(path, "f.section", F.col("f.__i").alias("__i"), F.col("f.__at").alias("__at"))
    return kept.withColumn("ord", F.row_number().over(Window.partitionBy("section").orderBy("__at"))).drop("__i", "__at")


def request_errors(request: dict[str, Column]) -> Column:
    """What is wrong with a request: an array of messages, empty if nothing."""
    missing = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    checks = [
        (missing(request["inputs"]) & missing(request["menu"]), "nothing to convert"), (missing(request["output"]), "no output folder"), (~C.valid_prefix(F.coalesce(request["prefix"], F.lit(""))), "bad prefix"),
        (~C.valid_code(F.coalesce(request["code"], F.lit(""))), "bad code"), (F.coalesce(request["workers"].try_cast("int"), F.lit(0)) < 1, "workers must be at least 1"),
        (F.coalesce(request["timeout"].try_cast("double"), F.lit(0.0)) <= 0, "timeout must be positive"),
    ]
    return F.array_compact(F.array(*[F.when(C.holds(test), message) for test, message in checks]))


def text_lines(text: Column) -> Column:
    """Lines of a field that aren't blank, without white space around them."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), C.stripped), lambda x: x != "")


def log_tail(content: Column, most: int = 65_536) -> Column:
    """The end of a log, without the line that the cut broke."""
    return F.when(F.length(content) <= most, content).otherwise(F.regexp_replace(F.right(content, F.lit(most)), r"^[^\n]*\n", ""))
