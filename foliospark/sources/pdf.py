"""PDF pages as tasks: glyphs or words of page ranges, by a pluggable backend.

A backend has three functions of a document's bytes: `pages` (how many pages
its tree has, whatever it declares), `glyphs` and `words` (rows of a range of
pages). The one of an installed library is found by `backend()`; tests and
other libraries bring their own. Backends are sent to the executors.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import layout

ROW = "page_num int, seq long, text string, x0 double, x1 double, y0 double, font_name string, font_size double, page_width double, page_height double"
FIELDS = [c.split()[0] for c in ROW.split(", ")]
#: How words are gathered from characters.
X_TOLERANCE, Y_TOLERANCE = 1.7, 3.0


@dataclass(frozen=True)
class Backend:
    """name; pages(content) -> int; glyphs and words(content, page) -> rows of FIELDS."""

    name: str
    pages: Callable[[bytes], int]
    glyphs: Callable[[bytes, int], list[tuple]]
    words: Callable[[bytes, int], list[tuple]]


def backend() -> Backend | None:
    """That of the installed library; None without one."""
    try:
        import pdfplumber  # noqa: F401
    except ImportError:
        return None

    def opened(content):
        import pdfplumber

        return pdfplumber.open(io.BytesIO(content))

    def rows(content, n, pick):
        with opened(content) as pdf:
            page = pdf.pages[n]
            out = [(n, i, c["text"], c["x0"], c["x1"], float(page.height) - c["bottom"], c.get("fontname"), c.get("size"), float(page.width), float(page.height)) for i, c in enumerate(pick(page))]
            page.close()
            return out

    def count(content):
        with opened(content) as pdf:
            return len(pdf.pages)

    words = lambda p: p.extract_words(x_tolerance=X_TOLERANCE, y_tolerance=Y_TOLERANCE, use_text_flow=True, extra_attrs=["fontname", "size"])
    return Backend("pdfplumber", count, lambda c, n: rows(c, n, lambda p: p.chars), lambda c, n: rows(c, n, words))


def page_tasks(files: DataFrame, b: Backend | None, pages_per_task: int = 16, start: int = 0, end: int | None = None) -> DataFrame:
    """path, start, end, error: the pages of each file (path, content) in ranges
    whose sizes differ by one at most; a file that can't be read has its error."""

    def count(contents: pd.Series) -> pd.DataFrame:
        out = []
        for c in contents:
            try:
                if b is None:
                    raise RuntimeError("no PDF library is installed")
                out.append((b.pages(bytes(c)), None))
            except Exception as e:
                out.append((0, f"{type(e).__name__}: {e}"[:500]))
        return pd.DataFrame(out, columns=["n", "error"])

    counted = files.select("path", F.pandas_udf(count, "n long, error string")("content").alias("c")).select("path", "c.n", "c.error")
    last = F.least(F.col("n"), F.lit(end if end is not None else 2**31)).cast("long")
    workers = F.greatest(F.ceil((last - start) / pages_per_task), F.lit(1)).cast("long")
    sized = counted.withColumn("ranges", layout.page_ranges(F.lit(start).cast("long"), last, workers))
    return sized.select("path", F.explode_outer("ranges").alias("r"), "error").select("path", "r.start", "r.end", "error")


def scanned(files: DataFrame, b: Backend | None, level: str = "glyphs", **pages) -> DataFrame:
    """path, FIELDS, error: glyphs or words of all pages. Ranges of pages are
    the tasks, so that one large file doesn't hold one; a page that fails gives
    a row with its error, the others go on. Order by path, page_num and seq."""
    tasks = page_tasks(files, b, **pages)
    failed = tasks.where("error is not null").select("path", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in ROW.split(", ")], "error")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, lo, hi, content in zip(batch["path"], batch["start"], batch["end"], batch["content"]):
                for n in range(int(lo), int(hi)):
                    try:
                        rows = [(path, *r, None) for r in getattr(b, level)(bytes(content), n)]
                    except Exception as e:
                        rows = [(path, n, *[None] * (len(FIELDS) - 1), f"{type(e).__name__}: {e}"[:500])]
                    yield pd.DataFrame(rows, columns=["path", *FIELDS, "error"])

    whole = tasks.where("error is null and start is not null").repartition("path", "start").join(files.select("path", "content"), "path")
    return whole.mapInPandas(read, f"path string, {ROW}, error string").unionByName(failed)


def page_warnings(rows: DataFrame) -> DataFrame:
    """path, warning of the pages and files that failed."""
    place = F.when(F.col("page_num").isNotNull(), F.concat(F.lit("page "), (F.col("page_num") + 1).cast("string"), F.lit(" extraction failed: "))).otherwise("")
    return rows.where("error is not null").select("path", F.concat(place, "error").alias("warning"))


def adaptive(files: DataFrame, b: Backend | None, mode: DataFrame, **pages) -> DataFrame:
    """As scanned, by words for files whose mode (path, mode) is ocr and by
    glyphs else; a file that gives nothing by the one is read by the other."""
    chosen = files.join(mode.select("path", "mode"), "path", "left")
    by_words = F.coalesce(F.col("mode") == "ocr", F.lit(False))
    out = None
    for level, mine in (("glyphs", ~by_words), ("words", by_words)):
        first = scanned(chosen.where(mine), b, level, **pages)
        empty = chosen.where(mine).join(first.where("text is not null").select("path").distinct(), "path", "left_anti")
        other = scanned(empty, b, "words" if level == "glyphs" else "glyphs", **pages)
        both = first.unionByName(other)
        out = both if out is None else out.unionByName(both)
    return out


def enriched(rows: DataFrame, keep: Column | None = None, page: dict[str, Column] | None = None, line: dict[str, Column] | None = None) -> DataFrame:
    """Rows that are kept, with columns of their page (aggregates over it) and
    of their own; page columns see the rows of a page that are kept."""
    df = rows if keep is None else rows.where(F.coalesce(keep, F.lit(False)))
    if page:
        sums = df.groupBy("path", "page_num").agg(*[c.alias(k) for k, c in page.items()])
        df = df.join(sums, ["path", "page_num"])
    return df.withColumns(line) if line else df


def coordinates(rows: DataFrame, page: int | None = None, needle: str | None = None) -> DataFrame:
    """Where texts stand: path, page_num, y0, text, x0, x1, font_name (`<mixed>`
    for several), font_size (to three places, null for several) of lines, of
    one page or with a text in them."""
    df = rows.where("error is null") if page is None else rows.where(f"error is null and page_num = {int(page)}")
    size, listed = F.round("font_size", 3), F.array_sort(F.collect_list(F.struct("seq", "text")))
    out = df.groupBy("path", "page_num", "y0").agg(
        F.array_join(F.transform(listed, lambda r: r["text"]), "").alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"),
        F.when(F.count_distinct("font_name") == 1, F.min("font_name")).otherwise("<mixed>").alias("font_name"), F.when(F.count_distinct(size) == 1, F.min(size)).alias("font_size"),
    )
    return out if needle is None else out.where(F.contains(F.lower("text"), F.lit(needle.lower())))
