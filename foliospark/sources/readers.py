"""Documents, sidecars and catalogues as DataFrames."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
EXTENSIONS = ("pdf", "docx")

DOCX_RUNS = (
    "path string, para int, run int, text string, x double, y double, w double, h double, bold boolean, "
    "italic boolean, superscript boolean, alignment string, first_line_indent double, error string"
)
GLYPHS = "path string, page_num int, seq long, text string, x0 double, x1 double, y0 double, font_name string, font_size double, error string"


def normalized_extensions(extensions=None) -> tuple[str, ...]:
    """Lower case, without dots; the default set for none."""
    clean = tuple(sorted({e.strip().lower().lstrip(".") for e in extensions or () if e.strip().strip(".")}))
    return clean or EXTENSIONS


def discover(spark: SparkSession, roots: list[str], extensions=None, recursive: bool = True, excluded: list[str] = ()) -> DataFrame:
    """path, length, modified, content of documents below the roots, by
    extension, without excluded folders, each physical path once. The content
    is read only if it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(roots)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    files = files.where(suffix.isin(*normalized_extensions(extensions)))
    for folder in excluded:
        files = files.where(~F.col("path").contains(folder.rstrip("/") + "/"))
    return files.select("path", "length", F.col("modificationTime").alias("modified"), "content").dropDuplicates(["path"])


def _number(element, name: str) -> float | None:
    value = element.get(W + name) if element is not None else None
    try:
        return None if value is None else float(value)
    except ValueError:
        return None


def _on(properties, name: str) -> bool:
    e = properties.find(W + name) if properties is not None else None
    return e is not None and e.get(W + "val", "true") not in ("0", "false")


def _runs(path: str, content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml"))
    for p, para in enumerate(body.iter(W + "p")):
        pr = para.find(W + "pPr")
        frame = pr.find(W + "framePr") if pr is not None else None
        if frame is None:
            continue
        jc, ind = pr.find(W + "jc"), pr.find(W + "ind")
        place = [_number(frame, k) for k in ("x", "y", "w", "h")]
        for r, run in enumerate(para.iter(W + "r")):
            text = "".join("\t" if t.tag == W + "tab" else t.text or "" for t in run.iter() if t.tag in (W + "t", W + "tab"))
            rp = run.find(W + "rPr")
            up = rp.find(W + "vertAlign") if rp is not None else None
            yield (
                path, p, r, text, *place, _on(rp, "b"), _on(rp, "i"), up is not None and up.get(W + "val") == "superscript",
                jc.get(W + "val") if jc is not None else None, _number(ind, "firstLine"), None,
            )


def docx_runs(files: DataFrame) -> DataFrame:
    """Runs of framed paragraphs of DOCX files (path, content). A file that
    can't be read gives one row with its error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DOCX_RUNS.split(", ")]
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    rows = list(_runs(path, content))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
                    rows = [(path, *[None] * (len(names) - 2), f"{type(e).__name__}: {e}"[:500])]
                yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(read, DOCX_RUNS)


def pdf_glyphs(files: DataFrame) -> DataFrame:
    """Glyphs of PDF files (path, content), where a PDF library is installed;
    without one, and for a page that fails, a row with the error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in GLYPHS.split(", ")]
        try:
            import pdfplumber
        except ImportError:
            pdfplumber = None
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                if pdfplumber is None:
                    yield pd.DataFrame([(path, *[None] * (len(names) - 2), "no PDF library is installed")], columns=names)
                    continue
                with pdfplumber.open(io.BytesIO(content)) as pdf:
                    for n, page in enumerate(pdf.pages):
                        try:
                            rows = [
                                (path, n, i, c["text"], c["x0"], c["x1"], float(page.height) - c["bottom"], c["fontname"], c["size"], None)
                                for i, c in enumerate(page.chars)
                            ]
                        except Exception as e:
                            rows = [(path, n, *[None] * (len(names) - 3), f"{type(e).__name__}: {e}"[:500])]
                        yield pd.DataFrame(rows, columns=names)
                        page.close()

    return files.select("path", "content").mapInPandas(read, GLYPHS)


def json_speakers(spark: SparkSession, path: str) -> DataFrame:
    """path, speaker_ref, label of JSON sidecars: a mapping, or one under
    `speakers` or `data.speakers`; unreadable files give nothing."""
    texts = spark.read.option("wholetext", "true").text(path).select(F.input_file_name().alias("path"), "value")
    maps = [F.from_json(F.get_json_object("value", p), "map<string,string>") for p in ("$.data.speakers", "$.speakers")]
    mapping = F.coalesce(*maps, F.from_json("value", "map<string,string>"))
    return texts.select("path", F.explode(mapping).alias("speaker_ref", "label")).where("label is not null and not label like '{%'")


def xml_extents(spark: SparkSession, path: str) -> DataFrame:
    """path, unit, quantity of the measures in written documents' headers."""
    texts = spark.read.option("wholetext", "true").text(path).select(F.input_file_name().alias("path"), "value")
    bare = F.regexp_replace("value", r'\sxmlns(:\w+)?="[^"]*"', "")
    units, sums = F.xpath(bare, F.lit("//extent/measure/@unit")), F.xpath(bare, F.lit("//extent/measure/@quantity"))
    pairs = texts.select("path", F.explode(F.arrays_zip(units.alias("unit"), sums.alias("quantity"))).alias("m"))
    return pairs.groupBy("path", "m.unit").agg(F.sum(F.col("m.quantity").try_cast("long")).alias("quantity"))
