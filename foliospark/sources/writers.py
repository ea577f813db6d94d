"""Results as files."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; the commit protocol replaces a path whole."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_files(df: DataFrame, name: str, text: str, folder: str) -> DataFrame:
    """Write each row's text to folder/name, on a file system all executors
    share, by renaming a finished sibling; name, bytes of what was written.
    Names must stay below the folder."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = os.path.realpath(folder)
        for b in batches:
            rows = []
            for n, t in zip(b[name], b[text]):
                path = os.path.realpath(os.path.join(top, n))
                if not path.startswith(top + os.sep):
                    raise ValueError(f"{n} leaves the folder")
                os.makedirs(os.path.dirname(path), exist_ok=True)
                data = (t or "").encode()
                part = f"{path}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, path)
                rows.append((n, len(data)))
            yield pd.DataFrame(rows, columns=["name", "bytes"])

    return df.select(name, text).mapInPandas(write, "name string, bytes long")


def package(root: str, out: str, suffixes: tuple[str, ...] = (".xml",), audit: str | None = None) -> int:
    """A ZIP of the files below a finished corpus, in order, each once;
    members are streamed from disk. Returns how many."""
    import zipfile

    top, n = os.path.realpath(root), 0
    with zipfile.ZipFile(out + ".part", "w", zipfile.ZIP_DEFLATED) as z:
        for base, keep in ((top, suffixes), (audit and os.path.realpath(audit), None)):
            found = sorted(os.path.join(d, f) for d, _, names in os.walk(base or "") for f in names)
            for path in found:
                if os.path.realpath(path) == path and (keep is None or path.endswith(keep)):
                    z.write(path, os.path.relpath(path, top if keep else os.path.dirname(base)))
                    n += 1
    os.replace(out + ".part", out)
    return n
