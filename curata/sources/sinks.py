"""Tables written as tab-separated text, split tables, HTML, and release files."""

from __future__ import annotations

import datetime
import html
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curata.schema import dotted
from curata.session import checkpointed


def as_text(df: DataFrame, first: str | None = None) -> DataFrame:
    """File form of a table: dotted names, structs and maps as JSON, lists joined, nulls as blanks."""
    columns = [first, *[c for c in df.columns if c != first]] if first else df.columns
    texts = []
    for c in columns:
        kind = df.schema[c].dataType
        v = F.col(c)
        if isinstance(kind, (T.StructType, T.MapType)):
            v = F.to_json(v, {"ignoreNullFields": "false"})
        elif isinstance(kind, T.ArrayType):
            v = F.array_join(v, ",")
        texts.append(F.coalesce(v.cast("string"), F.lit("")).alias(dotted(c)))
    return df.select(*texts)


def write_table(df: DataFrame, path: str, first: str | None = None, quoted: bool = True, order: Sequence[str] = ()) -> None:
    """Write a table as tab-separated files with a header. ``quoted`` False leaves JSON as it is."""
    out = as_text(df.orderBy(*order) if order else df, first)
    options = {"sep": "\t", "header": "true", "emptyValue": "", "nullValue": ""}
    if not quoted:
        options |= {"quote": "", "escapeQuotes": "false"}
    out.write.mode("overwrite").options(**options).csv(path)


#: Flags of a split and the names of their tables.
SPLITS = {"filtered": "full_filtered", "gene_broken": "full_gene_broken", "allele_broken": "full_allele_broken", "cdr3_broken": "full_cdr3aa_broken"}


def splits(flagged: DataFrame) -> dict[str, DataFrame]:
    """One table per flag; a row may go to several. The flags are written once, so each split is one scan of its rows."""
    written = checkpointed(flagged)
    return {name: written.where(F.col(f)).drop(*SPLITS) for f, name in SPLITS.items()}


def write_summary(df: DataFrame, path: str) -> None:
    """A report table as one tab-separated file with a header; it is sorted by the table, which must be a summary."""
    as_text(df).coalesce(1).write.mode("overwrite").options(sep="\t", header="true", emptyValue="", nullValue="").csv(path)


def read_table(spark, path: str) -> DataFrame:  # noqa: ANN001
    """A written table again, all columns as text, blanks as null, internal names."""
    raw = spark.read.option("sep", "\t").option("header", "true").option("nullValue", "").csv(path)
    return raw.toDF(*[c.replace(".", "_") for c in raw.columns])


def html_lines(df: DataFrame) -> DataFrame:
    """Each row of a table as one HTML table row, in a column ``html``; any number of rows."""
    def cell(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
            text = F.replace(text, F.lit(mark), F.lit(name))
        return F.concat(F.lit("<td>"), text, F.lit("</td>"))

    return df.select(F.concat(F.lit("<tr>"), *[cell(c) for c in df.columns], F.lit("</tr>")).alias("html"))


def html_table(df: DataFrame, titles: Sequence[str] | None = None) -> str:
    """A report table as one HTML text. Rows come to the driver one partition at a time; larger tables
    are for ``html_lines``, which writes them in parallel."""
    rows = df.toLocalIterator()
    head = "".join(f"<th>{html.escape(t)}</th>" for t in (titles or df.columns))
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def release(files: Sequence[str], folder: str, versions: str, base_url: str, day: datetime.date | None = None) -> bool:
    """Zip files under a dated name and put its URL first in the list of versions.

    Returns False, and changes nothing, if the list already starts with that URL.
    """
    name = f"records-{(day or datetime.date.today()).isoformat()}.zip"
    url, listed = f"{base_url}/{name}", Path(versions)
    before = listed.read_text() if listed.exists() else ""
    if before.split("\n", 1)[0] == url:
        return False
    with zipfile.ZipFile(Path(folder) / name, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, Path(f).name)
    listed.write_text(f"{url}\n{before}")
    return True
