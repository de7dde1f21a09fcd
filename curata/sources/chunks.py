"""Submission files: listing, reading line by line or as wide tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curata.operators import reject
from curata.operators.quality import check_header
from curata.schema import ALL, undotted
from curata.session import blank_to_null, checkpointed, lookup_join


def chosen(name: Column, wanted: Sequence[str] | None, substring: bool = False) -> Column:
    """Whether a file name is not hidden and, if names are given, is one of them.

    ``substring`` takes names that contain a wanted text in any letter case instead.
    """
    visible = ~name.startswith(".")
    if not wanted:
        return visible
    if not substring:
        return visible & name.isin(list(wanted))
    found = F.lit(False)
    for w in wanted:
        found = found | F.lower(name).contains(w.lower())
    return visible & found


def list_chunks(spark: SparkSession, folder: str, wanted: Sequence[str] | None = None, substring: bool = False, pattern: str = "*.txt") -> DataFrame:
    """Submission files of a folder: chunk_file, path, size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("chunk_file"), "path", F.col("length").alias("size")
    )
    return files.where(chosen(F.col("chunk_file"), wanted, substring))


def read_lines(spark: SparkSession, folder: str, wanted: Sequence[str] | None = None, substring: bool = False, pattern: str = "*.txt") -> DataFrame:
    """All records of the submission files of a folder: line_id, chunk_file, line_no (of its first line, from 1), raw_line.

    Files of any size are read in splits. Within a split lines are numbered as they come; the lines
    of the splits before it come from one count per split. A quoted value may hold line ends: its
    lines are one record. A record that runs over the end of a split (128 MB by default) is not
    joined, so its lines come out as broken quoting. Bytes that are no UTF-8 become replacement
    characters. The empty text behind the last line end is no line.
    """
    texts = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(folder)
    raw = texts.select(
        F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_name").alias("chunk_file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"), F.make_valid_utf8("value").alias("raw_line"),
    )
    own = raw.where(chosen(F.col("chunk_file"), wanted, substring))
    sizes = own.groupBy("__path", "__block").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy("__path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__path", "__block", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    placed = lookup_join(own.mapInArrow(_stitched, own.schema), starts, ["__path", "__block"], "inner")
    line_no = (F.col("__at") + F.col("__shift") + 1).cast("int")
    return placed.select(F.xxhash64("chunk_file", line_no - 1).alias("line_id"), "chunk_file", line_no.alias("line_no"), F.regexp_replace("raw_line", r"\r$", "").alias("raw_line"))


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, with those of one record joined. Only lines from an open quote on are held back."""
    held: pa.RecordBatch | None = None

    def joined(lines: pa.RecordBatch) -> pa.RecordBatch:
        text = lines.column("raw_line")
        if not pc.any(pc.match_substring(text, '"')).as_py():
            return lines
        parts = []
        for of in _runs(lines):
            values = of.column("raw_line").to_pylist()
            records = reject.joined_records([None if v is None else v.encode() for v in values])
            first = of.take(pa.array([at for at, _ in records], pa.int64()))
            whole = pa.array(["\n".join(v or "" for v in values[at : at + n]) if n > 1 else values[at] for at, n in records], pa.string())
            parts.append(first.set_column(first.schema.get_field_index("raw_line"), "raw_line", whole))
        return pa.concat_batches(parts)

    for batch in batches:
        given = batch if held is None else pa.concat_batches([held, batch])
        keep = _held_from(given)
        held = given.slice(keep) if keep < len(given) else None
        if keep:
            yield joined(given.slice(0, keep))
    if held is not None:
        yield joined(held)


def _runs(lines: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of one file and split."""
    split = pc.binary_join_element_wise(lines.column("__path"), lines.column("__block").cast(pa.string()), "\n")
    for a, b in _edges(split.to_pylist()):
        yield lines.slice(a, b - a)


def _edges(keys: list[str]) -> list[tuple[int, int]]:
    at = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
    return [(a, b) for a, b in zip(at, at[1:]) if b > a]


def _held_from(lines: pa.RecordBatch) -> int:
    """Place of the first line whose record may go on in the next batch: an open one without a later lone quote."""
    quotes = [k for k, q in enumerate(pc.match_substring(lines.column("raw_line"), '"').to_pylist()) if q]
    if not quotes:
        return len(lines)
    last = quotes[-1]
    return last if reject.opens(lines.column("raw_line")[last].as_py().encode()) else len(lines)


def read_chunks(spark: SparkSession, folder: str, wanted: Sequence[str] | None = None, substring: bool = False, required: Sequence[str] = (), policy: str = "warn") -> tuple[DataFrame, DataFrame]:
    """Records of the submission files of a folder, and the lines that cannot be read with reasons.

    Columns come in any order, further ones are ignored. Blank lines are left out. Only lines that
    cannot be read are refused (no header, wrong field count, broken quoting); values are for the
    checks to judge. All lines of a file whose header is empty, names a column twice or lacks
    ``required`` ones are refused; ``policy`` fail raises at such a file instead.
    """
    lines = read_lines(spark, folder, wanted, substring).where((F.trim("raw_line") != "") | (F.col("line_no") == 1))
    problems = checkpointed(reject.header_problems(lines, required))
    if policy == "fail" and (bad := problems.orderBy("chunk_file").first()):
        raise ValueError(f"{bad.chunk_file}: {bad.problem}")
    marked = lookup_join(lines, problems, ["chunk_file"])
    good, bad_lines = marked.where("problem is null").drop("problem"), marked.where("problem is not null and line_no > 1")
    refused = bad_lines.select("line_id", "chunk_file", "line_no", F.col("problem").alias("reasons"))
    return reject.typed_records(good, {}), reject.rejected_lines(good, {}).unionByName(refused)


def read_wide(spark: SparkSession, path: str | Sequence[str], header: Sequence[str] | None = None, required: Sequence[str] = ALL, sep: str = "\t") -> DataFrame:
    """Files of one header as a table of text columns, cells trimmed, blanks as null.

    Splits large files. Short rows are padded with null. Without ``header`` the files' own first
    lines name the columns. Names are checked: required ones there, none twice.
    """
    reader = spark.read.option("sep", sep).option("quote", "").option("mode", "PERMISSIVE").option("enforceSchema", "true")
    if header is None:
        raw = reader.option("header", "true").csv(path)
    else:
        raw = reader.option("header", "true").schema(", ".join(f"`{h}` string" for h in header)).csv(path)
    named = raw.toDF(*[undotted(c) for c in raw.columns])
    check_header(named.columns, required)
    return named.select(*[blank_to_null(F.col(c)).alias(c) for c in named.columns])


def union_wide(parts: Sequence[DataFrame], columns: Sequence[str] = ALL) -> DataFrame:
    """Tables of different headers as one, by name; missing columns are null, others left out."""
    result = None
    for p in parts:
        own = p.select(*[c for c in columns if c in p.columns])
        result = own if result is None else result.unionByName(own, allowMissingColumns=True)
    if result is None:
        raise ValueError("no tables")
    return result.select(*[F.col(c) if c in result.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Single-cell contigs from CSV, gzip included, all columns as text."""
    return spark.read.option("header", "true").csv(path)
