"""Loading of submission lines: valid rows as typed records, the rest apart with their reasons.

Structural indexing: the bytes of a whole Arrow batch are scanned at once. Quote masks and the
parity of the quotes before a byte tell which tabs delimit fields; only records whose quotes do not
fit that picture (a quote inside a plain field, or a broken quote) go through a small automaton.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions import validate
from curata.schema import ALL, EXTRA, dotted
from curata.session import lookup_join

TAB, QUOTE, CR = 9, 34, 13

#: Checked fields of a submission line: file name, and the check that may refuse it.
CHECKED = {
    "cdr3.beta": validate.sequence_ok,
    "mhc.a": validate.mhc_ok,
    "species": validate.species_ok,
    "reference.id": validate.reference_ok,
}


def split_quoted(line: bytes) -> tuple[list[bytes], bool]:
    """Fields of one line and whether its quotes are sound, by a byte-wise automaton."""
    fields: list[bytes] = []
    at, sound = 0, True
    while True:
        if line[at : at + 1] == b'"':
            close = at + 1
            while True:
                close = line.find(b'"', close)
                if close < 0:
                    return [*fields, line[at:]], False
                if line[close + 1 : close + 2] != b'"':
                    break
                close += 2
            stop = line.find(b"\t", close)
            stop = len(line) if stop < 0 else stop
            sound &= stop == close + 1
        else:
            stop = line.find(b"\t", at)
            stop = len(line) if stop < 0 else stop
        fields.append(line[at:stop])
        if stop == len(line):
            return fields, sound
        at = stop + 1


def index_lines(lines: pa.StringArray) -> tuple[pa.ListArray, np.ndarray]:
    """Fields of each line (trimmed, unquoted) and whether its quotes are sound."""
    lines = pc.fill_null(lines, "").cast(pa.large_string())
    lines = lines.combine_chunks() if isinstance(lines, pa.ChunkedArray) else lines
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + n + 1]
    base = int(offsets[0])
    raw = lines.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[base : int(offsets[-1])] if raw else np.empty(0, np.uint8)
    start, end = offsets[:-1] - base, offsets[1:] - base
    while len(data) and (cr := (end > start) & (data[np.maximum(end - 1, 0)] == CR)).any():
        end = end - cr

    special = np.flatnonzero((data == TAB) | (data == QUOTE))
    record = np.searchsorted(offsets[1:] - base, special, side="right")
    is_quote = data[special] == QUOTE
    quotes_before = np.cumsum(is_quote) - is_quote
    first = np.searchsorted(special, start)  # index of each record's first special byte
    before_record = np.append(quotes_before, is_quote.sum())[first]
    parity = (quotes_before - before_record[record]) & 1

    at, of = special[is_quote], record[is_quote]
    opening = parity[is_quote] == 0
    padded = np.concatenate(([TAB], data, [TAB]))
    previous = np.where(at == start[of], TAB, padded[at])
    following = np.where(at + 1 == end[of], TAB, padded[at + 2])
    beside = np.where(opening, previous, following)
    odd = np.zeros(n, bool)
    odd[of[(beside != TAB) & (beside != QUOTE)]] = True
    odd |= (np.bincount(of, minlength=n) & 1).astype(bool)

    delimiter = special[~is_quote & (parity == 0)]
    owner = record[~is_quote & (parity == 0)]
    counts = np.bincount(owner, minlength=n) + 1
    field_start, field_end = np.sort(np.concatenate((start, delimiter + 1))), np.sort(np.concatenate((delimiter, end)))
    keep = np.ones(len(data), bool)
    keep[delimiter] = False
    cut = end < offsets[1:] - base  # line ends in CR
    edges = np.bincount(end[cut], minlength=len(data) + 1) - np.bincount((offsets[1:] - base)[cut], minlength=len(data) + 1)
    keep[np.cumsum(edges)[: len(data)] > 0] = False
    value_offsets = np.concatenate(([0], np.cumsum(field_end - field_start)))
    values = pa.Array.from_buffers(
        pa.large_string(), len(field_start), [None, pa.py_buffer(value_offsets.astype(np.int64).tobytes()), pa.py_buffer(data[keep].tobytes())]
    )
    sound = ~odd
    fields = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int64()), _plain(values))
    if odd.any():
        where = np.flatnonzero(odd)
        split = [split_quoted(data[start[k] : end[k]].tobytes()) for k in where]
        sound[where] = [ok for _, ok in split]
        own = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum([len(f) for f, _ in split]))), pa.int64()),
            _plain(pa.array([v.decode("utf-8", "replace") for f, _ in split for v in f], pa.large_string())),
        )
        take = np.arange(n)
        take[where] = n + np.arange(len(where))
        fields = pa.concat_arrays([fields, own]).take(pa.array(take))
    return fields.cast(pa.list_(pa.string())), sound


def opens(line: bytes) -> bool:
    """Whether a line ends inside a quoted value that it opened."""
    fields, sound = split_quoted(line)
    last = fields[-1]
    return not sound and last.startswith(b'"') and re.fullmatch(rb'"(?:[^"]|"")*', last) is not None


def joined_records(lines: list[bytes | None]) -> list[tuple[int, int]]:
    """Records of consecutive lines, as first line and number of lines.

    A line that ends inside a quoted value goes on with the lines up to the next one that holds a
    lone quote. If what is joined so is sound, it is one record; else the quoting of its first line
    is broken, and that line stands by itself. Each line is looked at twice at most.
    """
    records: list[tuple[int, int]] = []
    at, n = 0, len(lines)
    while at < n:
        size, line = 1, lines[at]
        if line is not None and b'"' in line and opens(line):
            stop = at + 1
            while stop < n and (lines[stop] is None or b'"' not in lines[stop].replace(b'""', b"")):
                stop += 1
            if stop < n and split_quoted(b"\n".join(x or b"" for x in lines[at : stop + 1]).rstrip(b"\r"))[1]:
                size = stop + 1 - at
        records.append((at, size))
        at += size
    return records


def _plain(values: pa.Array) -> pa.Array:
    """Values without surrounding quotes and blanks, doubled quotes made single."""
    quoted = pc.starts_with(values, '"')
    if pc.any(quoted).as_py():
        inner = pc.utf8_slice_codeunits(values, 1, 2**31 - 1)
        inner = pc.if_else(pc.ends_with(inner, '"'), pc.utf8_slice_codeunits(inner, 0, -1), inner)
        values = pc.if_else(quoted, pc.replace_substring(inner, '""', '"'), values)
    return pc.utf8_trim_whitespace(values)


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``lines`` (line_id, chunk_file, line_no, raw_line) with its fields and quote check, row by row."""
    schema = "line_id bigint, chunk_file string, line_no int, fields array<string>, quotes_ok boolean"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields, sound = index_lines(batch.column("raw_line"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("line_id"), batch.column("chunk_file"), batch.column("line_no"), fields, pa.array(sound)],
                ["line_id", "chunk_file", "line_no", "fields", "quotes_ok"],
            )

    given = lines.select(
        F.col("line_id").cast("bigint"), "chunk_file", F.col("line_no").cast("int"), F.col("raw_line").cast("string")
    )
    return given.mapInArrow(parse, schema)


def header_problems(lines: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Files whose header cannot be used: chunk_file, problem.

    A header must be there (line 1), name no column twice and name all ``required`` ones.
    """
    files = lines.select("chunk_file").distinct()
    heads = parsed_lines(lines.where("line_no = 1")).groupBy("chunk_file").agg(F.min_by("fields", "line_id").alias("header"))
    known = F.filter("header", lambda c: c != "")
    missing = F.array_except(F.array(*[F.lit(dotted(c)) for c in required]), "header") if required else F.array().cast("array<string>")
    problem = F.concat_ws(
        "; ",
        F.when(F.coalesce(F.size(known), F.lit(0)) <= 0, "no header"),
        F.when(F.size(F.array_distinct(known)) < F.size(known), "duplicate columns"),
        F.when((F.size(known) > 0) & (F.size(missing) > 0), F.concat(F.lit("missing columns: "), F.array_join(missing, ", "))),
    )
    return files.join(heads, "chunk_file", "left").select("chunk_file", problem.alias("problem")).where("problem <> ''")


def checked_lines(lines: DataFrame, checks: Mapping[str, Callable[[Column], Column]] = CHECKED) -> DataFrame:
    """All lines other than headers with their header, fields and reasons for rejection.

    Result: line_id, chunk_file, line_no, header, fields, reasons (empty for a valid line).

    Reasons are ``no header``, ``broken quoting``, ``field count`` (not counted where the quoting is
    broken) and ``bad <field>``. A null
    line counts as an empty one. A file's header is its line 1 (of several, the one with the
    smallest line_id); a checked column that the header lacks counts as blank. Repeated lines are
    all kept. An empty table gives an empty result; further input columns are ignored. ``checks``
    may be left empty, so that only lines that cannot be read are refused.
    """
    headers = (
        parsed_lines(lines.where("line_no = 1"))
        .groupBy("chunk_file")
        .agg(F.min_by("fields", "line_id").alias("header"))
        .withColumn("at", F.create_map(*[x for c in CHECKED for x in (F.lit(c), F.array_position("header", c))]))
    )  # one row a file
    body = parsed_lines(lines.where("line_no <> 1 or line_no is null"))
    joined = lookup_join(body, headers, ["chunk_file"])

    def value(name: str) -> Column:
        v = F.get("fields", F.col("at")[name].cast("int") - 1)
        return F.when(v != "", v)

    count_ok = F.size("fields") == F.size("header")
    readable = count_ok & F.col("quotes_ok")
    reasons = [
        F.when(F.col("header").isNull(), "no header"),
        F.when(~count_ok & F.col("quotes_ok"), "field count"),
        F.when(~F.col("quotes_ok"), "broken quoting"),
        *[F.when(readable & ~check(value(name)), f"bad {name}") for name, check in checks.items()],
    ]
    return joined.select("line_id", "chunk_file", "line_no", "header", "fields", F.array_compact(F.array(*reasons)).alias("reasons"))


def rejected_lines(lines: DataFrame, checks: Mapping[str, Callable[[Column], Column]] = CHECKED) -> DataFrame:
    """Lines that cannot be read, with their reasons."""
    return checked_lines(lines, checks).where(F.size("reasons") > 0).select(
        "line_id", "chunk_file", "line_no", F.array_join("reasons", "; ").alias("reasons")
    )


def typed_records(lines: DataFrame, checks: Mapping[str, Callable[[Column], Column]] = CHECKED) -> DataFrame:
    """Valid lines as records: one column per known field (blank as null), in any column order."""
    known = F.map_from_arrays(
        F.transform("header", lambda h, i: F.concat(h, F.when(F.array_position("header", h) != i + 1, i.cast("string")).otherwise(""))),
        F.col("fields"),
    )
    rows = checked_lines(lines, checks).where(F.size("reasons") == 0).select("line_id", "chunk_file", "line_no", known.alias("v"))
    return rows.select(
        "line_id", "chunk_file", "line_no", *[F.when(F.col("v")[dotted(c)] != "", F.col("v")[dotted(c)]).alias(c) for c in EXTRA[:1] + ALL + EXTRA[1:]]
    )
