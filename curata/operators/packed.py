"""Several values packed in one field: one row per value, with its position.

Expectation-maximisation segmentation. A lattice over the text of a field has an edge for each
listed value (with or without an allele suffix), for each run of delimiters and, dearly, for text
that is neither; a quoted span that is one value is a single edge. Value costs are minus log
frequencies, learned from the whole column by forward-backward expectations; Viterbi then picks
the likeliest path. So a listed value that contains a delimiter is kept whole or split into
two, by which of the three the column holds more often.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.session import checkpointed, work_partitions

#: Largest list of values that is sent to the tasks.
MAX_VALUES = 100_000

DELIMITERS = re.compile(r"(?:[\s,;|/&+\[\](){}<>\"'´`’“”]|\\n|\b(?:and|or)\b)+")
ALLELE = re.compile(r"\*\d{2,3}(?::\d{2,3})*[A-Z]?")
WORD = re.compile(r"[^\s,;|/&+\[\](){}<>\"']+|.", re.DOTALL)
QUOTED = re.compile(r"\"([^\"]*)\"|'([^']*)'|“([^”]*)”")
UNKNOWN_COST = 60.0
DELIMITER_COST = 0.5


def _both(a: float, b: float) -> float:
    """Logarithm of the sum of two probabilities given as logarithms."""
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


class Segmenter:
    """Segmentations of one field's texts into listed values, and the likeliest of them.

    ``weights`` are the expected counts of the listed names and, under None, of unlisted pieces.
    """

    def __init__(self, names: Sequence[str], weights: Mapping[str | None, float] | None = None) -> None:
        given = weights or {}
        total = sum(given.values()) + len(names) + 1
        self.cost = {n: -math.log((given.get(n, 0.0) + 1) / total) for n in names}
        self.unlisted = UNKNOWN_COST - math.log((given.get(None, 0.0) + 1) / total)
        self.lengths = sorted({len(n) for n in names}, reverse=True)
        self.memo: dict[str, list[tuple[str, str]]] = {}

    def value_at(self, text: str, at: int, stop: int) -> Iterator[tuple[int, float, str]]:
        """Listed values that start at ``at`` and end at a boundary: end, cost, name."""
        for n in self.lengths:
            name = text[at : at + n]
            if at + n > stop or name not in self.cost:
                continue
            ends = {at + n}
            if m := ALLELE.match(text, at + n, stop):
                ends.add(m.end())
            for end in ends:
                after = text[end : end + 1] if end < stop else ""
                if not (after.isalnum() or after in ("*", ":", "-")) or not after:
                    yield end, self.cost[name], name

    def edges_at(self, text: str, at: int) -> list[tuple[int, float, str | None, int, int]]:
        """Edges of the lattice from ``at``: end, cost, listed name (if any) and where the value stands."""
        size, edges = len(text), []
        if m := QUOTED.match(text, at):
            begin, stop = next(m.span(g) for g in (1, 2, 3) if m.span(g)[0] >= 0)
            left = begin + len(text[begin:stop]) - len(text[begin:stop].lstrip())
            right = begin + len(text[begin:stop].rstrip())
            edges = [(m.end(), c, n, left, e) for e, c, n in self.value_at(text, left, right) if e == right]
            if edges:
                return edges
        edges = [(end, cost, name, at, end) for end, cost, name in self.value_at(text, at, size)]
        if m := DELIMITERS.match(text, at):
            edges.append((m.end(), DELIMITER_COST, None, 0, 0))
            if m.end() - at > 1:
                edges.append((at + 1, DELIMITER_COST, None, 0, 0))
        if m := WORD.match(text, at):
            edges.append((m.end(), self.unlisted, None, -1, 0))
        return edges

    def segment(self, text: str) -> list[tuple[str, str]]:
        """Values of ``text`` in order by the likeliest segmentation (Viterbi): (as written, listed name)."""
        if text in self.memo:
            return self.memo[text]
        size = len(text)
        best: list[float] = [0.0] + [math.inf] * size
        back: list[tuple[int, str | None, int, int]] = [(0, None, 0, 0)] * (size + 1)
        for at in range(size):
            if best[at] == math.inf:
                continue
            for end, cost, name, begin, stop in self.edges_at(text, at):
                if best[at] + cost < best[end]:
                    best[end] = best[at] + cost
                    back[end] = (at, name, begin, stop)
        values: list[tuple[str, str]] = []
        at = size
        while at > 0:
            at, name, begin, stop = back[at]
            if name is not None:
                values.append((text[begin:stop], name))
        values.reverse()
        if len(self.memo) >= 200_000:
            self.memo.clear()
        self.memo[text] = values
        return values

    def expected(self, text: str) -> dict[str | None, float]:
        """Expected counts over all segmentations of ``text``, by their likelihoods (forward-backward):
        of each listed name, and under None of unlisted pieces."""
        size = len(text)
        ahead: list[float] = [0.0] + [-math.inf] * size
        edges: list[tuple[int, int, float, str | None, bool]] = []
        for at in range(size):
            if ahead[at] == -math.inf:
                continue
            for end, cost, name, begin, _ in self.edges_at(text, at):
                ahead[end] = _both(ahead[end], ahead[at] - cost)
                edges.append((at, end, cost, name, begin < 0))
        behind: list[float] = [-math.inf] * size + [0.0]
        counts: dict[str | None, float] = {}
        for at, end, cost, name, unlisted in reversed(edges):
            if behind[end] == -math.inf:
                continue
            behind[at] = _both(behind[at], behind[end] - cost)
            if name is not None or unlisted:
                share = math.exp(ahead[at] - cost + behind[end] - ahead[size])
                counts[name] = counts.get(name, 0.0) + share
        return counts


def _listed(names: DataFrame, fields: Sequence[str]) -> dict[str, list[str]]:
    """Listed values of each field; the list must have at most ``MAX_VALUES`` rows."""
    rows = names.where(F.col("field_name").isin(list(fields)) & F.col("canonical_name").isNotNull()).select("field_name", "canonical_name").distinct()
    found = rows.limit(MAX_VALUES + 1).collect()
    if len(found) > MAX_VALUES:
        raise ValueError(f"the list of values has more than {MAX_VALUES} rows")  # a list, not data
    listed: dict[str, list[str]] = {f: [] for f in fields}
    for field, name in found:
        listed[field].append(name)
    return {f: sorted(v) for f, v in listed.items()}


def _texts(records: DataFrame, id_column: str, fields: Sequence[str]) -> DataFrame:
    """All texts of the fields: id, field_name, text."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields]))
    return records.select(F.col(id_column).alias("id"), each.alias("v")).select("id", "v.field_name", "v.text").where(F.col("text").isNotNull())


def _candidates(texts: DataFrame) -> DataFrame:
    """Texts that could hold several values.

    Before another value, a value ends at a character that ``value_at`` takes as a boundary; a text
    without any such character holds one value at most.
    """
    return texts.where(F.col("text").rlike(r"[^\p{L}\p{N}*:\-]"))


def learned(texts: DataFrame, listed: dict[str, list[str]], rounds: int = 2) -> dict[str, dict[str | None, float]]:
    """Value frequencies of each field by expectation-maximisation over all its texts, those of one value too.

    Each round weighs every segmentation of every text by the frequencies so far (uniform at first)
    and sums the expected counts of listed values and of unlisted pieces. Equal texts are counted
    first and weighed once. One number per task and listed value leaves the tasks.
    """
    counted = texts.groupBy("field_name", "text").agg(F.count("*").alias("n"))
    distinct = checkpointed(counted.repartition(work_partitions(counted)))  # read every round
    weights: dict[str, dict[str | None, float]] = {f: {} for f in listed}
    for _ in range(rounds):
        given = weights

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            segmenters = {f: Segmenter(listed[f], given[f]) for f in listed}
            tally: dict[tuple[str, str | None], float] = {}
            for batch in batches:
                for field, text, n in zip(*[batch.column(c).to_pylist() for c in ("field_name", "text", "n")]):
                    for name, share in segmenters[field].expected(text).items():
                        tally[field, name] = tally.get((field, name), 0.0) + n * share
            yield pa.RecordBatch.from_pydict(
                {"field_name": [f for f, _ in tally], "name": [n for _, n in tally], "n": list(tally.values())},
                pa.schema([("field_name", pa.string()), ("name", pa.string()), ("n", pa.float64())]),
            )

        totals = distinct.mapInArrow(count, "field_name string, name string, n double").groupBy("field_name", "name").agg(F.sum("n"))
        weights = {f: {} for f in listed}
        for field, name, n in totals.collect():  # at most one row per listed value
            weights[field][name] = n
    return weights


def split_values(
    records: DataFrame,
    names: DataFrame,
    fields: Sequence[str],
    id_column: str = "record_id",
    rounds: int = 2,
) -> DataFrame:
    """One row per value of each field that holds two or more values.

    Result: ``id_column``, field_name, value_pos (from 1), value_text as written without blanks,
    quotes and brackets around it. A value is a listed name of the field, alone or with an allele
    suffix; text that is none takes no position. Empty pieces do not count, repeated values do.
    Null and empty fields, and fields with fewer than two values, give nothing; so does a field
    without a list. ``rounds`` of expectation-maximisation come before the final split.
    """
    listed = _listed(names, fields)
    texts = _texts(records, id_column, fields)
    weights = learned(texts, listed, rounds)
    id_type = records.schema[id_column].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenters = {f: Segmenter(listed[f], weights[f]) for f in listed}
        for batch in batches:
            source: list[int] = []
            position: list[int] = []
            value: list[str] = []
            for k, (field, text) in enumerate(zip(batch.column("field_name").to_pylist(), batch.column("text").to_pylist())):
                values = segmenters[field].segment(text)
                if len(values) > 1:
                    source += [k] * len(values)
                    position += range(1, len(values) + 1)
                    value += [v for v, _ in values]
            take = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("field_name").take(take), pa.array(position, pa.int32()), pa.array(value, pa.string())],
                ["id", "field_name", "value_pos", "value_text"],
            )

    return _candidates(texts).mapInArrow(split, f"id {id_type}, field_name string, value_pos int, value_text string").withColumnRenamed("id", id_column)
