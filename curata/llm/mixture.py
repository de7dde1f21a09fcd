"""Mixing sources to target shares of all tokens.

Low-discrepancy source schedule: van der Corput points mapped through the cumulative shares give a
sequence of slots in which every source appears evenly; each slot takes one block of equally many
tokens from its source. A source's texts, in a random but fixed order, form one stream of tokens,
run through again up to its cap of repeats; the blocks are consecutive stretches of that stream,
and a text that runs over the end of a block is divided between the two slots.

The first 2**k points are the multiples of 2**-k in bit-reversed order. So the slots of a source,
an interval of those multiples, are known by arithmetic: its n-th block goes to the slot whose
number is the reversed bits of the interval's start plus n. No schedule is drawn up or joined.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.session import checkpointed, fits

#: Bits of the least and the most slots of a schedule, and the tokens of a block in a large mix.
LEAST_BITS, MOST_BITS = 12, 40
BLOCK_TOKENS = 1 << 20

#: Texts in a part of a source's stream; each part is summed by one task.
PART_TEXTS = 250_000

# Fixed value: the split pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Longer texts are encoded in pieces cut at white space, which no token of the pattern crosses.
PIECE = 50_000

# Before a white space between two other characters.
CUT = re.compile(r"\S(?=\s\S)")


def _encoding(path: str):  # noqa: ANN202
    import base64
    import sys

    import tiktoken

    kept = sys.modules["tiktoken"].__dict__.setdefault("_curata_encodings", {})
    if path not in kept:
        if not os.path.isfile(path):
            raise FileNotFoundError(f"no vocabulary at {path}: name the file of a byte-level vocabulary that every executor can read")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        kept[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, each cut before a single white space.

    There the pattern starts anew, so the pieces have the tokens of the whole. Where no such place
    is within reach the piece runs on to the next.
    """
    at = 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def token_counts(documents: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keep`` columns, a 128-bit hash of each text, and its tokens of a public tokenizer.

    Null texts are left out; empty ones have no tokens.
    """
    types = {f.name: f.dataType.simpleString() for f in documents.schema}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(tokenizer)
        for batch in batches:
            counts = []
            for text in batch.column("text").to_pylist():
                counts.append(sum(len(encoding.encode_ordinary(piece)) for piece in pieces(text)))
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, batch.column("h1"), batch.column("h2"), pa.array(counts, pa.int64())], [*keep, "h1", "h2", "n_tokens"])

    given = documents.where("text is not null").select(*keep, "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), F.reverse("text")).alias("h2"))
    return given.mapInArrow(count, ", ".join(f"{c} {types[c]}" for c in keep) + ", h1 bigint, h2 bigint, n_tokens bigint")


def distinct_texts(counted: DataFrame) -> DataFrame:
    """One row per text, of any source: the one with the smallest doc_id."""
    return counted.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("d")).select("d.doc_id", "d.source", "d.n_tokens")


def streamed(texts: DataFrame, seed: int = 7, part_texts: int = PART_TEXTS) -> DataFrame:
    """Texts with their place in their source's stream of tokens (``at``) and the stream's length.

    The order is that of a hash of doc_id. Running sums are taken within parts of each source, and
    the parts' offsets from one row per part, so a source of a third of all texts is no single task.
    There are as many parts as the largest source needs at about ``part_texts`` each.
    """
    largest = texts.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(max((largest // part_texts).bit_length(), 3), 24)
    placed = texts.withColumn("rank", F.xxhash64(F.lit(seed), "doc_id")).withColumn("part", F.shiftrightunsigned("rank", 64 - bits))
    offsets = placed.groupBy("source", "part").agg(F.sum("n_tokens").alias("tokens"))
    # Parts follow the order of the rank as an unsigned number.
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source")
    offsets = offsets.select("source", "part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"), F.sum("tokens").over(whole).alias("length"))
    inside = Window.partitionBy("source", "part").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return running.join(offsets, ["source", "part"]).select("doc_id", "source", "n_tokens", (F.col("offset") + F.col("inner")).alias("at"), "length")


def intervals(shares: list[float], bits: int) -> list[tuple[int, int]]:
    """Start and number of the points of each source among 2**bits: its share to within one point, one at least."""
    points, total = 1 << bits, sum(shares)
    if points < len(shares):
        raise ValueError("fewer slots than sources")
    exact = [s / total * points for s in shares]
    counts = [max(int(e), 1) for e in exact]
    byneed = sorted(range(len(shares)), key=lambda k: (counts[k] - exact[k], k))
    for k in range(points - sum(counts)):
        counts[byneed[k % len(byneed)]] += 1
    while sum(counts) > points:
        counts[max(range(len(shares)), key=lambda k: counts[k])] -= 1
    starts = [sum(counts[:k]) for k in range(len(counts))]
    return list(zip(starts, counts))


def bits_for(shares: list[float], tokens: float) -> int:
    """Bits of the number of slots: the smallest share gets several, and a block is about BLOCK_TOKENS in a large mix."""
    bits = LEAST_BITS
    while bits < MOST_BITS and ((1 << bits) * min(shares) < 8 * sum(shares) or (tokens / BLOCK_TOKENS) > (1 << bits)):
        bits += 1
    return bits


def slot_number(point: Column, bits: Column) -> Column:
    """The slot of a point: its number with the bits reversed."""
    return F.conv(F.reverse(F.lpad(F.bin(point), bits, F.lit("0"))), 2, 10).cast("bigint")


def mixtures(lengths: dict[str, int], targets: list[tuple[str, str, float, int]]) -> list[tuple]:
    """For each mix and source: share among the sources that have tokens, slots, their first point, tokens per slot, bits.

    A mix is as large as its scarcest source allows within its cap of repeats. Sources without
    tokens (or with no share or repeats) get no slots; the others keep their shares relative to
    each other.
    """
    rows: list[tuple] = []
    for mix in sorted({t[0] for t in targets}):
        own = sorted(t[1:] for t in targets if t[0] == mix)
        usable = [(s, share, cap) for s, share, cap in own if lengths.get(s, 0) > 0 and share > 0 and cap > 0]
        total = sum(u[1] for u in usable)
        of, block, bits = {}, 0.0, LEAST_BITS
        if usable:
            weights = [u[1] for u in usable]
            bits = bits_for(weights, min(lengths[s] * cap / share for s, share, cap in usable) * total)
            spans = intervals(weights, max(bits, (len(usable) - 1).bit_length()))
            block = min(lengths[s] * cap / n for (s, _, cap), (_, n) in zip(usable, spans))
            of = {s: (share / total, n, start) for (s, share, _), (start, n) in zip(usable, spans)}
        rows += [(mix, s, float(share), float(of.get(s, (0.0,))[0]), int(cap), of[s][1] if s in of else 0, of[s][2] if s in of else 0, float(block), bits) for s, share, cap in own]
    return rows


PLAN = "mix_name string, source string, target_share double, share_among_present double, max_repeats int, n_slots bigint, first_point bigint, block_tokens double, bits int"


def _streams(documents: DataFrame, tokenizer: str, seed: int) -> DataFrame:
    return checkpointed(streamed(checkpointed(distinct_texts(token_counts(documents, tokenizer))), seed))


def _plan(streams: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per mix and source; ``targets`` is a table of settings and must fit a broadcast."""
    wanted = targets.select("mix_name", "source_name", "target_share", "max_repeats").dropna()
    if not fits(wanted):
        raise ValueError("the table of targets is larger than a broadcast")
    rows = [tuple(r) for r in wanted.collect()]
    named = F.broadcast(wanted.select(F.col("source_name").alias("source")).distinct())
    lengths = dict(streams.join(named, "source", "left_semi").groupBy("source").agg(F.first("length")).collect())  # one row per wanted source
    return streams.sparkSession.createDataFrame(mixtures(lengths, rows), PLAN)


def _chosen(streams: DataFrame, plan: DataFrame) -> DataFrame:
    """The part of each text in each block: ``nth`` block of its source, ``first_token`` (from 1) and ``n_tokens``."""
    uses = streams.where("n_tokens > 0").join(F.broadcast(plan.where("n_slots > 0")), "source").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("max_repeats"))))
    start, block = (F.col("copy") - 1) * F.col("length") + F.col("at"), F.col("block_tokens")
    placed = uses.withColumns({"start": start, "end": F.least(start + F.col("n_tokens"), F.floor(F.col("n_slots") * block))}).where("start < end")
    # Block n runs from token floor(n * block) on; rounding may put a text's ends one block off, which gives an empty part.
    last = F.least(F.floor(F.col("end") / block), F.col("n_slots") - 1)
    parts = placed.withColumn("nth", F.explode(F.sequence(F.greatest(F.floor(F.col("start") / block) - 1, F.lit(0)).cast("bigint"), last.cast("bigint"))))
    low = F.greatest(F.col("start"), F.floor(F.col("nth") * block))
    high = F.least(F.col("end"), F.floor((F.col("nth") + 1) * block))
    return parts.withColumns({"first_token": (low - F.col("start") + 1).cast("bigint"), "n_tokens": (high - low).cast("bigint")}).where("n_tokens > 0")


def mixed(documents: DataFrame, targets: DataFrame, tokenizer: str, seed: int = 7) -> DataFrame:
    """The selection of each mix, with its place in the schedule.

    Result: mix_name, slot, doc_id, source, copy (from 1), first_token (from 1), n_tokens. Sorted by
    slot it is the mix; every slot holds the same number of tokens (to within one). A text that
    runs over the end of a block has one row in each of the two slots. Equal texts count as one text,
    whatever their source, so none is used more often than its cap. Texts of sources that a mix
    does not name, and null or empty texts, are left out. Results depend only on the rows and
    ``seed``.
    """
    streams = _streams(documents, tokenizer, seed)
    slot = slot_number(F.col("first_point") + F.col("nth"), F.col("bits"))
    return _chosen(streams, _plan(streams, targets)).select("mix_name", slot.alias("slot"), "doc_id", "source", "copy", "first_token", "n_tokens")


def shares(documents: DataFrame, targets: DataFrame, tokenizer: str, seed: int = 7) -> DataFrame:
    """What each mix reaches: one row per mix and source it names.

    Result: mix_name, source, target_share, share_among_present (the target among the sources that
    have documents), reached_share, n_tokens, n_texts, most_repeats.
    """
    streams = _streams(documents, tokenizer, seed)
    plan = _plan(streams, targets)
    texts = _chosen(streams, plan).groupBy("mix_name", "source", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.max("copy").alias("copies"))
    sums = texts.groupBy("mix_name", "source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_texts"), F.max("copies").alias("most_repeats"))
    total = Window.partitionBy("mix_name")
    return (
        plan.join(sums, ["mix_name", "source"], "left")
        .withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
        .select(
            "mix_name", "source", "target_share", "share_among_present",
            F.coalesce(F.try_divide("n_tokens", F.sum("n_tokens").over(total)), F.lit(0.0)).alias("reached_share"),
            "n_tokens", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        )
    )
