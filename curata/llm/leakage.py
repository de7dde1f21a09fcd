"""Evaluation texts inside training text.

Greedy string tiling: shared-token seeds (Karp-Rabin hashes over windows of words) lead to the
documents and items that match at all; for these the longest matches that do not overlap are
marked again and again, down to the least length, so passages are found in any order. The marked
part of the item is its coverage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.session import checkpointed, fits, lookup_join

WORD = re.compile(r"[^\W_]+")

#: Items, and bytes of their texts, that are sent to the tasks. More are joined by the hashes of their seeds.
SENT_ITEMS = 20_000
SENT_BYTES = 32 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Unbroken runs of letters and digits, lower case."""
    return WORD.findall((text or "").lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``width`` word ids, modulo 2**64."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = total * BASE + ids[k : k + n].astype(np.uint64)
    return total


class Items:
    """Evaluation items with their word ids and the hashes of all their windows."""

    def __init__(self, items: Sequence[tuple[int, str]], least: int) -> None:
        self.least = least
        self.vocabulary: dict[str, int] = {}
        self.words: list[np.ndarray] = []
        self.ids = [i for i, _ in items]
        hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for k, (_, text) in enumerate(items):
            words = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64)
            self.words.append(words)
            seeds = np.unique(rolling(words, least))
            hashes.append(seeds)
            owners.append(np.full(len(seeds), k))
        h, o = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(h, kind="stable")
        self.hashes, self.owners = h[order], o[order]

    def candidates(self, words: np.ndarray) -> set[int]:
        """Positions of the items that share a seed with a document."""
        windows = rolling(words, self.least)
        if not len(windows) or not len(self.hashes):
            return set()
        known = np.convolve(words == 0, np.ones(self.least, np.int64))[self.least - 1 : len(words)] == 0
        windows = np.unique(windows[known])
        left, right = np.searchsorted(self.hashes, windows, "left"), np.searchsorted(self.hashes, windows, "right")
        return {int(self.owners[j]) for a, b in zip(left, right) for j in range(a, b)}


def tiles(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Longest non-overlapping common runs of at least ``least`` words: (text at, item at, length).

    Longest first; among equally long ones the first in the text, then in the item.
    """
    free_text, free_item = np.ones(len(text), bool), np.ones(len(item), bool)
    found: list[tuple[int, int, int]] = []
    while True:
        seeds: dict[int, list[int]] = {}
        for j, h in enumerate(rolling(item, least).tolist()):
            if free_item[j : j + least].all():
                seeds.setdefault(h, []).append(j)
        best = (0, 0, 0)
        hashes = rolling(text, least)
        for i in np.flatnonzero(np.isin(hashes, np.fromiter(seeds, np.uint64, len(seeds)))).tolist():
            if not free_text[i : i + least].all():
                continue
            for j in seeds[int(hashes[i])]:
                n = 0
                while i + n < len(text) and j + n < len(item) and free_text[i + n] and free_item[j + n] and text[i + n] == item[j + n] and text[i + n]:
                    n += 1
                if n >= least and n > best[2]:
                    best = (i, j, n)
        if not best[2]:
            return found
        found.append(best)
        free_text[best[0] : best[0] + best[2]] = False
        free_item[best[1] : best[1] + best[2]] = False


def leaked(documents: DataFrame, items: DataFrame, least: int = 12, least_coverage: float = 0.0) -> DataFrame:
    """Documents that contain passages of evaluation items, and how much of each item.

    Result: doc_id, item_id, n_tiles, longest (words of the longest passage), covered (words of
    the item found), coverage (their share). A passage is ``least`` consecutive words or more, in
    any letter case; every such pair comes out if ``least_coverage`` is 0. Whole texts are read.
    Null, empty and short texts and items match nothing; of items that share their id each is
    matched by itself and the best covered one is kept.
    """
    given = items.where("item_text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), F.col("item_text").alias("text"))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    if fits(given, SENT_ITEMS, SENT_BYTES):
        result = _leaked_block(texts, sorted((r[0], r[1]) for r in given.collect()), least)
    else:
        result = _leaked_join(texts, given, least)
    best = F.max(F.struct("covered", "longest", "n_tiles", "coverage")).alias("m")
    return result.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.n_tiles", "m.longest", "m.covered", "m.coverage").where(F.col("coverage") >= least_coverage)


TILED = "n_tiles int, longest int, covered int, coverage double"


def winnowed(words: np.ndarray, least: int) -> np.ndarray:
    """Hashes of some windows of half of ``least`` words, chosen so that texts with ``least`` equal
    consecutive words share one: the smallest of every run of windows that such a passage holds."""
    half = (least + 1) // 2
    hashes, run = rolling(words, half), least - half + 1
    if len(hashes) < run:
        return np.empty(0, np.uint64)
    return np.unique(np.lib.stride_tricks.sliding_window_view(hashes, run).min(axis=1))


def _seeds(texts: DataFrame, key: str, least: int) -> DataFrame:
    """Chosen hashes of each text: ``key``, seed. Words are hashed alike in all tasks."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known: dict[str, int] = {}
        for batch in batches:
            owners, seeds = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                if len(known) > 1_000_000:
                    known.clear()
                ids = np.array([known.get(w) or known.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words], np.uint64)
                found = winnowed(ids, least)
                seeds.append(found)
                owners.append(np.full(len(found), k))
            own = pa.array(np.concatenate(owners) if owners else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(key).take(own), pa.array((np.concatenate(seeds) if seeds else np.empty(0, np.uint64)).view(np.int64))], [key, "seed"])

    return texts.mapInArrow(hashed, f"{key} bigint, seed bigint")


def _leaked_join(texts: DataFrame, items: DataFrame, least: int) -> DataFrame:
    """Leaks of any number of items: documents and items meet by their seeds, and only pairs that
    share one are tiled. The documents are read twice; shuffled are their seeds, about one for four
    words, and then the texts of the documents that are in a pair."""
    own = checkpointed(_seeds(items, "item_id", least).groupBy("seed").agg(F.collect_set("item_id").alias("items")))
    pairs = checkpointed(lookup_join(_seeds(texts, "doc_id", least), own, ["seed"], "inner").select("doc_id", F.explode("items").alias("item_id")).distinct())
    concerned = lookup_join(texts, pairs.groupBy("doc_id").agg(F.collect_set("item_id").alias("items")), ["doc_id"], "inner")
    each = concerned.select("doc_id", "text", F.explode("items").alias("item_id"))
    both = each.join(items.withColumnRenamed("text", "item_text"), "item_id")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, item_id, text, item_text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "text", "item_text"))):
                item = Items([(item_id, item_text)], least)
                words = np.array([item.vocabulary.get(w, 0) for w in words_of(text)], np.int64)
                rows += _row(doc_id, item, 0, words, least)
            yield _batch(rows)

    return both.mapInArrow(match, f"doc_id bigint, item_id bigint, {TILED}")


def _row(doc_id: int, items: Items, k: int, words: np.ndarray, least: int) -> list[tuple]:
    found = tiles(words, items.words[k], least)
    covered = sum(n for _, _, n in found)
    return [(doc_id, items.ids[k], len(found), max(n for _, _, n in found), covered, covered / len(items.words[k]))] if found else []


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "item_id", "n_tiles", "longest", "covered", "coverage"])


def _leaked_block(texts: DataFrame, block: list[tuple[int, str]], least: int) -> DataFrame:
    handle = texts.sparkSession.sparkContext.broadcast(block)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(handle.value, least)
        known = items.vocabulary.get
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = np.array([known(w, 0) for w in words_of(text)], np.int64)
                for k in sorted(items.candidates(words)):
                    rows += _row(doc_id, items, k, words, least)
            yield _batch(rows)

    return texts.mapInArrow(match, f"doc_id bigint, item_id bigint, {TILED}")
