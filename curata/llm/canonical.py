"""Mapping of freely typed names to the entries of a reference list.

The entries and their alias spellings form one trie, which is searched with a Levenshtein
automaton: next to each trie node runs the row of edit costs over the typed text. Letters may be
edited (substituted, dropped, doubled, swapped) within a distance that depends on the length of
the path; digits and allele letters must agree, but for look-alikes such as l for 1. Separators
are free. Names of other gene families are in the trie too and claim what is closer to them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.session import checkpointed, lookup_join

#: Largest reference list that is sent to the tasks.
MAX_ENTRIES = 100_000

#: Look-alikes of digits, and letters that stand for others.
LOOKALIKES = {"l": "1", "i": "1", "|": "1", "o": "0", "z": "2"}
GREEK_LETTERS = str.maketrans({"α": "a", "β": "b", "γ": "g", "δ": "d", "ß": "b"})

PLAIN_TAIL = re.compile(r"[\W_]*")

INF = 99

#: Largest limit of an entry.
LIVE = 3

#: Long runs of one separator; three of them read as any more do.
RUNS = re.compile(r"([^\w|]|_)\1{3,}")


class Symbol(NamedTuple):
    """One step of a trie path: letter, exact letter, digit, break between numbers, or any number."""

    kind: str
    char: str = ""
    first: bool = False  # first digit of its group
    last: bool = True  # last digit of its group


def path_of(spelling: str, strict_breaks: bool, exact_small: bool = True) -> list[Symbol]:
    """Symbols of a spelling; ``#`` stands for any number. Small letters after capitals are exact if asked."""
    path: list[Symbol] = []
    for part in re.findall(r"\d+|[^\W\d_]|#|(?:[^\w#]|_)+", spelling):
        if part.isdigit():
            if path and path[-1].kind == "digit" and strict_breaks:
                path.append(Symbol("break"))
            path += [Symbol("digit", c, k == 0, k == len(part) - 1) for k, c in enumerate(part)]
        elif part == "#":
            path += [Symbol("break")] * bool(path and path[-1].kind in ("number", "digit")) + [Symbol("number")]
        elif part.isalpha():
            path.append(Symbol("letter", part))
    capitals = False
    for k, s in enumerate(path):
        if s.kind == "letter":
            exact = exact_small and capitals and s.char.islower() and all(x.kind != "digit" for x in path[k:])
            path[k] = Symbol("exact" if exact else "letter", s.char.lower())
            capitals = s.char.isupper()
    return path


class Vocabulary:
    """What is known about a kind of names beside the list itself. This one knows nothing.

    ``decorations`` are words that say nothing about which entry is meant, ``prefixes`` short ones
    that may be written onto a name.
    """

    decorations: Sequence[str] = ()
    prefixes: Sequence[str] = ()
    exact_small = False  # whether small letters right behind capitals, as of an allele, must agree

    def spellings(self, name: str) -> list[str]:
        """Alias spellings of a listed name, itself first."""
        return [name]

    def tail(self, name: str) -> re.Pattern[str]:
        """What may follow a name without changing which entry it means."""
        return PLAIN_TAIL

    def strict_breaks(self, name: str) -> bool:
        """Whether numbers of the name must stay apart."""
        return True

    def others(self, names: Sequence[str]) -> list[tuple[str, re.Pattern[str]]]:
        """Spellings (``#`` for any number) of names that none of ``names`` belongs to, with their tails."""
        return []

    def lead(self, names: Sequence[str]) -> int:
        """By how many edits another family must be closer to claim a name."""
        return 0


class ReceptorVocabulary(Vocabulary):
    """Receptor genes and MHC alleles. Nothing here depends on which of them are listed."""

    # Words around names, species prefixes, spellings of gene families and of beta-2 microglobulin.
    decorations = ["human", "mouse", "gene", "allele", "segment", "chain", "light", "imgt", "homo sapiens", "mus musculus", "mhc-ii", "mhc-i", "mhc class ii", "mhc class i", "(f)", "(beta)", "(alpha)", "(orf)", "(p)"]
    prefixes = ["h", "hu", "hs", "m", "mo", "mm"]
    exact_small = True
    GREEK = {"a": "alpha", "b": "beta", "g": "gamma", "d": "delta"}
    ALIASES = {"B2M": ["B2M", "beta 2 microglobulin", "microglobulin beta 2", "b2 microglobulin", "b2 microglob", "beta 2 m"]}

    # Gene families that a typed name may mean instead, with the digit groups they take.
    OTHER_LOCI = {"TRA": "V D J".split(), "TRB": "V D J".split(), "IGH": "V D J".split(), "IGK": "V J".split(), "IGL": "V J".split()}
    SINGLE_NUMBER_LOCI = {"TRG": "V J".split(), "TRD": "V D J".split()}
    OTHER_MHC = ["HLA-A", "HLA-B", "HLA-C", "HLA-E", "HLA-F", "HLA-G", "HLA-DRA", "HLA-DQA1", "HLA-DPA1", "HLA-DRB1", "HLA-DRB2", "HLA-DRB3", "HLA-DRB4", "HLA-DRB5", "HLA-DQB1", "HLA-DPB1", "H2-M"]

    RECEPTOR = re.compile(r"(TR[ABGD])([VDJ])(.*)", re.DOTALL)
    RECEPTOR_TAIL = re.compile(r"\W*(?:\*\s*[\dilo]{2,3}(?::[\dilo]{2,3})*)?[\W_]*")
    MHC_TAIL = re.compile(r"(?:[\W_]+[\dilo]{3}|[\W_]*[\dilo]{2})*[a-z]?[\W_]*")

    def spellings(self, name: str) -> list[str]:
        if name in self.ALIASES:
            return self.ALIASES[name]
        if m := self.RECEPTOR.fullmatch(name):
            locus, segment, rest = m.groups()
            chain = locus[-1]
            families = [f"TR{chain}{segment}", f"TCR{chain}{segment}", f"{chain}{segment}", f"{segment} {self.GREEK[chain.lower()].upper()}", f"{segment}{chain}"]
            return [f + rest for f in families]
        if name.startswith("HLA-"):
            return [name, name[4:]]
        if name.startswith("H2-"):
            return [name, name[3:]]
        return [name]

    def tail(self, name: str) -> re.Pattern[str]:
        return self.RECEPTOR_TAIL if self.RECEPTOR.fullmatch(name) else self.MHC_TAIL if name.startswith("HLA-") else PLAIN_TAIL

    def strict_breaks(self, name: str) -> bool:
        return self.tail(name) is self.RECEPTOR_TAIL

    def others(self, names: Sequence[str]) -> list[tuple[str, re.Pattern[str]]]:
        own = {m.group(1) + m.group(2) for n in names if (m := self.RECEPTOR.fullmatch(n))}
        found = []
        for loci, shapes in ((self.OTHER_LOCI, ("#", "#-#")), (self.SINGLE_NUMBER_LOCI, ("#",))):
            for locus, segments in loci.items():
                for segment in segments:
                    if own and locus + segment not in own:
                        found += [x for s in shapes for x in (self.spellings(f"{locus}{segment}{s}") if locus[:2] == "TR" else [f"{locus}{segment}{s}"])]
        if any(n.startswith("HLA-") for n in names):
            found += [x + tail for f in self.OTHER_MHC for x in (f, f[4:]) if len(x) > 2 for tail in ("*#", "*#:#")]
        return [(x, self.MHC_TAIL if "*" in x else self.RECEPTOR_TAIL) for x in found]

    def lead(self, names: Sequence[str]) -> int:
        # A field of one receptor chain speaks for that chain: another family must lead by more.
        return 1 if any(self.RECEPTOR.fullmatch(n) for n in names) else 0


class NameTrie:
    """Trie of listed names and aliases, searched by edit distance."""

    def __init__(self, entries: Sequence[tuple[int, str]], vocabulary: Vocabulary | None = None, aliases: Sequence[tuple[int, str]] = ()) -> None:
        """``entries`` are the listed names, ``aliases`` further spellings of them, by name_id."""
        self.root: dict = {}
        v = vocabulary or ReceptorVocabulary()
        names = [n for _, n in entries]
        self.prefixes, self.lead = v.prefixes, v.lead(names)
        for name_id, name in [*entries, *aliases]:
            for spelling in v.spellings(name):
                self._add(path_of(spelling, v.strict_breaks(name), v.exact_small), name_id, v.tail(name))
        for spelling, tail in v.others(names):
            self._add(path_of(spelling, strict_breaks=True), 0, tail)
        words = sorted(map(re.escape, v.decorations), key=len, reverse=True)
        self.decoration = re.compile(r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])" if words else r"(?!)")

    def _add(self, path: list[Symbol], name_id: int, tail: re.Pattern[str]) -> None:
        node = self.root
        for symbol in path:
            node = node.setdefault(symbol, {})
        letters = sum(s.kind == "letter" for s in path)
        limit = 1 if letters <= 3 else 2 if letters <= 11 else 3
        node.setdefault("ends", []).append((name_id, limit, tail))

    def matches(self, typed: str) -> dict[int, int]:
        """Entries within their distance of ``typed`` and the distance; 0 stands for other families."""
        text = self.decoration.sub(" ", typed.lower().translate(GREEK_LETTERS).replace("–", "-").replace("\xa0", " "))
        text = RUNS.sub(r"\1\1\1", text.strip().lstrip("'\"([{<").strip())
        found: dict[int, int] = {}
        for prefix in ["", *self.prefixes]:
            if text.startswith(prefix):
                self._search(text[len(prefix) :].lstrip(" -_'\"\t"), found)
        return found

    def _search(self, text: str, found: dict[int, int]) -> None:
        """Rows hold the costs up to the last live one (3 at most, as is every limit); beyond it none is live."""
        n = len(text)
        letter = [c.isalpha() for c in text]
        free = [not c.isalnum() for c in text]
        number = [LOOKALIKES.get(c, c) for c in text]
        tails: dict[tuple[int, int], bool] = {}

        def spread(row: list[int], insert: bool) -> list[int]:
            j = 0
            while j < n and j < len(row):
                step = row[j] + (0 if free[j] else 1 if insert and letter[j] else INF)
                if j + 1 == len(row):
                    if step > LIVE:
                        break
                    row.append(step)
                elif step < row[j + 1]:
                    row[j + 1] = step
                j += 1
            return live(row)

        def live(row: list[int]) -> list[int]:
            while row and row[-1] > LIVE:
                row.pop()
            return row

        def run(new: list[int], row: list[int], within: Callable[[int], bool]) -> None:
            """One or more characters of a kind at no cost."""
            for j in range(n):
                if j + 1 == len(new):
                    if new[j] > LIVE:
                        break
                    new.append(INF)
                if within(j):
                    new[j + 1] = min(row[j] if j < len(row) else INF, new[j])

        def visit(node: dict, row: list[int], before: list[int] | None, last: Symbol | None) -> None:
            for name_id, limit, tail in node.get("ends", ()):
                for j, cost in enumerate(row):
                    if cost <= limit and cost < found.get(name_id, INF):
                        key = (id(tail), j)
                        if key not in tails:
                            tails[key] = tail.fullmatch(text, j) is not None
                        if tails[key]:
                            found[name_id] = cost
            for symbol, child in node.items():
                if symbol == "ends":
                    continue
                kind, char = symbol.kind, symbol.char
                lone = last is not None and last.kind == "digit" and last.first and last.last
                swaps = before is not None and last is not None and (last.kind == "letter" or lone)
                # A step takes one character more, a swap two more than the row before; the rest is run through below.
                top = min(n, max(len(row), len(before) + 1 if swaps else 0))
                padded = row + [INF] * (top + 1 - len(row))
                new = [INF] * (top + 1)
                if kind == "letter":
                    new[0] = padded[0] + 1
                    for j in range(1, top + 1):
                        c = text[j - 1]
                        best = padded[j] + 1
                        if c == char or (char in "ilo" and number[j - 1] == LOOKALIKES[char]):
                            best = min(best, padded[j - 1])
                        elif letter[j - 1]:
                            best = min(best, padded[j - 1] + 1)
                        if swaps and 1 < j < len(before) + 2 and c == last.char and text[j - 2] == char:
                            best = min(best, before[j - 2] + 1)
                        new[j] = best
                    spread(new, insert=True)
                elif kind == "exact":
                    for j in range(1, top + 1):
                        if text[j - 1] == char:
                            new[j] = padded[j - 1]
                    spread(new, insert=False)
                elif kind == "digit":
                    source = padded
                    if symbol.first and char != "0":
                        source = padded[:]
                        for j in range(n):
                            if j + 1 == len(source):
                                if number[j] != "0" or source[j] > LIVE:
                                    break
                                source.append(INF)
                            if number[j] == "0" and source[j] < source[j + 1]:
                                source[j + 1] = source[j]
                        top = min(n, max(top, len(source)))
                        source += [INF] * (top + 1 - len(source))
                        new += [INF] * (top + 1 - len(new))
                    for j in range(1, top + 1):
                        if number[j - 1] == char:
                            new[j] = source[j - 1]
                        if swaps and not lone and symbol.first and symbol.last and 1 < j < len(before) + 2 and text[j - 1] == last.char and number[j - 2] == char:
                            new[j] = min(new[j], before[j - 2] + 1)
                    if symbol.last:
                        spread(new, insert=False)
                elif kind == "break":
                    run(new, padded, lambda j: free[j] or text[j] == "s")
                else:
                    run(new, padded, lambda j: text[j].isdigit())
                    spread(new, insert=False)
                if live(new):
                    visit(child, new, row, symbol)

        visit(self.root, spread([0], insert=True), None, None)

    def resolve(self, typed: str) -> tuple[int, int]:
        """The entry that ``typed`` means and its distance; (0, -1) if none or several are closest."""
        return self.chosen(self.matches(typed))

    def chosen(self, found: dict[int, int]) -> tuple[int, int]:
        """The one entry of ``matches`` that is meant."""
        other, found = found.get(0, INF), {e: cost for e, cost in found.items() if e}
        if not found:
            return 0, -1
        least = min(found.values())
        closest = [e for e, cost in found.items() if cost == least]
        if (other < least and (other == 0 or other + self.lead < least)) or len(closest) > 1:
            return 0, -1
        return closest[0], least


def canonical_names(
    records: DataFrame,
    names: DataFrame,
    fields: Sequence[str],
    id_column: str = "record_id",
    vocabulary: Vocabulary | None = None,
) -> DataFrame:
    """The listed entry of every typed value that is not itself, character for character, listed.

    Result: ``id_column``, field_name, typed, name_id, distance, within. name_id is 0 and distance -1 for
    values that mean no entry or are equally close to several (unmatched values). A listed name in
    finer detail means its entry; a gene or allele that is not listed means none. Null values give
    no row; empty ones are unmatched. ``within`` lists all entries within their distance, the
    closest first. Each distinct value is resolved once and joined back, so repeated rows cost
    nothing. ``names`` may have a column ``aliases`` (an array of further spellings); ``vocabulary``
    is what is known of this kind of names, by default that of receptor genes and MHC alleles.
    """
    found = names.where(F.col("field_name").isin(list(fields)) & F.col("canonical_name").isNotNull())
    further = F.col("aliases") if "aliases" in names.columns else F.array().cast("array<string>")
    rows = found.select("field_name", "name_id", "canonical_name", further.alias("aliases")).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} rows")
    entries: dict[str, list[tuple[int, str]]] = {f: [] for f in fields}
    aliases: dict[str, list[tuple[int, str]]] = {f: [] for f in fields}
    for field, name_id, name, more in sorted(rows, key=lambda r: r[:3]):
        entries[field].append((name_id, name))
        aliases[field] += [(name_id, a) for a in more or ()]

    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("typed")) for f in fields]))
    listed = found.select("field_name", F.col("canonical_name").alias("typed")).distinct()
    typed = (
        records.select(F.col(id_column), each.alias("v"))
        .select(id_column, "v.field_name", "v.typed")
        .where("typed is not null")
        .join(F.broadcast(listed), ["field_name", "typed"], "left_anti")
    )

    within = pa.list_(pa.struct([("name_id", pa.int64()), ("distance", pa.int32())]))

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {f: NameTrie(e, vocabulary, aliases[f]) for f, e in entries.items()}
        for batch in batches:
            field, text = batch.column("field_name").to_pylist(), batch.column("typed").to_pylist()
            found = [tries[f].matches(t) for f, t in zip(field, text)]
            best = [tries[f].chosen(m) for f, m in zip(field, found)]
            every = [[{"name_id": e, "distance": c} for c, e in sorted((c, e) for e, c in m.items() if e)] for m in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("field_name"), batch.column("typed"), pa.array([e for e, _ in best], pa.int64()), pa.array([c for _, c in best], pa.int32()), pa.array(every, within)],
                ["field_name", "typed", "name_id", "distance", "within"],
            )

    distinct = typed.groupBy("field_name", "typed").agg(F.count("*").alias("n")).select("field_name", "typed")
    # The values are few bytes but much work each, so they are spread by number, not by size.
    spread = distinct.repartition(records.sparkSession.sparkContext.defaultParallelism, "typed")
    resolved = spread.mapInArrow(
        resolve, "field_name string, typed string, name_id bigint, distance int, within array<struct<name_id: bigint, distance: int>>"
    )
    return lookup_join(typed, checkpointed(resolved), ["field_name", "typed"], "inner")
