"""Receptor sequences: translation, k-mer hits, repair and codon alignment, as column builders.

Everything is higher-order functions over short arrays, so it stays in the JVM and runs per row.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The genetic code in the order TCAG, TCAG, TCAG; fix types from best to worst.
BASES = "TCAG"
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
FIX_TYPES = ["NoFixNeeded", "FixTrim", "FixAdd", "FixReplace", "FailedBadSegment", "FailedReplace", "FailedNoAlignment"]
GOOD_FIXES = 4
MAX_REPLACED = 1

CODONS = dict(zip(map("".join, itertools.product(BASES, repeat=3)), CODE))


def translated(nt: Column, backwards: bool = False) -> Column:
    """Amino acids of a nucleotide text; incomplete codons are dropped at the end, or at the start
    if ``backwards``. A codon with N gives X, any other unknown codon gives ``?``."""
    frame = F.substring(nt, F.length(nt) % 3 + 1, F.length(nt)) if backwards else nt
    table = F.create_map(*[F.lit(x) for pair in CODONS.items() for x in pair])
    count = F.floor(F.length(frame) / 3).cast("int")
    codons = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda k: F.upper(F.substring(frame, k * 3 - 2, F.lit(3))))
    amino = F.transform(codons, lambda c: F.coalesce(table[c], F.when(c.contains("N"), "X").otherwise("?")))
    return F.when(count > 0, F.array_join(amino, "")).when(nt.isNotNull(), "")


def germline_v(seq: Column, ref: Column) -> Column:
    """Nucleotides of a variable segment from three before its reference point."""
    return F.substring(seq, ref - 2, F.length(seq))


def germline_j(seq: Column, ref: Column) -> Column:
    """Nucleotides of a joining segment up to four behind its reference point."""
    return F.substring(seq, F.lit(1), ref + 4)


def kmer_hit(segment: Column, cdr3: Column, least: int = 2) -> Column:
    """Longest run of ``cdr3`` that stands in ``segment``: struct(seg_pos, cdr_pos, size), null if none.

    Runs that reach the last residue are not tried. Of equally long runs the first in ``cdr3``
    holds, at its last place in ``segment``. Positions count from 0.
    """
    n = F.length(cdr3)

    def at(k: Column, j: Column) -> Column:
        run = F.reverse(F.substring(cdr3, j + 1, k))
        back = F.call_function("locate", run, F.reverse(segment))
        return F.struct(F.when(back > 0, F.length(segment) - k - back + 1).otherwise(-1).alias("seg_pos"), j.alias("cdr_pos"), k.alias("size"))

    # From the longest run that both can hold downwards; once one stands in the segment no other is tried.
    longest = F.least(n - 1, F.length(segment))
    none = F.lit(None).cast("struct<seg_pos: int, cdr_pos: int, size: int>")

    def step(found: Column, k: Column) -> Column:
        runs = F.filter(F.transform(F.sequence(F.lit(0), n - k - 1), lambda j: at(k, j)), lambda h: h["seg_pos"] >= 0)
        return F.coalesce(found, F.get(runs, F.lit(0)))

    return F.when(longest >= least, F.aggregate(F.reverse(F.sequence(F.lit(least), longest)), none, step))


def one_sided_fix(segment: Column, cdr3: Column, hit: Column) -> Column:
    """Repair of one end by a hit: struct(cdr3, fix_type, rank, x); both texts read from that end."""
    prefix = F.substring(segment, F.lit(1), hit["seg_pos"])
    rest = F.substring(cdr3, hit["cdr_pos"] + 1, F.length(cdr3))

    def result(text: Column, kind: int, x: Column) -> Column:
        return F.struct(text.alias("cdr3"), F.lit(FIX_TYPES[kind]).alias("fix_type"), F.lit(kind).alias("rank"), x.cast("int").alias("x"))

    return (
        F.when(segment.isNull() | (segment == ""), result(cdr3, 4, F.lit(-1)))
        .when(hit.isNull(), result(cdr3, 6, F.lit(-1)))
        .when((hit["seg_pos"] == 0) & (hit["cdr_pos"] == 0), result(cdr3, 0, hit["size"]))
        .when(hit["seg_pos"] == 0, result(rest, 1, hit["size"]))
        .when(hit["cdr_pos"] == 0, result(F.concat(prefix, cdr3), 2, hit["size"]))
        .when(hit["cdr_pos"] <= MAX_REPLACED, result(F.concat(prefix, rest), 3, hit["size"]))
        .otherwise(result(cdr3, 5, F.lit(-1)))
    )


def segment_candidates(segment_id: Column) -> Column:
    """Names under which a segment may be listed, in order of preference.

    The name itself, without its allele, and that up to its first hyphen; each as it is, with
    allele 01, and (if it has no hyphen) as member 1 to 100 of its family with allele 01.
    """
    plain = F.split_part(segment_id, F.lit("*"), F.lit(1))
    forms = F.array(segment_id, plain, F.split_part(plain, F.lit("-"), F.lit(1)))

    def spelled(name: Column) -> Column:
        family = F.transform(F.sequence(F.lit(1), F.lit(100)), lambda i: F.concat(name, F.lit("-"), i.cast("string"), F.lit("*01")))
        whole = F.array(name, F.concat(name, F.lit("*01")))
        return F.when(name.contains("-"), whole).otherwise(F.concat(whole, family))

    return F.flatten(F.transform(forms, spelled))


def codon_score(amino: Column, nt: Column, backwards: bool = False) -> Column:
    """Nucleotides of ``nt`` that agree with some codons of ``amino``, up to the first that does not.

    Within a residue only codons that agreed so far go on. ``backwards`` compares from the end.
    When the nucleotides run out, the score stays.
    """
    codons_of = {a: [c for c, x in CODONS.items() if x == a] for a in sorted(set(CODE) - {"*"})}
    table = F.create_map(*[y for a, cs in codons_of.items() for y in (F.lit(a), F.array(*[F.lit(c[::-1] if backwards else c) for c in cs]))])
    aa, bases = (F.reverse(amino), F.reverse(nt)) if backwards else (amino, nt)
    size = F.length(aa)

    def step(acc: Column, k: Column) -> Column:
        want = table[F.substring(aa, k, F.lit(1))]
        have = F.substring(bases, k * 3 - 2, F.lit(3))

        def agrees(n: int) -> Column:
            return F.coalesce((F.length(have) >= n) & F.exists(want, lambda c: F.substring(c, 1, n) == F.substring(have, 1, n)), F.lit(False))

        got = F.when(agrees(3), 3).when(agrees(2), 2).when(agrees(1), 1).otherwise(0)
        return F.when(
            acc["go"], F.struct((acc["score"] + got).alias("score"), (got == 3).alias("go"))
        ).otherwise(acc)

    start = F.struct(F.lit(0).alias("score"), F.lit(True).alias("go"))
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), start, step)["score"]
    return F.when(size > 0, total).when(amino.isNotNull(), 0)


def non_amino_to_x(c: Column) -> Column:
    """Text with X for everything that is no amino acid."""
    return F.regexp_replace(c, "[^ARNDCQEGHILKMFPSTWYV]", "X")
