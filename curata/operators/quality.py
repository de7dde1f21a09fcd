"""Quality control of records: header and row checks, duplicates, broken-row splits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.functions.validate import VALIDATORS
from curata.operators.fixer import in_order
from curata.schema import ALL, ROW_SIGNATURE, dotted
from curata.session import hot_split_join, lookup_join, row_key


def check_header(columns: Sequence[str], required: Sequence[str] = ALL) -> None:
    """Raise if there are no columns, some twice, or required ones missing."""
    if not columns:
        raise ValueError("empty file")
    if len(set(columns)) != len(columns):
        raise ValueError(f"duplicate columns: {sorted({c for c in columns if list(columns).count(c) > 1})}")
    if missing := [c for c in required if c not in columns]:
        raise ValueError(f"missing columns: {missing}")


def messages(validators: dict[str, Callable[[Column], Column]] | None = None) -> Column:
    """All messages of a row, in order: bad fields, then no.cdr3, no.antigen.seq and no.mhc."""
    found = [F.when(~ok(F.col(c)), f"bad {dotted(c)}") for c, ok in (validators or VALIDATORS).items()]
    found += [
        F.when(F.col("cdr3_alpha").isNull() & F.col("cdr3_beta").isNull(), "no.cdr3"),
        F.when(F.col("antigen_epitope").isNull(), "no.antigen.seq"),
        F.when(F.col("mhc_a").isNull() | F.col("mhc_b").isNull(), "no.mhc"),
    ]
    return F.array_compact(F.array(*found))


def checked(rows: DataFrame, policy: str = "warn") -> DataFrame:
    """Rows with their ``messages``; ``policy`` says what becomes of rows that have any.

    warn keeps them, drop leaves them out, fail raises when one is met.
    """
    result = rows.withColumn("messages", messages())
    if policy == "drop":
        return result.where(F.size("messages") == 0)
    if policy == "fail":
        raised = F.raise_error(F.concat(F.lit("bad row: "), F.array_join("messages", ", ")))
        return result.where(F.when(F.size("messages") == 0, True).otherwise(raised.cast("boolean")))  # a filter is never pruned
    if policy != "warn":
        raise ValueError(f"unknown policy {policy}")
    return result


def numbered_duplicates(rows: DataFrame, order: Sequence[str], signature: Sequence[str] = ROW_SIGNATURE, scope: Sequence[str] = ()) -> DataFrame:
    """Rows with ``copy_no``: 1 for the first of each signature, in a total ``order``, within ``scope``.

    All rows are sorted by signature and order over ranges and numbered through; a copy's number is
    its distance from the first of its signature. So a signature that holds a third of all rows is
    spread over many parts, and only its first number is joined back, split.
    """
    numbered = in_order(rows.select("*", *row_key([*scope, *signature])), ["__k1", "__k2", *order], "__n")
    first = numbered.groupBy("__k1", "__k2").agg(F.min("__n").alias("__first"), F.count("*").alias("__rows"))
    return hot_split_join(numbered, first, ["__k1", "__k2"], "__rows").withColumn("copy_no", F.col("__n") - F.col("__first") + 1).select(*rows.columns, "copy_no")


def with_copy_flag(rows: DataFrame, key: Sequence[str], signature: Sequence[str] = ROW_SIGNATURE, scope: Sequence[str] = ()) -> DataFrame:
    """Rows with ``is_copy``: whether a row of the same signature comes before it by ``key`` (a total order).

    The first row of each signature is an algebraic aggregate; it is joined back with hot signatures split.
    """
    keyed = rows.select("*", *row_key([*scope, *signature]))
    place = F.struct(*[F.col(c) for c in key])
    first = keyed.groupBy("__k1", "__k2").agg(F.min(place).alias("__first"), F.count("*").alias("__rows"))
    return hot_split_join(keyed, first, ["__k1", "__k2"], "__rows").withColumn("is_copy", place != F.col("__first")).select(*rows.columns, "is_copy")


def deduplicated(rows: DataFrame, key: Sequence[str], signature: Sequence[str] = ROW_SIGNATURE, scope: Sequence[str] = ()) -> DataFrame:
    """The first row of each signature by ``key`` (a total order).

    An algebraic aggregate: each task keeps one candidate per signature, so a signature that holds
    a third of all rows is no single large task.
    """
    group = [*scope, *signature]
    rest = [c for c in rows.columns if c not in group]
    first = F.min(F.struct(*[F.col(c) for c in key], F.struct(*rest).alias("__rest"))).alias("first")
    return rows.groupBy(*group).agg(first).select(*group, "first.__rest.*").select(*rows.columns)


def repeated(rows: DataFrame, distinct: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, by their unique ``key``, that ``deduplicated`` left out."""
    return rows.join(distinct.select(*key), list(key), "left_anti")


def gene_known(rows: DataFrame, nomenclature: DataFrame, column: str) -> DataFrame:
    """Rows with ``column``_known and ``column``_allele_ok from a table of gene names and allele numbers.

    The gene is the part before ``*``; null is fine, as are alleles of unknown genes or no allele.
    """
    gene, allele = F.split_part(F.col(column), F.lit("*"), F.lit(1)), F.split_part(F.col(column), F.lit("*"), F.lit(2))
    table = nomenclature.select(F.col("gene_name").alias("__gene"), F.col("n_alleles").alias("__n")).distinct()
    joined = lookup_join(rows.withColumn("__gene", gene), table, ["__gene"])
    known = F.col(column).isNull() | F.col("__n").isNotNull()
    fits = F.col(column).isNull() | (allele == "") | F.col("__n").isNull() | F.coalesce(allele.try_cast("int") <= F.col("__n"), F.lit(False))
    return joined.withColumn(f"{column}_known", known).withColumn(f"{column}_allele_ok", fits).drop("__gene", "__n")


def canonical(c: Column) -> Column:
    """CDR3 that starts with C and ends with F or W; null is fine."""
    return c.isNull() | c.rlike("^C.*[FW]$")


def broken_flags(rows: DataFrame, nomenclature: DataFrame, genes: Sequence[str] = ("v_alpha", "j_alpha", "v_beta", "j_beta")) -> DataFrame:
    """Rows with the flags gene_broken, allele_broken, cdr3_broken and filtered (none of them).

    Only human genes are held against the nomenclature. One flags column set serves all splits.
    """
    human = F.coalesce(F.lower("species") == "homosapiens", F.lit(False))
    result = rows
    for g in genes:
        result = gene_known(result, nomenclature, g)
    unknown, unfit = F.lit(False), F.lit(False)
    for g in genes:
        unknown, unfit = unknown | ~F.col(f"{g}_known"), unfit | ~F.col(f"{g}_allele_ok")
    return (
        result.withColumn("gene_broken", human & unknown)
        .withColumn("allele_broken", human & unfit)
        .withColumn("cdr3_broken", ~canonical(F.col("cdr3_alpha")) | ~canonical(F.col("cdr3_beta")))
        .withColumn("filtered", ~F.col("gene_broken") & ~F.col("allele_broken") & ~F.col("cdr3_broken"))
        .drop(*[f"{g}_known" for g in genes], *[f"{g}_allele_ok" for g in genes])
    )
