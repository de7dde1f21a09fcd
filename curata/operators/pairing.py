"""Single-cell contigs to paired records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.schema import ALL


def paired_contigs(contigs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every alpha contig of a barcode with every beta contig; a lone chain stands with nulls.

    ``contigs`` has barcode, chain (TRA or TRB), v_gene, d_gene, j_gene, cdr3 and ``carry`` columns
    that are constant per barcode. Repeated pairs come out once. Null barcodes are left out. Each
    barcode is a cell with a few contigs; an equi-join on it builds the pairs.
    """
    cells = contigs.where("barcode is not null")
    alpha = cells.where("chain = 'TRA'").select("barcode", F.col("cdr3").alias("cdr3_alpha"), F.col("v_gene").alias("v_alpha"), F.col("j_gene").alias("j_alpha")).distinct()
    beta = cells.where("chain = 'TRB'").select(
        "barcode", F.col("cdr3").alias("cdr3_beta"), F.col("v_gene").alias("v_beta"), F.col("d_gene").alias("d_beta"), F.col("j_gene").alias("j_beta")
    ).distinct()
    pairs = alpha.join(beta, "barcode", "full_outer")
    if carry:
        pairs = pairs.join(cells.groupBy("barcode").agg(*[F.min(c).alias(c) for c in carry]), "barcode", "left")
    return pairs


def zipped_contigs(contigs: DataFrame) -> DataFrame:
    """The same pairs by collecting each barcode's contigs and exploding the zipped arrays twice."""

    def of(chain: str, columns: Sequence[str]) -> F.Column:
        return F.array_sort(F.collect_set(F.when(F.col("chain") == chain, F.struct(*columns))))

    both = contigs.where("barcode is not null").groupBy("barcode").agg(of("TRA", ["cdr3", "v_gene", "j_gene"]).alias("a"), of("TRB", ["cdr3", "v_gene", "d_gene", "j_gene"]).alias("b"))
    exploded = both.select("barcode", F.explode_outer("b").alias("b"), "a").select("barcode", "b", F.explode_outer("a").alias("a")).where("a is not null or b is not null")
    return exploded.select(
        "barcode", F.col("a.cdr3").alias("cdr3_alpha"), F.col("a.v_gene").alias("v_alpha"), F.col("a.j_gene").alias("j_alpha"),
        F.col("b.cdr3").alias("cdr3_beta"), F.col("b.v_gene").alias("v_beta"), F.col("b.d_gene").alias("d_beta"), F.col("b.j_gene").alias("j_beta"),
    )


def as_submission(pairs: DataFrame, constants: dict[str, str], mapped: tuple[str, str, dict[str, str | None]] | None = None) -> DataFrame:
    """Pairs in the columns of a submission: constants filled in, one column mapped, the rest null.

    ``mapped`` names a target column, its source column and the values it maps.
    """
    result = pairs
    if mapped:
        target, source, table = mapped
        known = {k: v for k, v in table.items() if v is not None}
        lookup = F.create_map(*[F.lit(x) for kv in known.items() for x in kv]) if known else F.lit(None)
        result = result.withColumn(target, lookup[F.col(source)] if known else F.lit(None).cast("string"))
    for c, v in constants.items():
        result = result.withColumn(c, F.lit(v))
    return result.select(*[F.col(c).cast("string").alias(c) if c in result.columns else F.lit(None).cast("string").alias(c) for c in ALL])


def split_present(rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with and without a value in ``column``."""
    return rows.where(F.col(column).isNotNull()), rows.where(F.col(column).isNull())
