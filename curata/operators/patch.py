"""Names patched from dictionaries: antigen species and gene, segment nomenclature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.session import lookup_join


def last_entries(dictionary: DataFrame) -> DataFrame:
    """One row per epitope: the entry of the later line holds."""
    return dictionary.groupBy("antigen_epitope").agg(
        F.max_by("antigen_species", "line_no").alias("__species"), F.max_by("antigen_gene", "line_no").alias("__gene")
    )


def patched_antigens(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rows whose antigen species and gene come from the dictionary where it has the epitope."""
    return (
        lookup_join(rows, last_entries(dictionary), ["antigen_epitope"])
        .withColumn("antigen_species", F.coalesce("__species", "antigen_species"))
        .withColumn("antigen_gene", F.coalesce("__gene", "antigen_gene"))
        .drop("__species", "__gene")
        .select(*rows.columns)
    )


def converted_names(rows: DataFrame, conversions: DataFrame, column: str) -> DataFrame:
    """Human segment names replaced by the first of their new names; others stay."""
    table = conversions.select(F.col("old_name").alias("__old"), F.trim(F.split_part("new_names", F.lit(","), F.lit(1))).alias("__new"))
    human = F.lower("species") == "homosapiens"
    joined = lookup_join(rows.withColumn("__old", F.when(human, F.col(column))), table, ["__old"])
    return joined.withColumn(column, F.coalesce("__new", column)).select(*rows.columns)
