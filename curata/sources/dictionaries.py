"""Reference tables from text: antigen dictionary, nomenclature, segments and their parts, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one small file with their numbers from 1."""
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    return whole.select((F.col("at") + 1).alias("line_no"), "line").where(F.trim("line") != "")


def antigen_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """line_no, antigen_epitope, antigen_species, antigen_gene; fields split at tabs or blanks, first line a header."""
    f = F.split("line", "[\t ]+")
    return _numbered(spark, path).where("line_no > 1").select("line_no", f[0].alias("antigen_epitope"), F.get(f, F.lit(1)).alias("antigen_species"), F.get(f, F.lit(2)).alias("antigen_gene"))


def nomenclature(spark: SparkSession, path: str) -> DataFrame:
    """old_name, new_names (a comma list); lines that start with ``#`` are comments."""
    f = F.split("line", "\t")
    return _numbered(spark, path).where(~F.col("line").startswith("#")).select(F.trim(f[0]).alias("old_name"), F.trim(F.get(f, F.lit(1))).alias("new_names"))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """species, gene, segment, id, ref, seq and ord (the line's place), V and J segments only."""
    f = F.split("line", "\t")
    rows = _numbered(spark, path).where("line_no > 1").select(*[F.trim(F.get(f, F.lit(k))).alias(n) for k, n in enumerate(["species", "gene", "segment", "id", "ref", "seq"])], F.col("line_no").alias("ord"))
    return rows.where(F.lower("segment").rlike("^[vj]")).withColumn("ref", F.col("ref").try_cast("int"))


def segment_parts(spark: SparkSession, path: str) -> DataFrame:
    """species, gene, part, segment from lines of species, gene, cdr3 part, an unused field and segment."""
    f = F.split("line", "\t")
    return _numbered(spark, path).where("line_no > 1").select(*[F.trim(F.get(f, F.lit(k))).alias(n) for k, n in ((0, "species"), (1, "gene"), (2, "part"), (4, "segment"))])


def allele_numbers(spark: SparkSession, path: str) -> DataFrame:
    """gene_name, n_alleles from a table whose header names IMGT/GENE-DB and Number of alleles."""
    table = spark.read.option("sep", "\t").option("header", "true").csv(path)
    return table.select(F.col("`IMGT/GENE-DB`").alias("gene_name"), F.col("`Number of alleles`").try_cast("int").alias("n_alleles"))


def cluster_members(spark: SparkSession, path: str) -> DataFrame:
    """gene, antigen_epitope, species, cdr3aa from a table with these columns."""
    table = spark.read.option("sep", "\t").option("header", "true").csv(path)
    return table.select("gene", F.col("`antigen.epitope`").alias("antigen_epitope"), "species", "cdr3aa")


def publication_dates(lines: DataFrame) -> DataFrame:
    """reference_id, pub_date (year) from summary XML: any number of summaries in each row's ``xml``.

    Each summary runs from its Id to the next one, so one without a date has a null year and none
    takes the date of another. Null texts and texts without an Id give nothing.
    """
    each = lines.select(F.explode(F.slice(F.split("xml", "<Id>"), 2, 2**31 - 1)).alias("block"))
    found = each.select(F.regexp_extract("block", r"^\s*(\d+)\s*</Id>", 1).alias("id"), F.regexp_extract("block", r'Name="PubDate"[^>]*>\s*(\d{4})', 1).alias("year"))
    return found.where("id <> ''").select(F.concat(F.lit("PMID:"), "id").alias("reference_id"), F.col("year").try_cast("int").alias("pub_date"))


def with_literal_dates(dates: DataFrame, known: dict[str, int]) -> DataFrame:
    """Publication dates with literal rows for references that no summary covers; a summary's own row holds."""
    own = dates.sparkSession.createDataFrame(sorted(known.items()), "reference_id string, pub_date int")
    return dates.unionByName(own.join(dates.select("reference_id"), "reference_id", "left_anti"))
