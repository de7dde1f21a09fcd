"""The whole build: submission files to the family of tables."""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators import fixer, patch, quality, realign, report, tables
from curata.schema import ALL
from curata.session import checkpointed
from curata.sources import chunks, dictionaries, sinks

FULL = [*ALL, "cdr3fix_alpha", "cdr3fix_beta", "confidence_score", "tcr_hash"]


def build(
    spark: SparkSession,
    folder: str,
    resources: str,
    wanted: Sequence[str] | None = None,
    policy: str = "warn",
    substring: bool = False,
    second_fix: bool = False,
    legacy_slim: bool = False,
    pgen: Column | None = None,
    clusters: str | None = None,
    alleles: str | None = None,
) -> dict[str, DataFrame]:
    """Read, check, deduplicate, patch, repair, score; returns every table of the family by name.

    ``resources`` holds antigens.dict, nomenclature.tsv, segments.txt and segments.parts.txt.
    ``policy`` warn keeps rows that a check refuses, drop leaves them out, fail raises at the first
    one and at files whose header cannot be used. ``second_fix`` realigns after the repair.
    ``alleles``, a table of gene names and allele numbers, adds the split tables; ``clusters``, a
    table of cluster members, adds the scored ones. ``qc`` lists messages and repeated rows.
    """
    records, rejects = chunks.read_chunks(spark, folder, wanted, substring, ALL, policy)
    read = checkpointed(records)
    distinct = checkpointed(quality.deduplicated(read, ["line_no"], scope=["chunk_file"]))
    place = ["chunk_file", "line_no"]
    judged = quality.checked(distinct, policy)
    messages = quality.checked(distinct).where(F.size("messages") > 0).select(*place, F.array_join("messages", "; ").alias("messages"))
    repeats = quality.repeated(read, distinct, place).select(*place, F.lit("duplicate").alias("messages"))
    patched = patch.patched_antigens(judged.drop("messages"), dictionaries.antigen_dictionary(spark, f"{resources}/antigens.dict"))
    segments = checkpointed(dictionaries.segments(spark, f"{resources}/segments.txt"))
    repaired = fixer.repaired(
        patched, fixer.germline(segments), dictionaries.segment_parts(spark, f"{resources}/segments.parts.txt"), dictionaries.nomenclature(spark, f"{resources}/nomenclature.tsv")
    )
    found: dict[str, DataFrame] = {}
    if second_fix:
        repaired = realign.realigned(repaired, segments)
        each = F.explode(F.array(*[F.struct(F.col(f"cdr3fix_{c}.v_fix_type").alias("v_fix_type"), F.col(f"cdr3fix_{c}.j_fix_type").alias("j_fix_type")) for c in ("alpha", "beta")])).alias("k")
    full = checkpointed(tables.full_table(checkpointed(repaired)))
    if second_fix:
        found["realign_counts"] = realign.change_counts(full.select(each).select("k.*"))
    default = checkpointed(tables.default_table(full, place, pgen=pgen))
    slim = (tables.slim_table_legacy if legacy_slim else tables.slim_table)(default)
    found |= {"full": full.select(*FULL), "default": default, "slim": slim, "meta": tables.catalog(spark), "slim_meta": tables.slim_catalog(slim), "rejects": rejects, "qc": messages.unionByName(repeats)}
    if alleles:
        found |= sinks.splits(quality.broken_flags(full.select(*FULL), dictionaries.allele_numbers(spark, alleles)))
    if clusters:
        members = dictionaries.cluster_members(spark, clusters)
        found |= {"full_scored": tables.cluster_flag_full(full.select(*FULL), members)}
        found |= {f"{n}_scored": tables.cluster_flag_chains(found[n], members) for n in ("default", "slim")}
    return found


def report_tables(slim: DataFrame, full: DataFrame) -> dict[str, DataFrame]:
    """The statistics of the report over a built collapsed table and the full one."""
    named = slim.withColumn("id", F.concat(*[F.coalesce(c, F.lit("")) for c in ("gene", "cdr3", "antigen_epitope", "antigen_gene", "antigen_species")]))
    usage = checkpointed(report.usage(named, "id"))
    ranks = checkpointed(report.epitope_ranks(slim))
    lengths = checkpointed(report.spectratype(slim))
    return {
        "records": report.counts_by(slim, ["species", "gene"]),
        "antigens": report.counts_by(slim.where("species = 'HomoSapiens'"), ["antigen_species"]),
        "antigen_chains": report.by_chain(report.antigen_chains(slim, "")),
        "scores": report.score_distribution(slim),
        "lengths": lengths,
        "length_density": report.density(lengths),
        "usage": usage,
        "usage_ratio": report.observed_to_expected(usage.where("gene = 'TRB' and mhc_class = 'MHCI'"), "mhc_a", "v_gene", "records"),
        "mhc": report.mhc_detail(named, "id"),
        "epitopes": ranks,
        "epitope_fit": report.loglog_fit(ranks),
        "naming": report.ambiguous_names(full),
    }


#: Tables written without quotes, so that their JSON columns stay as they are.
UNQUOTED = ["default", "default_scored", "full_scored", "slim_scored"]


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("folder")
    parser.add_argument("resources")
    parser.add_argument("out")
    parser.add_argument("--chunks-to-build", nargs="*")
    parser.add_argument("--substring", action="store_true", help="take files whose name contains one of the texts")
    parser.add_argument("--policy", choices=["warn", "drop", "fail"], default="warn")
    parser.add_argument("--fix2", action=argparse.BooleanOptionalAction, default=False, help="realign segments after the repair")
    parser.add_argument("--legacy-slim", action="store_true")
    parser.add_argument("--clusters", help="table of cluster members")
    parser.add_argument("--alleles", help="table of gene names and allele numbers")
    parser.add_argument("--report", action="store_true", help="also write the statistics, as tables and as HTML rows")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("curata").getOrCreate()
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(args.out, "_intermediate"))  # shared, as the output is
    found = build(spark, args.folder, args.resources, args.chunks_to_build, args.policy, args.substring, args.fix2, args.legacy_slim, None, args.clusters, args.alleles)
    for name, table in found.items():
        sinks.write_table(table, f"{args.out}/{name}", first="cdr3_alpha" if name.startswith("full") else None, quoted=name not in UNQUOTED)
    if args.report:
        for name, table in report_tables(found["slim"], found["full"]).items():
            sinks.write_summary(table, f"{args.out}/report/{name}")
            sinks.html_lines(table).write.mode("overwrite").text(f"{args.out}/report_html/{name}")


if __name__ == "__main__":
    main()
