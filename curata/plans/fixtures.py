"""Record tables over the driver's star schema, and small made-up reference tables.

The expressions of the submissions view are valid in Spark and in DuckDB alike, so queries and
their SQL read the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.session import load, spread

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _digits(x: str, to: str = "SGQNLTEPRD") -> str:
    return f"translate(cast({x} AS string), '0123456789', '{to}')"


SUBMISSION = {
    "cdr3_alpha": f"CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'CAV' || {_digits('l_suppkey % 37')} || (CASE WHEN l_linestatus = 'F' THEN 'NKFYF' ELSE 'GNQFY' END) END",
    "v_alpha": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'TRAV' || cast(l_suppkey % 9 + 1 AS string) || (CASE WHEN l_linenumber % 2 = 0 THEN '*01' ELSE '' END) END",
    "j_alpha": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'TRAJ' || cast(l_suppkey % 5 + 1 AS string) END",
    "cdr3_beta": f"CASE WHEN l_linenumber % 5 = 4 THEN NULL ELSE (CASE WHEN l_linenumber = 7 THEN 'AS' ELSE 'CASS' END) || {_digits('l_partkey % 97')} || (CASE l_returnflag WHEN 'A' THEN 'YEQYF' WHEN 'N' THEN 'TEAFF' ELSE 'NEQY' END) END",
    "v_beta": "CASE WHEN l_linenumber % 5 = 4 OR p_size % 10 = 0 THEN NULL ELSE 'TRBV' || cast(p_size % 7 + 1 AS string) END",
    "d_beta": "CASE WHEN l_linenumber % 5 = 4 OR l_linenumber % 2 = 1 THEN NULL ELSE 'TRBD' || cast(p_size % 2 + 1 AS string) END",
    "j_beta": "CASE WHEN l_linenumber % 5 = 4 THEN NULL ELSE 'TRBJ' || cast(p_size % 2 + 1 AS string) || '-' || cast(p_size % 6 + 1 AS string) END",
    "species": "CASE WHEN c_nationkey % 5 = 0 THEN 'MusMusculus' ELSE 'HomoSapiens' END",
    "mhc_a": "CASE WHEN c_nationkey % 4 = 0 THEN 'HLA-DRA*01:01' ELSE 'HLA-A*0' || cast(c_nationkey % 4 AS string) || ':01' END",
    "mhc_b": "CASE WHEN c_nationkey % 4 = 0 THEN 'HLA-DRB1*04:01' ELSE 'B2M' END",
    "mhc_class": "CASE WHEN c_nationkey % 4 = 0 THEN 'MHCII' ELSE 'MHCI' END",
    "antigen_epitope": f"'NLV' || {_digits('c_nationkey', 'PMVATGKLIF')} || 'ATV'",
    "antigen_gene": "'gene' || cast(c_nationkey % 6 AS string)",
    "antigen_species": "CASE c_nationkey % 4 WHEN 0 THEN 'CMV' WHEN 1 THEN 'EBV' WHEN 2 THEN 'InfluenzaA' ELSE 'SARS-CoV-2' END",
    "reference_id": "'PMID:' || cast(o_custkey AS string)",
    "method_identification": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'tetramer-sort' WHEN '2' THEN 'antigen-loaded-targets' WHEN '3' THEN 'limiting-dilution-cloning' WHEN '4' THEN 'beads,dextramer-sort' ELSE NULL END",
    "method_frequency": "CASE l_linenumber % 4 WHEN 0 THEN cast(cast(floor(l_quantity) AS int) AS string) || '/50' WHEN 1 THEN cast(cast(floor(l_quantity) AS int) AS string) || '%' WHEN 2 THEN cast(l_discount AS string) ELSE NULL END",
    "method_singlecell": "CASE l_linenumber WHEN 1 THEN 'yes' WHEN 2 THEN 'no' ELSE NULL END",
    "method_sequencing": "CASE p_size % 4 WHEN 0 THEN 'sanger' WHEN 1 THEN 'amplicon-seq' WHEN 2 THEN 'rna-seq' ELSE NULL END",
    "method_verification": "CASE p_size % 6 WHEN 0 THEN 'tetramer-stain' WHEN 1 THEN 'antigen-loaded-targets' WHEN 2 THEN 'direct' ELSE NULL END",
    "meta_study_id": "CAST(NULL AS string)",
    "meta_cell_subset": "c_mktsegment",
    "meta_subject_cohort": "CAST(NULL AS string)",
    "meta_subject_id": "cast(o_custkey AS string)",
    "meta_replica_id": "CAST(NULL AS string)",
    "meta_clone_id": "CAST(NULL AS string)",
    "meta_epitope_id": "CAST(NULL AS string)",
    "meta_tissue": "CAST(NULL AS string)",
    "meta_donor_MHC": "CAST(NULL AS string)",
    "meta_donor_MHC_method": "CAST(NULL AS string)",
    "meta_structure_id": "CASE WHEN l_partkey % 50 = 0 THEN '1ABC' ELSE NULL END",
}

_COLUMNS = ",\n  ".join(f"{e} AS {c}" for c, e in SUBMISSION.items())
SRC = f"""src AS (SELECT {', '.join(KEY)}, o_orderdate, l_discount,
  {_COLUMNS}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey)"""


def submissions(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """The submissions view: 31 record columns, the row key and o_orderdate; of ``orders``, if given, with its columns ``extra``."""
    joined = (
        spread(load(spark, sf_dir, "lineitem").select(*KEY, "l_quantity", "l_discount", "l_returnflag", "l_linestatus"))
        .join(load(spark, sf_dir, "orders") if orders is None else orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    return joined.selectExpr(*KEY, "o_orderdate", "l_discount", *extra, *[f"{e} AS {c}" for c, e in SUBMISSION.items()])


# Made-up germline tables. Each amino acid has one codon here.
CODON_OF = dict(zip("ARNDCQEGHILKMFPSTWYV", "GCT CGT AAT GAT TGT CAA GAA GGT CAT ATT CTG AAA ATG TTT CCT AGC ACT TGG TAT GTT".split()))
V_AA = {"TRAV1*01": "CAVR", "TRAV2*01": "CAVSG", "TRAV3*01": "CAVQ", "TRAV4*01": "CAVNT", "TRAV5*01": "CALS", "TRAV6*01": "CAVL", "TRAV7-1*01": "CAVEP", "TRAV8-2*01": "WCAV", "TRBV1*01": "CASSLG", "TRBV2*01": "CASSYS", "TRBV3-1*01": "CASSQD", "TRBV4*01": "CASSPG", "TRBV5*01": "CASRL", "TRBV6-4*01": "CAWS"}
J_AA = {"TRAJ1*01": "NKFYF", "TRAJ2*01": "GNQFYF", "TRAJ3*01": "SKIIF", "TRAJ4*01": "GNQF", "TRBJ1-1*01": "NTEAFF", "TRBJ1-3*01": "YEQYF", "TRBJ1-5*01": "TEAFF", "TRBJ2-2*01": "NEQYF", "TRBJ2-4*01": "TDTQYF", "TRBJ2-6*01": "QYF"}


def _segments() -> list[tuple[str, str, str, str, int, str, int]]:
    rows = []
    for species in ("HomoSapiens", "MusMusculus"):
        for k, (name, aa) in enumerate([*V_AA.items(), *J_AA.items()]):
            variable = name[3] == "V"
            nt = "".join(CODON_OF[a] for a in aa)
            rows.append((species, name[:3], "Variable" if variable else "Joining", name, 6 if variable else len(nt) + 1 - 4, f"GGA{nt}A" if variable else f"A{nt}GGC", k))
    return rows


SEGMENTS = _segments()
SEGMENT_COLUMNS = "species string, gene string, segment string, id string, ref int, seq string, ord int"
PARTS = [(s, n[:3], a, n) for s in ("HomoSapiens", "MusMusculus") for n, a in [*V_AA.items(), *J_AA.items()] if s == "HomoSapiens" or n[3] == "V"]
CONVERSIONS = [("TRBV7", "TRBV6-4"), ("TRAV9", "TRAV2,TRAV3")]
DICTIONARY = [(1, "NLVPATV", "HCMV", "pp65"), (2, "NLVMATV", "EBV-1", "BZLF1"), (3, "NLVPATV", "HCMV-2", "IE1"), (4, "NLVAPATV", "Flu", "M1")]
NOMENCLATURE = [*[(f"TRAV{k}", 1) for k in range(1, 8)], *[(f"TRBV{k}", 2) for k in range(1, 6)], *[(f"TRAJ{k}", 1) for k in range(1, 6)], *[(f"TRBJ{a}-{b}", 1) for a in (1, 2) for b in range(1, 6)]]


def values(rows: list[tuple]) -> str:
    """Rows as an SQL VALUES list."""
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, (int, float)) else f"'{v}'" for v in r) + ")" for r in rows) + ")"


def segments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENTS, SEGMENT_COLUMNS)


def parts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARTS, "species string, gene string, part string, segment string")


def conversions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONVERSIONS, "old_name string, new_names string")


def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DICTIONARY, "line_no int, antigen_epitope string, antigen_species string, antigen_gene string")


def nomenclature(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOMENCLATURE, "gene_name string, n_alleles int")
