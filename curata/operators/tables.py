"""The family of tables built from checked and repaired records: full, per chain, collapsed, flagged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import score
from curata.operators.fixer import fix_json, in_order
from curata.schema import META, METHOD, SIGNATURE, dotted
from curata.session import fits, hot_split_join, row_key

ANNOTATIONS = ["species", "mhc_a", "mhc_b", "mhc_class", "antigen_epitope", "antigen_gene", "antigen_species", "reference_id", "confidence_score", "tcr_hash"]


def with_signature_score(rows: DataFrame, columns: Sequence[str] = SIGNATURE) -> DataFrame:
    """Rows with confidence_score (the best record score of their signature), samples_found (records
    of that signature) and studies_found (its distinct references).

    Nulls are values of a signature. The statistics are algebraic aggregates joined back by key, so
    a signature that holds a third of all rows is no large task. Columns of these names are replaced.
    """
    given = rows.drop("record_score", "confidence_score", "samples_found", "studies_found")
    keyed = score.with_record_score(given).select("*", *row_key(columns))
    per_reference = keyed.groupBy("__k1", "__k2", "reference_id").agg(F.max("record_score").alias("best"), F.count("*").alias("n"))
    stats = per_reference.groupBy("__k1", "__k2").agg(
        F.max("best").alias("confidence_score"), F.sum("n").alias("samples_found"), F.count("reference_id").alias("studies_found")
    )
    return hot_split_join(keyed, stats, ["__k1", "__k2"], "samples_found").drop("__k1", "__k2")


def full_table(rows: DataFrame) -> DataFrame:
    """Scored records with their receptor hash."""
    return with_signature_score(rows).withColumn("tcr_hash", score.tcr_hash())


def is_paired() -> Column:
    return F.col("cdr3_alpha").isNotNull() & F.col("cdr3_beta").isNotNull()


def with_complex_id(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with complex_id: 1..n over paired records in a total order, 0 for the others.

    All rows are sorted at once with paired ones first, so the place of a paired row is its id.
    """
    numbered = in_order(rows.withColumn("__lone", ~is_paired()), ["__lone", *order], "complex_id")
    return numbered.withColumn("complex_id", F.when(F.col("__lone"), F.lit(0)).otherwise(F.col("complex_id")).cast("bigint")).drop("__lone")


def json_of(columns: Sequence[str], prefix: str, extra: dict[str, Column] | None = None) -> Column:
    """Columns as one JSON object, prefix stripped, blanks kept as empty text."""
    fields = [F.coalesce(c, F.lit("")).alias(c[len(prefix) :].replace("_", ".")) for c in columns]
    return F.to_json(F.struct(*fields, *[v.alias(n) for n, v in (extra or {}).items()]), {"ignoreNullFields": "false"})


def default_table(rows: DataFrame, order: Sequence[str], keep: Sequence[str] = (), documents: bool = True, number: bool = True, pgen: Column | None = None) -> DataFrame:
    """One row per chain of the full table, with method and meta as JSON (unless ``documents`` is False).

    Records in which a present CDR3 lacks its V or J are left out, with both chains. ``order`` is a
    total order that numbers the complexes; ``keep`` are further columns to carry along. Without
    ``number`` the complex id only tells paired records (1) from others (0), which saves the sort.
    Rows with repairs (cdr3fix_alpha, cdr3fix_beta) also give cdr3fix as JSON, its display flags,
    v_end and j_start. ``pgen`` is an expression over cdr3, gene and species for the log10 of the
    generation probability; pgen_score is its bin, 0 where it is null or not given.
    """
    complete = F.lit(True)
    for c in ("alpha", "beta"):
        complete = complete & (F.col(f"cdr3_{c}").isNull() | (F.col(f"v_{c}").isNotNull() & F.col(f"j_{c}").isNotNull()))
    fixed = "cdr3fix_alpha" in rows.columns and "cdr3fix_beta" in rows.columns
    annotations = [c for c in ANNOTATIONS if c in rows.columns]
    needed = dict.fromkeys([*order, *keep, *[f"{s}_{c}" for c in ("alpha", "beta") for s in ("cdr3", "v", "j", *(["cdr3fix"] if fixed else []))], *annotations])
    if documents:
        needed |= dict.fromkeys([*METHOD, *META, "samples_found", "studies_found"])
    meta_extra = {"samples.found": F.col("samples_found"), "studies.found": F.col("studies_found")}
    given = rows.where(complete).select(*needed)
    ided = with_complex_id(given, order) if number else given.withColumn("complex_id", is_paired().cast("bigint"))
    chains = F.array(
        *[
            F.when(
                F.col(f"cdr3_{c}").isNotNull(),
                F.struct(
                    F.lit(g).alias("gene"), F.col(f"cdr3_{c}").alias("cdr3"), F.col(f"v_{c}").alias("v_segm"), F.col(f"j_{c}").alias("j_segm"),
                    *([F.col(f"cdr3fix_{c}").alias("fix")] if fixed else []),
                ),
            )
            for c, g in (("alpha", "TRA"), ("beta", "TRB"))
        ]
    )
    texts = {
        "method": json_of(METHOD, "method_"),
        "meta": json_of(META, "meta_", meta_extra),
        "web_method": score.web_method(F.col("method_identification")),
        "web_method_seq": score.web_method_seq(F.col("method_singlecell"), F.col("method_sequencing")),
    }
    extra = [c.alias(n) for n, c in texts.items()] if documents else []
    each = ided.select(*keep, "complex_id", F.explode(F.array_compact(chains)).alias("chain"), *annotations, *extra)
    plain = each.select(*keep, "complex_id", "chain.*", *annotations, *(texts if documents else []))
    bins = score.pgen_bin(F.lit(None).cast("double") if pgen is None else pgen, F.col("species"), F.col("gene"))
    result = plain.withColumn("pgen_score", bins)
    if fixed:
        flags = web_fix_flags("fix") if documents else []
        document = [fix_json("fix").alias("cdr3fix")] if documents else []
        result = result.select(*[c for c in result.columns if c != "fix"], *document, *flags, F.col("fix.v_end").alias("v_end"), F.col("fix.j_start").alias("j_start"))
    return result


def web_fix_flags(fix: str) -> list[Column]:
    """Display flags of a repair: not canonical, and an end without a match."""
    nc = F.when(F.col(f"{fix}.v_canonical") & F.col(f"{fix}.j_canonical"), "no").otherwise("yes")
    unmatched = F.when((F.col(f"{fix}.v_end") > -1) & (F.col(f"{fix}.j_start") > -1), "no").otherwise("yes")
    return [nc.alias("web_cdr3fix_nc"), unmatched.alias("web_cdr3fix_unmp")]


def listed(c: str) -> Column:
    """Sorted distinct non-null values as text, joined by commas."""
    return F.array_join(F.sort_array(F.collect_set(F.col(c).cast("string"))), ",")


SLIM = ["gene", "cdr3", "species", "antigen_epitope", "antigen_gene", "antigen_species"]
LISTS = ["complex_id", "v_segm", "j_segm", "mhc_a", "mhc_b", "mhc_class", "reference_id", "pgen_score", "tcr_hash", "j_start", "v_end"]


def slim_table(chains: DataFrame, lists: Sequence[str] = LISTS) -> DataFrame:
    """Chains collapsed by gene, CDR3, species and antigen; other values as lists, scores at their best.

    Of ``lists`` and the score those columns come out that the chains have.
    """
    best = [F.max("confidence_score").alias("confidence_score")] if "confidence_score" in chains.columns else []
    return chains.groupBy(*SLIM).agg(*[listed(c).alias(c) for c in lists if c in chains.columns], *best)


def slim_table_legacy(chains: DataFrame, lists: Sequence[str] = LISTS[:7]) -> DataFrame:
    """As ``slim_table``, after the older rules: lists are taken apart, blanks, ``.`` and complex 0
    left out, an empty list is ``0``; v_end is the greatest, j_start the least that is not negative."""

    def pieces(c: str) -> Column:
        split = F.filter(F.transform(F.split(F.col(c).cast("string"), "[,;]"), lambda x: F.trim(x)), lambda x: ~x.isin("", ".") & ((x != "0") if c == "complex_id" else F.lit(True)))
        text = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(split)))), ",")
        return F.when(text == "", "0").otherwise(text).alias(c)

    ends = [F.max("v_end").alias("v_end"), F.coalesce(F.min(F.when(F.col("j_start") >= 0, F.col("j_start"))), F.lit(-1)).alias("j_start")]
    return chains.groupBy(*SLIM).agg(*[pieces(c) for c in lists], F.max("confidence_score").alias("confidence_score"), *(ends if "v_end" in chains.columns else []))


def _flagged(rows: DataFrame, members: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Rows with ``flag``: 1 if ``members`` has their ``keys``. A list that is too large to send is
    joined by the rows' own keys, of which each is counted and the hot ones are split."""
    own = members.select(*keys).dropna().distinct().withColumn(flag, F.lit(1))
    if fits(own):
        return rows.join(F.broadcast(own), keys, "left")
    weights = rows.groupBy(*keys).agg(F.count("*").alias("__n")).join(own, keys, "inner")
    return hot_split_join(rows, weights, keys, "__n", how="left").drop("__n")


def cluster_flag_full(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Rows with cluster_member: 1 if either chain is listed for its epitope and species."""
    result = rows
    for gene, cdr3, flag in (("TRA", "cdr3_alpha", "__a"), ("TRB", "cdr3_beta", "__b")):
        result = _flagged(result, members.where(F.col("gene") == gene).withColumnRenamed("cdr3aa", cdr3), ["antigen_epitope", "species", cdr3], flag)
    return result.withColumn("cluster_member", F.coalesce("__a", "__b", F.lit(0))).select(*rows.columns, "cluster_member")


def cluster_flag_chains(chains: DataFrame, members: DataFrame, strict: bool = False) -> DataFrame:
    """Chains with cluster_member: 1 if a member has their epitope, species and gene (``strict``: and CDR3)."""
    keys = ["antigen_epitope", "species", "gene"] + (["cdr3"] if strict else [])
    flagged = _flagged(chains, members.withColumnRenamed("cdr3aa", "cdr3"), keys, "__m")
    return flagged.withColumn("cluster_member", F.coalesce("__m", F.lit(0))).select(*chains.columns, "cluster_member")


#: Catalog of the per-chain table: name, type, visible, searchable, autocomplete, data type, title, comment.
CATALOG = [
    ("complex_id", "txt", False, False, False, "complex.id", "Complex", "Chains of one record share it; 0 for a lone chain."),
    ("gene", "txt", True, True, True, "factor", "Gene", "Chain: alpha or beta."),
    ("cdr3", "seq", True, True, False, "cdr3", "CDR3", "Amino acids of the third complementarity-determining region."),
    ("v_segm", "txt", True, True, True, "factor", "V", "Variable segment."),
    ("j_segm", "txt", True, True, True, "factor", "J", "Joining segment."),
    ("species", "txt", True, True, True, "factor", "Species", "Species of the receptor."),
    ("mhc_a", "txt", True, True, True, "factor", "MHC A", "First MHC chain."),
    ("mhc_b", "txt", True, True, True, "factor", "MHC B", "Second MHC chain."),
    ("mhc_class", "txt", True, True, True, "factor", "MHC class", "Class I or II."),
    ("antigen_epitope", "seq", True, True, True, "peptide", "Epitope", "Amino acids of the epitope."),
    ("antigen_gene", "txt", True, True, True, "factor", "Epitope gene", "Gene the epitope comes from."),
    ("antigen_species", "txt", True, True, True, "factor", "Epitope species", "Species the epitope comes from."),
    ("reference_id", "txt", True, True, True, "url", "Reference", "Publication or other source."),
    ("method", "txt", True, False, False, "method.json", "Method", "How the specificity was found, as JSON."),
    ("meta", "txt", True, False, False, "meta.json", "Meta", "Sample and donor, as JSON."),
    ("cdr3fix", "txt", True, False, False, "fixer.json", "CDR3fix", "Repair of the CDR3, as JSON."),
    ("confidence_score", "txt", True, True, False, "uint", "Score", "Confidence, 0 to 3."),
    ("web_method", "txt", False, False, True, "factor", "Internal", "Display group of the method."),
    ("web_method_seq", "txt", False, False, True, "factor", "Internal", "Display group of the sequencing."),
    ("web_cdr3fix_nc", "txt", False, False, True, "factor", "Internal", "Whether the CDR3 is not canonical."),
    ("web_cdr3fix_unmp", "txt", False, False, True, "factor", "Internal", "Whether an end has no match."),
]

#: Columns of the collapsed table that hold sequences; all others hold plain text.
SLIM_SEQUENCES = ["cdr3", "antigen_epitope"]


def catalog(spark: SparkSession) -> DataFrame:
    """The metadata catalog of the per-chain table, file names of columns."""
    columns = "name string, type string, visible int, searchable int, autocomplete int, data_type string, title string, comment string"
    return spark.createDataFrame([(dotted(r[0]), r[1], *map(int, r[2:5]), *r[5:]) for r in CATALOG], columns)


def slim_catalog(slim: DataFrame) -> DataFrame:
    """The metadata catalog of the collapsed table: name, type."""
    return slim.sparkSession.createDataFrame([(dotted(c), "seq" if c in SLIM_SEQUENCES else "txt") for c in slim.columns], "name string, type string")
