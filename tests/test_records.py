import random

import pytest
from pyspark.sql import functions as F

from curata.functions import score, seq
from curata.operators import fixer, pairing, quality, report, tables
from curata.schema import ALL, dotted, undotted


def slow_hit(segment, cdr3, least=2):
    """Restated rule: longest run that ends before the last residue, first in cdr3, last in segment."""
    best = None
    for k in range(least, len(cdr3)):
        for j in range(len(cdr3) - k):
            at = segment.rfind(cdr3[j : j + k])
            if at >= 0 and (best is None or k > best[2]):
                best = (at, j, k)
    return best


def test_kmer_hit_equals_loop(spark):
    rng = random.Random(3)
    pairs = [("".join(rng.choices("CAS", k=rng.randint(0, 8))), "".join(rng.choices("CAS", k=rng.randint(0, 9)))) for _ in range(1500)]
    rows = spark.createDataFrame(pairs, "s string, c string").withColumn("h", seq.kmer_hit(F.col("s"), F.col("c"))).collect()
    assert all((tuple(r.h) if r.h else None) == slow_hit(r.s, r.c) for r in rows)


@pytest.mark.parametrize(
    ("cdr3", "kind", "text", "x"),
    [
        ("CASSLGQEQYF", "NoFixNeeded", "CASSLGQEQYF", 6),
        ("ASSLGQEQYF", "FixAdd", "CASSLGQEQYF", 5),
        ("WCASSLGQYF", "FixTrim", "CASSLGQYF", 6),
        ("GASSLGQYF", "FixReplace", "CASSLGQYF", 5),
        ("GGSSLGQYF", "FailedReplace", "GGSSLGQYF", -1),
        ("WWYYFF", "FailedNoAlignment", "WWYYFF", -1),
        ("CASS", "NoFixNeeded", "CASS", 3),
    ],
)
def test_one_sided_fix(spark, cdr3, kind, text, x):
    row = spark.createDataFrame([("CASSLG", cdr3)], "s string, c string").withColumn("h", seq.kmer_hit(F.col("s"), F.col("c")))
    f = row.select(seq.one_sided_fix(F.col("s"), F.col("c"), F.col("h")).alias("f")).first().f
    assert (f.fix_type, f.cdr3, f.x) == (kind, text, x)


def test_fixed_both(spark):
    segments = spark.createDataFrame([("HomoSapiens", "V1*01", "V", "CASSLG"), ("HomoSapiens", "J1*01", "J", "YEQYF")], "species string, id string, kind string, seq_aa string")
    inputs = spark.createDataFrame([("HomoSapiens", "CASSYEQY", "V1", "J1"), ("HomoSapiens", "CASSYEQY", "V9,V1", "J1"), ("HomoSapiens", "CASSYEQY", None, None), ("HomoSapiens", None, "V1", "J1")], "species string, cdr3 string, v string, j string")
    got = {(r.v, r.j): r.fix for r in fixer.fixed_both(inputs, segments).collect()}
    assert len(got) == 3
    f = got["V1", "J1"]
    assert (f.cdr3, f.j_fix_type, f.j_start, f.v_end, f.good) == ("CASSYEQYF", "FixAdd", 5, 4, True)
    assert got["V9,V1", "J1"].v_id == "V1*01"
    assert got[None, None].v_fix_type == "FailedBadSegment" and not got[None, None].good
    again = fixer.fixed_both(inputs.limit(1).withColumn("cdr3", F.lit("CASSYEQYF")), segments).first().fix
    assert (again.cdr3, again.fix_needed) == ("CASSYEQYF", False)


def test_codon_score(spark):
    row = spark.createDataFrame([("CASSYLPGQGDHYSNQPQH", "TGTGCCAGCAGCTTAGG"), ("CASS", "TGTGC"), ("", "TGT"), (None, "TGT"), ("C?", "TGTAAA")], "a string, n string")
    assert [r.s for r in row.select(seq.codon_score(F.col("a"), F.col("n")).alias("s")).collect()] == [13, 5, 0, None, 3]


@pytest.mark.parametrize(
    ("identification", "freq", "single", "sequencing", "verification", "structure", "want"),
    [
        (None, None, None, None, None, "1ABC", 3),
        ("tetramer-sort", "5/13", None, "sanger", None, None, 1),
        ("tetramer-sort", "5/13", None, "sanger", "antigen-loaded-targets", None, 3),
        ("tetramer-sort", "1/22", None, "sanger", None, None, 0),
        ("cultured-T-cells,tetramer-sort", "40%", "yes", None, None, " ", 0),
        ("antigen-loaded-targets", "0.3", None, "amplicon-seq", "tetramer-stain", None, 2),
        (None, None, None, "rna-seq", "direct", None, 1),
        ("tetramer-sort", "1//17", "no", "sanger", None, None, 1),
        ("tetramer-sort", "rubbish", None, None, None, None, 0),
    ],
)
def test_score(spark, identification, freq, single, sequencing, verification, structure, want):
    names = "method_identification string, method_frequency string, method_singlecell string, method_sequencing string, method_verification string, meta_structure_id string"
    row = spark.createDataFrame([(identification, freq, single, sequencing, verification, structure)], names)
    assert score.with_record_score(row).first().record_score == want


def test_pgen_bins(spark):
    rows = spark.createDataFrame([(-7.0,), (-7.3,), (-12.1,), (-15.6,), (None,)], "p double")
    assert [r.b for r in rows.select(score.pgen_bin(F.col("p"), F.lit("HomoSapiens"), F.lit("TRB")).alias("b")).collect()] == [3, 2, 1, 0, 0]


def records(spark, *rows):
    table = [tuple(r.get(c) for c in ALL) + (k,) for k, r in enumerate(rows)]
    return spark.createDataFrame(table, ", ".join(f"{c} string" for c in ALL) + ", line int")


ONE = {"cdr3_alpha": "CAVF", "v_alpha": "TRAV1", "j_alpha": "TRAJ1", "cdr3_beta": "CASSF", "v_beta": "TRBV1", "j_beta": "TRBJ1-1", "species": "HomoSapiens", "mhc_a": "HLA-A*02:01", "mhc_b": "B2M", "mhc_class": "MHCI", "antigen_epitope": "NLVPMVATV", "antigen_gene": "pp65", "reference_id": "PMID:1"}


def test_tables(spark):
    rows = records(spark, ONE, ONE | {"reference_id": "PMID:2", "meta_structure_id": "1ABC"}, ONE | {"cdr3_alpha": None}, ONE | {"v_beta": None}).withColumn("__x", F.lit(1)).withColumn("confidence_score", F.lit(99))
    full = tables.full_table(rows)
    assert {r.line: (r.confidence_score, r.samples_found, r.studies_found) for r in full.collect()} == {0: (3, 2, 2), 1: (3, 2, 2), 2: (0, 1, 1), 3: (0, 1, 1)}
    default = tables.default_table(full, ["line"], ["line"])
    assert sorted((r.line, r.gene, r.complex_id) for r in default.collect()) == [(0, "TRA", 1), (0, "TRB", 1), (1, "TRA", 2), (1, "TRB", 2), (2, "TRB", 0)]
    slim = {r.gene: r for r in tables.slim_table(default).collect()}
    assert slim["TRB"].complex_id == "0,1,2" and slim["TRB"].reference_id == "PMID:1,PMID:2"
    assert {r.gene: r.complex_id for r in tables.slim_table_legacy(default).collect()} == {"TRA": "1,2", "TRB": "1,2"}
    assert tables.full_table(rows.where("false")).count() == 0


def test_quality(spark):
    rows = records(spark, ONE, ONE, ONE | {"species": None, "cdr3_beta": "CA"})
    assert sorted(r.line for r in quality.deduplicated(rows, ["line"]).collect()) == [0, 2]
    bad = {r.line: r.messages for r in quality.checked(rows).collect()}
    assert bad == {0: [], 1: [], 2: ["bad cdr3.beta", "bad species"]}
    assert quality.checked(rows, "drop").count() == 2
    with pytest.raises(Exception, match="bad row"):
        quality.checked(rows, "fail").collect()
    with pytest.raises(ValueError, match="missing"):
        quality.check_header(["a"])
    with pytest.raises(ValueError, match="duplicate"):
        quality.check_header([*ALL, "species"])
    names = spark.createDataFrame([("TRBV1", 1)], "gene_name string, n_alleles int")
    genes = spark.createDataFrame([("TRBV1*01",), ("TRBV1*02",), ("TRBV2*09",), (None,), ("TRBV1*x",)], "g string")
    got = {r.g: (r.g_known, r.g_allele_ok) for r in quality.gene_known(genes, names, "g").collect()}
    assert got == {"TRBV1*01": (True, True), "TRBV1*02": (True, False), "TRBV2*09": (False, True), None: (True, True), "TRBV1*x": (True, False)}


def test_order_pairing_and_names(spark):
    rows = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k"))
    assert all(r.n == r.k + 1 for r in fixer.in_order(rows, ["k"], "n").collect())
    contigs = spark.createDataFrame([("b", "TRA", "V1", None, "J", "C1"), ("b", "TRA", "V1", None, "J", "C1"), ("b", "TRB", "V2", "D", "J", "C2"), ("b", "TRB", "V3", "D", "J", "C3"), ("c", "TRA", "V4", None, "J", "C4")], "barcode string, chain string, v_gene string, d_gene string, j_gene string, cdr3 string")
    one, two = pairing.paired_contigs(contigs), pairing.zipped_contigs(contigs)
    assert sorted(map(str, one.select(*two.columns).collect())) == sorted(map(str, two.collect())) and one.count() == 3
    sent = pairing.as_submission(one, {"species": "MusMusculus"}, ("antigen_epitope", "barcode", {"b": "NLV", "c": None}))
    assert sent.columns == ALL and {(r.antigen_epitope, r.species) for r in sent.collect()} == {("NLV", "MusMusculus"), (None, "MusMusculus")}
    assert [x.count() for x in pairing.split_present(sent, "antigen_epitope")] == [2, 1]
    assert all(undotted(dotted(c)) == c for c in ALL)


def test_html(spark):
    text = ["x", "!summary_embed_start!", "a", "<div>", '<pre class="r"><code>', "code", "</code></pre>", "<table>", "!summary_embed_end!", "y"]
    lines = spark.createDataFrame([("p", i, t) for i, t in enumerate(text)], "d string, i int, t string")
    got = [r.t for r in report.html_embed(lines, "d", "i", "t").orderBy("i").collect()]
    assert got[0] == "a" and got[1].startswith("<table class=") and len(got) == 2
