"""Numbering, copies, sets, HTML lines and the checkpoint folder."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from curata import session
from curata.operators import fixer, quality, relational, report, tables
from curata.sources import sinks


def test_numbers_in_order(spark):
    rows = spark.range(5000).select(F.pmod(F.col("id") * 7919, F.lit(5000)).alias("k"), F.lit("x").alias("extra"))
    assert [r.n for r in fixer.in_order(rows, ["k"], "n").orderBy("k").collect()] == list(range(1, 5001))
    assert fixer.in_order(rows.where("false"), ["k"], "n").count() == 0


def test_complex_ids(spark):
    rows = spark.createDataFrame([(k, "A" if k % 3 else None, "B" if k % 2 else None) for k in range(60)], "k int, cdr3_alpha string, cdr3_beta string")
    got = {r.k: r.complex_id for r in tables.with_complex_id(rows, ["k"]).collect()}
    paired = [k for k in range(60) if k % 3 and k % 2]
    assert got == {k: paired.index(k) + 1 if k in paired else 0 for k in range(60)}


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_copies(spark, n):
    """A third of all rows are one signature; nulls are values of it."""
    rows = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("s"), F.lit(1).alias("copy_of"))
    flags = {r.id: r.is_copy for r in quality.with_copy_flag(rows, ["id"], ["s"]).collect()}
    numbers = {r.id: r.copy_no for r in quality.numbered_duplicates(rows, ["id"], ["s"]).collect()}
    seen: dict = {}
    for k in range(n):
        s = None if k % 3 == 0 else k % 50
        seen[s] = seen.get(s, 0) + 1
        assert numbers[k] == seen[s] and flags[k] == (seen[s] > 1)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_split_and_kept(spark, how):
    big = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    small = big.where("k <> 7").groupBy("k").agg(F.count("*").alias("n"))
    got = session.hot_split_join(big, small, ["k"], "n", parts=20, how=how)
    assert got.count() == (4000 if how == "left" else 3900) and got.where("k = 0 and n = 2000").count() == 2000 and "__salt" not in got.columns


def test_broadcast_is_bounded_in_bytes(spark):
    rows = spark.createDataFrame([("x" * 1000, 1)] * 50, "s string, n int")
    assert session.fits(rows, 50, 100_000) and not session.fits(rows, 50, 40_000) and not session.fits(rows, 49, 100_000) and session.fits(rows.where("false"))


def test_cluster_needs_a_shared_folder():
    def fake(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_folder(fake("spark://host:7077"))
    assert session.checkpoint_folder(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_sets(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, kind_ string")
    right = spark.createDataFrame([(2, None), (4, "d")], "k int, kind_ string")
    got = sorted((r.kind, r.k) for r in relational.set_comparison(left, right).collect())
    assert got == [("any", 1), ("any", 2), ("any", 3), ("any", 4), ("both", 2), ("left only", 1), ("left only", 3), ("right only", 4)]
    assert relational.set_comparison(left.where("false"), right.where("false")).count() == 0
    documents = spark.createDataFrame([(1, '{"a":1}'), (2, "no"), (3, None)], "k int, d string")
    assert [r.a for r in relational.from_documents(documents, "d", "a int").orderBy("k").collect()] == [1, None, None]
    assert relational.to_documents(left, ["kind_"], "d").where("k = 2").first().d == '{"kind_":null}'


def slow_embed(lines):
    """The loop over the lines, restated."""
    skip, code, out = True, False, []
    for n, line in lines:
        if "!e!" in line:
            skip, code = True, False
        if not skip and '<pre class="r"><code>' in line:
            code = True
        if not skip and not code and not line.startswith(("<div", "</div")):
            out.append(n)
        if "!s!" in line:
            skip, code = False, False
        if not skip and code and "</code></pre>" in line:
            code = False
    return out


def test_html_lines_equal_the_loop(spark):
    rng = random.Random(5)
    pieces = ["!s!", "!e!", '<pre class="r"><code>', "</code></pre>", "<div>", "text", "x"]
    docs = {d: [(n, "".join(rng.choices(pieces, k=rng.choice([1, 1, 2])))) for n in range(size)] for d, size in (("a", 900), ("b", 40), ("c", 0), ("d", 1))}
    rows = spark.createDataFrame([(d, n, t) for d, ls in docs.items() for n, t in ls] + [("a", 5000, None)], "doc string, n int, t string")
    got: dict = {}
    for r in report.html_embed(rows, "doc", "n", "t", "!s!", "!e!").orderBy("n").collect():
        got.setdefault(r.doc, []).append(r.n)
    assert got == {d: slow_embed(ls) for d, ls in docs.items() if slow_embed(ls)}


def test_species_in_any_letter_case(spark):
    segments = spark.createDataFrame([("HomoSapiens", "TRBV1*01", "V", "CASSLG"), ("HomoSapiens", "TRBJ1*01", "J", "YEQYF")], "species string, id string, kind string, seq_aa string")
    inputs = spark.createDataFrame([("homosapiens", "CASSYEQY", "TRBV1", "TRBJ1"), ("HomoSapiens", "CASSYEQY", "TRBV1", "TRBJ1"), (None, "CASSYEQY", "TRBV1", "TRBJ1")], "species string, cdr3 string, v string, j string")
    got = {r.species: (r.fix.good, r.fix.v_id, r.fix.v_fix_type) for r in fixer.fixed_both(inputs, segments).collect()}
    assert got == {"homosapiens": (True, "TRBV1*01", "NoFixNeeded"), "HomoSapiens": (True, "TRBV1*01", "NoFixNeeded"), None: (False, "TRBV1", "FailedBadSegment")}


def test_html_rows(spark):
    rows = spark.createDataFrame([("a<b", 1), (None, 2)], "s string, n int")
    assert {r.html for r in sinks.html_lines(rows).collect()} == {"<tr><td>a&lt;b</td><td>1</td></tr>", "<tr><td></td><td>2</td></tr>"}


def test_cumulative_years(spark):
    rows = spark.createDataFrame([("r1", "TRA", "x"), ("r2", "TRA", "x"), ("r2", "TRB", None), ("r9", "TRA", "z")], "reference_id string, chains string, antigen_epitope string")
    dates = spark.createDataFrame([("r1", 2001), ("r2", 2000), ("r2", 2003), ("r3", 2005), ("r9", None)], "reference_id string, pub_date int")
    got = {(r.pub_date, r.chains): (r.antigen_epitope_count, r.reference_id_count) for r in report.cumulative_by_year(rows, dates, ["antigen_epitope", "reference_id"]).collect()}
    assert got == {(2000, "TRA"): (1, 1), (2001, "TRA"): (1, 2), (2005, "TRA"): (1, 2), (2000, "TRB"): (0, 1), (2001, "TRB"): (0, 1), (2005, "TRB"): (0, 1)}
