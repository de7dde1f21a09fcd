"""Cases that a review found left out."""

from pathlib import Path

import pytest
from compare import difference, views
from pyspark.sql import functions as F

from curata.operators import drift, packed, report
from curata.plans import records

SF = "/root/testdata/sf0.001"


def test_pivot_has_every_value(spark):
    counts = spark.createDataFrame([("x", "NLVAATV", 2), ("x", "NLVLATV", 3), ("y", "NLVAATV", 4), ("y", None, 5)], "city string, antigen_epitope string, n bigint")
    got = report.pivoted(counts, ["city"], "antigen_epitope", "n")
    assert got.columns == ["city", "NLVAATV", "NLVLATV", "null"]
    assert sorted(tuple(r) for r in got.collect()) == [("x", 2, 3, 0), ("y", 4, 0, 5)]
    with pytest.raises(ValueError, match="more than 2"):
        report.pivoted(counts, ["city"], "antigen_epitope", "n", most=2)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["rep_geo", "rep_geo_pivot", "html_embed_filter", "publication_dates", "default_table", "built_default", "built_slim", "built_slim_legacy", "repaired_records", "realign_update", "realign_counts"])
def test_query_equals_sql(spark, name):
    rows, unlike = difference(spark, views(SF), records.QUERIES[name], records.SQL[name], SF)
    assert unlike == "" and rows > 0


def test_repeated_names_keep_their_row(spark):
    files = spark.createDataFrame([(1, "f", "2024-01-01"), (2, "f", "2024-02-01")], "file_id bigint, feed_name string, sent_at string")
    bodies = [(1, '{"record.key":"a","a":1,"n":{"k":1,"k":2}}'), (2, '{"record.key":"a","a":1,"a":"x","b":2}')]
    rows = spark.createDataFrame([(i, f, i, b) for i, (f, b) in enumerate(bodies)], "row_id bigint, file_id bigint, line_no int, row_json string")
    got = {(r.column_name, r.change_kind) for r in drift.changes(files, rows).collect()}
    assert got == {("a", "retyped"), ("b", "added"), ("n", "removed")}
    assert {(r.record_key, r.others) for r in drift.unified(files, rows).collect()} == {("a", '{"a":1,"n":{"k":2}}'), ("a", '{"a":"x","b":2}')}


@pytest.mark.parametrize("text", ["[A][B]", '"A""B"', "A\xa0B", "A\\nB", "<A>B", "A\u2003B", "A\x1fB", "(A)(B)", "‘A’“B”"])
def test_any_delimiter_reaches_the_lattice(spark, text):
    rows = spark.createDataFrame([(1, text), (2, "A"), (3, "B*01:02")], "record_id bigint, f string")
    names = spark.createDataFrame([("f", "A"), ("f", "B")], "field_name string, canonical_name string")
    want = [v for v, _ in packed.Segmenter(["A", "B"]).segment(text)]
    got = sorted((r.record_id, r.value_pos, r.value_text) for r in packed.split_values(rows, names, ["f"]).collect())
    assert got == ([(1, k + 1, v) for k, v in enumerate(want)] if len(want) > 1 else [])
    assert len(want) == 2 or text == "‘A’“B”"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_every_reference_with_a_place_is_counted(spark):
    whole = report.totals_by_reference(records._slim(spark, SF), "SARS-CoV-2").agg(F.sum("n")).first()[0]
    assert records.rep_geo(spark, SF).agg(F.sum("n")).first()[0] == whole


def test_references_without_a_place_are_left_out(spark):
    counts = spark.createDataFrame([("r1", 2), ("r2", 3)], "reference_id string, n bigint")
    places = spark.createDataFrame([("r1", "x"), ("r1", "x")], "reference_id string, city string")
    assert [(r.reference_id, r.city, r.n) for r in report.placed(counts, places).collect()] == [("r1", "x", 2)]
