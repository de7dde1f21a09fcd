from collections import Counter

import pytest
from pyspark.sql import functions as F

from curata.operators import drift, hotkeys, packed
from curata.session import checkpointed, hot_split_join, lookup_join


def test_heavy_keys(spark):
    rows = spark.createDataFrame([("a", "x", 1)] * 60 + [("b", None, 1)] * 36 + [(None, "y", 1)] * 4, "e string, s string, n int")
    got = {(r.field_name, r.key_value) for r in hotkeys.heavy_keys(rows, ["e", "s"]).collect()}
    assert got == {("e", "a"), ("e", "b"), ("s", "x")}
    assert hotkeys.heavy_keys(rows.where("false"), ["e", "s"]).count() == 0


def test_per_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), (None, 5)], "k string, v int")
    got = hotkeys.per_key(rows, "k", {"n": F.count("*")}, {"d": "v"}).collect()
    assert {(r.k, r.n, r.d) for r in got} == {("a", 3, 2), ("b", 1, 0)}


@pytest.mark.parametrize("limit", [0, 100])
def test_joins_keep_hot_keys(spark, limit):
    big = spark.range(3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id")
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    assert lookup_join(big, small.limit(50), ["k"], "left", max_rows=limit).count() == 3000
    assert hot_split_join(big, small, ["k"], "n", parts=10).count() == 3000
    assert hot_split_join(big.where("false"), small.where("false"), ["k"], "n").count() == 0


def test_copies_of_a_large_side_stay_off_the_driver(spark):
    small = checkpointed(spark.createDataFrame([(f"k{k}", k) for k in range(50)], "k string, v int"))  # a file, whose size Spark knows
    joined = lookup_join(small.select("k", F.lit(1).alias("n")), small, ["k"], "inner", max_rows=10)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(r.k, r.v) for r in joined.collect()} == {(f"k{k}", k) for k in range(50)}


NAMES = ["TRBV1", "TRBV10-1", "TRBV5/OR9-3", "H2-Ky, CD8-null", "H2-Ky", "A/B chimera", "A", "B"]


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("TRBV1, TRBV10-1*02", ["TRBV1", "TRBV10-1*02"]),
        ("TRBV5/OR9-3/TRBV1", ["TRBV5/OR9-3", "TRBV1"]),
        ('["TRBV1", "TRBV1"]', ["TRBV1", "TRBV1"]),
        ("'H2-Ky, CD8-null' or H2-Ky", ["H2-Ky, CD8-null", "H2-Ky"]),
        ("H2-Ky, CD8-null", ["H2-Ky, CD8-null"]),
        ("A/B chimera;; A/B", ["A/B chimera", "A", "B"]),
        (" ; TRBV1\n\tTRBV1 |", ["TRBV1", "TRBV1"]),
        ("TRBV1 junk TRBV1", ["TRBV1", "TRBV1"]),
        ("TRBV11", []),
        ("", []),
    ],
)
def test_segments(text, values):
    assert [v for v, _ in packed.Segmenter(NAMES).segment(text)] == values


def slow_expected(segmenter, text):
    """Expected counts by listing every path of the lattice."""
    import math
    from collections import defaultdict

    paths, total, counts = [(0, 0.0, [])], 0.0, defaultdict(float)
    while paths:
        at, cost, names = paths.pop()
        if at == len(text):
            p = math.exp(-cost)
            total += p
            for n in names:
                counts[n] += p
            continue
        for end, c, name, begin, _ in segmenter.edges_at(text, at):
            paths.append((end, cost + c, [*names, name] if name is not None or begin < 0 else names))
    return {n: c / total for n, c in counts.items()}


@pytest.mark.parametrize("text", ["A/B", "A/B chimera, A", "A, xx; B", '"A" / B', "A B/A"])
def test_expected_counts_equal_all_paths(text):
    segmenter = packed.Segmenter(["A", "B", "A/B", "A/B chimera", "A B"], {"A": 5.0, "A/B": 1.0, None: 2.0})
    got, want = segmenter.expected(text), slow_expected(segmenter, text)
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-9 for n in want)


@pytest.mark.parametrize(("others", "values"), [(["A; B", "B; A"] * 60, ["A", "B"]), (["A B; C", "C; A B"] * 60, ["A B"])])
def test_learned_frequencies_decide(spark, others, values):
    rows = spark.createDataFrame([(0, "A B, C"), *[(k + 1, t) for k, t in enumerate(others)]], "record_id bigint, f string")
    names = spark.createDataFrame([("f", n) for n in ("A", "B", "C", "A B")], "field_name string, canonical_name string")
    got = sorted((r.value_pos, r.value_text) for r in packed.split_values(rows, names, ["f"]).where("record_id = 0").collect())
    assert [v for _, v in got] == [*values, "C"]


@pytest.mark.parametrize(("singles", "values"), [(["A", "B"] * 60, ["A", "B"]), (["C"] * 60, ["A B"]), ([None, ""] * 60, ["A B"])])
def test_fields_of_one_value_are_learned_from(spark, singles, values):
    rows = spark.createDataFrame([(0, "A B, C"), *[(k + 1, t) for k, t in enumerate(singles)]], "record_id bigint, f string")
    names = spark.createDataFrame([("f", n) for n in ("A", "B", "C", "A B")], "field_name string, canonical_name string")
    got = sorted((r.value_pos, r.value_text) for r in packed.split_values(rows, names, ["f"]).collect())
    assert [v for _, v in got] == [*values, "C"]


def test_split_values(spark):
    rows = spark.createDataFrame([(1, "A;B", 9), (1, "A;B", 9), (2, None, 9), (3, "A", 9), (4, "", 9), (5, "A," * 3000, 9)], "record_id bigint, f string, field_name int")
    names = spark.createDataFrame([("f", "A"), ("f", "B"), ("g", "C")], "field_name string, canonical_name string")
    got = Counter((r.record_id, r.value_pos, r.value_text) for r in packed.split_values(rows, names, ["f"]).collect())
    assert got[1, 1, "A"] == 2 and got[1, 2, "B"] == 2 and sum(v for (i, _, _), v in got.items() if i == 5) == 3000
    assert {i for i, _, _ in got} == {1, 5}
    assert packed.split_values(rows.where("false"), names, ["f"]).count() == 0


def feeds(spark):
    files = spark.createDataFrame([(1, "f", "2024-01-01"), (2, "f", "2024-02-01"), (3, "f", "2024-02-01"), (4, "g", "2024-01-01"), (5, "f", "2024-03-01")], "file_id bigint, feed_name string, sent_at string")
    bodies = [
        (1, '{"record.key":"a","x":"u","n":1,"gone":null,"o":"p"}'),
        (1, '{"record.key":"b","x":"v","n":2}'),
        (2, '{"record.key":"a","y":"u","n":"1","new":null,"o":null}'),
        (2, '{"record.key":"a","y":"u","n":"1","new":null,"o":null}'),
        (3, '{"record.key":"b","y":"v","n":[1,2],"new":null}'),
        (5, "no json"),
        (5, None),
    ]
    rows = spark.createDataFrame([(i, f, i, b) for i, (f, b) in enumerate(bodies)], "row_id bigint, file_id bigint, line_no int, row_json string")
    return files, rows


def test_changes(spark):
    files, rows = feeds(spark)
    got = {(r.file_id, r.column_name, r.change_kind) for r in drift.changes(files, rows).collect()}
    assert {g for g in got if g[0] == 2} == {(2, "y", "renamed"), (2, "n", "retyped"), (2, "gone", "removed"), (2, "new", "added")}
    assert {g for g in got if g[0] == 3} == {(3, "n", "retyped"), (3, "o", "removed")}
    assert {g[2] for g in got if g[0] == 5} == {"removed"}
    assert drift.changes(files, rows.where("false")).count() == 0


def test_unified(spark):
    files, rows = feeds(spark)
    bodies = ['{"record.key":"k","meta.subset.frequency":"1/4","comment":"r"}', '{"record.key":"k","share":"1/4","Remarks":"r"}', '{"record.key":"k","share":{"num":1,"den":4},"Remarks":["r",7],"z":1}']
    more = spark.createDataFrame([(90 + k, 90 + k, 1, b) for k, b in enumerate(bodies)], rows.schema)
    sent = spark.createDataFrame([(90 + k, "h", f"2024-01-0{k + 1}") for k in range(3)], "file_id bigint, feed_name string, sent_at string")
    own = files.select("file_id", "feed_name", F.col("sent_at").cast("string").alias("sent_at")).union(sent)
    table = drift.unified(own, rows.union(more))
    assert table.count() == 10
    got = {r.row_id: (r.meta_subset_frequency, r.frequency_branch, r.comment, r.others) for r in table.where("row_id >= 90").collect()}
    assert got == {90: (0.25, "string", "r", "{}"), 91: (0.25, "string", "r", "{}"), 92: (0.25, "object", "r (7)", '{"z":1}')}
    assert table.where("others is null").count() == 2


@pytest.mark.parametrize(("value", "kind", "want"), [('"1//4"', "string", 0.25), ('"25%"', "string", 0.25), ("0.25", "number", 0.25), ("[1,4]", "array", 0.25), ('"x"', "string", None), ("[1,0]", "array", None)])
def test_frequency(spark, value, kind, want):
    row = spark.createDataFrame([(value, kind)], "v string, k string").select(drift.frequency_value(F.col("v"), F.col("k")).alias("f")).first()
    assert row.f == want
