import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curata.operators import reject

HEADER = "cdr3.beta\tspecies\tmhc.a\treference.id\tcomment"
SCHEMA = "line_id bigint, chunk_file string, line_no int, raw_line string, fields int, reasons string"


def lines(spark, *rows):
    return spark.createDataFrame([(i, "f", i, r, 7, "x") for i, r in enumerate([HEADER, *rows], 1)], SCHEMA)


def slow(line):
    """Fields and soundness, character by character."""
    line = line.rstrip("\r")
    fields, sound, at, n = [], True, 0, len(line)
    while True:
        start = at
        if line[at : at + 1] == '"':
            at += 1
            while at < n:
                if line[at] == '"':
                    if line[at + 1 : at + 2] == '"':
                        at += 2
                        continue
                    break
                at += 1
            if at >= n:
                return [*fields, line[start:]], False
            at += 1
            if at < n and line[at] != "\t":
                sound = False
        while at < n and line[at] != "\t":
            at += 1
        fields.append(line[start:at])
        if at >= n:
            return fields, sound
        at += 1


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet='a"\t \r', max_size=14), max_size=6))
def test_index_equals_automaton(texts):
    fields, sound = reject.index_lines(pa.array(texts, pa.string()))
    for text, got, ok in zip(texts, fields.to_pylist(), sound.tolist()):
        want, fine = slow(text)
        assert ok == fine
        if fine:
            assert len(got) == len(want)


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ("CASSLF\tHomoSapiens\tHLA-A*02:01\tPMID:1\t", ""),
        ("\tMusMusculus\tH2-Kb\t\t", ""),
        ('CASSLF\thomosapiens\tHLA-A*02\tUnpublished data\t"a\tb ""c"""\r', ""),
        ("CASSLF\tHomoSapiens\tHLA-A*02:01\tPMID:1", "field count"),
        ('CASSLF\tHomoSapiens\tHLA-A*02:01\tPMID:1\t"a" x', "broken quoting"),
        ('CASSLF\tHomoSapiens\tHLA-A*02:01\tPMID:1\t"a', "broken quoting"),
        ('CASSLF\tHomoSapiens\tHLA-A*02:01\tPMID:1\t5" tube', ""),
        ("CAS\tHomoSapiens\tHLA-A*02:01\tPMID:1\t", "bad cdr3.beta"),
        ("CASSXF\t\tHLA-a*02:01\tPIMD:1\t", "bad cdr3.beta; bad mhc.a; bad species; bad reference.id"),
        ("", "field count"),
        (None, "field count"),
    ],
)
def test_reasons(spark, row, reason):
    found = {r.line_id: r.reasons for r in reject.rejected_lines(lines(spark, row)).collect()}
    assert found.get(2, "") == reason


def test_no_header_long_text_and_empty(spark):
    only = spark.createDataFrame([(1, "g", 2, "a\tb", 0, "")], SCHEMA)
    assert [r.reasons for r in reject.rejected_lines(only).collect()] == ["no header"]
    long = "CASSLF\tHomoSapiens\tH2-K\tPMID:1\t" + "x y" * 200_000
    assert reject.rejected_lines(lines(spark, long)).count() == 0
    assert reject.typed_records(lines(spark, long)).first().comment == "x y" * 200_000
    empty = lines(spark).where("false")
    assert reject.rejected_lines(empty).count() == 0 and reject.typed_records(empty).count() == 0


def test_records_follow_header(spark):
    rows = lines(spark, "CASSLF\tHomoSapiens\tH2-K\tPMID:1\tfine").union(
        spark.createDataFrame([(9, "g", 1, "species\tcomment\tcdr3.beta", 0, ""), (10, "g", 2, "HomoSapiens\t\tCASSF", 0, "")], SCHEMA)
    )
    got = {r.line_id: (r.cdr3_beta, r.species, r.mhc_a, r.comment) for r in reject.typed_records(rows).collect()}
    assert got == {2: ("CASSLF", "HomoSapiens", "H2-K", "fine"), 10: ("CASSF", "HomoSapiens", None, None)}
