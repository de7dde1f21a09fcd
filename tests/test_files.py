import datetime

import pytest

from curata.build import build, main
from curata.schema import ALL, dotted
from curata.sources import chunks, dictionaries, sinks
from curata.streaming.ingest import ingest

ROW = {"cdr3.beta": "CASSYEQY", "v.beta": "TRBV1", "j.beta": "TRBJ1", "species": "HomoSapiens", "mhc.a": "HLA-A*02:01", "mhc.b": "B2M", "mhc.class": "MHCI", "antigen.epitope": "NLVPMVATV", "antigen.gene": "pp65", "reference.id": "PMID:1", "method.frequency": "1//17"}


def chunk(columns, *rows, end="\n"):
    return end.join(["\t".join(columns), *["\t".join(r.get(c, "") for c in columns) for r in rows]]) + end


def written(tmp_path):
    folder, resources = tmp_path / "chunks", tmp_path / "res"
    folder.mkdir()
    resources.mkdir()
    columns = [dotted(c) for c in ALL]
    (folder / "PMID_1.txt").write_text(chunk(columns, ROW, ROW, ROW | {"species": "x"}, ROW | {"cdr3.alpha": "CAVF", "v.alpha": "TRAV1", "j.alpha": "TRAJ1"}))
    (folder / "other.txt").write_bytes(chunk(["comment", *reversed(columns)], ROW | {"comment": 'say "hi"'}, end="\r\n").encode() + b"\n")
    (folder / ".hidden.txt").write_text("a\tb\n1\t2\n")
    (folder / "PMID_2.tsv").write_text("a\tb\n1\t2\n")
    (resources / "antigens.dict").write_text("e\ts\tg\nNLVPMVATV\tCMV\tpp65\nNLVPMVATV HCMV pp65b\n")
    (resources / "nomenclature.tsv").write_text("#old\tnew\nTRBV9\tTRBV1*01,TRBV2\n")
    (resources / "segments.txt").write_text("species\tgene\tsegment\tid\tref\tseq\nHomoSapiens\tTRB\tVariable\tTRBV1*01\t6\tGGATGTGCTAGCAGCCTGGGTA\nHomoSapiens\tTRB\tJoining\tTRBJ1*01\t12\tATATGAACAATATTTTGGC\nHomoSapiens\tTRB\tDiversity\tTRBD1\t0\tGGG\n")
    (resources / "segments.parts.txt").write_text("species\tgene\tcdr3\tx\tsegm\nHomoSapiens\tTRB\tCASS\t\tTRBV1*01\n")
    return str(folder), str(resources)


def test_listing_and_lines(spark, tmp_path):
    folder, _ = written(tmp_path)
    assert {r.chunk_file for r in chunks.list_chunks(spark, folder).collect()} == {"PMID_1.txt", "other.txt"}
    assert {r.chunk_file for r in chunks.list_chunks(spark, folder, ["pmid"], substring=True).collect()} == {"PMID_1.txt"}
    assert chunks.read_lines(spark, folder, ["PMID_1.txt"]).count() == 5
    records, rejects = chunks.read_chunks(spark, folder)
    assert records.count() == 5 and rejects.count() == 0
    assert records.where("comment is not null").first().comment == 'say "hi"'


def test_wide(spark, tmp_path):
    folder, _ = written(tmp_path)
    one, two = chunks.read_wide(spark, f"{folder}/PMID_1.txt"), chunks.read_wide(spark, f"{folder}/other.txt")
    both = chunks.union_wide([one, two])
    assert both.columns == ALL and both.count() == 5 and both.where("cdr3_alpha is null").count() == 4


def test_build(spark, tmp_path):
    folder, resources = written(tmp_path)
    got = build(spark, folder, resources)
    full = got["full"].collect()
    assert len(full) == 4 and {(r.species, r.cdr3_beta, r.v_beta) for r in full} == {("HomoSapiens", "CASSYEQYF", "TRBV1*01"), ("x", "CASSYEQY", "TRBV1")} and {r.antigen_species for r in full} == {"HCMV"}
    assert got["default"].count() == 5
    assert {(r.line_no, r.messages) for r in got["qc"].collect()} == {(3, "duplicate"), (4, "bad species")}
    assert build(spark, folder, resources, policy="drop")["full"].count() == 3
    with pytest.raises(Exception, match="bad row"):
        build(spark, folder, resources, policy="fail")
    sinks.write_table(got["default"], str(tmp_path / "out"), quoted=False)
    again = sinks.read_table(spark, str(tmp_path / "out"))
    assert again.count() == 5 and '"samples.found":' in again.first().meta
    assert "<td>TRB</td>" in sinks.html_table(got["slim"].select("gene"))


def test_tables_of_reference(spark, tmp_path):
    _, resources = written(tmp_path)
    assert [r.antigen_gene for r in dictionaries.antigen_dictionary(spark, f"{resources}/antigens.dict").orderBy("line_no").collect()] == ["pp65", "pp65b"]
    assert dictionaries.nomenclature(spark, f"{resources}/nomenclature.tsv").first().new_names == "TRBV1*01,TRBV2"
    assert dictionaries.segments(spark, f"{resources}/segments.txt").count() == 2
    (tmp_path / "a.tsv").write_text("IMGT/GENE-DB\tNumber of alleles\nTRBV1\t3\n")
    assert dictionaries.allele_numbers(spark, str(tmp_path / "a.tsv")).first().n_alleles == 3
    xml = spark.createDataFrame([('<Id>12</Id><Item Name="PubDate" Type="Date">2019 Jan</Item>',)], "xml string")
    assert tuple(dictionaries.publication_dates(xml).first()) == ("PMID:12", 2019)
    dates = spark.createDataFrame([('<Id>1</Id><Item Name="Title">a</Item><Id>2</Id><Item Name="PubDate" Type="Date">2001 May</Item>',), (None,), ("",)], "xml string")
    assert {tuple(r) for r in dictionaries.with_literal_dates(dictionaries.publication_dates(dates), {"x": 1999, "PMID:2": 1})  .collect()} == {("PMID:1", None), ("PMID:2", 2001), ("x", 1999)}


def test_release(tmp_path):
    (tmp_path / "t.txt").write_text("x")
    day = datetime.date(2024, 5, 1)
    assert sinks.release([str(tmp_path / "t.txt")], str(tmp_path), str(tmp_path / "v.txt"), "https://h", day)
    assert not sinks.release([str(tmp_path / "t.txt")], str(tmp_path), str(tmp_path / "v.txt"), "https://h", day)
    assert (tmp_path / "v.txt").read_text() == "https://h/records-2024-05-01.zip\n"


def test_stream(spark, tmp_path):
    folder, _ = written(tmp_path)
    chunks.read_lines(spark, folder).write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "lines")).schema).parquet(str(tmp_path / "lines"))
    ingest(stream, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "good")).count() == 4 and spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_stream_keeps_headers(spark, tmp_path):
    rows = [(1, "f", 1, "species\tcomment"), (2, "f", 2, "HomoSapiens\ta"), (3, "f", 3, "HomoSapiens\tb"), (4, "g", 2, "HomoSapiens\tc")]
    schema = "line_id bigint, chunk_file string, line_no int, raw_line string"
    for k, part in enumerate([rows[:2], rows[2:]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "lines"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "lines"))
        ingest(stream, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.comment for r in spark.read.parquet(str(tmp_path / "good")).collect()) == ["a", "b"]
    assert [r.reasons for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["no header"]


def test_lines_of_split_files_and_quoted_line_ends(spark, tmp_path):
    (tmp_path / "a.txt").write_text('h1\th2\n1\t"x\ny ""z"""\n' + "".join(f'{k}\tv{k}\n' for k in range(2, 3000)) + '9\t"open\n10\tb\n11\t"q"\n12\t"a\n\n"b\n', newline="")
    whole = {(r.line_no, r.raw_line) for r in chunks.read_lines(spark, str(tmp_path)).collect()}
    assert (2, '1\t"x\ny ""z"""') in whole and (4, "2\tv2") in whole and len(whole) == 1 + 1 + 2998 + 3 + 3
    assert {(3002, '9\t"open'), (3003, "10\tb"), (3004, '11\t"q"'), (3005, '12\t"a'), (3006, ""), (3007, '"b')} <= whole
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert {(r.line_no, r.raw_line) for r in chunks.read_lines(spark, str(tmp_path)).collect()} == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headers_of_all_shapes(spark, tmp_path):
    folder, resources = written(tmp_path)
    columns = [dotted(c) for c in ALL]
    (tmp_path / "chunks" / "short.txt").write_text(chunk(columns[:-1], ROW))
    (tmp_path / "chunks" / "twice.txt").write_text(chunk([*columns, "species"], ROW))
    (tmp_path / "chunks" / "empty.txt").write_text("\n" + "x\n")
    (tmp_path / "chunks" / "wide.txt").write_text(chunk(["chunk.id", *columns, "meta.subset.frequency", "comment", "submitter", "method.pairing"], ROW | {"chunk.id": "7"}))
    (tmp_path / "chunks" / "ragged.txt").write_text(chunk(columns, ROW) + "a\tb\n" + '"broken\n')
    records, rejects = chunks.read_chunks(spark, folder, required=ALL)
    assert records.count() == 7 and records.where("chunk_id = '7'").count() == 1
    assert {(r.chunk_file, r.reasons.split(":")[0]) for r in rejects.collect()} == {("short.txt", "missing columns"), ("twice.txt", "duplicate columns"), ("empty.txt", "no header"), ("ragged.txt", "field count"), ("ragged.txt", "broken quoting")}
    with pytest.raises(ValueError, match="empty.txt: no header"):
        chunks.read_chunks(spark, folder, required=ALL, policy="fail")


def test_every_table_of_the_build(spark, tmp_path):
    folder, resources = written(tmp_path)
    (tmp_path / "alleles.tsv").write_text("IMGT/GENE-DB\tNumber of alleles\nTRBV1\t1\nTRBJ1\t1\n")
    (tmp_path / "members.tsv").write_text("gene\tantigen.epitope\tspecies\tcdr3aa\nTRB\tNLVPMVATV\tHomoSapiens\tCASSYEQYF\n")
    main([folder, resources, str(tmp_path / "out"), "--fix2", "--alleles", str(tmp_path / "alleles.tsv"), "--clusters", str(tmp_path / "members.tsv"), "--report"])
    records = sinks.read_table(spark, str(tmp_path / "out" / "report" / "records")).collect()
    assert {(r.species, r.gene, r.records, r.paired_records) for r in records} == {("HomoSapiens", "TRA", "1", "1"), ("HomoSapiens", "TRB", "1", "1"), ("x", "TRB", "1", "0")}
    assert (tmp_path / "out" / "report_html" / "naming").exists()
    tables = {p.name: sinks.read_table(spark, str(p)) for p in (tmp_path / "out").iterdir() if not p.name.startswith(("_", "report"))}
    counts = {n: t.count() for n, t in tables.items()}
    assert counts == {
        "full": 4, "default": 5, "slim": 3, "meta": 21, "slim_meta": 18, "rejects": 0, "qc": 2, "realign_counts": 1, "full_filtered": 2, "full_gene_broken": 1, "full_allele_broken": 0, "full_cdr3aa_broken": 1,
        "full_scored": 4, "default_scored": 5, "slim_scored": 3,
    }
    assert tables["default"].columns[0] == "complex_id" and {"method", "meta", "cdr3fix", "web_method", "web_method_seq", "web_cdr3fix_nc", "web_cdr3fix_unmp", "pgen_score"} <= set(tables["default"].columns)
    assert {"v_end", "j_start", "tcr_hash", "pgen_score"} <= set(tables["slim"].columns)
    assert {(r.species, r.cluster_member) for r in tables["full_scored"].collect()} == {("HomoSapiens", "1"), ("x", "0")}
    assert (tmp_path / "out" / "full").exists() and tables["full"].columns[0] == "cdr3_alpha"
