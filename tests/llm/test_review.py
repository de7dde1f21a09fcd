"""Cases that a review found left out."""

import random
from pathlib import Path

import pytest
from compare import difference, views
from pyspark.sql import functions as F

from curata import session
from curata.llm import canonical, ledger, mixture, queries, survivor
GENES = [(1, "TRAV1"), (2, "TRAV10-1"), (3, "TRAV10-2"), (4, "TRAV5-2"), (5, "TRAV35/DV2")]


def test_no_text_of_a_field_is_lost(spark):
    texts = [
        ("note: A; B", "note=ab"), ("note: A; C", "note=ac"), ("note: A|B\nC;x=1;", "note=abc;x=1"), ("A; note: B; y=", "=a;note=b"), (";;note:;B", "note=b"), ("B", "=b"), ("", ""), (None, ""),
        ('{"n": ["a", "b"], "m": "x, \\"y\\": 1", "z": null, "e": ""}', "m=xy1;n=ab"), ('{"n": ["a", "c"]}', "n=ac"), ('{"n": 1.50, "o": {"p": true}}', "n=150;o=ptrue"), ('{"n": 1, "n": 2}', "n=1;n=2"), ("{}", ""),
        ('{"n": "a", "b"', "n=ab"), ('{"n": "a"} rest', "n=arest"), ('{"n": [1.50, -2], "m": 0.12345678901234567891, "s": "a, 5, \\u0041"}', "m=012345678901234567891;n=1502;s=a5a"),
        ('{"n": "' + "ab " * 20000 + '"}', "n=" + "ab" * 20000),
    ]
    rows = spark.createDataFrame([(t, w) for t, w in texts], "t string, want string").select("t", "want", ledger.canonical_fields(F.col("t")).alias("got"))
    assert [(r.t, r.got) for r in rows.collect()] == texts


def test_any_number_of_registries_is_counted(spark):
    rows = spark.range(600).selectExpr("id AS line_id", "CASE WHEN id % 7 > 0 THEN concat('r', id % 150) END AS registry", "concat('k', id % 200) AS a")
    keys = ledger.keyed(rows, ["a"], [], "line_id", "registry")
    want = {(r.k1, r.k2): (r.n_copies, r.first_id) for r in ledger.counted(keys).collect()}
    assert {(r.k1, r.k2): (r.n_copies, r.first_id) for r in ledger.ledger_of(keys).collect()} == want
    assert ledger.copies(keys, ledger.ledger_of(keys)).count() == 400


@pytest.mark.parametrize(
    ("typed", "want"),
    [("TRAV1" + " " * 5000 + "*01", 1), ("-" * 300 + "TRAV10_2", 3), ("TRAV" + "0" * 300 + "1", 1), ("TRAV1*02" + ":03" * 100, 1), ("TRAV10" + " " * 900 + "-1", 2), ("TRAV1 " + "x" * 300, 0), ("1" * 20_000, 0)],
)
def test_long_names_are_searched(typed, want):
    assert canonical.NameTrie(GENES).resolve(typed)[0] == want


def test_all_entries_within_distance_are_listed(spark):
    rows = spark.createDataFrame([(1, "TRAVV1"), (2, "mixed"), (3, "DRB1*2313")], "record_id bigint, v_alpha string")
    names = spark.createDataFrame([("v_alpha", i, n) for i, n in [*GENES, (6, "TRBV1"), (7, "TRDV1")]], "field_name string, name_id bigint, canonical_name string")
    got = {r.record_id: ([tuple(x) for x in r.within], r.name_id) for r in canonical.canonical_names(rows, names, ["v_alpha"]).collect()}
    assert got[1][1] == 1 and got[1][0][0] == (1, 1) and {e for e, _ in got[1][0]} == {1, 6, 7} and got[2] == ([], 0)


def test_every_usable_source_gets_a_slot(spark):
    given = [0.5, 0.49998, 0.00002]
    bits = mixture.bits_for(given, 10)
    counts = [n for _, n in mixture.intervals(given, bits)]
    assert sum(counts) == 1 << bits and abs(counts[2] / (1 << bits) - 0.00002) < 0.000003
    assert [n for _, n in mixture.intervals([1.0, 1e-9, 1e-9], 4)] == [14, 1, 1]
    docs = spark.createDataFrame([(i, f"cell beta {i}", "big") for i in range(3000)] + [(9000 + i, f"gamma {i}", "tiny") for i in range(40)], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("m", "big", 0.9999, 5), ("m", "tiny", 0.0001, 5)], "mix_name string, source_name string, target_share double, max_repeats int")
    reached = {r.source: r.n_texts for r in mixture.shares(docs, targets, queries.TOKENIZER).collect()}
    assert reached["tiny"] > 0 and {r.source for r in mixture.mixed(docs, targets, queries.TOKENIZER).collect()} == {"big", "tiny"}


@pytest.mark.parametrize("text", ["ab" * 60_000, "a" * 70_000 + " b", "ab\n" * 30_000, "ab   \n  c" * 9000, "x" * 49_999 + "    y" + " z" * 5])
def test_long_texts_have_the_tokens_of_the_whole(text):
    encoding = mixture._encoding(queries.TOKENIZER)
    assert "".join(mixture.pieces(text)) == text
    assert sum(len(encoding.encode_ordinary(p)) for p in mixture.pieces(text)) == len(encoding.encode_ordinary(text))


def test_composed_and_decomposed_letters_are_one(spark):
    rows = spark.createDataFrame([(1, "café", "x=café"), (2, "café", '{"x":"caf\\u00e9"}'), (3, "cafe", "x=cafe"), (4, "CAFÉ", "X: Café"), (5, "café", '{"x":"cafe\\u0301"}')], "line_id bigint, a string, t string")
    keys = ledger.keyed(rows, ["a"], ["t"], "line_id")
    assert {tuple(r) for r in ledger.copies(keys, ledger.ledger_of(keys)).collect()} == {(1, 2), (1, 4), (1, 5)}


def test_buckets_double_and_old_folders_go(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id AS line_id", "concat('k', id % 900) AS a")
    keys = ledger.keyed(rows, ["a"], [], "line_id")
    store = ledger.Ledger(spark, str(tmp_path / "ledger"), buckets=2, bucket_rows=150)
    for k in range(4):
        store.add(keys.where(f"id % 4 = {k}"))
    again = ledger.Ledger(spark, str(tmp_path / "ledger"))
    assert again.state["buckets"] == 8 and again.state["rows"] == 900
    want = {(r.k1, r.k2): (r.n_copies, r.first_id) for r in ledger.counted(keys).collect()}
    assert {(r.k1, r.k2): (r.n_copies, r.first_id) for r in again.read().collect()} == want
    assert again.read([0, 5]).count() == sum(n for b, n in again.state["sizes"].items() if b in ("0", "5"))
    used = {f.split("/")[0] for f in again.state["folders"].values()} | {f.split("/")[0] for f in again.state["unused"]}
    kept = {p.parent.name for p in (tmp_path / "ledger").glob("v*/bucket=*")}
    assert kept <= used and len(list((tmp_path / "ledger" / "versions").glob("*.json"))) == 2


def test_a_thousand_batches(spark):
    rows = spark.range(5000).selectExpr("id AS line_id", "concat('r', id % 1000) AS registry", "concat('k', id % 700) AS a")
    keys = ledger.keyed(rows, ["a"], [], "line_id", "registry")
    want = {(r.k1, r.k2): (r.n_copies, r.first_id) for r in ledger.counted(keys).collect()}
    assert {(r.k1, r.k2): (r.n_copies, r.first_id) for r in ledger.ledger_of(keys).collect()} == want


def test_rare_sources_share_a_quality(spark, monkeypatch):
    monkeypatch.setattr(survivor, "SOURCES", 2)
    schema = "complex_key string, version_id bigint, entered_by string, trust_rank int, updated_at string, reference_id string"
    rows = [(f"k{k}", 10 * k + j, s, 1, "2024-01-01 00:00:00", f"t{k}" if s != f"rare{k % 5}" else "wrong") for k in range(40) for j, s in enumerate(("a", "b", f"rare{k % 5}"))]
    judged = survivor.fused(spark.createDataFrame(rows, schema), ["reference_id"], survivor.trusted_order()).collect()
    assert all(r.is_true == r.value_text.startswith("t") for r in judged) and len(judged) == 80


def test_survivors_keep_all_true_values(spark):
    schema = "complex_key string, version_id bigint, entered_by string, trust_rank int, updated_at string, reference_id string"
    rows = [("k", 1, "a", 2, "2024-01-01 00:00:00", "x"), ("k", 2, "b", 2, "2024-01-01 00:00:00", "x"), ("k", 3, "c", 1, "2024-01-01 00:00:00", "z"), ("j", 4, None, 1, "2024-01-01 00:00:00", "x"), ("j", 5, "a", 1, "2024-01-01 00:00:00", "n/a")]
    judged = survivor.fused(spark.createDataFrame(rows, schema), ["reference_id"], survivor.trusted_order())
    got = {r.complex_key: (r.reference_id, r.reference_id_true) for r in survivor.survivors(judged, ["reference_id"]).collect()}
    assert got["k"][0] == "z" and got["k"][1][0] == "x" and got["j"][0] == "x"


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    rows, unlike = difference(spark, views(SF), queries.QUERIES[name], queries.SQL[name], SF)
    assert unlike == "" and rows > 0


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["p4_found", "p4_values"])
def test_each_of_many_sources_has_a_quality_of_its_own(spark, monkeypatch, tmp_path, name):
    """One source with two thirds of the versions, 60 rarer ones of uneven quality: equal to the SQL, whose model knows no pools."""
    monkeypatch.setattr(survivor, "SOURCES", 3)
    rare = F.col("version_id") % 3 == 0
    versions = spark.read.parquet(f"{SF}/record_versions.parquet").withColumn("entered_by", F.when(rare, F.concat("entered_by", F.col("version_id") % 45)).otherwise(F.lit("most")))
    versions.withColumn("meta_study_id", F.when(rare & (F.col("version_id") % 5 == 0), F.concat(F.lit("s"), F.col("version_id") % 2)).otherwise(F.col("meta_study_id"))).write.parquet(str(tmp_path / "record_versions.parquet"))
    rows, unlike = difference(spark, views(str(tmp_path)), queries.QUERIES[name], queries.SQL[name], str(tmp_path))
    assert unlike == "" and rows > 0


def test_few_and_many_sources_are_judged_alike(spark, monkeypatch):
    """Null sources, a field in which only such speak, repeated claims, keys of one version and one of a third of all rows."""
    rng = random.Random(5)
    schema = "complex_key string, version_id bigint, entered_by string, trust_rank int, updated_at string, reference_id string, other string"
    given = [(rng.choice(["hot", f"k{rng.randint(0, 150)}", f"k{rng.randint(0, 150)}"]), i, rng.choice([None, "a", f"s{rng.randint(0, 30)}"]), 1, "2024-01-01 00:00:00", rng.choice(["x", "y", "z", "n/a", None]), rng.choice(["p", "q", ""])) for i in range(900)]
    versions = spark.createDataFrame([*given, ("mute", 901, None, 1, None, "x", "p"), ("mute", 902, None, 1, None, "y", None), (None, 903, "a", 1, None, "x", "p")], schema)

    def judged():
        rows = survivor.fused(versions, ["reference_id", "other"], survivor.trusted_order(), rounds=2).withColumn("truth", F.round("truth", 6)).collect()
        return sorted(tuple(r) for r in rows)

    few = judged()
    monkeypatch.setattr(survivor, "SOURCES", 2)
    many = judged()
    assert many == few and ("mute", "reference_id", "x", 1, 0.5, True, 901, True) in many
    monkeypatch.setattr(survivor, "lookup_join", lambda big, small, on, how="left": session.lookup_join(big, small, on, how, max_rows=0))
    assert judged() == few


CITIES = [(1, "New York"), (2, "San Francisco"), (3, "Newark"), (4, "São Paulo"), (5, "Saint Petersburg")]


@pytest.mark.parametrize(("typed", "want"), [("new york", 1), ("NewYork", 1), ("New Yrok", 1), ("san fransisco", 2), ("SF", 2), ("newark", 3), ("sao paulo", 4), ("Sankt Petersburg", 5), ("St. Petersburg", 5), ("Boston", 0), ("", 0)])
def test_names_of_another_kind(typed, want):
    """Without a vocabulary only the list and its aliases count."""
    trie = canonical.NameTrie(CITIES, canonical.Vocabulary(), [(2, "SF"), (5, "St Petersburg")])
    assert trie.resolve(typed)[0] == want


def noisy(name, rng, edits=0.35):
    """A spelling of a listed name by a noise of its own: case, separators, blanks, marks, one edit, an allele."""
    text = list(name)
    if rng.random() < edits:
        letters = [k for k, c in enumerate(text) if c.isalpha() and (k + 1 == len(text) or not text[k + 1].islower())]
        k = rng.choice(letters)
        text[k : k + 1] = rng.choice([[text[k], text[k]], [rng.choice("QXWZ")]]) if rng.random() < 0.7 else []
    out = "".join(text)
    if rng.random() < 0.4:
        out = rng.choice([str.lower, str.upper, str.title])(out) if name[-1] not in "abcdefghijklmnopqrstuvwxyz" else out
    if rng.random() < 0.3:
        out = out.replace("-", rng.choice([" ", "_", "."]))
    if rng.random() < 0.2 and name.startswith("TR"):
        out += rng.choice(["*01", "*02", "*01:02"])
    return rng.choice(["", " ", "(", '"']) + out + rng.choice(["", " ", ".", " ?", ";"])


def test_recall_and_precision_on_generated_spellings():
    """Spellings of all listed names, and of genes that are not listed (without edits of letters, since
    TRAX1, say, may mean TRAV1 as well as TRAJ1, and the field's own family holds)."""
    rng = random.Random(11)
    listed = [f"TRAV{k}" for k in range(1, 42)] + [f"TRAV{k}-{m}" for k in (8, 12, 13) for m in (1, 2, 3)]
    entries = [(k + 1, n) for k, n in enumerate(listed)]
    trie = canonical.NameTrie(entries)
    right = wrong = missed = 0
    for name_id, name in entries * 20:
        got = trie.resolve(noisy(name, rng))[0]
        right, wrong, missed = right + (got == name_id), wrong + (got not in (0, name_id)), missed + (got == 0)
    others = [f"TRAV{k}" for k in range(50, 99)] + [f"TRBV{k}" for k in range(1, 30)] + [f"TRAJ{k}" for k in range(1, 60)] + ["CD8", "mixed", "unknown", "n/a"]
    false = sum(trie.resolve(noisy(n, rng, 0))[0] != 0 for n in others * 6)
    assert right / (right + wrong + missed) >= 0.9 and right / (right + wrong + false) >= 0.98, (right, wrong, missed, false)
