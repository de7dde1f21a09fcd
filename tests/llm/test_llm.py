import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.llm import canonical, leakage, ledger, mixture, pii, survivor
from curata.llm.queries import TOKENIZER

# Names -------------------------------------------------------------------------------------------

GENES = [(1, "TRAV1"), (2, "TRAV10-1"), (3, "TRAV10-2"), (4, "TRAV5-2"), (5, "TRAV35/DV2"), (6, "TRAV7")]
MHC = [(11, "B2M"), (12, "HLA-DRB1*23:13"), (13, "HLA-DQB1*16:45"), (14, "H2-IAv"), (15, "H2-IEv")]


@pytest.mark.parametrize(
    ("typed", "want"),
    [
        ("trav1", 1), ("TRAVl", 1), ("TRAV01*02", 1), ("human AV1", 1), ("hTRAV1", 1), ("RTAV1", 1), ("TRAVV1 [IMGT]", 1), ("V-alpha-1", 1), ("Vα10_2", 3), ("TCRAVI0-2;", 3),
        ("TRAV10s1", 2), ("Valpha 35/DV02", 5), ("'TRAV1O-1?", 2), ("TRAV1 segment*02", 1),
        ("TRAV10", 0), ("TRAV1-2", 0), ("TRAV77", 0), ("TRGV7", 0), ("TRDV1", 0), ("TRBV10-1", 0), ("IGKV5-2", 0), ("mixed", 0), ("?", 0), ("", 0), ("x" * 100_000, 0),
    ],
)
def test_gene_names(typed, want):
    assert canonical.NameTrie(GENES).resolve(typed)[0] == want


@pytest.mark.parametrize(
    ("typed", "want"),
    [
        ("beta-2 microglobuline", 11), ("BM2", 11), ("BZM?", 11), ("microglobulin, beta 2", 11), ("hB2M", 11), ("HLA-DRB1*23:13:01", 12), ("drb1*2313", 12), ("HLA-DRB123:13 allele", 12), ("HL-DBR1*23;13", 12),
        ("GLA-DBQ1 16:45:01:01", 13), ("mouse iav", 14), ("H2-1Av", 14), ("I-Ev", 15),
        ("HLA-DQB1*23:13", 0), ("HLA-DRB1*23:14", 0), ("HLA-E*01:72", 0), ("HLA-DRB11*23:13", 0), ("H2-IAz", 0), ("H2-M4", 0), ("CD1d", 0), ("TAP2", 0),
    ],
)
def test_mhc_names(typed, want):
    assert canonical.NameTrie(MHC).resolve(typed)[0] == want


def test_all_entries_within_distance_equal_brute_force():
    """Against plain edit distance (with swaps) over the letters of the family, digits being equal."""

    def distance(a, b):
        d = np.add.outer(np.arange(len(a) + 1), np.arange(len(b) + 1)).astype(int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[-1, -1]

    trie, rng = canonical.NameTrie(GENES[:4]), random.Random(5)
    for _ in range(300):
        letters = "".join(rng.choices("travk", k=rng.randint(2, 5)))
        if letters[0] in "h":
            continue
        got = trie.matches(letters + "10-1").get(2)
        spelled = {"trav": 2, "tcrav": 2, "av": 1, "valpha": 2, "va": 1}
        want = min([distance(letters, f) for f, limit in spelled.items() if distance(letters, f) <= limit], default=None)
        assert got == want, letters


def test_canonical_names(spark):
    rows = spark.createDataFrame([(1, "TRAV1", "x"), (2, "trav1", "x"), (2, "trav1", "x"), (3, None, "x"), (4, "", "x"), (5, "TRAV99", "x")], "record_id bigint, v_alpha string, typed string")
    names = spark.createDataFrame([("v_alpha", i, n) for i, n in GENES], "field_name string, name_id bigint, canonical_name string")
    got = Counter((r.record_id, r.name_id) for r in canonical.canonical_names(rows, names, ["v_alpha"]).collect())
    assert got == {(2, 1): 2, (4, 0): 1, (5, 0): 1}
    assert canonical.canonical_names(rows.where("false"), names, ["v_alpha"]).count() == 0


# Survivors ---------------------------------------------------------------------------------------

VERSION = "complex_key string, version_id bigint, entered_by string, trust_rank int, updated_at string, reference_id string, other string"


def test_fused(spark):
    rows = [
        ("k", 1, "a", 2, "2024-01-01 00:00:00", "R1", "y"), ("k", 2, "b", 1, "2023-01-01 00:00:00", " n/a ", "y"), ("k", 3, "c", 2, "2024-02-01 00:00:00", "R2", "y"), ("k", 4, "c", 2, "2024-02-01 00:00:00", "R3", "y"),
        ("lone", 5, "a", 1, "2024-01-01 00:00:00", "R9", "y"), ("none", 6, "a", 1, None, "TBD", "y"), ("none", 7, None, None, None, None, "y"), (None, 8, "a", 1, None, "R", "y"), (None, 9, "a", 1, None, "R", "y"),
    ]
    judged = survivor.fused(spark.createDataFrame(rows, VERSION), ["reference_id"], survivor.trusted_order())
    assert [(r.complex_key, r.version_id) for r in judged.where("is_best").collect()] == [("k", 3)]
    assert judged.count() == 3
    assert survivor.survivors(judged, ["reference_id"]).first().reference_id == "R2"
    assert survivor.fused(spark.createDataFrame([], VERSION), ["reference_id"], survivor.trusted_order()).count() == 0


def test_quality_is_found(spark):
    """Good sources state the true value nine times in ten, a bad one rarely; the model tells them apart."""
    rng, rows, truth = random.Random(1), [], {}
    for k in range(400):
        truth[f"k{k}"] = f"t{k}"
        for s, right in (("good1", 0.95), ("good2", 0.9), ("bad", 0.3)):
            value = f"t{k}" if rng.random() < right else f"w{rng.randint(0, 9)}"
            rows.append((f"k{k}", len(rows), s, 1, "2024-01-01 00:00:00", value, ""))
    versions = spark.createDataFrame(rows, VERSION)
    judged = survivor.fused(versions, ["reference_id"], survivor.trusted_order()).collect()
    hits = [r.is_true == (r.value_text == truth[r.complex_key]) for r in judged]
    assert sum(hits) / len(hits) > 0.85


# Ledger ------------------------------------------------------------------------------------------

LINE = "line_id bigint, registry string, a string, attribute_text string, n_copies int"


def registry(spark):
    rows = [
        (3, "r1", "CAS-F", "x=1; y=2", 0), (7, "r2", "casf ", '{"Y": "2", "X": "1"}', 0), (9, "r2", "c.a.s.f", "y : 2\nx : 1.", 0), (4, "r1", "CASF", "x=1; y=3", 0), (5, "r1", None, "x=1", 0), (6, "r2", " ", "x:1; y=", 0),
        (8, "r1", "CASF", "x=12; y=", 0), (10, None, None, None, 0), (11, None, "", "", 0),
    ]
    return spark.createDataFrame(rows, LINE)


def test_copies(spark):
    rows = registry(spark)
    keys = ledger.keyed(rows, ["a"], ["attribute_text"], "line_id", "registry")
    counts = ledger.ledger_of(keys)
    assert {tuple(r) for r in ledger.copies(keys, counts).collect()} == {(3, 7), (3, 9), (5, 6), (10, 11)}
    assert {(r.line_id, r.n_copies) for r in ledger.collapsed(rows.drop("n_copies"), counts).collect()} == {(3, 3), (4, 1), (5, 2), (8, 1), (10, 2)}
    none = ledger.keyed(rows.where("false"), ["a"], ["attribute_text"], "line_id", "registry")
    assert ledger.copies(none, ledger.ledger_of(none)).count() == 0


def test_hot_group_and_store(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id AS line_id", "'r' AS registry", "CASE WHEN id % 3 = 0 THEN 'Hot ' ELSE concat('k', id) END AS a", "cast(null as string) AS attribute_text")
    keys = ledger.keyed(rows, ["a"], ["attribute_text"], "line_id", "registry")
    assert ledger.copies(keys, ledger.ledger_of(keys)).count() == 1666
    store = ledger.Ledger(spark, str(tmp_path / "ledger"), buckets=4)
    store.add(keys.where("id < 2000"))
    store.add(keys.where("id >= 2000"))
    whole = {(r.k1, r.k2): (r.n_copies, r.first_id) for r in ledger.counted(keys).collect()}
    assert {(r.k1, r.k2): (r.n_copies, r.first_id) for r in store.read().collect()} == whole


# Leakage -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("sent", [20_000, 3])
def test_leaks_equal_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(leakage, "SENT_ITEMS", sent)
    rng = random.Random(2)
    words = [f"w{k}" for k in range(30)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 40)))) for i in range(12)]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.randint(0, 30))
        if d % 2:
            own = items[d % 12][1].split()
            at = rng.randint(0, len(own))
            text += own[at : at + rng.randint(5, 20)] + rng.choices(words, k=3)
        docs.append((d, "  ".join(text).upper() if d % 3 else "_".join(text) + ".", 1))
    docs += [(100, None, 1), (101, "", 1), (102, "w1 " * 60_000, 1)]

    def grams(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return {tuple(w[k : k + 6]) for k in range(len(w) - 5)}

    want = {(d, i) for d, t, _ in docs if t for i, x in items if grams(t) & grams(x)}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    table = spark.createDataFrame(items, "item_id bigint, item_text string")
    assert {(r.doc_id, r.item_id) for r in leakage.leaked(frame, table, least=6).collect()} == want
    assert leakage.leaked(frame.where("false"), table).count() == 0 and leakage.leaked(frame, table.where("false")).count() == 0


def test_tiles_find_moved_passages():
    item = np.arange(1, 31)
    text = np.concatenate((item[20:30], [0], item[0:15]))
    assert sorted(leakage.tiles(text, item, 5)) == [(0, 20, 10), (11, 0, 15)]


# Mixtures ----------------------------------------------------------------------------------------


def test_mixture(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(["cell", "beta", "gamma"], k=rng.randint(5, 60))) + f" {i}", "big" if i % 3 else "small") for i in range(900)]
    docs += [(1000 + i, docs[i][1], "small") for i in range(20)] + [(2000, None, "big"), (2001, "", "big")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("m", "big", 0.4, 1), ("m", "small", 0.5, 3), ("m", "gone", 0.1, 2), ("e", "gone", 1.0, 1)], "mix_name string, source_name string, target_share double, max_repeats int")
    used = mixture.mixed(frame, targets, TOKENIZER).collect()
    copies = {(r.doc_id, r.copy) for r in used}
    text_of = {i: t for i, t, _ in docs}
    assert max(Counter(text_of[i] for i, _ in copies).values()) == 3 and {c for i, c in copies if i in {r.doc_id for r in used if r.source == "big"}} == {1}
    size = {i: len(mixture._encoding(TOKENIZER).encode_ordinary(t)) for i, t, _ in docs if t}
    taken = {}
    for r in used:
        taken.setdefault((r.doc_id, r.copy), []).extend(range(r.first_token, r.first_token + r.n_tokens))
    assert all(len(set(v)) == len(v) and max(v) <= size[i] for (i, _), v in taken.items())
    assert sum(len(v) == size[i] for (i, _), v in taken.items()) >= len(taken) - 2  # only the last text of a source may be cut off
    slots = Counter()
    for r in used:
        slots[r.slot] += r.n_tokens
    assert set(slots) == set(range(4096)) and max(slots.values()) - min(slots.values()) <= 1
    table = {(r.mix_name, r.source): r for r in mixture.shares(frame, targets, TOKENIZER).collect()}
    assert abs(table["m", "big"].reached_share - 4 / 9) < 0.0005 and abs(table["m", "small"].reached_share - 5 / 9) < 0.0005
    assert table["m", "gone"].n_tokens == 0 and table["e", "gone"].reached_share == 0
    assert sum(r.n_tokens for r in used) == sum(r.n_tokens for r in table.values())
    assert mixture.mixed(frame.where("false"), targets, TOKENIZER).count() == 0
    with pytest.raises(Exception, match="no vocabulary at /nowhere"):
        mixture.shares(frame, targets, "/nowhere").collect()


def test_schedule_is_even(spark):
    """Slots by bit reversal are those of the van der Corput sequence, and every stretch has the shares."""
    spans = mixture.intervals([0.5, 0.3, 0.2], 10)
    assert [n for _, n in spans] == [512, 307, 205]
    rows = spark.range(1024).select("id", mixture.slot_number(F.col("id"), F.lit(10)).alias("slot")).collect()
    point = {r.slot: r.id for r in rows}
    assert sorted(point) == list(range(1024)) and all(point[s] == sum(((s >> k) & 1) << (9 - k) for k in range(10)) for s in point)
    source = np.array([next(k for k, (a, n) in enumerate(spans) if a <= point[s] < a + n) for s in range(1024)])
    assert all(abs((source[:n] == 0).mean() - 0.5) < 0.05 for n in range(50, 1024, 50))
    assert mixture.bits_for([0.5, 0.5], 2**40) == 20 and mixture.bits_for([1.0, 1e-9], 10) > 30


# Personal information ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Reply to j.doe+x@mail.site.example by Friday.", [("email", "j.doe+x@mail.site.example")]),
        ("cc data dot desk at lab2 dot example dot org; A.B @ c.net", [("email", "data dot desk at lab2 dot example dot org"), ("email", "A.B @ c.net")]),
        ("to me_1 [at] site [dot] org now", [("email", "me_1 [at] site [dot] org")]),
        ("Wells at 50 nM: PEPTIDE@50nM.", []),
        ("Mrs Tredotti called from (555) 555-0170 about it.", [("person_name", "Tredotti"), ("phone", "555) 555-0170")]),
        ("Call +44 (0)20 7946 0571 or 030/23125101, 5 5 5 - 0 1 5 3.", [("phone", "+44 (0)20 7946 0571"), ("phone", "030/23125101"), ("phone", "5 5 5 - 0 1 5 3")]),
        ("catalogue no. 173-93-6471, Order 0082-53-43, lot 76-328-5188, PMID:93117901", []),
        ("Donor 3 (passport X00112215) withdrew; SSN: 000-12-3456", [("id_number", "X00112215"), ("id_number", "000-12-3456")]),
        ("Key holder is Vae von Stuz (QQ 13 42 26 B).", [("person_name", "Vae von Stuz"), ("id_number", "QQ 13 42 26 B")]),
        ("Ship the vials to 12b Oak Lane, Flat 3, Lyston 00123. Then", [("street_address", "12b Oak Lane, Flat 3, Lyston 00123")]),
        ("lives at Baumstraße 7, 00679 Lykstad.", [("street_address", "Baumstraße 7, 00679 Lykstad")]),
        ("Avenue and street plots of lane 5 look alike", []),
        ("could you ask mulu stepp about it? Checked with Ann B. Lee and Roe, Max; both agree.", [("person_name", "mulu stepp"), ("person_name", "Ann B. Lee"), ("person_name", "Roe, Max")]),
        ("According to PMID:1, the Halbrun assay of Stad Reagents", []),
        ("Corresponding\n> author: Ann\n> Lee. E-mail", [("person_name", "Ann\n> Lee")]),
        ("", []),
        (None, []),
    ],
)
def test_spans(text, found):
    spans = pii.Finder().spans(text)
    assert [(s.kind, text[s.start : s.end]) for s in spans] == found


def test_redacted(spark):
    text = "thanks, Zah\nMail a@b.org or (555) 555-0170."
    docs = spark.createDataFrame([(1, text, "k"), (2, None, "k"), (3, "x" * 300_000 + " a@b.org", "k"), (1, text, "k")], "doc_id bigint, text string, pii_kind string")
    got = sorted((r.doc_id, r.text[-60:] if r.text else None) for r in pii.redacted(docs).where("doc_id < 3").collect())
    want = "thanks, [PERSON_NAME]\nMail [EMAIL] or [PHONE]."
    assert got == [(1, want), (1, want), (2, None)]
    assert Counter(r.doc_id for r in pii.personal_information(docs).collect()) == {1: 6, 3: 1}
    assert pii.personal_information(docs.where("false")).count() == 0
