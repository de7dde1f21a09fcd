"""Queries of the training-data operators over the project's tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm import canonical, leakage, ledger, mixture, pii, survivor
from curata.session import checkpointed, load

TYPED = ["v_alpha", "j_beta", "mhc_b"]
CONTESTED = ["reference_id", "method_identification", "meta_study_id"]
TOKENIZER = os.environ.get("CURATA_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
PLAIN, NAMED = ["cdr3_alpha", "v_beta", "species", "antigen_epitope"], ["attribute_text"]


def p3_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonical_names(load(spark, sf_dir, "receptor_records"), load(spark, sf_dir, "reference_names"), TYPED)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_names(spark, sf_dir).select("record_id", "field_name", "name_id")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_names(spark, sf_dir).where("name_id = 0").groupBy("field_name", "typed").agg(F.count("*").alias("n_rows"))


def p4_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.fused(load(spark, sf_dir, "record_versions"), CONTESTED, survivor.trusted_order()).withColumn("truth", F.round("truth", 6))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivor.representatives(load(spark, sf_dir, "record_versions"), CONTESTED, survivor.trusted_order())


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = survivor.survivors(p4_values(spark, sf_dir), CONTESTED)
    return records.select("complex_key", *CONTESTED, *[F.to_json(f"{f}_true").alias(f"{f}_true") for f in CONTESTED])


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(ledger.keyed(load(spark, sf_dir, "registry_lines"), PLAIN, NAMED, "line_id", "registry"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _keys(spark, sf_dir)
    return ledger.copies(keys, ledger.ledger_of(keys))


def p7_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ledger.ledger_of(_keys(spark, sf_dir))
    return ledger.collapsed(load(spark, sf_dir, "registry_lines"), counts).select("line_id", *PLAIN, *NAMED, "n_copies")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"), TOKENIZER)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.shares(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"), TOKENIZER)


def p10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_information(load(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_spans(spark, sf_dir).select("doc_id", "pii_kind", "start_pos")


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redacted(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p3_found, p3_names, p3_unmatched, p4_found, p4_values, p4_survivors, p7_found, p7_collapsed, p8_found, p8_leaks, p9_mixed, p9_shares, p10_found, p10_spans, p10_redacted)
}

_STATED = """
w AS (SELECT version_id, complex_key, trust_rank, updated_at, count(*) OVER (PARTITION BY complex_key) AS n, reference_id, method_identification, meta_study_id FROM record_versions WHERE complex_key IS NOT NULL),
u AS (SELECT version_id, complex_key, trust_rank, updated_at, n, 'reference_id' AS field_name, reference_id AS v FROM w
  UNION ALL SELECT version_id, complex_key, trust_rank, updated_at, n, 'method_identification', method_identification FROM w
  UNION ALL SELECT version_id, complex_key, trust_rank, updated_at, n, 'meta_study_id', meta_study_id FROM w),
s AS (SELECT *, row_number() OVER (PARTITION BY complex_key, field_name ORDER BY trust_rank, updated_at DESC, version_id) AS r FROM u
  WHERE n > 1 AND regexp_matches(v, '[[:alnum:]]') AND trim(lower(v)) NOT IN ('unknown', 'tbd', 'na', 'not reported', 'n/a', 'none given'))
"""

_REGISTRY = r"""
f AS (SELECT line_id, list_transform(CASE WHEN attribute_text LIKE '{%' THEN list_transform(json_keys(attribute_text), lambda k: k || '=' || json_extract_string(attribute_text, '/' || k))
        ELSE regexp_split_to_array(attribute_text, '[;|\n]+') END,
        lambda p: regexp_replace(lower(regexp_extract(p, '^([^:=]*)[:=]', 1)), '[^a-z0-9]', '', 'g') || '=' || regexp_replace(lower(regexp_extract(p, '^[^:=]*[:=]((.|\n)*)$', 1)), '[^a-z0-9]', '', 'g')) AS p
      FROM registry_lines),
k AS (SELECT r.line_id, concat_ws('|', regexp_replace(lower(coalesce(cdr3_alpha, '')), '[^a-z0-9]', '', 'g'), regexp_replace(lower(coalesce(v_beta, '')), '[^a-z0-9]', '', 'g'),
        regexp_replace(lower(species), '[^a-z0-9]', '', 'g'), regexp_replace(lower(antigen_epitope), '[^a-z0-9]', '', 'g'),
        array_to_string(list_sort(list_filter(p, lambda x: NOT ends_with(x, '='))), ';')) AS key
      FROM registry_lines r JOIN f USING (line_id)),
g AS (SELECT line_id, min(line_id) OVER (PARTITION BY key) AS first_id, count(*) OVER (PARTITION BY key) AS n_copies FROM k)
"""



_GRAMS = r"""
i AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_items),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
gi AS (SELECT item_id, p, array_to_string(w[p:p + 11], ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS p FROM i WHERE len(w) >= 12)),
gd AS (SELECT doc_id, p, array_to_string(w[p:p + 11], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS p FROM d WHERE len(w) >= 12))
"""



def _model(rounds: int = 10) -> str:
    """The two-sided model, round by round: CTE judged holds the truth of every stated value."""
    steps = [
        "cl AS MATERIALIZED (SELECT DISTINCT complex_key AS k, field_name AS f, trim(v) AS val, entered_by AS src FROM s2)",
        "pv AS MATERIALIZED (SELECT complex_key AS k, field_name AS f, trim(v) AS val, count(*) AS n_versions, any_value(n) AS n, arg_min(version_id, r) AS version_id, min(r) = 1 AS is_best FROM s2 GROUP BY 1, 2, 3)",
        "e AS MATERIALIZED (SELECT pv.k, pv.f, pv.val, sp.src, cl.src IS NOT NULL AS said FROM pv JOIN (SELECT DISTINCT k, f, src FROM cl) sp ON sp.k = pv.k AND sp.f = pv.f LEFT JOIN cl ON cl.k = pv.k AND cl.f = pv.f AND cl.val = pv.val AND cl.src = sp.src)",
        "q0 AS MATERIALIZED (SELECT DISTINCT src, 0.7::DOUBLE AS sens, 0.9::DOUBLE AS spec FROM cl)",
    ]
    for i in range(rounds + 1):
        steps.append(f"t{i} AS MATERIALIZED (SELECT k, f, val, 1 / (1 + exp(-sum(CASE WHEN said THEN ln(sens / (1 - spec)) ELSE ln((1 - sens) / spec) END))) AS p FROM e JOIN q{i} USING (src) GROUP BY 1, 2, 3)")
        if i < rounds:
            steps.append(f"q{i + 1} AS MATERIALIZED (SELECT src, least(greatest((sum(p) FILTER (said) + 3.5) / (sum(p) + 5), 0.001), 0.999) AS sens, least(greatest((coalesce(sum(1 - p) FILTER (NOT said), 0) + 4.5) / (sum(1 - p) + 5), 0.001), 0.999) AS spec FROM e JOIN t{i} USING (k, f, val) GROUP BY 1)")
    steps.append(f"judged AS (SELECT k AS complex_key, f AS field_name, val AS value_text, n_versions, round(p, 6) AS truth, p >= 0.5 AS is_true, version_id, is_best FROM pv JOIN t{rounds} USING (k, f, val) WHERE n > 1)")
    return ", ".join(steps)


# All stated values, those of keys with one version too, since the model learns from them.
_ALL_STATED = _STATED.replace("s AS (SELECT", "s2 AS (SELECT").replace("WHERE n > 1 AND regexp_matches", "WHERE regexp_matches").replace("version_id, complex_key, trust_rank", "entered_by, version_id, complex_key, trust_rank")
_TRUE = ", ".join(f"min(value_text) FILTER (field_name = '{f}' AND is_best) AS {f}, to_json(coalesce(list(value_text ORDER BY truth DESC, value_text) FILTER (field_name = '{f}' AND is_true), []))::VARCHAR AS {f}_true" for f in CONTESTED)

SQL: dict[str, str] = {
    "p4_values": f"WITH {_ALL_STATED}, {_model()} SELECT * FROM judged",
    "p4_survivors": f"WITH {_ALL_STATED}, {_model()} SELECT complex_key, {_TRUE} FROM judged GROUP BY 1",
    "p4_found": f"WITH {_STATED} SELECT complex_key, field_name, version_id FROM s WHERE r = 1",
    "p7_found": f"WITH {_REGISTRY} SELECT first_id, line_id AS copy_id FROM g WHERE line_id <> first_id",
    "p7_collapsed": f"WITH {_REGISTRY} SELECT line_id, cdr3_alpha, v_beta, species, antigen_epitope, attribute_text, n_copies FROM g JOIN registry_lines USING (line_id) WHERE line_id = first_id",
    "p8_found": f"WITH {_GRAMS} SELECT DISTINCT doc_id, item_id FROM gd JOIN gi USING (gram)",
    # Runs of matching windows along a diagonal; where these do not overlap they are the tiles.
    "p8_leaks": f"""WITH {_GRAMS},
m AS (SELECT doc_id, item_id, d, i - row_number() OVER (PARTITION BY doc_id, item_id, d ORDER BY i) AS g FROM (SELECT doc_id, item_id, gd.p AS i, gd.p - gi.p AS d FROM gd JOIN gi USING (gram))),
r AS (SELECT doc_id, item_id, count(*) + 11 AS n FROM m GROUP BY doc_id, item_id, d, g)
SELECT doc_id, item_id, count(*)::INT AS n_tiles, max(n)::INT AS longest, sum(n)::INT AS covered, sum(n) / any_value(len(w))::DOUBLE AS coverage FROM r JOIN i USING (item_id) GROUP BY 1, 2""",
}
